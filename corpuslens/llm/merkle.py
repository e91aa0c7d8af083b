r"""Merkle manifest of a dataset over concatenated-level strings.

Every row is a leaf: the SHA-256 of its fields, each written as its UTF-8
byte count, ``:`` and its value, or ``-`` if null.  Per source the leaves, in
order of doc_id, are hashed together ``ARITY`` by ``ARITY`` until one node,
the subroot, remains; the subroots, in order of source, likewise give the
root.

Leaves are numbered within their source, and ``ARITY ** DEPTH`` neighbours
form an aligned block: one row, whose level is one string of hex digests, 64
characters a node.  Parents are the digests of its fixed-width substrings, so
a level follows from the one below without moving a row; the siblings of a
node are the substrings that flank it in its run.  A block's top is a node
again: the tops of a source form blocks of the next round, and so on, until
one node a source remains; then the same is done once more with the subroots.
A block holds at most 729 leaves, however many rows a source has.

A proof is the list of (left, right) siblings, level by level from the leaf
to the root, so ``fold`` recomputes the root from a leaf and its proof alone.

Defined results: null fields are ``-``; null source is a source of its own,
first in order; null doc_id comes first in its source; rows that share source
and doc_id are ordered by their leaf, equal rows are leaves of their own; very
long texts are hashed whole; an empty table has no root and gives an empty
result; extra columns are not part of a leaf and are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import prepared, query, saved, sized, table
from corpuslens.operators.ordering import group_row_index

ARITY = 3
#: levels that a block holds; 3 ** 6 = 729 leaves
DEPTH = 6
HEX = 64
#: what makes a leaf, in order
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_EMPTY = "array<struct<left:string,right:string>>"


def field(value):
    """A field's part of the leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row, replaced=None):
    """Digest of the fields of ``row`` (a function name -> column)."""
    parts = [field((replaced or {}).get(c, row(c))) for c in FIELDS]
    return F.sha2(F.concat(*parts), 256)


def tampered(doc_id, text):
    """The text without line feeds where 2 divides the CRC-32 of the id."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.translate(text, "\n", "")).otherwise(text)


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, probe: one narrow row per row of ``docs``;
    ``probe`` is the leaf of the row as it would be after tampering."""
    col = F.col
    probe = leaf_of(col, {"text": tampered(col("doc_id"), col("text"))})
    return docs.select(col("source").cast("string").alias("source"), col("doc_id").cast("long").alias("doc_id"),
                       leaf_of(col).alias("leaf"), probe.alias("probe"))


def _part(level, start, nodes):
    """``nodes`` digests of a level from the node ``start`` on; both columns."""
    return F.substring(level, start * HEX + 1, nodes * HEX)


def _nodes(level):
    return F.expr(f"cast(octet_length({level}) div {HEX} as int)")


def _parents(level: str):
    """The level above, as bytes; a level with one node stays unless the
    block is only a part of its group (then it goes on to its full depth)."""
    runs = F.expr(f"cast(ceil(octet_length({level}) / {ARITY * HEX}) as int)")
    hashed = F.array_join(F.transform(
        F.sequence(F.lit(0), runs - 1),
        lambda i: F.sha2(_part(F.col(level), i * ARITY, F.lit(ARITY)), 256)), "").cast("binary")
    return F.when((_nodes(level) > 1) | (F.col("blocks") > 1), hashed).otherwise(F.col(level))


def _flanks(position, level: int):
    """Siblings of the node above ``position`` in a level of the block."""
    name = f"l{level}"
    node = F.floor(position / ARITY ** level).cast("int")
    run = F.floor(node / ARITY).cast("int") * ARITY
    last = F.least(run + ARITY, _nodes(name))
    return F.struct(_part(F.col(name), run, node - run).cast("string").alias("left"),
                    _part(F.col(name), node + 1, last - node - 1).cast("string").alias("right"))


def _block_round(nodes: DataFrame) -> DataFrame:
    """``nodes(grp, pos, digest, group_rows)`` -> one row per block: grp,
    block, blocks, top and an array of (pos, path)."""
    size = ARITY ** DEPTH
    d = nodes.select("grp", "digest", "pos", F.floor(F.col("pos") / size).cast("long").alias("block"),
                     F.ceil(F.col("group_rows") / size).cast("long").alias("blocks"))
    # at most ARITY ** DEPTH digests a row
    d = (d.groupBy("grp", "block", "blocks").agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("of"))
         .withColumn("l0", F.array_join(F.transform("of", lambda x: x["digest"]), "").cast("binary")))
    for level in range(DEPTH):
        d = d.withColumn(f"l{level + 1}", _parents(f"l{level}"))
    first = F.col("block") * size

    def path(x):
        at = (x["pos"] - first).cast("int")
        steps = [F.when((_nodes(f"l{k}") > 1) | (F.col("blocks") > 1), F.array(_flanks(at, k)))
                 .otherwise(F.array().cast(_EMPTY)) for k in range(DEPTH)]
        return F.struct(x["pos"].alias("pos"), F.concat(*steps).alias("path"))

    return d.select("grp", "block", "blocks", F.col(f"l{DEPTH}").cast("string").alias("top"),
                    F.transform("of", path).alias("of"))


def hash_up(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes(grp, pos, digest, group_rows)``, positions dense from 0 in
    each group -> (grp, pos, path) of every node and (grp, top) of every group."""
    below = saved(_block_round(nodes))
    paths = below.select("grp", "block", F.inline("of"))
    more = below.filter("blocks > 1")
    tops = below.filter("blocks = 1").select("grp", "top")
    if more.isEmpty():
        return paths.select("grp", "pos", "path"), tops
    # the tops of a group's blocks are nodes of the next round
    above, higher = hash_up(more.select("grp", F.col("block").alias("pos"), F.col("top").alias("digest"),
                                        F.col("blocks").alias("group_rows")))
    above = saved(above.select("grp", F.col("pos").alias("block"), F.col("path").alias("rest")))
    paths = (paths.join(sized(above, 4096), ["grp", "block"], "left")
             .select("grp", "pos", F.concat("path", F.coalesce("rest", F.array().cast(_EMPTY))).alias("path")))
    return paths, tops.unionByName(higher)


def fold(leaf, path):
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path):
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, probe, subroot, root and path (the proof)."""
    prepared(docs.sparkSession)
    # null sorts before any source, which starts with "="
    keyed = leaves(docs).withColumn("grp", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    ordered = saved(group_row_index(keyed, ["grp"], ["doc_id", "leaf", "probe"], "pos"))
    within, subroots = hash_up(ordered.select("grp", "pos", F.col("leaf").alias("digest"), "group_rows"))
    # the sources themselves are one group
    listed = saved(group_row_index(subroots.select(F.lit("").alias("all"), "grp", "top"), ["all"], ["grp"], "pos"))
    across, tops = hash_up(listed.select(F.col("all").alias("grp"), "pos", F.col("top").alias("digest"), "group_rows"))
    root = tops.first()
    sources = saved(listed.join(across.select("pos", F.col("path").alias("rest")), "pos")
                    .select("grp", F.col("top").alias("subroot"), "rest"))
    return (ordered.select("grp", "pos", "source", "doc_id", "leaf", "probe").join(within, ["grp", "pos"])
            .join(sized(sources, 4096), "grp")
            .select("source", "doc_id", "leaf", "probe", "subroot",
                    F.lit(root["top"] if root else None).cast("string").alias("root"),
                    F.concat("path", "rest").alias("path")))


def verify(rows: DataFrame, leaf: str) -> DataFrame:
    """``manifest`` rows plus folded_root and verified for the leaf column."""
    return rows.withColumn("folded_root", fold(F.col(leaf), F.col("path"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _sql_levels(base: str, name: str, levels: int) -> str:
    """Levels above ``base(g, i, h)`` and every leaf's way up, one CTE each."""
    out = [f"{name}n0 as materialized (select g, i, h, count(*) over (partition by g) as c from {base})"]
    for j in range(levels):
        out.append(f"""{name}r{j} as materialized (select g, i // {ARITY} as i, any_value(c) as c, list(h order by i) as kids,
  case when any_value(c) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h
  from {name}n{j} group by g, i // {ARITY})""")
        out.append(f"{name}n{j + 1} as materialized (select g, i, h, count(*) over (partition by g) as c from {name}r{j})")
    return ",\n".join(out)


def _sql_way(rows: str, name: str, levels: int, group: str, place: str) -> str:
    """Proof and folded node of ``rows(g, i, proof, fold, ...)``, level by level."""
    out, last = [], rows
    for j in range(levels):
        left = f"array_to_string(r.kids[1:p.{place} % {ARITY}], '')"
        right = f"array_to_string(r.kids[p.{place} % {ARITY} + 2:], '')"
        out.append(f"""{name}p{j} as materialized (select p.* replace (p.{place} // {ARITY} as {place}, p.proof || {left} || {right} as proof,
    case when r.c > 1 then sha256({left} || p.fold || {right}) else p.fold end as fold)
  from {last} p join {name}r{j} r on r.g = p.{group} and r.i = p.{place} // {ARITY})""")
        last = f"{name}p{j}"
    return ",\n".join(out)


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar))::varchar || ':' || {value}::varchar, '-')"


#: levels written out in the SQL: enough for 3 ** 12 rows a source, 3 ** 9 sources
_SQL_DEPTH, _SQL_SOURCES = 12, 9
_SQL_CRC = """xor(list_reduce([4294967295::ubigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint),
    lambda a, b: list_reduce([xor(a, b)] || [0::ubigint for _ in range(8)], lambda c, _: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""

OP12_SQL = f"""
with t as (
  select doc_id, source, lang, n_chars, text,
         case when {_SQL_CRC} % 2 = 0 then replace(text, chr(10), '') else text end as cut
  from documents),
d as materialized (
  select doc_id, coalesce('=' || source, '') as g,
         sha256({' || '.join(map(_sql_field, FIELDS))}) as leaf,
         sha256({' || '.join(_sql_field('cut' if c == 'text' else c) for c in FIELDS)}) as probe
  from t),
k as materialized (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf, probe) - 1 as i from d),
base as (select g, i, leaf as h from k),
{_sql_levels('base', 'a', _SQL_DEPTH)},
s as materialized (select g as source, '' as g, row_number() over (order by g) - 1 as i, h from an{_SQL_DEPTH}),
{_sql_levels('s', 'b', _SQL_SOURCES)},
way as (select k.doc_id, k.leaf, k.g, k.i, s.h as subroot, '' as top, s.i as place, '' as proof, k.probe as fold
        from k join s on s.source = k.g),
{_sql_way('way', 'a', _SQL_DEPTH, 'g', 'i')},
{_sql_way(f'ap{_SQL_DEPTH - 1}', 'b', _SQL_SOURCES, 'top', 'place')}
select doc_id, leaf, subroot, root.h as root, sha256(proof) as proof_sha256, fold as folded_root, fold = root.h as verified
from bp{_SQL_SOURCES - 1}, (select h from bn{_SQL_SOURCES}) root"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark, sf_dir):
    """Leaves, roots and proofs of all documents, and a check after tampering."""
    rows = verify(manifest(table(spark, sf_dir, "documents")), "probe")
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", "verified")
