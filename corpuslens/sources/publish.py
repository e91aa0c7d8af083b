"""Versioned publication of derived tables (K2, K3).

Tables that belong together are written below a folder of their own and become
visible by one rename of a manifest, ``manifest-<number>.json``, which names
the folder of each table and the fingerprint of what they were made from.
Readers take the newest manifest, so they see all tables of one version or all
of another; a folder is never changed once it is published, so a reader that
started on an older version goes on undisturbed.  A writer that dies leaves a
folder that nothing names.  If two writers publish the same number, the rename
of the second fails and it takes the next one.

The fingerprint covers the rows of the input (their number, and the sum and
exclusive-or of their 64-bit hashes, so order and partitions don't matter),
its schema and the options.  An unchanged input is served from the cache, a
changed one is built again.  It costs a scan of the columns that are given.

The rename must be atomic and must not replace a file, as on HDFS and local
disks; a store without such a rename needs a single writer.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.session import _store, child_names, path_exists

PREFIX, SUFFIX = "manifest-", ".json"
#: how often a writer tries the next number
ATTEMPTS = 20


def fingerprint(rows: DataFrame, options: Mapping | None = None) -> str:
    """Hex digest of the content of ``rows`` and the options."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) if rows.columns else F.lit(0)
    # equal values of neighbouring columns hash alike with nulls between them: tell nulls apart
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in rows.columns])
    h = F.xxhash64(h, nulls)
    n, total, odd = rows.select(h.alias("h")).agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    known = json.dumps([n, str(total), odd, rows.schema.jsonValue(), dict(options or {})], sort_keys=True, default=str)
    return hashlib.sha256(known.encode()).hexdigest()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    if not path_exists(spark, root):
        return []
    names = [n for n in child_names(spark, root) if n.startswith(PREFIX) and n.endswith(SUFFIX)]
    return sorted(int(n[len(PREFIX):-len(SUFFIX)]) for n in names)


def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{PREFIX}{number:08d}{SUFFIX}"


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The manifest with this number, or the newest; None if there is none."""
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    rows = spark.read.text(_manifest_path(root, numbers[-1] if number is None else number), wholetext=True).collect()
    return json.loads(rows[0][0])


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Give ``source`` its name unless that is taken."""
    from py4j.protocol import Py4JJavaError

    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    path, _ = _store(spark, target)
    old, _ = _store(spark, source)
    none = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), sc._jsc.hadoopConfiguration()).rename(old, path, none)
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in str(exc.java_exception):
            return False
        raise
    return True


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], key: str) -> dict:
    """Write ``tables`` as a new version and make it the newest."""
    root = root.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{version}/{name}")
    found = {"fingerprint": key, "tables": {name: f"{version}/{name}" for name in tables}}
    waiting = f"{root}/{version}/manifest"
    path, fs = _store(spark, waiting)
    out = fs.create(path, False)
    out.write(bytearray(json.dumps(found).encode()))
    out.close()
    for _ in range(ATTEMPTS):
        number = (_numbers(spark, root) or [0])[-1] + 1
        if _rename(spark, waiting, _manifest_path(root, number)):
            return found
    raise RuntimeError(f"{ATTEMPTS} other versions were published meanwhile: {root!r}")


def read_published(spark: SparkSession, root: str, found: dict | None = None) -> dict[str, DataFrame]:
    """The tables of a manifest (by default the newest), all of one version."""
    found = found or manifest(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing is published in {root!r}")
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{p}") for name, p in found["tables"].items()}


def load_or_build(spark: SparkSession, root: str, names: Sequence[str], build: Callable[[], dict[str, DataFrame]],
                  source: DataFrame, options: Mapping | None = None) -> dict[str, DataFrame]:
    """Tables made from ``source``: those published for the same content and
    options if there are, else built and published together."""
    key = fingerprint(source, options)
    for number in reversed(_numbers(spark, root)):
        found = manifest(spark, root, number)
        if found["fingerprint"] == key and set(names) <= set(found["tables"]):
            return {n: df for n, df in read_published(spark, root, found).items() if n in names}
    built = build()
    return read_published(spark, root, publish(spark, root, {n: built[n] for n in names}, key))
