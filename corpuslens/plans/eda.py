"""Corpus exploration queries: scans, per-field statistics, melt, box and
histogram numbers, word frequencies, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import readability as rd
from corpuslens.functions import segment
from corpuslens.operators import bootstrap, collocate, reshape, sketches, stats
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query, r6
from corpuslens.session import cut_lineage, scratch_dir
from corpuslens.sources import layout
from corpuslens.sources.tables import corpus, read_table

SPLITS = ["train", "validation", "test"]
FIELDS = ["article", "summary", "title"]
SAMPLE_SIZE = 500
SAMPLE_SEED = 0
SHUFFLE_SEED = 3407
HIST_BINS = 20
TOP_WORDS = 200

_SQL_SPLIT = "(case doc_id % 10 when 8 then 'validation' when 9 then 'test' else 'train' end)"
_SQL_CORPUS = (f"corpus as (select doc_id, lang as dataset, {_SQL_SPLIT} as split, "
               f"{q.sentences('text')}[1] as title, text as article, {q.abstract('text')} as summary "
               f"from documents)")


def field_stats(df, fields=FIELDS):
    """``{f}_tokens``, ``{f}_sentences``, ``{f}_avg_sent_len`` for each field."""
    out = df
    for f in fields:
        for name, expr in stats.text_stats(f).items():
            out = out.withColumn(f"{f}_{name}", expr)
    return out


def corpus_stats(spark, sf_dir):
    """Per-document statistics of every field plus summary readability."""
    c = corpus(spark, sf_dir)
    st = field_stats(c)
    st = rd.with_counts(st, "summary", prefix="s_")
    return st.select(
        "doc_id", "split", *[f"{f}_{m}" for f in FIELDS for m in ("tokens", "sentences", "avg_sent_len")],
        rd.flesch_reading_ease("s_n_words", "s_n_sents", "s_n_syll").alias("summary_flesch_reading_ease"),
        rd.flesch_kincaid_grade("s_n_words", "s_n_sents", "s_n_syll").alias("summary_flesch_kincaid_grade"),
    )


def _sql_field(f: str) -> str:
    s = q.sentences(f)
    return (f"cast(len({q.tokens(f)}) as bigint) as {f}_tokens, cast(len({s}) as bigint) as {f}_sentences, "
            f"coalesce(list_sum(list_transform({s}, lambda x: len(regexp_extract_all(x, '{q.TOKEN_RE}')))) "
            f"/ nullif(len({s}), 0), 0.0) as {f}_avg_sent_len")


_SQL_STATS = (
    "with " + _SQL_CORPUS + ", "
    "st as (select doc_id, split, " + ", ".join(_sql_field(f) for f in FIELDS) + ", "
    f"len({q.words('summary')}) as sw, len({q.sentences('summary')}) as ss, "
    f"greatest({q.vowel_groups('summary')}, len({q.words('summary')})) as sy from corpus), "
    "stats as (select *, case when sw > 0 then 206.835 - 1.015 * (sw / nullif(ss, 0)) - 84.6 * (sy / sw) end "
    "as summary_flesch_reading_ease, case when sw > 0 then 0.39 * (sw / nullif(ss, 0)) + 11.8 * (sy / sw) "
    "- 15.59 end as summary_flesch_kincaid_grade from st)"
)

_STAT_COLS = [f"{f}_{m}" for f in FIELDS for m in ("tokens", "sentences", "avg_sent_len")]


def _r6_doubles(df):
    return df.select(*[r6(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("corpus_scan",
       "with " + _SQL_CORPUS + " select doc_id, dataset, split, title, article, summary from corpus")
def q_corpus_scan(spark, sf_dir):
    return corpus(spark, sf_dir)


def _stored(spark, sf_dir):
    return layout.layout_of(spark, sf_dir, scratch_dir(spark, "layout"))


@query("split_scan", f"with {_SQL_CORPUS} select doc_id, dataset, split, title, summary, cast(length(article) as bigint) as n_chars "
       "from corpus where dataset = 'en' and split = 'validation'")
def q_split_scan(spark, sf_dir):
    """One split of one dataset, from the layout: other folders aren't opened."""
    one = layout.read_layout(spark, _stored(spark, sf_dir), "en", "validation")
    return one.select("doc_id", "dataset", "split", "title", "summary", F.length("article").cast("bigint").alias("n_chars"))


@query("requested_scan",
       f"with {_SQL_CORPUS}, sizes as (select dataset, split, count(*) as n from corpus where dataset is not null group by all), "
       "wanted as (select * from sizes where split <> 'train' and n * 10 <= (select count(*) from corpus)) "
       "select doc_id, dataset, split, cast(length(article) as bigint) as n_chars from corpus join wanted using (dataset, split)")
def q_requested_scan(spark, sf_dir):
    """Held-out splits with at most a tenth of all articles: which ones these
    are is a stored table, so folders are pruned at run time."""
    path = _stored(spark, sf_dir)
    sizes = spark.read.parquet(path).where("dataset is not null").groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n"))
    table = scratch_dir(spark, "requests")
    total = read_table(spark, sf_dir, "documents").count()
    sizes.select("dataset", "split", "n", F.lit(total).alias("total")).write.parquet(table)
    wanted = spark.read.parquet(table).where("split <> 'train' and n * 10 <= total")
    got = layout.read_requested(spark, path, wanted)
    return got.select("doc_id", "dataset", "split", F.length("article").cast("bigint").alias("n_chars"))


@query("concat_splits",
       "with " + _SQL_CORPUS + " select doc_id, dataset, split, title, summary from corpus")
def q_concat_splits(spark, sf_dir):
    # the splits are one table with a column that tells them apart
    return corpus(spark, sf_dir).where(F.col("split").isin(SPLITS)).select("doc_id", "dataset", "split", "title", "summary")


@query("text_stats", _SQL_STATS + " select doc_id, split, "
       + ", ".join(q.r6(c) + f" as {c}" if c.endswith("avg_sent_len") else c for c in _STAT_COLS)
       + f", {q.r6('summary_flesch_reading_ease')} as summary_flesch_reading_ease, "
       + f"{q.r6('summary_flesch_kincaid_grade')} as summary_flesch_kincaid_grade from stats")
def q_text_stats(spark, sf_dir):
    return _r6_doubles(corpus_stats(spark, sf_dir))


MEASURES = ("tokens", "sentences", "avg_sent_len")
_SQL_MELT = " union all ".join(
    f"select doc_id, split, '{f}' as field, '{m}' as measure, cast({f}_{m} as double) as value from stats"
    for f in FIELDS for m in MEASURES)


def melted_stats(spark, sf_dir):
    """(doc_id, split, field, measure, value) for every field and measure."""
    st = corpus_stats(spark, sf_dir)
    items = [F.struct(F.lit(f).alias("field"), F.lit(m).alias("measure"), F.col(f"{f}_{m}").cast("double").alias("value"))
             for f in FIELDS for m in MEASURES]
    return st.select("doc_id", "split", F.explode(F.array(*items)).alias("_x")).select("doc_id", "split", "_x.*")


@query("melt_stats", _SQL_STATS + f" select doc_id, split, field, measure, {q.r6('value')} as value from ({_SQL_MELT})")
def q_melt_stats(spark, sf_dir):
    return _r6_doubles(melted_stats(spark, sf_dir))


@query("melt_tokens", _SQL_STATS + " " + " union all ".join(
    f"select doc_id, split, '{f}' as field, {f}_tokens as tokens from stats" for f in FIELDS))
def q_melt_tokens(spark, sf_dir):
    return reshape.melt(corpus_stats(spark, sf_dir), ["doc_id", "split"], FIELDS, "tokens")


_SQL_BOX = (
    _SQL_STATS + f", melted as (select split, field, measure, value as v from ({_SQL_MELT})), "
    "qs as (select split, field, measure, count(*) as n, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, "
    "quantile_cont(v, 0.75) as q3 from melted group by split, field, measure), "
    "wk as (select m.split, m.field, m.measure, min(case when v >= q1 - 1.5 * (q3 - q1) then v end) as whisker_low, "
    "max(case when v <= q3 + 1.5 * (q3 - q1) then v end) as whisker_high "
    "from melted m join qs using (split, field, measure) group by m.split, m.field, m.measure) "
    "select split, field, measure, n, "
    + ", ".join(f"{q.r6(c)} as {c}" for c in ("q1", "median", "q3", "whisker_low", "whisker_high"))
    + " from qs join wk using (split, field, measure)"
)


@query("box_stats", _SQL_BOX)
def q_box_stats(spark, sf_dir):
    return _r6_doubles(stats.box_stats(melted_stats(spark, sf_dir), ["split", "field", "measure"], "value"))


#: documents of one slice: what arrives together and is sketched once
SLICE_DOCS = 256


def _sketched(spark, sf_dir):
    """All measures, and their sketches by slice of documents, stored."""
    g = ["split", "field", "measure"]
    long = melted_stats(spark, sf_dir).withColumn("slice", F.floor(F.col("doc_id") / SLICE_DOCS))
    path = scratch_dir(spark, "sketches")
    sketches.write_slices(sketches.slice_sketches(long, g, "slice", "value"), path)
    return long, sketches.merged(spark.read.parquet(path), g)


@query("box_stats_sketched")
def q_box_stats_sketched(spark, sf_dir):
    """Box numbers of every group from its slices' sketches."""
    _, whole = _sketched(spark, sf_dir)
    return _r6_doubles(sketches.box(whole, ["split", "field", "measure"]))


@query("sketch_rank_error", _SQL_STATS + f", melted as (select split, field, measure, value as v from ({_SQL_MELT})) "
       "select split, field, measure, count(*) as n, true as q1_near, true as median_near, true as q3_near, "
       "min(v) as low, max(v) as high from melted where v is not null group by all")
def q_sketch_rank_error(spark, sf_dir):
    """Whether each quartile's exact rank is within the stated error."""
    g = ["split", "field", "measure"]
    long, whole = _sketched(spark, sf_dir)
    ranks = sketches.exact_ranks(long, sketches.box(whole, g), g, "value", ["q1", "median", "q3"])
    near = [((F.col(f"{c}_below") <= (p + sketches.RANK_ERROR) * F.col("n")) & (F.col(f"{c}_upto") >= (p - sketches.RANK_ERROR) * F.col("n")))
            .alias(f"{c}_near") for c, p in zip(("q1", "median", "q3"), stats.QUARTILES)]
    return ranks.join(whole.select(*g, "low", "high"), g).select(*g, "n", *near, "low", "high")


# Fixed value: the splits whose readability is drawn.
HIST_SPLITS = ("train", "validation")
SCORES = {"FRE": "summary_flesch_reading_ease", "FKGL": "summary_flesch_kincaid_grade"}


def _sql_hist(score: str, col: str) -> str:
    return (f"select '{score}' as score, split, bucket, {q.r6(f'lo + (bucket - 1) * (hi - lo) / {HIST_BINS}.0')} as bin_low, "
            f"{q.r6(f'lo + bucket * (hi - lo) / {HIST_BINS}.0')} as bin_high, count(*) as count from ("
            f"select split, case when hi - lo = 0 then 1 else least(cast(floor((v - lo) / (hi - lo) * {HIST_BINS}.0) "
            f"as bigint) + 1, {HIST_BINS}) end as bucket, lo, hi from (select split, {col} as v from shown where {col} is not null) "
            f"cross join (select min({col}) as lo, max({col}) as hi from shown)) group by split, bucket, lo, hi")


@query("readability_hist", _SQL_STATS + f", shown as (select * from stats where split in {HIST_SPLITS}) "
       + " union all ".join(_sql_hist(k, v) for k, v in SCORES.items()))
def q_readability_hist(spark, sf_dir):
    st = corpus_stats(spark, sf_dir).where(F.col("split").isin(*HIST_SPLITS)).select("split", *SCORES.values())
    h = stats.histograms(st, ["split"], SCORES, HIST_BINS)
    return h.select("score", "split", "bucket", r6("bin_low").alias("bin_low"), r6("bin_high").alias("bin_high"), "count")


@query("readability_vs_length",
       _SQL_STATS + " select split, count(*) as n, "
       f"{q.r6('corr(summary_flesch_reading_ease, summary_avg_sent_len)')} as fre_corr, "
       f"{q.r6('regr_slope(summary_flesch_reading_ease, summary_avg_sent_len)')} as fre_slope, "
       f"{q.r6('corr(summary_flesch_kincaid_grade, summary_avg_sent_len)')} as fkgl_corr, "
       f"{q.r6('regr_slope(summary_flesch_kincaid_grade, summary_avg_sent_len)')} as fkgl_slope "
       "from stats where summary_flesch_reading_ease is not null group by split")
def q_readability_vs_length(spark, sf_dir):
    st = corpus_stats(spark, sf_dir).where(F.col("summary_flesch_reading_ease").isNotNull())
    x = F.col("summary_avg_sent_len")
    return st.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.corr("summary_flesch_reading_ease", x)).alias("fre_corr"),
        r6(F.regr_slope("summary_flesch_reading_ease", x)).alias("fre_slope"),
        r6(F.corr("summary_flesch_kincaid_grade", x)).alias("fkgl_corr"),
        r6(F.regr_slope("summary_flesch_kincaid_grade", x)).alias("fkgl_slope"),
    )


def _sql_frequencies(source: str, text_col: str) -> str:
    return (f"select word, count(*) as count from (select unnest({q.words(text_col)}) as word from {source}) "
            f"group by word order by count desc, word limit {TOP_WORDS}")


_SQL_PAIRS = (
    f"with w as (select {q.words('text')} as w from documents), "
    "uc as materialized (select word, count(*)::double as n from (select unnest(w) as word from w) group by word), "
    "bc as (select w1, w2, count(*)::double as n from (select unnest(w[:-2]) as w1, unnest(w[2:]) as w2 from w where len(w) > 1) group by all), "
    "tt as (select sum(n) as t from uc), "
    "jn as (select w1, w2, bc.n as k, a.n as a, b.n as b, t, b.n / t as p, bc.n / a.n as p1, coalesce((b.n - bc.n) / nullif(t - a.n, 0), 0) as p2 "
    "from bc join uc a on a.word = w1 join uc b on b.word = w2, tt), "
    + "sc as materialized (select w1, w2, k as n, a as n1, b as n2, round(2 * ("
    + " ".join(f"{sign} ({k} * ln(greatest({p}, {collocate.LEAST})) + ({n} - {k}) * ln(greatest(1 - {p}, {collocate.LEAST})))"
               for sign, k, n, p in (("", "k", "a", "p1"), ("+", "(b - k)", "(t - a)", "p2"), ("-", "k", "a", "p"), ("-", "(b - k)", "(t - a)", "p")))
    + f"), {collocate.DIGITS}) as score from jn)")


@query("word_pairs", _SQL_PAIRS + " select w1, w2, n::bigint as n, n1::bigint as n1, n2::bigint as n2, score from sc "
       f"where score > {collocate.PAIR_SCORE}")
def q_word_pairs(spark, sf_dir):
    """Adjacent words that belong together, with their contingency counts."""
    docs = read_table(spark, sf_dir, "documents").select("text")
    words, pairs = cut_lineage(collocate.word_counts(docs, "text")), cut_lineage(collocate.pair_counts(docs, "text"))
    return collocate.pair_scores(words, pairs).where(F.col("score") > collocate.PAIR_SCORE)


@query("word_frequencies_pairs", _SQL_PAIRS + f", ch as (select w1, w2, n from sc where score > {collocate.PAIR_SCORE}), "
       "tk as (select word, sum(n) as t from (select w1 as word, n from ch union all select w2, n from ch) group by word) "
       "select word, count, pair from (select word, (uc.n - coalesce(t, 0))::bigint as count, false as pair from uc left join tk using (word) "
       "union all select w1 || ' ' || w2, n::bigint, true from ch) where count > 0 "
       f"order by count desc, word limit {TOP_WORDS}")
def q_word_frequencies_pairs(spark, sf_dir):
    """The most frequent words and pairs, each occurrence counted once."""
    docs = read_table(spark, sf_dir, "documents").select("text")
    return collocate.frequencies(docs, "text").orderBy(F.desc("count"), "word").limit(TOP_WORDS)


@query("readability_band", _SQL_STATS + ", " + bootstrap.sql_band("stats", "doc_id", ["split"], "summary_flesch_reading_ease")
       + f" select split, n, {q.r6('mean')} as mean, {q.r6('low')} as low, {q.r6('high')} as high from band")
def q_readability_band(spark, sf_dir):
    """Mean reading ease of each split with its 95 % band."""
    st = corpus_stats(spark, sf_dir).select("doc_id", "split", "summary_flesch_reading_ease")
    return _r6_doubles(bootstrap.confidence_band(st, "doc_id", ["split"], "summary_flesch_reading_ease"))


@query("word_frequencies", _sql_frequencies("documents", "text"))
def q_word_frequencies(spark, sf_dir):
    return stats.word_frequencies(read_table(spark, sf_dir, "documents").select("text"), "text", top=TOP_WORDS)


@query("word_frequencies_without",
       f"with stop as (select distinct unnest({q.words('text')}) as word from benchmark) "
       f"select word, count(*) as count from (select unnest({q.words('text')}) as word from documents) "
       f"where word not in (select word from stop) group by word order by count desc, word limit {TOP_WORDS}")
def q_word_frequencies_without(spark, sf_dir):
    """Without the words of a caller's table."""
    stop = read_table(spark, sf_dir, "benchmark").select(F.explode(segment.words("text")).alias("word")).distinct()
    return stats.word_frequencies(read_table(spark, sf_dir, "documents").select("text"), "text", stop, TOP_WORDS)


def _field_query(field: str):
    @query(f"word_frequencies_{field}", "with " + _SQL_CORPUS + " " + _sql_frequencies("corpus", field))
    def q_field(spark, sf_dir):
        return stats.word_frequencies(corpus(spark, sf_dir).select(field), field, top=TOP_WORDS)
    return q_field


for _field in ("summary", "title"):
    _field_query(_field)


@query("word_frequencies_sample",
       f"with sampled as (select text from documents order by md5(concat('{SAMPLE_SEED}', ':', cast(doc_id as varchar))), "
       f"doc_id limit {SAMPLE_SIZE}) " + _sql_frequencies("sampled", "text"))
def q_word_frequencies_sample(spark, sf_dir):
    """Words of a sample of 500 articles."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return stats.word_frequencies(stats.sample_exact(docs, "doc_id", SAMPLE_SIZE, SAMPLE_SEED), "text", top=TOP_WORDS)


@query("sample_exact",
       f"select doc_id, n_chars, md5(concat('{SAMPLE_SEED}', ':', cast(doc_id as varchar))) as sample_key "
       f"from documents order by sample_key, doc_id limit {SAMPLE_SIZE}")
def q_sample_exact(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return stats.sample_exact(docs, "doc_id", SAMPLE_SIZE, SAMPLE_SEED)


@query("seeded_shuffle",
       f"select doc_id, md5(concat('{SHUFFLE_SEED}', ':', cast(doc_id as varchar))) as shuffle_key "
       f"from documents order by shuffle_key, doc_id")
def q_seeded_shuffle(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return stats.seeded_shuffle(docs, "doc_id", SHUFFLE_SEED)
