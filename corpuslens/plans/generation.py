"""Generation, checkpoint/resume, delivery sinks, batch numbering and
training slices over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions import text
from corpuslens.operators import generate as gen
from corpuslens.operators import slices
from corpuslens.operators.ordering import row_index
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query
from corpuslens.session import scratch_dir
from corpuslens.sources import sinks
from corpuslens.sources.tables import corpus, read_table

BATCH_SIZE = gen.DEFAULT_BATCH_SIZE
FIRST_ATTEMPT_DATASET = "en"
SLICE_BEGIN, SLICE_END = 20, 45
DATA_SPLIT, EPOCHS = 0.15, 1
FINE_SLICES = 100_000

_SQL_SPLIT = "(case doc_id % 10 when 8 then 'validation' when 9 then 'test' else 'train' end)"
_SQL_OUT = q.all_sentences(q.body("text"))
# A model whose raw output has blank edges, as language models' have.
PADDING = " \n "


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"), "lang")


def generated(spark, sf_dir):
    """The documents with ``summary`` from the default model."""
    return gen.generate(_docs(spark, sf_dir), gen.body_model())


@query("batch_generate", f"select doc_id, {_SQL_OUT} as summary from documents")
def q_batch_generate(spark, sf_dir):
    return generated(spark, sf_dir).select("doc_id", "summary")


@query("resume_remaining",
       f"select doc_id, {_SQL_OUT} as summary, case when lang = '{FIRST_ATTEMPT_DATASET}' then 1 else 2 end "
       f"as attempt from documents")
def q_resume_remaining(spark, sf_dir):
    """Interrupted run (one dataset done) resumed over the whole corpus."""
    path = scratch_dir(spark, "generation-checkpoint")
    docs, fn = _docs(spark, sf_dir), gen.body_model()
    first = docs.where(F.col("lang") == FIRST_ATTEMPT_DATASET)
    gen.generate_resumable(spark, first, fn, path, tag={"attempt": 1})
    out = gen.generate_resumable(spark, docs, fn, path, tag={"attempt": 2})
    return out.select("doc_id", "summary", F.col("attempt").cast("int").alias("attempt"))


@query("read_generated", f"select ' ' || chr(10) || ' ' || {_SQL_OUT} || ' ' || chr(10) || ' ' as summary from documents")
def q_read_generated(spark, sf_dir):
    """S3: one column of a table of raw outputs; the others aren't scanned."""
    path = scratch_dir(spark, "raw-outputs")
    raw = gen.generate(_docs(spark, sf_dir), gen.body_model(PADDING), strip=False)
    raw.select("doc_id", "lang", "summary").write.parquet(path)
    return spark.read.parquet(path).select("summary")


@query("strip_generated", f"select doc_id, {q.strip(_SQL_OUT)} as summary from documents")
def q_strip_generated(spark, sf_dir):
    raw = gen.generate(_docs(spark, sf_dir), gen.body_model(PADDING), strip=False)
    return raw.select("doc_id", text.strip("summary").alias("summary"))


def _pairs(spark, sf_dir):
    return generated(spark, sf_dir).select(
        "doc_id", F.col("summary").alias("generated_caption"), text.abstract_of("prompt").alias("reference"),
        F.col("prompt").alias("document"))


@query("eval_pairs_jsonl",
       f"select doc_id, {_SQL_OUT} as generated_caption, {q.abstract('text')} as reference, text as document "
       f"from documents")
def q_eval_pairs_jsonl(spark, sf_dir):
    """J4 + K4: output, reference and document of a row side by side, as JSON lines."""
    path = scratch_dir(spark, "eval-pairs") + ".jsonl"
    sinks.save_outputs(_pairs(spark, sf_dir), path, keys=["doc_id"])
    schema = "doc_id long, generated_caption string, reference string, document string"
    return spark.read.schema(schema).json(path)


@query("output_lines", f"select replace({_SQL_OUT}, chr(10), ' ') as value from documents")
def q_output_lines(spark, sf_dir):
    """K5: one output per line of a text file."""
    path = scratch_dir(spark, "output-lines") + ".TXT"
    sinks.save_outputs(_pairs(spark, sf_dir), path)
    return spark.read.text(path)


_SUB_SCHEMA = T.StructType([T.StructField("summary", T.StringType(), True)])


@query("submission_rows",
       f"select lang as dataset, {q.remove_brackets(q.remove_cutoff(_SQL_OUT))} as summary from documents")
def q_submission_rows(spark, sf_dir):
    """K7 + K8: post-processed outputs, tab-separated, headerless, one folder
    per dataset, gzip-compressed; read back from the delivery files."""
    rows = generated(spark, sf_dir).select(F.col("lang").alias("dataset"), text.postprocess("summary").alias("summary"))
    path = scratch_dir(spark, "submission")
    sinks.save_submission(rows, path, "dataset")
    return sinks.read_submission(spark, path, _SUB_SCHEMA).select("dataset", F.coalesce("summary", F.lit("")).alias("summary"))


@query("corpus_csv_roundtrip",
       f"select doc_id, text as article, {q.abstract('text')} as summary, text as transformed from documents")
def q_corpus_csv_roundtrip(spark, sf_dir):
    """K1 + S2: fixed three text columns (plus key) to CSV and back."""
    c = corpus(spark, sf_dir).select("doc_id", "article", "summary", F.col("article").alias("transformed"))
    path = scratch_dir(spark, "transformed-csv")
    (c.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').csv(path))
    schema = "doc_id long, article string, summary string, transformed string"
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


@query("project_reorder", f"select summary, doc_id, article from (select doc_id, text as article, "
       f"{q.abstract('text')} as summary from documents)")
def q_project_reorder(spark, sf_dir):
    return corpus(spark, sf_dir).select("summary", "doc_id", "article")


@query("column_map", f"select doc_id, {q.body('text')} as input, {q.abstract('text')} as output from documents")
def q_column_map(spark, sf_dir):
    c = read_table(spark, sf_dir, "documents").select(
        "doc_id", text.body_of("text").alias("extracted_summary"), text.abstract_of("text").alias("summary"))
    return c.withColumnsRenamed({"extracted_summary": "input", "summary": "output"})


@query("batch_assign",
       f"select doc_id, cast(row_number() over (order by doc_id) as bigint) as row_number, "
       f"cast(ceil(row_number() over (order by doc_id) / {BATCH_SIZE}.0) as bigint) as batch, "
       f"cast(ceil((select count(*) from documents) / {BATCH_SIZE}.0) as bigint) as n_batches from documents")
def q_batch_assign(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    idx = row_index(docs, ["doc_id"])
    n_batches = docs.select(F.ceil(F.count(F.lit(1)) / F.lit(float(BATCH_SIZE)))).scalar()
    return idx.select("doc_id", (F.col("idx") + 1).alias("row_number"),
                      (F.floor(F.col("idx") / BATCH_SIZE) + 1).cast("bigint").alias("batch"),
                      n_batches.cast("bigint").alias("n_batches"))


def _indexed_corpus(spark, sf_dir):
    c = corpus(spark, sf_dir).select("doc_id", "split")
    return slices.indexed_splits(c, "split", "doc_id")


_SQL_IDX = (f"with c as (select doc_id, {_SQL_SPLIT} as split from documents), "
            "ix as (select doc_id, split, row_number() over (partition by split order by doc_id) - 1 as idx, "
            "count(*) over (partition by split) as n from c)")


@query("percent_slice",
       _SQL_IDX + f" select doc_id, split, cast(idx as bigint) as idx from ix where split in ('train', 'validation') "
       f"and idx >= round_even(n * {float(SLICE_BEGIN)} / 100.0, 0) and idx < round_even(n * {float(SLICE_END)} / 100.0, 0)")
def q_percent_slice(spark, sf_dir):
    sl = slices.percent_slice(_indexed_corpus(spark, sf_dir), ["train", "validation"], SLICE_BEGIN, SLICE_END)
    return sl.select("doc_id", "split", F.col("idx").cast("bigint").alias("idx"))


_SCHEDULE = slices.epoch_schedule(DATA_SPLIT, EPOCHS, "compat")
_SQL_SCHED = "(values " + ", ".join(f"({e}, {b}, {en})" for e, b, en in _SCHEDULE) + ") as s(epoch, b, e)"


@query("slice_schedule",
       f"with c as (select {_SQL_SPLIT} as split, count(*) as n from documents group by 1) "
       f"select c.split, cast(c.n as bigint) as n_rows, s.epoch, s.b as begin_pct, s.e as end_pct, "
       f"cast(round_even(c.n * s.b / 100.0, 0) as bigint) as begin_row, "
       f"cast(round_even(c.n * s.e / 100.0, 0) as bigint) as end_row from c, {_SQL_SCHED}")
def q_slice_schedule(spark, sf_dir):
    counts = slices.split_counts(corpus(spark, sf_dir))
    return slices.schedule_frame(counts, slices.schedule_table(spark, DATA_SPLIT, EPOCHS, "compat"))


@query("slice_assign",
       _SQL_IDX + f" select ix.doc_id, ix.split, cast(ix.idx as bigint) as idx, s.epoch from ix join {_SQL_SCHED} "
       "on ix.idx >= round_even(ix.n * s.b / 100.0, 0) and ix.idx < round_even(ix.n * s.e / 100.0, 0) "
       "where ix.split = 'train'")
def q_slice_assign(spark, sf_dir):
    ix = _indexed_corpus(spark, sf_dir).where(F.col("split") == "train")
    ranges = slices.schedule_frame(slices.split_counts(ix), slices.schedule_table(spark, DATA_SPLIT, EPOCHS, "compat"))
    out = slices.assign_epochs(ix, ranges)
    return out.select("doc_id", "split", F.col("idx").cast("bigint").alias("idx"), "epoch")


@query("slice_assign_fine",
       _SQL_IDX + f", s as (select split, n, i + 1 as epoch, n * i // {FINE_SLICES} as b, n * (i + 1) // {FINE_SLICES} as e "
       f"from (select split, any_value(n) as n from ix group by split), (select unnest(range({FINE_SLICES})) as i)) "
       "select ix.doc_id, ix.split, cast(ix.idx as bigint) as idx, cast(s.epoch as integer) as epoch from ix join s "
       "on ix.split = s.split and ix.idx >= s.b and ix.idx < s.e")
def q_slice_assign_fine(spark, sf_dir):
    """Every split dealt out over a schedule of 100,000 row ranges."""
    ix = _indexed_corpus(spark, sf_dir)
    out = slices.assign_epochs(ix, slices.row_schedule(slices.split_counts(ix), FINE_SLICES))
    return out.select("doc_id", "split", F.col("idx").cast("bigint").alias("idx"), "epoch")
