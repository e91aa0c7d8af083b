"""Output sinks: generation results by file type, one-summary-per-line text
and the ordered ranking report.

Every writer is a Spark writer (one task per partition, atomic job commit);
nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVAL_PAIR_COLUMNS = ["generated_caption", "reference", "document"]


def write_text_lines(df: DataFrame, col: str, path: str) -> None:
    """One value per line.  Embedded newlines would split a record, so they
    are replaced by a space (a deliberate change from writing raw text)."""
    df.select(F.regexp_replace(F.coalesce(F.col(col), F.lit("")), r"\r?\n", " ").alias("value")) \
        .write.mode("overwrite").text(path)


def save_outputs(df: DataFrame, path: str, summary_col: str = "generated_caption",
                 keys: Sequence[str] = ()) -> None:
    """Save generation results by the target's extension, in any case.

    ``.jsonl``: JSON lines of ``keys`` and (generated_caption, reference,
    document); ``.txt``: one summary per line.  Any other extension raises.
    So does a result without rows, found from what was written: the model
    runs once.
    """
    kind = path.lower().rpartition(".")[2]
    if kind == "jsonl":
        df.select(*keys, *EVAL_PAIR_COLUMNS).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif kind == "txt":
        write_text_lines(df, summary_col, path)
    else:
        raise ValueError(f"unsupported output extension: {path!r} (use .jsonl or .txt)")
    if df.sparkSession.read.text(path).isEmpty():
        raise ValueError(f"the result holds no row: {path!r}")


def save_submission(df: DataFrame, path: str, group_col: str, *, compression: str = "gzip") -> None:
    """Tab-separated files without header, a folder for each group."""
    (df.write.mode("overwrite").partitionBy(group_col)
     .option("sep", "\t").option("header", False).option("compression", compression)
     .option("quote", '"').option("escape", '"').option("emptyValue", '""').csv(path))


def read_submission(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("sep", "\t").option("header", False)
            .option("quote", '"').option("escape", '"').option("multiLine", True).csv(path))


def write_variants(df: DataFrame, path: str, text_cols: Sequence[str], partition_col: str) -> None:
    """One write of all variants, a folder for each.

    A row's texts lie side by side, as a map by column name, so that Parquet
    compresses them together: what one text repeats of another costs little.
    """
    texts = F.create_map(*[x for c in text_cols for x in (F.lit(c), F.col(c))])
    rest = [c for c in df.columns if c not in text_cols]
    (df.select(*rest, texts.alias("texts")).write.mode("overwrite").partitionBy(partition_col)
     .option("compression", "zstd").parquet(path))


def read_variants(spark: SparkSession, path: str, text_cols: Sequence[str]) -> DataFrame:
    """What ``write_variants`` wrote, with a column for each text again."""
    back = spark.read.parquet(path)
    return back.select(*[c for c in back.columns if c != "texts"], *[F.col("texts").getItem(c).alias(c) for c in text_cols])


def write_ranking_report(ranked: DataFrame, path: str, order_col: str = "score",
                         tie_col: str = "model") -> None:
    """The ranking as CSV, in order within and over its part files."""
    (ranked.orderBy(F.col(order_col).desc_nulls_last(), F.col(tie_col))
     .write.mode("overwrite").option("header", True).csv(path))
