"""Evaluation report sources and sinks: JSON report folders, leaderboard CSV,
inline JSON records.

A report is one JSON object of metric -> value.  The reference layout is a
folder of ``<run name>.json`` files, one (often pretty-printed) object each;
Spark's own JSON writer produces ``<col>=<value>/part-*.json`` folders.  The
reader accepts both: the row key comes from the file stem or from the
partition folder name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens import schema


def read_eval_reports(spark: SparkSession, path: str, prefix: str | None = None,
                      key: str = "stem", metric_schema: T.StructType = schema.METRIC_SCHEMA,
                      key_col: str = "model") -> DataFrame:
    """Folder of one-object JSON reports -> (key_col, metrics...).

    key="stem": the key is the file name without ``.json`` (flat folder).
    key="dir":  the key is the parent folder name without a ``name=`` prefix
                (Spark ``partitionBy`` layout; files are searched recursively).
    ``prefix`` keeps only keys starting with it (a pushed-down path filter
    would need a glob, which cannot express "starts with" on the stem alone).
    """
    reader = (spark.read.schema(metric_schema).option("multiLine", True)
              .option("pathGlobFilter", "*.json"))
    if key == "dir":
        reader = reader.option("recursiveFileLookup", True)
    df = reader.json(path)
    if key == "stem":
        k = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    elif key == "dir":
        k = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:[^/=]+=)?([^/]+)/[^/]+$", 1)
        k = F.url_decode(k)
    else:
        raise ValueError("key must be 'stem' or 'dir'")
    out = df.select(k.alias(key_col), *[F.col(f.name) for f in metric_schema.fields])
    if prefix is not None:
        out = out.where(F.col(key_col).startswith(prefix))
    return out


def parse_run_name(name: Column) -> tuple[Column, Column]:
    """``<model>_<count>`` -> (model, count).

    count = the text after the last ``_`` as int (null if not a number);
    model = the name with every ``_<count>`` occurrence removed.
    """
    count = F.substring_index(name, "_", -1).try_cast("int")
    model = F.replace(name, F.concat(F.lit("_"), count.cast("string")))
    return F.when(count.isNotNull(), model).otherwise(name), count


def write_reports_json(report: DataFrame, path: str, key_col: str = "model") -> None:
    """One folder per key, each holding that key's report object."""
    report.repartition(key_col).write.mode("overwrite").partitionBy(key_col).json(path)


def write_reports_flat(report: DataFrame, path: str, key_col: str = "model") -> None:
    """One file ``<key>.json`` per report in one folder.

    Spark writes the reports; their files, one per model, then get the names
    this layout asks for.  Keys are names, so they hold no ``/``."""
    spark = report.sparkSession
    staged = f"{path.rstrip('/')}/_staged"
    write_reports_json(report, staged, key_col)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to_path = jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(conf)
    names = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(staged)
    key = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"/[^/=]+=([^/]+)/[^/]+$", 1))
    for row in names.select(key.alias("key"), F.col("_metadata.file_path").alias("file")).distinct().toLocalIterator():
        fs.rename(to_path(jvm.java.net.URI(row.file)), to_path(path, f"{row.key}.json"))


def write_leaderboard_csv(board: DataFrame, path: str) -> None:
    board.write.mode("overwrite").option("header", True).csv(path)


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """Leaderboard CSV with its fixed header; a UTF-8 BOM is ignored."""
    return (spark.read.schema(schema.LEADERBOARD_SCHEMA).option("header", True)
            .option("encoding", "UTF-8").csv(path))


def parse_records(col, metric_schema: T.StructType = schema.METRIC_SCHEMA,
                  single_quotes: bool = True) -> Column:
    """Parse a JSON (or Python-dict style, single-quoted) object string."""
    c = F.col(col) if isinstance(col, str) else col
    opts = {"allowSingleQuotes": "true"} if single_quotes else {}
    return F.from_json(c, metric_schema, opts)
