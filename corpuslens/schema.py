"""Table schemas and the fixed metric vocabulary of evaluation tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten report metrics in report order, the metrics where a
# lower value is better, and the three metric categories.
METRICS = ["ROUGE", "BLEU", "METEOR", "BERTScore", "FKGL", "DCRS", "CLI", "LENS",
           "AlignScore", "SummaC"]
LOWER_IS_BETTER = ["FKGL", "DCRS", "CLI"]
RELEVANCE = ["ROUGE", "BLEU", "METEOR", "BERTScore"]
READABILITY = ["FKGL", "DCRS", "CLI", "LENS"]
FACTUALITY = ["AlignScore", "SummaC"]

# Ranking column order of the report ranking.
RANKING_COLUMNS = ["model", "ROUGE", "BLEU", "METEOR", "BERTScore", "relevance",
                   "FKGL", "DCRS", "CLI", "LENS", "readability",
                   "AlignScore", "SummaC", "factuality", "score"]

# Leaderboard CSV header and its score columns.
LEADERBOARD_COLUMNS = ["#", "Participant", "Entries", "Date", "ID", "Select Task",
                       "Team Name", "ROUGE", "BLEU", "METEOR", "BERTScore", "FKGL",
                       "DCRS", "CLI", "LENS(Task1)", "AlignScore(Task1)",
                       "SummaC(Task1)", "Similarity(Task2)", "F1chexbert(Task2)",
                       "Radgraph(Task2)"]
LEADERBOARD_SCORES = ["ROUGE", "BLEU", "METEOR", "BERTScore", "FKGL", "DCRS", "CLI",
                      "LENS(Task1)", "AlignScore(Task1)", "SummaC(Task1)"]
LEADERBOARD_RELEVANCE = ["ROUGE", "BLEU", "METEOR", "BERTScore"]
LEADERBOARD_READABILITY = ["FKGL", "DCRS", "CLI", "LENS(Task1)"]
LEADERBOARD_FACTUALITY = ["AlignScore(Task1)", "SummaC(Task1)"]
LEADERBOARD_TASK = "SubTask 1.1"

METRIC_SCHEMA = T.StructType([T.StructField(m, T.DoubleType(), True) for m in METRICS])

REPORT_SCHEMA = T.StructType([T.StructField("model", T.StringType(), True)]
                             + list(METRIC_SCHEMA.fields))

_LB_TYPES = {"#": T.LongType(), "Entries": T.LongType(), "ID": T.LongType()}
LEADERBOARD_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c in LEADERBOARD_SCORES or c.endswith("(Task2)")
                  else _LB_TYPES.get(c, T.StringType()), True)
    for c in LEADERBOARD_COLUMNS
])

CORPUS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("dataset", T.StringType(), True),
    T.StructField("split", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("article", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
])
