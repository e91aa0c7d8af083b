"""Golden rankings computed from the committed evaluation reports.

Expected values were derived independently from the report data with the
"""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from corpuslens import schema
from corpuslens.operators import normalize, rank
from corpuslens.plans.evaltables import leaderboard_ranking
from corpuslens.plans.evaluation import rank_report
from corpuslens.sources import reports

ELIFE = os.path.join(FIXTURES, "reports", "elife")

# Display names the notebook uses for the extractive runs.
NOTEBOOK_MODEL_NAMES = {
    "extractive_elife_train_BioBERT": "BioBERT",
    "extractive_elife_train_pubmedbert-base": "PubMedBERT",
    "extractive_elife_train_MedEmbed-large": "MedEmbed",
    "extractive_elife_train_S-PubMedBert-MS-MARCO": "PubMedBERT-MS-Marco",
    "extractive_elife_train_medical-term-similarity": "Medical-MiniLM-L6",
}


def test_report_scan_keys_and_values(spark):
    df = reports.read_eval_reports(spark, ELIFE)
    assert df.count() == 48
    row = df.where(F.col("model") == "finetuned_elife_validation_fulltext").first()
    assert row.ROUGE == pytest.approx(0.3851198885080967)
    assert row.LENS == pytest.approx(78.67031665806981)


def test_report_ranking_golden(spark):
    ranked = rank_report(reports.read_eval_reports(spark, ELIFE)).collect()
    top = [(r.model, round(r.relevance, 6), round(r.readability, 6), round(r.factuality, 6), round(r.score, 6))
           for r in ranked]
    assert top[0] == ("finetuned_elife_validation_fulltext", 0.954173, 0.935548, 0.382233, 0.757318)
    assert top[1] == ("finetuned_elife_validation_BioBERT_40_epoch_2", 0.906905, 0.958134, 0.361242, 0.742094)
    assert top[2] == ("finetuned_elife_validation_BioBERT_40_epoch_1", 0.913789, 0.936353, 0.362017, 0.737386)
    assert top[3] == ("finetuned_elife_validation_BioBERT_20_epoch_1", 0.861062, 0.965634, 0.352482, 0.726393)
    assert top[-1] == ("extractive_zero-shot_elife_validation_BioBERT_20_preprocessed",
                       0.461705, 0.610961, 0.072295, 0.381654)
    assert [c for c in ranked[0].asDict()] == schema.RANKING_COLUMNS


def test_notebook_ranking_golden(spark):
    df = reports.read_eval_reports(spark, ELIFE, prefix="extractive_elife_train")
    model, count = reports.parse_run_name(F.col("model"))
    mapping = F.create_map(*[F.lit(x) for kv in NOTEBOOK_MODEL_NAMES.items() for x in kv])
    named = df.select(F.try_element_at(mapping, model).alias("model"), count.alias("count"), *schema.METRICS)
    assert named.count() == 17
    norm = normalize.minmax_normalize(named, schema.METRICS, schema.LOWER_IS_BETTER, "half")
    scored = rank.sort_by_score(normalize.category_means(
        norm, ("avg_relevance", "avg_readability", "avg_factuality", "score")), "score").collect()
    got = [(r.model, r["count"], round(r.avg_relevance, 6), round(r.avg_readability, 6),
            round(r.avg_factuality, 6), round(r.score, 6)) for r in scored[:4]]
    assert got == [("BioBERT", 40, 0.441654, 0.781009, 0.7964, 0.673021),
                   ("BioBERT", 10, 0.75, 0.239267, 0.995003, 0.661423),
                   ("Medical-MiniLM-L6", 40, 0.371797, 0.803193, 0.652733, 0.609241),
                   ("MedEmbed", 40, 0.330728, 0.833755, 0.627904, 0.597462)]


def test_run_name_parsing(spark):
    df = spark.createDataFrame([("a_b_10",), ("x_10_10",), ("plain",)], "n string")
    model, count = reports.parse_run_name(F.col("n"))
    got = [(r.m, r.c) for r in df.select(model.alias("m"), count.alias("c")).collect()]
    assert got == [("a_b", 10), ("x", 10), ("plain", None)]


def test_empty_leaderboard_with_bom(spark):
    board = reports.read_leaderboard(spark, os.path.join(FIXTURES, "leaderboard", "leaderboard.csv"))
    assert board.columns == schema.LEADERBOARD_COLUMNS
    assert board.where(F.col("`Participant`").isNotNull()).count() == 0
    assert leaderboard_ranking(board).count() == 0


def test_pretty_printed_stem_layout_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="reports-")
    with open(os.path.join(d, "run_a_10.json"), "w") as f:
        f.write('{\n  "ROUGE": 0.5,\n  "FKGL": 9.0\n}')
    with open(os.path.join(d, "other.json"), "w") as f:
        f.write('{"ROUGE": 0.1}')
    got = reports.read_eval_reports(spark, d, prefix="run_").collect()
    assert [(r.model, r.ROUGE, r.FKGL, r.BLEU) for r in got] == [("run_a_10", 0.5, 9.0, None)]
