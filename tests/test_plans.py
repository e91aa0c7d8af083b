"""Physical-plan properties of representative queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL_SF
from corpuslens.sources.tables import corpus, read_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dataset_filter_and_pruning_reach_scan(spark):
    df = corpus(spark, SMALL_SF, dataset="en").select("doc_id", "summary")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


@pytest.mark.parametrize("key", ["eval_report", "word_frequencies", "box_stats", "readability_hist",
                                 "embedding_cosine_topk", "text_stats", "extract_wide"])
def test_no_cartesian_or_nested_loop(spark, key):
    plan = _plan(E.queries()[key](spark, SMALL_SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["preprocess_text", "text_stats", "readability", "split_sentences",
                                 "chat_render", "instruction_prompt_train"])
def test_no_python_in_expression_queries(spark, key):
    plan = _plan(E.queries()[key](spark, SMALL_SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_word_frequencies_is_distributed_top_k(spark):
    plan = _plan(E.queries()["word_frequencies"](spark, SMALL_SF))
    assert "TakeOrderedAndProject" in plan


def test_four_lengths_share_one_ranking(spark):
    plan = _plan(E.queries()["extract_wide"](spark, SMALL_SF))
    assert plan.count("sort_array(") == 1      # one ranking, sorted inside each document row
    assert "Window" not in plan
    assert plan.count("ArrowEvalPython") == 1  # cosines and word graph in one pass over the rows


def test_overlap_and_generation_shuffle_nothing(spark):
    from corpuslens.operators import generate, overlap

    pairs = spark.createDataFrame([(1, "a b c", "a b d")], "pid long, g string, r string")
    assert "Exchange" not in _plan(overlap.ngram_overlap(pairs, "pid", "g", "r", (1, 2, 3, 4)))
    docs = read_table(spark, SMALL_SF, "documents").select("doc_id", F.col("text").alias("prompt"))
    assert "Exchange" not in _plan(generate.generate(docs, generate.body_model()))


def test_extraction_leaves_no_table_behind(spark):
    E.queries()["extract_wide"](spark, SMALL_SF).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("corpuslens")]


@pytest.mark.parametrize(("master", "local"), [("local", True), ("local[8]", True), ("local-cluster[2,1,1024]", False),
                                               ("yarn", False), ("spark://h:7077", False)])
def test_private_scratch_folder_is_for_one_process_only(master, local):
    from corpuslens.session import is_local
    assert is_local(master) is local
