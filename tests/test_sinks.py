"""Sinks: extension choice, text lines, ranking report, cached variants."""

import os
import random
import tempfile
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuslens.sources import sinks


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([("a\nb", "r1", "d1"), ("c", "r2", "d2")],
                                 "generated_caption string, reference string, document string")


def test_save_by_extension(spark, pairs):
    d = tempfile.mkdtemp(prefix="sink-")
    sinks.save_outputs(pairs, os.path.join(d, "out.jsonl"))
    assert spark.read.json(os.path.join(d, "out.jsonl")).count() == 2
    sinks.save_outputs(pairs, os.path.join(d, "out.TXT"))
    os.rename(os.path.join(d, "out.TXT"), os.path.join(d, "out.txt"))
    lines = sorted(r.value for r in spark.read.text(os.path.join(d, "out.txt")).collect())
    assert lines == ["a b", "c"]
    with pytest.raises(ValueError):
        sinks.save_outputs(pairs, os.path.join(d, "out.json"))
    with pytest.raises(ValueError):
        sinks.save_outputs(pairs.where("false"), os.path.join(d, "empty.jsonl"))


def test_ranking_report_is_ordered(spark):
    d = tempfile.mkdtemp(prefix="rank-") + "/r"
    df = spark.createDataFrame([("b", 0.2), ("a", 0.9), ("c", None), ("d", 0.2)], "model string, score double")
    sinks.write_ranking_report(df, d)
    got = [r.model for r in spark.read.option("header", True).csv(d).collect()]
    assert got == ["a", "b", "d", "c"]


def test_variants_keep_their_rows_and_repeated_text_costs_little(spark):
    rng = random.Random(1)
    texts = ["\n".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=60)) for _ in range(20)) for _ in range(50)]
    rows = [(i % 49, t, t[:60], n, "\n".join(t.split("\n")[::-1][:n])) for i, t in enumerate(texts) for n in (10, 20)]
    rows += [(None, None, "s", 10, None), (99, "a", None, 20, "")]
    long = spark.createDataFrame(rows, "doc_id long, article string, summary string, n_sentences int, transformed string").coalesce(1)
    d = tempfile.mkdtemp(prefix="variants-")
    sinks.write_variants(long, f"{d}/v", ["article", "summary", "transformed"], "n_sentences")
    back = sinks.read_variants(spark, f"{d}/v", ["article", "summary", "transformed"]).select(*long.columns)
    assert Counter(map(tuple, back.collect())) == Counter(rows)
    assert {p.name for p in Path(d, "v").glob("n_*")} == {"n_sentences=10", "n_sentences=20"}
    # the articles, twice, are most of it; texts taken from them add little
    size = sum(p.stat().st_size for p in Path(d, "v").rglob("*.parquet"))
    long.select("n_sentences", "article").write.option("compression", "zstd").parquet(f"{d}/a")
    alone = sum(p.stat().st_size for p in Path(d, "a").rglob("*.parquet"))
    assert size < 2.5 * alone and size < 0.8 * sum(len(x or "") for r in rows for x in (r[1], r[2], r[4]))


def test_the_fan_out_takes_less_room_than_its_articles(spark, monkeypatch):
    from corpuslens.plans import extract

    d = tempfile.mkdtemp(prefix="fanout-")
    monkeypatch.setattr(extract, "scratch_dir", lambda spark, name: f"{d}/{name}")
    rows = extract.q_extract_fanout(spark, "/root/testdata/sf0.001")
    articles = rows.agg(F.sum(F.octet_length("article"))).first()[0]
    assert sum(p.stat().st_size for p in Path(d, "extract-fanout").rglob("*.parquet")) < 0.45 * articles
