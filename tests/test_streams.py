"""Streams over a table that is one file or a folder of part files."""

import os
import tempfile

import pytest

from corpuslens.plans import stream_vectors as S


@pytest.fixture(params=["folder", "file"])
def sf(request, spark):
    base = tempfile.mkdtemp(prefix="run-streams-")
    rows = [(1, "Lead line.\nOne here. Two (gone) here.", "en"), (2, None, "fr"), (None, "Only", "en"), (4, "a\nb", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if request.param == "folder":
        docs.repartition(3).write.parquet(f"{base}/documents.parquet")
    else:
        docs.coalesce(1).write.parquet(f"{base}/parts")
        part = next(f for f in os.listdir(f"{base}/parts") if f.endswith(".parquet"))
        os.link(f"{base}/parts/{part}", f"{base}/documents.parquet")
    return base


def test_every_row_goes_through_the_cleaning_stream(spark, sf):
    got = {r.doc_id: (r.cleaned, r.post) for r in S.q_stream_clean(spark, sf).collect()}
    assert set(got) == {1, 2, None, 4} and got[2] == (None, None)
    assert got[1] == ("Lead line. One here. Two here.", "Lead line.\nOne here. Two  here.")


def test_every_row_goes_through_generation_once(spark, sf):
    got = sorted((r.doc_id or 0, r.summary) for r in S.q_stream_generate(spark, sf).collect())
    assert got == [(0, ""), (1, "One here. Two (gone) here."), (2, ""), (4, "b")]
