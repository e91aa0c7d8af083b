import numpy as np
import pytest

from corpuslens.operators import extract, latent, vectors
from corpuslens.plans import dense
from corpuslens.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _cells(spark, a):
    i, j = np.nonzero(a)
    return spark.createDataFrame([(int(x), f"t{y}", float(a[x, y])) for x, y in zip(i, j)], "k long, term string, w double").repartition(4)


def _loaded(encoder, terms):
    v = np.zeros((terms, len(encoder[0].vector)))
    for r in encoder:
        v[int(r.term[1:])] = r.vector
    return v


def test_the_subspace_is_that_of_a_full_svd(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(80, 6)) * [9, 8, 7, 6, 5, 4] @ np.linalg.qr(rng.normal(size=(50, 6)))[0].T
    a += 0.02 * rng.normal(size=a.shape)
    encoder, values = latent.fit(_cells(spark, a), "k", 6, 6, 1)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    v = _loaded(encoder.collect(), 50)
    assert np.allclose(values, s[:6], rtol=1e-3)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-9)
    # cosines of the angles between the subspaces
    assert np.linalg.svd(vt[:6] @ v, compute_uv=False).min() > 0.9999
    got = latent.text_vectors(_cells(spark, a), ["k"], encoder, 6).collect()
    for r in got:
        assert np.linalg.norm(r.vector) == pytest.approx(np.linalg.norm(a[r.k] @ vt[:6].T), rel=1e-3)


def test_power_steps_bring_the_sketch_nearer(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(70, 60)) * np.linspace(2, 0.5, 60)
    best = np.sqrt((np.linalg.svd(a, compute_uv=False)[:5] ** 2).sum())
    kept = [np.sqrt((latent.fit(_cells(spark, a), "k", 5, 3, steps)[1] ** 2).sum()) for steps in (0, 3)]
    assert kept[0] < kept[1] <= best * (1 + 1e-9) and kept[1] > 0.97 * best


def test_low_rank_empty_and_unknown_terms(spark):
    a = np.outer([1.0, 2, 3, 0], [1.0, 0, 2])
    encoder, values = latent.fit(_cells(spark, a), "k", 3, 2, 1)
    assert len(values) == 1 and values[0] == pytest.approx(np.linalg.norm(a))
    other = spark.createDataFrame([(1, "t0", 1.0), (2, "unknown", 1.0)], "k long, term string, w double")
    assert [r.k for r in latent.text_vectors(other, ["k"], encoder, 1).collect()] == [1]
    none, values = latent.fit(other.limit(0), "k")
    assert none.collect() == [] and len(values) == 0
    assert latent.text_vectors(other, ["k"], none, 0).collect() == []
    with pytest.raises(ValueError):
        latent.fit(other, "k", 65, 0)


def test_sentence_cosines_equal_numpy_on_the_same_encoder(spark):
    docs, cells, encoder, values = dense._trained(spark, SF)
    enc = {r.term: np.array(r.vector) for r in encoder.collect()}
    v = np.stack([enc[t] for t in sorted(enc)])
    assert np.allclose(v.T @ v, np.eye(len(values)), atol=1e-8)
    idf = {r.term: r.idf for r in cells.select("term", "idf").distinct().collect()}
    texts = {r.doc_id: r for r in extract.sentence_rows(docs, "doc_id", "text").where("doc_id = 3").collect()}
    assert texts
    whole = sum(r.w * enc[r.term] for r in cells.where("doc_id = 3").collect())
    got = {r.pos: r.cosine for r in dense.q_dense_sentence_cosine(spark, SF).where("doc_id = 3").collect()}
    tf = vectors.term_counts(extract.sentence_rows(docs, "doc_id", "text").where("doc_id = 3"), ["pos"], "sentence").collect()
    for pos in got:
        x = sum(r.tf * idf[r.term] * enc[r.term] for r in tf if r.pos == pos)
        want = x @ whole / np.linalg.norm(x) / np.linalg.norm(whole)
        assert got[pos] == pytest.approx(want, abs=2e-6)
    assert len(got) > 1
    assert dense.q_dense_document_vectors(spark, SF).where("kept > 1.000001").count() == 0
    assert read_table(spark, SF, "documents").count() >= dense.q_dense_document_vectors(spark, SF).count() > 0


def test_centroids_of_ragged_and_null_vectors(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, None, 5.0]), ("b", None), ("b", [7.0]), (None, [1.0]), (None, [2.0]), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v array<float>").repartition(3)
    got = {r.g: r.centroid for r in vectors.group_centroids(df, "g", "v").collect()}
    assert got["a"] == [2.0, 2.0, 5.0] and got["b"] == [7.0] and got[None] == [1.5]


def test_rare_terms_are_joined_and_frequent_ones_sent(spark, monkeypatch):
    """Which terms are frequent changes where a product is taken, not its result;
    cells of frequent terms are not shuffled for a text's vector."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(40, 9)) * (rng.random((40, 9)) < 0.6) * np.linspace(3, 1, 9)
    cells, rows = _cells(spark, a).coalesce(2), []
    for frequent in ([], ["t1", "t4", "nowhere"], [f"t{i}" for i in range(9)]):
        encoder, values = latent.fit(cells, "k", 9, 9, 1, frequent)
        assert np.allclose(values, np.linalg.svd(a, compute_uv=False))
        vec = latent.text_vectors(cells, ["k"], encoder, len(values), frequent)
        rows.append({r.k: np.linalg.norm(r.vector) for r in vec.collect()})
        assert rows[-1] == pytest.approx({i: np.linalg.norm(x) for i, x in enumerate(a) if x.any()})
    docs = spark.createDataFrame([(1, "b a a c"), (1, "a d"), (2, "a É é"), (None, "c"), (3, None)], "doc_id long, text string")
    want = {(r.doc_id, r.term): (r.tf, r.w) for r in extract.document_terms(docs, "doc_id", "text").collect()}
    assert {k: v[0] for k, v in want.items()} == {(1, "a"): 3, (1, "b"): 1, (1, "c"): 1, (1, "d"): 1, (2, "a"): 1, (2, "é"): 2,
                                                  (None, "c"): 1}
    monkeypatch.setattr(vectors, "FREQUENT", 2)
    assert {(r.doc_id, r.term): (r.tf, r.w) for r in extract.document_terms(docs, "doc_id", "text").collect()} == want


def test_a_batch_without_frequent_terms_has_sums_of_the_same_kind(spark):
    """Rows of rare terms only come first, some thousand of them, then one of a frequent term."""
    rows = [(i, f"r{i}", 2.0) for i in range(3000)] + [(3000, "often", 3.0)]
    cells = spark.createDataFrame(rows, "k long, term string, w double").coalesce(1)
    encoder = spark.createDataFrame([(t, [1.0, 0.5]) for t in ("often", "r0", "r2999")], "term string, vector array<double>")
    got = {r.k: r.vector for r in latent.text_vectors(cells, ["k"], encoder, 2, ["often"]).collect()}
    assert got == {3000: [3.0, 1.5], 0: [2.0, 1.0], 2999: [2.0, 1.0]}


def test_texts_without_rare_terms_are_not_shuffled(spark, monkeypatch):
    """Cells of a text stay in one pack, however few a worker packs together."""
    monkeypatch.setattr(latent, "CELLS_AT_ONCE", 3)
    rows = [(i, f"t{j}", float(i + j + 1)) for i in range(40) for j in range(9 if i % 7 == 0 else 2)]
    cells = spark.createDataFrame(rows, "k long, term string, w double").coalesce(1)
    encoder = spark.createDataFrame([(f"t{j}", [1.0 + j, float(j * j)]) for j in range(8)], "term string, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        packs = latent._packed(cells, ["k"], ["t0", "t1"])
        assert packs.count() == 40
        want = {r.k: r.vector for r in latent.text_vectors(cells, ["k"], encoder, 2, ["t0", "t1"]).collect()}
        got = {r.k: r.vector for r in latent.text_vectors(cells, ["k"], encoder, 2, ["t0", "t1"], True).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(got) == 40 and got[1] == [2.0 * 1 + 3.0 * 2, 3.0 * 1]


def test_idf_is_looked_up_where_terms_are_counted(spark):
    docs = spark.createDataFrame([(1, "b a a c"), (1, "a d"), (2, "a É é"), (None, "c"), (3, None)], "doc_id long, text string")
    idf = vectors.idf_table(docs, "doc_id", "text")
    sent, every = vectors.sent_idf(idf)
    rows = vectors.document_weights(docs, "doc_id", "text", idf, sent, every).select("doc_id", "term", "tf", "idf").collect()
    other = vectors.document_weights(docs, "doc_id", "text", idf, sent, False).select("doc_id", "term", "tf", "idf").collect()
    assert every and sorted(map(str, rows)) == sorted(map(str, other)) and len(rows) == 7
