import re
from collections import Counter

import pytest
from llm_fixtures import messy, no_docs  # noqa: F401
from oracle_compare import compare

from corpuslens.llm import collocations as C

SF = "/root/testdata/sf0.001"


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for r in rows:
        lang = r["lang"] or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = Counter()
    for p, a in candidates.items():
        if len(p) == 4:
            for part in (p[:3], (p[0], *p[2:])):
                longer[part] = max(longer[part], a)
    out = {}
    for p, a in candidates.items():
        if 100 * longer[p] >= 50 * a:
            continue
        cuts = [(f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, (left, right) = min((1_000_000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1))


def _query(docs, **options):
    return sorted(tuple(r) for r in C.collocations(docs, **options).collect())


def test_sql_agrees(spark):
    assert not compare(spark, C.op11_phrase_collocations, C.OP11_SQL, SF)


def _docs(spark):
    lines = ["the cat sat. the cat ran, THE dog sat on the mat", "a b a b a b a b; b a", "x", "the the the the", None, "", " \t \n.",
             "one two three " * 40, "é Ü é Ü é Ü!", "of the cat of the cat of the dog"]
    rows = [(i, lines[i % len(lines)], (None, "en", "fr", "und")[i * 7 % 4 if i % 3 else 1]) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


@pytest.mark.parametrize("setting", [{}, {"BLOCK_WORDS": 7}, {"PART_BYTES": 5, "BLOCK_WORDS": 11}, {"MERGE_ELEMENTS": 2, "BUCKET_WORDS": 50}, {"OUT_ROWS": 1}])
def test_blocks_and_parts_of_any_size_count_alike(spark, monkeypatch, setting):
    docs = _docs(spark)
    for name, value in setting.items():
        monkeypatch.setattr(C, name, value)
    assert _query(docs) == brute([r.asDict() for r in docs.collect()])


def test_divided_stripes_and_limits(spark, monkeypatch):
    docs = _docs(spark)
    frequent = C.frequent_words

    def finely(texts, parts):
        total, found = frequent(texts, 50)
        assert len(found) > 5  # so most stripes are divided
        return total, found

    monkeypatch.setattr(C, "frequent_words", finely)
    rows = [r.asDict() for r in docs.collect()]
    assert _query(docs) == brute(rows)
    assert _query(docs, least=2, top=3) == brute(rows, 2, 3)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_999_999_999_999
    df = spark.createDataFrame([(big, big, big), (big - 1, big, big), (3_000_000_000_000, big, big - 7)], "a long, l long, r long")
    got = [r[0] for r in df.select(C.score("l", "r")).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in
                   [(big, big, big), (big - 1, big, big), (3_000_000_000_000, big, big - 7)]]


def test_messy_rows(messy, no_docs):
    assert _query(messy, least=2) == brute([r.asDict() for r in messy.collect()], 2)
    assert _query(no_docs) == []
