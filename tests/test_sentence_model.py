import re
from collections import Counter

import pytest

from corpuslens.operators import sentence_model as M

NAMES = ["Smith", "Jones", "Brown", "White", "Green", "Black", "Stone", "Young"]
VERBS = ["walks", "reads", "sleeps", "waits", "sings", "works", "writes", "talks"]
PLACES = ["home", "town", "school", "church", "market", "river", "garden", "office"]


@pytest.fixture(scope="module")
def learned(spark):
    """Abbreviations before names and numbers, many plain sentences, and The
    as the usual first word."""
    texts = []
    for i in range(240):
        n, v, p = NAMES[i % 8], VERBS[i // 8 % 8], PLACES[i // 3 % 8]
        texts.append(f"The man {v} near the {p}. The woman {v} at {p}. Today dr. {n} {v} in the {p}, cf. page {i}. "
                     f"The price is 3.{i} and the old {p} is old. They say e.g. {n.lower()} {v}! The {p} is {i}. The end is near.")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known, starters = M.learned_lists(docs, "doc_id", "text")
    return known, starters


def _cut(spark, learned, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = M.split_learned(docs, "doc_id", "text", *learned).select("doc_id", "sentences").collect()
    return [r.sentences for r in sorted(rows)]


def test_lists_are_learned(learned):
    known = {r.base for r in learned[0].collect()}
    assert {"dr", "cf", "e.g"} <= known
    assert not known & {*PLACES, *(v for v in VERBS), "near", "old"}
    assert "the" in {r.word for r in learned[1].collect()}


def test_abbreviations_and_decimals_do_not_cut(spark, learned):
    got = _cut(spark, learned, "Dr. Smith paid 3.14 euros. He left.", "See cf. page 2. The rest, e.g. this, is old! Why? (Yes.) It is.",
               'He met J. Brown at home. "The end." She left')
    assert got == [["Dr. Smith paid 3.14 euros.", "He left."],
                   ["See cf. page 2.", "The rest, e.g. this, is old!", "Why?", "(Yes.)", "It is."],
                   ["He met J. Brown at home.", '"The end."', "She left"]]


def test_an_abbreviation_may_end_a_sentence_before_a_starter(spark, learned):
    assert _cut(spark, learned, "He saw the dr. The man sleeps.") == [["He saw the dr.", "The man sleeps."]]


def test_line_breaks_numbers_and_blank_texts(spark, learned):
    got = _cut(spark, learned, "one two\nthree  four\t five", "There are 12. Then 5. apples", None, "", " \n \n")
    assert got == [["one two", "three four five"], ["There are 12.", "Then 5. apples"], [], [], []]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "no period here"), (2, None)], "doc_id long, text string")
    known, starters = M.learned_lists(docs, "doc_id", "text")
    assert known.collect() == [] and starters.collect() == []
    assert _cut(spark, (known, starters), "Ab bc. Cd de.") == [["Ab bc.", "Cd de."]]
    empty = docs.limit(0)
    assert M.learned_lists(empty, "doc_id", "text")[0].collect() == []


def test_texts_are_not_shuffled_for_the_statistics(spark):
    docs = spark.createDataFrame([(1, "a b. C d.")], "doc_id long, text string")
    rows = M.token_rows(docs, "doc_id", "text")
    plan = rows.groupBy("base").count()._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange"):]
    assert "partial_count" in exchange


ODD = ["Dr. Σοφός ΟΔΟΣ. “Quote.” (Ende.) 'ΟΔΟΣ'. İstanbul. a.b.c. U.S. x! y?) z.\u2028 w,\u2028 q!\x85 3.\u2028 12. Then é. É.  b.",
       "one.\n\nTwo..\tthree . . ... ,;: (\"') !? dr.\r\nEnd.\x0bnext\x0cpage 𝒜. 𐐀𐐁. x", "dr. dr. Smith! the The\n", " \n", "", None, "last."]


def test_counts_of_one_pass_equal_those_of_token_rows(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(ODD * 3)), "doc_id long, text string").repartition(2)
    rows = M.token_rows(docs, "doc_id", "text").collect()
    word = re.compile(r"[^\W\d_]+(\.[^\W\d_]+)*[\x85\u2028\u2029]?")
    is_word = lambda x: x is not None and bool(word.fullmatch(x))
    core = {r.token: r.core for r in rows}
    want, sure = Counter(), Counter()
    for r in rows:
        if is_word(r.base):
            want[r.base, r.dotted] += 1
        if re.search(r"[!?][\x85\u2028\u2029]?\Z", r.token) or r.dotted and is_word(r.base):
            following = core.get(r.next)
            sure[r.base if r.dotted and is_word(r.base) else None, following if is_word(following) else None] += 1
    monkeypatch.setattr(M, "token_rows", None)
    monkeypatch.setattr(M, "TEXT_AT_ONCE", 40)
    got, pairs = Counter(), Counter()
    for r in M.token_counts(docs, "doc_id", "text").collect():
        got += Counter({(r.base, True): r.n_dotted, (r.base, False): r.n_plain})
        pairs += Counter({(r.base, r.word): r.n_sure})
    assert got == want and pairs == sure
    assert M.learned_lists(docs, "doc_id", "text")[0].count() >= 0


def test_lists_too_long_to_be_sent_are_joined(spark, learned, monkeypatch):
    texts = [*ODD, "Dr. Smith paid. See cf. page 2. The rest, e.g. this, is old! He saw the dr. The man sleeps."]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[-1]), (7, "See cf. page 3. The dr. The end.")], "doc_id long, text string")

    def cut():
        return sorted(map(str, M.split_learned(docs, "doc_id", "text", *learned).select("doc_id", "text", "sentences").collect()))

    sent = cut()
    monkeypatch.setattr(M, "LIST_BYTES", 0)
    assert cut() == sent
    # the lists belong to rows with a key
    assert any("'See cf. page 2.'" in r for r in sent) and any("doc_id=None" in r and "'See cf.'" in r for r in sent)
