"""DuckDB SQL fragments that mirror the column expressions, for oracles.

Each helper takes a SQL expression string and returns a SQL expression
string.  They exist only to write ``oracle_sql()`` statements; the engine
itself never runs SQL through them.
"""

from __future__ import annotations

import re

# The same patterns as functions.text / functions.segment,
# written for RE2 (no look-around; \\w spelled out; Latin range as code points).
WORD_RE = r"[A-Za-z\x{00C0}-\x{024F}]+"
SENT_RE = r"[^.!?\n]+[.!?]*"
TOKEN_RE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def plain(pattern: str) -> str:
    """A pattern without possessive marks, which RE2 has no need of."""
    return re.sub(r"(?<=[+*])\+|(?<=,\})\+", "", pattern)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def abstract(t: str) -> str:
    return strip(f"split_part({t}, chr(10), 1)")


def body(t: str) -> str:
    return (f"(case when strpos({t}, chr(10)) > 0 then "
            f"{strip(f'substr({t}, strpos({t}, chr(10)) + 1)')} else '' end)")


def sentences(t: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({t}, ''), '{SENT_RE}'), "
            f"lambda s: trim(s)), lambda s: s <> '')")


def words(t: str) -> str:
    return f"regexp_extract_all(lower(coalesce({t}, '')), '{WORD_RE}')"


def tokens(t: str) -> str:
    return f"regexp_extract_all(coalesce({t}, ''), '{TOKEN_RE}')"


def vowel_groups(t: str) -> str:
    return f"len(regexp_extract_all(lower(coalesce({t}, '')), '[aeiouy]+'))"


def all_sentences(t: str) -> str:
    return f"array_to_string({sentences(t)}, ' ')"


def ngrams(w: str, n: int) -> str:
    return (f"(case when len({w}) >= {n} then list_transform(range(0, len({w}) - {n} + 1), "
            f"lambda i: array_to_string(list_slice({w}, i + 1, i + {n}), ' ')) else [] end)")


def remove_brackets(t: str) -> str:
    return rf"regexp_replace({t}, '\([^()]*\)|\{{[^{{}}]*\}}|\[[^\[\]]*\]', '', 'g')"


def remove_cutoff(t: str) -> str:
    return rf"regexp_extract({t}, '(?s)^(.*\.|[^.]*$)', 1)"


def preprocess_ctes(source: str, keys: str, text_col: str, out: str = "cleaned") -> str:
    """CTE chain ``pp_a .. pp_f`` ending in ``pp_f(keys, {out})``.

    The eight-step clean-up; look-arounds are rewritten per character over a
    materialised character list (one split per row, not per character).
    ``keys`` is a comma-separated column list of ``source``.
    """
    return (
        rf"pp_a as (select {keys}, regexp_replace(regexp_replace(regexp_replace({text_col}, "
        rf"'\([^()]*\)', ' ', 'g'), '\{{[^{{}}]*\}}', ' ', 'g'), '\[[^\[\]]*\]', ' ', 'g') as t "
        rf"from {source}), "
        rf"pp_b as (select {keys}, string_split(regexp_replace(t, '\s*([^\p{{L}}\p{{N}}_\s])\s*', "
        rf"'\1', 'g'), '') as l from pp_a), "
        rf"pp_c as (select {keys}, array_to_string(list_transform(l, lambda x, i: "
        rf"case when x in ('.', '!', '?') and not regexp_matches(coalesce(l[i - 1], ''), '\d') "
        rf"and regexp_matches(coalesce(l[i + 1], ''), '[^\d\s]') then x || ' ' else x end), '') as t "
        rf"from pp_b), "
        rf"pp_f as (select {keys}, regexp_replace(regexp_replace(regexp_replace(t, '([,;:%])', '\1 ', 'g'), "
        rf"'\s+', ' ', 'g'), '^ | $', '', 'g') as {out} from pp_c)"
    )


def r6(x: str) -> str:
    return f"round(cast({x} as double), 6)"


def row_mean(cols: list[str]) -> str:
    s = " + ".join(f"coalesce({c}, 0)" for c in cols)
    n = " + ".join(f"(case when {c} is null then 0 else 1 end)" for c in cols)
    return f"(case when ({n}) = 0 then null else ({s}) / ({n}) end)"
