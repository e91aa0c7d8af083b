"""Text cleaning expressions (Column -> Column), all JVM-side regexes.

Each function returns a ``Column`` so callers compose them inside one
``select``; nothing here runs Python per row.  ``(?U)`` makes ``\\s`` and
``\\w`` Unicode-aware in Java regex, matching Python ``re`` on str.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Patterns whose behaviour must equal the original cleaning
# rules (innermost bracket spans, punctuation spacing, sentence ends, cut-off
# sentence detection).  Kept together, in the order the rules apply.
# ---------------------------------------------------------------------------
ROUND_SPAN = r"\([^()]*\)"
CURLY_SPAN = r"\{[^{}]*\}"
SQUARE_SPAN = r"\[[^\[\]]*\]"
ANY_BRACKET_SPAN = ROUND_SPAN + "|" + CURLY_SPAN + "|" + SQUARE_SPAN
SPACES_AROUND_PUNCT = r"(?U)\s*([^\w\s])\s*"
SENTENCE_END_NO_DIGIT = r"(?U)(?<!\d)([.!?])(?!\d)(?=\S)"
CLAUSE_MARK = r"(?U)([,;:%])(?=\S)"
WHITESPACE_RUN = r"(?U)\s+"
# The characters Java's (?U)\s matches (Unicode White_Space), for trim().
UNICODE_WHITESPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                      "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
KEEP_UP_TO_LAST_PERIOD = r"(?s)^(.*\.|[^.]*$)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    ``trim`` with an explicit character set (plain ``trim`` removes only the
    space character); about three times cheaper than the equivalent regex.
    """
    return F.trim(_c(col), F.lit(UNICODE_WHITESPACE))


def remove_brackets(col) -> Column:
    """One alternation pass deleting innermost (), {}, [] spans."""
    return F.regexp_replace(_c(col), ANY_BRACKET_SPAN, "")


def remove_cutoff(col) -> Column:
    """Drop a trailing unfinished sentence: keep text up to the last '.'.

    Text ending in '.' or containing no '.' is returned unchanged.
    """
    return F.regexp_extract(_c(col), KEEP_UP_TO_LAST_PERIOD, 1)


def postprocess(col) -> Column:
    """Submission clean-up: cut-off removal first, then bracket removal."""
    return remove_brackets(remove_cutoff(col))


def preprocess_text(col) -> Column:
    """Corpus clean-up: bracket spans, punctuation spacing, whitespace."""
    t = _c(col)
    t = F.regexp_replace(t, ROUND_SPAN, " ")
    t = F.regexp_replace(t, CURLY_SPAN, " ")
    t = F.regexp_replace(t, SQUARE_SPAN, " ")
    t = F.regexp_replace(t, SPACES_AROUND_PUNCT, "$1")
    t = F.regexp_replace(t, SENTENCE_END_NO_DIGIT, "$1 ")
    t = F.regexp_replace(t, CLAUSE_MARK, "$1 ")
    t = F.regexp_replace(t, WHITESPACE_RUN, " ")
    return F.regexp_replace(t, "^ | $", "")


def abstract_of(col) -> Column:
    """First line of an article, stripped."""
    return strip(F.substring_index(_c(col), "\n", 1))


def body_of(col) -> Column:
    """Everything after the first newline, stripped; '' when there is none."""
    t = _c(col)
    pos = F.instr(t, "\n")
    return F.when(pos > 0, strip(t.substr(pos + 1, F.length(t)))).otherwise(F.lit(""))


def prepend_abstract(abstract, summary) -> Column:
    """``f"{abstract}\\n{summary}".strip()``."""
    return strip(F.concat(_c(abstract), F.lit("\n"), _c(summary)))


def is_blank(col) -> Column:
    """True for null text or text that is only whitespace."""
    return F.coalesce(strip(col), F.lit("")) == F.lit("")
