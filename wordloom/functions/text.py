"""Column expressions for words and subword tokens (all JVM-side built-ins).

Token lists under training and encoding are one STRING in which every token
has its own space on both sides: ``" l  o  w  </w> "``.  Merging the pair
(a, b) is then the literal ``replace(t, ' a  b ', ' ab ')``, which scans left
to right and never overlaps -- the greedy pair merge of the tokenizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tokenizer format.
PAD = "<PAD>"
END = "<END>"
WORD_END = "</w>"
WORD_PATTERN = "([A-Za-z]+)"  # ASCII letters only; every other byte separates words

SEP = "  "  # between two tokens in the spaced form


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words_array(text) -> Column:
    """ASCII letter runs, lower-cased after extraction."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(WORD_PATTERN), 1), lambda x: F.lower(x))


def spaced_word(word) -> Column:
    """a word as its start tokens, one per character, plus the end marker."""
    return F.concat(F.regexp_replace(_c(word), "(.)", " $1 "), F.lit(f" {WORD_END} "))


def merge_pair(spaced, a: str, b: str) -> Column:
    """merge every (a, b) in a spaced token string."""
    return F.replace(_c(spaced), F.lit(f" {a}{SEP}{b} "), F.lit(f" {a}{b} "))


def token_array(spaced) -> Column:
    """Spaced form back to ARRAY<STRING>; an empty string gives an empty array.

    Tokens hold no spaces, so the double separators are first made single:
    splitting on one plain character avoids compiling a regex per row.
    """
    s = F.trim(_c(spaced))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(F.replace(s, F.lit(SEP), F.lit(" ")), " "))


def adjacent_pairs(tokens) -> Column:
    """adjacent (a, b) pairs of a token array; one-token arrays give none."""
    k = _c(tokens)
    n = F.greatest(F.size(k) - 1, F.lit(0))
    return F.zip_with(F.slice(k, 1, n), F.slice(k, 2, n), lambda x, y: F.struct(x.alias("a"), y.alias("b")))


def parse_rule(rule) -> tuple[Column, Column]:
    """split ``"a + b -> ab"`` into (a, b); invalid rules give nulls.

    The text after the arrow is ignored; the merged token is always a + b.
    """
    r = _c(rule)
    plus = F.instr(r, " + ")
    arrow = F.instr(r, " -> ")
    ok = (plus > 1) & (arrow > plus + 3)
    a = F.when(ok, F.substring(r, F.lit(1), plus - 1))
    b = F.when(ok, F.substring(r, plus + 3, arrow - plus - 3))
    return a, b


def rule_can_match(a, b) -> Column:
    """F4 helper: a rule side holding white space can never equal a token."""
    return _c(a).isNotNull() & _c(b).isNotNull() & ~_c(a).rlike(r"\s") & ~_c(b).rlike(r"\s")


def format_rule(a, b) -> Column:
    """the text form of a merge rule."""
    return F.concat(_c(a), F.lit(" + "), _c(b), F.lit(" -> "), _c(a), _c(b))
