"""Column-level text helpers (all JVM-side expressions, no Python UDFs).

These build ``Column`` expressions; operators in ``presswork.operators``
apply them to DataFrames. Regexes are written for Java's engine with
explicit Unicode classes, since Java's ``\\w`` / ``\\d`` are ASCII-only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern (Unicode letters, digits, underscore).
WORD_RE = r"[\p{L}\p{N}_]+"

# The white space that trimming takes (E8, K5), the Unicode
# spaces and the four separator controls; a bare ``s`` class is ASCII.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TRIM_RE = f"^{SPACE}+|{SPACE}+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim Unicode whitespace on both ends (``trim`` alone only drops spaces)."""
    return F.regexp_replace(col_(c), TRIM_RE, "")


def word_tokens(c) -> Column:
    """All maximal runs of word characters, in text order."""
    return F.regexp_extract_all(col_(c), F.lit(WORD_RE), 0)


def sentence_fragments(c) -> Column:
    """K5 step 1: split on '.', strip each piece."""
    return F.transform(F.split(col_(c), r"\.", -1), strip_ws)


def merge_fragments(frags_col: str, min_len: int = 15) -> Column:
    """K5 step 2 on a materialised fragment column: a piece of <= ``min_len``
    chars is appended (after one space) to the previous sentence; empty
    results dropped.

    Start positions, then one slice + join per sentence: linear in the text
    length, no shuffle. ``frags_col`` must be a column (not an expression) so
    the lambdas do not re-evaluate the split per element.
    """
    frags = F.col(frags_col)
    starts = F.filter(
        F.sequence(F.lit(0), F.size(frags) - 1),
        lambda i: (i == 0) | (F.length(F.get(frags, i)) > min_len),
    )
    return starts, frags


def merge_sentences(df, text: str, out: str = "sentences", min_len: int = 15):
    """K5 on a DataFrame: adds array column ``out`` of merged sentences."""
    tmp = df.withColumn("_frags", sentence_fragments(text))
    starts, frags = merge_fragments("_frags", min_len)
    tmp = tmp.withColumn("_starts", starts)
    st = F.col("_starts")
    n = F.size(frags)
    sents = F.transform(
        st,
        lambda s, k: F.array_join(
            F.slice(frags, s + 1, F.coalesce(F.get(st, k + 1), n) - s), " "),
    )
    return (tmp.withColumn(out, F.filter(sents, lambda s: F.length(s) > 0))
            .drop("_frags", "_starts"))


def filter_tokens(tokens, stop: list[str] | None = None, min_len: int = 2) -> Column:
    """K6 filter: tokens of at least ``min_len`` chars whose lower case is not in ``stop``."""
    words = sorted(set(stop or []))

    def keep(t):
        cond = F.length(t) >= min_len
        if words:  # a list of literals is looked up by hash
            cond = cond & ~F.lower(t).isin(words)
        return cond

    return F.filter(col_(tokens), keep)


# Fixed value: sentence pattern of U3, the shortest run ending in . ! or ? that has no
# digit immediately before or after the mark.
SENTENCE_RE = r"(?d)(.+?(?<!\d)[.!?](?!\d))"


def split_sentences(c) -> Column:
    """Sentences as the shortest runs ending in ``.!?`` not between digits.

    ``(?s)`` is off on purpose: '.' stops at line breaks as in the original
    pattern, so a run never crosses a newline.
    """
    return F.regexp_extract_all(col_(c), F.lit(SENTENCE_RE), 1)
