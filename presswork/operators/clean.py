"""Body cleaning: E8-E14, driven by the rule table of ``clean_rules``.

The rules fold into one expression per column (``regexp_replace`` chain);
outlet rules are guarded by ``when(outlet == ...)`` so every row evaluates
only its own outlet's patterns after the common ones.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions import clean_rules as R
from presswork.functions.text import strip_ws


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_ws(c) -> Column:
    """E8 (start): script noise, newline, CR, <br>, tab removed; trimmed."""
    t = F.replace(_c(c), F.lit(R.SCRIPT_NOISE), F.lit(""))
    for lit in ("\n", "\r", "<br>", "\t"):
        t = F.replace(t, F.lit(lit), F.lit(""))
    return strip_ws(t)


def final_spaces(c) -> Column:
    """E8 (end): one pass of double space -> space, then one leading space off."""
    return F.regexp_replace(F.replace(_c(c), F.lit("  "), F.lit(" ")), "^ ", "")


_META = set(".[](){}?*+|^$\\")


def required_literal(pattern: str) -> str | None:
    """Longest literal run that every match of ``pattern`` must contain.

    Conservative: a run breaks at any class, group, dot or anchor; a char
    made optional by ``?``, ``*`` or ``{0,`` is dropped; alternation or
    inline flags give no guard (None).
    """
    if "|" in pattern or re.search(r"\(\?(?!:)", pattern):
        return None
    runs, cur, i, depth = [], "", 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            lit, step = (nxt, 2) if not nxt.isalnum() else (None, 2)
        elif ch == "[":
            j = pattern.index("]", i + 2) if "]" in pattern[i + 2:] else len(pattern) - 1
            lit, step = None, j - i + 1
        elif ch == "{":
            j = pattern.index("}", i) if "}" in pattern[i:] else len(pattern) - 1
            lit, step = None, j - i + 1
        elif ch in "()":
            depth += 1 if ch == "(" else -1
            lit, step = None, 1
        elif ch in _META:
            lit, step = None, 1
        else:
            lit, step = ch, 1
        after = pattern[i + step:i + step + 2]
        optional = after[:1] in ("?", "*") or after.startswith("{0")
        if lit is None or depth > 0 or optional:
            if len(cur) > 0:
                runs.append(cur)
            cur = ""
            if lit is not None and not optional and depth == 0:
                cur = lit
        else:
            cur += lit
        i += step
    if cur:
        runs.append(cur)
    runs = [r for r in runs if r.strip()]
    return max(runs, key=len) if runs else None


def guarded(col: Column, pat: str, rep: str) -> Column:
    """``regexp_replace`` that runs only on texts containing the pattern's
    required literal (exact: without it no match exists), skipping the
    backtracking of ``.+`` patterns on texts they cannot hit. The input is
    bound once through a one-element ``transform``, so chains stay linear."""
    lit = required_literal(pat)
    if not lit:
        return F.regexp_replace(col, pat, rep)
    return F.element_at(F.transform(F.array(col), lambda t: F.when(
        t.contains(lit), F.regexp_replace(t, pat, rep)).otherwise(t)), 1)


def guarded_steps(df, c: str, rules: Sequence[tuple]):
    """Apply outlet-free rules to column ``c`` (one expression)."""
    return df.withColumn(c, apply_rules(F.col(c), rules))


def apply_rules(c, rules: Sequence[tuple]) -> Column:
    """Fold ``(outlet, pattern, repl)`` rules of one outlet (or of all) over a
    text column; each step wraps the previous one once (linear size)."""
    t = _c(c)
    for _who, pat, rep in rules:
        t = drop_tail_after_last_stop(t) if pat == R.TAIL else guarded(t, pat, rep)
    return t


def by_outlet(c: str, outlet, rules: Sequence[tuple]) -> Column:
    """One ``CASE`` over outlets; each branch folds that outlet's rules over
    the materialised column ``c``; outlet-free rules apply to every row."""
    common = [r for r in rules if r[0] is None]
    per: dict[str, list] = {}
    for r in rules:
        if r[0] is not None:
            per.setdefault(r[0], []).append(r)
    base = F.col(c)
    if not per:
        return apply_rules(base, common)
    expr = None
    for who, rs in per.items():
        cond = _c(outlet) == F.lit(who)
        expr = F.when(cond, apply_rules(base, rs)) if expr is None else expr.when(cond, apply_rules(base, rs))
    return apply_rules(expr.otherwise(base), common)


def clean_generic(c) -> Column:
    """Leading bracket tag, stray ']', arrow-to-html run, byline."""
    return apply_rules(c, R.GENERIC_RULES)


def strip_symbols(c) -> Column:
    """Bars, triangles, arrows, square brackets."""
    return F.translate(_c(c), R.SYMBOLS, "")


def clean_unconditional(c) -> Column:
    """Outlet patterns applied to every article."""
    return apply_rules(c, R.UNCONDITIONAL_RULES)


def clean_by_outlet(df, c: str, outlet: str, rules: Sequence[tuple] = tuple(R.OUTLET_RULES),
                    out: str | None = None):
    """Outlet-conditional rules on column ``c`` of ``df``."""
    return df.withColumn(out or c, by_outlet(c, outlet, rules))


def drop_tail_after_last_stop(c) -> Column:
    """Delete (literally, every occurrence) the text after the last '. '.

    Without any '. ' the tail is the whole text, so the text empties.
    """
    t = _c(c)
    tail = F.when(t.contains(". "), F.regexp_extract(t, r"(?s)^.*\. (.*)$", 1)).otherwise(t)
    return F.when(tail == "", t).otherwise(F.replace(t, tail, F.lit("")))


def empty_to_null(c) -> Column:
    """Empty or single-space text -> null (the sentinel)."""
    t = _c(c)
    return F.when((t == "") | (t == " "), F.lit(None).cast("string")).otherwise(t)


def clean_body(df, c: str, outlet: str | None = None, extra_rules: Sequence[tuple] = (),
               out: str = "cleaned", symbols_last: bool = False):
    """E8-E14 in the original order on column ``c``; ``extra_rules`` (for
    example corpus rules) run after the outlet rules. Steps are materialised
    as columns so no expression repeats its input.

    In the original order the symbols go before the outlet rules, so rules for
    bracketed signatures meet no bracket and are dead. ``symbols_last`` is the
    second order: the same rules with the symbols taken out after them."""
    df = df.withColumn("_clean", normalise_ws(c))
    df = guarded_steps(df, "_clean", R.GENERIC_RULES)
    if not symbols_last:
        df = df.withColumn("_clean", strip_symbols("_clean"))
    df = guarded_steps(df, "_clean", R.UNCONDITIONAL_RULES)
    if outlet is not None:
        df = df.withColumn("_clean", by_outlet("_clean", outlet, R.OUTLET_RULES))
    if symbols_last:
        df = df.withColumn("_clean", strip_symbols("_clean"))
    if extra_rules:
        df = df.withColumn("_clean", by_outlet("_clean", outlet, extra_rules) if outlet
                           else apply_rules(F.col("_clean"), extra_rules))
    df = df.withColumn("_clean", empty_to_null("_clean"))
    return df.withColumn(out, final_spaces("_clean")).drop("_clean")
