"""Text as columns: canonical form, folding, prose predicates, numbers in cells."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, functions as F

# Characters that stand for each other, one for one.
SINGLE = "‘’‚‛"
DOUBLE = "“”„‟"
DASHES = "‐‑‒–—―−"
BLANKS = "    ​﻿"
FOLD_FROM = SINGLE + DOUBLE + DASHES + BLANKS
FOLD_TO = "'" * 4 + '"' * 4 + "-" * 7 + " " * 6
# Words that make prose name a crossing, a comparison, a change or a derivation.
CROSSING_WORDS = ("interaction", "moderat", "×")
COMPARISON_WORDS = ("versus", " vs ", " vs. ", "greater than", "less than", "difference between", "change in", "change from", "pre-post", "pre/post", "prepost")
COMPARISON_OPERATOR = r"[a-z0-9)\]]\s*[<>]\s*[a-z0-9(\[]"
CHANGE_WORDS = ("change", "longitudinal", "over time", "follow-up", "followup", "pre > post", "post > pre", "pre-post", "following treatment", "after treatment")
DERIVED_WORDS = ("change in", "change from", "change over", "percent change", "percentage change", "percent reduction", "difference between", "difference in", "improvement in", "delta ")
BY_CROSSING = "([a-z]+)-by-([a-z]+)"
# Patterns of table cells.
PLACEHOLDER = r"^Unnamed:\s*\d+(_level_\d+)?$"
NUMBER = "^[-+−‐-―]?\\s?\\d+\\.?\\d*$"
GAP = r"(?:\s*[,;/]\s*|\s+)"
TRIPLE = rf"^[^\d+\-]{{0,3}}(-?\d+\.?\d*){GAP}(-?\d+\.?\d*){GAP}(-?\d+\.?\d*)\D{{0,3}}$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(text) -> Column:
    """Line ends become LF and nothing else changes."""
    return F.replace(F.replace(col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def text_hash(text) -> Column:
    return F.sha2(col(text), 256)


def fold(text) -> Column:
    """Quotes, dashes and odd spaces to their plain forms; the length stays."""
    return F.translate(col(text), FOLD_FROM, FOLD_TO)


def squeeze(text) -> Column:
    return F.trim(F.regexp_replace(col(text), r"(?U)\s+", " "))


@cache
def _case_foldings() -> tuple[str, str, dict[str, str]]:
    """All letters that full case folding changes: those that become one letter, these letters, and those that become several."""
    changed = {chr(c): chr(c).casefold() for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c)}
    one = {c: f for c, f in changed.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in changed.items() if len(f) > 1}


def caseless(text) -> Column:
    """Full case folding."""
    one, to, several = _case_foldings()
    out = F.translate(col(text), one, to)
    long = out
    for c, f in several.items():
        long = F.replace(long, F.lit(c), F.lit(f))
    return F.when(F.rlike(out, F.lit(f"[{''.join(several)}]")), long).otherwise(out)


def fold_label(text) -> Column:
    """Join key of labels: folded, blanks squeezed, caseless."""
    return caseless(squeeze(fold(text)))


def truncate(text, n: int) -> Column:
    return F.left(squeeze(text), F.lit(n))


def strip_fence(text) -> Column:
    """Without a code fence around it."""
    return F.regexp_replace(F.regexp_replace(F.trim(col(text)), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")


def prose(*fields) -> Column:
    return F.lower(F.concat_ws(" ", *[col(f) for f in fields]))


def _any_of(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def names_a_crossing(*fields) -> Column:
    text = prose(*fields)
    left, right = F.regexp_extract_all(text, F.lit(BY_CROSSING), F.lit(1)), F.regexp_extract_all(text, F.lit(BY_CROSSING), F.lit(2))
    return _any_of(text, CROSSING_WORDS) | F.exists(F.zip_with(left, right, lambda a, b: a != b), lambda x: x)


def names_a_comparison(*fields) -> Column:
    text = prose(*fields)
    return _any_of(text, COMPARISON_WORDS) | F.rlike(text, F.lit(COMPARISON_OPERATOR))


def names_a_change(*fields) -> Column:
    return _any_of(prose(*fields), CHANGE_WORDS)


def names_a_derivation(*fields) -> Column:
    return _any_of(prose(*fields), DERIVED_WORDS)


def clean_cell(cell) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(col(cell), F.lit(""))), PLACEHOLDER, "")


def normalize_number(cell) -> Column:
    """Dashes and blanks folded, and no gap between a sign and its digits."""
    plain = F.translate(F.coalesce(col(cell), F.lit("")), DASHES + BLANKS[:5], "-" * 7 + " " * 5)
    return F.trim(F.regexp_replace(plain, r"([-+])\s+", "$1"))


def is_number(cell) -> Column:
    return F.rlike(normalize_number(cell), F.lit(NUMBER))


def triple(cell) -> Column:
    """array of three doubles that a cell holds, else null."""
    text = normalize_number(cell)
    return F.when(F.rlike(text, F.lit(TRIPLE)), F.array(*[F.regexp_extract(text, TRIPLE, k).try_cast("double") for k in (1, 2, 3)]))


def dedup_base(header) -> Column:
    return F.regexp_replace(col(header), r"\.\d+$", "")


def markdown_cell(cell) -> Column:
    return F.trim(F.replace(F.replace(F.coalesce(col(cell), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))
