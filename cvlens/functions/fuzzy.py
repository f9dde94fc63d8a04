"""Indel similarity (the ``ratio`` of fuzzy string matching).

ratio(a, b) = 100 * (1 - (len a + len b - 2 * LCS(a, b)) / (len a + len b)),
case-sensitive; 100 when both are empty. The longest common subsequence is
worked out row by row as a column expression, on the JVM; it is meant for the
few pairs that the candidate join leaves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one row of the table per character of ``a``."""
    theirs = F.split(b, "")
    places = F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1)))

    def row(above: Column, ch: Column) -> Column:
        return F.aggregate(places, F.array(F.lit(0)), lambda own, j: F.array_append(own, F.when(
            F.get(theirs, j - 1) == ch, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(own, j - 1)))))

    start = F.array_repeat(F.lit(0), F.greatest(F.length(b), F.lit(1)) + 1)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(
        F.array_max(F.aggregate(F.split(a, ""), start, row)))


def indel_similarity(a: Column, b: Column) -> Column:
    """Normalised indel similarity in [0, 1]; null if either is null."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) - (total - 2 * lcs_length(a, b)) / total)


def admissible_lengths(length: Column, cutoff: float) -> Column:
    """Lengths ``lb`` that can still reach ``cutoff`` against a string of ``length``.

    ratio <= 200 * min(la, lb) / (la + lb), so lb lies in
    [cutoff * la / (200 - cutoff), la * (200 - cutoff) / cutoff]; one extra unit
    each side absorbs rounding, the exact score filters afterwards.
    """
    if not 0 < cutoff <= 100:
        raise ValueError("fuzzy cutoff must be in (0, 100]")
    lo = F.greatest(F.floor(length * F.lit(cutoff / (200.0 - cutoff))) - 1, F.lit(0))
    hi = F.ceil(length * F.lit((200.0 - cutoff) / cutoff)) + 1
    return F.sequence(lo.cast("int"), hi.cast("int"))


def edit_bound(la: Column, lb: Column, cutoff: float) -> Column:
    """The most insertions and deletions that strings of these lengths may be apart and still reach ``cutoff``."""
    return F.floor((la + lb) * F.lit(1.0 - cutoff / 100.0) + F.lit(1e-9)).cast("int")


def lcs_sql(a: str, b: str) -> str:
    """DuckDB expression: LCS length by the textbook row recurrence."""
    return ("list_reduce(string_split(%(a)s, ''), lambda prev, ca: list_reduce(range(1, len(%(b)s) + 1), "
            "lambda cur, j: list_append(cur, CASE WHEN ca = %(b)s[j] THEN prev[j] + 1 "
            "ELSE greatest(prev[j + 1], cur[j]) END), [0]), "
            "list_transform(range(0, len(%(b)s) + 1), lambda x: 0))[-1]") % {"a": a, "b": b}


def similarity_sql(a: str, b: str) -> str:
    return ("CASE WHEN length(%(a)s) + length(%(b)s) = 0 THEN 1.0 ELSE "
            "1.0 - (length(%(a)s) + length(%(b)s) - 2 * (%(l)s)) / (length(%(a)s) + length(%(b)s))::DOUBLE END"
            ) % {"a": a, "b": b, "l": lcs_sql(a, b)}

