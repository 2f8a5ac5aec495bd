"""Person-name normalisation and token-sort similarity."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _fold_to_ascii(names: pd.Series) -> pd.Series:
    def fold(text):
        if text is None or text.isascii():
            return text
        return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")

    return names.map(fold, na_action="ignore")


def normalise_name(c: Column | str) -> Column:
    """Lower-case ASCII letters and digits separated by single spaces; null becomes ''.

    Only the compatibility decomposition leaves the JVM: Spark has no built-in for it. Text
    that is ASCII already goes there as null and back.
    """
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    folded = F.coalesce(_fold_to_ascii(F.when(F.octet_length(text) > F.length(text), text)), text)
    spaced = F.lower(F.regexp_replace(folded, "[^a-zA-Z0-9]+", " "))
    return F.trim(spaced)


def sort_tokens(c: Column | str) -> Column:
    """Words of an already normalised name in alphabetical order."""
    words = F.split(F.col(c) if isinstance(c, str) else c, " ")
    return F.array_join(F.array_sort(words), " ")


def _common_subsequence(a: str, b: str) -> int:
    """Longest common subsequence length, one machine-word-parallel step per letter of b."""
    positions: dict[str, int] = {}
    for i, letter in enumerate(a):
        positions[letter] = positions.get(letter, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & positions.get(letter, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _similarity(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 100.0
    total = len(a) + len(b)
    edits = total - 2 * _common_subsequence(a, b)
    return (1.0 - edits / total) * 100.0


@F.pandas_udf(T.DoubleType())
def insert_delete_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """0-100 similarity by insertions and deletions; 0 when either side is empty."""
    return pd.Series([_similarity(a or "", b or "") for a, b in zip(left, right)], dtype="float64")


def token_sort_ratio(left: Column | str, right: Column | str) -> Column:
    """Similarity of two normalised names regardless of word order."""
    return insert_delete_ratio(sort_tokens(left), sort_tokens(right))


def edit_budget(length_a: Column, length_b: Column, threshold: float) -> Column:
    """Most edits a pair of these lengths can have and still reach the threshold."""
    share = round(1.0 - threshold / 100.0, 9)
    return F.floor(F.lit(share) * (length_a + length_b) + F.lit(1e-9))


def may_reach(a: Column | str, b: Column | str, threshold: float) -> Column:
    """Necessary condition for ``insert_delete_ratio >= threshold``, inside codegen:
    replacing a letter costs one edit here and two there, so this never rejects a match."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    budget = edit_budget(F.length(a), F.length(b), threshold)
    return (
        (F.length(a) > 0)
        & (F.length(b) > 0)
        & (F.abs(F.length(a) - F.length(b)) <= budget)
        & (F.levenshtein(a, b) <= budget)
    )
