"""Similarity of short texts, 0-100.

``levenshtein_score`` is a Column expression. The other scorers follow the published
definitions of sequence-ratio matching and run inside Arrow batches over tiles of distinct
texts (see operators/similar.py), never row by row over the data.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_score(a: Column, b: Column) -> Column:
    return rounded_score(F.greatest(F.length(a), F.length(b)), F.levenshtein(a, b))


def rounded_score(longest: Column, edits: Column) -> Column:
    """Two empty texts score 0, as texts without anything in common do."""
    share = F.try_divide(F.lit(100.0) * (longest - edits), longest)
    return F.floor(F.coalesce(share, F.lit(0.0)) + 0.5).cast("int")


def clean(text: str) -> str:
    """Lower case, everything but letters, digits and underscores blank, trimmed."""
    return re.sub(r"\W", " ", text).strip().lower()


def ratio(a: str, b: str) -> int:
    return round(100 * SequenceMatcher(None, a, b).ratio()) if a and b else 0


def ratio_against(other: str) -> Callable[[str], int]:
    """``ratio`` with the analysis of the second text done once."""
    if not other:
        return lambda text: 0
    matcher = SequenceMatcher(None, "", other)

    def score(text: str) -> int:
        matcher.set_seq1(text)
        return round(100 * matcher.ratio()) if text else 0

    return score


SCORERS: dict[str, Callable[[str], Callable[[str], int]]] = {
    "ratio": ratio_against,
}


def overlap_bounds(texts: list[str], others: list[str]) -> np.ndarray:
    """Upper bounds of ``ratio``, texts × others: shared characters, order ignored."""
    alphabet = sorted(set("".join(texts)))

    def counts(rows: list[str]) -> np.ndarray:
        return np.array([[row.count(c) for c in alphabet] for row in rows], dtype=np.int32).reshape(len(rows), -1)

    left, right = counts(texts), counts(others)
    shared = np.minimum(left[:, None, :], right[None, :, :]).sum(axis=2)
    lengths = np.add.outer([len(t) for t in texts], [len(o) for o in others])
    return np.rint(200.0 * shared / np.maximum(lengths, 1)).astype(int)
