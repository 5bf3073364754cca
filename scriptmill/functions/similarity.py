"""Text similarity: cheap exact cases and length rejects in the JVM, the matcher itself in Python."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptmill.functions.text import comparison_key

#: Characters compared, and the length ratio beyond which texts count as unlike (fixed values).
MAX_CHARS, MAX_RATIO = 20_000, 2.0


@cache
def _ratio():
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(ratio, "double")


def key_similarity(a: Column, b: Column) -> Column:
    """Similarity of two comparison keys; only pairs that cannot be decided by length or equality reach Python. Pass columns that exist, not expressions: each is used in several branches."""
    la, lb = F.length(a), F.length(b)
    cut = lambda x: F.substring(x, 1, MAX_CHARS)
    decided = F.when((la == 0) & (lb == 0), 1.0).when((la == 0) | (lb == 0), 0.0).when(F.greatest(la, lb) / F.least(la, lb) > MAX_RATIO, 0.0).when(cut(a) == cut(b), 1.0)
    open_ = decided.isNull() & a.isNotNull() & b.isNotNull()
    return F.coalesce(decided, _ratio()(F.when(open_, cut(a)), F.when(open_, cut(b))))


def similarity(a: Column, b: Column, compatibility: bool = True) -> Column:
    """Similarity between 0 and 1 of two texts, by their comparison keys."""
    return key_similarity(comparison_key(a, compatibility), comparison_key(b, compatibility))
