"""Mergeable quantile sketches (KLL) with a known rank error.

A sketch keeps about ``k`` weighted values whatever the number of rows, so it is a bounded state for
a stream's time bin, and sketches of small bins merge into those of larger ones without reading the
rows again. A quantile read from it is a value of the data whose rank is off by at most
``rank_error(k)`` of the rows with 99 % confidence (``wide_rank_error`` practically always). A
sketch of fewer rows than ``k`` holds them all. NULL and NaN take no part; of no rows the quantiles
are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A few kilobytes per sketch, 0.28 % rank error.
SKETCH_K = 1000


def sketch(value: str | Column, k: int = SKETCH_K) -> Column:
    """The aggregate that builds a sketch of a double column."""
    v = F.col(value) if isinstance(value, str) else value
    return F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(k))


def merged(sketches: str | Column, k: int = SKETCH_K) -> Column:
    """The aggregate that merges sketches."""
    return F.kll_merge_agg_double(sketches, F.lit(k))


def rows_in(s: str | Column) -> Column:
    return F.kll_sketch_get_n_double(s)


def quantiles(s: str | Column, probs: list[float]) -> Column:
    """Array of the quantiles of a sketch."""
    return F.when(rows_in(s) > 0, F.kll_sketch_get_quantile_double(s, F.array(*map(F.lit, probs))))


def rank_error(k: int = SKETCH_K) -> float:
    """The rank error of one quantile at 99 % confidence, as a share of the rows (the published
    fit for KLL sketches)."""
    return 2.296 / k**0.9723


def wide_rank_error(k: int = SKETCH_K) -> float:
    """Twice ``rank_error``: the error is about normal, so it stays below this but for some two
    quantiles in ten million."""
    return 2.0 * rank_error(k)


def sketch_bytes(k: int = SKETCH_K) -> int:
    """An upper bound of a sketch's size for up to 2**40 rows: levels shrink by a third each to eight
    values at least."""
    return 64 + 8 * (3 * k + 8 * 40)
