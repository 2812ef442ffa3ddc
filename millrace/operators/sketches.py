"""Mergeable summaries: distinct counts and quantiles that are stored per period and added up over any span.

States are fixed-size binaries built map-side, so neither a hot key nor a long
span needs its rows again. Distinct states of 2**`log2` registers have a relative
standard error of about 1.04 / sqrt(2**log2); they may be merged with themselves.
Quantile states of size `k` have a rank error of about 2.3 / k at 99 % confidence;
merging the same rows twice counts them twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.versions import VersionedTable

DISTINCT_LOG2 = 14
QUANTILE_K = 400


def distinct_state(value: str, log2: int = DISTINCT_LOG2) -> Column:
    return F.hll_sketch_agg(value, F.lit(log2))


def merged_distinct(state: str) -> Column:
    """A state of states, for `estimated_distinct` or to be stored."""
    return F.hll_union_agg(state)


def estimated_distinct(state: Column) -> Column:
    return F.hll_sketch_estimate(state)


def quantile_state(value: str, k: int = QUANTILE_K) -> Column:
    """Of doubles; nulls are left out."""
    return F.kll_sketch_agg_double(value, F.lit(k))


def merged_quantiles(state: str, k: int = QUANTILE_K) -> Column:
    return F.kll_merge_agg_double(state, F.lit(k))


def estimated_quantile(state: Column, p: float) -> Column:
    """Null for a state of no values."""
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_quantile_double(state, F.lit(p)))


# How a stored column is made one of several of its kind.
MERGED = {"sum": F.sum, "distinct": merged_distinct, "quantiles": merged_quantiles}


def fold_states(table: VersionedTable, delta: DataFrame, keys: Sequence[str], kinds: dict[str, str], token: tuple[str, int] | None = None) -> int:
    """Merge a batch's states into a table with one row per `keys`; returns its version.

    `kinds` names each other column's kind: sum, distinct or quantiles. Only the
    table's parts that the batch has rows for are read and written. A batch
    delivered again under its token changes nothing.
    """
    base = table.manifest()
    if token and base.tokens.get(token[0], -1) >= token[1]:
        return base.number
    parts = table.labels(delta, base)
    both = table.read(base, parts).select(*keys, *kinds).unionByName(delta.select(*keys, *kinds))
    merged = both.groupBy(*keys).agg(*[MERGED[kind](c).cast(dict(delta.dtypes)[c]).alias(c) for c, kind in kinds.items()])
    return table.replace(merged, parts, base, token)
