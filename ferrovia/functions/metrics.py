"""Exact decimal metrics.

Gold stores minutes as DECIMAL(8,2), percentages as DECIMAL(5,2) and speeds as
DECIMAL(6,1).  All of them are computed from integer partial sums (which can
be pre-aggregated map-side and merged in any order) followed by a single exact
decimal division and one HALF_UP rounding, so results do not depend on task
scheduling or on the order rows are combined in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES = "decimal(8,2)"
PCT = "decimal(5,2)"
KMH = "decimal(6,1)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nz(n: Column) -> Column:
    return F.when(n != 0, n)


def minutes(secs) -> Column:
    """Per-row seconds -> minutes, DECIMAL(8,2)."""
    return (_col(secs).cast("decimal(20,0)") / F.lit(60)).cast(MINUTES)


def minutes_from_sums(sum_secs, n_secs) -> Column:
    """Average minutes from a seconds sum and its non-NULL count.

    NULL when nothing was observed (count 0), also under ANSI mode.
    """
    den = _nz(_col(n_secs).cast("decimal(20,0)") * F.lit(60))
    return (_col(sum_secs).cast("decimal(20,0)") / den).cast(MINUTES)


def pct_from_counts(k, n) -> Column:
    """100 * k / n, DECIMAL(5,2); NULL when n is 0."""
    return ((_col(k).cast("decimal(20,0)") * F.lit(100)) / _nz(_col(n).cast("decimal(20,0)"))).cast(PCT)


def speed_kmh(mps) -> Column:
    """m/s -> km/h rounded per row to DECIMAL(6,1); a value out of range is an
    error, not a silent NULL."""
    return (_col(mps) * F.lit(3.6)).cast(KMH)


def fits_minutes(secs) -> Column:
    """Whether seconds have a place in the minutes column (NULL has)."""
    c = _col(secs)
    return c.isNull() | (c.cast("decimal(20,0)") / F.lit(60)).try_cast(MINUTES).isNotNull()


def fits_kmh(mps) -> Column:
    """Whether a speed has a place in the km/h column (NULL has; NaN hasn't)."""
    c = _col(mps)
    return c.isNull() | (c * F.lit(3.6)).try_cast(KMH).isNotNull()


def kmh_from_sums(sum_kmh, n) -> Column:
    """Average of per-row rounded km/h values, DECIMAL(6,1)."""
    return (_col(sum_kmh) / _nz(_col(n).cast("decimal(20,0)"))).cast(KMH)


def distinct_count(c, approx_rsd: float | None = None) -> Column:
    """Exact distinct count, or a HyperLogLog++ estimate with relative
    standard deviation ``approx_rsd`` (mergeable sketches: no shuffle of the
    distinct values themselves, constant memory per group)."""
    col = _col(c)
    if approx_rsd is None:
        return F.count_distinct(col)
    return F.approx_count_distinct(col, approx_rsd)
