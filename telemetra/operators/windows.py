"""Top-N per group.

All of them filter ``row_number() <= n`` right after the window, so Catalyst
inserts a partial ``WindowGroupLimit`` before the shuffle: a hot group is cut
to ``n`` rows per input partition on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_group(df: DataFrame, group: list[str] | str, order: list[Column], n: int,
                      rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..n within each group by ``order`` (ties broken by ``order``'s tail)."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= F.lit(n))
    return out if rank_col else out.drop(rn)


def latest_order(time_col: str = "ts", tiebreak: str = "uuid") -> list[Column]:
    """Newest first; readings whose clock does not parse never rank first."""
    return [F.col(time_col).desc_nulls_last(), F.col(tiebreak).asc()]


def latest_n(readings: DataFrame, n: int, station_col: str = "StationID", time_col: str = "ts",
             tiebreak: str = "uuid", rank_col: str | None = None) -> DataFrame:
    """Latest ``n`` readings per station."""
    return first_n_per_group(readings, station_col, latest_order(time_col, tiebreak), n, rank_col)
