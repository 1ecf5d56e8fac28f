"""Helpers that keep a hot key, or a whole table, out of one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable_rows

# A key with more rows than this is split over several tasks.
HOT_ROWS = 1_000_000


def _same_keys(left: str, right: str, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def join_to_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    spread: str,
    group_rows: str = "group_rows",
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `rows` to one-row-per-key `groups`, splitting hot keys.

    `groups` is an aggregate of `rows`, so its side of the join sits right
    above an aggregation and AQE cannot split it.  Instead a key with more
    than `hot_rows` rows gets ``ceil(n / hot_rows)`` shares: its group row is
    repeated once per share and its rows pick a share by a hash of `spread`.
    At most ``total rows / hot_rows`` keys are hot, which bounds the broadcast
    list of them.  Null keys match each other.  `spread` must not be null.
    """
    payload = [c for c in groups.columns if c not in keys and c != group_rows]
    shares = F.ceil(F.col(group_rows) / F.lit(hot_rows)).cast("int")
    hot = F.broadcast(groups.where(F.col(group_rows) > hot_rows).select(*keys, shares.alias("_shares")))
    split_rows = (
        rows.alias("r")
        .join(hot.alias("h"), _same_keys("r", "h", keys), "left")
        .select(
            "r.*",
            F.coalesce(
                F.pmod(F.xxhash64(F.col(f"r.{spread}")), F.col("h._shares")), F.lit(0)
            ).cast("int").alias("_share"),
        )
    )
    split_groups = groups.select(
        *keys,
        *payload,
        F.explode(F.sequence(F.lit(0), F.greatest(shares, F.lit(1)) - 1)).alias("_share"),
    )
    return (
        split_rows.alias("r")
        .join(
            split_groups.alias("g"),
            _same_keys("r", "g", keys) & (F.col("r._share") == F.col("g._share")),
            how,
        )
        .select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"g.{c}") for c in payload])
    )


def number_rows(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Number rows by a total order, `start` first, with no single-task sort.

    The rows are range-partitioned and sorted, then written once so that both
    passes below see the same partitions.  Only one count per partition is
    summed up in one place; each row adds its position to its partition's
    offset.  The number depends on the order alone, so a rerun agrees.
    """
    ordered = durable_rows(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order))
    placed = ordered.withColumn("_place", F.monotonically_increasing_id())
    partition = F.shiftright("_place", 33)
    placed = placed.withColumn("_partition", partition).withColumn(
        "_position", F.col("_place") - F.shiftleft("_partition", 33)
    )
    # One row per partition: bounded by the number of partitions.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_partition")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_partition", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + F.col("_position") + F.lit(start))
        .drop("_partition", "_position", "_offset", "_place")
    )
