"""Top rows per group, and positions 1..n over results of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.lookup import MAX_BROADCAST_BYTES, payload_bytes, rows_with_keys
from tidewire.session import settle

_RN = "__rn"
# Up to this n Spark cuts each group before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
EARLY_CUT = 1000
# monotonically_increasing_id keeps the partition above bit 33 and the row below it.
_ROW_BITS = 33


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Each task keeps at most ``n`` rows per group before the shuffle (WindowGroupLimit), so the size
    of a group does not matter. A larger ``n`` than Spark cuts early takes distributed positions.
    ``order`` must end in a unique column.
    """
    if n > EARLY_CUT:
        grouped = df.withColumn("__group", F.struct(*keys))
        return numbered(grouped, order, within="__group", name=_RN).filter(F.col(_RN) <= n).select(*df.columns)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) <= n).drop(_RN)


def first_rows_per_group(df: DataFrame, group: Sequence[Column], order: Sequence[Column], key: str,
                         n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group by descending ``order``, then ascending unique ``key``.

    For wide rows: the choice runs on the narrow columns, then the chosen rows are fetched by key.
    """
    group_names, order_names = [f"__g{i}" for i in range(len(group))], [f"__o{i}" for i in range(len(order))]
    narrow = df.select(F.col(key), *[c.alias(a) for c, a in zip(group, group_names)],
                       *[c.alias(a) for c, a in zip(order, order_names)])
    chosen = first_per_group(narrow, group_names, [F.desc(a) for a in order_names] + [F.col(key)], n)
    return rows_with_keys(df, settle(chosen.select(key)), key)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, order: Sequence[Column], within: str | None = None, name: str = "rank") -> DataFrame:
    """Add the position 1..n by ``order``, over everything or within each value of ``within``.

    A plain window would sort one whole group in one task. Here the rows are range-partitioned by
    the full order, which also splits a hot group and, through the unique last column, ties. The
    sorted rows are kept on shared storage with their place in their partition, and the partition
    starts are added up from one count per partition (and group).
    """
    keys = ([F.col(within)] if within else []) + list(order)
    place = "__place"
    rows = settle(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn(place, F.monotonically_increasing_id())
    )
    rows = rows.withColumn("__part", F.shiftright(place, _ROW_BITS)).withColumn(
        place, F.col(place).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    groups = ["__part"] + ([within] if within else [])
    counts = rows.groupBy(*groups).agg(F.count("*").alias("__n"), F.min(place).alias("__first"))
    earlier = Window.orderBy("__part")
    if within:
        earlier = Window.partitionBy(within).orderBy("__part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *groups, (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__start"))
    if payload_bytes(counts) <= MAX_BROADCAST_BYTES:
        starts = F.broadcast(starts)
    joined = rows.withColumnRenamed(within, "__w").join(
        starts.withColumnRenamed("__part", "__p"),
        (F.col("__part") == F.col("__p")) & F.col("__w").eqNullSafe(F.col(within)),
    ).drop("__w", "__p") if within else rows.join(starts, "__part")
    ranked = joined.withColumn(name, F.col("__start") + F.col(place) + 1)
    return ranked.select(name, *df.columns)


def running_totals(df: DataFrame, order: Sequence[Column], value: str, within: str, position: str = "position",
                   total: str = "offset") -> DataFrame:
    """Position 1..n by ``order`` within each value of ``within``, and the sum of ``value`` over the rows before.

    For narrow rows: they are range-partitioned and stored, added up within each partition, and the partitions' own
    sums are added up from one row per partition and group.
    """
    place = "__place"
    rows = settle(df.repartitionByRange(within, *order).sortWithinPartitions(within, *order).withColumn(
        place, F.monotonically_increasing_id())).withColumn("__part", F.shiftright(place, _ROW_BITS))
    inside = Window.partitionBy("__part", within).orderBy(place)
    summed = rows.withColumns({
        position: F.row_number().over(inside).cast("long"),
        total: F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")})
    parts = rows.groupBy(F.col("__part").alias("__p"), F.col(within).alias("__w")).agg(
        F.count("*").alias("__n"), F.sum(value).alias("__sum"))
    earlier = Window.partitionBy("__w").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__p", "__w", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__rows"),
                          F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    if payload_bytes(parts) <= MAX_BROADCAST_BYTES:
        starts = F.broadcast(starts)
    joined = summed.join(starts, (F.col("__part") == F.col("__p")) & F.col("__w").eqNullSafe(F.col(within)))
    return joined.select(*df.columns, (F.col(position) + F.col("__rows")).alias(position),
                         (F.col(total) + F.col("__before")).cast("long").alias(total))


def numbered_top(df: DataFrame, order: Sequence[Column], n: int, within: str | None = None,
                 name: str = "rank") -> DataFrame:
    """Positions of the first ``n`` rows only, over everything or per value of ``within``."""
    if n > EARLY_CUT:
        return numbered(df, order, within, name).filter(F.col(name) <= n).select(*df.columns, name)
    if within is None:
        window = Window.orderBy(*order)
        return top_rows(df, order, n).withColumn(name, F.row_number().over(window).cast("long"))
    window = Window.partitionBy(within).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long")).filter(F.col(name) <= n)
