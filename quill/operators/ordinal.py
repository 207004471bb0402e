"""Global 0-based ordinals without an unpartitioned window, and without moving or
storing anything but keys.

The keys are range-partitioned and sorted, each partition numbers its own, and the
per-partition counts (one row per partition) give the offsets. The numbered keys are
written to the shared folder first, so the partition numbers the offsets refer to cannot
change on a recomputation (lost executor, AQE re-plan). The rows then meet their
ordinals in one join on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.sources.tables import stored


def key_index(keys: DataFrame, name: str = "idx") -> DataFrame:
    """``keys`` (all its columns in order are the key) with ``name`` = 0-based position."""
    cols = [F.col(c) for c in keys.columns]
    # Partition number and position in it come from one id, given after the sort:
    # the range partitioning is the only shuffle.
    ranged = keys.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_mono", F.monotonically_increasing_id())
    local = stored(ranged, "ordinals")
    pid, place = F.shiftright("_mono", 33).cast("int"), F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition: a tiny frame, the running sum over it is cheap.
    offsets = (local.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")))
    return (local.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
            .select(*keys.columns, (F.col("_off") + place).alias(name)))


def attach(df: DataFrame, index: DataFrame, cols: list[str], name: str) -> DataFrame:
    """``df`` with the position of its key from ``index`` (``cols``, ``name``; one row for each
    row of ``df``). Rows of an equal key get its positions in no particular order."""
    first = index.groupBy(*cols).agg(F.min(name).alias("_ix"), F.count(F.lit(1)).alias("_ixn"))
    first = first.select(*[F.col(c).alias(f"_ixk{i}") for i, c in enumerate(cols)], "_ix", "_ixn")
    repeated = (first.agg(F.max("_ixn")).first()[0] or 0) > 1
    on = " and ".join(f"`{c}` <=> _ixk{i}" for i, c in enumerate(cols))
    joined = df.join(first.drop("_ixn"), F.expr(on))
    place = F.col("_ix")
    if repeated:
        place = place + F.row_number().over(Window.partitionBy(*[f"_ixk{i}" for i in range(len(cols))]).orderBy(F.lit(0))) - 1
    return joined.select(*df.columns, place.alias(name))


def global_index(df: DataFrame, order_cols: list[str], name: str = "idx") -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order. The columns
    should identify rows; rows of an equal key get consecutive positions."""
    return attach(df, key_index(df.select(*order_cols), name), order_cols, name)
