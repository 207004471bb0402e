"""Distributed ordered scans with one shuffle of the rows, which do not put a whole group
in one task.

Rows are range-partitioned on (group, order) and each task walks its sorted slice once,
in Arrow batches. Only the first group of a slice can go on from the slice before, so
the borders are one row per partition: first group, last group and the last group's
final values. They are folded in order on the driver (their number is that of the
partitions) and handed to the rows of each slice's first group by a broadcast join on
the partition number.

A value is one of three kinds: ``LAST``, the last non-null value of a column at or before
the row within its group (``last(ignorenulls)`` over a running frame); ``BEFORE``, the same
strictly before the row; ``ROW_BEFORE``, the value of the row before (``lag``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from quill.sources.tables import stored


def _starts(groups: pa.Array) -> np.ndarray:
    """The first row of each row's group; nulls are a group of their own."""
    codes = groups.dictionary_encode()
    code = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))


LAST, BEFORE, ROW_BEFORE = "last", "before", "row before"


def ordered_scan(df: DataFrame, group_col: str, order_cols: list[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """``df``, stored, with a column for each of ``values`` (name: source column and kind).
    ``order_cols`` order the rows of a group; rows that tie come in no particular order."""
    spark = df.sparkSession
    names, kinds = df.columns, df.schema
    keys = [F.col(group_col), *map(F.col, order_cols)]
    # What a slice hands on is kept beside the result.
    schema = StructType([*kinds.fields, *(StructField(c, kinds[v].dataType) for c, (v, _) in values.items()),
                         *(StructField(f"_hand{i}", kinds[v].dataType) for i, (v, _) in enumerate(values.values())),
                         StructField("_pid", IntegerType()), StructField("_head", BooleanType()), StructField("_top", BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        group, handed, head = None, {}, True   # the last row's group and values; still in the slice's first group
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = batch.column(group_col)
            joined = groups if group is None else pa.concat_arrays([group, groups])
            skip = len(joined) - n
            start = _starts(joined)
            at = np.arange(len(joined))
            out, hand = [], []
            for c, (v, kind) in values.items():
                own = pa.concat_arrays([handed[c], batch.column(v)]) if skip else batch.column(v)
                last = at if kind == ROW_BEFORE else np.maximum.accumulate(np.where(own.is_valid().to_numpy(zero_copy_only=False), at, -1))
                here = last if kind == LAST else np.concatenate([[-1], last[:-1]])
                take = lambda i: own.take(pa.array(np.maximum(i, 0), mask=i < start))[skip:]  # noqa: B023, E731
                out.append(take(here))
                hand.append(take(last))
                handed[c] = hand[-1][-1:]
            heads = (start[skip:] == 0) & head
            top = (np.arange(n) == 0) & (skip == 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out, *hand, pa.array(np.full(n, pid, np.int32)), pa.array(heads), pa.array(top)],
                                             names=[f.name for f in schema.fields])
            head = bool(heads[-1])
            group = groups[-1:]

    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Written once, so that the partition numbers stay what the borders refer to.
    local = stored(ranged.mapInArrow(walk, schema), "scan")
    hands = [f"_hand{i}" for i in range(len(values))]
    first = F.struct(F.col(group_col).alias("g"))
    last = F.struct(F.col(group_col).alias("g"), *hands)
    borders = local.groupBy("_pid").agg(F.min_by(first, F.struct(*keys)).alias("first"), F.max_by(last, F.struct(*keys)).alias("last")).collect()
    rows, group, carry = [], None, [None] * len(values)
    for i, r in enumerate(sorted(borders, key=lambda r: r["_pid"])):
        into = carry if i and r["first"]["g"] == group else [None] * len(values)
        rows.append((r["_pid"], *into))
        through = r["first"]["g"] == r["last"]["g"]
        group = r["last"]["g"]
        carry = [b if r["last"][h] is None and through and kind != ROW_BEFORE else r["last"][h] for h, b, (_, kind) in zip(hands, into, values.values())]
    carried = spark.createDataFrame(rows, StructType([StructField("_pid", IntegerType()), *(StructField(f"_in{i}", schema[h].dataType) for i, h in enumerate(hands))]))
    out = local.join(F.broadcast(carried), "_pid")   # one row a partition
    there = [F.when(F.col("_top" if kind == ROW_BEFORE else "_head") & F.col(c).isNull(), F.col(f"_in{i}")).otherwise(F.col(c)).alias(c)
             for i, (c, (_, kind)) in enumerate(values.items())]
    return out.select(*names, *there)


def carry_forward(df: DataFrame, group_col: str, order_col: str, value_cols: list[str],
                  suffix: str = "_ff") -> DataFrame:
    """Each of ``value_cols`` filled forward, in a column with ``suffix``."""
    return ordered_scan(df, group_col, [order_col], {c + suffix: (c, LAST) for c in value_cols})


def previous_in_order(df: DataFrame, group_col: str, order_cols: list[str], value_col: str,
                      name: str = "previous") -> DataFrame:
    """``name``: the ``value_col`` of the row before in the group, null in its first row."""
    return ordered_scan(df, group_col, order_cols, {name: (value_col, ROW_BEFORE)})
