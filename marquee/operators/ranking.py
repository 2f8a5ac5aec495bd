"""Whole-table ranks without a whole-table window.

Values are dealt by range over partitions, all ranked columns together, and ranked within each partition. A value's rank
is that plus the rows of the partitions before, of which only one line per partition and column is needed. A
value that very many rows hold spreads over several partitions; its rank is then that in the first of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _partitions(df: DataFrame) -> int:
    return max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _same(a, b) -> bool:
    return a == b or all(isinstance(x, float) and math.isnan(x) for x in (a, b))


def _first_ranks(lines: list) -> list[tuple[int, int, int, int]]:
    """Per partition and column: rows in the partitions before, and the rank of the partition's first value,
    which may have begun in an earlier one. ``lines`` are in the order of partitions."""
    out, seen, last = [], {}, {}
    for line in lines:
        column, n, top, bottom = line["_c"], line["n"], list(line["top"])[1:], list(line["bottom"])
        before = seen.get(column, 0)
        rank = before + 1
        if column in last and all(map(_same, last[column][0], top)):
            rank = last[column][1]
        out.append((line["_p"], column, before, rank))
        local, low = bottom[0], bottom[1:]
        last[column] = (low, rank if local == 1 else before + local)
        seen[column] = before + n
    return out


def add_ranks(df: DataFrame, ranks: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Adds ``rank() over (order by column desc nulls last)`` for each ``name: column``.

    All columns are ranked in one pass over (row, column, value) and come back to the rows in one join.
    """
    base = cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()))
    columns = list(dict.fromkeys(ranks.values()))
    kinds = list(dict.fromkeys(base.schema[c].dataType.simpleString() for c in columns))
    entry = lambda i, c: F.struct(
        F.lit(i).alias("_c"), *((F.col(c) if base.schema[c].dataType.simpleString() == k else F.lit(None)).cast(k).alias(f"_v{j}") for j, k in enumerate(kinds))
    )
    values = [f"_v{j}" for j in range(len(kinds))]
    largest_first = [F.desc_nulls_last(v) for v in values]
    long = base.select("_rid", F.inline(F.array(*(entry(i, c) for i, c in enumerate(columns)))))
    dealt = long.repartitionByRange(buckets or _partitions(base), F.col("_c"), *largest_first, F.col("_rid"))
    dealt = dealt.withColumn("_p", F.spark_partition_id())
    local = F.rank().over(Window.partitionBy("_p", "_c").orderBy(*largest_first))
    # Stored, so that a row's partition doesn't depend on another sample of the values.
    placed = cut_lineage(cut_lineage(dealt).withColumn("_local", local))
    ends = F.struct("_local", *values)
    lines = placed.groupBy("_p", "_c").agg(F.count("*").alias("n"), F.min(ends).alias("top"), F.max(ends).alias("bottom"))
    firsts = _first_ranks(lines.orderBy("_p", "_c").collect())  # one line per partition and column
    if not firsts:
        return base.withColumns({name: F.lit(None).cast("long") for name in ranks}).drop("_rid")
    starts = base.sparkSession.createDataFrame(firsts, "_p int, _c int, _before bigint, _first bigint")
    told = placed.join(F.broadcast(starts), ["_p", "_c"])
    rank = F.when(F.col("_local") == 1, F.col("_first")).otherwise(F.col("_before") + F.col("_local"))
    of_row = told.groupBy("_rid").agg(*(F.max(F.when(F.col("_c") == columns.index(c), rank)).alias(name) for name, c in ranks.items()))
    return base.join(of_row, "_rid").drop("_rid")


def rows_at(df: DataFrame, order_col: str, positions: list[int], buckets: int | None = None) -> DataFrame:
    """The rows standing at the given zero-based positions of the ascending order of a
    unique column, with ``position``. Never sorts the table into one task."""
    dealt = df.repartitionByRange(buckets or _partitions(df), order_col).withColumn("_p", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    starts, total = [], 0
    for p, n in sorted(map(tuple, dealt.groupBy("_p").count().collect())):
        starts.append((p, total))
        total += n
    wanted = [(p, at - start, at) for p, start in starts for at in positions if start <= at and (p, start) == max(s for s in starts if s[1] <= at)]
    chosen = df.sparkSession.createDataFrame(wanted, "_p int, _nth int, position bigint")
    nth = F.row_number().over(Window.partitionBy("_p").orderBy(order_col)) - 1
    held = dealt.join(F.broadcast(chosen.select("_p").distinct()), "_p", "left_semi").withColumn("_nth", nth)
    return held.join(F.broadcast(chosen), ["_p", "_nth"]).drop("_p", "_nth")
