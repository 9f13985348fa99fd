"""Row numbers over whole tables, and values by their place in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import spilled

#: A table is broadcast up to this many rows; above, Spark chooses.
SMALL = 200_000

#: Rows that one range of a global numbering has, about.
RANGE_ROWS = 1_000_000


def global_row_number(rows: DataFrame, order: list[str | Column], name: str = "row_number", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Row numbers from 1 over the whole table in ``order``, without bringing all rows to one task.

    Rows are dealt into ranges of ``order``, as many as their number asks for, and sorted
    within them; the places within ranges are kept in a table in the shared folder, so that counts
    and numbers come from the same ranges.  What is summed up and joined back is one row for
    each range.  Columns of ``order`` that tell equal keys apart also split them between ranges;
    rows that are equal in all of them are numbered in any order.
    """
    n = max(1, -(-rows.count() // range_rows))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed, _ = spilled(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    # the id is 2^33 times the number of the partition, and the row's place in it
    own = placed.withColumn("_range", F.shiftright("_place", 33)).withColumn("_place", F.col("_place").bitwiseAND((1 << 33) - 1))
    sizes = own.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    sent = F.broadcast(before) if n <= SMALL else before
    return own.join(sent, "_range").withColumn(name, F.col("_place") + F.col("_before") + 1).select(*rows.columns, name)


def numbered(pool: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """The distinct values of each key by place: ``_n, value`` with a number over the whole pool in order of
    keys and value, and ``keys, _first, _size`` with each key's first number and count.

    Neither gathers a key's values: a draw among them is an equi-join on the number.
    """
    values = pool.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value")).distinct()
    placed = global_row_number(values, [*keys, "_value"], name="_n")
    return placed.select("_n", F.col("_value").alias(value)), placed.groupBy(*keys).agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_size"))
