"""Dense surrogate keys: row numbers over many tasks, and keys that survive a rerun."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.session import write_scratch

_PART, _POSITION = "__part", "__position"
# monotonically_increasing_id holds the row's position within its partition in the low 33 bits
_POSITION_BITS = (1 << 33) - 1


def number_rows(
    df: DataFrame,
    key: str,
    order_by: list[str] | None = None,
    start: int = 1,
    unique: bool = False,
) -> DataFrame:
    """The rows with a gapless ``key`` from ``start`` on.

    Without ``order_by`` rows are numbered as they arrive: nothing is shuffled, whatever values
    they hold. With it they are range-sorted. Rows that are equal there, perhaps many copies of
    one, are then told apart by their arrival, so that they too spread over tasks; ``unique``
    says that there are none and saves noting the arrival.

    Rows are written to a scratch table with their partition and position, and the first number
    of a partition follows from the sizes of the partitions before it. Counting and numbering read
    the same written rows, so a lost executor cannot renumber anything. Store the result, then
    ``release_scratch``.
    """
    spark, rows, arrived = df.sparkSession, df, None
    if order_by:
        arrival = [] if unique else [_PART, _POSITION]
        if not unique:
            arrived = _write_placed(df)
            rows = spark.table(arrived)
        order = [*order_by, *arrival]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(*arrival)
    placed = spark.table(_write_placed(rows))
    if arrived:
        spark.sql(f"DROP TABLE {arrived}")
    # one row per written partition: the window and the broadcast are bounded by their number
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("count").over(earlier), F.lit(0)) + start
    firsts = placed.groupBy(_PART).count().select(_PART, first.alias("__first"))
    return placed.join(F.broadcast(firsts), _PART).select(
        (F.col("__first") + F.col(_POSITION)).alias(key), *df.columns
    )


def _write_placed(rows: DataFrame) -> str:
    """A table of the rows, each with its partition and its position there."""
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    placed = rows.withColumns({_PART: F.spark_partition_id(), _POSITION: position})
    return write_scratch(placed, "rows")


def assign_keys(
    df: DataFrame,
    natural_key: list[str],
    key: str,
    existing: DataFrame | None = None,
    start: int = 1,
) -> DataFrame:
    """The natural keys of ``df`` and of ``existing`` with one integer ``key`` each.

    Known natural keys keep their number. New ones are numbered without gaps in natural-key order
    from the highest known number on, or from ``start``. Repeats are combined before the shuffle,
    so a hot key is one row per task. Rows without a natural key get none.
    """
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in natural_key])
    fresh = df.select(*natural_key).filter(present).distinct()
    if existing is None:
        return number_rows(fresh, key, natural_key, start, unique=True)
    known = existing.select(key, *natural_key)
    highest = known.agg(F.max(key)).first()[0]
    start = start if highest is None else highest + 1
    fresh = fresh.join(known, natural_key, "left_anti")
    return known.unionByName(number_rows(fresh, key, natural_key, start, unique=True))
