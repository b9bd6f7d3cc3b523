"""Running values over long ordered groups without putting a group into one task.

A log has few partitions, so ``Window.partitionBy("topic", "partition")`` would sort all of it in a handful of tasks. Here
each group is cut into blocks of ``2**bits`` positions. Blocks are totalled with a partial aggregate, the totals
are scanned in two levels (at most ``2**bits`` of them per task), and every block gets one extra leading row that
carries the value reached before it. The rows themselves move once, by (group, block).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.operators.staging import small_side

DEFAULT_BITS = 20

# Positions that are instants in microseconds: a block is about 67 seconds. With 2**20, about a second, a quiet log would
# have nearly as many blocks as rows; a block still cannot hold more than 2**26 different instants.
TIME_BITS = 26

# A key is split only when it has more rows than this, so there are at most rows / HOT_ROWS such keys. Their list is staged and
# broadcast if it is small by its bytes, else joined by a shuffle.
HOT_ROWS = 1 << 20


@dataclass(frozen=True)
class Running:
    """One running value: ``combine`` is ``sum`` or ``max``; ``inclusive`` says whether the row itself counts."""

    name: str
    value: Column
    combine: str = "sum"
    inclusive: bool = True

    def over(self, column: Column) -> Column:
        return F.sum(column) if self.combine == "sum" else F.max(column)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``rows`` rows. Counting happens before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    return counts.select(*keys, F.lit(True).alias("_hot"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str | Sequence[str],
    values: Sequence[Running],
    bits: int = DEFAULT_BITS,
    split_only_hot: bool = False,
    hot_rows: int = HOT_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus one running column per entry of ``values``, per group of ``keys`` along ``order``.

    ``position`` is a bigint column that never decreases along ``order`` (an offset, a time in microseconds), or several
    columns the last of which is such a bigint within equal values of the others (partition, offset). With
    ``split_only_hot`` the groups are taken to be many and mostly short: only the hot ones are cut into blocks. Which these are is counted in ``hot_from``
    when given (a cheaper table with about as many rows per group), else in ``df``.
    Rows equal in ``order`` must be made distinct by the caller, else their relative order is open.
    """
    columns = df.columns
    keys = list(keys)
    *leading, pos = [position] if isinstance(position, str) else position
    inputs = {f"_v{i}": v.value for i, v in enumerate(values)}

    def block(shift: int) -> Column:
        number = F.shiftright(pos, shift)
        return F.struct(*leading, number.alias("_block")) if leading else number

    rows = df.withColumns({**inputs, "_b0": block(bits), "_b1": block(2 * bits)})

    if split_only_hot:
        hot = small_side(hot_keys(df if hot_from is None else hot_from, keys, hot_rows).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)}))
        # A null key may be hot too.
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        marks = [f"_k{i}" for i in range(len(keys))]
        to_total = rows.join(hot, same, "inner").drop(*marks)
        rows = rows.join(hot, same, "left").drop(*marks).withColumns(
            {"_b0": F.when(F.col("_hot"), F.col("_b0")), "_b1": F.when(F.col("_hot"), F.col("_b1"))}
        )
    else:
        to_total = rows

    def totals(source: DataFrame, by: list[str]) -> DataFrame:
        return source.groupBy(*by).agg(*[v.over(F.col(f"_v{i}")).alias(f"_v{i}") for i, v in enumerate(values)])

    def before(source: DataFrame, by: list[str], along: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("_is_row", along).rowsBetween(Window.unboundedPreceding, -1)
        return source.withColumns({f"_c{i}": v.over(F.col(f"_v{i}")).over(w) for i, v in enumerate(values)})

    def as_carry(source: DataFrame, by: list[str]) -> DataFrame:
        return source.select(*by, F.lit(0).alias("_is_row"), *[F.col(f"_c{i}").alias(f"_v{i}") for i in range(len(values))])

    blocks = totals(to_total, keys + ["_b1", "_b0"]).withColumn("_is_row", F.lit(1))
    superblocks = totals(blocks, keys + ["_b1"]).withColumn("_is_row", F.lit(1))
    super_carry = as_carry(before(superblocks, keys, "_b1"), keys + ["_b1"])
    block_rows = blocks.unionByName(super_carry, allowMissingColumns=True)
    carried = before(block_rows, keys + ["_b1"], "_b0").filter(F.col("_is_row") == 1)
    carry = as_carry(carried, keys + ["_b0"])

    stacked = rows.withColumn("_is_row", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    along = Window.partitionBy(*keys, "_b0").orderBy("_is_row", *order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excluding = along.rowsBetween(Window.unboundedPreceding, -1)
    out = stacked.withColumns(
        {v.name: v.over(F.col(f"_v{i}")).over(upto if v.inclusive else excluding) for i, v in enumerate(values)}
    )
    return out.filter(F.col("_is_row") == 1).select(*columns, *[v.name for v in values])


def running_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[Running]) -> DataFrame:
    """The same by one plain window per group: the definition :func:`running` is tested against."""
    w = Window.partitionBy(*keys).orderBy(*order)
    upto, excluding = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({v.name: v.over(v.value).over(upto if v.inclusive else excluding) for v in values})
