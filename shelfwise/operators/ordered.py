"""Running totals and positions in an order, for groups of any size.

A window over a group needs the whole group in one task. Here the rows are range-partitioned by (group, order)
into slices instead, so a group spreads over as many slices as it has rows for. The slice number is fixed by a
reliable checkpoint; sums per (group, slice) give each slice its starting value, and only the rest is a window,
over at most one slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.checkpoints import checkpoint


def slices_of(df: DataFrame) -> int:
    """Default number of slices: the session's shuffle parallelism."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """Range-partition by group and order and add the fixed slice number ``_slice``."""
    ranged = df.repartitionByRange(slices or slices_of(df), *[F.col(k) for k in keys], *order)
    return checkpoint(ranged.withColumn("_slice", F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    position: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add running sums up to and including the row, group totals, and the 1-based position.

    ``order`` must be total within a group for repeatable results. ``sums`` and ``totals`` map output names to
    numeric columns.
    """
    sums, totals = dict(sums or {}), dict(totals or {})
    if position:
        sums[position] = F.lit(1).cast("bigint")
    cut = sliced(df, keys, order, slices)

    per_slice = cut.groupBy(*keys, "_slice").agg(
        *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()],
        *[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()],
    )
    # A group has at most one row per slice here, so these windows are small whatever the group size.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = per_slice.select(
        *keys, "_slice", F.lit(0).alias("_row"),
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_v_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(whole).alias(f"_t_{n}") for n in totals],
    )
    # The starting values enter as one more row in front of each slice: no join, one shuffle.
    rows = cut.withColumns({"_row": F.lit(1), **{f"_v_{n}": c for n, c in sums.items()}})
    slice_rows = Window.partitionBy(*keys, "_slice").orderBy("_row", *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = rows.unionByName(starts, allowMissingColumns=True).withColumns({
        **{n: F.sum(f"_v_{n}").over(slice_rows) for n in sums},
        **{n: F.first(f"_t_{n}").over(slice_rows) for n in totals},
    })
    return summed.filter(F.col("_row") == 1).select(*df.columns, *sums, *totals)


def running_share(
    df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], out: str, decimal: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Cumulative share of ``value`` within the group, largest values first, ties by ``tie``.

    Sums are ``decimal(38,16)``, so the result does not depend on the order of additions or the number of slices; it is
    NULL when the total is NULL or 0. With ``decimal`` the ratio is decimal too and has 6 digits.
    """
    order = [F.col(value).desc(), *[F.col(t).asc() for t in tie]]
    amount = F.col(value).try_cast("decimal(38,16)")
    summed = running(df, keys, order, {"_run": amount}, {"_all": amount}, slices=slices)
    if decimal:
        ratio = F.try_divide("_run", "_all").cast("decimal(38,6)")
    else:
        ratio = F.try_divide(F.col("_run").cast("double"), F.col("_all").cast("double"))
    return summed.withColumn(out, ratio.cast("double")).drop("_run", "_all")


def renumber(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, slices: int | None = None
) -> DataFrame:
    """Number the rows of a group from 1."""
    numbered = running(df.drop(out), keys, order, position="_position", slices=slices)
    return numbered.withColumn(out, F.col("_position").cast("int")).select(*df.columns) \
        if out in df.columns else numbered.withColumnRenamed("_position", out)


def first_by_key(df: DataFrame, key: str, n: int, slices: int | None = None) -> DataFrame:
    """The ``n`` rows with the smallest ``key``, which must be unique; all rows if there are fewer.

    Positions are worked out on the key alone, slice by slice; the rows themselves only pass a semi-join.
    """
    numbered = running(df.select(key), [], [F.col(key)], position="_position", slices=slices)
    return df.join(numbered.filter(F.col("_position") <= n).select(key), key, "left_semi").select(*df.columns)
