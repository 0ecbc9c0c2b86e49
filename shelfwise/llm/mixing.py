"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the rows are ordered by key, cut into slices of the hash range
(known beforehand, as keys are uniform), and summed slice by slice: no task ever sees more than one slice, however
large the source. Whole epochs come from division; the last epoch ends at the key where the running sum of words
reaches the budget. That gives one cut per source, which every row compares with its own key: texts never move.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; rows without words are
not part of a mix; rows that repeat in full have the same key and are cut alike (the words left over by an uneven
division among them, fewer than there are copies, stay untaken); an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.checkpoints import stored
from .common import WORD, text_of

# Width of the part of a key that names its slice.
SLICE_DIGITS, SLICE_BITS = 8, 32


def size_of(text: Column | str) -> Column:
    """Number of words."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def key_of(doc_id: str, text: str, seed: int) -> Column:
    """Hash-random key: equal for equal rows only."""
    return F.md5(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), text_of(text)))


def targets(sources: DataFrame, cycle: Sequence[int], share: float, limit: float) -> DataFrame:
    """Add ``target`` to one row per source ``(source, source_size)``.

    Weights follow the code-point order of the sources. A target stops at ``limit`` times the source's size; what
    is beyond is shared again among the others by weight. With the sources in the order of cap / weight, the first
    one that its share does not fill fixes the level for itself and all after it.
    """
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    by_ratio = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        sources.withColumn("place", F.row_number().over(ordered))
        .withColumn("weight", F.element_at(weights, ((F.col("place") - 1) % len(cycle) + 1).cast("int")))
        .withColumn("cap", F.lit(float(limit)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", (
            F.lit(float(share)) * F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))
        ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))))
    )
    unfilled = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))
    return levels.withColumn("level", F.min(unfilled).over(everything)["level"]).select(
        "source", "source_size", "place",
        F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"))


def cuts(
    sized: DataFrame, cycle: Sequence[int], share: float, limit: float, slice_rows: int,
) -> DataFrame:
    """Per source of ``(source, size, key)``: sizes, target, whole epochs, and where the last epoch ends.

    ``cut_key`` is the key that holds the cut, ``cut_words`` the words that each row with that key still gives.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = stored(
        targets(per_source.select("source", "source_size"), cycle, share, limit).join(
            per_source.select(F.col("source").alias("_s"), "rows"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("epochs", whole)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("slices", F.ceil(F.col("rows") / slice_rows).cast("long")), "mix-plan")

    cut_short = plan.filter("rest > 0").select(F.col("source").alias("_s"), "place", "rest", "slices")
    number = F.conv(F.substring("key", 1, SLICE_DIGITS), 16, 10).cast("long")
    keyed = (
        sized.filter("size > 0").join(cut_short, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("slice", F.shiftright(number * F.col("slices"), SLICE_BITS))
        .groupBy("place", "slice", "key", "size", "rest").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    per_slice = keyed.groupBy("place", "slice", "rest").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        per_slice.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))
        .select("place", "slice", "start")
    )
    upto = Window.partitionBy("place", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        keyed.join(crossing, ["place", "slice"])
        .withColumn("start", F.col("start") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        .filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))
        .select("place", F.col("key").alias("cut_key"),
                F.floor((F.col("rest") - F.col("start")) / F.col("copies")).cast("long").alias("cut_words"))
    )
    return stored(plan.join(cut, "place", "left").select(
        "source", "source_size", "target", "epochs", "cut_key", "cut_words"), "mix-cuts")


def _last_epoch(size: Column, key: Column, cut_key: Column, cut_words: Column) -> Column:
    """Words that a row gives in the last epoch."""
    return F.when(key < cut_key, size).when(key == cut_key, cut_words).otherwise(F.lit(0).cast("long"))


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    cycle: Sequence[int] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: int = 17,
    slice_rows: int = 50_000,
) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, taken`` (words taken, repeats counted)."""
    sized = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"),
        key_of(doc_id, text, seed).alias("key")), "mix-sizes")
    ends = cuts(sized.select("source", "size", "key"), cycle, share, limit, slice_rows).withColumnRenamed("source", "_s")
    taken = F.col("epochs") * F.col("size") + _last_epoch(
        F.col("size"), F.col("key"), F.col("cut_key"), F.col("cut_words"))
    return sized.join(ends, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source", "source_size", "target", taken.alias("taken"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    cycle: Sequence[int] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: int = 17,
    slice_rows: int = 50_000,
) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: one row per epoch, the row at the cut with its first words."""
    columns = docs.columns
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(source).alias("source"),
        size_of(text).alias("size"), key_of(doc_id, text, seed).alias("key"))
    sized = stored(whole.select("source", "size", "key"), "mix-sizes")
    ends = cuts(sized, cycle, share, limit, slice_rows).withColumnRenamed("source", "_s")
    # Each copy gives this many words: the size, or fewer at the cut.
    last = _last_epoch(F.col("size"), F.col("key"), F.col("cut_key"), F.col("cut_words"))
    copies = F.concat(
        F.array_repeat(F.col("size"), F.col("epochs").cast("int")),
        F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<bigint>")))
    lead_in = F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    first_words = F.array_join(F.slice(lead_in, F.lit(1), F.col("words").cast("int")), "")
    cut = F.when(F.col("words") < F.col("size"), first_words).otherwise(F.col(f"row.`{text}`"))
    return (
        whole.filter("size > 0").join(ends, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("words", F.explode(copies))
        .select(*[cut.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in columns])
    )
