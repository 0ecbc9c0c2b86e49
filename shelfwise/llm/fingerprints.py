"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has buckets of ``TABLES * CELLS`` cells; bits of a paragraph's digest name the bucket and one cell in each of
the bucket's tables. A cell holds the number of its digests, their exclusive or, and that of their check values. Two
versions' sketches subtract cell by cell, so that paragraphs of both vanish; cells with one digest left give it away
and take it out of its other cells, until nothing is left. When some remains, both sketches are made four times as
large and subtracted again; beyond ``MAX_LEVEL`` sketches the digests themselves are compared.

Everything is built from array functions of one row: no Python, and no shuffle.

A paragraph is a line; a line longer than ``LONGEST`` code points counts as several. Repeated paragraphs count once.

Defined cases: null counts as empty text; an empty text has an empty sketch, is wholly like another empty one and
unlike all others; equal texts have equal fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import text_of
from .files import range_limits, shard_of

LONGEST = 256
TABLES, CELLS, CELL_BITS = 4, 8, 3
# Paragraphs that one bucket is made for; buckets grow by four a level.
PER_BUCKET, BUCKET_BITS, MAX_LEVEL = 20, 2, 9
ROUNDS = 16
LEAST_KEY = -(2**63)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), then), 0)


def digests_of(text: Column | str) -> Column:
    """Sorted distinct 64-bit digests of the paragraphs."""
    parts = F.regexp_extract_all(text_of(text), F.lit(f"[^\\n]{{1,{LONGEST}}}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))))


def _check(digest: Column) -> Column:
    return F.hash(digest)


def _bits(digest: Column, shift: Column | int, width: int) -> Column:
    shift = F.lit(shift) if isinstance(shift, int) else shift
    return F.call_function("shiftrightunsigned", digest, shift.cast("int")).bitwiseAND(F.lit(2**width - 1))


def _empty() -> Column:
    return F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("c"))


def _add(cell: Column, n: Column, digest: Column) -> Column:
    return F.struct((cell["n"] + n).alias("n"), cell["k"].bitwiseXOR(digest).alias("k"),
                    cell["c"].bitwiseXOR(_check(digest)).alias("c"))


def _in_cell(digest: Column, cell: Column) -> Column:
    """Whether a digest belongs to a cell, numbered table by table."""
    shift = F.call_function("shiftright", cell, F.lit(CELL_BITS)) * CELL_BITS
    return _bits(digest, shift, CELL_BITS) == cell.bitwiseAND(F.lit(CELLS - 1))


def sketch(digests: Column) -> Column:
    """The cells of one bucket."""
    return F.transform(F.sequence(F.lit(0), F.lit(TABLES * CELLS - 1)), lambda i: F.aggregate(
        digests, _empty(), lambda cell, x: F.when(_in_cell(x, i), _add(cell, F.lit(1), x)).otherwise(cell)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: F.struct(
        (p["n"] - q["n"]).alias("n"), p["k"].bitwiseXOR(q["k"]).alias("k"), p["c"].bitwiseXOR(q["c"]).alias("c")))


def peel(cells: Column) -> Column:
    """``(first, second, rest)``: the digests of either version alone, and whether some could not be recovered."""
    none = F.array().cast("array<bigint>")

    def one_round(state: Column, _: Column) -> Column:
        single = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["c"]))
        found = F.array_distinct(F.transform(single, lambda c: F.struct(c["n"].alias("n"), c["k"].alias("k"))))
        return let(found, lambda f: F.when(F.size(f) == 0, state).otherwise(F.struct(
            F.transform(state["cells"], lambda cell, i: F.aggregate(
                f, cell, lambda c, p: F.when(_in_cell(p["k"], i), _add(c, -p["n"], p["k"])).otherwise(c))
            ).alias("cells"),
            F.concat(state["first"], F.transform(F.filter(f, lambda p: p["n"] == 1), lambda p: p["k"])).alias("first"),
            F.concat(state["second"], F.transform(F.filter(f, lambda p: p["n"] == -1), lambda p: p["k"])).alias("second"),
        )))

    begin = F.struct(cells.alias("cells"), none.alias("first"), none.alias("second"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, one_round, lambda s: F.struct(
        s["first"].alias("first"), s["second"].alias("second"),
        F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0)).alias("rest")))


def buckets(digests: Column, level: Column) -> Column:
    """The digests dealt to the ``4 ** level`` buckets of a level: each level splits the buckets of the one before."""
    levels = F.when(level > 0, F.sequence(F.lit(1), level)).otherwise(F.array().cast("array<int>"))
    first_bit = TABLES * CELL_BITS - BUCKET_BITS
    return F.aggregate(levels, F.array(digests), lambda parts, l: F.flatten(F.transform(parts, lambda part: F.transform(
        F.sequence(F.lit(0), F.lit(2**BUCKET_BITS - 1)),
        lambda v: F.filter(part, lambda x: _bits(x, l * BUCKET_BITS + first_bit, BUCKET_BITS) == v)))))


def level_for(paragraphs: Column) -> Column:
    """The smallest level whose buckets are made for so many paragraphs."""
    level = F.lit(MAX_LEVEL)
    for at in reversed(range(MAX_LEVEL)):
        level = F.when(paragraphs <= PER_BUCKET * 4**at, F.lit(at)).otherwise(level)
    return level


def fingerprint(digests: Column) -> Column:
    """The sketch in text form, at the size that its own number of paragraphs asks for."""
    cells = F.flatten(F.transform(buckets(digests, level_for(F.size(digests))), sketch))
    return F.array_join(F.transform(cells, lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(F.concat(
        F.hex(c["n"]), F.lit(":"), F.hex(c["k"]), F.lit(":"), F.hex(c["c"])))), ".")


def difference(a: Column, b: Column) -> Column:
    """``(first, second)``: digests that only one of two versions has, recovered from their subtracted sketches."""
    def attempt(state: Column) -> Column:
        level = state["level"]
        peeled = F.zip_with(buckets(a, level), buckets(b, level), lambda x, y: peel(subtract(sketch(x), sketch(y))))
        return let(peeled, lambda p: F.struct(
            (level + 1).alias("level"), (~F.exists(p, lambda x: x["rest"])).alias("done"),
            F.flatten(F.transform(p, lambda x: x["first"])).alias("first"),
            F.flatten(F.transform(p, lambda x: x["second"])).alias("second")))

    none = F.array().cast("array<bigint>")
    begin = F.struct(level_for(F.greatest(F.size(a), F.size(b))).alias("level"), F.lit(False).alias("done"),
                     none.alias("first"), none.alias("second"))
    tried = F.aggregate(
        F.sequence(F.lit(0), F.lit(MAX_LEVEL)), begin,
        lambda s, _: F.when(s["done"] | (s["level"] > MAX_LEVEL), s).otherwise(attempt(s)))
    return let(tried, lambda s: F.when(s["done"], F.struct(s["first"].alias("first"), s["second"].alias("second")))
               .otherwise(F.struct(F.array_except(a, b).alias("first"), F.array_except(b, a).alias("second"))))


def likeness(a: Column, b: Column) -> Column:
    """Shared paragraphs by all paragraphs of two versions, from the difference of their sketches."""
    total = F.size(a) + F.size(b)
    apart = let(difference(a, b), lambda d: F.size(d["first"]) + F.size(d["second"]))
    return F.when(total == 0, F.lit(1.0)).otherwise(
        let(apart, lambda d: (total - d).cast("double") / (total + d).cast("double")))


def with_next(docs: DataFrame, doc_id: str, text: str, rows_per_block: int) -> DataFrame:
    """``doc_id, text, digests`` and ``next_text, next_digests`` of the next document in descending order of id.

    The last is followed by the first. Rows are dealt to blocks of ids; the first row of a block also goes to the end
    of the block before it, so that every row finds the next one in its own block and texts move once.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(LEAST_KEY))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    limits = range_limits(rows.select("doc_id"), key, rows_per_block)
    top = rows.agg(F.max(key).alias("top")).first()["top"]
    own, above = shard_of(key, limits), shard_of(F.least(key, F.lit(2**63 - 2)) + 1, limits)
    place = F.struct(own.alias("block"), F.lit(0).alias("copy"))
    places = F.concat(
        F.array(place),
        F.when(own != above, F.array(F.struct(above.alias("block"), F.lit(1).alias("copy")))).otherwise(F.array()),
        F.when(key == F.lit(top), F.array(F.struct(F.lit(0).alias("block"), F.lit(2).alias("copy")))).otherwise(F.array()))
    order = Window.partitionBy("block").orderBy("copy", F.col("key").desc(), "text")
    return (
        rows.withColumn("digests", digests_of("text")).withColumn("key", key)
        .withColumn("place", F.explode(places)).withColumns({"block": F.col("place.block"), "copy": F.col("place.copy")})
        .select("doc_id", "text", "digests", "key", "block", "copy",
                F.lead("text").over(order).alias("next_text"), F.lead("digests").over(order).alias("next_digests"))
        .filter("copy = 0").drop("key", "block", "copy")
    )


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_block: int = 2000,
) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many of the next
    document, in descending order of id.
    """
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(docs, doc_id, text, rows_per_block).select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "digests", "next_digests")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "digests", "next_digests",
                       digests_of("edited").alias("edited_digests"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("digests")).alias("fingerprint"),
        fingerprint(F.col("edited_digests")).alias("edited_fingerprint"),
        likeness(F.col("digests"), F.col("edited_digests")).alias("near_edited"),
        likeness(F.col("digests"), F.col("next_digests")).alias("near_next"))
