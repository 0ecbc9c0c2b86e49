"""Cleaning of titles, brands, URLs and flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Unicode white space, as a regular-expression character class. Fixed value.
WHITE_SPACE = r"\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# Marks that brand keys ignore. Fixed value.
BRAND_MARKS = "！!。，,、"
# Brand words that mean "no brand". Fixed values.
NO_BRAND_WORDS = ("无品牌", "其他", "other")
# Label of a brand taken from the listing instead of the annotation. Fixed value.
BRAND_CORRECTED = "因相同标题或std_brand_name为空原因修正异常std_brand_name"
# Title prefix of a part of a bundle. Fixed value.
BUNDLE_PREFIX = "（套组拆分）"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str, extra: Iterable[str] = ()) -> Column:
    """True for NULL, ``''`` and the ``extra`` markers."""
    c = col(c)
    return c.isNull() | c.isin("", *extra)


def blank_to_null(c: Column | str, extra: Iterable[str] = ("0",)) -> Column:
    return F.when(~is_blank(c, extra), col(c))


def first_non_blank(*cols: Column | str) -> Column:
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def flag(c: Column | str, values: Mapping[str, int]) -> Column:
    """Enumerated text to integer, NULL for any other text."""
    out = F.lit(None).cast("int")
    for text, number in values.items():
        out = F.when(col(c) == text, F.lit(number)).otherwise(out)
    return out


def clean_text(*cols: Column | str) -> Column:
    """First non-NULL value without line breaks and outer blanks; ``''`` when all are NULL."""
    return F.trim(F.regexp_replace(F.coalesce(*[col(c) for c in cols], F.lit("")), "\r|\n", ""))


def rewrite_url(c: Column | str, pattern: str, replacement: str) -> Column:
    """Regex replacement, falling back to the input where nothing would be left."""
    return F.coalesce(F.nullif(F.regexp_replace(col(c), pattern, replacement), F.lit("")), col(c))


def image_list(a: Column | str, b: Column | str, sep: str = " | ") -> Column:
    """Two separated image lists as one JSON array string; equal inputs are kept once."""
    a, b = col(a), col(b)
    parts_a, parts_b = (F.split(x, sep.replace("|", "\\|")) for x in (a, b))
    return F.to_json(
        F.when(a == b, parts_a)
        .when(a.isNotNull() & b.isNotNull(), F.concat(parts_a, parts_b))
        .otherwise(F.coalesce(parts_a, parts_b))
    )


def image_list_plain(a: Column | str, b: Column | str) -> Column:
    """The unquoted variant: ``[a,b]`` with every ``|`` turned into a comma."""
    joined = F.concat_ws(",", *[F.replace(col(x), F.lit("|"), F.lit(",")) for x in (a, b)])
    return F.when(col(a).isNotNull() | col(b).isNotNull(), F.concat(F.lit("["), joined, F.lit("]")))


def sku_title(item_title: Column | str, sku_name: Column | str) -> Column:
    """Item title, followed by the SKU title when there is one."""
    item = F.coalesce(col(item_title), F.lit(""))
    return F.when(~is_blank(sku_name, ("null",)), F.concat(item, F.lit(" "), col(sku_name))).otherwise(item)


def part_title(
    spu: Column | str, weight: Column | str, unit: Column | str, packages: Column | str, parts: Column | str
) -> Column:
    """Name, weight, unit and packages of one annotated part; prefixed when the listing has several parts.

    Weight, unit and packages only appear when the weight is known; the name is NULL when one of the other
    parts that must appear is.
    """
    known = col(weight).isNotNull()
    name = F.concat(
        col(spu),
        F.when(known, col(weight).cast("string")).otherwise(""),
        F.when(known, col(unit)).otherwise(""),
        F.when(known, col(packages).cast("string")).otherwise(""),
    )
    return F.when(col(parts) == 1, name).otherwise(F.concat(F.lit(BUNDLE_PREFIX), name))


def standard_sku_name(spu: Column | str, weight: Column | str, unit: Column | str | None = None) -> Column:
    """``spu`` + rounded weight (half to even) + unit (``ml`` if unknown); NULL without a usable name or weight."""
    unit = F.lit("ml") if unit is None else F.coalesce(col(unit), F.lit("ml"))
    usable = ~is_blank(spu) & (F.lower(col(spu)) != "others") & col(weight).isNotNull()
    return F.when(usable, F.concat(col(spu), F.bround(col(weight)).cast("bigint").cast("string"), unit))


def gram_sku_name(spu: Column | str, weight: Column | str) -> Column:
    """``spu`` + whole grams (truncated) + ``g``; NULL when either is NULL."""
    return F.concat(col(spu), col(weight).cast("double").cast("int").cast("string"), F.lit("g"))


def display_title(
    standard_name: Column | str, platform: Column | str, sku_name: Column | str, item_title: Column | str
) -> Column:
    """Standard name if any; on two platforms SKU title + item title; else the item title."""
    both = F.concat(F.coalesce(col(sku_name), F.lit("")), F.coalesce(col(item_title), F.lit("")))
    return F.coalesce(
        F.nullif(col(standard_name), F.lit("")),
        F.when(F.lower(col(platform)).isin("tmall", "jd"), both).otherwise(col(item_title)),
    )


def collapse_space(c: Column | str) -> Column:
    """Runs of white space to one blank, outer white space removed, NULL to ``''``."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), f"[{WHITE_SPACE}]+", " "))


def text_fingerprint(a: Column | str, b: Column | str) -> Column:
    """md5 of two white-space-normalised texts joined by ``_``."""
    return F.md5(F.concat(collapse_space(a), F.lit("_"), collapse_space(b)))


def cache_key(c: Column | str) -> Column:
    return F.md5(col(c))


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC form. Spark has no such function; see :func:`nfkc_in_market` for tables."""

    # Nested, so that it travels by value and executors need no copy of this package.
    @F.pandas_udf("string")
    def normalise(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFKC")

    return normalise(col(c))


def nfkc_in_market(df: DataFrame, names: Sequence[str], market: str, wanted: str = "JP") -> DataFrame:
    """NFKC of text columns in one market only.

    Only the distinct texts of that market with other than ASCII characters go to Python, once each for all columns;
    the rows take theirs by a null-safe join, which adaptive execution can split at a hot text.
    """
    def needed(name: str) -> Column:
        return F.when((F.col(market) == wanted) & F.col(name).rlike(r"[^\x00-\x7F]"), F.col(name))

    texts = df.select(F.explode(F.array(*[needed(n) for n in names])).alias("_text")).filter("_text IS NOT NULL").distinct()
    normal = texts.select("_text", nfkc("_text").alias("_normal"))
    out = df
    for name in names:
        on = needed(name).eqNullSafe(F.col("_text"))
        out = out.join(normal, on, "left").withColumn(name, F.coalesce("_normal", name)).drop("_text", "_normal")
    return out.select(*df.columns)


def brand_key(c: Column | str) -> Column:
    """Comparison key of a brand: lower case, without marks and white space."""
    return F.regexp_replace(F.lower(col(c)), f"[{BRAND_MARKS}{WHITE_SPACE}]", "")


def arbitrated_brand(
    annotated: Column | str, listed: Column | str, item_title: Column | str, sku_name: Column | str
) -> tuple[Column, Column]:
    """The annotated brand if the listing supports it, else the listed one; and a label when it was replaced.

    Supported means: the first Latin or the first Chinese run of the annotated brand occurs in item title + SKU
    title + listed brand (any case), or the listed brand is blank or says "no brand".
    """
    ai, raw = col(annotated), col(listed)
    text = F.lower(F.concat(col(item_title), F.coalesce(col(sku_name), F.lit("")), F.coalesce(raw, F.lit(""))))

    def occurs(run: str) -> Column:
        token = F.lower(F.regexp_extract(ai, run, 0))
        return F.coalesce((token != "") & F.contains(text, token), F.lit(False))

    no_brand = reduce(lambda a, b: a | b, [F.contains(F.lower(raw), F.lit(w)) for w in NO_BRAND_WORDS])
    supported = occurs("[a-zA-Z]+") | occurs("[一-龥]+") | is_blank(raw) | no_brand
    chosen = F.coalesce(F.when(supported, ai).otherwise(raw), raw)
    return F.upper(chosen), F.when(ai != chosen, F.lit(BRAND_CORRECTED))
