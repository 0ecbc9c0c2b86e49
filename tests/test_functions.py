"""Column functions on hand-made values."""

from pyspark.sql import functions as F

from shelfwise.functions import crawl as C, jsons as J, keys as K, measures as M, text as T
from shelfwise.operators.joins import period_before


def values(spark, columns, schema, *exprs):
    """Rows of expressions over literal rows, in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(columns)], "row_no int, " + schema)
    out = df.select("row_no", *[e.alias(f"e{n}") for n, e in enumerate(exprs)]).orderBy("row_no").collect()
    return [tuple(r)[1:] if len(exprs) > 1 else r[1] for r in out]


def test_sales_text(spark):
    cases = [
        ("過去1か月で50点以上購入", "jp", 50), ("過去1か月で1.5万点以上購入", "JP", 15000), ("50点", "JP", None),
        ("1.5K+ bought", "us", 1500), ("3 mil vendidos", "MX", 3000), ("2w+", "CN", 20000), ("1,500+ bought", "US", 1),
        ("none", "US", None), (None, "US", None), ("700", None, None), ("12.6", "US", 13),
    ]
    got = values(spark, [c[:2] for c in cases], "t string, r string", C.parse_sales_text("t", "r"))
    assert got == [c[2] for c in cases]


def test_sales_text_with_commas(spark):
    assert values(spark, [("1,500+ bought", "US")], "t string, r string",
                  C.parse_sales_text("t", "r", strip_commas=True)) == [1500]


def test_sales_suffix(spark):
    cases = [("1.5k", 1500.0), ("2W ", 20000.0), ("30", 30.0), ("1k+", None), ("about 5", None), (None, None)]
    assert values(spark, [c[:1] for c in cases], "t string", C.parse_sales_suffix("t")) == [c[1] for c in cases]


def test_region(spark):
    cases = [
        ("fr", "https://www.x.com/", "FR"), ("", "https://www.x.com/a", "US"), (None, "https://www.x.co.jp/a", "JP"),
        (None, "https://www.x.de", "DE"), (None, None, "US"), (None, "no url", "US"), (None, "https://x.com:80/", ""),
    ]
    got = values(spark, [c[:2] for c in cases], "j string, u string", C.region_of("j", "u"))
    assert got == [c[2] for c in cases]


def test_split_path(spark):
    made = C.split_path("p", "c")
    got = values(spark, [("a>b > c", "top"), ("", "top"), (None, None), ("one", "t")], "p string, c string",
                 *[made[k] for k in ("category_name", "category_1_name", "category_2_name", "category_3_name", "category_9_name")])
    assert got == [(" c", "top", "a", "b ", None), (None, "top", None, None, None), (None,) * 5,
                   ("one", "t", "one", None, None)]


def test_json(spark):
    got = values(spark, [('{"a|b":"x","n":{"q":1}}', 'say "hi"')], "j string, v string", J.json_field("j", "a|b"),
                 J.json_build(k="v", other=F.lit(None).cast("string")), J.json_build_if_any(k=F.lit("")))
    assert got == [("x", '{"k":"say \\"hi\\"","other":""}', None)]


def test_blanks_flags_images(spark):
    got = values(spark, [("0", "a | b", "a | b"), ("", None, "c"), (None, "a | b", "c"), ("x", None, None)],
                 "c string, a string, b string", T.blank_to_null("c"), T.image_list("a", "b"),
                 T.image_list_plain("a", "b"), T.flag("c", {"x": 1, "0": 0}))
    assert got == [(None, '["a","b"]', "[a , b,a , b]", 0), (None, '["c"]', "[c]", None),
                   (None, '["a","b","c"]', "[a , b,c]", None), ("x", None, None, 1)]


def test_titles(spark):
    got = values(spark, [("spu", 2.5, "Tmall", "p", "i"), ("others", 2.0, "jd", None, "i"), (None, 1.0, "PDD", "p", "i"),
                         ("spu", 3.5, "x", "", None)],
                 "s string, w double, pl string, p string, i string", T.standard_sku_name("s", "w"),
                 T.display_title(T.standard_sku_name("s", "w"), "pl", "p", "i"), T.sku_title("i", "p"),
                 T.gram_sku_name("s", "w"))
    assert got == [("spu2ml", "spu2ml", "i p", "spu2g"), (None, "i", "i", "others2g"), (None, "i", "i p", None),
                   ("spu4ml", "spu4ml", "", "spu3g")]


def test_fingerprint_ignores_white_space(spark):
    got = values(spark, [(" a\t\n b　c ", None), ("a b c", ""), ("abc", "")], "a string, b string",
                 T.text_fingerprint("a", "b"))
    assert got[0] == got[1] != got[2]


def test_nfkc_only_in_market(spark):
    rows = [(1, "ＡＢＣ①", "JP"), (2, "ＡＢＣ", "US"), (3, "abc", "JP"), (4, None, "JP"), (5, "ｶﾞ", "JP"), (6, "ＡＢＣ①", "JP")]
    df = T.nfkc_in_market(spark.createDataFrame(rows, "n int, b string, m string"), ["b"], "m")
    assert [r.b for r in df.orderBy("n").collect()] == ["ABC1", "ＡＢＣ", "abc", None, "ガ", "ABC1"]


def test_brand_key_and_arbitration(spark):
    assert values(spark, [("A！ b。C,、　",)], "b string", T.brand_key("b")) == ["abc"]
    brand, label = T.arbitrated_brand("ai", "raw", "t", "p")
    rows = [("Acme 品牌", "raw", "ACME soap", None), ("Acme", "raw", "soap", None), ("品牌", "raw", "x", "有品牌"),
            ("Acme", None, "soap", None), ("Acme", "No Other", "soap", None), (None, "raw", "soap", None),
            ("Acme", "raw", None, "acme")]
    got = values(spark, rows, "ai string, raw string, t string, p string", brand, label)
    assert got == [("ACME 品牌", None), ("RAW", T.BRAND_CORRECTED), ("品牌", None), ("ACME", None), ("ACME", None),
                   ("RAW", None), ("RAW", T.BRAND_CORRECTED)]


def test_unit_weight(spark):
    made = M.unit_weight("w", "n", 100)
    got = values(spark, [(150.0, 2), (300.0, 2), (None, None), (10.0, 0)], "w double, n int",
                 *[made[k] for k in ("package", "weight", "total_weight", "total_weight_src")])
    assert got == [(2, 75.0, 150.0, M.WEIGHT_MEASURED), (2, None, None, "超过阈值100g"),
                   (1, 0.0, 0.0, M.WEIGHT_DERIVED), (0, None, None, "超过阈值100g")]


def test_single_part(spark):
    made = M.single_part_defaults("n", "own", "grp", "fix", "val", "ratio", "src")
    got = values(spark, [(1, 2.0, 9.0, 5.0, 7.0, 0.5, "r"), (2, 2.0, None, 5.0, 7.0, 0.5, "r")],
                 "n int, own double, grp double, fix double, val double, ratio double, src string", *made.values())
    assert got == [(2.0, 7.0, 1.0, M.SINGLE_PART), (5.0, None, 0.5, "r")]


def test_part_key_tells_parts_apart(spark):
    rows = [("Tmall", None, "1", "2", "2024-01-01", None, 1), ("Tmall", "cn", "1", "2", "2024-01-01", "0", 1),
            ("Tmall", "cn", "1", "2", "2024-01-01", "0", 2)]
    got = values(spark, rows, "platform string, market string, item_id string, pfsku_id string, month_dt string, shop_id string, "
                 "n int", K.part_key(part="n"))
    assert got[0] == got[1] != got[2]


def test_period_before_keeps_the_format(spark):
    got = values(spark, [("2024-01-08",), ("20240108",)], "d string", period_before("d", 1), period_before("d", -1))
    assert got == [("2024-01-01", "2024-01-15"), ("20240101", "20240115")]
