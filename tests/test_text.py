from pyspark.sql import functions as F

from loomstat.functions import text as X


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()[0]


def test_normalize_text_splits_at_vowel_signs_unless_strict(spark):
    assert one(spark, "গাজীপুর", X.normalize_text) == "গ জ প র"
    assert one(spark, "গাজীপুর", lambda c: X.normalize_text(c, strict_marks=True)) == "গাজীপুর"
    assert one(spark, "  A.B-C (Pvt.)  Ltd ", X.normalize_text) == "a b c pvt ltd"
    assert one(spark, None, X.normalize_text) == ""


def test_company_core(spark):
    assert one(spark, "Acme Textiles Industries (Pvt.) Ltd.", X.company_core) == "acme textiles"
    assert one(spark, "Group Ltd", X.company_core) == ""


def test_admin_name(spark):
    assert one(spark, "Cox’s Bazar  Zilla", X.admin_name) == "coxs bazar"
    assert one(spark, "Ｇａｚｉｐｕｒ District", X.admin_name) == "gazipur"


def test_numbers(spark):
    assert one(spark, "১,২০০ জন", X.parse_int) == 1200
    assert one(spark, "none", X.parse_int) is None
    assert one(spark, "2.5 million pcs/year", X.parse_number) == 2_500_000
    assert one(spark, "300 machines", X.parse_number) == 300
    assert one(spark, "300 machines", lambda c: X.parse_number(c, legacy_scale=True)) == 300_000_000
    assert one(spark, "2.5 million pcs/year", X.capacity_unit) == "pcs/year"
    assert one(spark, "500 kg/day", X.capacity_unit) == "kg/day"


def test_lists_and_codes(spark):
    assert one(spark, "Shirts; shirts , Pants|Socks", X.split_list) == ["Shirts", "Pants", "Socks"]
    assert one(spark, "6109, 6110; 6203 6109 12 12345678901", X.product_codes) == ["6109", "6110", "6203"]


def test_instants(spark):
    at = lambda s: one(spark, s, lambda c: F.date_format(X.parse_instant(c), "yyyy-MM-dd HH:mm"))
    assert at("2026-03-01T06:00:00+06:00") == "2026-03-01 00:00"
    assert at("2026/03/01") == "2026-03-01 00:00"
    assert at("01-03-2026") == at("1/3/2026") == "2026-03-01 00:00"
    assert at("2026-08") == "2026-08-01 00:00"
    assert at("2026") is None and at("") is None and at("2026-13-01") is None


def test_rounding_to_even_equals_python(spark):
    values = [(1 / 3 * 100,), (2.00005,), (66.66665,), (None,)]
    got = [r[0] for r in spark.createDataFrame(values, "c double").select(X.round_to_even_4("c")).collect()]
    assert got == [None if v is None else round(v, 4) for (v,) in values]


def test_urls(spark):
    assert one(spark, "https://x.y/member/12?a=1", lambda c: X.url_key(c, "member")) == "12"
    assert one(spark, "https://x.y/l?page=3", X.url_page) == 3
    assert one(spark, "https://x.y/l", X.url_page) == 1
    assert one(spark, "https://x.y/l?a=b&page=3&c=d", lambda c: X.set_page(c, F.lit(9))) == "https://x.y/l?a=b&page=9&c=d"
    assert one(spark, "https://x.y/l?a=b#t", lambda c: X.set_page(c, F.lit(9))) == "https://x.y/l?a=b&page=9"
    allowed = lambda u: one(spark, u, lambda c: X.url_allowed(c, ["x.y"], ["/l"]))
    assert allowed("https://x.y/list") and not allowed("http://x.y/list") and not allowed("https://z.y/list") and not allowed("https://x.y/a")


def test_spread_pages(spark):
    got = spark.createDataFrame([(4166, 150), (0, 5), (20, 100), (90, 10_000)], "t int, w int").select(X.spread_pages(F.col("t"), F.col("w"), 30)).collect()
    assert [r[0] for r in got] == [[1, 35, 70, 105, 139], [], [1], [1, 2, 3]]


def test_locations_and_families(spark):
    assert tuple(one(spark, "Road 1, Sreepur, Gazipur, Dhaka", X.location_parts)) == ("Sreepur", "Gazipur", "Dhaka")
    assert tuple(one(spark, "Gazipur, Dhaka", X.location_parts)) == (None, None, None)
    assert one(spark, "রাইস মিল", X.sector_family) == "FOOD_AGRO"
    assert one(spark, "?", X.sector_family) == "UNCLASSIFIED" and one(spark, "?", X.sampling_family) == "OTHER_MANUFACTURING"
    assert one(spark, "গাজীপুর", X.geography_group) == "CORE_DHAKA" and one(spark, None, X.geography_group) == "OTHER"
