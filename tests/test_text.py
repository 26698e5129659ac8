from pyspark.sql import functions as F

from tillwork.functions import amounts, text, zones
from tillwork.operators import cleaning, country

def test_text_key(values):
    got = values(lambda v: text.text_key(v), ["489434", " c489449 ", "A 1", "", None, " x \t\n y\x1f"])
    assert got == ["489434", "C489449", "A_1", "", "UNKNOWN", "X_Y"]


def test_text_key_matches_python_strip_and_split(values):
    blanks = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    inputs = [f"{b}a{b}{b}b{b}" for b in blanks]
    assert values(lambda v: text.text_key(v), inputs) == ["A_B"] * len(inputs)


def test_country_key(values):
    got = values(lambda v: text.country_key(v), ["Unspecified", " united  kingdom ", None, "EIRE"])
    assert got == ["UNKNOWN", "UNITED_KINGDOM", "UNKNOWN", "EIRE"]


def test_customer_key(values):
    assert values(lambda v: text.customer_key(v), ["13085.0", "13085", None, "A.0"]) == ["13085", "13085", "UNKNOWN", "A.0"]


def test_to_number(values):
    inputs = ["1", " 2.5 ", "-3e2", "x", "", None, "1d", "1f", "0x10", "nan", "1.2.3", ".5", "5.", "-inf", "e", "+-1"]
    want = [1.0, 2.5, -300.0, None, None, None, None, None, None, None, None, 0.5, 5.0, float("-inf"), None, None]
    assert values(lambda v: text.to_number(v), inputs) == want


def test_product_words(values):
    inputs = ["CAFÉ BAG", "½ PINT", 'T-LIGHT, 9" X', "__A__", "???", None, "a  b", " x"]
    want = ["CAFE_BAG", "1_2_PINT", "T_LIGHT_9_X", "A", "UNKNOWN", "UNKNOWN", "A_B", "X"]
    assert values(lambda v: text.product_words(v), inputs) == want


def test_product_words_whole_documents_match_python(spark):
    import re
    import unicodedata

    def plain(t):
        t = re.sub(r"[^\w]", "_", unicodedata.normalize("NFKD", t))
        t = re.sub(r"_+", "_", re.sub(r"^_+|_+$", "", t))
        return t.upper() or "UNKNOWN"

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("text").alias("v"))
    for r in docs.select("v", text.product_words(F.col("v")).alias("w")).collect():
        assert r["w"] == plain(r["v"])


def test_title_words(values):
    inputs = ["O'BRIEN-land 2nd", "UNITED_KINGDOM", "_x_", "école 3D", None]
    assert values(lambda v: text.title_words(v), inputs) == [None if i is None else i.replace("_", " ").title().strip() for i in inputs]


def test_first_match_and_plain_words(values):
    assert values(lambda v: text.first_match(v, r"(\d+)"), ["C489", "abc", None]) == ["489", None, None]
    assert values(lambda v: text.plain_words(v), [" T-Light, 9\" x ", None, "é"]) == ["T_LIGHT_9_X", None, ""]


def test_stable_id_is_fixed(values):
    import hashlib

    want = [int(hashlib.md5(v.encode()).hexdigest()[:15], 16) for v in ("FRANCE", "É_x")]
    assert values(lambda v: text.stable_id(v), ["FRANCE", "É_x"]) == want


def test_utc_offset(values):
    at = F.timestamp_seconds(F.lit(1_719_792_000))
    inputs = ["Europe/London", "America/New_York", "Asia/Kolkata", "Mars/Base", None, "America/St_Johns"]
    assert values(lambda v: zones.utc_offset(at, v), inputs) == ["+0100", "-0400", "+0530", None, None, "-0230"]


def test_classify_return_sale(spark):
    rows = [("489434", 1), ("C489449", 1), ("489434", -1), ("489434", None), ("UNKNOWN", 5), ("", 5), ("489434", 0)]
    df = cleaning.classify_return_sale(spark.createDataFrame(rows, "INVOICE string, QUANTITY bigint"))
    assert [r["INVOICE_TYPE"] for r in df.collect()] == ["SALE", "RETURN", "RETURN", "SALE", "RETURN", "RETURN", "SALE"]


def test_timestamp_split(spark):
    df = spark.createDataFrame([("2009-12-01 07:45:00",), ("2010-13-99",), (None,), ("2010-01-02",)], "INVOICEDATE string")
    got = [tuple(r) for r in cleaning.coerce_timestamp_split(df).collect()]
    assert got == [("2009-12-01", "07:45:00"), (None, None), (None, None), ("2010-01-02", "00:00:00")]


def test_timestamp_split_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "INVOICEDATE string")
        assert tuple(cleaning.coerce_timestamp_split(df).first()) == ("2024-03-10", "02:30:00")
        ntz = df.select(amounts.instant(F.col("INVOICEDATE").cast("timestamp_ntz")).alias("t"))
        assert ntz.select(F.unix_seconds("t")).first()[0] == 1_710_037_800
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_country_resolve(spark):
    raw = ["EIRE", "RSA", "CHANNEL_ISLANDS", "WEST_INDIES", "UNKNOWN", "UNITED_KINGDOM", None]
    df = country.country_resolve(spark.createDataFrame([(r,) for r in raw], "COUNTRY_RAW string"))
    assert [(r[1], r[2]) for r in df.collect()] == [
        ("Ireland", "MAPPED"),
        ("Republic of South Africa", "MAPPED"),
        ("Jersey", "MAPPED"),
        ("West Indies", "MAPPED"),
        ("Unknown", "MAPPED"),
        ("United Kingdom", "EXACT"),
        (None, "INVALID"),
    ]


def test_country_enrich_uses_stand_ins(spark):
    reference = spark.createDataFrame(
        [("Dominican Republic", "Americas", "Santo Domingo", "DOM", "DOP", "America/Santo_Domingo")],
        "NAME string, CONTINENT string, CAPITAL string, ISO3 string, CURRENCY string, ZONE string",
    )
    raw = spark.createDataFrame([("WEST_INDIES",), ("NOWHERE",)], "COUNTRY_RAW string")
    got = {r["COUNTRY_RAW"]: (r["ISO3"], r["TIMEZONE"]) for r in country.new_country_metadata(raw, reference).collect()}
    assert got == {"WEST_INDIES": ("DOM", "-0400"), "NOWHERE": (None, None)}
