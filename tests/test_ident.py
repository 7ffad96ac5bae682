from pyspark.sql import functions as F

from corpusloom.functions import ident


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


def test_mint(spark):
    rows = [(2026, "1.37", True, "2026-EEO-1.37"), (2026, "17", False, "2026-EO-017"), (2026, "08", False, "2026-EO-008"),
            (2024, None, False, "2024-EO-UNK"), (2020, "1234", False, "2020-EO-1234")]
    d = spark.createDataFrame(rows, "y int, n string, e boolean, want string")
    got = d.select("want", ident.mint_id(F.col("y"), F.col("n"), F.col("e")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_titles(spark):
    want = {"EEO 131 - x": ("eeo", "131"), "Executive Order No. 40": ("eo", "40"), "Executive Orders and Memoranda": ("volume", None), "Hotel #55": ("unparsed", None)}
    for t, w in want.items():
        assert tuple(one(spark, t, ident.title_kind)) == w


def test_filenames(spark):
    assert tuple(one(spark, "http://h/2020EEO015.pdf", ident.filename_identity)) == (2020, "015", True)
    assert one(spark, "http://h/readme.txt", ident.filename_identity) is None
    assert tuple(one(spark, "/executive-orders/2018/eo-34.pdf", ident.assets_identity)) == (2018, "34", False)
    for bad in ("/executive-orders/2016/mpo-2016-1.pdf", "/executive-orders/2016/eo-45.pdf.105", "/x/eo-1.pdf"):
        assert one(spark, bad, ident.assets_identity) is None


def test_dates_and_numbers(spark):
    assert one(spark, "January 5, 2024", ident.parse_article_date) == "2024-01-05"
    assert one(spark, "soon", ident.parse_article_date) is None
    assert [one(spark, n, ident.norm_number) for n in ("008", "01.07", "A1")] == ["8", "1.07", "A1"]
