from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import relational as rel
from corpusloom.streaming.intake import follow


def test_duplicates_and_conflicts(spark):
    d = spark.createDataFrame([(1, "051", "a"), (2, "051", "a"), (3, "052", "a"), (4, "052", "b"), (5, "053", None), (6, "053", None)], "seq int, id string, url string")
    kept, conflicts = rel.collapse_duplicates(d, "id", "url", ["seq"])
    assert sorted(r.seq for r in kept.collect()) == [1, 3, 4, 5]
    assert [tuple(r) for r in conflicts.collect()] == [("052", "a", "b")]


def test_missing_numbers(spark):
    d = spark.createDataFrame([("e", "716"), ("e", "718"), ("e", "1.5"), ("e", None), ("r", "4")], "s string, n string")
    assert [tuple(r) for r in rel.missing_numbers(d, ["s"], F.col("n")).collect()] == [("e", 717)]
    assert rel.missing_numbers(d.limit(0), ["s"], F.col("n")).count() == 0


def test_title_and_date(spark):
    lines = ["OFFICE OF THE MAYOR", "July 25, 1974", "VOTER ASSISTANCE", "PROGRAM -", "", "By virtue of"]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    d = text.label_lines(d).agg(F.array_sort(F.collect_list(F.struct("i", "line", "anchor"))).alias("l"))
    r = d.select(text.title_candidate(F.col("l")).alias("t"), text.extract_date(F.transform("l", lambda x: x["line"]), F.lit(1974)).alias("d")).first()
    assert tuple(r) == ("VOTER ASSISTANCE PROGRAM", "1974-07-25")


def test_intake_is_incremental(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = '{"eo_id":"%s","source_pdf_url":"u","title":"t"}\n'
    (tmp_path / "in/a.json").write_text(row % "1" + row % "1" + row % "2")
    for _ in range(2):
        follow(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/ck").awaitTermination()
    (tmp_path / "in/b.json").write_text(row % "2" + row % "3")
    follow(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.eo_id for r in spark.read.parquet(f"{tmp_path}/table").collect()) == ["1", "2", "3"]


def test_missing_numbers_by_slots(spark):
    """A hot series over many slots, gaps within and between slots, slot ends, repeats, null and odd labels."""
    import random

    from pyspark.sql import functions as F

    from corpusloom.operators import relational as rel

    r = random.Random(4)
    own = {"hot": r.sample(range(100_000, 300_000), 150_000), "ends": [0, 1, 32767, 32768, 65535, 65537, 131071], "one": [7], "two": [32767, 32769], None: [3, 6]}
    rows = [(k, str(n)) for k, numbers in own.items() for n in numbers] + [("hot", "100000")] * 5 + [("two", None), ("two", "x1"), ("two", " 032770 "), ("none", "1.5")]
    own["hot"].append(100_000)
    own["two"].append(32770)
    got = rel.missing_numbers(spark.createDataFrame(rows, "s string, n string"), ["s"], F.col("n"))
    want = {(k, n) for k, numbers in own.items() for n in set(range(min(numbers), max(numbers))) - set(numbers)}
    found = [tuple(x) for x in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_lookup_of_keys_is_not_in_its_sorts(spark):
    """A key is worked out once a row: none of its regular expressions stands in a sort or a join, which would run them for every comparison."""
    hits = spark.createDataFrame([(f"http://WWW1.nyc.gov:80/{i}.PDF", 2 * i) for i in range(6)], "original string, n int")
    hits = hits.selectExpr("original", "TIMESTAMP '2020-01-01 00:00:00' AS timestamp", "'application/pdf' AS mimetype", "200 AS statuscode", "'d' AS digest")
    rows = spark.createDataFrame([(1, ["https://nyc.gov/9.pdf", "https://nyc.gov/4.pdf"]), (1, []), (None, None), (2, ["https://nyc.gov/5.pdf"])], "id int, c array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rel.first_hit(rows, F.col("c"), hits)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not [x for x in plan.splitlines() if ("Sort [" in x or "SortMergeJoin" in x) and "regexp" in x]
        got = [(r.id, r.candidate, r.original) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got, key=str) == sorted([
        (1, "https://nyc.gov/4.pdf", "http://WWW1.nyc.gov:80/4.PDF"), (1, None, None), (None, None, None), (2, "https://nyc.gov/5.pdf", "http://WWW1.nyc.gov:80/5.PDF"),
    ], key=str)
