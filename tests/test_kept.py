"""State between runs, files by a commit protocol, sources that ask for what a filter needs."""

import json
import os
from urllib.parse import parse_qs, urlsplit

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.jobs import integrate
from corpusloom.sources import archive, commit, fetch, sinks, state, tables


def files_of(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


# Commit protocol ---------------------------------------------------------------------------------------------------


def test_files_appear_together(spark, tmp_path):
    rows = [(f"{i % 7}/f{i}.txt", f"text {i}".encode()) for i in range(200)] + [(None, b"x"), ("y", None)]
    df = spark.createDataFrame(rows, "path string, content binary").repartition(5)
    commit.write_files(df, f"{tmp_path}/out")
    want = sorted(p for p, c in rows if p and c is not None)
    assert files_of(f"{tmp_path}/out") == want and open(f"{tmp_path}/out/3/f3.txt").read() == "text 3"
    commit.write_files(df.limit(0), f"{tmp_path}/out")
    commit.write_files(spark.createDataFrame([("3/f3.txt", bytearray(b"new"))], "path string, content binary"), f"file://{tmp_path}/out")
    assert files_of(f"{tmp_path}/out") == want and open(f"{tmp_path}/out/3/f3.txt").read() == "new"


def test_failed_job_leaves_nothing(spark, tmp_path):
    """A task that fails halfway, after other tasks have written theirs."""
    root = f"{tmp_path}/out"
    bad = F.when(F.col("id") == 150, F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.lit("x").cast("binary"))
    df = spark.range(0, 200, 1, 4).select(F.concat(F.lit("a/"), F.col("id").cast("string")).alias("path"), bad.alias("content"))
    with pytest.raises(Exception, match="broken"):
        commit.write_files(df, root)
    assert files_of(root) == [] and [x for x in os.listdir(root)] == []
    for path in ("../x", "/etc/x", "a/../../x"):
        with pytest.raises(Exception, match="UnsafePath"):
            commit.write_files(spark.createDataFrame([(path, bytearray(b"x"))], "path string, content binary"), root)
    assert not os.path.exists(f"{tmp_path}/x")


def test_attempts_that_run_twice(tmp_path):
    """Two attempts of one task: only the one that is told to the driver counts, the other's files go."""
    writer = commit.FilesWriter(f"{tmp_path}/out")
    batch = lambda text: pa.RecordBatch.from_arrays([pa.array(["a/1", "b/2"]), pa.array([text, text], pa.binary())], names=["path", "content"])
    lost, kept = writer.write(iter([batch(b"lost")])), writer.write(iter([batch(b"kept")]))
    assert lost.folder != kept.folder and not os.path.exists(f"{tmp_path}/out/a")
    writer.commit([kept, None])
    assert files_of(f"{tmp_path}/out") == ["a/1", "b/2"] and open(f"{tmp_path}/out/a/1").read() == "kept"
    other = commit.FilesWriter(f"{tmp_path}/out")
    message = other.write(iter([batch(b"never")]))
    other.abort([message])
    assert files_of(f"{tmp_path}/out") == ["a/1", "b/2"] and open(f"{tmp_path}/out/a/1").read() == "kept"


# State -------------------------------------------------------------------------------------------------------------


def test_versions_and_shrinking(spark, tmp_path):
    kept = state.State(spark, str(tmp_path))
    assert kept.pointer()["version"] == 0 and kept.read("t", "a int").count() == 0
    assert kept.save({"t": spark.range(5), "u": spark.range(2)}) == 1 and kept.pointer()["counts"] == {"t": 5, "u": 2}
    old = kept.read("t", "id long")
    with pytest.raises(sinks.ShrinkError):
        kept.save({"u": spark.range(9), "t": spark.range(4)}, guarded=("t",))
    bad = spark.range(6).select(F.when(F.col("id") == 5, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        kept.save({"t": spark.range(7), "u": bad})
    assert kept.pointer()["version"] == 1 and old.count() == 5 and kept.read("u", "id long").count() == 2
    assert len([x for x in os.listdir(tmp_path) if x.startswith("v")]) == 1  # failed versions are gone
    more = state.merged(kept.read("t", "id long"), spark.range(3, 8), ["id"])
    assert kept.save({"t": more}, guarded=("t",)) == 2 and kept.read("t", "id long").count() == 8 and kept.read("u", "x int").count() == 0
    assert old.count() == 5  # a reader of the old version still has it
    kept.save({"t": spark.range(1)}, guarded=("t",), allow_shrink=True)
    kept.clear_old(2)
    assert kept.pointer()["version"] == 3 and sorted(x[:7] for x in os.listdir(tmp_path) if x.startswith("v")) == ["v000002", "v000003"]


def test_merged_replaces_by_key(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3), ("y", 4)], "k string, v int")
    b = spark.createDataFrame([(9, "y"), (8, None), (7, "z")], "v int, k string")
    assert sorted(map(str, (tuple(r) for r in state.merged(a, b, ["k"]).collect()))) == sorted(map(str, [("x", 1), ("y", 9), (None, 8), ("z", 7)]))


def test_one_job_for_a_write(spark, tmp_path):
    """The rows of a guarded write are computed once: a counter in a task sees each of them once."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(40).mapInArrow(look, "id long")
    state.State(spark, f"{tmp_path}/s").save({"t": df}, guarded=("t",))
    assert seen.value == 40
    sinks.write_json(df, f"{tmp_path}/lines", existing=spark.range(39))
    assert seen.value == 80 and spark.read.json(f"{tmp_path}/lines").count() == 40
    with pytest.raises(sinks.ShrinkError):
        sinks.write_json(spark.range(3), f"{tmp_path}/lines", existing=spark.read.json(f"{tmp_path}/lines"))
    assert spark.read.json(f"{tmp_path}/lines").count() == 40 and not os.path.exists(f"{tmp_path}/lines.new")


def test_deferred_orders_complete_in_a_later_run(spark, tmp_path):
    from corpusloom.plans.registry import CREATORS, TERMS

    inventory = spark.createDataFrame(
        [("n1", "Executive Order No. 40.", "2021-05-01", "Bill de Blasio", "f1", ""), ("c1", "EO 9", "2022-04-04", "Eric Adams", "f2", ""), ("d1", "EEO 7", "2022-03-03", "Eric Adams", "f3", "")], tables.INVENTORY
    )
    blank = dict.fromkeys([f.split()[0] for f in tables.CORPUS.split(", ")])
    have = [blank | {"eo_id": e, "number": n, "year": 2022, "mayor": "Adams", "is_emergency": s, "pdf_path": p, "full_text": "old", "supersedes": [], "superseded_by": [], "dropped_marks": []} for e, n, s, p in (("2022-EO-009", "9", False, None), ("2022-EEO-7", "7", True, "p"))]
    corpus = spark.createDataFrame([tuple(r.values()) for r in have], tables.CORPUS)

    def parse(rows):
        for c, kind in ((f.name, f.dataType) for f in corpus.schema):
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None).cast(kind))
        return rows.withColumn("full_text", F.concat(F.lit("text of "), "pdf_path")).select(*corpus.columns)

    def staged(*names):
        return spark.createDataFrame([(f, f"/s/gpp-{f}.pdf", True) for f in names], "fileset_id string, path string, valid boolean")

    kept = state.State(spark, str(tmp_path))
    read = lambda name: {r[0]: r for r in kept.read(name, "a string").collect()}
    integrate.integrate_kept(kept, integrate.items(inventory, TERMS, CREATORS), corpus, staged("f3"), parse)
    assert set(read("waiting")) == {"n1", "c1"} and {r.gpp_id for r in read("deferred").values()} == {"n1", "c1"}
    assert set(read("records")) == {"2022-EO-009", "2022-EEO-7"} and set(read("ledger")) == {"2022-EEO-7"}
    # the next run is given nothing new but the files: what waited completes
    nothing = integrate.items(inventory.limit(0), TERMS, CREATORS)
    integrate.integrate_kept(kept, nothing, corpus.limit(0), staged("f1", "f3"), parse)
    assert set(read("waiting")) == {"c1"} and read("records")["2021-EO-040"].full_text == "text of pdfs/2021/2021-EO-040.pdf"
    assert read("ledger").keys() == {"2022-EEO-7", "2021-EO-040"} and read("records")["2022-EO-009"].full_text == "old"
    integrate.integrate_kept(kept, nothing, corpus.limit(0), staged("f1", "f2", "f3"), parse)
    assert not read("waiting") and not read("deferred") and read("records")["2022-EO-009"].full_text == "text of pdfs/2022/2022-EO-009.pdf"
    assert kept.pointer()["version"] == 3 and kept.pointer()["counts"]["records"] == 3
    # given again in full, nothing is minted twice and no record changes
    before = sorted(map(str, read("records").values()))
    integrate.integrate_kept(kept, integrate.items(inventory, TERMS, CREATORS), corpus, staged("f1", "f2", "f3"), parse)
    assert sorted(map(str, read("records").values())) == before


# Pushdown ----------------------------------------------------------------------------------------------------------


def logged(folder, answer):
    """A fetcher that notes each request as a file, as it runs in other processes."""

    class Logged:
        def get_text(self, url):
            import tempfile

            fd, _ = tempfile.mkstemp(dir=folder)
            os.write(fd, url.encode())
            os.close(fd)
            return answer(url)

    return Logged


def asked(folder):
    out = [open(os.path.join(folder, f)).read() for f in os.listdir(folder)]
    for f in os.listdir(folder):
        os.remove(os.path.join(folder, f))
    return out


def test_feed_filters_decide_what_is_fetched(spark, tmp_path):
    def answer(url):
        q = parse_qs(urlsplit(url).query)
        year, page = q["fromDate"][0][:4], q["currentPage"][0]
        return json.dumps({"totalPages": 3, "results": [{"link": "/x", "title": f"Executive Order {year}.{page}", "articleDate": ""}]})

    pages = lambda: fetch.feed_pages(spark, logged(str(tmp_path), answer), 2015, 2024)
    assert pages().count() == 30 and len({*asked(tmp_path)}) == 30
    for where, years in (("window_year = 2020", {2020}), ("window_year > 2022 AND page > 1", {2023, 2024}), ("window_year IN (2016, 2030) ", {2016}), ("window_year BETWEEN 2018 AND 2019", {2018, 2019}), ("window_year < 2015", set())):
        got = pages().filter(where).collect()
        want = pages_of = {(y, p) for y in years for p in (1, 2, 3)}
        want = {(y, p) for y, p in pages_of if "page > 1" not in where or p > 1}
        assert {(r.window_year, r.page) for r in got} == want
        assert {int(parse_qs(urlsplit(u).query)["fromDate"][0][:4]) for u in asked(tmp_path)} == years


def test_archive_filters_and_resume_keys(spark, tmp_path):
    lines = [f"gov,nyc)/{d}/{y}eo{n}.pdf {y}0601000000 http://www.nyc.gov/{d}/{y}EO{n}.pdf {m} {s} D{n} 10" for d in ("html/a", "html/b") for y in range(2010, 2020) for n in range(5) for m, s in (("application/pdf", 200), ("text/html", "-"))]

    def answer(url):
        q = {k: v for k, v in parse_qs(urlsplit(url).query).items()}
        prefix = ",".join(reversed(q["url"][0].split("/")[0].split("."))) + ")/" + q["url"][0].partition("/")[2]
        own = [x for x in lines if x.startswith(prefix) and q["from"][0] <= x.split()[1] <= q["to"][0]]
        for f in q.get("filter", []):
            name, value = f.split(":")
            own = [x for x in own if x.split()[{"mimetype": 3, "statuscode": 4}[name]] == value]
        at, size = int(q.get("resumeKey", ["0"])[0]), int(q["limit"][0])
        part = own[at : at + size]
        return "\n".join(part) + (f"\n\n{at + size}" if at + size < len(own) else "\n")

    def source(size=1000):
        return archive.archive_captures(spark, logged(str(tmp_path), answer), "nyc.gov/html/", 2010, 2019, size)

    assert source().count() == 200 and len(asked(tmp_path)) == 10
    assert source(3).count() == 200 and len(asked(tmp_path)) == 70  # seven pages a year by resume keys
    got = tables.captures(source(), "http://www.nyc.gov/html/b/", 2014, 2015, keyed=True).collect()
    urls = asked(tmp_path)
    assert sorted(r.original for r in got) == sorted(x.split()[2] for x in lines if "/html/b/" in x and "application" in x and x.split()[1][:4] in ("2014", "2015"))
    assert len(urls) == 2 and all("url=nyc.gov%2Fhtml%2Fb%2F" in u and "filter=mimetype%3Aapplication%2Fpdf" in u and "filter=statuscode%3A200" in u for u in urls)
    assert source().filter("timestamp > TIMESTAMP '2018-03-01 00:00:00'").count() == 40 and len(asked(tmp_path)) == 2
    assert source().filter(F.col("urlkey").startswith("gov,nyc)/html/a/")).count() == 100 and all("html%2Fa%2F" in u for u in asked(tmp_path))
    assert archive.parse_captures("bad line\n") == ([], None) and archive.parse_captures("") == ([], None)
