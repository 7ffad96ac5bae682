"""Writers of the published forms. Tables go out in parts; the single files of the published form are merged from sorted parts
by the file system, so the driver holds no rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import frontmatter
from .tables import FRONTMATTER


class ShrinkError(RuntimeError):
    """A write would leave fewer records than there are."""


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows, as ``rows`` of the observation, while an action runs over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _least(existing: DataFrame | None, allow: bool) -> int:
    return 0 if existing is None or allow else existing.count()


def _check(new: int, least: int, name: str) -> None:
    if new < least:
        raise ShrinkError(f"{name}: {new} records would replace {least}")


def guard_shrink(df: DataFrame, existing: DataFrame | None, name: str, allow: bool = False) -> None:
    """Raise if ``df`` has fewer rows than ``existing``, unless that is allowed."""
    if existing is not None and not allow:
        _check(df.count(), existing.count(), name)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_file(spark: SparkSession, path: str, sections: list[tuple[str, DataFrame, str, str]], least: int = 0) -> int:
    """One file at ``path`` of sections (head, lines, between, tail): a section's lines are strings ``value`` in ``_order``, written in
    range-sorted parts beside the file, then joined in order, a buffer at a time; the number of lines, which the writes count. The old
    file stands until the new one is whole, and stays if that has fewer than ``least`` lines (``ShrinkError``)."""
    fs, target = _fs(spark, path)
    _, temp = _fs(spark, f"{path}.tmp")
    out, total = fs.create(temp, True), 0
    for head, lines, between, tail in sections:
        only, seen = counted(lines.select("_order", "value").repartitionByRange("_order").sortWithinPartitions("_order").select("value"))
        only.write.mode("overwrite").option("lineSep", between).text(f"{path}.parts")
        _, folder = _fs(spark, f"{path}.parts")
        files = [x for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-") and x.getLen() > 0]
        files.sort(key=lambda x: x.getPath().getName())
        out.write(bytearray(head.encode()))
        for i, x in enumerate(files):
            length = x.getLen() - (len(between.encode()) if i == len(files) - 1 else 0)  # no separator after the last
            source = fs.open(x.getPath())
            spark._jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, length)
            source.close()
        out.write(bytearray(tail.encode()))
        fs.delete(folder, True)
        total += seen.get["rows"]
    out.close()
    if total < least:
        fs.delete(temp, False)
    _check(total, least, path)
    fs.delete(target, False)
    if not fs.rename(temp, target):
        raise OSError(path)
    return total


def _pretty(row: Column) -> Column:
    """JSON of a struct, indented as an element of an array is."""
    text = F.to_json(row, {"ignoreNullFields": "false", "pretty": "true"})
    text = F.regexp_replace(F.regexp_replace(text, r'(?m)^(\s*"[^"]*") : ', "$1: "), r"\[ \]", "[]")
    return F.regexp_replace(text, "(?m)^", "  ")


def write_json_array(df: DataFrame, path: str, order: list[str], existing: DataFrame | None = None, allow_shrink: bool = False) -> None:
    """The published JSON: one array of indented objects with every field, null ones too, in order. Refuses to shrink."""
    rows = df.select(F.struct(*order).alias("_order"), _pretty(F.struct(*df.columns)).alias("value"))
    write_file(df.sparkSession, path, [("[\n", rows, ",\n", "\n]\n")], _least(existing, allow_shrink))


def write_json_object(spark: SparkSession, path: str, lists: dict[str, tuple[DataFrame, list[str]]], values: dict[str, object] | None = None) -> None:
    """One JSON object: ``values`` first, then each list of rows in order (edges and dangles of the graph, a probe's records, the
    volumes)."""
    sections, head = [], "{\n" + "".join(f"  {json.dumps(k)}: {json.dumps(v, ensure_ascii=False)},\n" for k, v in (values or {}).items())
    for i, (name, (df, order)) in enumerate(lists.items()):
        rows = df.select(F.struct(*order).alias("_order"), F.regexp_replace(_pretty(F.struct(*df.columns)), "(?m)^", "  ").alias("value"))
        sections.append((f"{head if not i else ''}  {json.dumps(name)}: [\n", rows, ",\n", "\n  ]\n}\n" if i == len(lists) - 1 else "\n  ],\n"))
    write_file(spark, path, sections)


def write_ledger(provenance: DataFrame, path: str, values: dict[str, object] | None = None) -> None:
    """The provenance file: ``values``, then orders by id, each with its entry. ``tables.read_ledger`` reads it back."""
    head = "{\n" + "".join(f"  {json.dumps(k)}: {json.dumps(v, ensure_ascii=False)},\n" for k, v in (values or {}).items()) + '  "orders": {\n'
    entry = F.regexp_replace(F.regexp_replace(_pretty(F.struct(*provenance.columns)), "(?m)^", "  "), r"^\s+", "")
    rows = provenance.select(F.col("eo_id").alias("_order"), F.concat(F.lit('    "'), "eo_id", F.lit('": '), entry).alias("value"))
    write_file(provenance.sparkSession, path, [(head, rows, ",\n", "\n  }\n}\n")])


def write_json(df: DataFrame, path: str, existing: DataFrame | None = None, allow_shrink: bool = False) -> None:
    """JSON lines in parts, null fields kept, written beside ``path`` and then put in its place. Refuses to shrink, by the count of the
    write itself. ``existing`` and ``df`` may be read from ``path``."""
    least, new = _least(existing, allow_shrink), f"{path.rstrip('/')}.new"
    rows, seen = counted(df)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(new)
    fs, temp = _fs(df.sparkSession, new)
    if seen.get["rows"] < least:
        fs.delete(temp, True)
    _check(seen.get["rows"], least, path)
    _, target = _fs(df.sparkSession, path)
    fs.delete(target, True)
    if not fs.rename(temp, target):
        raise OSError(path)


def csv_cells(df: DataFrame) -> DataFrame:
    """Cells as the published CSV has them: nulls empty, booleans in lower case."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    """Header, nulls as empty fields, booleans in lower case; in parts."""
    csv_cells(df).write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)


def write_csv_file(df: DataFrame, path: str, order: list[str]) -> None:
    """The same as one file, in order."""
    said = lambda c: F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat_ws(",", *(said(cell(c)) for c in df.columns))
    rows = df.select(F.struct(*order).alias("_order"), line.alias("value"))
    write_file(df.sparkSession, path, [(",".join(df.columns) + "\r\n", rows, "\r\n", "\r\n" if not rows.isEmpty() else "")])


def write_markdown(df: DataFrame, folder: str, body: str = "full_text") -> DataFrame:
    """One file ``<year>/<eo_id>.md`` a record; (eo_id, md_path) of what was written, which is a table ``_paths`` in the folder. All
    files appear, or none does (``commit``)."""
    from .commit import write_files

    fields = [f for f in FRONTMATTER if f in df.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            paths = [f"{r['year']}/{r['eo_id']}.md" for r in rows]
            texts = [frontmatter.render(fields, r, r[body] or "").encode() for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "content"])

    wanted = list(dict.fromkeys([*fields, "eo_id", "year", body]))
    write_files(df.select(*wanted).mapInArrow(run, "path string, content binary"), folder)
    path = F.concat(F.col("year").cast("string"), F.lit("/"), "eo_id", F.lit(".md"))
    df.select("eo_id", path.alias("md_path")).write.mode("overwrite").parquet(f"{folder}/_paths")
    return df.sparkSession.read.parquet(f"{folder}/_paths")


def place_files(plan: DataFrame, log: str, write: bool = False) -> DataFrame:
    """(src, dest, written) of a plan (src, dest) of files, as a table at ``log``: copied only where the destination differs in
    size or bytes, by the tasks. Without ``write`` nothing is changed and written tells what would be."""
    from pyarrow import fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dest = batch.column("src").to_pylist(), batch.column("dest").to_pylist()
            done = []
            for a, b in zip(src, dest, strict=True):
                (one, x), (two, y) = (fs.FileSystem.from_uri(p if ":" in p else f"file://{p}") for p in (a, b))
                held = two.get_file_info(y)
                size = one.get_file_info(x).size
                same = held.type == fs.FileType.File and held.size == size and one.open_input_file(x).readall() == two.open_input_file(y).readall()
                if not same and write:
                    two.create_dir(y.rsplit("/", 1)[0], recursive=True)
                    with two.open_output_stream(f"{y}.{TaskContext.get().taskAttemptId()}") as out:
                        out.write(one.open_input_file(x).readall())
                    two.move(f"{y}.{TaskContext.get().taskAttemptId()}", y)
                done.append(not same)
            yield pa.RecordBatch.from_arrays([batch.column("src"), batch.column("dest"), pa.array(done)], names=["src", "dest", "written"])

    plan.select("src", "dest").mapInArrow(run, "src string, dest string, written boolean").write.mode("overwrite").parquet(log)
    return plan.sparkSession.read.parquet(log)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small report as one file."""
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
