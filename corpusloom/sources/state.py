"""State kept between runs: named tables in numbered versions, and a pointer that moves last.

A version is a folder with a Parquet table for each name. Its tables are written first, their rows counted by the writes themselves;
then the pointer file, which names the version and its counts, is replaced. A run that fails, or would leave a guarded table with fewer rows,
leaves the pointer, so readers keep the old version, whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sinks import ShrinkError, _fs


class State:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def pointer(self) -> dict:
        """{version, folder, counts} of the current version; version 0 if there is none."""
        fs, at = _fs(self.spark, f"{self.root}/_current")
        if not fs.exists(at):
            return {"version": 0, "folder": None, "counts": {}}
        source = fs.open(at)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return json.loads(text)

    def read(self, name: str, schema: str) -> DataFrame:
        """A table of the current version; no rows of ``schema`` if it isn't there."""
        now = self.pointer()
        if name not in now["counts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{now['folder']}/{name}")

    def save(self, tables: dict[str, DataFrame], guarded: tuple[str, ...] = (), allow_shrink: bool = False) -> int:
        """Write a version of ``tables``, each by one job, and point to it; its number. Tables that aren't named are dropped from
        it. A guarded table with fewer rows than it has now is a ``ShrinkError``, and nothing changes."""
        now = self.pointer()
        number = now["version"] + 1
        folder, counts = f"v{number:06d}-{uuid.uuid4().hex[:8]}", {}
        try:
            for name, df in tables.items():
                seen = Observation()
                df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{folder}/{name}")
                counts[name] = seen.get["rows"]
                if name in guarded and not allow_shrink and counts[name] < now["counts"].get(name, 0):
                    raise ShrinkError(f"{name}: {counts[name]} records would replace {now['counts'][name]}")
        except Exception:
            fs, at = _fs(self.spark, f"{self.root}/{folder}")
            fs.delete(at, True)
            raise
        fs, temp = _fs(self.spark, f"{self.root}/_next-{uuid.uuid4().hex}")
        out = fs.create(temp, True)
        out.write(bytearray(json.dumps({"version": number, "folder": folder, "counts": counts}).encode()))
        out.close()
        _, at = _fs(self.spark, f"{self.root}/_current")
        fs.delete(at, False)
        if not fs.rename(temp, at):
            raise OSError(f"{self.root}/_current")
        return number

    def clear_old(self, keep: int = 2) -> None:
        """Delete all versions but the current one and those before it, ``keep`` in all."""
        fs, at = _fs(self.spark, self.root)
        now = self.pointer()["version"]
        for x in fs.listStatus(at):
            name = x.getPath().getName()
            if name.startswith("v") and name[1:7].isdigit() and int(name[1:7]) <= now - keep:
                fs.delete(x.getPath(), True)


def merged(table: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` with the rows of ``updates``, which replace rows of the same keys (null keys equal)."""
    new = updates.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return table.join(new, on, "left_anti").unionByName(updates.select(*table.columns))
