"""Ranges of a JSON array against the parser that reads it whole."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import json_splits as j
from corpusloom.sources import tables


def random_value(r, depth=0):
    k = r.randrange(8 if depth < 4 else 4)
    if k < 3:
        return "".join(r.choice(['"', "\\", "[", "]", "{", "}", ",", ":", "a", "é", "🙂", "\n", " ", "\\\\"]) for _ in range(r.randint(0, 12)))
    if k == 3:
        return r.choice([1, -2.5, True, None])
    if k < 6:
        return {str(random_value(r, 4)): random_value(r, depth + 1) for _ in range(r.randint(0, 3))}
    return [random_value(r, depth + 1) for _ in range(r.randint(0, 3))]


def by_ranges(path, step):
    """What the tasks do, one after another."""
    size = path.stat().st_size
    got, state, lo = [], (False, 0), 0
    with j._source(str(path)) as source:
        for at in range(0, size, step):
            lo, hi = j._begin(source, at, size), j._begin(source, at + step, size)
            got += [x for x in (t.strip() for t in j.elements(source, lo, hi, size, *state)) if x]
            odd, out, inner = j.effect(np.frombuffer(source.read_at(hi - lo, lo), dtype=np.uint8))
            state = (bool(state[0] ^ odd), state[1] + (inner if state[0] else out))
    assert state == (False, 0)
    return got


def test_random_arrays(tmp_path, monkeypatch):
    monkeypatch.setattr(j, "FURTHER", 5)
    r = random.Random(1)
    for n in range(250):
        rows = [random_value(r) for _ in range(r.randint(0, 12))]
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(rows, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 2])), encoding="utf-8")
        for step in (1, 2, 3, 7, 40, 100_000):
            assert [json.loads(t) for t in by_ranges(path, step)] == rows


def test_backslashes_at_ranges_ends(tmp_path):
    for n in range(0, 9):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(["\\" * n, '"' * n, "\\" * n + '"', ["],[", "\\"]]))
        for step in range(1, 12):
            assert len(by_ranges(path, step)) == 4


def test_index_by_many_tasks(spark, tmp_path):
    rows = [{"eo_id": f"e{i}", "number": str(i), "year": 2000 + i % 20, "is_emergency": i % 2 == 0, "title": 'a "quoted", [x] \\ {y}\n' * (i % 5) or None, "more": {"z": [i]}} for i in range(3000)]
    path = f"{tmp_path}/index.json"
    with open(path, "w", encoding="utf-8") as out:
        json.dump(rows, out, indent=2)
    whole, split = tables.read_index(spark, path), tables.read_index(spark, path, split=20_000)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
    used = split.withColumn("task", F.spark_partition_id()).groupBy("task").count()
    assert used.count() > 20 and used.agg(F.max("count")).first()[0] < 300
    for i, text in enumerate(("[]", " [ ] ", "", "\n[\n1, {}\n]\n")):
        with open(f"{tmp_path}/odd-{i}.json", "w") as out:
            out.write(text)
    assert sorted(r.value for r in j.split_array(spark, f"{tmp_path}/odd-*.json", 3).collect()) == ["1", "{}"]
    assert j.split_array(spark, f"{tmp_path}/none-*.json").count() == 0
    with open(f"{tmp_path}/object.json", "w") as out:
        out.write('{"records": []}')
    with pytest.raises(Exception, match="NotAnArray"):
        j.split_array(spark, f"{tmp_path}/object.json").count()
