"""Quoted CSV split among tasks: equal to the reader that takes a file in one task."""

import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

from opinari.sources import csv, files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def field(r):
    kind = r.random()
    if kind < 0.1:
        return ""
    text = "".join(r.choice(["x", "yz ", ",", '"', "\n", "\r\n", "é", "\n\n", "日"] if kind < 0.5 else ["x", "yz ", "é"]) for _ in range(r.randrange(1, 40)))
    if kind > 0.97:
        text = 'long "quoted"\n' * 900
    return text if not set(text) & set(',"\n\r') and kind > 0.7 else '"' + text.replace('"', '""') + '"'


def table(seed, n, end="\n"):
    r = random.Random(seed)
    return "id,a,b" + end + "".join(f"{k},{field(r)},{field(r)}{end}" for k in range(n))


@pytest.fixture
def splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def whole(spark, path):
    return (spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def key(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_one_task(spark, splits, end):
    folder = tempfile.mkdtemp()
    for k, n in enumerate((2000, 300, 1, 0)):
        with open(os.path.join(folder, f"{k}.csv"), "w", newline="", encoding="utf-8") as f:
            f.write(table(k, n, end))
    open(os.path.join(folder, "empty.csv"), "w").close()
    lines = csv._lines(spark, folder)
    states = csv.split_states(lines).collect()
    assert len(states) > 20 and 3 < sum(s["inside"] for s in states) < len(states)
    got = csv.read_csv(spark, folder, SCHEMA)
    # The other reader makes "\n" of what it takes for line ends inside quotes, too.
    inside = (lambda x: x.replace("\r\n", "\n") if isinstance(x, str) else x) if end == "\r\n" else (lambda x: x)
    found = got.collect()
    assert len(found) == 2301
    assert key([tuple(map(inside, x)) for x in found]) == key(whole(spark, folder).collect())


def test_state_join_without_broadcast(spark, splits, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(), "a.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(table(9, 400)[:-1])                          # no line end at the end
    monkeypatch.setattr(csv, "MAX_BROADCAST", 0)
    assert key(csv.read_csv(spark, path, SCHEMA).collect()) == key(whole(spark, path).collect())


def test_records_over_many_splits_and_open_quotes(spark, splits):
    path = os.path.join(tempfile.mkdtemp(), "a.csv")
    giant = "line\n" * 8000
    with open(path, "w", newline="") as f:
        f.write(f'id,a,b\n\n1,"{giant}",x\n\n2,y,"z\n')
    got = sorted(map(tuple, csv.read_csv(spark, path, SCHEMA).collect()))
    assert got[0] == (1, giant, "x") and got[1][:2] == (2, "y") and len(got) == 2
    assert [r["record"] for r in csv.records(spark, path).collect() if r["record"].startswith("2")] == ['2,y,"z']


def test_misfits_keep_their_text(spark, splits):
    path = os.path.join(tempfile.mkdtemp(), "a.csv")
    with open(path, "w", newline="") as f:
        f.write("id,a,b\n" + "".join(f'{k if k % 5 else "no%d" % k},"t\n{k}",u\n' for k in range(1000)))
    good, bad = files.split_csv(spark, path, SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == [k for k in range(1000) if k % 5]
    assert sorted(r[0] for r in bad.collect()) == sorted(f'no{k},"t\n{k}",u' for k in range(0, 1000, 5))
