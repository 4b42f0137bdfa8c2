"""X1/X2/A2/A3/O3/A5 against Python sets; S9 keyed replace load."""

import pytest
from pyspark.sql import functions as F

from curata.operators.reconcile import (DuplicateKeyError, Loads, duplicate_keys, load_folders, loaded_folders, reconcile, replace_folders, sample,
                                        verdict)

LEFT = [("  p1 ", "u1 "), ("p1", "u1"), ("p2", "u2"), ("p3", "u3"), (None, "u9"), ("p4", None)]
RIGHT = [("p1", "u1"), ("p3 ", "u3"), ("p5", "u5"), ("p6", "u6"), (None, "u9")]


def py_sets():
    s = lambda v: None if v is None else v.strip()
    l_ = {(s(a), s(b)) for a, b in LEFT}
    r_ = {(s(a), s(b)) for a, b in RIGHT}
    return l_, r_


def test_reconcile_sets(spark):
    left = spark.createDataFrame(LEFT, "promotion string, url string")
    right = spark.createDataFrame(RIGHT, "promotion string, url string")
    l_, r_ = py_sets()
    sides = {(r.promotion, r.url): r.side for r in reconcile(left, right).collect()}
    assert {k for k, v in sides.items() if v == "left_only"} == l_ - r_
    assert {k for k, v in sides.items() if v == "right_only"} == r_ - l_
    assert {k for k, v in sides.items() if v == "both"} == l_ & r_
    v = verdict(left, right).first()
    assert (v.left_rows, v.right_rows, v.matching, v.identical) == (6, 5, len(l_ & r_), False)
    same = verdict(right, right).first()
    assert same.identical
    empty = verdict(left.limit(0), right.limit(0)).first()
    assert not empty.identical  # a CSV without data rows is not a match


def test_reconcile_by_bucket(spark, tmp):
    """The rows of ``reconcile`` with many buckets and few; equal sides shuffle no text."""
    from curata.operators.reconcile import reconcile_by_bucket
    schema = "promotion string, url string"
    more = [(f"p{i} " + "long text " * 40, f"u{i}") for i in range(300)]
    left = spark.createDataFrame(LEFT + more + more[:50], schema)
    right = spark.createDataFrame(RIGHT + more[1:] + [("new", "n")], schema)
    want = sorted(map(tuple, reconcile(left, right).collect()), key=repr)
    for buckets in (1, 16, 1 << 20):
        assert sorted(map(tuple, reconcile_by_bucket(left, right, buckets=buckets).collect()), key=repr) == want
    assert reconcile_by_bucket(left.limit(0), right.limit(0)).count() == 0
    spark.createDataFrame(more, schema).write.parquet(f"{tmp}/same")
    same = spark.read.parquet(f"{tmp}/same")
    out = reconcile_by_bucket(same, same)
    assert out.where("side = 'both'").count() == 300 and out.count() == 300
    moved = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "Broadcast" not in x]
    # what is shuffled are pairs of differing buckets (here none) and pairs that stand twice (here none)
    assert all(spark.read.parquet(f).isEmpty() for f in {p.rsplit("/", 1)[0] for p in out.inputFiles() if "/curata-cut-" in p}) and moved


def test_sample_top5(spark):
    left = spark.createDataFrame([(f"p{i:02d}", "u") for i in range(12)], "promotion string, url string")
    right = spark.createDataFrame([("z", "u")], "promotion string, url string")
    rows = sample(reconcile(left, right)).orderBy("side", "ordinal").collect()
    lo = [(r.ordinal, r.promotion, r.n_more) for r in rows if r.side == "left_only"]
    assert lo == [(i + 1, f"p{i:02d}", 7) for i in range(5)]
    assert [(r.promotion, r.n_more) for r in rows if r.side == "right_only"] == [("z", 0)]


def test_load_folders_in_one_step(spark, tmp):
    """Loads that fail -- half-way through the data, or before they are published -- leave the table as it was."""
    path, schema = f"{tmp}/loads", "promotion string, url string, folder_name string"
    table = lambda: sorted(tuple(r) for r in loaded_folders(spark, path).collect())
    assert table() == []
    a = [("x", "u1", "A"), ("y", "u2", "A"), ("z", "u3", "B")]
    for _ in range(2):  # loading twice leaves one copy
        assert load_folders(spark.createDataFrame(a, schema), path) == 3
        assert table() == a
    new = [("w", "u9", "A"), ("v", "u8", "B"), ("t", "u7", "01")]
    df = spark.createDataFrame(new, schema)
    loads = Loads(spark, path)
    boom = df.repartition(2, "folder_name").withColumn("promotion", F.when(F.col("folder_name") == "B", F.raise_error(F.lit("lost"))).otherwise(F.col("promotion")))
    with pytest.raises(Exception):
        loads.write_aside(boom, "folder_name")  # between two folders
    assert table() == a
    loads.write_aside(df, "folder_name")  # the driver dies before it publishes
    assert table() == a
    assert load_folders(df, path) == 3
    assert table() == sorted(new)
    assert load_folders(spark.createDataFrame(a[:1], schema), path) == 1
    assert table() == sorted([a[0], *new[1:]])
    with pytest.raises(DuplicateKeyError):
        load_folders(spark.createDataFrame([("a", "u", "C"), ("b", "u", "C")], schema), path)
    assert load_folders(df.limit(0), path, header_only=True) == 0 and table() == sorted([a[0], *new[1:]])
    assert len(loads.finished()) == 2


def test_replace_folders(spark, tmp):
    path = f"{tmp}/integration"
    a = spark.createDataFrame([("x", "u1", "A"), ("y", "u2", "A"), ("z", "u3", "B")], "promotion string, url string, folder_name string")
    assert replace_folders(a, path) == 3
    assert replace_folders(a.where("folder_name = 'A'"), path) == 2  # loading twice leaves one copy
    assert spark.read.parquet(path).count() == 3
    new_a = spark.createDataFrame([("w", "u9", "A")], "promotion string, url string, folder_name string")
    replace_folders(new_a, path)
    got = sorted((r.folder_name, r.url) for r in spark.read.parquet(path).collect())
    assert got == [("A", "u9"), ("B", "u3")]  # B untouched
    dup = spark.createDataFrame([("a", "u", "C"), ("b", "u", "C")], "promotion string, url string, folder_name string")
    with pytest.raises(DuplicateKeyError):
        replace_folders(dup, path)
    assert spark.read.parquet(path).count() == 2  # nothing changed
    assert replace_folders(dup.limit(0), path, header_only=True) == 0
    assert duplicate_keys(dup).first().n == 2


def test_load_writes_its_rows_once(spark, tmp, monkeypatch):
    """A load is checked where it lies aside, its odd folder names as they came; a failed one leaves nothing."""
    import os
    from curata.operators import reconcile as R
    monkeypatch.setattr(R, "cut_lineage", lambda df: pytest.fail("a second copy of the rows"))
    schema = "promotion string, url string, folder_name string"
    rows = [("a", "u", ""), ("b", "u", None), ("c", "u", "__HIVE_DEFAULT_PARTITION__"), ("d", "u", "A")]
    assert load_folders(spark.createDataFrame(rows, schema), f"{tmp}/t") == 4  # four keys, though three share a path
    for bad in (rows[:1] * 2, rows[1:2] * 2, rows[2:3] * 2):
        with pytest.raises(DuplicateKeyError):
            load_folders(spark.createDataFrame(bad, schema), f"{tmp}/t")
    assert os.listdir(f"{tmp}/t/data") == ["v=1"]
    assert [tuple(r) for r in loaded_folders(spark, f"{tmp}/t").collect()] == [("d", "u", "A")]
