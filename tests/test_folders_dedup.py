"""F1/J1/A1/O1/P24, S4, W1 keep-first (vs the window form), J3, ordinals."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curata.operators.dedup import keep_first, pending, with_url_norm
from curata.operators.folders import folder_counts, folder_listing, saved_searches
from curata.operators.ordering import ordinal
from curata.sources.readers import ledger_keys, resolve_url_column


def test_saved_searches_ilike(spark):
    node = spark.createDataFrame([(1, "A Saved Search", "vfolder"), (2, "b saved SEARCH", "vfolder"),
                                  (3, "C Search", "folder"), (4, "Inbox", "vfolder")], "node_id int, title string, type string")
    assert sorted(r.node_id for r in saved_searches(node).collect()) == [1, 2]


def test_counts_include_empty_folders(spark):
    node = spark.createDataFrame([(1, "x Search", "vfolder"), (2, "y Search", "vfolder")], "node_id int, title string, type string")
    m = spark.createDataFrame([(1, 10), (1, 11), (1, None)], "node_id int, item_id long")
    got = {r.node_id: r.n_items for r in folder_counts(node, m).collect()}
    assert got == {1: 2, 2: 0}
    listing = folder_listing(folder_counts(node, m)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.title) for r in listing] == [(1, "x Search"), (2, "y Search")]


def test_ordinal_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    want = sorted((r.g, r.v) for r in df.collect())
    got = ordinal(df, ["g", "v"], partitions=13).orderBy("ordinal").collect()
    assert [(r.g, r.v) for r in got] == want
    assert [r.ordinal for r in got] == list(range(1, 5001))


def test_resolve_url_column(spark):
    a = spark.createDataFrame([(1, "l", "g")], "item_id long, link string, guid string")
    assert resolve_url_column(a).columns == ["item_id", "url"]
    assert resolve_url_column(a).first().url == "l"
    b = spark.createDataFrame([(1, "x")], "item_id long, title string")
    assert resolve_url_column(b).count() == 0


def test_keep_first_matches_window(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        u = rnd.choice(["https://a.org/x", "http://www.a.org/x/", "https://a.org/x?utm_s=1", "https://b.org/",
                        "https://c.org/p", "", None, "HTTPS://C.org/p/"])
        upd = rnd.choice([None, rnd.randint(0, 50)])
        rows.append((rnd.randint(0, 30), i, u, upd))
    df = spark.createDataFrame(rows, "node_id int, item_id long, url string, updated long")
    got = {(r.node_id, r.url_norm): r.item_id for r in keep_first(with_url_norm(df), ["node_id"]).collect()}
    w = Window.partitionBy("node_id", "url_norm").orderBy(F.col("updated").desc_nulls_last(), "item_id")
    ref = with_url_norm(df).withColumn("rn", F.row_number().over(w)).where("rn = 1")
    assert got == {(r.node_id, r.url_norm): r.item_id for r in ref.collect()}


def test_pending_uses_normal_form(spark):
    df = spark.createDataFrame([("https://a.org/x", "https://a.org/x"), ("https://b.org", "https://b.org")],
                               "url string, url_norm string")
    ledger = spark.createDataFrame([("http://www.a.org/x/",)], "url string")
    assert [r.url for r in pending(df, ledger_keys(ledger)).collect()] == ["https://b.org"]


def test_ordered_items_nulls_last(spark):
    from curata.operators.folders import ordered_items
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9), (4, 5)], "item_id long, updated long")
    assert [r.item_id for r in ordered_items(df).collect()] == [3, 2, 4, 1]


def test_a_large_ledger_is_not_shuffled(spark, tmp):
    """Few pending rows against a ledger beyond the broadcast threshold: no exchange over the ledger's scan, same rows."""
    import re
    from curata.operators.dedup import pending, pending_written
    spark.range(200_000).select(F.concat(F.lit("https://e/"), F.col("id").cast("string")).alias("url_norm")).write.parquet(f"{tmp}/ledger")
    spark.createDataFrame([(i, f"https://e/{i * 50_000}") for i in range(8)] + [(9, "https://e/50000")], "n long, url_norm string").write.parquet(f"{tmp}/pending")
    ledger, rows = spark.read.parquet(f"{tmp}/ledger"), spark.read.parquet(f"{tmp}/pending")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")
    try:
        out = pending_written(rows, ledger)
        assert sorted(r.n for r in out.collect()) == sorted(r.n for r in pending(rows, ledger).collect()) == [4, 5, 6, 7]
        plan = out._jdf.queryExecution().executedPlan().toString()
        beyond = pending_written(rows, ledger, most=3)
        assert sorted(r.n for r in beyond.collect()) == [4, 5, 6, 7]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("Initial Plan")[-1].splitlines()
    scan = next(i for i, x in enumerate(lines) if re.search(r"Scan parquet.*/ledger", x))
    above = [x for x in lines[:scan] if x.find("+-") < lines[scan].find("+-")]
    join = next(i for i in range(len(above) - 1, -1, -1) if "LeftSemi" in above[i])
    assert "BroadcastHashJoin" in above[join] and not any("Exchange" in x for x in above[join:])
