"""T1 batch vs a brute-force walk (skewed keys, ties, many partitions), stream = batch, J5/X3."""

import random
import time

from pyspark.sql import functions as F

from curata.operators.repeats import cache_state, merge_cache, successor, suppress_repeats

DAY_US = 86_400_000_000
BASE_US = 1_704_067_200_000_000  # 2024-01-01: keeps test times clear of the initial watermark (epoch 0)


def brute(rows):
    """rows: (id, key, t_us) -> ids that pass."""
    by = {}
    for i, k, t in rows:
        by.setdefault(k, []).append((t, i))
    kept = set()
    for v in by.values():
        anchor = None
        for t, i in sorted(v):
            if anchor is None or t - anchor >= DAY_US:
                kept.add(i)
                anchor = t
    return kept


def skewed_rows(n=6000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}"   # one key holds a third of all rows
        t = rnd.randint(0, 40 * DAY_US)
        if i % 17 == 0:
            t = (t // DAY_US) * DAY_US                           # exact day boundaries and ties
        rows.append((i, k, BASE_US + t))
    return rows


def to_df(spark, rows):
    return (spark.createDataFrame(rows, "id long, k string, t long")
            .withColumn("ts", F.timestamp_micros("t")))


def test_successor_brute(spark):
    rows = skewed_rows(1500, seed=4)
    got = {r.id: r.nxt_id for r in successor(to_df(spark, rows), ["k"], "ts", "id", DAY_US, partitions=17).collect()}
    by = {}
    for i, k, t in rows:
        by.setdefault(k, []).append((t, i))
    for i, k, t in rows:
        later = [x for x in sorted(by[k]) if x[0] >= t + DAY_US]
        assert got[i] == (later[0][1] if later else None)


def test_batch_matches_brute_skewed(spark):
    rows = skewed_rows()
    df = to_df(spark, rows)
    want = brute(rows)
    for parts in (1, 7, 32):
        got = {r.id for r in suppress_repeats(df, ["k"], "ts", "id", partitions=parts).collect()}
        assert got == want, parts


def test_hot_key_over_many_partitions(spark):
    """One key holds a third of all rows; Arrow batches smaller than a partition."""
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 40}", BASE_US + (i * 7919 % 6000) * DAY_US // 90) for i in range(6000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.id for r in suppress_repeats(to_df(spark, rows), ["k"], "ts", "id", partitions=24).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert got == brute(rows)


def test_carry_over_many_segments(spark):
    """A hot key in segments of a few rows: short ones that a walk jumps over, and long ones that it enters."""
    from curata.operators.repeats import anchors
    for step, seed in ((DAY_US // 40, 1), (DAY_US // 3, 2), (3 * DAY_US, 3)):
        rnd = random.Random(seed)
        rows = [(i, "hot" if i % 3 else f"k{i % 7}", BASE_US + i * step + rnd.randint(0, 3) * step // 2) for i in range(900)]
        for parts, segment in ((1, 5), (5, 3), (13, 1000)):
            got = {r.id for r in anchors(to_df(spark, rows), ["k"], "ts", "id", partitions=parts, segment=segment).collect()}
            assert got == brute(rows), (step, parts, segment)


def test_exits_equal_the_walk():
    import numpy as np
    from curata.operators.repeats import exits
    rnd = random.Random(5)
    t = np.sort(np.array([rnd.randint(0, 30 * DAY_US) for _ in range(400)]))
    for i, last in enumerate(exits(t, DAY_US)):
        at = i
        while (later := np.flatnonzero(t >= t[at] + DAY_US)).size:
            at = int(later[0])
        assert last == at


def micro_batches(spark, tmp, batches, **kw):
    """Statuses by id after feeding lists of (id, key, hours) one after another."""
    from curata.streaming.repeats import repeats_micro_batch
    for n, rows in enumerate(batches):
        df = to_df(spark, [(i, k, BASE_US + h * 3_600_000_000) for i, k, h in rows])
        repeats_micro_batch(df, n, ["k"], "ts", "id", f"{tmp}/out", f"{tmp}/state", **kw)
    return {r.id: r.status for r in spark.read.parquet(f"{tmp}/out").collect()}


def test_late_first_arrival_passes(spark, tmp):
    # key b is first seen 26 h behind the stream
    got = micro_batches(spark, tmp, [[(1, "a", 0)], [(2, "a", 30)], [(3, "b", 4)]])
    assert got == {1: "passed", 2: "passed", 3: "passed"}


def test_late_repeat_is_a_repeat(spark, tmp):
    batches = [[(1, "k", 0), (2, "z", 30)], [(3, "k", 10)]]
    assert micro_batches(spark, tmp, batches, lateness_hours=48) == {1: "passed", 2: "passed"}
    # beyond the stated lateness a row comes out as late; it does not vanish
    assert micro_batches(spark, f"{tmp}/b", batches, lateness_hours=12) == {1: "passed", 2: "passed", 3: "late"}


def test_state_table_stream_equals_batch(spark, tmp):
    from curata.streaming.repeats import start_repeats_stream
    rows = skewed_rows(2000, seed=13)
    df = to_df(spark, rows)
    src = f"{tmp}/events"
    chunk = ((F.col("t") - BASE_US) / (8 * DAY_US)).cast("int")
    for c in range(6):
        df.where(chunk == c).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_repeats_stream(stream, ["k"], "ts", "id", f"{tmp}/out", f"{tmp}/state", f"{tmp}/ck",
                             trigger={"availableNow": True})
    q.awaitTermination(600)
    got = {r.id for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert got == brute(rows)
    # a retried batch rewrites only its own output and state version
    from curata.streaming.repeats import repeats_micro_batch
    last = max(int(x.split("=")[1]) for x in __import__("os").listdir(f"{tmp}/state/meta") if x.startswith("v="))
    batch = spark.read.parquet(src).where(chunk == 5)
    repeats_micro_batch(batch, last, ["k"], "ts", "id", f"{tmp}/out", f"{tmp}/state")
    assert {r.id for r in spark.read.parquet(f"{tmp}/out").collect()} == brute(rows)


def state_rows(spark, tmp, batch):
    """(rows, buckets) that a batch wrote as state."""
    s = spark.read.parquet(f"{tmp}/state/data").where(F.col("v") == batch)
    return s.count(), s.select("b").distinct().count()


def test_state_written_follows_the_batch(spark, tmp):
    """Many keys known: a batch of one row writes one anchor in one bucket; a repeat writes none."""
    known = [(i, f"k{i}", 0) for i in range(5000)]
    micro_batches(spark, tmp, [known, [(5000, "k17", 30)]], buckets=64)
    assert state_rows(spark, tmp, 0) == (5000, 64) and state_rows(spark, tmp, 1) == (1, 1)
    from curata.streaming.repeats import repeats_micro_batch
    for batch, row in ((2, (5001, "k17", BASE_US + 31 * 3_600_000_000)), (3, (5002, "new", BASE_US))):
        repeats_micro_batch(to_df(spark, [row]), batch, ["k"], "ts", "id", f"{tmp}/out", f"{tmp}/state")
    assert state_rows(spark, tmp, 2) == (0, 0) and state_rows(spark, tmp, 3) == (1, 1)
    got = {r.id: r.batch_id for r in spark.read.parquet(f"{tmp}/out").where("batch_id > 0").collect()}
    assert got == {5000: 1, 5002: 3}


def test_buckets_are_written_anew_and_old_anchors_go(spark, tmp, monkeypatch):
    """Versions of a bucket stay few, and with a stated lateness anchors that decide nothing any more go."""
    from curata.streaming import buckets, repeats
    monkeypatch.setattr(buckets, "MOST_VERSIONS", 2)
    batches = [[(100 * b + i, f"k{b}-{i}", 30 * b) for i in range(3)] for b in range(7)]
    want = {r[0]: "passed" for rows in batches for r in rows}
    assert micro_batches(spark, tmp, batches, lateness_hours=24, buckets=1) == want
    state = repeats.AnchorState(spark, f"{tmp}/state", 7)
    assert state.buckets == 1 and len(state.versions(0)) <= 3
    keys = {r["_k"] for r in state.read([0]).collect()}
    assert '{"k":"k6-0"}' in keys and '{"k":"k0-0"}' not in keys
    # a retried batch finds the state that it found before
    again = to_df(spark, [(i, k, BASE_US + h * 3_600_000_000) for i, k, h in batches[6]])
    repeats.repeats_micro_batch(again, 6, ["k"], "ts", "id", f"{tmp}/out", f"{tmp}/state", lateness_hours=24, buckets=1)
    assert {r.id: r.status for r in spark.read.parquet(f"{tmp}/out").collect()} == want


def test_cache_state_and_merge(spark):
    arts = spark.createDataFrame([("https://a",), ("https://b",), ("https://c",)], "url string")
    cache = spark.createDataFrame([("https://a", "2024-01-30 12:00:00", "A"), ("https://b", "2024-01-29 00:00:00", "B")],
                                  "url string, t string, body string").select(
        F.md5("url").alias("url_key"), "url", F.to_timestamp("t").alias("fetched_at"), "body")
    st = {r.url: (r.cache, r.action) for r in cache_state(arts, cache, "2024-01-31 00:00:00").collect()}
    assert st == {"https://a": ("fresh", "repeated"), "https://b": ("stale", "refresh"), "https://c": ("miss", "fetch")}
    reuse = {r.url: r.action for r in cache_state(arts, cache, "2024-01-31 00:00:00", on_fresh="reuse").collect()}
    assert reuse["https://a"] == "reuse"
    fetched = spark.createDataFrame([("https://b", "2024-01-31 00:00:00", "B2"), ("https://c", "2024-01-31 00:00:00", "C")],
                                    "url string, t string, body string").select(
        F.md5("url").alias("url_key"), "url", F.to_timestamp("t").alias("fetched_at"), "body")
    snap = {r.url: r.body for r in merge_cache(cache, fetched).collect()}
    assert snap == {"https://a": "A", "https://b": "B2", "https://c": "C"}


def test_cache_upserts_write_what_changed(spark, tmp):
    """A refreshed and a new article are written, in their buckets; the others are neither read nor written."""
    from curata.plans.curate import article_cache, upsert_cache
    page = "<html><body><article><p>{}</p></article></body></html>"
    url = lambda i: f"https://h.org/{i}"
    old = spark.range(400).select(F.md5(F.concat(F.lit("https://h.org/"), F.col("id").cast("string"))).alias("url_key"),
                                  F.concat(F.lit("https://h.org/"), F.col("id").cast("string")).alias("url"),
                                  F.when(F.col("id") == 7, "2024-01-01 00:00:00").otherwise("2024-01-30 12:00:00").cast("timestamp_ntz").alias("fetched_at"),
                                  F.lit("old").alias("body"))
    first = article_cache(spark, f"{tmp}/cache", 0, buckets=32)
    first.write(old, list(range(32)))
    pages = spark.createDataFrame([(url(i), page.format(f"text {i}")) for i in (7, 8, 9000)], "url string, html string")
    upsert_cache(pages, article_cache(spark, f"{tmp}/cache", 1), "2024-01-31 00:00:00")
    written = spark.read.parquet(f"{tmp}/cache/data").where("v = 1")
    assert sorted(r.url for r in written.collect()) == [url(7), url(9000)]
    body = {r.url: r.body for r in article_cache(spark, f"{tmp}/cache", 2).read().collect()}
    assert body == {url(i): "old" for i in range(400)} | {url(7): "text 7", url(9000): "text 9000"}


def test_mark_repeats_flags_every_row(spark):
    from curata.operators.repeats import mark_repeats
    rows = skewed_rows(500, seed=21)
    got = {r.id: r.repeat for r in mark_repeats(to_df(spark, rows), ["k"], "ts", "id").collect()}
    want = brute(rows)
    assert len(got) == len(rows) and {i for i, rep in got.items() if not rep} == want
