import pytest
"""G1-G4 (failures per row), P12-P15, F5/A4/F6, sweep, T2 run twice publishes nothing new."""

from pyspark.sql import functions as F

from curata.operators.generate import (SUMMARY_TEMPLATE, batch_generate, build_prompt, filter_models,
                                       finish_text, request_json, sweep)
from curata.operators.publish import classify, posts, run_summary
from curata.plans.curate import digest_generator
from curata.streaming.publish import process_batch, publish_stream


def flaky(prompt):
    if "boom" in prompt:
        raise RuntimeError("model down")
    return "<think>\nx\n</think>\nsummary of " + prompt[-5:]


def test_batch_generate_failures_do_not_stop(spark):
    df = spark.createDataFrame([(1, "ok one"), (2, "boom"), (3, "ok two")], "id long, prompt string")
    rows = {r.id: r for r in batch_generate(df, flaky, workers=["h1", "h2"]).collect()}
    assert rows[2].status == "failed" and "model down" in rows[2].error and rows[2].raw is None
    assert rows[1].status == "ok" and rows[1].raw.endswith("summary of k one")
    assert {r.worker for r in rows.values()} <= {"h1", "h2"}
    assert all(r.duration_s >= 0 and r.slow is False for r in rows.values())


def test_prompt_and_request(spark):
    df = spark.createDataFrame([("body text", "https://u")], "body string, url string")
    p = df.select(build_prompt(SUMMARY_TEMPLATE, length=257, body=F.col("body")).alias("p")).first().p
    assert p.startswith("Respond ONLY with the 257-character summary.") and p.endswith("\n\nbody text")
    j = df.select(request_json("m1", F.lit("hi")).alias("j")).first().j
    assert j == '{"model":"m1","prompt":"hi","stream":false}'
    f = spark.createDataFrame([(" ",), ("x",)], "t string").select(finish_text("t").alias("f")).collect()
    assert [(r.f.text, r.f.status) for r in f] == [("[Error: No summary generated]", "empty"), ("x", "ok")]


def test_classify_and_summary(spark):
    df = spark.createDataFrame([("A", ""), ("A", "has Error in it"), ("A", "Reject: no"), ("A", "Reject: Error"),
                                ("B", "fine"), ("B", None)], "folder string, promotion string")
    got = {(r.folder, r.status): r.n for r in run_summary(classify(df)).collect()}
    assert got == {("A", "error"): 3, ("A", "rejected"): 1, ("B", "published"): 1, ("B", "error"): 1}


def test_posts(spark):
    df = spark.createDataFrame([(" " + "a" * 256 + " https://x.org/long ", " https://u "), ("b" * 258, "u")],
                               "promotion string, url string")
    rows = posts(df).collect()
    assert [r.status for r in rows] == ["ready", "too_long"]
    assert rows[0].post == "a" * 256 + " https://x.org/long\nhttps://u"


def test_model_filter_and_sweep(spark):
    models = spark.createDataFrame([("qwen3:4b",), ("qwen3:4b-x",), ("llama3",), ("qwen2x5:7b",), ("qwen2:7b",)],
                                   "model string")
    # unanchored, and '.' is a wildcard
    assert sorted(r.model for r in filter_models(models, ["qwen3:4b", "qwen2.5:7b"]).collect()) == ["llama3", "qwen2:7b"]
    assert filter_models(models, []).count() == 5
    arts = spark.createDataFrame([("https://a", "p1"), ("https://b", "p2")], "url string, prompt string")
    out = sweep(arts, ["m2", "m1", "skip-me"], lambda p, m: f"{m}:{p}", skip=["skip"]).collect()
    assert sorted((r.url, r.model, r.raw) for r in out) == [
        ("https://a", "m1", "m1:p1"), ("https://a", "m2", "m2:p1"), ("https://b", "m1", "m1:p2"), ("https://b", "m2", "m2:p2")]
    assert all(r.elapsed == "0s" for r in out)


def test_incremental_publish_twice(spark, tmp):
    arts = spark.createDataFrame(
        [("F Search", i, f"https://n.org/{i % 6}", i, "body " * (i + 3)) for i in range(12)],
        "title string, item_id long, url string, updated long, body string")
    ledger, results = f"{tmp}/ledger", f"{tmp}/results"
    process_batch(arts, 0, ledger, results, digest_generator)
    first = spark.read.parquet(ledger).count()
    assert first > 0
    process_batch(arts, 1, ledger, results, digest_generator)   # second run publishes nothing new
    assert spark.read.parquet(ledger).count() == first
    process_batch(arts, 0, ledger, results, digest_generator)   # a retried batch does not append twice
    assert spark.read.parquet(ledger).count() == first


def test_publish_stream(spark, tmp):
    src = f"{tmp}/arts"
    spark.createDataFrame([("F Search", 1, "https://s.org/1", 1, "some body text")],
                          "title string, item_id long, url string, updated long, body string").write.parquet(src)
    stream = spark.readStream.schema("title string, item_id long, url string, updated long, body string").parquet(src)
    q = publish_stream(stream, f"{tmp}/ledger", f"{tmp}/res", f"{tmp}/ck", digest_generator,
                       trigger={"availableNow": True})
    q.awaitTermination(300)
    res = spark.read.parquet(f"{tmp}/res").collect()
    assert len(res) == 1 and res[0].status in ("published", "error", "rejected")


def test_sweep_log_round_trip(spark, tmp):
    from curata.sources.sinks import append_sweep_log
    arts = spark.createDataFrame([("https://a", "p1")], "url string, prompt string")
    out = sweep(arts, ["m1"], lambda p, m: f"{m}:{p}")
    append_sweep_log(out, f"{tmp}/sweep")
    append_sweep_log(out, f"{tmp}/sweep")
    back = spark.read.parquet(f"{tmp}/sweep").collect()
    assert len(back) == 2 and {r.model for r in back} == {"m1"} and all(r.status == "ok" for r in back)


def run_publish(spark, tmp, rows, generator, runs=1):
    arts = spark.createDataFrame(rows, "title string, item_id long, url string, updated long, body string")
    for n in range(runs):
        process_batch(arts, n, f"{tmp}/ledger", f"{tmp}/results", generator)
    return spark.read.parquet(f"{tmp}/ledger").collect()


def test_each_url_is_published_once(spark, tmp):
    """Two folders, a URL that clean-up changes, a URL with quotes; three runs."""
    rows = [(f, i, u, i, "some body") for i, (f, u) in enumerate([
        ("A", "https://ex.com/caf\u00e9"), ("B", "https://ex.com/caf\u00e9"), ("B", "https://ex.com/\"q\""),
        ("A", "http://www.ex.com/x/"), ("B", "https://ex.com/x?utm_source=f")])]
    led = run_publish(spark, tmp, rows, lambda p: "a summary", runs=3)
    assert sorted((r.folder_name, r.url_norm) for r in led) == [
        ("A", "https://ex.com/caf\u00e9"), ("A", "https://ex.com/x"), ("B", "https://ex.com/\"q\"")]


def test_failed_rows_come_up_again_once(spark, tmp):
    """A row that fails in batch 0 is generated again in batch 1 and published; a reject comes up in every batch."""
    calls = f"{tmp}/calls"

    def generator(name):
        def generate(prompt):
            with open(calls, "a") as f:
                f.write(f"{name} {prompt[-1]}\n")
            if name == "first" and prompt.endswith("b"):
                raise ValueError("down")
            return "Reject: no" if prompt.endswith("r") else "fine"
        return generate

    schema = "title string, item_id long, url string, updated long, body string"
    one = spark.createDataFrame([("F", 1, "https://e/a", 1, "a"), ("F", 2, "https://e/b", 1, "b"), ("G", 3, "https://e/b/", 1, "b"),
                                 ("F", 4, "https://e/r", 1, "r"), ("F", 5, "https://e/n", 1, None)], schema)
    paths = (f"{tmp}/ledger", f"{tmp}/results")
    process_batch(one, 0, *paths, generator("first"), retry_path=f"{tmp}/retries")
    for _ in range(2):  # the second is a retry of the batch
        process_batch(spark.createDataFrame([("F", 6, "https://e/c", 2, "c")], schema), 1, *paths, generator("second"), retry_path=f"{tmp}/retries")
    process_batch(one.where("false"), 2, *paths, generator("third"), retry_path=f"{tmp}/retries")
    res = {(r.batch_id, r.url_norm): r.status for r in spark.read.parquet(f"{tmp}/results").collect()}
    assert {k: v for k, v in res.items() if k[0] == 0} == {(0, "https://e/a"): "published", (0, "https://e/b"): "failed", (0, "https://e/r"): "rejected",
                                                           (0, "https://e/n"): "failed"}
    assert res[2, "https://e/r"] == "rejected" and res[2, "https://e/n"] == "failed" and len([k for k in res if k[0] == 2]) == 2
    assert sorted(r.url_norm for r in spark.read.parquet(f"{tmp}/ledger").collect()) == ["https://e/a", "https://e/b", "https://e/c"]
    made = open(calls).read().split("\n")
    assert made.count("first b") == 1 and made.count("second b") == 1 and made.count("second c") == 1 and made.count("third r") == 1
    import os
    assert sorted(os.listdir(f"{tmp}/retries")) == ["v=1", "v=2"]


def test_a_killed_job_goes_on_where_it_was(spark, tmp):
    """One bucket's task dies: the others stay, and only missing buckets are generated by the next run."""
    from curata.operators.generate import journaled_generate
    df = spark.createDataFrame([(i, f"p{i}") for i in range(300)], "id long, prompt string").repartition(3)

    def generator(run, deadly=None):
        def generate(prompt):
            if prompt == deadly:
                import time
                time.sleep(3)  # the other tasks end first
                raise SystemExit("killed")
            open(f"{tmp}/{run}-{prompt}", "x").close()  # a second call fails
            return f"{run}:{prompt}"
        return generate

    with pytest.raises(Exception):
        journaled_generate(df, generator("one", "p17"), f"{tmp}/journal", ["id"], rows_a_bucket=20).collect()
    kept = {r.id for r in spark.read.parquet(f"{tmp}/journal/data").collect()}
    assert kept and 17 not in kept
    out = {r.id: r.raw for r in journaled_generate(df, generator("two"), f"{tmp}/journal", ["id"], rows_a_bucket=1000, workers=["h1", "h2"]).collect()}
    assert out == {i: f"{'one' if i in kept else 'two'}:p{i}" for i in range(300)}
    again = journaled_generate(df, generator("three"), f"{tmp}/journal", ["id"])
    assert {r.id: r.raw for r in again.collect()} == out
    assert spark.read.parquet(f"{tmp}/journal/data").select("_bucket").distinct().count() > 10


def test_unreadable_ledger_raises(spark, tmp):
    import os
    os.makedirs(f"{tmp}/ledger")
    with open(f"{tmp}/ledger/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        run_publish(spark, tmp, [("A", 1, "https://e.org", 1, "b")], lambda p: "x")


def test_empty_and_failed_are_never_published(spark):
    from curata.plans.curate import generated

    def gen(prompt):
        if "boom" in prompt:
            raise ValueError("boom")
        return "<think>only" if "empty" in prompt else "fine"
    df = spark.createDataFrame([("u1", "boom"), ("u2", "empty"), ("u3", "ok")], "url string, body string")
    for substring in (True, False):
        out = {r.url: (r.status, r.over_length) for r in generated(df, gen, error_substring=substring).collect()}
        assert out["u1"][0] == "failed" and out["u2"][0] == "empty" and out["u3"] == ("published", False)


def test_published_ledger_takes_every_page(spark, tmp):
    """Page 7 of ten is published like the others, in the query and in its SQL."""
    import duckdb
    from curata.plans import catalog
    rows = {"nation": ([(0, "N")], "n_nationkey int, n_name string"),
            "customer": ([(k, 0) for k in range(20)], "c_custkey long, c_nationkey int"),
            "events": ([(0, None)], "event_id long, ts timestamp_ntz"),
            "pages": ([(k, f"http://h.org/{k}", "<article><p>twelve chars</p></article>") for k in range(20)],
                      "page_id long, url string, html string")}
    con = duckdb.connect()
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp}/{name}.parquet/*.parquet')")
    want = sorted(f"http://h.org/{k}" for k in range(1, 20, 2))
    urls = lambda found: sorted(u.replace("https://www.", "http://").split("?")[0] for u in found)
    assert urls(r.url for r in catalog.QUERIES["published_ledger"](spark, tmp).collect()) == want
    assert urls(r[1] for r in con.sql(catalog.ORACLE["published_ledger"]).fetchall()) == want


def _rows_at_hand(prompt):
    import sys
    return str(sys._getframe(1).f_locals["b"].num_rows)


def test_generation_holds_a_part_of_a_batch(spark):
    """Prompts of 20 MB in one batch come as Python strings a megabyte at a time."""
    from curata.operators.generate import batch_generate
    df = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('x', 10000) AS prompt")
    raws = [int(r.raw) for r in batch_generate(df, _rows_at_hand).select("raw").collect()]
    assert len(raws) == 2000 and max(raws) <= 105
