"""S1, S2, S5, S6 (+P5, F3) on small files made here; S7/S8 round trips."""

import os

import pytest

from curata.sources.readers import ledger_keys, read_feed_list, read_ledger, read_opml, read_promotions
from curata.sources.sinks import append_ledger, export_folders, export_ledger_csv

OPML = """<?xml version="1.0" encoding="UTF-8"?>
<opml version="1.0">
<head><title>Subscriptions</title></head>
<body>
<outline title="News" text="News">
  <outline title="A &amp; B" text="A &amp; B" description="d" type="rss" xmlUrl="https://a.org/feed" htmlUrl="https://a.org/"/>
  <outline title="C" text="C" description="" type="atom" xmlUrl="https://c.org/atom" htmlUrl=""/>
</outline>
</body>
</opml>
"""


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_opml(spark, tmp):
    p = write(os.path.join(tmp, "feeds.opml"), OPML)
    rows = sorted(read_opml(spark, p).collect(), key=lambda r: r.title)
    assert [(r.folder, r.title, r.type, r.xmlUrl) for r in rows] == [
        ("News", "A & B", "rss", "https://a.org/feed"), ("News", "C", "atom", "https://c.org/atom")]
    assert rows[1].htmlUrl in ("", None)


def test_feed_list(spark, tmp):
    p = write(os.path.join(tmp, "feeds.txt"), "https://a.org/feed\n\n  https://b.org/rss  \nhttps://a.org/feed\n")
    assert [r.url for r in read_feed_list(spark, p).collect()] == ["https://a.org/feed", "https://b.org/rss", "https://a.org/feed"]


def test_ledger_csv(spark, tmp):
    p = write(os.path.join(tmp, "news.csv"),
              '"Promotion","URL","Search Folder Name","Duration (Seconds)","Host"\n'
              '"say \\"hi\\"","https://a.org/x/","F","1.50","h1"\n'
              '"multi\nline","http://www.b.org","F","2.00","h2"\n'
              '"short row"\n'
              '"","https://c.org","F","0.10","h1"\n')
    order = ["https://a.org/x/", "http://www.b.org", "https://c.org"]  # a table has no order of its own
    rows = sorted(read_ledger(spark, p).collect(), key=lambda r: order.index(r.url))
    assert [r.url for r in rows] == order
    assert rows[0].promotion == 'say "hi"' and rows[1].promotion == "multi\nline" and rows[2].promotion == ""
    assert sorted(r.url_norm for r in ledger_keys(read_ledger(spark, p)).collect()) == [
        "https://a.org/x", "https://b.org", "https://c.org"]
    assert read_ledger(spark, os.path.join(tmp, "missing.csv")).count() == 0
    h = write(os.path.join(tmp, "header_only.csv"), '"Promotion","URL"\n')
    assert read_ledger(spark, h).count() == 0


def test_promotions_csv(spark, tmp):
    d = os.path.join(tmp, "promo")
    os.makedirs(d)
    write(os.path.join(d, "folder_urls_gaza_Saved_Search.csv"),
          '"Promotion","URL","extra"\n"p1","u1","x"\n"only one"\n"p2",""\n"say ""q""","u3"\n')
    rows = read_promotions(spark, d, prefix="folder_urls_").collect()
    assert [(r.promotion, r.url, r.folder_name) for r in rows] == [
        ("p1", "u1", "gaza_Saved_Search"), ("p2", "", "gaza_Saved_Search"), ('say "q"', "u3", "gaza_Saved_Search")]
    bad = os.path.join(tmp, "bad")
    os.makedirs(bad)
    write(os.path.join(bad, "other.csv"), '"Promotion","URL"\n"p","u"\n')
    with pytest.raises(Exception):
        read_promotions(spark, bad, prefix="folder_urls_").collect()


def test_ledger_round_trip(spark, tmp):
    rows = spark.createDataFrame([('q "x" \\ y', "https://a.org", "F", 1.234, "h1", "https://a.org")],
                                 "promotion string, url string, folder_name string, duration_s double, worker string, url_norm string")
    append_ledger(rows, f"{tmp}/ledger")
    append_ledger(rows, f"{tmp}/ledger")
    assert spark.read.parquet(f"{tmp}/ledger").count() == 2
    export_ledger_csv(spark.read.parquet(f"{tmp}/ledger"), f"{tmp}/csv")
    back = read_ledger(spark, f"{tmp}/csv").collect()
    assert [r.promotion for r in back][0].startswith('q "x"') and back[0].duration_s == "1.23"


def test_export_folders(spark, tmp):
    from curata.sources.sinks import SlugCollisionError
    urls = spark.createDataFrame([("gaza Saved Search", 'https://a.org/"q"', 9, 1), ("x/y Search", "https://b.org", None, 2)],
                                 "title string, url string, updated int, item_id int")
    export_folders(urls, f"{tmp}/exp")
    clash = urls.union(spark.createDataFrame([("x y Search", "https://c.org", 1, 3)], urls.schema))
    with pytest.raises(SlugCollisionError):
        export_folders(clash, f"{tmp}/clash")
    dirs = sorted(x for x in os.listdir(f"{tmp}/exp") if x.startswith("folder_slug="))
    assert dirs == ["folder_slug=gaza_Saved_Search", "folder_slug=x_y_Search"]
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp}/exp/folder_slug=gaza_Saved_Search")
    assert back.first().URL == 'https://a.org/"q"'


def test_promotions_csv_duplicate_fails_load(spark, tmp):
    from curata.operators.reconcile import DuplicateKeyError, replace_folders
    d = os.path.join(tmp, "load")
    os.makedirs(d)
    table = os.path.join(tmp, "integration")
    write(os.path.join(d, "folder_urls_News.csv"), '"Promotion","URL"\n"a","u1"\n"b","u2"\n')
    assert replace_folders(read_promotions(spark, d, prefix="folder_urls_"), table) == 2
    dup = os.path.join(tmp, "dup")
    os.makedirs(dup)
    write(os.path.join(dup, "folder_urls_News.csv"), '"Promotion","URL"\n"x","u9"\n"y","u9"\n')
    with pytest.raises(DuplicateKeyError):
        replace_folders(read_promotions(spark, dup, prefix="folder_urls_"), table)
    assert sorted(r.url for r in spark.read.parquet(table).collect()) == ["u1", "u2"]  # unchanged
    empty = os.path.join(tmp, "empty")
    os.makedirs(empty)
    write(os.path.join(empty, "folder_urls_News.csv"), '"Promotion","URL"\n')
    from curata.operators.reconcile import NoUsableRowError
    with pytest.raises(NoUsableRowError):
        replace_folders(read_promotions(spark, empty, prefix="folder_urls_"), table)
    assert replace_folders(read_promotions(spark, empty, prefix="folder_urls_"), table, header_only=True) == 0
    assert spark.read.parquet(table).count() == 2  # header-only file leaves the table as it is


def test_records_in_splits_of_any_size(spark, tmp):
    """A file in splits of a few bytes gives the records and positions of one read as a whole."""
    import csv
    import io
    from curata.sources.records import read_lines, read_records
    text = 'p,u\r\n"a ""quoted""\n\nline","x"\n"short"\n\nplain,"y\n"\n"","z"\n"one","two","three\r\nfour"\r\n' + '"n ""m""","w"\n' * 50 + '"last'
    want = [r for r in csv.reader(io.StringIO(text, newline=""), strict=False)]
    (lambda p: open(p, "w", newline="").write(text))(f"{tmp}/a.csv")
    (lambda p: open(p, "w", newline="").write("h\n"))(f"{tmp}/b.csv")
    for size in (1 << 20, 64, 7):
        rows = read_records(spark, f"{tmp}/*.csv", split_bytes=size).orderBy("file_name", "position").collect()
        assert [r.position for r in rows] == [*range(len(want)), 0]
        parsed = [next(csv.reader(io.StringIO(r.record, newline="")), []) for r in rows]
        assert parsed == [*want, ["h"]]
    assert read_lines(spark, f"{tmp}/a.csv", '"', 64).select("split").distinct().count() > 5


def test_ledger_in_splits(spark, tmp):
    rows = [(f'a "quoted" \\ back\nline {i}', f"https://h/{i}", "f", "1.50", "w") for i in range(40)]
    lines = "".join(",".join('"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"' for x in r) + "\n" for r in rows)
    open(f"{tmp}/l.csv", "w").write('"Promotion","URL","Search Folder Name","Duration (Seconds)","Host"\n' + lines + '"short"\n')
    for size in (1 << 20, 50):
        assert sorted(tuple(r) for r in read_ledger(spark, f"{tmp}/l.csv", split_bytes=size).collect()) == sorted(rows)


def test_small_splits_make_few_tasks(spark, tmp):
    """Splits are still taken one by one, but a task reads many of them; records that lie in one
    split are joined there, so none is left over for the shuffle."""
    from curata.sources.records import read_lines, read_records
    rows = [f'"text {i}\nwith ""lines""\nof its own","u{i}"' for i in range(2000)]
    open(f"{tmp}/a.csv", "w").write("p,u\n" + "\n".join(rows) + "\n")
    lines = read_lines(spark, f"{tmp}/a.csv", '"', 256)
    assert lines.select("split").distinct().count() > 200
    assert len(lines.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert [r.record for r in read_records(spark, f"{tmp}/a.csv", split_bytes=256).orderBy("position").collect()] == ["p,u", *rows]


def test_lines_of_a_record_are_joined_where_they_lie():
    import pyarrow as pa
    from curata.sources.records import _records
    at = {"inside": [False, True, False, False, True], "odd": [True, True, False, True, False]}
    b = pa.RecordBatch.from_pydict({"file": ["f"] * 5, "split": [0] * 5, "nth": [*range(5)], "value": ['"a', 'b"', "c", '"d', "e"], **at,
                                    "position": [0, 0, 1, 2, 2]})
    (got,) = _records([b])
    assert [(r["value"], r["position"], r["whole"]) for r in got.to_pylist()] == [('"a\nb"', 0, True), ("c", 1, True), ('"d\ne', 2, False)]


def test_files_in_order_grow_in_number(spark, monkeypatch):
    """A table twice as large gives more files in order, not larger ones."""
    from curata.plans import roundtrips
    monkeypatch.setattr(roundtrips, "FILE_BYTES", 1000)
    rows = spark.createDataFrame([(i, "é" * 50) for i in range(100)], "doc_id long, promotion string")
    assert roundtrips._files(rows, 4) == 10 and roundtrips._files(rows.limit(1), 4) == 4 and roundtrips._files(rows.limit(0), 3) == 3
