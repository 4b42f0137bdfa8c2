"""Quality rules: statistics against brute force, the learner on planted concepts, edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curata.llm import catalog, rules

EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "a b c a b c a b c"), (6, "x\n\nx\n x\nx"), (7, "é 日本 😀 é 日本 😀"), (7, "repeated id"),
        (None, "no id"), (8, "w " * 30_000), (9, "a b c x a b c y a b c"), (10, "a\x0bb\x0cc\rd\x1ce a\x0bb\x0cc"), (11, "#*$%&|<> <<a>>"),
        (12, " ".join(str(i % 997) for i in range(20_000)))]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeated = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated)


def failed(n_words, n_repeat):
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def table(spark, rows):
    """Documents with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "k", 1, True) for i, t in rows], "doc_id long, text string, k string, n_words long, kept boolean").repartition(3)


def test_statistics_equal_brute_force(spark):
    random.seed(12)
    rows = EDGE + [(100 + i, "".join(random.choice(["a ", "b ", "c ", "aa ", "\n", "<", "  "]) for _ in range(random.randint(0, 80)))) for i in range(300)]
    got = [tuple(r) for r in rules.statistics(table(spark, rows)).select("k", *rules.STATISTICS).collect()]
    assert sorted(got, key=repr) == sorted([(i, *brute(t)) for i, t in rows], key=repr)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = catalog.op12_rules(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeat = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, lines, repeat, failed(n, repeat))
        assert r.kept == (not r.base_failed and r.rule is None)
    passed = [r for r in rows if not r.base_failed and r.doc_id in labels]
    good, bad = ([r.kept for r in passed if labels[r.doc_id] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def plain(i, extra=""):
    """A document of 60 different words that passes the base rules."""
    return " ".join(f"w{i}x{j}{extra}" for j in range(60))


def test_learns_two_concepts_in_order(spark):
    """Bad are texts with many symbols, and long ones that shout; each takes a rule of its own."""
    random.seed(3)
    rows, labels = [], []
    for i in range(900):
        kind = i % 6
        text = plain(i, "#" if kind == 0 else "")
        if kind == 1:
            text = (text + " " + plain(i + 10_000)).upper()
        if kind == 2:
            text = text.upper()  # short and loud is fine
        if kind == 3:
            text += " " + plain(i + 10_000)  # long and quiet, too
        rows.append((i, text))
        labels.append((i, int(kind > 1), 0))
    lab = spark.createDataFrame(labels + [(5000, None, 0), (None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    docs = table(spark, rows + EDGE[:4])
    learnt = rules.learn(rules.stage(rules.statistics(docs)), lab)
    assert len(learnt.rules) == 2 and sorted(map(len, learnt.rules)) == [1, 2]
    out = {r.doc_id: r.kept for r in rules.judge(docs, lab).collect() if r.doc_id and r.doc_id > 20}
    assert all(out[i] == (i % 6 > 1) for i in range(21, 900))


def test_without_labels_the_base_rules_decide(spark):
    docs = table(spark, [(i, plain(i)) for i in range(30)] + EDGE)
    for labels in ([], [(1, 1, 0)], [(i, 0, 0) for i in range(30)]):
        out = rules.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert out.where(F.col("kept") == F.col("base_failed")).count() == 0 and out.count() == 30 + len(EDGE)


def test_empty_table(spark):
    out = rules.judge(table(spark, EDGE).where("doc_id > 1000"), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert out.columns == ["doc_id", *rules.STATISTICS, "base_failed", "kept", "rule"] and out.count() == 0


def test_no_python_on_the_main_path(spark):
    plan = rules.judge(table(spark, EDGE), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    staged = rules.statistics(table(spark, EDGE))._jdf.queryExecution().toString()
    assert not re.search("Python|InArrow|Pandas", staged)


@pytest.mark.parametrize("p,n,p0,n0", [(0, 5, 10, 10), (10, 0, 10, 10), (5, 5, 10, 10)])
def test_gain(p, n, p0, n0):
    assert (rules._gain(p, n, p0, n0) > 0) == (p > n)
