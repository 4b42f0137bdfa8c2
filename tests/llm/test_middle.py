"""Fill-in-middle by chunk memoization: brute-force version, chunk edges, exact round trips, edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curata.llm import catalog, middle
from curata.llm.words import buffers


def brute(key, text):
    t = text or ""
    d = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (key, n, "plain", None, None, t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "<P>" + t[:a], "<M>" + t[a:b], "<S>" + t[b:]
    if h[3] % 100 < 20:
        return (key, n, "spm", a, b - a, s + p + m)
    return (key, n, "psm", a, b - a, p + s + m)


def texts():
    random.seed(11)
    pool = ["a", "b c", "é", "日本", "😀", "\n", "<", "P>", "<S", ">", "M>", " of the "]
    out = ["".join(random.choice(pool) for _ in range(random.randint(0, 60))) for _ in range(300)]
    passage = "a passage that many texts share, word for word. " * 40
    out += [passage + str(i) for i in range(20)] + [str(i) + passage for i in range(20)]
    return out + [None, "", "x", "é" * 70_000, "x" * 200_000, "<P>", "a<S>b", "<M", "word " * 50_000, "word " * 50_000]


def table(spark, rows):
    """Documents with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "n", "psm", 1) for i, t in rows], "doc_id long, text string, output string, form string, n long").repartition(3)


@pytest.mark.parametrize("bits,most", [(middle.BITS, middle.MOST), (2, 7), (6, 1)])
def test_equals_brute_force(spark, bits, most):
    rows = [(i, t) for i, t in enumerate(texts()) if most > 7 or len(t or "") < 5000] + [(3, "repeated id"), (3, "repeated id"), (None, "no id")]
    out = middle.transform(table(spark, rows), bits=bits, most=most).withColumn("back", middle.restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in out.collect()]
    want = [(*brute(i, t), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_columns(spark):
    """The registered query's own columns, from its whole table."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = catalog.op11_middle(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        key, n, form, prefix, mid, output = brute(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (key, n, form, prefix, mid, sha(output), sha(docs[key] or ""))


def test_empty_table(spark):
    out = middle.transform(table(spark, [(1, "a")]).where("doc_id > 1"))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and out.count() == 0


def test_chunks_depend_on_content_only():
    """Behind the window's first bytes a shared passage falls into the same chunks, whatever stands before it."""
    passage = " ".join(str(i * 7919) for i in range(3000))
    raw, offsets = buffers(pa.array(["one " + passage, "another beginning " + passage]))
    ends = middle.chunk_ends(raw, offsets)
    data, starts = raw.tobytes(), np.concatenate([[0], ends[:-1]])
    chunks = [data[a:b] for a, b in zip(starts, ends)]
    k = int(np.searchsorted(ends, offsets[1])) + 1
    assert chunks[1:k] == chunks[k + 1:] and len(chunks[1:k]) > 5
    assert b"".join(chunks) == data


def test_cache_reuses_and_stays_bounded():
    s = middle.Summaries(most=100)
    assert s.of(b"a<P>") == (4, True, b"a<", b"P>") and s.of(b"a<P>") == (4, True, b"a<", b"P>") and s.reused == 1
    for i in range(100):
        s.of(b"%09d" % i)
        assert s.held <= 100 and sum(map(len, s.known)) == s.held
    assert s.of("é日".encode()[1:]) == (1, False, "é日".encode()[1:3], "é日".encode()[-2:])  # cut inside a code point
