"""Scalar text rules: literal inputs and outputs, and properties."""

import random
import re

from conftest import one_col
from curata.functions import text as X


URLS = {
    None: None, "": "", "   ": "", "HTTP://Example.com/a": "http://example.com/a",
    "http://www.example.com/a//": "https://example.com/a/", "https://x.org/a/?": "https://x.org/a",
    "https://x.org/a?utm_source=f&b=2": "https://x.org/a&b=2", "https://x.org/a?b=2&utm_medium=x": "https://x.org/a?b=2",
    "https://x.org/a?utm_x=a=b": "https://x.org/a", "https://x.org/a/#frag": "https://x.org/a", "https://x.org/a#frag": "https://x.org/a#frag",
    "https://x.org/a\n": "https://x.org/a", "https://x.org/?sid=9": "https://x.org", "https://x.org/a?fbclid=1": "https://x.org/a",
    "https://x.org/a?mc_cid=3&gclid=7": "https://x.org/a", "https://www.X.org/": "https://x.org", " https://x.org/a ": "https://x.org/a",
    "http://www.x.org/a?sid=1&sid=2": "https://x.org/a", "https://x.org/a b/": "https://x.org/a b",
}
CLEAN = {
    None: "", "": "", "  a \n b  ": "a b", "caf\u00e9 \ufb01ne \u00bd": "cafe fine 12", '\x1b[31mred\x1b[0m "q"': "red 'q'",
    "a\tb\x7fc": "abc", " lead": "lead", "x\r\ny": "xy", "\u00a0z": "z", "\u65e5\u672c": "",
}


def test_normalize_url_literals(spark):
    assert one_col(spark, list(URLS), X.normalize_url) == list(URLS.values())


def test_normalize_url_properties(spark):
    rnd = random.Random(7)
    parts = ["http://", "https://", "www.", "HTTP://", "x.org", "/", "?", "&", "utm_a=1", "sid=2",
             "fbclid=3", "mc_x=4", "a=b", " ", "Z", "\u00e9"]
    cases = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    for url, got in zip(cases, one_col(spark, cases, X.normalize_url)):
        assert got == got.lower().strip(), url
        assert not re.search(r"[?&](sid|fbclid)=", got), url
        assert not got.startswith("http://") or not url.startswith("http://"), url


def test_clean_text_literals(spark):
    assert one_col(spark, list(CLEAN), X.clean_text) == list(CLEAN.values())


def test_clean_text_properties(spark):
    rnd = random.Random(5)
    cases = ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(1, 32), rnd.randrange(0xA0, 0x2000)]))
                     for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    once = one_col(spark, cases, X.clean_text)
    assert all(c.isascii() and not re.search(r"[\x00-\x1f\x7f\"]|  ", c) and c == c.strip() for c in once)


def test_slug_and_strip(spark):
    titles = ["gaza Saved Search", "  A--b__c  ", "café ½!", "___", "x́y"]
    assert one_col(spark, titles, X.slug) == ["gaza_Saved_Search", "A_b_c", "caf\u00e9_\u00bd", "", "x_y"]
    ws = [" a ", "\x1c a\x1f", " b　", "\tc\n", None]
    assert one_col(spark, ws, X.strip_ws) == [None if w is None else w.strip() for w in ws]


def test_cut_limits_post(spark):
    s = ["x" * 280, "x" * 281, "y" * 500, "short"]
    assert one_col(spark, s, X.cut) == [v if len(v) <= 280 else v[:277] + "..." for v in s]
    promos = ["a" * 250 + " https://example.org/verylongpath", "b" * 258, "see http://x.y/z and https://q"]
    assert one_col(spark, promos, X.link_free_length) == [len(re.sub(r"https?://\S+", "", p)) for p in promos]
    assert one_col(spark, ["  ", "", None, "ok"], X.empty_fallback) == [X.EMPTY_FALLBACK] * 3 + ["ok"]


def test_folder_from_file_name(spark):
    import pytest
    from pyspark.errors import PySparkException
    assert one_col(spark, ["folder_urls_gaza_Saved_Search.csv"],
                   lambda c: X.folder_from_file_name(c, "folder_urls_")) == ["gaza_Saved_Search"]
    with pytest.raises(Exception) as e:
        one_col(spark, ["other.csv"], lambda c: X.folder_from_file_name(c, "folder_urls_"))
    assert isinstance(e.value, (PySparkException, Exception))


def test_clean_up_holds_a_part_of_a_batch():
    """Of 40 MB of text a few megabytes are Python strings at a time."""
    import tracemalloc
    import pyarrow as pa
    from curata.functions import text as X
    from curata.functions.batches import parts
    texts = pa.array(["é" + "x" * 4000, None, "", "plain"] * 10_000)
    tracemalloc.start()
    got = X._nfkd_ascii.func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist()[:4] == ["e" + "x" * 4000, None, "", "plain"] and len(got) == len(texts) and peak < 8 << 20
    assert list(parts(pa.array(["a" * 10, "b" * 90, None, "c"]), 20)) == [(0, 1), (1, 2), (2, 4)] and not list(parts(pa.array([], pa.string())))
