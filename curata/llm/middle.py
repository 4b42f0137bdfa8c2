"""Fill-in-middle transformation by content-defined chunk memoization (operator 11).

A text is cut into a prefix, a middle and a suffix at two code points, and its parts are
written in another order behind the marks ``<P>``, ``<S>`` and ``<M>``.  Where the cuts lie
is drawn from the hash of the document's id; finding them takes the number of code points
before every byte:

1. a rolling hash over ``WINDOW`` bytes ends a chunk wherever its low bits are zero, so that
   equal passages fall into equal chunks, whatever stands before them;
2. a chunk's boundary summary (its code points, whether a mark stands in it, its first and
   last two bytes) is kept in a cache by content: the chunk's hash finds the entry, its bytes
   verify it.  Passages that documents share are summed up once a task;
3. the summaries of a text combine from left to right: running sums of the counts say how
   long the text is and which chunk holds a cut, and only that chunk is searched; two bytes
   on either side of a chunk's edge show a mark that crosses it.

The cache holds ``CACHE_BYTES`` of chunks and starts anew beyond; a chunk has ``MOST`` bytes
at most.  Neither changes a result.  Map-only: nothing is shuffled.

Defined results: a null text counts as empty and is plain; a null id draws from ``1:``; a text that
holds a mark is plain; repeated rows give equal rows; texts of any length are whole; an
empty table gives an empty result.  Only the id and text columns are read, so other columns
never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.common import arrow_map
from curata.llm.words import buffers

#: The marks before prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: Of 100 documents, those from here on stay plain; of the others, those below the second are ``spm``.
PLAIN_FROM, SPM_BELOW = 90, 20
#: Bytes under the rolling hash (a power of two, 32 at most), bits that are zero at a chunk's end, most bytes of one.
WINDOW, BITS, MOST = 32, 10, 1 << 16
CACHE_BYTES = 32 << 20
#: Bytes of text hashed and written at once (a longer text alone).
SLICE = 4_000_000

_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(raw: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The hash of the ``window`` bytes that end at each byte (fewer at the start).

    Sums over twice as many bytes come from two sums, one of them moved and shifted."""
    h, width = _GEAR[raw], 1
    while width < window:
        twice = h.copy()
        twice[width:] += h[:-width] << np.uint32(width)
        h, width = twice, 2 * width
    return h


def chunk_ends(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS, most: int = MOST) -> np.ndarray:
    """Where the chunks of all texts end: by content, at a text's end, and after ``most`` bytes."""
    if not len(raw):
        return np.zeros(0, np.int64)
    cut = (rolling(raw) & np.uint32((1 << bits) - 1)) == 0
    ends = np.flatnonzero(cut).astype(np.int64) + 1
    ends = np.union1d(ends, offsets[1:][np.diff(offsets) > 0])
    starts = np.concatenate([[0], ends[:-1]])
    more = (ends - starts - 1) // most  # cuts inside a chunk that content alone leaves too long
    if more.any():
        owner = np.repeat(np.arange(len(ends)), more)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(more) - more, more) + 1
        ends = np.union1d(ends, starts[owner] + nth * most)
    return ends


def leads(content: bytes) -> np.ndarray:
    """Places of the bytes that begin a code point."""
    return np.flatnonzero((np.frombuffer(content, np.uint8) & 0xC0) != 0x80)


class Summaries:
    """Boundary summaries (code points, holds a mark, first two bytes, last two bytes) by content."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.known, self.reused = most, 0, {}, 0

    def of(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        got = self.known.get(chunk)  # found by hash, verified by its bytes
        if got is not None:
            self.reused += 1
            return got
        got = (len(leads(chunk)), any(m in chunk for m in _MARKS), chunk[:2], chunk[-2:])
        if self.held + len(chunk) > self.most:
            self.known, self.held = {}, 0
        self.known[chunk] = got
        self.held += len(chunk)
        return got


class Chunked:
    """One text as its chunks with their combined summaries."""

    def __init__(self, chunks: list[bytes], summaries: Summaries):
        self.chunks, self.before, self.marked = chunks, [0], False
        tail = b""
        for c in chunks:
            points, marked, head, last = summaries.of(c)
            edge = tail + head
            self.marked = self.marked or marked or (len(edge) > 2 and any(m in edge for m in _MARKS))
            self.before.append(self.before[-1] + points)
            tail = last if len(c) > 1 else (tail + last)[-2:]

    @property
    def points(self) -> int:
        return self.before[-1]

    def split(self, at: int) -> tuple[int, int]:
        """(chunk, byte in it) before which ``at`` code points stand."""
        if at >= self.points:
            return len(self.chunks), 0
        k = int(np.searchsorted(self.before, at, side="right")) - 1
        return k, int(leads(self.chunks[k])[at - self.before[k]])

    def between(self, a: tuple[int, int], b: tuple[int, int]) -> bytes:
        if a[0] == b[0]:
            return self.chunks[a[0]][a[1]:b[1]] if a[0] < len(self.chunks) else b""
        last = [self.chunks[b[0]][:b[1]]] if b[0] < len(self.chunks) else []
        return b"".join([self.chunks[a[0]][a[1]:], *self.chunks[a[0] + 1:b[0]], *last])


def rewritten(text: Chunked, digest: str) -> tuple[str, int | None, int | None, bytes]:
    """(form, code points of prefix and of middle, output) of a text, drawn by a hex digest."""
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    end = (len(text.chunks), 0)
    if not text.points or text.marked or h3 % 100 >= PLAIN_FROM:
        return "plain", None, None, text.between((0, 0), end)
    low, high = sorted((h1 % (text.points + 1), h2 % (text.points + 1)))
    a, b = text.split(low), text.split(high)
    p, m, s = _MARKS[0] + text.between((0, 0), a), _MARKS[2] + text.between(a, b), _MARKS[1] + text.between(b, end)
    spm = h4 % 100 < SPM_BELOW
    return "spm" if spm else "psm", low, high - low, (s + p if spm else p + s) + m


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS, most: int = MOST) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        summaries = Summaries()
        for b in batches:
            raw, offsets = buffers(b.column(1))
            digests = b.column(2)
            lo, n = 0, len(offsets) - 1
            while lo < n:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1)
                part, edge = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                ends = chunk_ends(part, edge, bits, most)
                data, stop = part.tobytes(), np.searchsorted(ends, edge[1:], side="right").tolist()
                at, first, rows = ends.tolist(), 0, []
                start = 0
                for i in range(hi - lo):
                    chunks = []
                    for k in range(first, stop[i]):
                        chunks.append(data[start:at[k]])
                        start = at[k]
                    first = stop[i]
                    whole = Chunked(chunks, summaries)
                    rows.append((whole.points, *rewritten(whole, digests[lo + i].as_py())))
                points, form, prefix, middle, output = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(points, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    ["k", "n", "form", "prefix_chars", "middle_chars", "output"])
                lo = hi

    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(docs[key].cast("string"), F.lit(""))).cast("binary"), 256)
    out = arrow_map(docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t"), drawn.alias("h")), run,
                    f"k {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return out.withColumnRenamed("k", key)


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form.

    No text with a mark is rewritten, and no mark begins as another ends, so each mark of an
    output is found at its first place."""
    def part(first: str, then: str | None) -> Column:
        start = F.locate(first, output) + len(first)
        size = F.locate(then, output) - start if then else F.length(output)
        return F.substring(output, start, size)

    psm = F.concat(part(PREFIX, SUFFIX), part(MIDDLE, None), part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), part(MIDDLE, None), part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def oracle() -> str:
    """DuckDB SQL for the digests of ``transform`` over documents."""
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
      u AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
      f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
             WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM u),
      p AS (SELECT *, '{PREFIX}' || substr(t, 1, a) AS pre, '{MIDDLE}' || substr(t, a + 1, b - a) AS mid, '{SUFFIX}' || substr(t, b + 1) AS suf FROM f)
      SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN pre || suf || mid ELSE suf || pre || mid END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM p"""
