"""Quality by an interpolated modified Kneser-Ney model over bytes (operator 10).

Training counts the runs of ``ORDER`` bytes of all trusted texts (one map-side combined
aggregate) and derives the lower orders from them: their counts are the numbers of
different bytes that stand before a run.  Discounts, back-off weights and probabilities
are joins of these tables, kept as a table of one weight a run:

    log p(run) - log backoff(context) - log p(run without its first byte) + log backoff(run)

With that the log probability of a text is a plain sum over its runs of all orders that
the model knows, so a text is scored by a count join: its runs, counted, meet the sharded
weights by an equi-join.  To keep the join small and free of hot keys, the ``HOT`` most
frequent runs go to every executor and are summed in the map; a fixed-size Bloom filter
of all other runs drops those the model doesn't know.  Both sizes are fixed and neither
changes a result; what is left is joined.  How frequent a run of any order is comes from the
training counts, so short runs, which every text holds, are always among the first.

A text stays if its perplexity a byte is at most the quantile ``QUANTILE`` (with a margin)
of trusted texts of its language that the model wasn't trained on: half of the trusted
texts train, half calibrate.  A language without such texts takes the quantile of all.

Defined results: a null or empty text is scored by its end alone; without trusted texts there is
no model and everything stays with a null perplexity; a null language is its own class;
repeated rows get equal scores; an empty table gives an empty result.  A text's whole
bytes count.  Of the documents only id, text and language are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.common import arrow_map, stage, trimmed
from curata.llm.words import U, buffers, mix

ORDER = 5
HOT = 1 << 20
BLOOM_BITS = 1 << 25
QUANTILE = 0.998
MARGIN = 1.02
START, END = 2, 3
#: Bytes counted at once, and bytes scored at once (about 120 bytes each).
SLICE, SCORED = 500_000, 125_000
#: Ids up to which the trusted ones go to all executors; beyond, Spark joins by shuffle.
MOST_SENT = 5_000_000
_TAG = 48


def stream(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ORDER - 1 start bytes and one end byte each: (bytes, start of each)."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    starts = offsets[:-1] + ORDER * np.arange(n)
    out = np.full(len(raw) + ORDER * n, START, np.uint8)
    out[np.arange(len(raw)) + np.repeat(ORDER * np.arange(n) + ORDER - 1, lengths)] = raw
    out[starts + lengths + ORDER - 1] = END
    return out, starts


def codes(x: np.ndarray) -> np.ndarray:
    """The run of ORDER bytes that ends at each position (the first ORDER - 1 are no runs)."""
    v = np.zeros(len(x), np.int64)
    for k in range(ORDER):
        v[ORDER - 1:] = (v[ORDER - 1:] << 8) | x[k:len(x) - ORDER + 1 + k]
    return v


def slices(column: pa.Array, size: int):
    """(from, to, bytes, starts) of consecutive texts of about ``size`` bytes."""
    raw, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi, *stream(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def counts(texts: DataFrame) -> DataFrame:
    """(g, c): every run of ORDER bytes of the texts and how often it stands."""
    def run(batches):
        for b in batches:
            for _, _, x, starts in slices(b.column(0), SLICE):
                v = codes(x)
                scored = np.ones(len(x), bool)
                for k in range(ORDER - 1):
                    scored[starts + k] = False
                g, c = np.unique(v[scored], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c.astype(np.int64))], ["g", "c"])

    return arrow_map(texts, trimmed(run), "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c"))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order from its counts of counts."""
    n = {r["c"]: r["n"] for r in table.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    usual = (0.5, 1.0, 1.5)
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(d if 0 < d < i + 1 else u for i, (d, u) in enumerate(zip(raw, usual)))


def _log(x: Column) -> Column:
    return F.when(x.isNotNull(), F.log(F.greatest(x, F.lit(1e-12))))  # greatest() alone would skip a null


@dataclass
class Model:
    """Weights by run (staged: key, w, c) and the weight of a byte never seen."""

    weights: DataFrame | None = None
    unseen: float = 0.0
    hot: dict = field(default_factory=dict)
    bloom: np.ndarray | None = None


def train(texts: DataFrame) -> Model:
    """Learn from a column of trusted texts."""
    tables = {ORDER: stage(counts(texts))}
    for k in range(ORDER - 1, 0, -1):  # how many different bytes stand before a run
        tables[k] = stage(tables[k + 1].groupBy(F.col("g").bitwiseAND((1 << 8 * k) - 1).alias("g")).agg(F.count("*").alias("c")))
    if tables[1].isEmpty():
        return Model()
    lower, found, contexts, unseen = None, [], {}, 0.0
    for k in range(1, ORDER + 1):
        t = tables[k]
        d1, d2, d3 = _discounts(t)
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = t.groupBy(F.shiftright("g", 8).alias("ctx")).agg(
            F.sum("c").alias("total"), F.sum(discount).alias("freed"))
        context = stage(context.select("ctx", "total", (F.col("freed") / F.col("total")).alias("backoff")))
        contexts[k] = context
        t = t.withColumn("ctx", F.shiftright("g", 8)).join(context, "ctx")
        own = (F.col("c") - discount) / F.col("total")
        if k == 1:
            unseen = math.log(max(context.first()["backoff"], 1e-12) / 257)
            t = t.select("g", "c", (own + F.col("backoff") / 257).alias("p"))
            t = t.withColumn("w", F.log("p"))
        else:
            t = t.withColumn("s", F.col("g").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(
                lower.select(F.col("g").alias("s"), F.col("p").alias("q")), "s")
            t = t.withColumn("p", own + F.col("backoff") * F.col("q"))
            t = t.select("g", "c", "p", (F.log("p") - _log(F.col("backoff")) - F.log("q")).alias("w"))
        lower = stage(t)
        found.append(lower)
    out = None
    for k, t in enumerate(found, 1):
        t = t.select("g", "c", "w")
        if k < ORDER:  # as the context of the next byte
            t = (t.join(contexts[k + 1].select(F.col("ctx").alias("g"), "total", "backoff"), "g", "full_outer")
                 .select("g", F.coalesce("c", "total").alias("c"),
                         (F.coalesce("w", F.lit(0.0)) + F.coalesce(_log(F.col("backoff")), F.lit(0.0))).alias("w")))
        t = t.select(F.col("g").bitwiseOR(k << _TAG).alias("key"), "w", "c")
        out = t if out is None else out.union(t)
    model = Model(stage(out), unseen)
    top = model.weights.join(F.broadcast(frequent(frequencies(tables[ORDER]), HOT)), "key", "left_semi").select("key", "w").toArrow()
    model.hot = _hash_table(top["key"].to_numpy(), top["w"].to_numpy())
    model.bloom = _bloom(model.weights, BLOOM_BITS)
    return model


def frequencies(runs: DataFrame) -> DataFrame:
    """Staged (key, c): how often the runs of all orders stand in the texts counted by ``runs`` (g, c).

    Every place has one run of full order, so a shorter run's places are those of the runs that
    end with it; what stands before a text's first byte is looked up once a text."""
    out = None
    for k in range(1, ORDER + 1):
        end = F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1)).bitwiseOR(F.lit(k << _TAG))
        t = runs.groupBy(end.alias("key")).agg(F.sum("c").alias("c"))
        out = t if out is None else out.union(t)
        if k < ORDER:
            start = sum(START << 8 * i for i in range(ORDER - 1))
            first = runs.where(F.shiftright("g", 8) == F.lit(start)).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"))
            out = out.union(first.select(F.lit(sum(START << 8 * i for i in range(k)) | k << _TAG).cast("long").alias("key"), "c"))
    return stage(out)


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The keys of the runs from that count on from which there are at most ``most``."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 64).cast("int")  # 64 levels a doubling, so few in all
    sizes = counted.where("c > 0").groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r["l"]):
        total += r["n"]
        if total > most:
            break
        least = r["l"]
    return counted.where(F.lit(False) if least is None else (F.col("c") > 0) & (level >= least)).select("key")


def _positions(key: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(key.view(np.uint64))
    return [(h % U(size)).astype(np.int64), ((h >> U(32)) * U(2654435761) % U(size)).astype(np.int64)]


def _bloom(weights: DataFrame, size: int) -> np.ndarray:
    """The filter's bytes: each task sets bits, an aggregate joins them, ``size`` bits in all."""
    def run(batches):
        bits = np.zeros(size, bool)
        for b in batches:
            for p in _positions(b.column(0).to_numpy(), size):
                bits[p] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        for lo in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[lo:lo + 100_000]), pa.array(words[at[lo:lo + 100_000]])], ["at", "word"])

    got = arrow_map(weights.select("key").coalesce(8), run, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[got["at"].to_numpy()] = got["word"].to_numpy()
    return words.view(np.uint8)


def _hash_table(keys: np.ndarray, weights: np.ndarray) -> dict:
    """Open addressing: arrays of keys (-1: free) and weights."""
    bits = max(10, int(len(keys) * 2 - 1).bit_length())  # at most half full
    slot, table, value = _slot(keys, bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
    todo = np.arange(len(keys))
    while len(todo):
        free = todo[table[slot[todo]] < 0]
        put = free[np.unique(slot[free], return_index=True)[1]]
        table[slot[put]], value[slot[put]] = keys[put], weights[put]
        todo = np.setdiff1d(todo, put, assume_unique=True)
        slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)
    return {"bits": bits, "keys": table, "weights": value}


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * U(0x9E3779B97F4A7C15)) >> U(64 - bits)).astype(np.int64)


def _lookup(table: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, rows of keys that aren't in the table)."""
    slot = _slot(keys, table["bits"])
    found = table["keys"][slot]
    out = np.where(found == keys, table["weights"][slot], 0.0)
    todo, missing = np.flatnonzero((found != keys) & (found >= 0)), [np.flatnonzero(found < 0)]
    mask = len(table["keys"]) - 1
    while len(todo):
        slot[todo] = (slot[todo] + 1) & mask
        found = table["keys"][slot[todo]]
        hit = found == keys[todo]
        out[todo[hit]] = table["weights"][slot[todo[hit]]]
        missing.append(todo[found < 0])
        todo = todo[~hit & (found >= 0)]
    return out, np.concatenate(missing)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, lang, n, perplexity) of every row: perplexity a byte, the end counted as one."""
    spark, unseen, size = docs.sparkSession, model.unseen, SCORED
    # a worker loads the tables once, not with every task
    tables = spark.sparkContext.broadcast((model.hot, model.bloom))
    d = docs.select(docs[key].cast("long").alias("id"), docs[text], docs[lang].cast("string").alias("lang"))

    def run(batches):
        part, row = TaskContext.get().partitionId() << 40, 0
        hot, bloom = tables.value
        for b in batches:
            for lo, hi, x, starts in slices(b.column(1), size):
                n = hi - lo
                v = codes(x)
                ends = np.append(starts[1:], len(x))
                total = np.zeros(len(x))
                cold = []
                for k in range(1, ORDER + 1):
                    keys = (v & ((1 << 8 * k) - 1)) | (k << _TAG)
                    # the last start byte is a context only; it has no run of full order of its own
                    for s in range(ORDER - 2):
                        keys[starts + s] = -2
                    if k < ORDER:
                        keys[starts + ORDER - 2] = sum(START << 8 * i for i in range(k)) | (k << _TAG)
                    else:
                        keys[starts + ORDER - 2] = -2
                    w, at = _lookup(hot, keys)
                    at = at[keys[at] >= 0]
                    miss = keys[at]
                    known = np.ones(len(miss), bool)
                    for p in _positions(miss, len(bloom) * 8):
                        known &= (bloom[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                    if k == 1:
                        w[at[~known]] = unseen
                    cold.append((at[known], miss[known]))
                    total += w
                sums = np.concatenate([[0.0], np.cumsum(total)])
                uid = part + row + np.arange(n)
                row += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), b.column(0).slice(lo, n), b.column(2).slice(lo, n), pa.array((ends - starts - ORDER + 1).astype(np.int64)),
                     pa.array(sums[ends] - sums[starts]), pa.nulls(n, pa.int64())], ["uid", "id", "lang", "n", "s", "key"])
                at, keys = np.concatenate([c[0] for c in cold]), np.concatenate([c[1] for c in cold])
                if len(at):
                    doc = np.searchsorted(starts, at, side="right") - 1
                    order = np.lexsort((keys, doc))
                    doc, keys = doc[order], keys[order]
                    new = np.ones(len(doc), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])
                    first = np.flatnonzero(new)
                    m = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[doc[first]]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.string()),
                         pa.array(np.diff(np.append(first, len(doc))).astype(np.int64)), pa.nulls(m, pa.float64()), pa.array(keys[first])],
                        ["uid", "id", "lang", "n", "s", "key"])

    both = stage(arrow_map(d, trimmed(run), "uid bigint, id bigint, lang string, n bigint, s double, key bigint"))
    tables.destroy()  # what is written needs them no more
    base = both.where("key is null").select("uid", "id", "lang", "n", "s")
    # an unknown byte that the filter let pass still needs its weight
    joined = both.where("key is not null").select("uid", "key", "n").join(model.weights.select("key", "w"), "key", "left")
    weight = F.coalesce("w", F.when(F.shiftright("key", _TAG) == 1, F.lit(unseen)).otherwise(0.0))
    extra = joined.groupBy("uid").agg(F.sum(F.col("n") * weight).alias("more"))
    out = base.join(extra, "uid", "left")
    return out.select("id", "lang", "n", F.exp(-(F.col("s") + F.coalesce("more", F.lit(0.0))) / F.col("n")).alias("perplexity"))


def trains(key: Column) -> Column:
    """Which trusted texts train; the others calibrate."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(2)) == 0


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """(key, lang, perplexity, threshold, kept) of every row; ``trusted`` holds the trusted ids in ``key``."""
    ids = stage(trusted.select(F.col(key).cast("long").alias("t")).where("t is not null").distinct())
    count = ids.count()
    side = F.broadcast(ids) if count <= MOST_SENT else ids
    chosen = docs.select(docs[key].cast("long").alias("t"), docs[text].alias("x")).where(trains(F.col("t"))).where("x is not null")
    model = train(chosen.join(side, "t", "left_semi").select("x"))
    if model.weights is None:
        null = F.lit(None).cast("double")
        return docs.select(docs[key].alias(key), docs[lang].alias("lang"), null.alias("perplexity"), null.alias("threshold"), F.lit(True).alias("kept"))
    scored = stage(score(docs, model, key, text, lang))
    held = scored.where(~trains(F.col("id"))).join(side, scored["id"] == F.col("t"), "left_semi")
    bound = F.percentile_approx("perplexity", quantile, 100_000) * margin
    by_lang = held.groupBy("lang").agg(bound.alias("own"))  # a row a language
    overall = held.agg(bound.alias("all")).first()["all"]
    out = scored.join(F.broadcast(by_lang.withColumnRenamed("lang", "l")), F.col("lang").eqNullSafe(F.col("l")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return out.select(F.col("id").alias(key), "lang", "perplexity", threshold.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that stay."""
    gone = stage(judge(docs, trusted, key, text, lang).where("not kept").select(key).distinct())
    count = gone.count()
    return docs.join(F.broadcast(gone) if count <= MOST_SENT else gone, key, "left_anti").select(*docs.columns)
