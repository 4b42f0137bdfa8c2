"""Language identification by hierarchical discrimination (operator 9).

The language family is predicted first; one-versus-one linear support vector machines
then separate the languages of that family.  Families are told apart by one-versus-one
machines too.  The features are hashed runs of 3 and 4 bytes of the whole text, letters
only (ASCII letters in lower case, other ASCII bytes as blanks).

The machines have no bias, so a text's decision is a plain sum over its runs and texts of
any length are scored in one pass, in slabs.  ``fit`` learns from a bounded sample:
about ``sample`` labelled texts a language.

Defined results: a text that is null or has no letter is ``und`` with score 0; without
any labelled text everything is ``und``; repeated rows get equal results; ties go to the
language that comes first in the alphabet; an empty table gives an empty result.  Only
key, text and (for learning) language columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.common import arrow_map, trimmed
from curata.llm.words import LOWER, buffers

UND = "und"
#: Labelled texts a language that the machines learn from (about; a hash decides).
SAMPLE = 300
BITS = 14
#: Families of languages by ISO 639-1 code; any other language is its own family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

#: Letters stay (in lower case), other ASCII bytes become blanks, UTF-8 continuation stays.
_LETTERS = LOWER.copy()
_LETTERS[:128][~np.isin(LOWER[:128], np.arange(97, 123))] = 32
#: Bytes of texts taken at once (a longer one alone; about 60 bytes each), and bytes scored at once.
SLICE, SLAB = 1 << 17, 1 << 17


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, lang)


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as letters with a blank before and after each: (bytes, starts, ends)."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    starts = offsets[:-1] + 2 * np.arange(n)
    out = np.full(len(raw) + 2 * n, 32, np.uint8)
    out[np.arange(len(raw)) + np.repeat(2 * np.arange(n) + 1, lengths)] = _LETTERS[raw]
    return out, starts, starts + lengths + 2


def run_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """A bucket for every run of ``size`` (3 or 4) bytes."""
    n = len(x) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    v = np.zeros(n, np.uint32)
    for k in range(size):
        v = (v << np.uint32(8)) | x[k:k + n]
    return (v * np.uint32(0x9E3779B1 if size == 3 else 0x85EBCA6B)) >> np.uint32(32 - BITS)


@dataclass
class Machines:
    """One-versus-one machines: columns of ``weights`` between classes ``a`` and ``b``."""

    langs: list[str] = field(default_factory=list)
    families: dict[str, list[int]] = field(default_factory=dict)
    pairs: list[tuple[str, int, int]] = field(default_factory=list)  # (level, a, b): level "" or a family
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    slope: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean weight of each text's runs for every machine, a slice of texts at a time."""
        parts, lo, n = [], 0, len(offsets) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1)
            parts.append(self._margins(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
            lo = hi
        return np.concatenate(parts) if parts else np.zeros((0, self.weights.shape[1]))

    def _margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, starts, ends = padded(raw, offsets)
        n, c = len(starts), self.weights.shape[1]
        total, count = np.zeros((n, c)), np.zeros(n)
        for size in (3, 4):
            last = np.maximum(ends - size + 1, starts)
            count += last - starts
            lo = 0
            while lo < len(x):
                hi = min(len(x), lo + SLAB)
                h = run_hashes(x[lo:min(len(x), hi + size - 1)], size)[:hi - lo]
                first, stop = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, hi)
                s = np.clip(starts[first:stop] - lo, 0, len(h))
                e = np.clip(last[first:stop] - lo, s, len(h))
                for k in range(c):
                    sums = np.zeros(len(h) + 1)
                    np.cumsum(self.weights[:, k][h], out=sums[1:])
                    total[first:stop, k] += sums[e] - sums[s]
                lo = hi
        return total / np.maximum(count, 1)[:, None]

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of every text."""
        m = self.margins(raw, offsets)
        p = 1 / (1 + np.exp(-np.clip(m * self.slope, -30, 30)))
        names = list(self.families)
        best, family_score = self._vote("", len(names), p)
        lang, score = np.zeros(len(m), np.int64), family_score
        for f, name in enumerate(names):
            own = self.families[name]
            rows = best == f
            if len(own) == 1:
                lang[rows] = own[0]
                continue
            inner, inner_score = self._vote(name, len(own), p)
            lang[rows] = np.array(own)[inner[rows]]
            score = np.where(rows, score * inner_score, score)
        return lang, score

    def _vote(self, level: str, size: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most duels won, then the largest sum; its mean probability."""
        wins, sums = np.zeros((len(p), size)), np.zeros((len(p), size))
        for k, (at, a, b) in enumerate(self.pairs):
            if at == level:
                wins[:, a] += p[:, k] >= 0.5
                wins[:, b] += p[:, k] < 0.5
                sums[:, a] += p[:, k]
                sums[:, b] += 1 - p[:, k]
        best = np.argmax(wins * size * 2 + sums, axis=1)
        if size == 1:
            return best, np.ones(len(p))
        return best, sums[np.arange(len(p)), best] / (size - 1)


def svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 40) -> np.ndarray:
    """Weights of a linear support vector machine without bias over some rows of x, by dual
    coordinate descent."""
    k = (x @ x.T)[np.ix_(rows, rows)]
    alpha, grad = np.zeros(len(y)), np.zeros(len(y))  # grad = K (alpha * y)
    share = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    order, random = np.arange(len(y)), np.random.default_rng(0)
    for _ in range(epochs):
        random.shuffle(order)
        most = 0.0
        for i in order:
            new = min(max(alpha[i] + (1 - y[i] * grad[i]) / max(k[i, i], 1e-9), 0.0), c * share[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                grad += step * y[i] * k[i]
                most = max(most, abs(step))
        if most < 1e-4:
            break
    share = np.zeros(len(x), np.float32)
    share[rows] = alpha * y
    return share @ x


def _slope(m: np.ndarray, y: np.ndarray) -> float:
    """One-parameter logistic calibration of a machine's margins."""
    scale = max(np.abs(m).mean(), 1e-12)
    best, least = 1.0, np.inf
    for s in np.geomspace(0.5, 20, 25):
        loss = np.logaddexp(0, -y * m * s / scale).mean() + 1e-4 * s
        if loss < least:
            best, least = s, loss
    return best / scale


def learnable(key: Column) -> Column:
    """Which documents may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return ~held_out(key) & key.isNotNull()


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE, allowed: Column | None = None) -> Machines:
    """Learn from about ``sample`` labelled texts of each language (the rows with ``allowed``).

    The hash of the key decides which; histograms are made on the executors."""
    rows = docs.select(docs[key].alias("k"), docs[text].alias("t"), docs[lang].alias("l"))
    rows = rows.where(learnable(F.col("k")) if allowed is None else allowed).where("l is not null")
    sizes = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}  # a row a language
    if not sizes:
        return Machines()
    share = F.create_map(*[F.lit(v) for name, n in sizes.items() for v in (name, min(1.0, sample / n))])
    chosen = rows.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < share[F.col("l")] * 1_000_000)

    def histograms(batches):
        for b in batches:
            raw, offsets = buffers(b.column(1))
            x, starts, ends = padded(raw, offsets)
            at, size = [], []
            for s, e in zip(starts.tolist(), ends.tolist()):
                h = np.bincount(np.concatenate([run_hashes(x[s:e], 3), run_hashes(x[s:e], 4)]), minlength=1 << BITS)
                own = np.flatnonzero(h)
                at.append(own.astype(np.int32))
                size.append(h[own].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(size, pa.list_(pa.int32()))],
                                             ["l", "at", "n"])

    got = arrow_map(chosen.where(has_letter(F.col("t"))).select("l", "t"), histograms,
                    "l string, at array<int>, n array<int>").toArrow()
    # One matrix of the sample, filled in a fixed order and scaled in place: the driver holds no copy.
    labels = np.array(got["l"].to_pylist(), dtype=object)
    runs = np.array([int(pa.compute.sum(n.values).as_py()) for n in got["n"]], dtype=float)
    order = np.lexsort((runs, labels.astype(str)))  # whatever the order of arrival
    labels, runs = labels[order], runs[order]
    x = np.zeros((len(order), 1 << BITS), np.float32)
    for row, i in enumerate(order.tolist()):
        x[row, got["at"][i].values.to_numpy()] = got["n"][i].values.to_numpy()
    del got
    length = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
    x /= np.maximum(length, 1e-9)[:, None].astype(np.float32)
    scale = length / np.maximum(runs, 1)  # from a unit vector's margin to the mean a run
    langs = sorted(set(labels.tolist()))
    families: dict[str, list[int]] = {}
    for i, name in enumerate(langs):
        families.setdefault(family_of(name), []).append(i)
    families = dict(sorted(families.items()))
    own = np.array([langs.index(v) for v in labels])
    family = np.array([list(families).index(family_of(v)) for v in labels])
    pairs, columns, slopes = [], [], []
    tasks = [("", a, b, family == a, family == b) for a, b in combinations(range(len(families)), 2)]
    for name, members in families.items():
        tasks += [(name, i, j, own == a, own == b) for (i, a), (j, b) in combinations(enumerate(members), 2)]
    for level, a, b, is_a, is_b in tasks:
        rows_ = is_a | is_b
        y = np.where(is_a[rows_], 1.0, -1.0)
        w = svm(x, np.flatnonzero(rows_), y)
        pairs.append((level, a, b))
        columns.append(w)
        slopes.append(_slope((x @ w)[rows_] * scale[rows_], y))
    weights = np.stack(columns, 1) if columns else np.zeros((1 << BITS, 0))
    return Machines(langs, families, pairs, np.asfortranarray(weights, dtype=np.float32), np.array(slopes))


def predict(docs: DataFrame, machines: Machines, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row.  Map-only; the machines go with the tasks."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            n = b.num_rows
            step = 2000
            for lo in range(0, n, step):
                part = b.slice(lo, step)
                letters = part.column(2).to_numpy(zero_copy_only=False)
                if machines.langs:
                    lang, score = machines.predict(*buffers(part.column(1)))
                    names = np.array(machines.langs, dtype=object)[lang]
                    names, score = np.where(letters, names, UND), np.where(letters, score, 0.0)
                else:
                    names, score = np.full(part.num_rows, UND, dtype=object), np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names.tolist(), pa.string()), pa.array(score)],
                                                 ["k", "lang_pred", "score"])

    out = arrow_map(docs.select(docs[key], docs[text], has_letter(docs[text])), run,
                    f"k {kind}, lang_pred string, score double")
    return out.withColumnRenamed("k", key)


def keep_identified(docs: DataFrame, machines: Machines, least: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least`` or more.

    The texts stay where they are: rows pass through the map, no join."""
    schema = docs.schema
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            letters = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ok = letters[lo:lo + 2000].copy()
                if machines.langs:
                    ok &= machines.predict(*buffers(part.column(at)))[1] >= least
                kept = pa.RecordBatch.from_arrays(part.columns[:-1], part.schema.names[:-1])
                yield kept.filter(pa.array(ok))

    return arrow_map(docs.select("*", has_letter(docs[text])), trimmed(run), schema)
