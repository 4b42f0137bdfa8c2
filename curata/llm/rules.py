"""Quality rules by a learned decision list (operator 12), in DataFrame functions throughout.

1. ``statistics`` measures every whole text in one map: words, characters of words, symbols,
   repeated lines, words in repeated three-word windows, and shares of these.  Repeated
   windows are found inside the row: window hashes with their places are sorted as plain
   numbers, neighbours that agree are candidates, and candidates are compared word for word.
2. ``learn`` grows a decision list on the labelled rows by sequential covering.  A rule is a
   conjunction of thresholds on statistics.  It grows one condition at a time by the largest
   information gain on two thirds of the rows, counted by one aggregate a condition over
   (statistic, bin, label); it is pruned to the prefix of its conditions that tells bad from
   good best on the last third, and is taken if at least ``PRECISION`` of what it finds there
   is bad.  Rows that a rule finds are left out, and the next rule grows.  All labelled rows count; only
   counts reach the driver: statistics x (bins + 1) x 2 numbers a condition.
3. ``verdict`` emits the list as one ordered conditional expression.

Defined results: a null text counts as empty; a document with fewer than ``LEAST_WORDS``
words, or more than half of whose words stand in repeated windows, fails the base rules and is never
kept; without labels of both kinds there are no rules and the base rules decide; labels that are null or disagree about an id are
left out; a row without id has no label; repeated rows get equal results; texts of any
length are whole; an empty table gives an empty result.  Other columns are not read and never clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.common import stage

#: Separators of words, as a class and as characters to strip (fixed values).
_SPACE = r"[ \t\n\x0B\f\r]"
_STRIP = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3
#: Bits of a packed window hash that hold its place; more words than that fit no string.
_PLACE = (1 << 30) - 1

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What rules speak about.
FEATURES = ["n_words", "chars_a_word", "symbols_a_word", "dup_lines", "repeated_words", "distinct_words", "upper", "digits", "exclaims_a_word"]
#: Thresholds tried a statistic (quantiles of the bad and of the good rows) and the learner's bounds.
BINS = 32
MOST_RULES, MOST_CONDITIONS = 12, 5
PRECISION = 0.95
LEAST_FOUND = 3


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, the five ``STATISTICS`` as longs, array f of ``FEATURES``) of every row."""
    d = docs.select(docs[key].alias("k"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    d = d.select("k", "t", F.btrim("t", F.lit(_STRIP)).alias("inner"))
    none = F.array().cast("array<string>")
    d = d.select("k", "t", F.when(F.col("inner") != "", F.split("inner", f"{_SPACE}+", -1)).otherwise(none).alias("words"),
                 F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{_SPACE[1:]}")).alias("lines"))
    at = lambda a, i: F.get(F.col(a), i)
    window = lambda i: [at("words", i + j) for j in range(WINDOW)]
    places = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(0), F.size("words") - WINDOW)).otherwise(F.array().cast("array<int>"))
    # the hash in the upper bits, the place below: sorted as numbers, equal windows are neighbours
    packed = F.transform(places, lambda i: F.xxhash64(*window(i)).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    d = d.select("k", "t", "words", "lines", F.sort_array(packed).alias("h"))
    top = lambda x: F.shiftright(x, 30)
    likely = F.filter("h", lambda x, i: F.coalesce(top(x) == top(F.get("h", i + 1)), F.lit(False)) |
                      F.coalesce(top(x) == top(F.get("h", i - 1)), F.lit(False)))
    d = d.select("k", "t", "words", "lines", likely.alias("h"))
    told = F.transform("h", lambda x: F.struct(F.concat_ws(" ", *window(x.bitwiseAND(F.lit(_PLACE)).cast("int"))).alias("w"),
                                               x.bitwiseAND(F.lit(_PLACE)).cast("int").alias("p")))
    d = d.select("k", "t", "words", "lines", F.array_sort(told).alias("h"))
    again = F.filter("h", lambda x, i: F.coalesce(x["w"] == F.get("h", i + 1)["w"], F.lit(False)) |
                     F.coalesce(x["w"] == F.get("h", i - 1)["w"], F.lit(False)))
    d = d.select("k", "t", "words", "lines", F.sort_array(F.transform(again, lambda x: x["p"])).alias("p"))
    # windows that overlap share words: each covers what lies before the next one
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    d = d.select("k", F.size("words").cast("long").alias("n_words"),
                 (F.length("t") - F.regexp_count("t", F.lit(_SPACE))).cast("long").alias("word_chars"),
                 F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), covered.cast("long").alias("n_repeat_words"),
                 F.size("lines").alias("n_lines"), F.size(F.array_distinct("words")).alias("n_distinct"),
                 F.regexp_count("t", F.lit(r"\p{Lu}")).alias("n_upper"), F.regexp_count("t", F.lit("[0-9]")).alias("n_digits"),
                 F.regexp_count("t", F.lit("[!?]")).alias("n_exclaims"))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    f = {"n_words": F.col("n_words"), "chars_a_word": F.col("word_chars") / words, "symbols_a_word": F.col("n_symbols") / words,
         "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), "repeated_words": F.col("n_repeat_words") / words,
         "distinct_words": F.col("n_distinct") / words, "upper": F.col("n_upper") / chars, "digits": F.col("n_digits") / chars,
         "exclaims_a_word": F.col("n_exclaims") / words}
    return d.select("k", *STATISTICS, F.array(*[f[x].cast("double") for x in FEATURES]).alias("f"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass
class DecisionList:
    """Ordered rules; a rule is a list of (statistic, above, threshold): above it, or at most it."""

    rules: list[list[tuple[str, bool, float]]] = field(default_factory=list)

    def texts(self) -> list[str]:
        return [" and ".join(f"{name} {'>' if above else '<='} {t:.6g}" for name, above, t in rule) for rule in self.rules]

    def verdict(self, f: Column) -> Column:
        """The text of the first rule that finds the row; null if none does."""
        out = F.lit(None).cast("string")
        for rule, text in reversed(list(zip(self.rules, self.texts()))):
            out = F.when(_holds(rule, f), F.lit(text)).otherwise(out)
        return out


def _bin(x: Column, thresholds: list[float]) -> Column:
    """How many thresholds lie below a statistic."""
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda c: c < x))


def _holds(rule: list[tuple[str, bool, float]], f: Column) -> Column:
    out = F.lit(True)
    for name, above, t in rule:
        x = F.get(f, F.lit(FEATURES.index(name)))
        out = out & ((x > t) if above else (x <= t))
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained about the bad rows that a condition keeps."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", precision: float = PRECISION,
          most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS) -> DecisionList:
    """A decision list for bad rows (label 0) among those that pass the base rules."""
    known = (labels.select(labels[key].alias("k"), labels[label].alias("l")).where("k is not null").groupBy("k")
             .agg(F.min("l").alias("l"), F.max("l").alias("m")).where("l = m").select("k", (F.col("l") == 0).alias("bad")))
    rows = measured.where(~base_failed()).join(known, "k").select("f", "bad", (F.pmod(F.xxhash64("k"), F.lit(3)) == 0).alias("held"))
    rows = stage(rows)
    share = [(i + 0.5) / BINS for i in range(BINS)]
    cuts = rows.groupBy("bad").agg(*[F.percentile_approx(F.get("f", F.lit(i)), share, 10_000).alias(x) for i, x in enumerate(FEATURES)]).collect()
    if len(cuts) < 2:
        return DecisionList()  # nothing to tell apart
    thresholds = [sorted({v for r in cuts for v in r[x]}) for x in FEATURES]
    bins = F.array(*[_bin(F.get("f", F.lit(i)), t) for i, t in enumerate(thresholds)])
    left, f = stage(rows.select("bad", "held", "f", bins.alias("bins"))), F.col("f")
    out = DecisionList()
    while len(out.rules) < most_rules:
        rule = _grown(left.where(~F.col("held")), most_conditions)
        if not rule:
            break
        counts = left.where("held").agg(*[F.count_if(_holds(rule[:m], f) & (F.col("bad") == bad)).alias(f"{'p' if bad else 'n'}{m}")
                                          for m in range(1, len(rule) + 1) for bad in (True, False)]).first()
        worth = lambda m: (counts[f"p{m}"] - counts[f"n{m}"]) / max(counts[f"p{m}"] + counts[f"n{m}"], 1)
        size = max(range(1, len(rule) + 1), key=lambda m: (worth(m), -m))
        p, n = counts[f"p{size}"], counts[f"n{size}"]
        if p < LEAST_FOUND or p < precision * (p + n):
            break
        out.rules.append(rule[:size])
        left = left.where(~_holds(rule[:size], f))
    return out


def _grown(rows: DataFrame, most: int) -> list[tuple[str, bool, float]]:
    """A rule, one condition after another; one aggregate each.

    A threshold is put halfway between the values on its two sides."""
    rule: list[tuple[str, bool, float]] = []
    while len(rule) < most:
        got = (rows.where(_holds(rule, F.col("f"))).select("bad", F.posexplode(F.arrays_zip("bins", "f")).alias("i", "x"))
               .groupBy("i", F.col("x.bins").alias("b")).agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"),
                                                             F.min("x.f").alias("least"), F.max("x.f").alias("most")).collect())
        p0, n0 = (sum(r[c] for r in got if r["i"] == 0) for c in ("p", "n"))
        if not p0 or not n0:
            break
        best, condition = 0.0, None
        for i, name in enumerate(FEATURES):
            p = n = 0
            own = sorted((r for r in got if r["i"] == i), key=lambda r: r["b"])
            for low, high in zip(own, own[1:]):
                p, n = p + low["p"], n + low["n"]
                for above, gain in ((False, _gain(p, n, p0, n0)), (True, _gain(p0 - p, n0 - n, p0, n0))):
                    if gain > best:
                        best, condition = gain, (name, above, (low["most"] + high["least"]) / 2)
        if condition is None:
            break
        rule.append(condition)
    return rule


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, the five statistics, base_failed, kept, rule) of every row; ``rule`` is the text of the rule that drops it."""
    measured = stage(statistics(docs, key, text))
    found = learn(measured, labels, key, label).verdict(F.col("f"))
    out = measured.select(F.col("k").alias(key), *STATISTICS, base_failed().alias("base_failed"), found.alias("rule"))
    return out.select(key, *STATISTICS, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
