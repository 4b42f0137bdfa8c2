"""Personal data by candidate gradient boosting (operator 5), DataFrame functions only.

High-recall generators propose spans, which may overlap: four base kinds and the longer
list of ``EXTRA`` kinds.  Boosted trees score every candidate from features of its format
and its context; a threshold for each kind, calibrated on the candidates of all documents held
back from training, selects the redactions.  A kind without a threshold is selected by its own
check.  A base span that passes its own check always stays.

The trees are learnt here by weak supervision: a candidate's label says whether it passes
the check of its kind (Luhn, octets, digit counts, shape of a secret), which is no feature;
training takes a bounded sample of documents (``SAMPLE_DOCS``), calibration a quarter of the whole
table.  Features and trees then apply to every candidate of every whole text as plain expressions.
There is no Python, and no shuffle but of the calibration's counts.

The patterns are written so that Java's engine needs no recursion and never scans a run
twice: a dot inside a host name or a separator inside a digit run first becomes one stand-in
character, so that the repeated groups become character classes.  Positions are code points.

Defined results: a null text is an empty one, without spans; texts of any length are
searched whole; repeated rows give equal results; ties in the order of spans go by kind as
listed, then end; an empty table gives an empty result.  Only key and text are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.common import stage

#: Kinds in the order that breaks ties; the first four are the base kinds.
KINDS = ["email", "ip", "card", "phone", "secret", "key", "local", "ssn"]
BASE = KINDS[:4]
EXTRA = KINDS[4:]
_MARK = "\x01"  # stands for a dot or separator with its neighbours on both sides

#: (which form of the text, pattern).  Possessive runs and lookbehind keep them linear.
GENERATORS = {
    "email": ("dots", rf"(?:(?<![A-Za-z0-9._%+{_MARK}-])|\G)[A-Za-z0-9._%+{_MARK}-]++@[A-Za-z0-9-]++{_MARK}[A-Za-z0-9{_MARK}-]*+"),
    "ip": ("plain", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("digits", rf"[0-9][0-9{_MARK}]++"),
    "phone": ("plain", r"\+[0-9][ ().0-9-]+[0-9]"),
    "secret": ("plain", r"(?i)(?:password|passwd|secret|token|api[_-]?key)[ \"']{0,2}[=:][ \"']{0,2}[A-Za-z0-9+/_.~-]{6,}+"),
    "key": ("plain", r"(?<![A-Za-z0-9])(?:[0-9A-Z]{16,}+|[0-9a-f]{24,}+)(?![A-Za-z0-9])"),
    "local": ("plain", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "ssn": ("plain", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Words before a span that speak for personal data.
CUES = r"(?i)(?:mail|phone|tel|call|fax|card|visa|host|address|password|token|secret|key|ssn|contact)[^A-Za-z]*$"
CONTEXT = 24

FEATURES = ["kind", "length", "digits", "digit_share", "upper_share", "separators", "at", "plus",
            "cue", "letter_before", "letter_after", "mixed", "zeros"]
#: Documents (about) from which those that train the trees are taken.
SAMPLE_DOCS = 3000
ROUNDS, DEPTH = 8, 3
PRECISION = 0.95


def _found(form: Column, pattern: str) -> Column:
    return F.regexp_extract_all(form, F.lit(pattern), F.lit(0))


def _between(form: Column, found: Column, pattern: str) -> Column:
    """The text between the matches; only where there are any."""
    return F.when(F.size(found) > 0, F.split(form, pattern, -1))


def _spans(found: Column, between: Column) -> Column:
    """array<struct<start, end>>: running sums over the lengths between and of the matches."""
    steps = F.transform(found, lambda m, i: F.struct(F.length(F.get(between, i)).alias("gap"), F.length(m).alias("size")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    run = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, s: F.struct((a["at"] + s["gap"] + s["size"]).alias("at"), F.concat(a["out"], F.array(
            F.struct((a["at"] + s["gap"]).alias("start"), (a["at"] + s["gap"] + s["size"]).alias("end")))).alias("out")),
        lambda a: a["out"])
    return F.when(F.size(found) > 0, run).otherwise(none)


def luhn(digits: Column) -> Column:
    """Does a string of digits pass Luhn's check?"""
    def step(total, i):
        x = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _checked(kind: str, s: Column) -> Column:
    """The check of a kind on a span's own text."""
    digits = F.regexp_replace(s, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "secret":
        value = F.regexp_extract(s, r"[=:][ \"']{0,2}([A-Za-z0-9+/_.~-]+)$", 1)
        return (F.length(value) >= 8) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    if kind == "key":
        return s.rlike("[0-9]") & s.rlike("[A-Za-z]")
    if kind == "ssn":
        return ~s.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)  # email, local: the pattern is the check


def _share(s: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(s, f"[^{pattern}]", "")) / F.greatest(F.length(s), F.lit(1))


def _features(kind: str, s: Column, before: Column, after: Column) -> Column:
    number = {
        "kind": F.lit(float(KINDS.index(kind))),
        "length": F.length(s),
        "digits": F.length(F.regexp_replace(s, "[^0-9]", "")),
        "digit_share": _share(s, "0-9"),
        "upper_share": _share(s, "A-Z"),
        "separators": F.length(F.regexp_replace(s, "[^ .()=:-]", "")),
        "at": s.contains("@").cast("int"),
        "plus": s.startswith("+").cast("int"),
        "cue": before.rlike(CUES).cast("int"),
        "letter_before": before.rlike(r"\p{L}$").cast("int"),
        "letter_after": after.rlike(r"^\p{L}").cast("int"),
        "mixed": (s.rlike("[0-9]") & s.rlike("[A-Za-z]")).cast("int"),
        "zeros": s.rlike("0000|1111|1234").cast("int"),
    }
    return F.array(*[number[f].cast("double") for f in FEATURES])


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, t, c): key, text and the array of candidates (kind, start, end, checked, f)."""
    d = docs.select(docs[key].alias("k"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    plain = F.translate("t", _MARK, "\x02")
    d = d.select("k", "t", F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _MARK).alias("dots"),
                 F.regexp_replace(plain, "(?<=[0-9])[ -](?=[0-9])", _MARK).alias("digits"))
    form = {"plain": F.col("t"), "dots": F.col("dots"), "digits": F.col("digits")}
    d = d.select("*", *[_found(form[w], p).alias(f"m_{kind}") for kind, (w, p) in GENERATORS.items()])
    d = d.select("*", *[_between(form[w], F.col(f"m_{kind}"), p).alias(f"b_{kind}") for kind, (w, p) in GENERATORS.items()])
    d = d.select("k", "t", *[_spans(F.col(f"m_{kind}"), F.col(f"b_{kind}")).alias(kind) for kind in KINDS])

    def described(kind: str) -> Column:
        def one(x):
            s = F.substring(F.col("t"), x["start"] + 1, x["end"] - x["start"])
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), s.alias("s"),
                            F.substring(F.col("t"), F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1,
                                        F.least(x["start"], F.lit(CONTEXT))).alias("before"),
                            F.substring(F.col("t"), x["end"] + 1, F.lit(1)).alias("after"))
        return F.transform(kind, one)

    def checked(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["s"].alias("s"),
            x["before"].alias("before"), x["after"].alias("after"), _checked(kind, x["s"]).alias("checked")))

    def featured(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["checked"].alias("checked"),
            _features(kind, x["s"], x["before"], x["after"]).alias("f")))

    d = d.select("k", "t", *[described(kind).alias(kind) for kind in KINDS])
    d = d.select("k", "t", *[checked(kind).alias(kind) for kind in KINDS])
    # a digit run too short or too long for a card is no candidate at all
    d = d.withColumn("card", F.filter("card", lambda x: x["checked"] | (F.length(F.regexp_replace(x["s"], "[^0-9]", "")).between(12, 19))))
    return d.select("k", "t", F.concat(*[featured(kind) for kind in KINDS]).alias("c"))


@dataclass
class Selector:
    """The boosted trees as nested (feature, threshold, left, right) or leaf values, and thresholds."""

    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def probability(self, f: Column) -> Column:
        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(weight) * self._value(f, tree)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))

    def _value(self, f: Column, tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        at, threshold, left, right = tree
        return F.when(F.get(f, F.lit(at)) <= threshold, self._value(f, left)).otherwise(self._value(f, right))

    def selects(self, c: Column) -> Column:
        """Base spans that pass, and other candidates above the threshold of their kind; a kind
        without a threshold, or without trees, goes by its own check."""
        chosen = c["checked"]
        if not self.trees:
            return chosen
        for kind, t in self.thresholds.items():
            chosen = F.when(c["kind"] == KINDS.index(kind), c["probability"] >= t).otherwise(chosen)
        return (c["kind"] < len(BASE)) & c["checked"] | chosen


def _parse(debug: str):
    """A tree of the learner's printed form."""
    lines = [x.strip() for x in debug.splitlines() if re.match(r"\s+(If|Else|Predict)", x)]

    def node():
        line = lines.pop(0)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        at, threshold = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
        left = node()
        lines.pop(0)  # its Else
        return int(at), float(threshold), left, node()

    return node()


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
        precision: float = PRECISION) -> Selector:
    """Train the trees on a sample of about ``sample_docs`` documents and calibrate the thresholds.

    A quarter of all documents, by the hash of the key, is held back.  The sample is chosen by
    the hash of key and text, and what is not held back trains; a kind's threshold is the least
    score from which on ``precision`` of its candidates in all documents held back pass their check."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    total = docs.count()
    if not total:
        return Selector()
    h = F.pmod(F.xxhash64(docs[key], docs[text]), F.lit(1 << 30))
    held = F.pmod(F.xxhash64(docs[key]), F.lit(4)) == 0
    # written first: Spark would put the candidates' expressions into a filter over all rows
    chosen = stage(docs.where((h < int(min(1.0, sample_docs / total) * (1 << 30))) & ~held).select(key, text))
    rows = stage(candidates(chosen, key, text).select(F.explode("c").alias("c")).select(
        F.col("c.f").alias("f"), F.col("c.checked").cast("double").alias("label")))
    kinds = rows.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        return Selector()  # nothing to tell apart
    train = rows.select(array_to_vector("f").alias("features"), "label").coalesce(2)
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=7, cacheNodeIds=False, maxBins=32).fit(train)
    out = Selector([(float(w), _parse(t.toDebugString)) for t, w in zip(model.trees, model.treeWeights)])
    # written before it is exploded, for the same reason
    marks = stage(candidates(docs.where(held), key, text).select(F.transform("c", lambda x: F.struct(
        x["kind"].alias("kind"), x["checked"].cast("double").alias("label"),
        F.floor(out.probability(x["f"]) * 50).alias("bin"))).alias("c")))
    bins = (marks.select(F.explode("c").alias("c")).groupBy(F.col("c.kind").alias("kind"), F.col("c.bin").alias("bin"))
            .agg(F.sum("c.label").alias("good"), F.count("*").alias("n")).collect())
    for i, kind in enumerate(KINDS):
        good = n = 0.0
        for r in sorted((r for r in bins if r["kind"] == i), key=lambda r: -r["bin"]):
            good, n = good + r["good"], n + r["n"]
            if good >= precision * n:
                out.thresholds[kind] = r["bin"] / 50
    return out


def scan(docs: DataFrame, selector: Selector, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, t, spans, base): selected spans and base spans, sorted array<struct<start, kind, end>>."""
    c = candidates(docs, key, text)
    if selector.trees:
        c = c.select("k", "t", F.transform("c", lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["checked"].alias("checked"),
            selector.probability(x["f"]).alias("probability"))).alias("c"))
    order = lambda a: F.array_sort(F.transform(a, lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return c.select("k", "t", order(F.filter("c", selector.selects)).alias("spans"),
                    order(F.filter("c", lambda x: (x["kind"] < len(BASE)) & x["checked"])).alias("base"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every selected span replaced by its kind in brackets, from left to right;
    where spans overlap, all of them go under the first one's name."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start,
        lambda a, x: F.struct(
            F.greatest(a["at"], x["end"]).alias("at"),
            F.when(x["start"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.get(names, x["kind"]))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))


def redact(docs: DataFrame, selector: Selector, text: str = "text") -> DataFrame:
    """``docs`` with the selected spans of ``text`` redacted; every other column as it is."""
    other = [F.col(f"k.`{c}`").alias(c) if c != text else None for c in docs.columns]
    boxed = docs.select(F.struct(*docs.columns).alias("k_"), docs[text].alias("t_"))
    done = scan(boxed, selector, "k_", "t_")
    new = F.when(F.col(f"k.`{text}`").isNotNull(), redacted(F.col("t"), F.col("spans"))).alias(text)
    return done.select(*[new if o is None else o for o in other])
