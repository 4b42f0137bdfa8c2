"""The pipeline stage by stage on sf0.01, each against its operator or brute force."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curata.llm import neardup
from curata.llm.common import stage

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"input": docs}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF))
        out[name] = docs
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_and_subsets(steps):
    names = [k for k, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_duplicates", "personal", "packing"]
    before = steps["input"]
    for k in names[:-1]:
        assert steps[k].dtypes == steps["input"].dtypes
        assert ids(steps[k]) <= ids(before)
        before = steps[k]


def test_clean_documents_stay(spark, steps):
    good = ids(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"))
    assert len(good - ids(steps["language"])) == 0
    assert len(good - ids(steps["quality"])) <= 0.02 * len(good)
    junk = ids(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0"))
    assert len(junk & ids(steps["quality"])) <= 0.3 * len(junk)


def test_one_of_each_group_stays(steps):
    from test_similarity_operators import brute_components
    rows = [(r.doc_id, r.text) for r in steps["quality"].select("doc_id", "text").collect()]
    assert ids(steps["near_duplicates"]) == {c for _, c in brute_components(rows, percent=corpus_pipeline.NEAR_PERCENT).values()}


def test_stage_links_from_80_percent_on(spark):
    """Against brute force at 0.8, with many pairs from 0.80 to under 0.85."""
    from test_similarity_operators import near_copies, word_sets
    texts = [t for seed in range(40) for t in near_copies(seed, 5, 120, 3)]
    rows = list(enumerate(texts))
    sets, least = word_sets(rows), list(range(len(rows)))
    between = 0
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            if 100 * both >= 80 * union:
                between += 100 * both < 85 * union
                p, q = least[a], least[b]
                least = [min(p, q) if x in (p, q) else x for x in least]
    assert between > 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ids(corpus_pipeline.drop_near_duplicates(spark, df, SF)) == set(least)
    assert len(set(least)) < neardup.keep_one(df).count()
    assert neardup.bounds(85) == (neardup.BANDS, neardup.MOST_BITS)


def test_personal_data_is_gone(steps):
    from test_text_operators import base_spans
    texts = {r.doc_id: r for r in steps["personal"].collect()}
    assert set(texts) == ids(steps["near_duplicates"])
    assert all(not base_spans(r.text or "") for r in texts.values())
    assert all(r.n_chars == len(r.text) for r in texts.values())
    source = {r.doc_id: r.text for r in steps["near_duplicates"].collect()}
    untouched = [i for i, t in source.items() if not re.search(r"[0-9@]", t)]
    assert untouched and all(texts[i].text == source[i] for i in untouched)


def test_everything_is_packed(spark, steps):
    p = steps["packing"]
    assert ids(p) == ids(steps["personal"])
    assert p.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert p.agg(F.sum("length")).first()[0] == p.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]


PROSE = ("the quick brown fox jumps over the lazy dog while seven other foxes watch it from behind the old wooden fence near the river and wonder "
         "what it may be up to on such a bright and windy morning in late autumn ").split()


def prose(seed, n=60):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + (str(r.randrange(10**6)) if r.random() < 0.1 else "") for _ in range(n))


def edge_folder(spark, tmp, rows, labelled):
    """Documents with columns that the stages don't name, one of them called as an operator's own, and without n_chars."""
    docs = spark.createDataFrame([(*r, "pass", 7) for r in rows], "doc_id long, text string, lang string, source string, k string, row int")
    docs.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in labelled], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    return docs


def through(spark, docs, tmp):
    out = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, tmp))
        out[name] = docs
    return out


def test_edge_rows(spark, tmp):
    """Nulls in every column, empty and very long texts, equal texts, repeated rows and ids."""
    same = prose(1)
    rows = [(i, prose(100 + i), "en", "s") for i in range(40)]
    rows += [(50, None, "en", "s"), (51, "", "en", None), (52, " 12 ", None, "s"), (60, same, "en", "s"), (61, same, None, None), (60, same, "en", "s"),
             (None, prose(2), "en", "s"), (70, prose(3, 30_000), "en", "s"), (5, "mail to a.b@example.org " + prose(4), "en", "s")]
    docs = edge_folder(spark, tmp, rows, range(40))
    out = through(spark, docs, tmp)
    names = [k for k, _ in corpus_pipeline.STAGES]
    assert all(out[k].dtypes == docs.dtypes for k in names[:-1])
    ids_of = lambda k: sorted((r.doc_id for r in out[k].select("doc_id").collect()), key=repr)
    assert not {50, 51, 52} & set(ids_of("language")) and len(ids_of("language")) == len(rows) - 3
    before, after = ids_of("quality"), ids_of("near_duplicates")
    assert set(before) >= {None, 60, 70} and after.count(None) == 1
    assert 61 not in after and after.count(60) == before.count(60)
    texts = {r.doc_id: r for r in out["personal"].collect()}
    assert len(out["personal"].collect()) == len(after) and all("@" not in r.text for r in texts.values())
    assert all((r.k, r.row) == ("pass", 7) for r in texts.values())
    assert sorted(set(ids_of("packing")), key=repr) == sorted(set(after), key=repr)


def test_empty_documents(spark, tmp):
    docs = edge_folder(spark, tmp, [(1, "x", "en", "s")], [1]).where("doc_id > 1")
    out = through(spark, docs, tmp)
    assert all(df.count() == 0 for df in out.values())


def test_scoring_sends_its_tables_once(spark, monkeypatch):
    """The tables go to a worker as a broadcast, not inside the function that each task loads."""
    from pyspark import cloudpickle
    from curata.llm import quality
    sizes, real = [], quality.arrow_map

    def seen(df, fn, schema):
        if "key bigint" in schema:
            sizes.append(len(cloudpickle.dumps(fn)))
        return real(df, fn, schema)

    monkeypatch.setattr(quality, "arrow_map", seen)
    df = spark.createDataFrame([(i, f"the text {i} " * 9, "en") for i in range(40)], "doc_id long, text string, lang string")
    whole = {r.doc_id: r.perplexity for r in quality.judge(df, df.select("doc_id")).collect()}
    assert len(whole) == 40 and len(sizes) == 1 and sizes[0] < 1 << 20
    monkeypatch.setattr(quality, "SCORED", 50)  # a text or less at once
    assert {r.doc_id: r.perplexity for r in quality.judge(df, df.select("doc_id")).collect()} == pytest.approx(whole, rel=1e-9)


def test_packing_places_partitions_without_python_rows(spark, capsys):
    """The partitions' offsets come from Arrow: an RDD of Python rows leaves workers of a second kind."""
    from curata.llm import catalog
    df = spark.createDataFrame([(i, "a b c " * i) for i in range(20)], "doc_id long, text string")
    catalog.pieces(df).explain()
    assert "ExistingRDD" not in capsys.readouterr().out


def test_batches_of_the_stages_are_small(spark):
    """What a stage leaves set: at most 2 MB of text an Arrow batch and 512 rows a scan."""
    corpus_pipeline.moderate_batches(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 250
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) <= 2 << 20
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def test_stages_return_the_drivers_memory(spark, monkeypatch):
    """Every stage has the driver's Python and JVM give back what earlier work has freed, the first after its learning."""
    calls, real = [], corpus_pipeline.lighten
    monkeypatch.setattr(corpus_pipeline, "lighten", lambda s: (calls.append(s), real(s)))
    docs = spark.createDataFrame([(i, f"the little text number {i} " * 5, "en") for i in range(20)], "doc_id long, text string, lang string")
    for k, (name, apply) in enumerate(corpus_pipeline.STAGES, 1):
        assert name and set(apply(spark, docs, SF).columns) and len(calls) == k
