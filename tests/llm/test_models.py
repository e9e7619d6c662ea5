"""Language mixtures and toxicity: held-out accuracy, and the method on small cases."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from doctriage.llm import language, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents)


def test_language_of_held_out_documents(documents, model):
    got = {r.doc_id: r for r in language.identify(documents, model).collect()}
    rows = documents.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out and r.lang]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_read(documents, model):
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    again = language.fit(changed)
    assert again.langs == model.langs and np.array_equal(again.log_p, model.log_p)


def test_mixture_finds_both_languages(documents, model):
    pure = language.identify(documents.filter("length(text) between 2000 and 4000"), model).filter("size(langs) = 1")
    by = {r.lang_pred: r.text for r in pure.join(documents, "doc_id").collect()}  # passages of another language aside
    one, two = by["en"], by["fr"]
    share = language.mixtures(model, pa.array([one, two, one + " " + two], pa.large_string()))
    langs = np.array(model.langs)
    assert set(langs[share[2] > 0]) == {"en", "fr"}
    words = len(one.split()) / (len(one.split()) + len(two.split()))
    assert abs(share[2][langs == "en"][0] - words) < 0.1


def test_filter_keeps_mixtures_without_a_majority(spark, documents, model):
    pure = language.identify(documents.filter("length(text) between 2000 and 4000"), model).filter("size(langs) = 1")
    by = {r.lang_pred: r.text.split() for r in pure.join(documents, "doc_id").collect()}
    mixed = " ".join(w for lang, n in (("en", 80), ("fr", 70), ("de", 50)) for w in by[lang][:n])
    docs = spark.createDataFrame([(1, mixed), (2, " ".join(by["en"])), (3, "12 -- 34 ..."), (4, None), (None, mixed)],
                                 "doc_id long, text string")
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert {"en", "fr", "de"} <= set(found[1].langs) and found[1].score < 0.5
    kept = language.keep_identified(docs, model)
    assert kept.dtypes == docs.dtypes and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]


def test_expectation_maximisation_reaches_the_likeliest_mixture():
    rng = np.random.default_rng(5)
    like = rng.random((60, 2)).astype(np.float32)
    share, _ = language._em(like, np.array([0]), np.array([60]), np.full((1, 2), 0.5), 400)
    grid = max(np.linspace(0, 1, 2001), key=lambda p: np.log(like @ [p, 1 - p]).sum())
    assert abs(share[0, 0] - grid) < 5e-3


def test_language_odd_texts(frame, odd_rows, model):
    docs = frame(odd_rows + [(50, "123 !!! 4"), (51, "the and of")])
    got = language.identify(docs, model).collect()
    assert len(got) == len(odd_rows) + 2 and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 50)} == {"und"}
    kept = language.keep_identified(docs, model)
    assert kept.dtypes == docs.dtypes
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in got if r.lang_pred != "und"}
    assert language.identify(frame([]), model).count() == 0


def test_rare_language_is_learned(frame):
    usual = [(i, "the and of with that this " * 3, "en") for i in range(400)]
    rare = [(1000 + i, "zoj kvar pluv neniam tiam kiel " * 2, "eo") for i in range(3)]
    fitted = language.fit(frame(usual + rare), limit=40)
    assert fitted.langs == ["en", "eo"]
    got = language.identify(frame([(1, "kvar neniam zoj"), (2, "with the that")]), fitted).collect()
    assert {(r.doc_id, r.lang_pred) for r in got} == {(1, "eo"), (2, "en")}


def test_few_toxic_documents_among_many_labels(spark):
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, 30)) + (" hateful vile" if i % 100 == 0 else "")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(5000)], "doc_id long, toxic int")
    got = toxicity.severity(docs, toxicity.fit(docs, labels, limit=200)).collect()
    assert {r.doc_id for r in got if r.toxic} == {i for i in range(0, 4000, 100)}


def test_language_without_labels(frame):
    docs = frame([(1, "abc", None), (2, None, "en")])
    empty = language.fit(docs)
    assert language.keep_identified(docs, empty).count() == 2
    assert empty.langs == [] and {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def test_toxicity_on_documents_it_was_not_fitted_on(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = toxicity.fit(docs, labels.filter("doc_id % 3 != 0"))
    rows = toxicity.severity(docs, fitted).join(labels.filter("doc_id % 3 = 0").withColumnRenamed("toxic", "y"), "doc_id")
    rows = rows.select("toxic", "y", "severity").collect()
    caught = [r.toxic for r in rows if r.y == 1]
    clean = [r.toxic for r in rows if r.y == 0]
    assert sum(caught) >= 0.85 * len(caught) and sum(clean) <= 0.01 * len(clean)


def test_ordinal_model_orders_grades():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3)).astype(np.float32)
    latent = 6 * x[:, 0] - 3 * x[:, 1] + rng.logistic(size=600)
    grades = np.digitize(latent, [0.5, 2.0, 3.5])
    w, t = toxicity.fit_ordinal(toxicity.sparse(x), grades)
    assert list(t) == sorted(t) and w[0] > 2 and w[1] < -1 and abs(w[2]) < 1
    p = toxicity.Model([], w, t).at_least(x @ w)
    assert (np.diff(p, axis=1) <= 0).all()
    assert np.corrcoef(p.sum(axis=1), grades)[0, 1] > 0.6

    def loss(w, t):
        c = 1 / (1 + np.exp(-((x @ w)[:, None] - t)))
        c = np.hstack([np.ones((600, 1)), c, np.zeros((600, 1))])
        i = np.arange(600)
        return -np.log(c[i, grades] - c[i, grades + 1]).mean() + 0.5 * toxicity.RIDGE * (w @ w)
    best = loss(w, t)
    for i, step in itertools.product(range(6), (-0.2, 0.2)):
        d = np.zeros(6)
        d[i] = step
        assert loss(w + d[:3], t + d[3:]) > best - 1e-3


def test_toxicity_odd_inputs(spark, frame, odd_rows):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (8, None), (4, 0)], "doc_id long, toxic int")
    docs = frame(odd_rows)
    fitted = toxicity.fit(docs, labels)
    got = toxicity.severity(docs, fitted).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.severity <= 3 for r in got)
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.severity(docs, none).count() == len(odd_rows)
    assert toxicity.severity(frame([]), fitted).count() == 0
