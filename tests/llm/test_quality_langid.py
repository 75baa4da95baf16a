"""Held-out accuracy and odd inputs of the quality classifier and of language identification."""

import numpy as np
import pyarrow as pa

from folio.llm import common, langid, quality

DIR = "/root/testdata/sf0.01"
ODD = [(1, None, None), (2, "", "en"), (3, "123 !!", "en"), (4, "word", "fr"), (5, "é", None), (6, "the " * 200_000, "en"), (6, "the " * 200_000, "en"), (None, "no id", "en")]


def test_features_against_plain_counts():
    texts = ["", "Ab, ab! | 12\nÉé ab", "x", "  ", "a a a b"]
    raw, off = common.flat_bytes(pa.array(texts))
    got = quality.features(raw, off)
    f = quality.FEATURES.index
    for t, row in zip(texts, got):
        b, ws = t.encode(), t.lower().split()
        assert np.isclose(row[f("log_bytes")], np.log1p(len(b))) and np.isclose(row[f("log_words")], np.log1p(len(ws)))
        assert np.isclose(row[f("upper")] * max(len(b), 1), sum(65 <= c <= 90 for c in b))
        assert np.isclose(row[f("distinct")] * max(len(ws), 1), len(set(ws)))
        assert np.isclose(row[f("commonest")] * max(len(ws), 1), max([ws.count(w) for w in ws], default=0))
    assert np.array_equal(quality.features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape, (1, len(quality.FEATURES)))


def test_quality_held_out(spark):
    docs, labels = common.table(spark, DIR, "documents"), common.table(spark, DIR, "labels")
    from folio.llm import catalog

    got = catalog.op10_quality(spark, DIR).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    both = got.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.97


def test_quality_odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, score string")
    lab = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (6, 1), (None, 1), (2, None)], "doc_id long, quality int")
    got = quality.score(df, quality.train(df, lab)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(df.limit(0), quality.train(df, lab.limit(0))).collect() == []
    assert quality.train(df, lab.limit(0)).score(np.zeros((2, len(quality.FEATURES)))).tolist() == [0.5, 0.5]


def test_language_held_out(spark):
    from folio.llm import catalog

    truth = common.table(spark, DIR, "documents").toPandas().set_index("doc_id")
    got = catalog.op6_language(spark, DIR).toPandas()
    assert len(got) == len(truth) and got.score.between(0, 1).all()
    held = got[got.held_out & (got.lang_pred != langid.NONE)]
    assert len(held) > 100 and (held.lang_pred.values == truth.lang[held.doc_id].values).mean() > 0.97


def test_language_odd(spark):
    df = spark.createDataFrame([(i, t, g, "x") for i, t, g in ODD], "doc_id long, text string, lang string, score string")
    d = langid.learn(df)
    assert list(d) == ["en", "fr"]
    got = langid.predict(df, d).collect()
    assert [r.lang_pred == langid.NONE for r in got] == [True, True, True] + [False] * 5 and got[5].lang_pred == got[6].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(df, {}).collect()} == {langid.NONE}
    assert langid.learn(df.limit(0)) == {} and langid.predict(df.limit(0), d).collect() == []
