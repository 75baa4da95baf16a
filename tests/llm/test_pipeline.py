"""The pipeline on the smallest documents: each stage against a plain version on its own input, and odd rows."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from folio.llm import common, mixing, quality
from tests.llm.test_jaccard import brute

DIR = "/root/testdata/sf0.001"
ORDER = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = common.table(spark, DIR, "documents")
    kept = [docs.toPandas()]
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.option("maxPartitionBytes", "1").parquet(str(tmp_path / str(k)))
        assert name == "tokens" or docs.columns == ORDER
        kept.append(docs.toPandas())
    start, good, single, clean, mixed, tokens = kept

    labels = common.table(spark, DIR, "labels").toPandas()
    model = quality.train(common.table(spark, DIR, "documents"), common.table(spark, DIR, "labels").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    scores = [model.score(quality.features(*common.flat_bytes(pa.array([t]))))[0] for t in start.text]
    assert sorted(good.doc_id) == sorted(start.doc_id[np.array(scores) >= 0.5])
    bad = set(labels.doc_id[labels.quality == 0])
    assert len(bad & set(good.doc_id)) <= 0.1 * len(bad) and len(set(labels.doc_id[labels.quality == 1]) - set(good.doc_id)) <= 2

    want = {c for _, _, c in brute(list(zip(good.doc_id.tolist(), good.text)), 5, 80, 100)}
    assert sorted(single.doc_id) == sorted(want) and len(single) < len(good)
    assert sorted(clean.doc_id) == sorted(single.doc_id) and not clean.text.str.contains("@mail").any() and (clean.text.str.len() == clean.n_chars).all()
    assert sorted(map(tuple, mixed[ORDER].values.tolist())) == sorted(map(tuple, clean[ORDER].values.tolist())) and mixed.doc_id.tolist() != clean.doc_id.tolist()
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in tokens.itertuples():
        ids = lib.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and hashlib.sha256(r.ids).digest() == hashlib.sha256(np.array(ids, "<u4").tobytes()).digest()
    assert len(tokens) == len(mixed)
    # The place in the files, which the last stage keeps, is the order of the mix.
    assert tokens.sort_values("position").doc_id.tolist() == in_mix(spark, clean)


def in_mix(spark, rows):
    """The doc_ids of rows in the order of the mix of their sources."""
    return [r.doc_id for r in mixing.interleave(spark.createDataFrame(rows[ORDER])).orderBy("__position").collect()]


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0), (3, "x y z", "en", "a", 5), (3, "x y z", "en", "a", 5), (None, "x y z", None, "b", 5), (4, "w " * 90_000, "en", None, 180_000), (5, "a@b.cd is mine", "en", "a", 14)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = dict(corpus_pipeline.STAGES)
    single = names["near_duplicates"](spark, df, DIR).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in single) == [(False, 1), (False, 1), (False, 2), (False, 3), (False, 4), (False, 5)]
    clean = {r.doc_id: r for r in names["personal_data"](spark, df.where("doc_id = 5 or doc_id = 1").distinct(), DIR).collect()}
    assert clean[5].text == "[EMAIL] is mine" and clean[5].n_chars == 15 and clean[1].text is None and clean[1].n_chars is None
    assert len(names["mixing"](spark, df, DIR).collect()) == len(rows) and len(names["tokens"](spark, df, DIR).collect()) == len(rows)
    for f in names.values():
        assert f(spark, df.limit(0), DIR).collect() == []


def test_positions_do_not_depend_on_files(spark, tmp_path):
    """documents.parquet itself, filtered rows, files of unmixed rows that are named as Spark's, and rows dealt out anew."""
    docs = common.table(spark, DIR, "documents").select(*ORDER)
    docs.limit(150).repartition(3).write.parquet(str(tmp_path / "unmixed"))
    unmixed = spark.read.parquet(str(tmp_path / "unmixed"))
    tokens = dict(corpus_pipeline.STAGES)["tokens"]
    for df in (docs, docs.where("doc_id % 3 <> 0"), unmixed, unmixed.repartition(5)):
        got = tokens(spark, df, DIR).select("doc_id", "position").toPandas().sort_values("position")
        assert got.position.is_unique and got.doc_id.tolist() == in_mix(spark, df.toPandas())


def test_hot_rows_without_identifier(spark):
    """Many repeated rows: without identifier and text, and with the same of both."""
    n = 20_000
    df = spark.range(n, numPartitions=4).selectExpr("cast(null as bigint) as doc_id", "case when id % 2 = 0 then 'the very same words in all of them' end as text", "'en' as lang", "'a' as source", "id as n_chars")
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, DIR)
    assert [r.asDict() for r in got.groupBy("text").count().orderBy("text").collect()] == [{"text": None, "count": n // 2}, {"text": "the very same words in all of them", "count": 1}]


def test_run(spark, tmp_path, monkeypatch):
    for module in (common, corpus_pipeline):
        monkeypatch.setattr(module, "shared_dir", lambda _: str(tmp_path))
    got = corpus_pipeline.run(spark, DIR)
    assert got.columns == [*ORDER, "position", "n_tokens", "ids"]
    assert [f.name.split("-")[0] for f in tmp_path.iterdir()] == ["pipeline"], "only the result is left"
    rows = got.toPandas().sort_values("position")
    assert len(rows) > 50 and rows.position.is_unique and rows.doc_id.tolist() == in_mix(spark, rows)


def test_tokens_keep_the_places_that_mixing_gave(spark, tmp_path, monkeypatch):
    """What mixing decides is what comes out; rows that are no longer as it gave them are mixed by tokens."""
    docs = common.table(spark, DIR, "documents").select(*ORDER)
    sources = sorted(r.source for r in docs.select("source").distinct().collect())
    other = {"weights": {sources[0]: 9.0, sources[1]: 1.0}, "block_rows": 1}
    want = [r.doc_id for r in mixing.interleave(docs, **other).orderBy("__position").collect()]
    assert want != in_mix(spark, docs.toPandas())
    names = dict(corpus_pipeline.STAGES)
    mixing.in_order(docs, **other).write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    assert mixed.columns == ORDER
    got = names["tokens"](spark, mixed, DIR)
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan and "Exchange" not in plan
    rows = got.select("doc_id", "position").toPandas().sort_values("position")
    assert rows.doc_id.tolist() == want and rows.position.tolist() == list(range(len(want)))
    dealt = names["tokens"](spark, mixed.repartition(7), DIR).select("doc_id", "position").toPandas().sort_values("position")
    assert dealt.doc_id.tolist() == want

    mixed.repartition(3, "doc_id").write.parquet(str(tmp_path / "rewritten"))
    for df in (mixed.where("doc_id % 3 <> 0"), spark.read.parquet(str(tmp_path / "rewritten")), mixed.withColumn("n_chars", F.col("n_chars") + 1), mixed.union(mixed.limit(1))):
        again = names["tokens"](spark, df, DIR).select("doc_id", "position").toPandas().sort_values("position")
        assert again.doc_id.tolist() == in_mix(spark, df.toPandas()) and again.position.tolist() == list(range(len(again)))

    # In the whole run, too, another mix gives another result.
    for module in (common, corpus_pipeline):
        monkeypatch.setattr(module, "shared_dir", lambda _: str(tmp_path / "run"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("mixing", lambda s, d, _: mixing.in_order(d, **other)), ("tokens", names["tokens"])])
    assert [r.doc_id for r in corpus_pipeline.run(spark, DIR).orderBy("position").select("doc_id").collect()] == want
