"""The index of live digests: filter, insertion, deletion, clashing digests, copies in bulk."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import bodies, cuckoo

SCHEMA = "doc_id long, text string, row string, digest string"


def plain(rows):
    norm = lambda t: (t or "").encode().translate(None, b" \t\n\x0b\f\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0))
    for i, t in rows:
        g = sorted(groups[norm(t)])
        yield i, None if g[0][1] else g[0][2], len(g), hashlib.sha256(norm(t)).hexdigest()


def check(got, rows):
    assert sorted((tuple(r)[:3] + (r.text_sha256,) for r in got), key=str) == sorted(plain(rows), key=str)
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    for g in groups.values():
        assert sum(r.kept for r in g) == 1 and all(r.doc_id == r.keep_id for r in g if r.kept)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)


ODD = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " \x0b\f\r"), (7, "a b"), (8, "é" * 9), (9, "é" * 9 + " "), (9, "é" * 9 + " "), (None, "ab   "), (None, "z"), (10, "z"), (-(2**63), "z"), (11, "w" * 300_000), (12, "w" * 300_000 + "\n")]


@pytest.mark.parametrize("bits", [64, 4])
def test_odd_texts_and_clashing_digests(spark, bits):
    rows = ODD + [(100 + i, f"text {i % 40}") for i in range(120)]
    check(cuckoo.duplicates(frame(spark, rows), bits=bits).collect(), rows)


def test_empty_table(spark):
    assert cuckoo.duplicates(frame(spark, ODD).limit(0)).collect() == []


def test_copies_are_counted_before_they_meet(spark):
    docs = spark.range(100_000, numPartitions=8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("the same").alias("text"))
    made = cuckoo._thinned(docs.select(F.xxhash64("text").alias("d"))).groupBy("digest").count().agg(F.max("count")).first()[0]
    assert made <= 2 * 8
    got = cuckoo.duplicates(docs).groupBy("group_size", "kept").count().collect()
    assert {tuple(r) for r in got} == {(1, True, 33_334), (66_666, True, 1), (66_666, False, 66_665)}


def test_insertion_and_deletion(spark):
    first, second = [(i, f"t{i % 30}") for i in range(60)], [(100 + i, f"t {i}") for i in range(20, 50)]
    index = cuckoo.Index(spark, shards=4).insert(frame(spark, first)).insert(frame(spark, second))
    check(index.report().collect(), first + second)
    gone = {*range(0, 20), *range(120, 150)}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in first + second if r[0] not in gone]
    check(index.report().collect(), left)
    # Each live digest has one mark, no other has one.
    marks = sum(int(np.count_nonzero(np.frombuffer(r.cells, np.uint16))) for r in index.filters.collect())
    assert marks == len({t.replace(" ", "") for _, t in left})
    again = [(500 + i, f"t{i}") for i in range(0, 60)]
    check(index.insert(frame(spark, again)).report().collect(), left + again)


def test_full_filters_are_built_from_stored_keys(spark):
    first, second = [(i, f"a{i}") for i in range(300)], [(1000 + i, f"b{i}") for i in range(3000)]
    index = cuckoo.Index(spark, shards=1).insert(frame(spark, first))
    small = len(index.filters.first().cells)
    index.insert(frame(spark, second))
    assert len(index.filters.first().cells) > 4 * small
    keys = np.array([r.digest for r in index.members().collect()], np.int64)
    assert cuckoo.CuckooFilter(cells=index.filters.first().cells).contains(keys).all()


def test_filter():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 20_000))
    rng.shuffle(keys)
    live = cuckoo.build(keys)
    assert live.contains(keys).all() and np.count_nonzero(live.cells) == len(keys)
    other = np.setdiff1d(rng.integers(-(2**63), 2**63 - 1, 50_000), keys)
    assert live.contains(other).mean() < 0.001
    live.delete(keys[:15_000])
    assert live.contains(keys[15_000:]).all() and live.contains(keys[:15_000]).mean() < 0.001
    assert np.count_nonzero(live.cells) == 5_000 and not cuckoo.CuckooFilter(16).insert(keys)


def test_one_sha_and_two_texts_is_an_error(spark):
    rows = spark.createDataFrame([(1, "s", "a"), (1, "s", "b")], "key long, sha string, text string").repartition(2)
    with pytest.raises(Exception, match="one SHA-256"):
        bodies.confirmed(bodies.packed(rows.withColumn("sha", F.col("sha"))).unionByName(bodies.packed(rows.where("text = 'b'")))).collect()
