"""The similarity join against all pairs, and its pieces against plain versions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import common, jaccard
from folio.llm.components import components


def plain_set(text, n):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, num, den):
    sets = [plain_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                c = len(sets[i] & sets[j])
                if den * c >= num * (len(sets[i]) + len(sets[j]) - c):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    name = lambda i: min((d for d in least[find(i)] if d is not None), default=None) if sets[i] else rows[i][0]
    return sorted(((rows[i][0], len(sets[i]), name(i)) for i in range(len(rows))), key=str)


def corpus(seed, near=40):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "é É"), (8, "a b c d"), (9, "a b c d e"), (9, "a b c d e")]
    k = 20
    line = [word() for _ in range(30)]
    for size in (5, 8, 12, 20, 30, 60, 150, 400):
        base = [word() for _ in range(size)] + (line if size > 20 else [])
        for c in range(near // 4):
            t = list(base)
            for _ in range(r.randint(0, max(1, size // 25))):
                what, at = r.random(), r.randrange(len(t))
                if what < 0.4:
                    t[at] = word()
                elif what < 0.7:
                    del t[at]
                else:
                    t.insert(at, word())
            rows.append((k, " ".join(t)))
            k += 1
    rows += [(k + i, " ".join([word() for _ in range(r.randint(3, 50))] + line)) for i in range(30)]
    rows.append((None, rows[40][1]))
    return rows


@pytest.mark.parametrize("seed,n,num,den,hot", [(1, 4, 85, 100, False), (2, 5, 80, 100, False), (3, 4, 85, 100, True), (4, 3, 60, 100, False)])
def test_equals_all_pairs(spark, seed, n, num, den, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(jaccard, "HOT_HERE", 3)
        monkeypatch.setattr(jaccard, "HOT_ALL", 4)
        monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, s string, n int").repartition(3)
    got = jaccard.classes(df, n, num, den).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, n, num, den)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.classes(df).collect() == []
    assert len(jaccard.classes(spark.createDataFrame([(1, ""), (1, "")], "doc_id long, text string")).collect()) == 2


def test_sets():
    texts = ["", "a", "A b C d", "a b c d a b c d a b c d", "x\ny", "a b c d"]
    s, border = jaccard.shingle_sets(*common.flat_bytes(pa.array(texts)), 4)
    assert np.diff(border).tolist() == [len(plain_set(t, 4)) for t in texts]
    names = jaccard.set_names(s, border)
    assert names[2] == names[5] and len(set(names.tolist())) == 5


def test_every_similar_pair_shares_a_bucket():
    r = np.random.default_rng(7)
    missed = 0
    for trial in range(3000):
        n = int(r.integers(1, 60))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        most = jaccard.most_different(len(a), len(a), 85, 100)
        b = np.setdiff1d(a, r.choice(a, min(len(a), int(r.integers(0, most + 1))), replace=False))
        b = np.union1d(b, r.integers(0, 2**63, int(r.integers(0, most + 1))).astype(np.uint64))
        c = len(np.intersect1d(a, b))
        if not len(b) or 100 * c < 85 * (len(a) + len(b) - c):
            continue
        keys = [{(k, own) for ks, own in jaccard.signatures(x, 85, 100) for k in ks.tolist()} for x in (a, b)]
        shared = {k for k, _ in keys[0]} & {k for k, _ in keys[1]}
        own = {k for k, o in keys[0] | keys[1] if o}
        missed += not shared & own
    assert missed == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(5, 5), (7, 3), (r.randrange(200, 240), r.randrange(200, 240))]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(31)}) == 1 and len({got[i] for i in range(100, 140)}) == 1 and got[0] != got[100]


def test_bitmaps_differ_in_no_more_bits_than_sets(spark):
    r = np.random.default_rng(3)
    sets = []
    for n in (0, 1, 300, 511, 513, 900, 1100, 5000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        sets += [a, np.union1d(a[: len(a) * 9 // 10], r.integers(0, 2**63, n // 10).astype(np.uint64))]
    bits = jaccard.bitmaps(np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets]))).to_pylist()
    pairs = [(i, len(a), bits[i], j, len(b), bits[j]) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j]
    df = spark.createDataFrame(pairs, "a int, an long, ab array<long>, b int, bn long, bb array<long>").selectExpr("a", "b", "named_struct('n', an, 'bits', ab) as x", "named_struct('n', bn, 'bits', bb) as y")
    got = {(x.a, x.b): x.fine for x in df.selectExpr("a", "b", f"{jaccard.few_bits_differ(80, 100)} as fine").collect()}
    similar = {(i, j): len(sets[i]) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) for i, _, _, j, _, _ in pairs}
    assert all(got[p] for p, yes in similar.items() if yes) and sum(map(bool, similar.values())) >= 6
    near = lambda i, j: 500 < min(len(sets[i]), len(sets[j])) and max(len(sets[i]), len(sets[j])) < 1.5 * min(len(sets[i]), len(sets[j]))
    assert not any(got[p] for p in got if near(*p) and not similar[p])


def test_long_unlike_sets_in_one_bucket(spark):
    """Long texts that share passages but are not similar, beside some that are."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(900)]
    rows = [(i, " ".join(passage + [word() for _ in range(r.choice((0, 40, 700)))])) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.classes(df, 5, 80, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, 5, 80, 100)
