"""The filter audit against a plain version: every order run one filter after another."""

import itertools

import pytest

from folio.llm import audit


def plain(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = []
    for i, t, s in docs:
        t = t or ""
        w = t.encode().split()
        f = set()
        f |= {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        f |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        f |= {"E"} if i is not None and least[t] < i else set()
        fails.append((s or "", f, i))
    out, shapley = [], {}
    for part in {s for s, _, _ in fails}:
        own = [(f, i) for s, f, i in fails if s == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for k, c in enumerate(order):
                here = [x for x in left if c in x[0]]
                left = [x for x in left if c not in x[0]]
                shapley[part, c] = shapley.get((part, c), 0) + len(here)
                out.append((part, "".join(order), k + 1, len(left), len(here), sum(c in f for f, _ in gone), sum(f == {c} for f, _ in own), sum(i in good for _, i in here), sum(i in toxic for _, i in here)))
                gone += here
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


PROSE = " ".join(f"word{i}" for i in range(250))
DOCS = [
    (1, PROSE, "a"), (2, PROSE, "b"), (3, PROSE, None), (4, PROSE + " # ", "a"), (5, "THE SAME " * 150, "a"), (6, None, "a"), (7, "", ""), (8, "short | text", None), (9, PROSE[:-1] + "X", "a"), (9, PROSE, "a"),
    (1, PROSE, "a"), (None, PROSE, "b"), (None, "", "b"), (10, "é" * 5000, "b"), (11, "é" * 4999 + "e", "b"), (12, "é" * 5000, "a"), (13, "same same " * 300, "b"), (-5, "short | text", "a"), (14, "x" * 300_000, "a"), (15, "x" * 300_000, "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (5, 0, 1), (9, 1, 0), (12, 1, 1), (None, 1, 1), (77, 1, 1)]


@pytest.mark.parametrize("bits", [64, 1])
def test_equals_plain_version(spark, bits):
    docs = spark.createDataFrame([(*r, 7, "m") for r in DOCS], "doc_id long, text string, source string, mask int, part string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = audit.audit(docs, labels, bits=bits)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == plain(DOCS, LABELS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a", "s")], docs.schema)
    assert audit.audit(one, labels).count() == 600
