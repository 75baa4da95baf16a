"""Repeated strings against brute force over all windows."""

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from folio.llm import suffix_dedup, winnow


def brute(rows, width, keep):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of rows (doc_id, text)."""
    places = defaultdict(list)
    raws = [(t or "").encode() for _, t in rows]
    for i, b in enumerate(raws):
        for s in range(len(b) - width + 1):
            places[b[s : s + width]].append(((rows[i][0] if rows[i][0] is not None else 2**63 - 1, s), i, s))
    gone = [np.zeros(len(b), bool) for b in raws]
    for p in places.values():
        if len(p) > 1:
            least = min(x[0] for x in p)
            for at, i, s in p:
                if keep == "none" or at != least:
                    gone[i][s : s + width] = True
    return sorted(
        ((rows[i][0], len(b), int(g.sum()), int(np.diff(np.append(0, g.astype(int))).clip(0).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~g].tobytes()).hexdigest()) for i, (b, g) in enumerate(zip(raws, gone))), key=str
    )


def corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line, whole = text(90), "license " * 9, text(120)
    rows = [(0, None), (1, ""), (2, "x"), (3, "a" * 700), (4, whole), (5, whole), (6, whole[:180] + "Q" + whole[181:]), (8, passage + passage), (9, "y" * 199), (10, "y" * 199), (11, "z" * 200), (12, "z" * 200)]
    rows += [(20 + i, text(r.randint(0, 60)) + passage[r.randint(0, 50) : r.randint(260, 400)] + text(r.randint(0, 40))) for i in range(25)]
    rows += [(60 + i, text(20) + line + text(20)) for i in range(25)]
    for i in range(20):
        t = list(whole)
        t[r.randrange(len(t))] = "#"
        rows.append((100 + i, "".join(t)))
    return rows + [(4, whole), (None, "no id " + passage)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot,batch", [("", 10_000), ("", 2), ("anchors", 10_000), ("anchors", 2), ("anchors", 5), ("edges", 10_000), ("edges", 5), ("small", 10_000)])
def test_equals_brute_force(spark, keep, hot, batch, monkeypatch):
    rows = corpus()
    if keep == "first":
        rows = [r for i, r in enumerate(rows) if r[0] is not None and r[0] not in [x[0] for x in rows[:i]]]
    if hot == "edges":
        monkeypatch.setattr(suffix_dedup, "HOT_EDGES", 2)
    if hot == "anchors":  # everything that occurs a few times takes the way of very frequent anchors
        monkeypatch.setattr(suffix_dedup, "HOT_HERE", 3)
        monkeypatch.setattr(suffix_dedup, "HOT_ALL", 4)
    if hot == "small":  # every anchor is sorted apart
        monkeypatch.setattr(suffix_dedup, "BATCH", 1)
        monkeypatch.setattr(suffix_dedup, "HELD", 1)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, th string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted((tuple(r) for r in suffix_dedup.removed(df, keep=keep).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, 200, keep)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_longest_matches_of_contexts(keep):
    """Against all pairs, on strings that are prefixes of each other, equal, or end in zero bytes."""
    r = random.Random(11)
    texts = [bytes(r.choice(b"ab\0") for _ in range(r.randint(1, 9))) for _ in range(200)] + [b"a", b"a\0", b"a\0\0"] * 3
    position = np.array(r.sample(range(len(texts)), len(texts)))
    order, lcp = suffix_dedup.context_order(texts, np.argsort(position))
    got = suffix_dedup.longest_matches(order, lcp, position, keep)
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    want = [max([common(t, u) for j, u in enumerate(texts) if j != i and (keep == "none" or position[j] < position[i])], default=0) for i, t in enumerate(texts)]
    assert got.tolist() == want


@pytest.mark.parametrize("keep", ["none", "first"])
def test_anchors_of_many_batches(spark, keep, monkeypatch):
    """No run is lost where one anchor fills several batches."""
    monkeypatch.setattr(suffix_dedup, "HOT_ALL", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        r = random.Random(7)
        text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
        passage = text(210)
        rows = [(i, text(r.randint(0, 300)) + passage + text(r.randint(0, 300))) for i in range(12)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = sorted((tuple(x) for x in suffix_dedup.removed(df, keep=keep).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, 200, keep)


def test_documents(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"]) for r in t]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.removed(df, with_text=True).collect()
    want = brute(rows, 200, "none")
    assert sorted((tuple(r)[:5] for r in got), key=str) == want and sum(w[2] for w in want) > 10_000
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert suffix_dedup.removed(df.limit(0)).collect() == []


def test_longest_previous_factors():
    r = random.Random(5)
    s = bytes(r.choice(b"ab") for _ in range(300))
    n, width = len(s), 40
    data = np.frombuffer(s + b"\0" * width, np.uint8)
    order, lcp = suffix_dedup.suffix_order(data, np.arange(n), width)
    got = np.zeros(n, int)
    got[order] = suffix_dedup.longest_previous(order, lcp)
    common = lambda i, j: next((k for k in range(width) if data[i + k] != data[j + k]), width)
    assert got.tolist() == [max([common(i, j) for j in range(i)], default=0) for i in range(n)]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    raw[3000:3400] = raw[100:500]
    off = np.array([0, 0, 50, 2000, 5000])
    lo, hi, at, h = winnow.runs(raw, off, 200, 64)
    anchor = {s: a - s for x, y, a in zip(lo, hi, at) for s in range(x, y + 1)}
    assert sorted(anchor) == [*range(50, 1801), *range(2000, 4801)]
    assert all(anchor[100 + i] == anchor[3000 + i] for i in range(201))


def test_many_copies_keep_the_first(spark):
    """Copies of one text are one row before anything is gathered."""
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.range(20_000, numPartitions=4).selectExpr("id as doc_id", f"case when id < 5 then concat('own start ', id, ' {text}') else '{text}' end as text").repartition(4)
    assert suffix_dedup._runs(df.selectExpr("doc_id as ord", "text", "xxhash64(text) as th"), 200, 64).groupBy("th", "ord").count().count() <= 4 * 6
    got = suffix_dedup.removed(df, keep="first").groupBy("n_removed", "n_bytes").count().collect()
    head = len("own start 0 ")
    assert {(r.n_bytes - r.n_removed, r["count"]) for r in got} == {(len(text) + head, 1), (head - 1, 4), (0, 19_995)}


def test_anchors_of_long_texts_by_pieces(monkeypatch):
    """Texts shorter and longer than a piece: each window is in one run, and equal windows have equal anchors and equal runs equal hashes, wherever pieces end."""
    monkeypatch.setattr(winnow, "PLACE", 9)
    rng = np.random.default_rng(4)
    raw = rng.integers(97, 100, 9000).astype(np.uint8)
    raw[6100:7900] = raw[1000:2800]
    raw[8300:8700] = raw[0]
    off = np.array([0, 90, 90, 700, 900, 4000, 4001, 4250, 6000, 9000])
    lo, hi, at, h, ctx = winnow.contexts(raw, off, 200, 64)
    windows = [s for a, b in zip(off[:-1], off[1:]) for s in range(a, b - 199)]
    assert [s for x, y in zip(lo, hi) for s in range(x, y + 1)] == windows
    by_window, by_run = {}, {}
    for x, y, a, g, c in zip(lo.tolist(), hi.tolist(), at.tolist(), h.tolist(), ctx.tolist()):
        assert x + 136 >= a >= y and by_run.setdefault(c, raw[x : y + 200].tobytes()) == raw[x : y + 200].tobytes()
        assert by_run.setdefault(g, raw[a : a + 64].tobytes()) == raw[a : a + 64].tobytes()
        for s in range(x, y + 1):
            assert by_window.setdefault(raw[s : s + 200].tobytes(), (a - s, g)) == (a - s, g)
    assert len(by_window) < len(windows) - 1500 and len(set(ctx.tolist())) < len(ctx)


def test_anchors_take_little_memory():
    """The arrays of a piece fit a cache, so that 1 MB of text needs little beside its runs: whole arrays of 8 bytes for each byte made this stage the dearest."""
    raw = np.random.default_rng(6).integers(97, 123, 1 << 20).astype(np.uint8)
    off = np.arange(0, len(raw) + 1, 2048)
    winnow.runs(raw, off, 200, 64)
    tracemalloc.start()
    try:
        winnow.runs(raw, off, 200, 64)
        assert tracemalloc.get_traced_memory()[1] < 6 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("width", [1, 7, 8, 20, 200])
def test_common_prefixes(width):
    rows = np.random.default_rng(width).integers(0, 2, (300, width)).astype(np.uint8)
    rows[100:] = rows[:200]
    rows[::3, -1] ^= 1
    order = np.array(sorted(range(300), key=lambda i: rows[i].tobytes()))
    got = suffix_dedup.common_prefixes(rows, order)
    assert got.tolist() == [0] + [next((k for k in range(width) if rows[i, k] != rows[j, k]), width) for i, j in zip(order, order[1:])]
