"""Language identification and the quality classifier against versions written plainly, over whole tables."""

import bisect
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
import zstandard

from folio.llm import catalog, common, langid, quality

DIR = "/root/testdata/sf0.001"


def rows_of(spark, name, columns):
    return [tuple(r) for r in common.table(spark, DIR, name).select(*columns).collect()]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ---- language


def plain_bytes(text):
    return bytes(c if c >= 0x80 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in text.lower().encode())


def plain_dictionaries(rows, dict_bytes=96 << 10, most=512):
    found = {}
    often = Counter(g for _, _, g in rows if g is not None)
    for lang, n in often.items():
        own = [(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) % 2**30, i, len(t.encode()), t) for i, t, g in rows if g == lang and t is not None and regex.search(r"\p{L}", t)]
        taken, size = [], 0
        for h, i, b, t in sorted(x for x in own if x[0] <= min(1.0, 4 * most / n) * 2**30)[:most]:
            if size < dict_bytes:
                taken.append((i, t))
            size += b
        found[lang] = b" ".join(plain_bytes(t) for _, t in sorted(taken))[-2 * dict_bytes :]
    return dict(sorted(found.items(), key=lambda x: (-often[x[0]], x[0])))


def plain_language(text, dictionaries):
    if text is None or not regex.search(r"\p{L}", text):
        return langid.NONE, 0.0
    data, sizes = plain_bytes(text), []
    for d in dictionaries.values():
        pack = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
        sizes.append(sum(len(pack.compress(data[i : i + 1024])) for i in range(0, len(data), 1024)))
    least = min(sizes)
    score = 1 / sum(math.exp(-8.0 * (s - least) * 8.0 / len(text.encode())) for s in sizes)
    return list(dictionaries)[sizes.index(least)], score


def test_language_equals_plain_version(spark):
    rows = rows_of(spark, "documents", ["doc_id", "text", "lang"])
    dictionaries = plain_dictionaries([r for r in rows if fold(r[0], 5) != 0])
    want = {i: (fold(i, 5) == 0, *plain_language(t, dictionaries)) for i, t, _ in rows}
    got = catalog.op6_language(spark, DIR).collect()
    assert len(got) == len(rows) > 150
    for r in got:
        held, lang, score = want[r.doc_id]
        assert (r.held_out, r.lang_pred) == (held, lang) and r.score == pytest.approx(score, abs=1e-9), r.doc_id


def test_many_languages(spark):
    """A fixed set of more languages than any text tells apart: dictionaries share what is shipped, and the right one still wins."""
    words = {f"l{k:03d}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{j}x".replace(str(j), "abcdefghij"[j % 10] * (j // 10 + 1)) for j in range(40)] for k in range(300)}
    rows = [(1000 * k + i, " ".join(ws[(i * 7 + j) % 40] for j in range(30)), lang) for k, (lang, ws) in enumerate(words.items()) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    d = langid.learn(df.where("doc_id % 1000 < 2"))
    assert len(d) == 300 and sum(map(len, d.values())) <= langid.MOST_DICTIONARY_BYTES
    got = langid.predict(df.where("doc_id % 1000 = 2"), d).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 280


# ---- quality


def plain_features(text):
    b = (text or "").encode()
    words = regex.findall(rb"[^\x20\x09-\x0D]+", b)
    lower = [w.lower() for w in words]
    isletter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    stop, space = b".,;:!?'\"-()", bytes([32, *range(9, 14)])
    by, n = max(len(b), 1), max(len(words), 1)
    share = lambda f: sum(map(f, b)) / by
    got = {
        "log_bytes": math.log1p(len(b)), "log_words": math.log1p(len(words)), "word_length": sum(map(len, words)) / n, "upper": share(lambda c: 65 <= c <= 90), "digit": share(lambda c: 48 <= c <= 57),
        "stop": share(lambda c: c in stop), "symbol": share(lambda c: not isletter(c) and not 48 <= c <= 57 and c not in stop and c not in space), "space": share(lambda c: c in space), "wide": share(lambda c: c >= 128),
        "newline": share(lambda c: c == 10), "distinct": len(set(lower)) / n, "repeated": sum(x == y for x, y in zip(lower, lower[1:])) / n, "commonest": max(Counter(lower).values(), default=0) / n,
        "no_letter": sum(not any(map(isletter, w)) for w in words) / n, "odd_end": sum(not (isletter(w[-1]) or 48 <= w[-1] <= 57 or w[-1] in b".,;:!?") for w in words) / n,
        "sentence": len(words) / (sum(c in b".!?" for c in b) + 1), "long_word": sum(len(w) > 20 for w in words) / n,
    }
    return [got[k] for k in quality.FEATURES]


def plain_tree(grad, hess, splits, ridge=2.0):
    value = lambda a, b: sum(grad[a:b]) / (sum(hess[a:b]) + ridge)
    gain = lambda a, b: sum(grad[a:b]) ** 2 / (sum(hess[a:b]) + ridge)
    leaves = [(0, len(grad))]
    for _ in range(splits):
        cuts = [(gain(a, m) + gain(m, b) - gain(a, b), a, m, b) for a, b in leaves for m in range(a + 1, b)]
        best = max(cuts, key=lambda c: c[0], default=(0,))
        if best[0] <= 1e-9:
            break
        _, a, m, b = best
        leaves.remove((a, b))
        leaves += [(a, m), (m, b)]
    out = [0.0] * len(grad)
    for a, b in leaves:
        out[a:b] = [value(a, b)] * (b - a)
    return out


def plain_model(x, y, rounds, pair_rounds, n_pairs, rate=0.15):
    """A function of a row of features: cyclic boosting of lookup tables, then of tables of pairs."""
    dims = range(len(x[0]))
    edges = [[sorted(set(np.quantile([r[j] for r in x], np.linspace(0, 1, n + 1)[1:-1]).tolist())) for j in dims] for n in (64, 8)]
    bins = lambda r, k: [bisect.bisect_right(edges[k][j], r[j]) for j in dims]
    fine, wide = [bins(r, 0) for r in x], [bins(r, 1) for r in x]
    share = sum(y) / len(y)
    base = math.log(share / (1 - share))
    f = [base] * len(y)

    def step(cells, size):
        g, h = [0.0] * size, [0.0] * size
        for i, c in enumerate(cells):
            p = 1 / (1 + math.exp(-f[i]))
            g[c] += y[i] - p
            h[c] += p * (1 - p)
        return g, h

    tables = [[0.0] * (len(edges[0][j]) + 1) for j in dims]
    for _ in range(rounds):
        for j, t in enumerate(tables):
            add = [rate * v for v in plain_tree(*step([b[j] for b in fine], len(t)), 2)]
            t[:] = [u + v for u, v in zip(t, add)]
            f = [v + add[b[j]] for v, b in zip(f, fine)]
    rest = []
    for i in dims:
        for j in range(i):
            k = len(edges[1][j]) + 1
            g, h = step([b[i] * k + b[j] for b in wide], (len(edges[1][i]) + 1) * k)
            rest.append((sum(u * u / (v + 2.0) for u, v in zip(g, h)), i, j))
    pairs = [(i, j, len(edges[1][j]) + 1, [0.0] * ((len(edges[1][i]) + 1) * (len(edges[1][j]) + 1))) for _, i, j in sorted(rest, reverse=True)[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, k, t in pairs:
            g, h = step([b[i] * k + b[j] for b in wide], len(t))
            n = len(t) // k
            side = plain_tree([sum(g[r * k : r * k + k]) for r in range(n)], [sum(h[r * k : r * k + k]) for r in range(n)], 1)
            add = [0.0] * len(t)
            for v in set(side):
                own = [r for r in range(n) if side[r] == v]
                tree = plain_tree([sum(g[r * k + c] for r in own) for c in range(k)], [sum(h[r * k + c] for r in own) for c in range(k)], 1)
                for r in own:
                    add[r * k : r * k + k] = [rate * z for z in tree]
            t[:] = [u + v for u, v in zip(t, add)]
            f = [v + add[b[i] * k + b[j]] for v, b in zip(f, wide)]

    def score(r):
        b, c = bins(r, 0), bins(r, 1)
        return 1 / (1 + math.exp(-(base + sum(t[b[j]] for j, t in enumerate(tables)) + sum(t[c[i] * k + c[j]] for i, j, k, t in pairs))))

    return score


def test_features_equal_plain_version(spark):
    texts = [t for _, t in rows_of(spark, "documents", ["doc_id", "text"])] + ["", " ", "Ab, ab! | 12\nÉé ab", "x" * 25 + " --"]
    raw, off = common.flat_bytes(pa.array([t or "" for t in texts]))
    assert np.allclose(quality.features(raw, off), [plain_features(t) for t in texts], rtol=0, atol=1e-12)


def test_quality_equals_plain_version(spark):
    """The query, trees, tables, pairs and all: as many rounds as production has."""
    docs = dict(rows_of(spark, "documents", ["doc_id", "text"]))
    labels = [(i, q) for i, q in rows_of(spark, "labels", ["doc_id", "quality"]) if q is not None and fold(i, 3) != 1 and i in docs]
    model = quality.Additive()
    x = np.array([plain_features(docs[i]) for i, _ in labels])
    order = np.lexsort(x.T)
    score = plain_model(x[order].tolist(), [labels[k][1] for k in order], model.rounds, model.pair_rounds, model.n_pairs)
    for r in catalog.op10_quality(spark, DIR).collect():
        assert r.held_out == (fold(r.doc_id, 3) == 1) and r.predicted == (r.score >= 0.5)
        assert r.score == pytest.approx(score(plain_features(docs[r.doc_id])), abs=1e-6), r.doc_id
