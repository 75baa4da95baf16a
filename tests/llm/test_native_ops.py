"""Mixing, personal data and fingerprints against plain Python versions."""

import hashlib
import heapq
import math
import random
import re
import time

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import fingerprint, mixing, pii

# ---- mixing


def edf(blocks: dict, tickets: dict):
    """(slot, source, block, release, deadline) of one global earliest-deadline-first schedule, in exact arithmetic."""
    names = sorted(blocks)
    fluid = lambda s, k: sum(min(tickets[u] * k, blocks[u] * tickets[s]) for u in names)
    jobs = sorted((fluid(s, k) // tickets[s], -(-fluid(s, k + 1) // tickets[s]), s, k) for s in names for k in range(blocks[s]))
    heap, at, out = [], 0, []
    for t in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= t:
            r, d, s, k = jobs[at]
            heapq.heappush(heap, (d, s, k, r))
            at += 1
        d, s, k, r = heapq.heappop(heap)
        out.append((t, s, k, r, d))
    return out


def test_mixing_equals_global_schedule(spark):
    sizes = {"a": 301, "b": 97, "c": 5, None: 11, "": 1, "hot": 999}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, s, "t", "x", 1, "m"))
            i += 1
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, block string, patterns int, m string")
    weights = {"a": 0.5, "hot": 0.3, "b": 0.2}
    got = mixing.interleave(df, weights, block_rows=4, resolution=20).collect()
    assert len(got) == len(rows) and sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    name = lambda s: "n" if s is None else "s" + s
    counts = {name(s): n for s, n in sizes.items()}
    counts["sa"] += 1
    tickets = {s: 1 for s in counts} | {"sa": 10, "shot": 6, "sb": 4}
    want = edf({s: math.ceil(n / 4) for s, n in counts.items()}, tickets)
    assert {(r["__slot"], name(r.source), r["__block"], r["__release"], r["__deadline"]) for r in got} == set(want)
    # Every prefix is within one block of the fluid mix, and blocks are within their windows.
    blocks, done, total = {s: math.ceil(n / 4) for s, n in counts.items()}, dict.fromkeys(counts, 0), 0
    assert all(r <= t < d for t, _, _, r, d in want)
    ordered = mixing.in_order(df, weights, block_rows=4, resolution=20).collect()
    position = {}
    for r in got:
        position.setdefault(r.doc_id, []).append(r["__position"])
    assert [r.doc_id for r in ordered] == [d for d, _ in sorted(((d, p) for d, ps in position.items() for p in ps), key=lambda x: x[1])]
    assert ordered[0].asDict().keys() == {"doc_id", "source", "text", "block", "patterns", "m"}
    assert mixing.interleave(df.limit(0)).collect() == [] and total == 0 and sum(done.values()) == 0 and sum(blocks.values()) == len(want)


def test_deviation_is_below_one_block():
    blocks, tickets = {"a": 40, "b": 13, "c": 3, "d": 90}, {"a": 7, "b": 2, "c": 1, "d": 10}
    want, done = edf(blocks, tickets), dict.fromkeys(blocks, 0)
    total = sum(blocks.values())

    def fluid(t):  # by bisection on the common progress
        lo, hi = 0.0, 1000.0
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(tickets[s] * mid, blocks[s]) for s in blocks) < t else (lo, mid)
        return {s: min(tickets[s] * hi, blocks[s]) for s in blocks}

    for t, s, _, _, _ in want:
        done[s] += 1
        f = fluid(t + 1)
        assert all(abs(done[u] - f[u]) < 1 + 1e-6 for u in blocks)
    assert sum(done.values()) == total


# ---- personal data


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(pii.BASE):
        for m in re.finditer(kind.plain, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind.name == "ip" else True, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind.name]
            if ok:
                out.append((m.start(), k, f"{kind.name}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


ODD = [
    None, "", "a@b.c", "é🙂 x.y@z-1.co.uk, a@b a@@b.c a@b.c@d.e a@b.cx_y@d.e %+-@a.b..c", "1.2.3.4 1.2.3.4.5 256.1.1.1 001.0002.3.4 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 4111-1111-1111-1111",
    "4111111111111111", "5 4111111111111111", "5  4111111111111111", "4111 1111 1111 11114111111111111111 9", "+1 (017) 555-7713 +49 30 1234567 ++12345678901 +1234567890123456", "1 " * 30_000, "a" * 20_000, "9" * 20_000,
    "a.b" * 3_000 + "@c.d", "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "my SSN 078-05-1120" + " " * 50 + "078-05-1120", "call 555.123.4567" + " " * 50 + "555.123.4567", "7536784127813050 4845168114407329", "x@y.z" * 500,
]


def test_spans_equal_plain_patterns(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(ODD)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.digest_query(df).collect()}
    for i, t in enumerate(ODD):
        want = base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t or "")[:80]
        assert set(want) <= set(got[i].spans.split(",")) or not want
    assert "iban:5:32" in got[15].spans and "iban:37:59" in got[15].spans
    assert got[16].spans == "ssn:7:18" and got[17].spans == "national_phone:5:17" and got[18].spans == "card_run:0:16,card_run:17:33"
    assert pii.digest_query(df.limit(0)).collect() == []


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.text(alphabet="0123456789 .-+()@ab%é🙂", max_size=60), min_size=30, max_size=30))
def test_spans_of_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest_query(df).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(base(texts[r.doc_id])).encode()).hexdigest(), texts[r.doc_id]


def test_context_words_and_borders(spark):
    texts = {
        "hotel 555-123-4567": "", "Tel 555-123-4567": "national_phone:4:16", "555-123-4567 (call)": "national_phone:0:12", "hot" + "x" * 37 + "tel 555-123-4567": "", "tel" + " " * 38 + "555-123-4567": "",
        "tel" + " " * 37 + "555-123-4567": "national_phone:40:52", "555-123-4567" + " " * 37 + "fax": "national_phone:0:12", "555-123-4567" + " " * 36 + "faxes": "", "call 1555-123-4567": "", "call 555-123-45678": "",
        "é" * 600 + " ssn: 078-05-1120 " + "é" * 600: "ssn:606:617", "ssn 1078-05-1120": "", "xDE89370400440532013000": "", "ssn 078-05-1120 or ssn 078-05-1121": "ssn:4:15,ssn:23:34",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {list(texts)[r.doc_id]: r.spans for r in pii.digest_query(df).collect()}
    assert got == texts


def test_many_matches_take_no_square_time(spark):
    one = "ask some.one@mail.example or +1 (017) 555-7713 at 10.0.0.1; "
    df = spark.createDataFrame([(1, one * 16_000)], "doc_id long, text string")
    pii.digest_query(spark.createDataFrame([(0, one)], "doc_id long, text string")).collect()
    start = time.perf_counter()
    r = pii.digest_query(df).collect()[0]
    assert (r.n_email, r.n_phone, r.n_ip) == (16_000, 16_000, 16_000) and time.perf_counter() - start < 20
    start = time.perf_counter()
    assert pii.redact(df).collect()[0].text == "ask [EMAIL] or [PHONE] at [IP]; " * 16_000 and time.perf_counter() - start < 20


def test_redact(spark):
    df = spark.createDataFrame([(1, "mail x@y.zz and +1 (017) 555-7713!"), (2, None), (3, "é clean"), (4, "+4111111111111111@a.b")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "mail [EMAIL] and [PHONE]!", 2: None, 3: "é clean", 4: "[EMAIL]"}


# ---- fingerprints


def xx(*xs):
    seed = 42
    for x in xs:
        if x is not None:
            raw = x.encode() if isinstance(x, str) else x.to_bytes(8, "little", signed=True) if isinstance(x, int) else x
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def units(t):
    own = lambda c: any(lo <= ord(c) <= hi for lo, hi in ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)))
    out, run = [], ""
    for c in t + " ":
        if own(c) or c in " \t\n\x0b\f\r" or len(run) == fingerprint.PIECE:
            out += [run] * bool(run)
            run = ""
        if own(c):
            out.append(c)
        elif c not in " \t\n\x0b\f\r":
            run += c
    return out or [t]


def codes(t):
    """Order MinHash, written plainly: each seed orders all numbered k-mers and takes the least."""
    if t == "":
        return []
    top = lambda h: (h >> fingerprint.PLACE) << fingerprint.PLACE
    seen, kmers, u = {}, [], units(t)
    for i, w in enumerate(u):
        h = top(xx(w, u[i + 1] if i + 1 < len(u) else None))
        n = seen[h] = seen.get(h, -1) + 1
        kmers.append((top(xx(h, n.to_bytes(4, "little"))), i))
    out, turns = [], fingerprint.SKETCH // fingerprint.RINGS
    for ring in range(fingerprint.RINGS):
        hashed = [(h if ring == 0 else top(xx(h, ring.to_bytes(4, "little"))), i) for h, i in kmers]
        for j in range(turns):
            turn = top((2 * j + 1) * 2**62 // turns - 2**63 + (j << 60) // turns)
            best = sorted(hashed, key=lambda x: ((x[0] - turn) % 2**64, x[1]))[: fingerprint.TUPLE]
            best = best if len(best) > 1 else best * fingerprint.TUPLE
            out.append(xx(*[h for h, _ in sorted(best, key=lambda x: x[1])], ring.to_bytes(4, "little"), j.to_bytes(4, "little")) & 65535)
    return out


def test_fingerprints(spark):
    long = " ".join(f"w{i * i % 97}" for i in range(700))
    texts = {5: "a", 1: None, 9: "the cat sat on the mat and the cat sat", 2: "", 12: long, 13: long[:2000] + " x " + long[2000:], 14: long, 20: "🙂é" * 40, 30: "abc" * 5000, 40: " ".join(f"q{i}" for i in range(70))}
    df = spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id long, text string, n_chars string")
    got = {r.doc_id: r for r in fingerprint.digest_query(df).collect()}
    ids = sorted(texts)
    said = lambda c: "".join(f"{v:04x}" for v in c)
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / fingerprint.SKETCH if a and b else float(len(a) == len(b))
    for k, i in enumerate(ids):
        t, nxt = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        e = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r.fingerprint == said(codes(t)) and r.edited_fingerprint == said(codes(e)), t[:50]
        assert r.near_edited == like(codes(t), codes(e)) and r.near_next == like(codes(t), codes(nxt))
    assert got[12].fingerprint == got[14].fingerprint and got[12].near_next > 0.8 and got[13].near_next > 0.8
    assert fingerprint.digest_query(df.limit(0)).collect() == []
    one = fingerprint.digest_query(df.where("doc_id = 12")).collect()
    assert one[0].near_next == 1.0
    twice = fingerprint.digest_query(df.union(df)).collect()
    assert len(twice) == 2 * len(texts)


def test_fingerprints_of_all_sizes_compare(spark):
    """One unit for all texts: an edit that changes the number or the length of words much leaves texts comparable."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    long, prose, token = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(1500)), " ".join(word() for _ in range(70)), "".join(r.choice("abcdefgh") for _ in range(9000))
    few, many = " ".join(word() for _ in range(44)), " ".join(word() for _ in range(90))
    pairs = [(long, long + " " + prose), (few, few + " " + many[:41]), (many, many + " " + few[:69]), (token, token[:8000] + " " + prose)]
    df = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)], "doc_id long, text string")
    got = {x.doc_id: x.near_next for x in fingerprint.digest_query(df).collect()}
    assert all(got[2 * i] > 0.4 for i in range(len(pairs))), got


def test_ranges_of_identifiers(spark, monkeypatch):
    """Equal identifiers in bulk, and more ranges than rows."""
    rows = [(7, f"t{i}") for i in range(300)] + [(9, "a b c"), (None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 1)
    got = fingerprint.with_next(df, ["text"]).collect()
    follows = {r.text: r.next_text for r in got}
    at, seen = "n", []
    for _ in rows:
        seen.append(at)
        at = follows[at]
    assert at == "n" and len(set(seen)) == len(rows) and seen[-1] == "a b c"


def test_likeness_falls_with_edits():
    """Over random texts, the likeness estimates what all pairs of k-mers give, and does so without a bias for long texts."""
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]
    for n in (60, 600):
        got = []
        for _ in range(60):
            a = [r.choice(vocabulary) for _ in range(n)]
            b = a[: n - n // 4] + [r.choice(vocabulary) for _ in range(n // 4)]
            x, y = codes(" ".join(a)), codes(" ".join(b))
            got.append(sum(p == q for p, q in zip(x, y)) / len(x))
        assert 0.28 < sum(got) / len(got) < 0.46, n  # 0.6 squared, the share of pairs of k-mers that both have
