"""BPE against the tokenizers library, on odd texts and on the smallest documents."""

import hashlib
import random
import time

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
from tokenizers import Tokenizer

from folio.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \n\t", "a", "Hello, World's it'll DON'T", "aaaaaaaaaaaaaaaa" * 300, "x<|endoftext|>y <|startoftext|>", "<|endoftext", "ΑΣ ΣΑΣ. İstanbul ǅ",
    "é café b\x85c\x1cd", "日本語 ١٢٣ ½ 12,345.67", "🙂🙂👨‍👩‍👧 !!??..", "''s'S \"'re", "﻿abc​def", "ẞß ﬁ", "no " * 5000,
]


def test_equals_library(spark):
    texts = ODD + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    lib = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode(df, PATH, digests=True).collect()}
    full = {r.doc_id: r for r in bpe.encode(df, PATH).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert bytes(full[i].ids) == raw and full[i].text == t, t
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest(), t


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(df, PATH, digests=True).collect() == []


def test_long_words_equal_library():
    r = random.Random(4)
    prose = "".join(pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:40])
    joined = "".join(c for c in prose.lower() if c.isalpha())[:30_000]
    texts = [joined, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "".join(r.choice("ab") for _ in range(9_000)), "abcab" * 3_000, "a" * 9_001, "!" * 5_001 + "?!" * 900, "é🙂" * 2_000, "日本" * 3_000]
    lib, codec = Tokenizer.from_file(PATH), bpe.Codec(bpe.load(PATH))
    for t, got in zip(texts, codec.encode(texts)):
        want = lib.encode(t, add_special_tokens=False).ids
        assert got == np.array(want, "<u4").tobytes(), t[:40]
        assert codec.decode([got, b""]).to_pylist() == [lib.decode(want, skip_special_tokens=False), ""]


def test_a_very_long_word_takes_no_square_time():
    r = random.Random(5)
    word = "".join(r.choice("etaoinshrdlu") for _ in range(200_000))
    codec, start = bpe.Codec(bpe.load(PATH)), time.perf_counter()
    (ids,) = codec.encode([word])
    assert "".join(codec.decode([ids]).to_pylist()[0].split(" ")) == word + bpe.END
    assert time.perf_counter() - start < 10


def test_words_beyond_the_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 50)
    lib, codec = Tokenizer.from_file(PATH), bpe.Codec(bpe.load(PATH))
    for i in range(20):
        t = f"word{'x' * i} is <|endoftext|> again"
        assert codec.encode([t, None])[0] == np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() and codec.held < 2000
