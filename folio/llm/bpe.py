"""BPE encoding and decoding with batched numpy merge rounds.

The distinct new words of a batch lie in one flat symbol array. In each round every pair of neighbours
in a word is looked up by binary search over the sorted pair keys; each word then merges all places of
its lowest-ranked pair, left to right, until no word has a known pair. As every merge of the vocabulary
makes a token of its own, whose later merges rank higher, this equals merging one pair at a time.
Long words also merge, in the same round, each place that ranks lowest among those within `reach` (the bytes
of the longest token) of it: a merge of lower rank from farther off would have to make a longer token to get there.

Decoding looks the tokens of all ids of a batch up in one table and joins them, text by text.

Defined results: null text counts as empty and has 0 tokens; a text of any length, and a word of any length, is
encoded whole; equal texts have equal ids; an empty table gives an empty table; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import common

# Fixed values of the tokenizer's file format: what `\s` stands for inside a class, and the mark of a word's end.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
END = "</w>"
#: A worker keeps the ids of words of so many bytes, with what a word takes beside its letters.
CACHE_BYTES, PER_WORD = 64 << 20, 200


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def load(vocab_path: str) -> dict:
    """The tables that encoding needs, small enough to ship: sorted pair keys with rank and product, tokens, specials, the words' pattern."""
    with open(vocab_path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
    if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["decoder"] or spec["model"]["end_of_word_suffix"] != END:
        raise ValueError(f"{vocab_path}: not a word-level BPE of this format")
    vocab, n = spec["model"]["vocab"], len(spec["model"]["vocab"])
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    keys = np.array([vocab[a] * n + vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    tokens = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for s, i in vocab.items():
        tokens[i] = s
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for s, i in special.items():
        tokens[i] = s
    chars = byte_chars()
    return {
        "pattern": spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", WHITE), "reach": max(len(x.removesuffix(END)) for x in vocab),
        "n": n, "keys": keys[order], "rank": order.astype(np.int64), "made": made[order], "tokens": tokens, "special": special,
        "inner": np.array([vocab[c] for c in chars], np.int64), "last": np.array([vocab[c + END] for c in chars], np.int64),
    }


def _least_near(rank: np.ndarray, reach: int) -> np.ndarray:
    """The least of rank[i - reach : i + reach + 1] for each i."""
    pad = np.full(reach, np.iinfo(np.int64).max)
    m, size, width = np.concatenate([pad, rank, pad]), 1, 2 * reach + 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(rank)], m[width - size : width - size + len(rank)])


def merge_rounds(symbols: np.ndarray, word: np.ndarray, t: dict) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word of each) after all merges. Words that have no known pair left leave the working set."""
    done_s, done_w = [], []
    none = np.int64(len(t["keys"]))
    while len(symbols):
        same = word[1:] == word[:-1]
        key = symbols[:-1] * t["n"] + symbols[1:]
        at = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        rank = np.where(same & (t["keys"][at] == key), t["rank"][at], none)
        rank, at = np.append(rank, none), np.append(at, 0)
        starts = np.flatnonzero(np.append(True, ~same))
        best = np.minimum.reduceat(rank, starts)
        length = np.diff(np.append(starts, len(symbols)))
        best = np.repeat(best, length)
        ready = best == none
        if ready.any():
            done_s.append(symbols[ready])
            done_w.append(word[ready])
        # Neighbouring places of one rank overlap (equal symbols): of such a run every second one merges, from the left, if all of it may.
        begun = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        run = np.diff(np.append(begun, len(rank)))
        hit = rank == best
        if length.max() > 4 * t["reach"]:  # else hardly a place more
            near = np.logical_and.reduceat(hit | (rank <= _least_near(rank, t["reach"] + 1)), begun)
            hit |= np.repeat(near, run)
        hit &= (rank < none) & ((np.arange(len(rank)) - np.repeat(begun, run)) % 2 == 0)
        symbols = np.where(hit, t["made"][at], symbols)
        keep = ~ready & ~np.append(False, hit[:-1])
        symbols, word = symbols[keep], word[keep]
    if not done_s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, w = np.concatenate(done_s), np.concatenate(done_w)
    order = np.argsort(w, kind="stable")
    return s[order], w[order]


def encode_words(words: list[str], t: dict) -> list[np.ndarray]:
    """The ids of each word."""
    raw = [w.encode("utf-8") for w in words]
    size = np.array([len(b) for b in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    symbols = t["inner"][flat]
    ends = np.cumsum(size) - 1
    symbols[ends] = t["last"][flat[ends]]
    s, w = merge_rounds(symbols, np.repeat(np.arange(len(words)), size), t)
    return np.split(s.astype("<u4"), np.flatnonzero(np.diff(w)) + 1)


class Codec:
    """Encodes whole texts; keeps the ids of the words it has met, up to CACHE_BYTES."""

    def __init__(self, t: dict):
        self.t, self.words, self.held, self.find = t, {}, 0, regex.compile(t["pattern"]).findall
        self.apart = regex.compile("(" + "|".join(map(regex.escape, t["special"])) + ")").split if t["special"] else None
        self.tokens = pa.array(t["tokens"], pa.large_string())

    def split(self, text: str) -> list[str]:
        """The words of a text; a special token stands as itself, and no word that the pattern finds can equal it."""
        if self.apart and "<|" in text:
            return [x for i, part in enumerate(self.apart(text)) for x in ([part] if i % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letters are lowered one by one
        return self.find(text.lower())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        split = [self.split(x or "") for x in texts]
        if self.held > CACHE_BYTES:
            self.words, self.held = {}, 0
        if not self.words:
            self.words |= {s: np.array([i], "<u4").tobytes() for s, i in self.t["special"].items()}
        known = self.words
        if new := list({w for ws in split for w in ws}.difference(known)):
            for w, ids in zip(new, encode_words(new, self.t)):
                known[w] = ids.tobytes()
                self.held += len(w) + PER_WORD
        return [b"".join([known[w] for w in ws]) for ws in split]

    def decode(self, ids: list[bytes]) -> pa.Array:
        """The text of each: the file names no decoder, so tokens are joined by spaces."""
        off = np.cumsum([0, *(len(x) // 4 for x in ids)])
        tokens = self.tokens.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(off, pa.int32()), tokens), pa.scalar(" ", pa.large_string()))


def _codec(shipped) -> Codec:
    cache = common.worker_cache()
    if ("bpe", shipped.id) not in cache:
        cache[("bpe", shipped.id)] = Codec(shipped.value)
    return cache[("bpe", shipped.id)]


class _Shipped:
    """Tables as a broadcast (its size is that of the vocabulary), with a key for the worker's cache."""

    def __init__(self, spark, t: dict, key: str):
        self.b, self.id = spark.sparkContext.broadcast(t), key

    @property
    def value(self) -> dict:
        return self.b.value


def _sha256(values: Iterator[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(x).hexdigest() for x in values], pa.string())


def encode(docs: DataFrame, vocab_path: str, text: str = "text", digests: bool = False) -> DataFrame:
    """docs' columns (text itself only if digests is False) with n_tokens and ids (binary, little-endian
    unsigned 32-bit) or, with digests, n_tokens, ids_sha256 and decoded_sha256 (of the ids decoded).

    Only the text goes through Python. A column of docs that has the name of a new one is replaced.
    """
    shipped = _Shipped(docs.sparkSession, load(vocab_path), f"{vocab_path}")
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids binary"
    names = [x.split()[0] for x in new.split(", ")]
    types = [pa.int64(), pa.string(), pa.string()] if digests else [pa.int64(), pa.binary()]
    kept = [c for c in docs.columns if c not in names and not (digests and c == text)]

    @F.arrow_udf(f"struct<{new.replace(' ', ':').replace(',:', ', ')}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.settle()
        codec = _codec(shipped)
        for whole in batches:
            parts = [pa.StructArray.from_arrays([pa.nulls(0, t) for t in types], names=names)]
            for b in common.slices(pa.RecordBatch.from_arrays([whole], names=["t"]), "t"):
                ids = codec.encode(b.column(0).to_pylist())
                out = [pa.array([len(x) // 4 for x in ids], pa.int64())]
                if digests:
                    out += [_sha256(ids), _sha256(x.as_buffer() for x in codec.decode(ids))]
                else:
                    out.append(pa.array(ids, pa.binary()))
                parts.append(pa.StructArray.from_arrays(out, names=names))
            yield pa.concat_arrays(parts)
        common.trim()

    made = docs.select(*kept, run(F.col(text)).alias("__made"))
    return made.select(*kept, *[F.col(f"__made.{n}").alias(n) for n in names])
