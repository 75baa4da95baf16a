"""Document fingerprints by Order MinHash.

A text's units are its words, in pieces of at most PIECE characters from the word's start; letters of scripts that are written without
blanks are units of their own. The k-mers (pairs of neighbouring units) are numbered by occurrence, so that repeated ones differ. For each of SKETCH seeds
the TUPLE least of all numbered k-mers under the seed's order are selected, put in the order in which they stand in the text, and hashed together.
Two texts agree in an entry if they share the selected k-mers in the same order, so the share of agreeing entries falls with edits, also with moves.

A seed is a hash function and a turn: k-mers are ordered by (hash - turn) modulo the range of hashes. For a random hash each k-mer is the least with the
same chance, as any hash function gives it. RINGS hash functions with SKETCH / RINGS turns each thus cost one sort per function: with the turns
sorted among the hashes, the k-mers of a seed are those that follow its turn, around the ring.

All is SQL functions over arrays: positions and hashes are packed into longs, so that sorting is on plain numbers.

Defined results: null text is empty; an empty text has the fingerprint '' and is like empty texts only (1, else 0); a text of blanks only is one unit; a text of a single
unit has one k-mer, in all entries; equal texts have equal fingerprints; rows of one doc_id follow each other by a hash of their text; a null doc_id comes first; a single
document is its own next one; an empty table gives an empty table; very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH, RINGS, TUPLE, PIECE = 32, 4, 2, 12
#: Bits of a packed long that hold a position, from 1 (0: a turn).
PLACE = 28
#: Ranges of identifiers hold about so many bytes of text; there are at most so many.
LEAST_RANGES, RANGE_BYTES, MOST_RANGES = 2048, 64 << 20, 1 << 17
# Blocks of scripts written without blanks (Thai to Tibetan, Myanmar, Khmer, East Asian).
UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
UNIT = rf"[{UNSPACED}]|[^\s{UNSPACED}]{{1,{PIECE}}}"


def with_codes(df: DataFrame, text: str, to: str) -> DataFrame:
    """df with the column `to`: the SKETCH entries (0 to 65535) of the text; an empty array for an empty one.

    Each step is a column of its own, so that sorts run on plain arrays of longs."""
    mask, top, turns = (1 << PLACE) - 1, -(1 << PLACE), SKETCH // RINGS
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    d = df.withColumn("__u", F.expr(f"if(rlike({text}, r'\\S'), regexp_extract_all({text}, r'{UNIT}', 0), if({text} = '', array(), array({text})))"))
    d = d.withColumn("__k", F.expr(f"sort_array(transform(__u, (w, i) -> (xxhash64(w, get(__u, i + 1)) & {top}L) | (i + 1)))"))
    # Equal k-mers are neighbours now, in text order: s holds where each kind starts, m is how many of its kind come before one.
    starts = f"filter(sequence(0, size(__k) - 1), i -> i = 0 or shiftright(__k[greatest(i - 1, 0)], {PLACE}) <> shiftright(__k[i], {PLACE}))"
    d = d.withColumn("__s", F.expr(f"if(size(__k) = 0, array(), {starts})"))
    nth = f"transform(slice(__k, o + 1, coalesce(get(__s, j + 1), size(__k)) - o), (p, m) -> (xxhash64(p & {top}L, m) & {top}L) | (p & {mask}L))"
    alone = f"(xxhash64(__k[o] & {top}L, 0) & {top}L) | (__k[o] & {mask}L)"
    numbered = f"if(size(__s) = size(__k), transform(__s, o -> {alone}), flatten(transform(__s, (o, j) -> {nth})))"
    d = d.withColumn("__n", F.expr(numbered))
    rings = []
    for ring in range(RINGS):
        marks = ", ".join(f"{(2 * j + 1) * (1 << 62) // turns - (1 << 63) + (j << 60) // turns & top}L" for j in range(turns))
        hashed = "__n" if ring == 0 else f"transform(__n, q -> (xxhash64(q & {top}L, {ring}) & {top}L) | (q & {mask}L))"
        d = d.withColumn(f"__r{ring}", F.expr(f"sort_array(concat({hashed}, array({marks})))"))
        # Where the turns lie; the k-mer of rank p among k-mers is p places on, and one more for each turn before it.
        d = d.withColumn(f"__t{ring}", F.expr(f"filter(sequence(0, size(__r{ring}) - 1), i -> (__r{ring}[i] & {mask}L) = 0)"))
        at = lambda p: let("p", f"({p}) % size(__n)", f"__r{ring}[p + size(filter(__t{ring}, (v, z) -> v - z <= p))]")  # noqa: E731, B023
        chosen = "array_sort(array(" + ", ".join(at(f"i - j + {c}") for c in range(TUPLE)) + f"), (a, b) -> cast(sign((a & {mask}L) - (b & {mask}L)) as int))"
        ids = ", ".join(f"c[{i}] & {top}L" for i in range(TUPLE))
        entry = let("c", chosen, f"cast(xxhash64({ids}, {ring}, j) & 65535 as int)")
        rings.append(f"transform(__t{ring}, (i, j) -> {entry})")
    d = d.withColumn(to, F.expr(f"if(size(__n) = 0, cast(array() as array<int>), concat({', '.join(rings)}))"))
    return d.drop("__u", "__k", "__s", "__n", *[f"__{x}{r}" for x in "rt" for r in range(RINGS)])


def as_text(c: str) -> str:
    return f"array_join(transform({c}, v -> lpad(lower(hex(v)), 4, '0')), '')"


def likeness(a: str, b: str) -> str:
    """SQL: the share of equal entries, 0 to 1."""
    return f"case when size({a}) = 0 or size({b}) = 0 then if(size({a}) = size({b}), 1D, 0D) else aggregate(zip_with({a}, {b}, (p, q) -> if(p = q, 1, 0)), 0, (t, v) -> t + v) / {SKETCH}D end"


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", prefix: str = "next_") -> DataFrame:
    """docs with the values of `columns` of the next document by key (of the first after the last).

    The key's quantiles cut the rows into ranges, more of them the more bytes the first column holds, each a group of one window. The first row of a range also goes to the range
    before it (that of the first range to the last), so no row needs another group."""
    k = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    least, size = docs.select(k.alias("k"), F.octet_length(columns[0]).alias("n")).agg(F.min("k"), F.sum("n")).first()
    if least is None:
        return docs.select("*", *[F.col(c).alias(prefix + c) for c in columns])
    ranges = min(max(LEAST_RANGES, (size or 0) // RANGE_BYTES), MOST_RANGES)
    cuts = docs.select(k.alias("k")).agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    bounds = sorted({least, *cuts})
    held = docs.withColumns({"__k": k, "__bounds": F.lit(bounds)})
    steps = len(bounds).bit_length()
    held = held.withColumn(
        "__r", F.expr(f"aggregate(sequence({steps}, 0, -1), 0, (o, b) -> if(o + shiftleft(1, b) <= {len(bounds)} and get(__bounds, o + shiftleft(1, b) - 1) <= __k, o + shiftleft(1, b), o)) - 1")
    )
    # (range, 0 for its own rows, 1 for the row that follows them)
    again = F.expr(f"array(struct(if(__r = 0, {len(bounds) - 1}, __r - 1) as r, 1 as follows))")
    own = F.expr("array(struct(__r as r, 0 as follows))")
    dealt = held.withColumn("__to", F.explode(F.when(F.expr("get(__bounds, __r) = __k"), F.concat(own, again)).otherwise(own))).drop("__bounds")
    w = Window.partitionBy("__to.r").orderBy("__to.follows", "__k", *[F.xxhash64(*columns)], *columns)
    led = dealt.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in columns])
    return led.where("__to.follows = 0").drop("__k", "__r", "__to")


def digest_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of docs (doc_id, text)."""
    d = with_codes(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), "t", "c")
    d = with_next(d, ["t", "c"]).withColumn("n", F.length("t"))
    d = d.withColumn("x", F.expr("concat(substr(t, 1, cast(n - n div 4 as int)), substr(next_t, 1, cast(n div 4 as int)))")).drop("t", "next_t")
    d = with_codes(d.withColumn("sha", F.sha2("x", 256)), "x", "e")
    return d.selectExpr(
        "doc_id", "cast(n as bigint) as n_chars", "sha as edited_sha256", f"{as_text('c')} as fingerprint", f"{as_text('e')} as edited_fingerprint",
        f"{likeness('c', 'e')} as near_edited", f"{likeness('c', 'next_c')} as near_next",
    )
