"""Personal data: regular expressions propose spans, validators confirm them, context words adjust the score.

All is SQL expressions. Positions come from splitting a text at its matches: the lengths of the pieces and matches
before a match add up to its start, by running totals in doubling steps. Surroundings are cut from blocks of the text, and base spans
that an added one may touch are found by binary search, so time grows with the text and, but for a logarithm, with its matches.
The base kinds keep every confirmed match; added kinds must also reach `threshold`. A context word counts as a whole word
within `REACH` characters before or after a match.

Defined results: null text is empty and has no spans; positions count code points, the end is exclusive; spans of different
kinds may overlap (an added span that touches a base span is dropped); repeated rows each get their result; very long
texts are searched whole in time that grows with their length, as no pattern backtracks over what it has read;
an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """plain: the pattern's definition. pattern: the same matches without backtracking. check: SQL over the match t. score, and with
    `words` the bonus if one of them stands near. border: a class of characters that must not touch a match."""

    name: str
    plain: str
    pattern: str
    check: str
    score: float
    words: str = ""
    bonus: float = 0.0
    needs: str = ""  # a string without which there is no match
    border: str = ""


LUHN = (
    "length({d}) between 14 and 19 and aggregate(sequence(1, length({d})), 0L, (a, i) -> a + if((length({d}) - i) % 2 = 1, "
    "(cast(substr({d}, i, 1) as int) * 2) % 10 + cast(substr({d}, i, 1) as int) * 2 div 10, cast(substr({d}, i, 1) as int))) % 10 = 0"
)
DIGITS = "regexp_replace(t, '[^0-9]', '')"
MOD97 = (
    "length({c}) between 15 and 34 and aggregate(sequence(1, length({c})), 0, (a, i) -> if(ascii(substr({r}, i, 1)) >= 65, "
    "(a * 100 + ascii(substr({r}, i, 1)) - 55) % 97, (a * 10 + ascii(substr({r}, i, 1)) - 48) % 97)) = 1"
)
COMPACT = "replace(t, ' ', '')"
ROTATED = f"concat(substr({COMPACT}, 5), substr({COMPACT}, 1, 4))"

MAIL, HOST, CARD, CALL = r"e-?mails?|mails?|mailto|contact|write", "ip|hosts?|servers?|address|addr", "cards?|visa|credit|karte|carte", "tel|telephone|telefon|phone|mobile|cell|call|fax|fon"
#: In the order in which spans of one start are listed.
BASE = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 0.9, MAIL, 0.1, "@"),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"forall(split(t, r'\.'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(p, 9)) as int) <= 255)", 0.6, HOST, 0.3, "."),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])", LUHN.format(d=DIGITS), 0.8, CARD, 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) between 10 and 15", 0.7, CALL, 0.3, "+"),
)
ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", MOD97.format(c=COMPACT, r=ROTATED), 0.9, "iban|account|konto|compte|cuenta", 0.1, border="[A-Za-z0-9]"),
    Kind("card_run", r"[0-9]+", r"(?<![0-9])[0-9]{14,19}(?![0-9])", LUHN.format(d=DIGITS), 0.7, CARD, 0.2),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "true", 0.3, "ssn|social security", 0.5, "-", border="[0-9]"),
    Kind("national_phone", r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}", r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}", "true", 0.3, CALL, 0.4, border="[0-9]"),
)
KINDS = (*BASE, *ADDED)
REACH, BLOCK = 40, 512
THRESHOLD = 0.6
PLACES = "array<struct<start:int,end:int,t:string>>"
SPANS = "array<struct<start:int,end:int,k:int,kind:string,score:double>>"


def _running(a: str, op: str) -> str:
    """SQL: the running totals of the array a (not empty) under op, an expression of u and v; as many steps as its size has bits."""
    step = "transform(a, (u, i) -> if(i >= shiftleft(1, b), transform(array(a[i - shiftleft(1, b)]), v -> {op})[0], u))".format(op=op)
    return f"aggregate(sequence(0, length(bin(size({a}))) - 1), {a}, (a, b) -> {step})"


def _matches(x: str, kind: Kind) -> str:
    """SQL: array of (start, end, t) of the confirmed matches in the SQL string x, in order."""
    rx, let = f"r'{kind.pattern}'", lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    ends = let("w", "transform(m, (t, i) -> length(p[i]) + length(t))", _running("w", "u + v"))
    located = let("p", f"split({x}, {rx}, -1)", let("e", ends, "transform(m, (t, i) -> named_struct('start', e[i] - length(t), 'end', e[i], 't', t))"))
    guard = f"contains({x}, '{kind.needs}') and " if kind.needs else ""
    # A list of one match list, or of none: what follows runs only on texts with matches.
    listed = f"filter(if({guard}rlike({x}, {rx}), array(regexp_extract_all({x}, {rx}, 0)), array()), m -> size(m) > 0)"
    good = f"filter({located}, s -> transform(array(s.t), t -> {kind.check})[0])"
    return f"coalesce(flatten(transform({listed}, m -> {good})), cast(array() as {PLACES}))"


def _cut(a: str, b: str) -> str:
    """SQL: characters a to b of the text, from its blocks."""
    return f"substr(array_join(slice(__blocks, ({a}) div {BLOCK} + 1, ({b}) div {BLOCK} - ({a}) div {BLOCK} + 1), ''), ({a}) % {BLOCK} + 1, ({b}) - ({a}))"


def _scored(places: str, k: int, kind: Kind) -> str:
    """SQL: array of (start, end, k, kind, score) of the matches `places` that nothing forbidden touches."""
    score = f"{kind.score}D"
    if kind.words:
        # One character more on each side only tells whether a word goes on there.
        near = (
            f"concat(if(s.start <= {REACH}, ' ', ''), {_cut(f'greatest(s.start - {REACH + 1}, 0)', 's.start')}, ' ', "
            f"{_cut('s.end', f'least(s.end + {REACH + 1}, __length)')}, if(s.end + {REACH} >= __length, ' ', ''))"
        )
        score = rf"if(rlike(lower({near}), r'[^\p{{L}}](?:{kind.words})[^\p{{L}}]'), {kind.score + kind.bonus:.1f}D, {kind.score}D)"
    if kind.border:
        touch = f"concat({_cut('greatest(s.start - 1, 0)', 's.start')}, {_cut('s.end', 'least(s.end + 1, __length)')})"
        places = f"filter({places}, s -> not rlike({touch}, '{kind.border}'))"
    return f"transform({places}, s -> named_struct('start', s.start, 'end', s.end, 'k', {k}, 'kind', '{kind.name}', 'score', {score}))"


def _touches(places: str) -> str:
    """SQL: whether one of the sorted, disjoint spans overlaps s; the last that starts before s ends is found by bisection."""
    last = f"aggregate(sequence(length(bin(size({places}))) - 1, 0, -1), 0, (o, b) -> if(o + shiftleft(1, b) <= size({places}) and {places}[o + shiftleft(1, b) - 1].start < s.end, o + shiftleft(1, b), o))"
    return f"(size({places}) > 0 and transform(array({last}), o -> o > 0 and {places}[greatest(o - 1, 0)].end > s.start)[0])"


def _found(docs: DataFrame, text: str, to: str, threshold: float) -> DataFrame:
    """docs with `to` and the working columns __blocks and __length of the texts that have matches."""
    d = docs.withColumn("__x", F.coalesce(F.col(text), F.lit("")))
    for i, kind in enumerate(KINDS):
        d = d.withColumn(f"__m{i}", F.expr(_matches("__x", kind)))
    d = d.withColumn("__some", F.expr(" or ".join(f"size(__m{i}) > 0" for i in range(len(KINDS)))))
    d = d.withColumns({"__blocks": F.expr(f"if(__some, regexp_extract_all(__x, '(?s).{{1,{BLOCK}}}', 0), cast(array() as array<string>))"), "__length": F.expr("if(__some, length(__x), 0)")})
    base = ", ".join(_scored(f"__m{i}", i, k) for i, k in enumerate(BASE))
    added = "concat(" + ", ".join(_scored(f"__m{i}", i, k) for i, k in enumerate(KINDS) if i >= len(BASE)) + ")"
    free = f"filter({added}, s -> s.score >= {threshold}D and not ({' or '.join(_touches(f'__m{i}') for i in range(len(BASE)))}))"
    order = "(a, b) -> case when a.start <> b.start then a.start - b.start when a.k <> b.k then a.k - b.k else a.end - b.end end"
    d = d.withColumn(to, F.expr(f"if(__some, array_sort(concat({base}, {free}), {order}), cast(array() as {SPANS}))"))
    return d.drop("__x", "__some", *[f"__m{i}" for i in range(len(KINDS))])


def find(docs: DataFrame, text: str = "text", to: str = "spans", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the column `to`: array of struct(start, end, k, kind, score) by start, then kind as listed."""
    return _found(docs, text, to, threshold).drop("__blocks", "__length")


def digest_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of docs (doc_id, text)."""
    said = lambda a: f"array_join(transform({a}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    count = [f"cast(size(filter(found, s -> s.kind = '{k.name}')) as bigint) as n_{k.name}" for k in BASE]
    found = find(docs.select("doc_id", "text"), to="found")
    return found.selectExpr("doc_id", *count, f"sha2({said(f'filter(found, s -> s.k < {len(BASE)})')}, 256) as base_sha256", f"{said('found')} as spans")


def redact(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with each found span replaced by its kind in brackets; of overlapping spans the first names the whole stretch. Null stays null."""
    d = _found(docs, text, "__found", threshold).withColumn("__any", F.expr("size(__found) > 0"))
    d = d.withColumn("__ends", F.expr(f"if(__any, {_running('transform(__found, s -> s.end)', 'greatest(u, v)')}, array())"))
    # A stretch begins where no span before reaches to.
    d = d.withColumn("__at", F.expr("if(__any, filter(sequence(0, size(__found) - 1), i -> i = 0 or __found[i].start >= __ends[greatest(i - 1, 0)]), array())"))
    end = "__ends[coalesce(get(__at, j + 1), size(__found)) - 1]"
    before = "if(j = 0, 0, __ends[greatest(i, 1) - 1])"
    pieces = f"transform(__at, (i, j) -> concat({_cut(before, '__found[i].start')}, '[', upper(__found[i].kind), ']', if(j = size(__at) - 1, {_cut(end, '__length')}, '')))"
    out = d.withColumn(text, F.expr(f"if(__any, array_join({pieces}, ''), `{text}`)"))
    return out.drop("__found", "__any", "__ends", "__at", "__blocks", "__length")


def oracle() -> str:
    """The query in DuckDB, with the plain patterns and SQL of its own."""
    luhn = """(length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 1
      THEN (CASE WHEN substr(d, i, 1)::INT > 4 THEN 2 * substr(d, i, 1)::INT - 9 ELSE 2 * substr(d, i, 1)::INT END) ELSE substr(d, i, 1)::INT END)) % 10 = 0)"""
    iban = """(length(c) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(range(1, length(c) + 1), lambda i: ascii(substr(substr(c, 5) || substr(c, 1, 4), i, 1)))),
      lambda a, b: CASE WHEN b >= 65 THEN (a * 100 + b - 55) % 97 ELSE (a * 10 + b - 48) % 97 END) = 1)"""
    checks = {"email": "true", "ip": "len(list_filter(string_split(t, '.'), lambda p: p::HUGEINT > 255)) = 0", "card": luhn, "phone": "length(d) BETWEEN 10 AND 15", "iban": iban, "card_run": luhn, "ssn": "true", "national_phone": "true"}
    parts = []
    for i, k in enumerate((*BASE, *ADDED)):
        near = f"CASE WHEN s <= {REACH} THEN ' ' ELSE '' END || x[greatest(s - {REACH + 1}, 0) + 1 : s] || ' ' || x[e + 1 : e + {REACH + 1}] || CASE WHEN e + {REACH} >= length(x) THEN ' ' ELSE '' END"
        score = f"CASE WHEN regexp_matches(lower({near}), '[^\\p{{L}}](?:{k.words})[^\\p{{L}}]') THEN {k.score + k.bonus:.1f} ELSE {k.score} END" if k.words else f"{k.score}"
        apart = f" AND NOT regexp_matches(CASE WHEN s > 0 THEN substr(x, s, 1) ELSE '' END || substr(x, e + 1, 1), '{k.border}')" if k.border else ""
        parts.append(f"""SELECT doc, x, s, e, {i} AS k, '{k.name}' AS kind, {score} AS score FROM (SELECT doc, x, t, s, s + length(t) AS e, regexp_replace(t, '[^0-9]', '', 'g') AS d, replace(t, ' ', '') AS c
          FROM (SELECT doc, x, m[i] AS t, (list_sum(list_transform(p[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(m[1:i-1], lambda z: length(z))), 0))::BIGINT AS s
            FROM (SELECT doc, x, m, p, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc, x, regexp_extract_all(x, '{k.plain}') AS m, string_split_regex(x, '{k.plain}') AS p FROM t)))) WHERE {checks[k.name]}{apart}""")
    return f"""
WITH t AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS x FROM documents),
f AS ({' UNION ALL '.join(parts)}),
b AS (SELECT * FROM f WHERE k < {len(BASE)}),
g AS (SELECT * FROM b UNION ALL SELECT * FROM f WHERE k >= {len(BASE)} AND score >= {THRESHOLD} AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc = f.doc AND b.s < f.e AND f.s < b.e)),
a AS (SELECT doc, {', '.join(f"count(*) FILTER (WHERE kind = '{k.name}') AS n_{k.name}" for k in BASE)},
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (WHERE k < {len(BASE)}) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans FROM g GROUP BY doc)
SELECT t.doc_id, {', '.join(f'coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a ON a.doc = t.doc
"""
