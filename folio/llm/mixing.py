"""Mixing sources to target weights by Pfair scheduling.

Each source has whole tickets in proportion to its target weight, and its rows are cut into blocks. In an ideal
fluid mix sources advance at once, each at its tickets' share of those not yet used up. Block k of a source may not
start before the slot in which the fluid mix reaches it (release) and must be placed by the slot in which the fluid
mix is through with it (deadline); earliest-deadline-first keeps every prefix within less than one block of the fluid mix.

After each round, in which every source gets as many blocks as it has tickets (or all it has left), the fluid mix stands at
whole blocks. So rounds are scheduled independently, and all rounds between two changes (a source ending) share one pattern:
at most 2 * sources + 1 patterns of at most `resolution` + sources slots are computed, whatever the number of rows.

Everything is DataFrame operations. Rows are numbered within (source, hash bucket) and offset by the counts of
smaller buckets, so a source of a third of all rows is spread over BUCKETS groups.

Defined results: rows without source form a source of their own; rows of a source are in the order of the MD5 of their
identifier (then identifier, then other columns); repeated rows get places of their own; without weights, tickets follow the
row counts to the power `smoothing`; sources missing from given weights get one ticket; all rows are kept: when a source
ends the others go on in their proportion; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import operator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import common

BUCKETS = 4096
#: A schedule of at most so many slots is broadcast (12 bytes each); a larger one is joined.
MOST_BROADCAST_SLOTS = 2_000_000
BLOCK_ROWS, RESOLUTION, SMOOTHING = 16, 1000, 0.7


def _tickets(counts: DataFrame, weights: dict[str, float] | None, resolution: int, smoothing: float) -> DataFrame:
    """(s, n, tickets) of each source."""
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(smoothing))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit("s" + k), F.lit(float(v)))]
        share = F.coalesce(F.create_map(*pairs)[F.col("s")], F.lit(0.0)) if pairs else F.lit(0.0)
    one = counts.groupBy("s").agg(F.sum("n").alias("n")).withColumn("share", share)
    # As many rows as there are sources, in one list.
    listed = one.agg(F.collect_list(F.struct("s", "n", "share")).alias("all"), F.sum("share").alias("total"))
    each = listed.select(F.explode("all").alias("x"), "total").select("x.*", "total")
    scaled = F.round(resolution * F.col("share") / F.greatest("total", F.lit(1e-300)))
    return each.select("s", "n", F.greatest(F.lit(1), scaled.cast("long")).cast("long").alias("m"))


def schedule(tickets: DataFrame, block_rows: int) -> DataFrame:
    """One row per source: s, m, starts (first round of each pattern), base (slots before it), len (slots of one of its rounds), and for
    each pattern the slot, release and deadline of each of the source's blocks in a round."""
    one = tickets.selectExpr("s", "m", f"cast(ceil(n / {block_rows}) as bigint) as b")
    row = one.agg(F.array_sort(F.collect_list(F.struct("s", "m", "b"))).alias("src"))
    row = row.withColumn("rounds", F.expr("array_max(transform(src, x -> cast(ceil(x.b / x.m) as bigint)))"))
    row = row.withColumn(
        "starts",
        F.expr("array_sort(filter(array_distinct(concat(array(0L), flatten(transform(src, x -> array(x.b div x.m, x.b div x.m + 1))))), p -> p < rounds))"),
    )
    # A pattern: the blocks c that each source has in the round.
    p = row.select("src", F.explode("starts").alias("p")).withColumn(
        "act", F.expr("filter(transform(src, x -> named_struct('s', x.s, 'm', x.m, 'c', least(x.m, greatest(0L, x.b - p * x.m)))), x -> x.c > 0)")
    )
    p = p.withColumns(
        {
            "base": F.expr("aggregate(src, 0L, (a, x) -> a + least(x.m * p, x.b))"),
            "len": F.expr("aggregate(act, 0L, (a, x) -> a + x.c)"),
            # Where the fluid mix reaches block i of source x: the sum over sources of min(m * i / x.m, c), in whole numbers.
            "rel": F.expr("transform(act, x -> transform(sequence(0L, x.c - 1), i -> aggregate(act, 0L, (a, u) -> a + least(u.m * i, u.c * x.m)) div x.m))"),
            "due": F.expr(
                "transform(act, x -> transform(sequence(1L, x.c), i -> (aggregate(act, 0L, (a, u) -> a + least(u.m * i, u.c * x.m)) + x.m - 1) div x.m))"
            ),
        }
    )
    # Earliest deadline first: slot by slot, of the sources whose next block is released, the one with the least deadline.
    pick = "array_min(transform(st.done, (k, j) -> if(k < act[j].c and rel[j][k] <= t, named_struct('due', due[j][k], 'j', j), null))).j"
    p = p.withColumn(
        "order",
        F.expr(f"""
        aggregate(sequence(0L, len - 1), named_struct('done', transform(act, x -> 0), 'out', cast(array() as array<int>)),
          (st, t) -> transform(array({pick}), w -> named_struct('done', transform(st.done, (k, j) -> if(j = w, k + 1, k)), 'out', concat(st.out, array(w))))[0]).out
        """),
    )
    slots = p.select(
        "p", "base", "len", F.posexplode("act").alias("j", "x"), "order", "rel", "due"
    ).selectExpr(
        "p", "base", "len", "x.s as s", "filter(transform(order, (w, t) -> if(w = j, t, null)), t -> t is not null) as slot", "rel[j] as rel", "due[j] as due"
    )
    each = slots.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("p", "base", "len", "slot", "rel", "due"))).alias("patterns"))
    return each.join(tickets.select("s", "m"), "s")


def interleave(
    docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION, smoothing: float = SMOOTHING, key: str = "doc_id", source: str = "source"
) -> DataFrame:
    """docs with __row (a hash of the row), __block (of its source, from 0), __release, __deadline (slots), __slot (of the block) and __position (ascending with the mix)."""
    s = F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))
    h = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    bucket = lambda h: F.conv(F.substring(h, 1, 3), 16, 10).cast("int")
    named = docs.withColumns({"__s": s, "__h": h, "__b": bucket(h), "__row": F.xxhash64(*docs.columns)})
    counts = common.materialize(named.select(F.col("__s").alias("s"), F.col("__b").alias("b")).groupBy("s", "b").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    before = counts.select("s", "b", F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    plan = common.materialize(schedule(_tickets(counts, weights, resolution, smoothing), block_rows), "mix-plan")
    size = plan.select(F.sum(F.expr("aggregate(patterns, 0, (a, x) -> a + size(x.slot))"))).first()[0] or 0
    plan = F.broadcast(plan) if size <= MOST_BROADCAST_SLOTS else plan
    w = Window.partitionBy("__s", "__b").orderBy("__h", key, "__row")
    ranked = named.withColumn("__n", F.row_number().over(w) - 1)
    ranked = ranked.join(before.withColumnsRenamed({"s": "__s", "b": "__b"}), ["__s", "__b"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__n")).withColumn("__block", F.expr(f"__rank div {block_rows}"))
    x = ranked.join(plan.withColumnsRenamed({"s": "__s", "m": "__m", "patterns": "__patterns"}), "__s")
    x = x.withColumn("__j", F.expr("__block div __m")).withColumn("__p", F.expr("element_at(filter(__patterns, q -> q.p <= __j), -1)"))
    start = "__p.base + (__j - __p.p) * __p.len + "
    i = "[cast(__block % __m as int)]"
    x = x.withColumns({"__slot": F.expr(f"{start} __p.slot{i}"), "__release": F.expr(f"{start} __p.rel{i}"), "__deadline": F.expr(f"{start} __p.due{i}")})
    x = x.withColumn("__position", F.expr(f"__slot * {block_rows} + __rank % {block_rows}"))
    return x.select(*docs.columns, "__row", "__block", "__release", "__deadline", "__slot", "__position")


def _dealt(
    docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION, smoothing: float = SMOOTHING, key: str = "doc_id", source: str = "source"
) -> DataFrame:
    """The rows of docs in the order of their mix, partition after partition, with __row (a hash of the row) and __at (number of the partition * 2**33 + place in it)."""
    mixed = interleave(docs, weights, block_rows, resolution, smoothing, key, source)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = docs.groupBy(source).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("n")).agg(F.sum("n")).first()[0] or 1
    dealt = mixed.repartitionById(n, F.expr(f"cast(__slot * {n} div {slots} as int)")).sortWithinPartitions("__position")
    return dealt.select(*docs.columns, "__row", F.monotonically_increasing_id().alias("__at"))


def _summary(placed: DataFrame) -> tuple[list[int], dict[str, int]]:
    """Of rows with __row and __at: the place at which each partition (or file) starts; the number of rows, and a hash of which row is at which place."""
    each = placed.groupBy(F.shiftright("__at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("__at", "__row")).alias("hash"))
    found = {r.part: r for r in each.collect() if r.part is not None}  # as many rows as partitions
    starts = [0]
    for k in range(max(found, default=0)):
        starts.append(starts[-1] + (found[k].n if k in found else 0))
    return starts, {"rows": sum(r.n for r in found.values()), "hash": functools.reduce(operator.xor, (r.hash for r in found.values()), 0)}


def in_order(docs: DataFrame, *args, key: str = "doc_id", **kw) -> DataFrame:
    """The rows of docs in the order of their mix (arguments as interleave() has them): partition after partition, each sorted. Written, the files hold the mix by number and row.
    The metadata of the key's column, which Parquet keeps, say how many rows there are and, by a hash, which is where; with_position() knows such files by them."""
    dealt = _dealt(docs, *args, key=key, **kw)
    _, mix = _summary(dealt)
    return dealt.select(*[F.col(c).alias(c, metadata={"mix": mix}) if c == key else F.col(c) for c in docs.columns])


def _as_filed(docs: DataFrame, key: str) -> tuple[DataFrame, list[int]] | None:
    """docs with __at and the starts of the files, if every row is in the file and at the place where in_order() had put it; else None."""
    mix = docs.schema[key].metadata.get("mix")
    if not mix:
        return None
    try:
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("long")
        placed = docs.select("*", (F.shiftleft(number, 33) + F.col("_metadata.row_index")).alias("__at"))
    except AnalysisException:  # not read from files
        return None
    starts, found = _summary(placed.select("__at", F.xxhash64(*docs.columns).alias("__row")))
    return (placed, starts) if found == mix else None


def with_position(docs: DataFrame, to: str = "position", key: str = "doc_id", **kw) -> DataFrame:
    """docs with the column `to`, the place (from 0) of each row in the mix. Rows that lie in files as in_order() gave them keep the places that it gave, whatever its weights;
    others, such as filtered, changed or rewritten ones, are mixed here."""
    if filed := _as_filed(docs, key):
        placed, starts = filed
    else:
        placed = _dealt(docs, key=key, **kw)
        starts, _ = _summary(placed)
    place = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), F.shiftright("__at", 33).cast("int") + 1) + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*[F.col(c).alias(c, metadata={}) if c == key else F.col(c) for c in docs.columns if c != to], place.alias(to))


ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('s' || source, 'n') AS s, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) - 1 AS rank FROM d),
c AS (SELECT s, count(*) AS n FROM r GROUP BY s),
m AS (SELECT s, ceil(n / {BLOCK_ROWS}.0)::BIGINT AS b, greatest(1, round({RESOLUTION} * pow(n::DOUBLE, {SMOOTHING}) / sum(pow(n::DOUBLE, {SMOOTHING})) OVER ()))::BIGINT AS m FROM c),
k AS (SELECT s, m, b, unnest(range(b)) AS k FROM m),
w AS (SELECT k.s, k.k, sum(least(u.m * k.k, u.b * k.m)) // k.m AS rel, (sum(least(u.m * (k.k + 1), u.b * k.m)) + k.m - 1) // k.m AS due
  FROM k CROSS JOIN m u GROUP BY k.s, k.k, k.m),
one AS (SELECT list(rels ORDER BY s) AS rels, list(dues ORDER BY s) AS dues, list(len(rels) ORDER BY s) AS n, list(s ORDER BY s) AS names
  FROM (SELECT s, list(rel ORDER BY k) AS rels, list(due ORDER BY k) AS dues FROM w GROUP BY s)),
e AS (SELECT -1::BIGINT AS t, list_transform(n, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS j FROM one
  UNION ALL
  SELECT t, list_transform(done, lambda x, i: x + CASE WHEN i = j THEN 1 ELSE 0 END), j FROM (
    SELECT e.t + 1 AS t, e.done, list_min(list_transform(list_filter(range(1, len(n) + 1), lambda j: e.done[j] < n[j] AND rels[j][e.done[j] + 1] <= e.t + 1),
      lambda j: dues[j][e.done[j] + 1] * 1000000 + j)) % 1000000 AS j
    FROM e CROSS JOIN one WHERE e.t + 1 < list_sum(n))),
z AS (SELECT names[j] AS s, row_number() OVER (PARTITION BY j ORDER BY t) - 1 AS k, t FROM e CROSS JOIN one WHERE t >= 0)
SELECT r.doc_id, r.source, z.k::BIGINT AS block, w.rel::BIGINT AS release, w.due::BIGINT AS deadline, z.t::BIGINT AS slot, (z.t * {BLOCK_ROWS} + r.rank % {BLOCK_ROWS})::BIGINT AS position
FROM r JOIN z ON z.s = r.s AND z.k = r.rank // {BLOCK_ROWS} JOIN w ON w.s = z.s AND w.k = z.k
"""
