"""Structured log records: queries, redaction, thinning, quality.

Records have ts (milliseconds or timestamp), level, logger, message, code, run_id, phase and a map of extras.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as T

MUST_HAVE_CODE = ("WARNING", "ERROR", "CRITICAL")


def query(records: DataFrame, level: str | None = None, code: str | None = None, phase: str | None = None, run_id: str | None = None) -> DataFrame:
    """Records that agree with all that is given; levels compare without case."""
    if level is not None:
        records = records.where(F.upper(F.coalesce("level", F.lit(""))) == level.upper())
    for name, value in (("code", code), ("phase", phase), ("run_id", run_id)):
        if value is not None:
            records = records.where(F.coalesce(F.col(name), F.lit("")) == value)
    return records


def code_histogram(records: DataFrame, prefix: str = "VL-") -> DataFrame:
    return records.where(F.col("code").startswith(prefix)).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def quality(records: DataFrame, least_context: float = 0.9) -> DataFrame:
    """One row: how many records, the share with run_id and phase, how many warnings and errors lack a code, and whether that passes."""
    there = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    r = records.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(there("run_id") & there("phase")).alias("with_context"), F.count_if(F.upper("level").isin(*MUST_HAVE_CODE) & ~there("code")).alias("without_code")
    )
    ratio = F.col("with_context") / F.col("total")
    return r.withColumn("passed", (F.col("total") == 0) | ((ratio >= least_context) & (F.col("without_code") == 0)))


def with_context(records: DataFrame, context: dict[str, str]) -> DataFrame:
    """Absent or missing fields from the context."""
    return records.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in records.columns else F.lit(v) for k, v in context.items()})


def redacted(records: DataFrame, salt: str = "") -> DataFrame:
    """Every string column, and hashed keys of any type, by the rules of its name."""
    return records.withColumns({f.name: T.redact_value(f.name, F.col(f.name), salt) for f in records.schema if f.dataType.simpleString() == "string" or f.name in ("user_id", "file_id")})


def every_nth(records: DataFrame, n: int, order: list[str], within: list[str] | None = None, span: float = 3600.0) -> DataFrame:
    """Every n-th record in order (the first column of it a time or a number), within each of the groups.

    Groups are cut into buckets of `span` of order[0]; counts of the buckets before give each its first number, so no group is sorted as a whole. Spans that hold many
    records are for the caller to shorten."""
    within = within or []
    kind = records.schema[order[0]].dataType.typeName()
    at = F.unix_micros(F.col(order[0]).cast("timestamp")) / 1e6 if kind.startswith(("timestamp", "date")) else F.col(order[0]).cast("double")
    x = records.withColumn("__b", F.coalesce(F.floor(at / span), F.lit(-(2**62))))
    x = x.withColumns({f"__k{i}": F.col(c) for i, c in enumerate(within)})
    keys = [f"__k{i}" for i in range(len(within))]
    counts = x.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("__b").alias("__br"), before.alias("__before"))
    same = F.col("__b") == F.col("__br")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}r"))
    own = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order))
    return x.withColumn("__i", own).join(counts, same).where((F.col("__i") + F.col("__before")) % max(1, n) == 0).select(*records.columns)


#: Seconds of a bucket of a key's time, at least.
SPAN = 3600.0


def _opened(times: np.ndarray, width: int, touching: bool) -> np.ndarray:
    """For each of the sorted times the first row that lies past the window it opens, else the number of rows."""
    return np.searchsorted(times, times + width, "left" if touching else "right")


def _windows(records: DataFrame, width: float, most: int, keys: list[str], seconds: Column, order: list[str], touching: bool, span: float | None) -> DataFrame:
    """The first `most` records of each window of a key. A window opens with its first record, the next one with the first record more than (`touching`: at least) `width` seconds later; records without time stay.

    Where windows open depends on all earlier ones, but only through one number: the time up to which the last one reaches. So each key's time is cut into buckets that are
    dealt out apart. A bucket first tells what it would hand on for each time that could reach into it (few rows: windows soon agree, wherever the first one
    opened); these are followed from bucket to bucket; then each bucket, knowing what reaches into it, marks its records as a stream. A steady key is spread over its buckets, and no task holds more than a bucket's times."""
    us = int(round(width * 1e6))
    span = int((span or max(SPAN, 8 * width)) * 1e6)
    x = records.withColumns({"__t": F.round(seconds * 1e6).cast("long"), "__k": F.to_json(F.struct(*keys)) if keys else F.lit("")})
    timed = x.where("__t is not null").withColumn("__b", F.expr(f"cast(floor(__t / {span}) as bigint)")).repartition("__k", "__b")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bucket rows (k, b, upto, reach, n): if what reaches into it lies before `upto` (and not before that of the row before), it hands on `reach` and the n records of its last window; upto null: it holds no more than n records of the window before."""
        now, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            t = np.concatenate(held)
            step = _opened(t, us, touching)
            last = np.where(step < len(t), step, np.arange(len(t)))
            while not np.array_equal(further := last[last], last):
                last = further
            # What reaches in lies before the bucket's start and one window more.
            first = np.unique(t[: np.searchsorted(t, now[1] * span + us, "right") + 1], return_index=True)[1]
            change = np.append(np.flatnonzero(np.diff(last[first])), len(first) - 1)
            upto, reach, n = t[first][change], t[last[first][change]] + us, len(t) - last[first][change]
            rows = len(change) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * rows, pa.string()), pa.array([now[1]] * rows, pa.int64()), pa.array([*upto.tolist(), None], pa.int64()), pa.array([*reach.tolist(), None], pa.int64()), pa.array([*n.tolist(), len(t)], pa.int64())], names=["__k", "__b", "upto", "reach", "n"]
            )

        for batch in batches:
            for key, part in _runs(batch, 2):
                if key != now:
                    yield from close()
                    now, held = key, []
                held.append(np.array(part.column(2), np.int64))
        yield from close()

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(k, b, reach, n) of what reaches into each bucket of a key, and how many records of that window came before it; buckets in order."""
        now, state, after = None, None, None
        for batch in batches:
            keys_, buckets, reaches, counts = [], [], [], []
            for k, b, upto, reach, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, b) != now:
                    state = after if now and now[0] == k else (None, 0)
                    now, done = (k, b), False
                    keys_, buckets, reaches, counts = keys_ + [k], buckets + [b], reaches + [state[0]], counts + [state[1]]
                if done:
                    continue
                if upto is None:
                    after, done = (state[0], state[1] + n), True
                elif state[0] is None or (state[0] <= upto if touching else state[0] < upto):
                    after, done = (reach, n), True
            yield pa.RecordBatch.from_arrays([pa.array(keys_, pa.string()), pa.array(buckets, pa.int64()), pa.array(reaches, pa.int64()), pa.array(counts, pa.int64())], names=["__k", "__b", "__reach", "__n"])

    times = timed.select("__k", "__b", "__t").sortWithinPartitions("__k", "__b", "__t").mapInArrow(told, "__k string, __b long, upto long, reach long, n long")
    chain = times.repartition("__k").sortWithinPartitions("__k", "__b", F.col("upto").asc_nulls_last()).mapInArrow(followed, "__k string, __b long, __reach long, __n long")
    names = records.columns

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reach, n = None, None, 0
        for batch in batches:
            keep = []
            for key, part in _runs(batch, 2):
                t = np.array(part.column(2), np.int64)
                if key != now:
                    now = key
                    reach, n = (part.column(i)[0].as_py() for i in (3, 4))
                nth, at = np.empty(len(t), np.int64), 0
                # Records of the window that reaches in, then one window after the other.
                while at < len(t):
                    to = max(at, int(np.searchsorted(t, reach, "left" if touching else "right"))) if reach is not None else 0
                    nth[at:to] = n + np.arange(to - at)
                    n, at = n + to - at, to
                    if at < len(t):
                        reach, n = int(t[at]) + us, 0
                        nth[at] = 0
                        n, at = 1, at + 1
                keep.append(nth < most)
            if keep:
                got = batch.filter(pa.array(np.concatenate(keep)))
                yield pa.RecordBatch.from_arrays(got.columns[5:], names=names)

    y = timed.join(chain, ["__k", "__b"]).sortWithinPartitions("__k", "__b", "__t", *order)
    done = y.select("__k", "__b", "__t", "__reach", "__n", *names).mapInArrow(marked, records.schema)
    return done.unionByName(x.where("__t is null").select(*names))


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(values of the first `keys` columns, rows) of each run of rows that agree in them."""
    if not batch.num_rows:
        return
    change = np.zeros(batch.num_rows - 1, bool)
    for i in range(keys):
        c = batch.column(i)
        change |= np.array(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).fill_null(True), bool)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        yield tuple(batch.column(i)[lo].as_py() for i in range(keys)), batch.slice(lo, hi - lo)


def drop_repeats(records: DataFrame, ttl: float, keys: list[str], seconds: Column, order: list[str], span: float | None = None) -> DataFrame:
    """Drops a record if less than ttl seconds have passed since the last *kept* one of its key."""
    return _windows(records, ttl, 1, keys, seconds, order, True, span)


def limit_rate(records: DataFrame, window: float, most: int, keys: list[str], seconds: Column, order: list[str], span: float | None = None) -> DataFrame:
    """Keeps `most` records per window; a window opens with its first record, the next one once more than `window` seconds have passed."""
    return _windows(records, window, most, keys, seconds, order, False, span)


# What each handler does with a record, in order; the least level it takes; the loggers that have to say more; and the filters' settings (seconds, records).
HANDLERS = {"console": ("context", "redaction", "duplicate", "sampling", "ratelimit"), "json_file": ("context", "redaction", "duplicate"), "json_file_daily": ("context", "redaction", "duplicate")}
LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}
LEAST, QUIET = "INFO", {"uvicorn.access": "WARNING", "PIL": "WARNING", "pdfminer": "WARNING"}
TTL, EVERY, WINDOW, MOST = 2.0, 10, 10.0, 50


def admitted(records: DataFrame) -> DataFrame:
    """Records of the least level, and of the level that their logger asks for."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[x for n, v in LEVELS.items() for x in (F.lit(n), F.lit(v))]), F.upper("level")), F.lit(0))
    least = F.coalesce(F.try_element_at(F.create_map(*[x for n, v in QUIET.items() for x in (F.lit(n), F.lit(LEVELS[v]))]), F.col("logger")), F.lit(0))
    return records.where((rank >= LEVELS[LEAST]) & (rank >= least))


def handled(
    records: DataFrame, handler: str, seconds: Column, order: list[str], context: dict[str, str] | None = None, salt: str = "", ttl: float = TTL, every: int = EVERY, window: float = WINDOW, most: int = MOST
) -> DataFrame:
    """What a handler writes of records (level, logger, message, code and more), which have `order` (its first column a time): those of its level and of their logger's, with the context, redacted, and
    thinned by its filters one after the other. A filter sees only what the ones before it let through; duplicates are told by logger, level, message and code, samples and rates by the handler's whole stream."""
    x = admitted(records).withColumn("__at", seconds)
    for name in HANDLERS[handler]:
        if name == "context":
            x = with_context(x, context or {})
        elif name == "redaction":
            x = redacted(x, salt)
        elif name == "duplicate":
            x = drop_repeats(x, ttl, ["logger", "level", "message", "code"], F.col("__at"), order)
        elif name == "sampling":
            x = every_nth(x, every, order)
        else:
            x = limit_rate(x, window, most, [], F.col("__at"), order)
    return x.drop("__at")


def latest(files: DataFrame, by: str = "modificationTime", path: str = "path", group: list[str] | None = None) -> DataFrame:
    """The path of the newest file of each group."""
    return files.groupBy(*(group or [])).agg(F.max_by(path, by).alias("path"))


def valid_record(records: DataFrame) -> DataFrame:
    """Records with a level, a logger and a message."""
    return records.where(" and ".join(f"coalesce({c}, '') <> ''" for c in ("level", "logger", "message")))


def select(records: DataFrame, equal: dict | None = None, unequal: dict | None = None, like: dict | None = None, unlike: dict | None = None) -> DataFrame:
    """Records whose labels (an absent one is empty) agree with all matchers: =, !=, =~ and !~."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    for given, test in ((equal, lambda c, v: value(c) == v), (unequal, lambda c, v: value(c) != v), (like, lambda c, v: matches(value(c), v)), (unlike, lambda c, v: ~matches(value(c), v))):
        for c, v in (given or {}).items():
            records = records.where(test(c, v))
    return records


def lines_with(records: DataFrame, pattern: str, column: str = "message") -> DataFrame:
    """A line filter: the pattern occurs in the line."""
    return records.where(F.col(column).rlike(pattern))


def count_over_time(records: DataFrame, width: str, labels: list[str], ts: str = "ts") -> DataFrame:
    return records.groupBy(F.window(ts, width)["start"].alias("start"), *labels).agg(F.count(F.lit(1)).alias("n"))


def matches(column: Column, pattern: str, insensitive: bool = False) -> Column:
    """A label matcher: the pattern must cover the whole value."""
    return column.rlike(f"{'(?i)' if insensitive else ''}^(?:{pattern})$")


