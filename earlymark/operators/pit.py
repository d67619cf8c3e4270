"""Point-in-time features: what was known of an entity at each cutoff, and nothing later.

Events are first summed up by entity and by the cell of time between two window edges (the cutoffs and
the starts of their windows). That partial aggregate runs before any shuffle, so an entity with a third of
all events sends each task's cells and no more. An entity's cells and the marks of its cutoffs and window starts are then swept once in the order of
time: running sums and maxima at the marks, and differences of two running sums for the windows. So rows grow with cells + cutoffs,
not with their product. The distinct cutoffs are read by the driver: one for each run date.
"""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NO_ACTIVITY_DAYS = 999
#: More distinct cutoffs than this are a mistake: each is a run date.
MOST_CUTOFFS = 10_000


class Grid:
    """The cutoffs of the snapshots and the edges of their windows of so many days."""

    def __init__(self, snapshots: DataFrame, as_of: str, days: list[int]):
        rows = snapshots.select(as_of).where(F.col(as_of).isNotNull()).distinct().limit(MOST_CUTOFFS + 1).collect()
        if len(rows) > MOST_CUTOFFS:
            raise ValueError(f"more than {MOST_CUTOFFS} distinct cutoffs")
        self.cutoffs = sorted(r[0] for r in rows)
        self.edges = sorted({c - dt.timedelta(days=d) for c in self.cutoffs for d in [0, *days]})

    def with_cell(self, events: DataFrame, time: str) -> DataFrame:
        """events up to the last cutoff with _cell, the number of edges before their time: equal for times that all windows treat alike.

        A table of days tells how many edges lie before a day and which lie in it, so an event is compared with the edges of its own day alone,
        however many there are. It has a row for each day with an edge or after one, up to the last cutoff's; events before those are in cell 0.
        """
        events = events.where(F.col(time) <= self.last())
        if not self.edges:
            return events.withColumn("_cell", F.lit(0))
        first, last = self.edges[0].date(), self.edges[-1].date()
        inside: dict[dt.date, list[dt.datetime]] = {}
        for e in self.edges:
            inside.setdefault(e.date(), []).append(e)
        rows, before = [], 0
        for k in range((last - first).days + 1):
            day = first + dt.timedelta(days=k)
            rows.append((day, before, inside.get(day, [])))
            before += len(inside.get(day, []))
        days = events.sparkSession.createDataFrame(rows, "_day date, _before int, _edges array<timestamp_ntz>")
        met = events.join(F.broadcast(days), F.to_date(time) == F.col("_day"), "left")  # a row for each day between the first and the last edge
        cell = F.coalesce(F.col("_before") + F.size(F.filter("_edges", lambda e: e < F.col(time))), F.lit(0))
        return met.withColumn("_cell", cell).drop("_day", "_before", "_edges")

    def last(self) -> Column:
        return F.lit(self.cutoffs[-1]) if self.cutoffs else F.lit(None).cast("timestamp_ntz")

    def spans(self, spark, as_of: str, days: list[int]) -> DataFrame:
        """as_of, _to, _from<d>: the cells up to each cutoff, and the first cell of its window of d days."""
        rows = [(c, bisect.bisect_left(self.edges, c), *(bisect.bisect_left(self.edges, c - dt.timedelta(days=d)) + 1 for d in days)) for c in self.cutoffs]
        return spark.createDataFrame(rows, ", ".join([f"{as_of} timestamp_ntz", "_to int", *(f"_from{d} int" for d in days)]))


def swept(cells: DataFrame, marks: DataFrame, key: str, running: dict[str, Callable[[str], Column]]) -> DataFrame:
    """marks (key, _pos and own columns) with running aggregates, by name, over their key's cells at _pos or before.

    Cells and marks of a key are one sorted stream; each mark comes after the cells of its place.
    """
    own = [c for c in marks.columns if c not in (key, "_pos")]
    rows = cells.where(F.col(key).isNotNull()).withColumn("_mark", F.lit(False)).unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    upto = W.partitionBy(key).orderBy("_pos", "_mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.select(key, "_pos", "_mark", *own, *[f(name).over(upto).alias(name) for name, f in running.items()]).where("_mark").drop("_mark")


def at_cutoffs(snapshots: DataFrame, events: DataFrame, key: str, as_of: str, time: str, measures: dict[str, tuple[int | None, str, Column]]) -> DataFrame:
    """key, as_of and the measures of the events up to each cutoff: name -> (days back or None, "sum", "count", "max" or "latest", value).

    A window of d days is open at its start: (as_of - d days, as_of]. latest is the time of the last event whose value isn't null; max has no window. Nulls don't
    count; a measure without events is null. A windowed sum is the difference of two running sums, so sums of doubles are exact only for whole numbers.
    """
    if any(kind == "max" and d for d, kind, _ in measures.values()):
        raise ValueError("a maximum has no window")
    days = sorted({d for d, _, _ in measures.values() if d})
    grid = Grid(snapshots, as_of, days)
    own = {"sum": F.sum, "max": F.max, "latest": lambda v: F.max(F.when(v.isNotNull(), F.col(time))), "count": F.count}
    cells = grid.with_cell(events, time).groupBy(key, F.col("_cell").alias("_pos")).agg(*[own[kind](value).alias(name) for name, (_, kind, value) in measures.items()])
    base = snapshots.select(key, as_of).distinct().join(F.broadcast(grid.spans(snapshots.sparkSession, as_of, days)), as_of)  # at most MOST_CUTOFFS rows
    places = [F.struct(F.lit(0).alias("_back"), F.col("_to").alias("_pos")), *[F.struct(F.lit(d).alias("_back"), (F.col(f"_from{d}") - 1).alias("_pos")) for d in days]]
    marks = base.select(key, as_of, F.inline(F.array(*places)))
    added = [n for n, (_, kind, _) in measures.items() if kind in ("sum", "count")]
    cells = cells.withColumns({f"_n_{n}": F.when(F.col(n).isNotNull() & (F.col(n) != 0 if measures[n][1] == "count" else F.lit(True)), 1).otherwise(0) for n in added})
    at = swept(cells, marks, key, {n: (F.sum if n in added else F.max) for n in measures} | {f"_n_{n}": F.sum for n in added})
    pick = lambda c, d: F.max(F.when(F.col("_back") == d, F.col(c)))

    def value(name: str, d: int | None, kind: str) -> Column:
        if kind in ("max", "latest"):
            end = pick(name, 0)
            return end if not d else F.when(end > F.col(as_of) - F.expr(f"INTERVAL '{d}' DAY"), end)
        before = lambda c: F.coalesce(pick(c, d), F.lit(0)) if d else F.lit(0)
        return F.when(pick(f"_n_{name}", 0) > before(f"_n_{name}"), pick(name, 0) - before(name))

    return at.groupBy(key, as_of).agg(*[value(name, d, kind).alias(name) for name, (d, kind, _) in measures.items()])


def rate(snapshots: DataFrame, events: DataFrame, key: str, as_of: str, time: str, flag: Column, days: int = 28) -> DataFrame:
    """Share of the window's events with the flag (0 without events), and the latest of them."""
    got = at_cutoffs(snapshots, events, key, as_of, time, {"_sum": (days, "sum", flag.cast("double")), "_n": (days, "count", flag), "max_event_at": (days, "latest", F.col(time))})
    return got.select(key, as_of, F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).otherwise(0.0).alias(f"rate_{days}d"), "max_event_at")


def counts(snapshots: DataFrame, events: DataFrame, key: str, as_of: str, time: str, missed: Column, support: Column, active: Column) -> DataFrame:
    """Missed events in 28 days, support events in 90, days since the last activity (NO_ACTIVITY_DAYS if none), latest event."""
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    got = at_cutoffs(snapshots, events, key, as_of, time, {"missed_28d": (28, "sum", one(missed)), "support_90d": (90, "sum", one(support)), "_last": (None, "max", F.when(active, F.col(time))), "max_event_at": (None, "max", F.col(time))})
    return got.select(key, as_of, F.coalesce("missed_28d", F.lit(0)).alias("missed_28d"), F.coalesce("support_90d", F.lit(0)).alias("support_90d"), F.coalesce(F.datediff(F.to_date(as_of), F.to_date("_last")), F.lit(NO_ACTIVITY_DAYS)).cast("long").alias("days_since_activity"), "max_event_at")


def activity(snapshots: DataFrame, events: DataFrame, key: str, as_of: str, time: str, flag: Column, missed: Column, support: Column, active: Column) -> DataFrame:
    """rate and counts of the same events, in one pass over them."""
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    got = at_cutoffs(snapshots, events, key, as_of, time, {
        "_sum": (28, "sum", flag.cast("double")), "_n": (28, "count", flag), "missed_28d": (28, "sum", one(missed)), "support_90d": (90, "sum", one(support)),
        "_last": (None, "max", F.when(active, F.col(time))), "max_event_at": (None, "max", F.col(time))})
    return got.select(
        key, as_of, F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).otherwise(0.0).alias("rate_28d"), F.coalesce("missed_28d", F.lit(0)).alias("missed_28d"), F.coalesce("support_90d", F.lit(0)).alias("support_90d"),
        F.coalesce(F.datediff(F.to_date(as_of), F.to_date("_last")), F.lit(NO_ACTIVITY_DAYS)).cast("long").alias("days_since_activity"), "max_event_at")


def latest_state(snapshots: DataFrame, states: DataFrame, key: str, as_of: str, time: str, record: str, fields: dict[str, object]) -> DataFrame:
    """The fields of the latest state at each cutoff (ties go to the larger record id), with defaults, and its time."""
    got = at_cutoffs(snapshots, states, key, as_of, time, {"_s": (None, "max", F.struct(time, record, *fields))})
    return got.select(key, as_of, *[F.coalesce(F.col(f"_s.{c}"), F.lit(d)).alias(c) for c, d in fields.items()], F.col(f"_s.{time}").alias("max_event_at"))


def ranked_history(snapshots: DataFrame, rows: DataFrame, key: str, as_of: str, time: str, record: str, value: str, flag: Column) -> DataFrame:
    """current, prior_sum, trend (current less the one before), prior_flags and the latest time, at each cutoff.

    Rows rank by time and record id, latest first. In each cell only the two latest rows leave their task as rows (Spark limits the groups
    before the shuffle); the others count in sums.
    """
    grid = Grid(snapshots, as_of, [])
    cells = grid.with_cell(rows, time).select(key, time, record, F.col(value).alias("_v"), F.coalesce(flag, F.lit(False)).cast("long").alias("_f"), F.col("_cell").alias("_pos"))
    order = [F.desc(time), F.desc(record)]
    top = cells.withColumn("_r", F.row_number().over(W.partitionBy(key, "_pos").orderBy(*order))).where("_r <= 2")
    # the row before a cell's latest one is the second of the cell or the latest of the cell before it
    top = top.withColumn("_p", F.lag("_v").over(W.partitionBy(key).orderBy(time, record))).where("_r = 1").select(key, "_pos", F.struct(time, record, "_v", "_f", "_p").alias("_s"))
    sums = cells.groupBy(key, "_pos").agg(F.sum("_v").alias("_all"), F.sum("_f").alias("_flags"))
    base = snapshots.select(key, as_of).distinct().join(F.broadcast(grid.spans(snapshots.sparkSession, as_of, [])), as_of)
    marks = base.select(key, as_of, F.col("_to").alias("_pos"))
    at = swept(sums.unionByName(top, allowMissingColumns=True), marks, key, {"_all": F.sum, "_flags": F.sum, "_s": F.max})
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    v = F.col("_s._v")
    return at.select(
        key, as_of, zero(v).alias("current"), zero(F.col("_all") - zero(v)).alias("prior_sum"), zero(v - F.col("_s._p")).alias("trend"),
        F.coalesce(F.col("_flags") - F.col("_s._f"), F.lit(0)).alias("prior_flags"), F.col(f"_s.{time}").alias("max_event_at"))


def features(base: DataFrame, blocks: list[DataFrame], key: str, as_of: str) -> DataFrame:
    """base with all blocks of features of (key, as_of), and the latest event that any of them saw."""
    named = [b.withColumnRenamed("max_event_at", f"_m{i}") for i, b in enumerate(blocks)]
    joined = reduce(lambda a, b: a.join(b, [key, as_of], "left"), named, base)
    last = F.greatest(*[F.col(f"_m{i}") for i in range(len(blocks))]) if len(blocks) > 1 else F.col("_m0")
    return joined.withColumn("max_feature_event_at", last).drop(*[f"_m{i}" for i in range(len(blocks))])


def leaks(snapshots: DataFrame, as_of: str) -> DataFrame:
    """Snapshots that know of something later than their cutoff: there must be none."""
    return snapshots.where(F.col("max_feature_event_at") > F.col(as_of))


def entity_snapshots(entities: DataFrame, key: str, run_dates: DataFrame, run_date: str, as_of: str = "as_of") -> DataFrame:
    """Every entity at the end (23:59:59) of every run date; the run dates are few."""
    return entities.select(key).distinct().crossJoin(F.broadcast(run_dates.select(end_of_day(F.col(run_date)).alias(as_of)).distinct()))


def end_of_day(date: Column) -> Column:
    return F.concat(F.to_date(date).cast("string"), F.lit(" 23:59:59")).cast("timestamp_ntz")


def label_cutoff(census: Column) -> Column:
    """The last second before the day on which a label is observed."""
    return end_of_day(F.date_sub(census, 1))
