"""State and history from change logs, whatever the order of delivery."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.workspace import kept
from .conform import ranked_first

KEY = "intervention_id"
ACTIVE = ("open", "contacted", "in_progress", "deferred")


def audit(log: DataFrame) -> DataFrame:
    """Each change image once: of repeated deliveries the one that arrived last (of equal arrivals the largest image)."""
    keys = [KEY, "change_type", "lsn", "sort_by"]
    rest = [c for c in log.columns if c not in keys]
    best = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("delivered_at", *[c for c in rest if c != "delivered_at"])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*log.columns)


def current(log: DataFrame) -> DataFrame:
    """The last image of each key that carries state; a key whose last image is a delete is gone until it is inserted again."""
    rows = audit(log).where("change_type <> 'update_preimage'")
    return ranked_first(rows, [KEY], [F.desc("lsn"), F.desc("sort_by"), F.desc("change_type")]).where("change_type <> 'delete'")


def event_history(log: DataFrame) -> DataFrame:
    """One insert image for each event_id, the first in the log: events don't change afterwards."""
    return ranked_first(log.where("change_type = 'insert'"), ["event_id"], [F.asc("lsn"), F.asc("sort_by"), F.desc("delivered_at")])


def events_with_owner(events: DataFrame, log: DataFrame, columns: list[str]) -> DataFrame:
    """events with columns of the latest image of their key, deleted or not."""
    identity = ranked_first(audit(log), [KEY], [F.desc("lsn"), F.desc("sort_by"), F.desc("change_type")]).select(KEY, *columns)
    return events.join(identity, KEY)


def summary(current_rows: DataFrame, events: DataFrame, now: dt.datetime) -> DataFrame:
    """One row for each entity: status and priority of its foremost case, first time, follow-ups due and completed.

    A case that isn't closed stands before closed ones, then the latest update, version, lsn and sort_by decide.
    A follow-up is due if an open case's next_follow_up_at has come; it is completed if one
    case has both been scheduled for one and closed. The foremost case is a max over a struct, so no entity's cases are sorted in one task.
    """
    flag = lambda kind: F.max(F.when(F.col("event_type") == kind, 1).otherwise(0))
    flags = events.groupBy(KEY).agg(flag("follow_up_scheduled").alias("_scheduled"), flag("closed").alias("_closed"))
    cases = current_rows.join(flags, KEY, "left").fillna(0, ["_scheduled", "_closed"])
    open_ = F.col("status") != "closed"
    order = F.struct(F.when(open_, 1).otherwise(0), F.col("updated_at"), F.col("version"), F.col("lsn"), F.col("sort_by"))
    due = open_ & (F.col("next_follow_up_at") <= F.lit(now).cast("timestamp_ntz"))
    return cases.groupBy("entity_id").agg(
        F.max_by("status", order).alias("intervention_status"), F.max_by("priority", order).alias("intervention_priority"), F.min("created_at").alias("first_intervention_at"),
        F.coalesce(F.bool_or(due), F.lit(False)).alias("follow_up_due"), F.bool_or((F.col("_scheduled") == 1) & (F.col("_closed") == 1)).alias("follow_up_completed"))


#: Entities that share keys are folded together in one ordered stream up to so many commands in all; beyond, by rounds.
TOGETHER = 1_000_000
ORDER = ["action", "idempotency_key", "expected_version", "event_type", "new_status", "outcome", "at"]


def fold_commands(commands: DataFrame, together: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Results of create and transition commands, and the events they append, in the order of seq.

    commands: seq, entity_id, action (create or transition), idempotency_key, expected_version, event_type, new_status, outcome, at.
    A key that was used before by a command that applied, to whatever entity, is replayed with the version it made then (of equal seq the smaller entity
    comes first). A create starts version 1 as open; a transition applies if expected_version is the current one, else it is a conflict and
    changes nothing. outcome stays unless a new one is given; closed_at is set by closing and cleared by any other status.
    A create for an entity that exists and a transition for one that doesn't are conflicts.

    Commands of one entity depend on each other, so they are streamed in order through one task, which holds the entity's state and
    those of its keys that come again later. Entities none of whose keys another one uses are folded once, in parallel. The others hang on one another: up to `together`
    (TOGETHER) commands they are folded as one stream in the order of seq; beyond, each entity is folded by itself and told which commands an earlier one of another
    entity has made replays, and after the first fold only entities for which that changed are folded again. A command's answer depends on earlier ones
    alone, so this ends.
    """
    commands = commands.withColumn("seq", F.col("seq").cast("long"))
    keyed = commands.where("idempotency_key IS NOT NULL").groupBy("idempotency_key").agg(F.min("entity_id").alias("_a"), F.max("entity_id").alias("_b"), F.max(F.col("entity_id").isNull().cast("int")).alias("_n"))
    several = keyed.where("_a <> _b OR (_a IS NOT NULL AND _n = 1)").select("idempotency_key")
    bound = kept(commands.join(several, "idempotency_key", "left_semi").select("entity_id").distinct().withColumn("_hangs", F.lit(True)))
    if bound.isEmpty():
        return _results(_folded(commands, ["entity_id"]))
    marked = kept(commands.join(bound.withColumnRenamed("entity_id", "_e"), F.col("entity_id").eqNullSafe(F.col("_e")), "left").drop("_e"))
    free, hanging = _folded(marked.where("_hangs IS NULL").drop("_hangs"), ["entity_id"]), marked.where("_hangs").drop("_hangs")
    together = TOGETHER if together is None else together
    if hanging.limit(together + 1).count() <= together:
        return _results(free.unionByName(_folded(hanging, [])))
    return _results(free.unionByName(_settled(hanging, several)))


def _settled(commands: DataFrame, several: DataFrame) -> DataFrame:
    """The fold of entities that hang on one another, by rounds; each folds only the entities whose told replays changed."""
    crossing = kept(commands.join(several, "idempotency_key", "left_semi").select("entity_id", "idempotency_key", "seq").distinct())
    place, id_ = F.struct("seq", "entity_id"), ["entity_id", "idempotency_key", "seq"]
    told = crossing.select(*id_, F.lit(None).cast("int").alias("_told")).limit(0)
    rounds, used, changed, todo = [], None, [], commands
    while True:
        on = [todo[c].eqNullSafe(told[c]) for c in id_]
        rounds.append(kept(_folded(todo.join(told, on[0] & on[1] & on[2], "left").select(todo["*"], "_told"), ["entity_id"])))
        new_used = rounds[-1].where("result = 'applied'").join(several, "idempotency_key", "left_semi").select(*id_, "version")
        if used is not None:  # those of entities that were folded again are replaced
            now = changed[-1].withColumnRenamed("entity_id", "_e")
            new_used = used.join(now, F.col("entity_id").eqNullSafe(F.col("_e")), "left_anti").unionByName(new_used)
        used = kept(new_used)
        first = used.groupBy("idempotency_key").agg(F.min_by(F.struct("seq", "entity_id", "version"), place).alias("_w"))
        new = kept(crossing.join(first, "idempotency_key").where(~F.col("entity_id").eqNullSafe(F.col("_w.entity_id")) & (place > F.struct("_w.seq", "_w.entity_id"))).select(*id_, F.col("_w.version").alias("_told")))
        differ = kept(new.exceptAll(told).unionByName(told.exceptAll(new)).select("entity_id").distinct())
        if differ.isEmpty():
            break
        changed.append(differ)
        todo, told = commands.join(differ.withColumnRenamed("entity_id", "_e"), F.col("entity_id").eqNullSafe(F.col("_e")), "left_semi"), new
    last = None
    for k, df in enumerate(changed, 1):
        last = df.withColumn("_k", F.lit(k)) if last is None else last.unionByName(df.withColumn("_k", F.lit(k)))
    if last is None:
        return rounds[0]
    last = last.groupBy(F.col("entity_id").alias("_e")).agg(F.max("_k").alias("_last"))
    all_ = None
    for k, df in enumerate(rounds):
        all_ = df.withColumn("_k", F.lit(k)) if all_ is None else all_.unionByName(df.withColumn("_k", F.lit(k)))
    return all_.join(last, F.col("entity_id").eqNullSafe(F.col("_e")), "left").where(F.col("_k") == F.coalesce("_last", F.lit(0))).drop("_k", "_e", "_last")


def _results(folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    events = folded.where("result = 'applied'").select("entity_id", "seq", "event_type", "prior_status", F.col("status").alias("new_status"), "idempotency_key", F.col("version").alias("result_version"), "at")
    return folded.select("entity_id", "seq", "result", "version", "status", "outcome", "closed_at"), events


def _folded(commands: DataFrame, by: list[str]) -> DataFrame:
    """Every command with its result, folded entity by entity (by is entity_id) or as one stream (by is empty); _told is the version of another entity that makes it a replay."""
    kinds = ("string", "string", "int", "string", "string", "string", "timestamp_ntz")
    told = F.col("_told") if "_told" in commands.columns else F.lit(None).cast("int").alias("_told")
    steps = commands.select("entity_id", F.col("seq").cast("bigint").alias("seq"), *[F.col(c).cast(k).alias(c) for c, k in zip(ORDER, kinds)], told)
    order = ["seq", *([] if by else ["entity_id"]), *ORDER]
    again = F.lead(F.lit(True), 1, False).over(W.partitionBy(*by, "idempotency_key").orderBy(*order))
    steps = steps.withColumn("again", F.col("idempotency_key").isNotNull() & again)
    steps = (steps.repartition(*by) if by else steps.coalesce(1)).sortWithinPartitions(*by, *order, F.desc("again"))
    result = "seq bigint, result string, version int, prior_status string, status string, outcome string, closed_at timestamp_ntz, idempotency_key string, event_type string, at timestamp_ntz"
    schema = T.StructType([steps.schema["entity_id"], *T.StructType.fromDDL(result).fields])
    types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.timestamp("us"), pa.string(), pa.string(), pa.timestamp("us")]
    alone = bool(by)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, used, here, new_one = {}, {}, object(), (0, None, None, None)
        for batch in batches:
            rows, own = [], [c.cast(pa.int64()) if n == "at" else c for n, c in zip(batch.schema.names, batch.columns)]
            for who, seq, action, key, expected, event, new, said, at, told, comes_again in zip(*(c.to_pylist() for c in own)):
                if alone and who != here:
                    states, used, here = {}, {}, who
                version, status, outcome, closed = states.get(who, new_one)
                create, prior, seen = action == "create", status, used.get(key) if told is None else told
                applied = seen is None and (version == 0 if create else version > 0 and version == expected)
                if applied:
                    version, status, outcome = version + 1, "open" if create else new, outcome if said is None else said
                    closed = at if status == "closed" else None
                    states[who] = (version, status, outcome, closed)
                    if comes_again:
                        used[key] = version
                elif seen is not None and not comes_again:
                    used.pop(key, None)
                rows.append((seq, "applied" if applied else "conflict" if seen is None else "replayed", version if seen is None else seen, prior, status, outcome, closed, key, "created" if create else event, at))
            if rows:
                columns = [pa.array(c, pa.int64()).cast(t) if pa.types.is_timestamp(t) else pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return steps.mapInArrow(fold, schema)
