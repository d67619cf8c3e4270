"""Queries over feeds: quality, ingest, latest rows, orphans, point-in-time features and change logs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import SCHEMAS, Contract, contract
from ..operators import changelog, conform, daily, metrics, pit, quality
from ..operators.products import risk_tier
from ..sources import files, keyed
from ..sources.workspace import workspace
from ..streaming.ingest import EVENTS, SIDES, ExpectationFailed, Feed, conform_stream, ingest, ingest_all, side
from . import inputs as i


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.read(spark, sf_dir, "events").selectExpr(*i.DIRTY_EVENTS)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(dirty_events(spark, sf_dir), i.EVENTS, i.TODAY)


def quality_classify(spark, sf_dir):
    return classified(spark, sf_dir).groupBy(*quality.RULE_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))


def quality_split(spark, sf_dir):
    rows = classified(spark, sf_dir)
    tag = lambda name, df: df.select(F.lit(name).alias("side"), "event_key", "ts", "violation_reason")
    return tag("accepted", quality.accepted(rows)).unionByName(tag("quarantine", quality.quarantined(rows)))


def quality_reasons(spark, sf_dir):
    return quality.quarantined(classified(spark, sf_dir)).groupBy("violation_reason").agg(F.count(F.lit(1)).alias("row_count"))


def customer_balance_quality(spark, sf_dir):
    rows = i.read(spark, sf_dir, "customer").selectExpr("*", "TIMESTAMP_NTZ '2024-01-10 00:00:00' AS seen_at", "DATE '2024-01-30' AS run_date")
    return quality.classify(rows, i.CUSTOMERS, i.TODAY).select("c_custkey", *quality.RULE_COLUMNS)


def expectation_report(spark, sf_dir):
    return quality.expectation_report(dirty_events(spark, sf_dir), {"key_present": quality.present("event_key"), "time_present": F.col("ts").isNotNull(), "run_date_valid": F.col("run_date") <= F.lit(i.TODAY), "type_known": F.col("event_type") != "error"})


def constraint_violations(spark, sf_dir):
    log = i.read(spark, sf_dir, "events").selectExpr(*i.CHANGE_LOG)
    return quality.violations(log, "lsn", {"status_domain": F.col("status").isin("open", "contacted", "in_progress", "closed"), "version_positive": F.col("version") > 1, "closed_has_no_follow_up": (F.col("status") != "closed") | F.col("next_follow_up_at").isNull()})


def must_hold(spark, sf_dir):
    return quality.must_hold(i.read(spark, sf_dir, "orders"), "positive_total", F.col("o_totalprice") > 0).select("o_orderkey", "o_totalprice")


EVENT_FEED = Feed(i.EVENTS, "event_key string, ts timestamp_ntz, user_key string, event_type string, value double, run_date date")


def ingest_stream_replay(spark, sf_dir):
    """Streams the events files twice with one checkpoint: the second run adds nothing."""
    root = workspace(spark)
    dirty_events(spark, sf_dir).where(quality.present("event_key") & F.col("ts").isNotNull()).write.parquet(f"{root}/landed")
    for _ in range(2):
        ingest(spark, f"{root}/landed", EVENT_FEED, i.TODAY, f"{root}/out").awaitTermination()
    return _sides(spark, f"{root}/out")


def _sides(spark, root):
    sides = [side(spark, root, name, EVENT_FEED.schema).groupBy().agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("row_count"), F.count("_source_file").alias("with_source")) for name in SIDES]
    return sides[0].unionByName(sides[1])


def guarded_batch(spark, sf_dir):
    """After a good file, one with rows that break what must hold, twice: its batch leaves nothing, each time, and its sides stay those of the first file."""
    root, rows = workspace(spark), dirty_events(spark, sf_dir)
    good = quality.present("event_key") & F.col("ts").isNotNull()
    rows.where(good).where("value < 250").write.parquet(f"{root}/landed/a")
    for k in range(3):
        if k == 1:
            rows.where(~good | (F.col("value") >= 250)).write.parquet(f"{root}/landed/b")
        try:
            ingest(spark, f"{root}/landed", EVENT_FEED, i.TODAY, f"{root}/out").awaitTermination()
        except StreamingQueryException as e:
            if k == 0 or ExpectationFailed.__name__ not in str(e):
                raise
        else:
            if k:
                raise RuntimeError("a batch with broken rows was accepted")
    return _sides(spark, f"{root}/out")


def flowed(spark, sf_dir):
    """Lands the six feeds and runs them from one call; the folder of their outputs."""
    root, feeds = workspace(spark), {}
    for name, (source, columns) in i.FEEDS.items():
        rows = i.read(spark, sf_dir, source).selectExpr(*columns)
        rows.write.parquet(f"{root}/landed/{name}")
        feeds[name] = Feed(contract(name), SCHEMAS[name], ", ".join(f"{c} string" for c in rows.columns))
    ingest_all(spark, f"{root}/landed", feeds, i.TODAY, f"{root}/out")
    return f"{root}/out"


def feed_flow_counts(spark, sf_dir):
    root = flowed(spark, sf_dir)
    parts = [side(spark, f"{root}/{flow}", name, SCHEMAS[flow]).groupBy("violation_reason", F.col(files.RESCUED).isNotNull().alias("rescued")).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(flow).alias("flow"), F.lit(name).alias("side"), "violation_reason", "rescued", "row_count") for flow in i.FEEDS for name in SIDES]
    return reduce(DataFrame.unionByName, parts)


def flow_metrics(spark, sf_dir):
    """The event log of the six flows, which the passes that wrote their rows filled."""
    root = flowed(spark, sf_dir)
    log = reduce(DataFrame.unionByName, [spark.read.schema(EVENTS).parquet(f"{root}/{flow}/events") for flow in i.FEEDS])
    return log.groupBy("flow", "expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


DAY_FEED = Feed(Contract("events", "event_key", "ts", "user_key"), EVENT_FEED.schema)


def _day_stages(sf_dir, root):
    at = lambda day: pit.end_of_day(F.lit(day))

    def activity(spark, inputs, day):
        ingest(spark, f"{root}/landed", DAY_FEED, day, f"{root}/ingested").awaitTermination()
        rows = side(spark, f"{root}/ingested", "accepted", DAY_FEED.schema).where(F.col("ts") <= at(day))
        return rows.select(F.col("user_key").cast("long").alias("entity_id"), "ts", "event_type")

    def features(spark, inputs, day):
        kind = lambda t: F.col("event_type") == t
        snaps = inputs["entities"].select("entity_id", at(day).alias("as_of"))
        return pit.activity(snaps, inputs["activity"], *KEY, "ts", kind("purchase"), kind("error"), kind("click"), kind("view"))

    score = metrics.rule_score(F.col("rate_28d"), F.col("missed_28d"), F.lit(False), F.col("days_since_activity"), F.lit(0))
    return [
        daily.Stage("entities", lambda spark, inputs, day: i.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("program"))),
        daily.Stage("activity", activity),
        daily.Stage("features", features, ("entities", "activity")),
        daily.Stage("scores", lambda spark, inputs, day: inputs["features"].select(*KEY, score.alias("risk_score"), risk_tier(score).alias("risk_tier")), ("features",)),
        daily.Stage("caseload", lambda spark, inputs, day: inputs["scores"].where("risk_tier <> 'low'").join(inputs["entities"], "entity_id"), ("entities", "scores"))]


def daily_workflow(spark, sf_dir):
    """Two days from landed files to products. The second one stops after its features and goes on where it stopped; both are repeated, which changes nothing."""
    root = workspace(spark)
    stages, rows = _day_stages(sf_dir, root), i.read(spark, sf_dir, "events")
    for day, since, until, count in ((15, 0, 15, 5), (22, 15, 22, 3), (22, 0, 0, 5), (15, 0, 0, 5), (22, 0, 0, 5)):
        date = dt.date(2024, 1, day)
        if until:
            new = rows.where((F.dayofmonth("ts") > since) & (F.dayofmonth("ts") <= until))
            new.select(F.col("event_id").cast("string").alias("event_key"), "ts", F.col("user_id").cast("string").alias("user_key"), "event_type", "value", F.lit(date).alias("run_date")).write.parquet(f"{root}/landed/{day}")
        daily.run_day(spark, root, date, stages[:count])
    return daily.ledger(spark, root).select("run_date", "stage", "row_count")


def rescue_values(spark, sf_dir):
    raw = i.read(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 5 = 0 THEN event_type ELSE CAST(user_id AS STRING) END AS amount", "CASE WHEN event_id % 7 = 0 THEN 'x' || CAST(event_id AS STRING) END AS surplus")
    schema = T.StructType().add("event_id", "long").add("amount", "long")
    return files.rescue(raw, schema).select("event_id", "amount", F.get_json_object(files.RESCUED, "$.amount").alias("lost_amount"), F.get_json_object(files.RESCUED, "$.surplus").alias("surplus"), F.col(files.RESCUED).isNotNull().alias("rescued"))


def conform_stream_latest(spark, sf_dir):
    """Streams order lines whose order is known into a table of the latest row of each key, half of the files at a time."""
    root = workspace(spark)
    keys = ["l_orderkey", "l_linenumber"]
    lines = i.read(spark, sf_dir, "lineitem").select(*keys, *SEQUENCE)
    landed, buckets = i.parts(lines, 4), i.parts(lines, 8)
    lines.repartition(landed).write.parquet(f"{root}/landed")
    parents = i.read(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("l_orderkey"))
    source = files.stream(spark, f"{root}/landed", lines.schema, files_per_batch=-(-landed // 2))
    table = keyed.Keyed(f"{root}/table", tuple(keys), buckets=buckets)
    conform_stream(source, table, SEQUENCE, f"{root}/checkpoint", parents, "l_orderkey").awaitTermination()
    return keyed.read(spark, table)


SEQUENCE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def scd1_latest(spark, sf_dir):
    rows = i.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SEQUENCE)
    return conform.latest(rows, ["l_orderkey", "l_linenumber"], SEQUENCE)


def scd1_upsert(spark, sf_dir):
    """Two batches, the earlier half after the later one: the order of batches doesn't matter."""
    rows = i.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SEQUENCE)
    keys = ["l_orderkey", "l_linenumber"]
    late, early = rows.where("l_partkey % 2 = 0"), rows.where("l_partkey % 2 = 1")
    return conform.upserted(conform.latest(late, keys, SEQUENCE), early, keys, SEQUENCE)


def _children(spark, sf_dir):
    parent = i.read(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("entity_id"))
    return {"orders": (i.orders(spark, sf_dir), "o_orderkey"), "events": (i.events(spark, sf_dir), "event_id")}, parent


def orphan_quarantine(spark, sf_dir):
    return conform.orphans(*_children(spark, sf_dir), "entity_id")


def orphan_counts(spark, sf_dir):
    return conform.orphan_counts(*_children(spark, sf_dir), "entity_id")


def with_parent(spark, sf_dir):
    children, parent = _children(spark, sf_dir)
    return conform.with_parent(children["orders"][0], parent, "entity_id").select("entity_id", "o_orderkey")


def protected_latest(spark, sf_dir):
    return conform.protected_view(i.orders(spark, sf_dir), "entity_id", ["o_orderpriority", "o_orderstatus"], ["o_orderdate", "o_orderkey"])


def isolated_columns(spark, sf_dir):
    """The rows of customers without the protected columns, and the columns that a product may not have but these still have."""
    rows = conform.isolated(i.read(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])
    left = quality.forbidden_columns(rows, ["c_name", "c_acctbal", "c_mktsegment"]).agg(F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("forbidden"))
    return rows.crossJoin(F.broadcast(left))  # one row


KEY = ("entity_id", "as_of")


def rate_block(spark, sf_dir):
    return pit.rate(i.snapshots(spark, sf_dir), i.events(spark, sf_dir), *KEY, "ts", F.col("event_type") == "purchase")


def counts_block(spark, sf_dir):
    kind = lambda t: F.col("event_type") == t
    return pit.counts(i.snapshots(spark, sf_dir), i.events(spark, sf_dir), *KEY, "ts", kind("error"), kind("click"), kind("view"))


def activity_block(spark, sf_dir):
    kind = lambda t: F.col("event_type") == t
    return pit.activity(i.snapshots(spark, sf_dir), i.events(spark, sf_dir), *KEY, "ts", kind("purchase"), kind("error"), kind("click"), kind("view"))


def state_block(spark, sf_dir):
    return pit.latest_state(i.snapshots(spark, sf_dir), i.orders(spark, sf_dir), *KEY, "o_orderdate", "o_orderkey", {"o_orderstatus": "NONE", "o_orderpriority": "NONE"})


def history_block(spark, sf_dir):
    return pit.ranked_history(i.snapshots(spark, sf_dir), i.orders(spark, sf_dir), *KEY, "o_orderdate", "o_orderkey", "o_totalprice", F.col("o_orderstatus") == "F")


def pit_rate_28d(spark, sf_dir):
    return i.round_columns(rate_block(spark, sf_dir), ["rate_28d"])


def pit_ranked_history(spark, sf_dir):
    return i.round_columns(history_block(spark, sf_dir), ["current", "prior_sum", "trend"])


def all_features(spark, sf_dir):
    base = i.snapshots(spark, sf_dir).join(i.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("program")), "entity_id")
    return pit.features(base, [b(spark, sf_dir) for b in (activity_block, state_block, history_block)], *KEY)


def pit_features(spark, sf_dir):
    return i.round_columns(all_features(spark, sf_dir), ["rate_28d", "current", "prior_sum", "trend"])


def leakage_audit(spark, sf_dir):
    return pit.leaks(all_features(spark, sf_dir), "as_of").agg(F.count(F.lit(1)).alias("leaks"))


def label_cutoffs(spark, sf_dir):
    return i.read(spark, sf_dir, "orders").select("o_orderkey", pit.label_cutoff(F.col("o_orderdate")).alias("as_of"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def entity_snapshots(spark, sf_dir):
    days = i.read(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).unionByName(i.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))).distinct()
    return pit.entity_snapshots(i.read(spark, sf_dir, "supplier"), "s_suppkey", days, "d")


def cdc_audit(spark, sf_dir):
    return changelog.audit(i.change_log(spark, sf_dir))


def cdc_current(spark, sf_dir):
    return changelog.current(i.change_log(spark, sf_dir))


def cdc_events(spark, sf_dir):
    return changelog.event_history(i.event_log(spark, sf_dir))


def cdc_event_owners(spark, sf_dir):
    return changelog.events_with_owner(cdc_events(spark, sf_dir).select("event_id", "intervention_id", "event_type"), i.change_log(spark, sf_dir), ["entity_id", "priority"])


def cdc_summary(spark, sf_dir):
    return changelog.summary(cdc_current(spark, sf_dir), cdc_events(spark, sf_dir), i.NOW)


def command_fold(spark, sf_dir):
    return changelog.fold_commands(i.read(spark, sf_dir, "events").selectExpr(*i.COMMANDS))[0]


def command_events(spark, sf_dir):
    return changelog.fold_commands(i.read(spark, sf_dir, "events").selectExpr(*i.COMMANDS))[1]


QUERIES = {f.__name__: f for f in (
    quality_classify, quality_split, quality_reasons, customer_balance_quality, expectation_report, constraint_violations, must_hold, ingest_stream_replay, guarded_batch, feed_flow_counts, flow_metrics, daily_workflow, conform_stream_latest, rescue_values, scd1_latest, scd1_upsert, orphan_quarantine, orphan_counts,
    with_parent, protected_latest, isolated_columns, pit_rate_28d, pit_ranked_history, pit_features, leakage_audit, label_cutoffs, entity_snapshots, cdc_audit, cdc_current, cdc_events, cdc_event_owners, cdc_summary, command_fold, command_events)}
QUERIES |= {"pit_counts": counts_block, "pit_latest_state": state_block}

_REASON = """CASE WHEN event_key IS NULL OR trim(event_key) = '' THEN 'MISSING_PRIMARY_KEY' WHEN ts IS NULL THEN 'INVALID_EVENT_TIMESTAMP' WHEN user_key IS NULL THEN 'MISSING_PARENT_ID'
    WHEN run_date IS NULL OR run_date > DATE '2024-01-31' THEN 'INVALID_RUN_DATE' WHEN ts::DATE > run_date THEN 'EVENT_AFTER_RUN_DATE' WHEN event_type NOT IN ('click', 'purchase', 'signup', 'view') THEN 'UNKNOWN_EVENT_TYPE' WHEN value < 1.0 THEN 'NEGATIVE_VALUE' END"""
_CLASS = f"(SELECT *, coalesce(reason NOT IN ('MISSING_PRIMARY_KEY', 'INVALID_EVENT_TIMESTAMP'), true) AS is_critical_valid, reason IS NULL AS is_recoverable_valid FROM (SELECT *, {_REASON} AS reason FROM dirty))"
_LATEST = f"SELECT l_orderkey, l_linenumber, {', '.join(SEQUENCE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in SEQUENCE)}) AS k FROM lineitem) WHERE k = 1"
_ORPHANS = "SELECT 'orders' AS dataset, o_orderkey::VARCHAR AS record_id, o_custkey AS entity_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 7 <> 0) UNION ALL SELECT 'events', event_id::VARCHAR, user_id FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_custkey % 7 <> 0)"

_DAYS = "day(as_of) < 25"
ORACLES = {k: i.sql(v) for k, v in {
    "quality_classify": f"SELECT is_critical_valid, is_recoverable_valid, reason AS violation_reason, count(*) AS row_count FROM {_CLASS} GROUP BY ALL",
    "quality_split": f"SELECT CASE WHEN is_recoverable_valid OR NOT is_critical_valid THEN 'accepted' ELSE 'quarantine' END AS side, event_key, ts, reason AS violation_reason FROM {_CLASS}",
    "quality_reasons": f"SELECT reason AS violation_reason, count(*) AS row_count FROM {_CLASS} WHERE is_critical_valid AND NOT is_recoverable_valid GROUP BY ALL",
    "customer_balance_quality": "SELECT c_custkey, true AS is_critical_valid, c_acctbal >= 0 AS is_recoverable_valid, CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_BALANCE' END AS violation_reason FROM customer",
    "expectation_report": "SELECT e AS expectation, count(*) FILTER (p) AS passed, count(*) FILTER (NOT p) AS failed FROM (SELECT unnest(['key_present', 'time_present', 'run_date_valid', 'type_known']) AS e, unnest([coalesce(trim(event_key) <> '', false), ts IS NOT NULL, coalesce(run_date <= DATE '2024-01-31', false), event_type <> 'error']) AS p FROM dirty) GROUP BY ALL",
    "constraint_violations": "SELECT lsn, 'status_domain' AS \"constraint\" FROM log1 WHERE status = 'deferred' UNION ALL SELECT lsn, 'version_positive' FROM log1 WHERE version <= 1 UNION ALL SELECT lsn, 'closed_has_no_follow_up' FROM log1 WHERE status = 'closed' AND next_follow_up_at IS NOT NULL",
    "must_hold": "SELECT o_orderkey, o_totalprice FROM orders",
    "ingest_stream_replay": f"SELECT CASE WHEN is_recoverable_valid THEN 'accepted' ELSE 'quarantine' END AS side, count(*) AS row_count, count(*) AS with_source FROM {_CLASS} WHERE is_critical_valid GROUP BY ALL",
    "guarded_batch": f"SELECT CASE WHEN is_recoverable_valid THEN 'accepted' ELSE 'quarantine' END AS side, count(*) AS row_count, count(*) AS with_source FROM {_CLASS} WHERE is_critical_valid AND value < 250 GROUP BY ALL",
    "feed_flow_counts": "SELECT flow, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'quarantine' END AS side, reason AS violation_reason, coalesce(reason = 'RESCUED_DATA', false) AS rescued, count(*) AS row_count FROM landed GROUP BY ALL",
    "flow_metrics": "SELECT flow, e AS expectation, count(*) FILTER (e <> 'recoverable' OR reason IS NULL) AS passed, count(*) FILTER (e = 'recoverable' AND reason IS NOT NULL) AS failed FROM landed, (SELECT unnest(['primary_key_present', 'event_timestamp_present', 'recoverable']) AS e) GROUP BY ALL",
    "daily_workflow": f"""SELECT as_of::DATE AS run_date, 'entities' AS stage, (SELECT count(*) FROM customer) AS row_count FROM cut WHERE {_DAYS} UNION ALL SELECT as_of::DATE, 'activity', (SELECT count(*) FROM events WHERE ts <= as_of) FROM cut WHERE {_DAYS}
        UNION ALL SELECT as_of::DATE, unnest(['features', 'scores']), count(*) FROM f_rate WHERE {_DAYS} GROUP BY as_of
        UNION ALL SELECT as_of::DATE, 'caseload', count(*) FILTER (0.35 * (1.0::DOUBLE - least(rate_28d, 1.0)) + 0.20 * least(missed_28d::DOUBLE, 4.0) / 4 + 0.15 * least(days_since_activity::DOUBLE, 60.0) / 60 >= 0.3) FROM f_rate JOIN f_counts USING (entity_id, as_of) WHERE {_DAYS} GROUP BY as_of""",
    "rescue_values": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS amount, CASE WHEN event_id % 5 = 0 THEN event_type END AS lost_amount, CASE WHEN event_id % 7 = 0 THEN 'x' || event_id::VARCHAR END AS surplus, event_id % 5 = 0 OR event_id % 7 = 0 AS rescued FROM events",
    "conform_stream_latest": f"SELECT * FROM ({_LATEST}) WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)",
    "scd1_latest": _LATEST,
    "scd1_upsert": _LATEST,
    "orphan_quarantine": _ORPHANS,
    "orphan_counts": f"SELECT dataset, count(*) AS orphans FROM ({_ORPHANS}) GROUP BY ALL",
    "with_parent": "SELECT o_custkey AS entity_id, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)",
    "protected_latest": "SELECT o_custkey AS entity_id, o_orderpriority, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1",
    "isolated_columns": "SELECT c_custkey, c_nationkey, c_mktsegment, 'c_mktsegment' AS forbidden FROM customer",
    "pit_rate_28d": f"SELECT {i.rounded(['rate_28d'], ['entity_id', 'as_of', 'max_event_at'])} FROM f_rate",
    "pit_counts": "SELECT * FROM f_counts",
    "pit_latest_state": "SELECT * FROM f_state",
    "pit_ranked_history": f"SELECT {i.rounded(['current', 'prior_sum', 'trend'], ['entity_id', 'as_of', 'prior_flags', 'max_event_at'])} FROM f_hist",
    "pit_features": f"""SELECT a.entity_id, a.as_of, c.c_mktsegment AS program, missed_28d, support_90d, days_since_activity, o_orderstatus, o_orderpriority, prior_flags, {i.rounded(['rate_28d', 'current', 'prior_sum', 'trend'], [])},
        greatest(a.max_event_at, b.max_event_at, d.max_event_at, e.max_event_at) AS max_feature_event_at FROM f_rate a JOIN f_counts b USING (entity_id, as_of) JOIN f_state d USING (entity_id, as_of) JOIN f_hist e USING (entity_id, as_of) JOIN customer c ON c.c_custkey = a.entity_id""",
    "leakage_audit": "SELECT count(*) AS leaks FROM f_rate a JOIN f_counts b USING (entity_id, as_of) WHERE greatest(a.max_event_at, b.max_event_at) > as_of",
    "label_cutoffs": "SELECT o_orderkey, (o_orderdate::DATE - 1)::TIMESTAMP + INTERVAL '23:59:59' AS as_of, (o_orderstatus = 'F')::INT AS label FROM orders",
    "entity_snapshots": "SELECT s_suppkey, d::TIMESTAMP + INTERVAL '23:59:59' AS as_of FROM (SELECT DISTINCT s_suppkey FROM supplier), (SELECT ts::DATE AS d FROM events UNION SELECT o_orderdate::DATE FROM orders)",
    "cdc_audit": "SELECT * FROM audit",
    "cdc_current": "SELECT * FROM cur",
    "cdc_events": "SELECT * FROM ev",
    "cdc_event_owners": "SELECT ev.event_id, ev.intervention_id, ev.event_type, l.entity_id, l.priority FROM ev JOIN (SELECT *, row_number() OVER (PARTITION BY intervention_id ORDER BY lsn DESC, sort_by DESC) AS k FROM audit) l ON l.intervention_id = ev.intervention_id AND l.k = 1",
    "cdc_summary": "SELECT * FROM summ",
}.items()}

#: Every command once those before it of its entity and of its key are known; used is the version that the key stands for from then on.
_COMMANDS = f"""WITH RECURSIVE c AS (
        SELECT *, lag(seq) OVER (PARTITION BY entity_id ORDER BY seq) AS entity_before, CASE WHEN idempotency_key IS NOT NULL THEN lag(seq) OVER (PARTITION BY idempotency_key ORDER BY seq) END AS key_before FROM (SELECT {', '.join(i.COMMANDS)} FROM events)),
    f(seq, applied, seen, version, prior_status, status, outcome, closed_at, used) USING KEY (seq) AS (
        SELECT -1::BIGINT, false, NULL::BIGINT, 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::TIMESTAMP, NULL::BIGINT
        UNION
        SELECT seq, applied, seen, version + applied::BIGINT, prior_status, CASE WHEN applied THEN target ELSE prior_status END, CASE WHEN applied THEN coalesce(said, outcome) ELSE outcome END,
            CASE WHEN NOT applied THEN closed_at WHEN target = 'closed' THEN happened END, CASE WHEN applied THEN version + 1 ELSE seen END
        FROM (
            SELECT c.seq, CASE WHEN c.action = 'create' THEN 'open' ELSE c.new_status END AS target, c.outcome AS said, c."at" AS happened, coalesce(e.version, 0) AS version, e.status AS prior_status, e.outcome, e.closed_at, k.used AS seen,
                k.used IS NULL AND CASE WHEN c.action = 'create' THEN coalesce(e.version, 0) = 0 ELSE coalesce(e.version > 0 AND e.version = c.expected_version, false) END AS applied
            FROM c LEFT JOIN recurring.f e ON e.seq = c.entity_before LEFT JOIN recurring.f k ON k.seq = c.key_before LEFT JOIN recurring.f done ON done.seq = c.seq
            WHERE done.seq IS NULL AND (c.entity_before IS NULL OR e.seq IS NOT NULL) AND (c.key_before IS NULL OR k.seq IS NOT NULL)))"""
ORACLES |= {
    "command_fold": f"{_COMMANDS} SELECT c.entity_id, seq, CASE WHEN applied THEN 'applied' WHEN seen IS NULL THEN 'conflict' ELSE 'replayed' END AS result, coalesce(seen, version)::INTEGER AS version, f.status, f.outcome, f.closed_at FROM f JOIN c USING (seq)",
    "command_events": f"""{_COMMANDS} SELECT c.entity_id, seq, CASE WHEN c.action = 'create' THEN 'created' ELSE c.event_type END AS event_type, f.prior_status, f.status AS new_status, c.idempotency_key, f.version::INTEGER AS result_version, c."at" FROM f JOIN c USING (seq) WHERE applied""",
}
