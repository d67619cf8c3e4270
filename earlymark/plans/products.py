"""Queries over the products: context, caseload, metrics, roll-ups, profiles, policies and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import products as p
from ..operators import rollups as r
from ..sources import files
from . import feeds, hashing
from . import inputs as i


def scored_history(spark, sf_dir):
    return i.score_history(spark, sf_dir).withColumn("risk_tier", p.risk_tier(F.col("risk_score")))


def latest_scores(spark, sf_dir):
    return p.latest_scores(scored_history(spark, sf_dir))


def context(spark, sf_dir):
    orders = i.orders(spark, sf_dir).withColumn("term", F.expr(i.TERM))
    owners = i.read(spark, sf_dir, "customer").selectExpr("c_custkey AS entity_id", "c_mktsegment AS program", "c_custkey % 40 AS advisor_id", "greatest(c_acctbal, 0.0D) AS exposure")
    features = feeds.activity_block(spark, sf_dir).drop("max_event_at", "support_90d").join(owners, "entity_id")
    outcomes = orders.select("entity_id", "o_orderdate", "o_orderkey", F.expr("CASE o_orderstatus WHEN 'F' THEN 'PERSISTED' WHEN 'O' THEN 'RETAINED' ELSE 'LEFT' END").alias("outcome_status"), F.when(F.col("o_orderkey") % 3 != 0, F.col("term")).alias("outcome_term"))
    return p.entity_context(latest_scores(spark, sf_dir), features, p.first_and_last_term(orders, "entity_id", "o_orderdate", "o_orderkey", "term"), p.latest_outcome(outcomes, "entity_id", "o_orderdate", "o_orderkey", ["outcome_status", "outcome_term"]), feeds.cdc_summary(spark, sf_dir))


CONTEXT_FLOATS, EXEC_FLOATS, TREND_FLOATS = ["rate_28d"], ["retention_rate", "observed_retention_rate", "intervention_coverage", "days_to_first_intervention", "follow_up_completion_rate", "exposure"], ["average_score"]
CASELOAD = ["entity_id", "advisor_id", "program", "cohort", "term", "score_date", "risk_score", "risk_tier", "intervention_status", "intervention_priority", "first_intervention_at", "follow_up_due", "follow_up_completed", "caseload_priority", "scored_at"]


def entity_context(spark, sf_dir):
    return i.round_columns(context(spark, sf_dir), CONTEXT_FLOATS)


def entity_detail(spark, sf_dir):
    return i.round_columns(p.detail(context(spark, sf_dir)), CONTEXT_FLOATS)


def caseload_ranked(spark, sf_dir):
    return p.caseload(context(spark, sf_dir)).select(*CASELOAD)


def executive(spark, sf_dir):
    return p.executive_metrics(context(spark, sf_dir))


def trends(spark, sf_dir):
    return p.risk_trends(context(spark, sf_dir))


def executive_metrics(spark, sf_dir):
    return i.round_columns(executive(spark, sf_dir), EXEC_FLOATS)


def risk_trends(spark, sf_dir):
    return i.round_columns(trends(spark, sf_dir), TREND_FLOATS)


def risk_trend_history(spark, sf_dir):
    rows = scored_history(spark, sf_dir).withColumn("score_date", F.to_date("as_of"))
    return i.round_columns(p.risk_trends(rows, ["score_date", "model_version", "risk_tier"]), TREND_FLOATS)


def kpi_rollup(spark, sf_dir):
    return i.round_columns(r.kpi_rollup(executive(spark, sf_dir)), [c for c in EXEC_FLOATS if c != "observed_retention_rate"])


def kpi_rollup_weighted(spark, sf_dir):
    return i.round_columns(r.kpi_rollup(executive(spark, sf_dir), by_at_risk=True), [c for c in EXEC_FLOATS if c != "observed_retention_rate"])


def trend_rollup(spark, sf_dir):
    return i.round_columns(r.trend_rollup(trends(spark, sf_dir), ["score_date", "risk_tier"]), TREND_FLOATS)


def program_trend(spark, sf_dir):
    return i.round_columns(r.trend_rollup(trends(spark, sf_dir), ["score_date", "program"]), TREND_FLOATS)


def concentration(spark, sf_dir):
    return r.concentration(trends(spark, sf_dir))


def high_count(spark, sf_dir):
    return r.total_by(trends(spark, sf_dir), ["program"], "entity_count", "high_entities", "risk_tier = 'high'")


def coverage_by_program(spark, sf_dir):
    return i.round_columns(r.weighted_by(executive(spark, sf_dir), ["program"], "intervention_coverage", "at_risk_count", "risk_tier IN ('medium', 'high')"), ["intervention_coverage"])


def exposure(spark, sf_dir):
    return i.round_columns(r.total_by(executive(spark, sf_dir), ["program"], "exposure", "exposure"), ["exposure"])


def retention_weighted(spark, sf_dir):
    return i.round_columns(r.weighted_by(executive(spark, sf_dir), ["program"], "retention_rate", "entity_count"), ["retention_rate"])


def status_counts(spark, sf_dir):
    return r.total_by(executive(spark, sf_dir), ["program", "intervention_status"], "entity_count", "entity_count")


def tier_distribution(spark, sf_dir):
    return r.total_by(trends(spark, sf_dir), ["risk_tier"], "entity_count", "entity_count")


def unknown_group(spark, sf_dir):
    return r.total_by(trends(spark, sf_dir), ["program"], "entity_count", "entity_count", "program = 'NO_SUCH_PROGRAM'")


ROW_TABLES = ("customer", "orders", "lineitem", "events", "documents", "labels", "conversations")


def row_counts(spark, sf_dir):
    return r.row_counts({t: i.read(spark, sf_dir, t) for t in ROW_TABLES})


def duplicate_keys(spark, sf_dir):
    return r.duplicate_keys({"lineitem": (i.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]), "events": (i.read(spark, sf_dir, "events"), ["event_id"]), "orders": (i.read(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])})


def completeness(spark, sf_dir):
    return r.completeness(feeds.dirty_events(spark, sf_dir), ["event_key", "ts", "user_key", "run_date"], F.col("ts") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


def value_profile(spark, sf_dir):
    return r.profile(files.scan_sql(spark, f"{sf_dir}/orders.parquet"), ["o_orderpriority"], "o_totalprice")


def segment_rate(spark, sf_dir):
    rows = i.read(spark, sf_dir, "orders").join(i.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return i.round_columns(r.rate_by(rows, ["c_mktsegment"], F.col("o_orderstatus") == "F", "filled_rate"), ["filled_rate"])


def period_balance(spark, sf_dir):
    return i.read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("period"), (F.col("o_orderstatus") == "F").alias("label")).agg(F.count(F.lit(1)).alias("row_count"))


def history_integrity(spark, sf_dir):
    return scored_history(spark, sf_dir).groupBy("model_version", "risk_tier").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("entity_id", "as_of").alias("keys"), F.max("scored_at").alias("fresh_at"))


def snapshot_completeness(spark, sf_dir):
    return i.snapshots(spark, sf_dir).groupBy(F.to_date("as_of").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("entity_id").alias("entities"))


def image_counts(spark, sf_dir):
    return i.change_log(spark, sf_dir).groupBy("change_type").agg(F.count(F.lit(1)).alias("images"), F.countDistinct("lsn").alias("distinct_images"))


def status_rollup(spark, sf_dir):
    i.read(spark, sf_dir, "events").selectExpr(*i.CHANGE_LOG).createOrReplaceTempView("earlymark_changes")
    return spark.sql("SELECT status, priority, count(*) AS row_count, min(version) AS first_version, sum(CASE WHEN next_follow_up_at IS NULL THEN 1 ELSE 0 END) AS without_follow_up FROM earlymark_changes GROUP BY ALL")


def metric_delta(spark, sf_dir):
    log = i.change_log(spark, sf_dir)
    measures = {"images": F.count(F.lit(1)), "entities": F.countDistinct("entity_id"), "closed": F.count_if(F.col("status") == "closed")}
    return r.metric_delta(log.where("lsn % 2 = 0"), log, measures)


def freshness(spark, sf_dir):
    return r.freshness({"events": (i.read(spark, sf_dir, "events"), "ts"), "orders": (i.read(spark, sf_dir, "orders"), "o_orderdate")})


def table_checksum(spark, sf_dir):
    return r.checksum(i.read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


def _entitled(spark, rows):
    return spark.createDataFrame(rows, "user_identity string, scope string")


def row_policy(spark, sf_dir):
    user = spark.sql("SELECT current_user()").first()[0]
    grants = _entitled(spark, [(user, "3"), (user, "7"), ("someone else", "*")])
    return r.allowed(caseload_ranked(spark, sf_dir), grants, "advisor_id").select("entity_id", "advisor_id")


def row_policy_all(spark, sf_dir):
    return r.allowed(caseload_ranked(spark, sf_dir), _entitled(spark, [("reader", "*"), ("reader", "3")]), "advisor_id", "reader").select("entity_id", "advisor_id")


def row_policy_denied(spark, sf_dir):
    return r.allowed(caseload_ranked(spark, sf_dir), _entitled(spark, [("someone else", "*")]), "advisor_id", "reader").select("entity_id", "advisor_id")


def caseload_page(spark, sf_dir):
    return r.page(caseload_ranked(spark, sf_dir), "high", 25, 25).select("entity_id", "caseload_priority", "risk_score", "total_count")


def caseload_page_sql(spark, sf_dir):
    caseload_ranked(spark, sf_dir).createOrReplaceTempView("earlymark_caseload")
    return spark.sql("SELECT entity_id, caseload_priority FROM earlymark_caseload WHERE :tier = '' OR risk_tier = :tier ORDER BY caseload_priority, entity_id LIMIT :size OFFSET :skip", args={"tier": "", "size": 10, "skip": 5})


def top_caseload(spark, sf_dir):
    return r.top_k(caseload_ranked(spark, sf_dir), 10, [F.asc("caseload_priority"), F.asc("entity_id")]).select("entity_id", "program", "risk_score", "risk_tier", "intervention_status", "caseload_priority")


def top_scores(spark, sf_dir):
    return r.top_k(latest_scores(spark, sf_dir), 50, [F.desc("risk_score"), F.asc("entity_id")]).select("entity_id", "risk_score")


def backlog(spark, sf_dir):
    return caseload_ranked(spark, sf_dir).where("follow_up_due").select("entity_id", "program", "risk_tier", "intervention_priority", "caseload_priority").orderBy("caseload_priority")


def urgency_sort(spark, sf_dir):
    return r.urgency(caseload_ranked(spark, sf_dir).select("entity_id", "follow_up_due", "caseload_priority"))


def entity_lookup(spark, sf_dir):
    return r.lookup(scored_history(spark, sf_dir).where("model_version = '1'"), "entity_id", 17, "as_of").select("entity_id", "as_of", "risk_score")


def owner_history(spark, sf_dir):
    cases = feeds.cdc_current(spark, sf_dir).select("intervention_id", "entity_id", F.col("priority").alias("owner"), "status")
    return r.owner_history(cases, feeds.cdc_events(spark, sf_dir).select("intervention_id", "event_id", "at"), 5, "high")


def tier_transitions(spark, sf_dir):
    return p.tier_transitions(scored_history(spark, sf_dir).where("model_version = '1'"))


def serving_snapshot(spark, sf_dir):
    return i.round_columns(p.serving_snapshot(trends(spark, sf_dir).fillna("UNKNOWN", ["cohort", "term"]), p.DIMENSIONS, "risk_trends", "serving.risk_trends", {"change_log", "event_log"}), TREND_FLOATS)


QUERIES = {f.__name__: f for f in (
    latest_scores, entity_context, entity_detail, caseload_ranked, executive_metrics, risk_trends, risk_trend_history, kpi_rollup, kpi_rollup_weighted, trend_rollup, program_trend, concentration, high_count, coverage_by_program,
    exposure, retention_weighted, status_counts, tier_distribution, unknown_group, row_counts, duplicate_keys, completeness, value_profile, segment_rate, period_balance, history_integrity, snapshot_completeness, image_counts,
    status_rollup, metric_delta, freshness, table_checksum, row_policy, row_policy_all, row_policy_denied, caseload_page, caseload_page_sql, top_caseload, top_scores, backlog, urgency_sort, entity_lookup, owner_history,
    tier_transitions, serving_snapshot)}

_TIER = "CASE WHEN risk_score >= 0.6 THEN 'high' WHEN risk_score >= 0.3 THEN 'medium' ELSE 'low' END"
_KPI = [c for c in EXEC_FLOATS if c not in ("observed_retention_rate", "exposure")]
_W = lambda v, w: f"sum({v} * {w}) / nullif(sum(CASE WHEN {v} IS NOT NULL THEN {w} END), 0)"
_EXEC = ["program", "cohort", "term", "score_date", "risk_tier", "intervention_status", "entity_count", "at_risk_count", "exposure_is_estimate", "fresh_at"]
_TREND = f"SELECT {i.rounded(['average_score'], [*p.DIMENSIONS, 'entity_count', 'minimum_score', 'maximum_score'])} FROM trend"
_KPI_HEAD = "SELECT score_date, sum(entity_count)::BIGINT AS entity_count, sum(at_risk_count)::BIGINT AS at_risk_count, round(sum(exposure), 6) AS exposure, max(fresh_at) AS fresh_at"
_KPI_TAIL = "FROM exec WHERE score_date = (SELECT max(score_date) FROM exec) GROUP BY score_date"
_CTX_TAIL = "(SELECT * FROM ctx)"

ORACLES = {k: i.sql(v) for k, v in {
    "table_checksum": f"SELECT count(*) AS row_count, sum({hashing.SIGNED})::DECIMAL(38, 0) AS checksum FROM {hashing.with_hash('(SELECT o_orderkey, o_custkey, o_orderstatus FROM orders)', [('o_orderkey', 'long'), ('o_custkey', 'long'), ('o_orderstatus', 'letter')])}",
    "latest_scores": f"SELECT *, {_TIER} AS risk_tier FROM lscore",
    "entity_context": f"SELECT * REPLACE (round(rate_28d, 6) AS rate_28d) FROM {_CTX_TAIL}",
    "entity_detail": f"SELECT * EXCLUDE exposure REPLACE (round(rate_28d, 6) AS rate_28d) FROM {_CTX_TAIL}",
    "caseload_ranked": f"SELECT {', '.join(CASELOAD)} FROM load",
    "executive_metrics": f"SELECT {i.rounded(EXEC_FLOATS, _EXEC)} FROM exec",
    "risk_trends": _TREND,
    "serving_snapshot": f"SELECT * REPLACE (coalesce(cohort, 'UNKNOWN') AS cohort, coalesce(term, 'UNKNOWN') AS term) FROM ({_TREND})",
    "risk_trend_history": f"SELECT as_of::DATE AS score_date, model_version, {_TIER} AS risk_tier, count(DISTINCT entity_id) AS entity_count, round(avg(risk_score), 6) AS average_score, min(risk_score) AS minimum_score, max(risk_score) AS maximum_score FROM scores GROUP BY ALL",
    "kpi_rollup": f"{_KPI_HEAD}, {', '.join(f'round(sum(entity_count * {c}) / nullif(sum(entity_count), 0), 6) AS {c}' for c in _KPI)} {_KPI_TAIL}",
    "kpi_rollup_weighted": f"{_KPI_HEAD}, {', '.join(f'round({_W(c, w)}, 6) AS {c}' for c, w in zip(_KPI, ['entity_count', 'at_risk_count', 'entity_count', 'entity_count']))} {_KPI_TAIL}",
    "trend_rollup": f"SELECT score_date, risk_tier, sum(entity_count)::BIGINT AS entity_count, round({_W('average_score', 'entity_count')}, 6) AS average_score FROM trend GROUP BY ALL",
    "program_trend": f"SELECT score_date, program, sum(entity_count)::BIGINT AS entity_count, round({_W('average_score', 'entity_count')}, 6) AS average_score FROM trend GROUP BY ALL",
    "concentration": "SELECT program, sum(entity_count)::BIGINT AS elevated_entities FROM trend WHERE risk_tier IN ('medium', 'high') GROUP BY ALL",
    "high_count": "SELECT program, sum(entity_count)::BIGINT AS high_entities FROM trend WHERE risk_tier = 'high' GROUP BY ALL",
    "coverage_by_program": f"SELECT program, round({_W('intervention_coverage', 'at_risk_count')}, 6) AS intervention_coverage FROM exec WHERE risk_tier IN ('medium', 'high') GROUP BY ALL",
    "exposure": "SELECT program, round(sum(exposure), 6) AS exposure FROM exec GROUP BY ALL",
    "retention_weighted": f"SELECT program, round({_W('retention_rate', 'entity_count')}, 6) AS retention_rate FROM exec GROUP BY ALL",
    "status_counts": "SELECT program, intervention_status, sum(entity_count)::BIGINT AS entity_count FROM exec GROUP BY ALL",
    "tier_distribution": "SELECT risk_tier, sum(entity_count)::BIGINT AS entity_count FROM trend GROUP BY ALL",
    "unknown_group": "SELECT program, sum(entity_count)::BIGINT AS entity_count FROM trend WHERE program = 'NO_SUCH_PROGRAM' GROUP BY ALL",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS row_count FROM {t}" for t in ROW_TABLES),
    "duplicate_keys": "SELECT 'lineitem' AS dataset, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem UNION ALL SELECT 'events', count(*) - count(DISTINCT event_id) FROM events UNION ALL SELECT 'orders', count(*) - count(DISTINCT (o_custkey, o_orderdate)) FROM orders",
    "completeness": "SELECT count(*) AS row_count, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in ("event_key", "ts", "user_key", "run_date")) + ", count(*) FILTER (ts > TIMESTAMP '2024-01-20 00:00:00') AS future_rows FROM dirty",
    "value_profile": "SELECT o_orderpriority, count(*) AS row_count, round(avg(o_totalprice), 6) AS average FROM orders GROUP BY ALL",
    "segment_rate": "SELECT c_mktsegment, count(*) AS row_count, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS filled_rate FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "period_balance": "SELECT year(o_orderdate)::INT AS period, o_orderstatus = 'F' AS label, count(*) AS row_count FROM orders GROUP BY ALL",
    "history_integrity": f"SELECT model_version, {_TIER} AS risk_tier, count(*) AS row_count, count(DISTINCT (entity_id, as_of)) AS keys, max(scored_at) AS fresh_at FROM scores GROUP BY ALL",
    "snapshot_completeness": "SELECT as_of::DATE AS snapshot_date, count(*) AS row_count, count(DISTINCT entity_id) AS entities FROM snap GROUP BY ALL",
    "image_counts": "SELECT change_type, count(*) AS images, count(DISTINCT lsn) AS distinct_images FROM log GROUP BY ALL",
    "status_rollup": "SELECT status, priority, count(*) AS row_count, min(version) AS first_version, sum(CASE WHEN next_follow_up_at IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_follow_up FROM log1 GROUP BY ALL",
    "metric_delta": "SELECT metric, b AS before, a AS after, a - b AS delta FROM (SELECT unnest(['images', 'entities', 'closed']) AS metric, unnest([count(*) FILTER (lsn % 2 = 0), count(DISTINCT entity_id) FILTER (lsn % 2 = 0), count(*) FILTER (lsn % 2 = 0 AND status = 'closed')])::DOUBLE AS b, unnest([count(*), count(DISTINCT entity_id), count(*) FILTER (status = 'closed')])::DOUBLE AS a FROM log)",
    "freshness": "SELECT 'events' AS dataset, count(*) AS row_count, max(ts) AS fresh_at FROM events UNION ALL SELECT 'orders', count(*), max(o_orderdate) FROM orders",
    "row_policy": "SELECT entity_id, advisor_id FROM load WHERE advisor_id IN (3, 7)",
    "row_policy_all": "SELECT entity_id, advisor_id FROM load",
    "row_policy_denied": "SELECT entity_id, advisor_id FROM load WHERE false",
    "caseload_page": "SELECT entity_id, caseload_priority, risk_score, total_count FROM (SELECT *, count(*) OVER () AS total_count FROM load WHERE risk_tier = 'high' ORDER BY caseload_priority, follow_up_due DESC, risk_score DESC, entity_id LIMIT 25 OFFSET 25)",
    "caseload_page_sql": "SELECT entity_id, caseload_priority FROM load ORDER BY caseload_priority, entity_id LIMIT 10 OFFSET 5",
    "top_caseload": "SELECT entity_id, program, risk_score, risk_tier, intervention_status, caseload_priority FROM load ORDER BY caseload_priority, entity_id LIMIT 10",
    "top_scores": "SELECT entity_id, risk_score FROM lscore ORDER BY risk_score DESC, entity_id LIMIT 50",
    "backlog": "SELECT entity_id, program, risk_tier, intervention_priority, caseload_priority FROM load WHERE follow_up_due ORDER BY caseload_priority",
    "urgency_sort": "SELECT entity_id, follow_up_due, caseload_priority FROM load",
    "entity_lookup": "SELECT entity_id, as_of, risk_score FROM scores1 WHERE entity_id = 17 ORDER BY as_of DESC LIMIT 1",
    "owner_history": "SELECT cur.intervention_id, cur.entity_id, cur.priority AS owner, cur.status, ev.event_id, ev.at FROM cur JOIN ev USING (intervention_id) WHERE cur.entity_id = 5 AND cur.priority = 'high'",
    "tier_transitions": f"SELECT entity_id, as_of, prior_tier, risk_tier FROM (SELECT *, lag(risk_tier) OVER (PARTITION BY entity_id ORDER BY as_of) AS prior_tier FROM (SELECT *, {_TIER} AS risk_tier FROM scores1)) WHERE prior_tier <> risk_tier",
}.items()}
