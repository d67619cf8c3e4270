"""The roles that the test tables play, as Spark DataFrames and as SQL for the comparison.

Each derived table is a list of expressions that both engines read the same way.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Contract

NOW = dt.datetime(2024, 1, 31)
TODAY = dt.date(2024, 1, 31)
CUTOFFS = ["2024-01-15 23:59:59", "2024-01-22 23:59:59", "2024-01-30 23:59:59"]

EVENTS = Contract("events", "event_key", "ts", "user_key", checks=(("UNKNOWN_EVENT_TYPE", "event_type IN ('click', 'purchase', 'signup', 'view')"), ("NEGATIVE_VALUE", "value >= 1.0D")))
CUSTOMERS = Contract("customers", "c_custkey", "seen_at", None, checks=(("NEGATIVE_BALANCE", "c_acctbal >= 0.0D"),))

DIRTY_EVENTS = [
    "CASE WHEN event_id % 83 <> 0 THEN CAST(event_id AS STRING) ELSE ' ' END AS event_key", "CASE WHEN event_id % 89 <> 0 THEN ts END AS ts",
    "CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS STRING) END AS user_key", "event_type", "value",
    "CASE WHEN event_id % 79 = 0 THEN DATE '2024-02-05' WHEN event_id % 71 = 0 THEN DATE '2024-01-02' WHEN event_id % 61 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2024-01-31' END AS run_date",
]
CHANGE_LOG = [
    "user_id AS entity_id", "user_id * 4 + event_id % 4 AS intervention_id",
    "CASE WHEN event_id % 10 < 4 THEN 'insert' WHEN event_id % 10 < 7 THEN 'update_postimage' WHEN event_id % 10 < 9 THEN 'update_preimage' ELSE 'delete' END AS change_type",
    "event_id AS lsn", "event_id * 7 % 5 AS sort_by",
    "CASE event_id % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'contacted' WHEN 2 THEN 'in_progress' WHEN 3 THEN 'deferred' ELSE 'closed' END AS status",
    "CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS priority", "event_id % 50 + 1 AS version",
    "ts - INTERVAL '1' DAY * (event_id % 5) AS created_at", "ts AS updated_at",
    "CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL '1' DAY * (event_id % 7) END AS next_follow_up_at", "ts AS delivered_at",
]
EVENT_LOG = [
    "event_id - event_id % 2 AS event_id", "event_id AS lsn", "event_id * 7 % 5 AS sort_by", "CASE WHEN event_id % 7 < 6 THEN 'insert' ELSE 'update_postimage' END AS change_type",
    "user_id * 4 + event_id % 4 AS intervention_id",
    "CASE event_id % 6 WHEN 0 THEN 'created' WHEN 1 THEN 'note_added' WHEN 2 THEN 'follow_up_scheduled' WHEN 3 THEN 'status_changed' WHEN 4 THEN 'closed' ELSE 'outcome_recorded' END AS event_type",
    "ts AS at", "ts AS delivered_at",
]
COMMANDS = [
    "event_id AS seq", "user_id * 2 + event_id % 2 AS entity_id", "CASE WHEN event_id % 9 < 2 THEN 'create' ELSE 'transition' END AS action", "CASE WHEN event_id % 8 = 3 THEN 'k' || CAST(event_id % 700 AS STRING) WHEN event_id % 8 = 5 THEN 'r' || CAST(user_id AS STRING) || '/' || CAST(event_id % 31 AS STRING) WHEN event_id % 8 < 7 THEN 'u' || CAST(event_id AS STRING) END AS idempotency_key",
    "CAST(event_id % 3 + 1 AS INT) AS expected_version", "CASE WHEN event_id % 5 = 4 THEN 'closed' ELSE 'status_changed' END AS event_type",
    "CASE event_id % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'contacted' WHEN 2 THEN 'in_progress' WHEN 3 THEN 'deferred' ELSE 'closed' END AS new_status", "CASE WHEN event_id % 4 = 0 THEN event_type END AS outcome", "ts AS at",
]
#: The six feeds as they land, as text: name -> (table, columns). Some values don't fit their type, and outcomes have a column that the feed lacks.
FEEDS = {
    "entities": ("customer", [
        "'E' || CAST(c_custkey AS STRING) AS entity_id", "c_mktsegment AS program", "'A' || CAST(c_custkey % 40 AS STRING) AS advisor_id", "CASE WHEN c_custkey % 61 = 0 THEN 'n/a' ELSE CAST(c_custkey % 1000 AS STRING) END AS exposure",
        "'2024-01-10 00:00:00' AS record_effective_at", "CASE WHEN c_custkey % 47 = 0 THEN '2024-03-01' ELSE '2024-01-30' END AS run_date"]),
    "periods": ("orders", [
        "'P' || CAST(o_orderkey AS STRING) AS period_id", "CASE WHEN o_orderkey % 59 <> 0 THEN 'E' || CAST(o_custkey AS STRING) END AS entity_id", "'T1' AS term", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS census_date", "CASE WHEN o_orderkey % 67 = 0 THEN 'twelve' ELSE '12' END AS credits_attempted",
        "'10' AS credits_completed", "CAST((o_orderkey % 45) / 10.0D AS STRING) AS cumulative_gpa", "'2024-01-30' AS run_date"]),
    "presence": ("events", [
        "'R' || CAST(event_id AS STRING) AS presence_id", "CASE WHEN event_id % 97 <> 0 THEN 'E' || CAST(user_id AS STRING) END AS entity_id", "CAST(ts AS STRING) AS event_at", "CASE WHEN event_id % 101 = 0 THEN 'perhaps' ELSE 'true' END AS present_flag",
        "CASE WHEN event_id % 71 = 0 THEN '2024-01-02' ELSE '2024-01-31' END AS run_date"]),
    "activity": ("events", [
        "'V' || CAST(event_id AS STRING) AS activity_id", "'E' || CAST(user_id AS STRING) AS entity_id", "CASE event_type WHEN 'click' THEN 'LMS_LOGIN' WHEN 'view' THEN 'ASSIGNMENT' WHEN 'purchase' THEN 'ADVISING' WHEN 'signup' THEN 'SUPPORT' ELSE 'OTHER' END AS event_type", "CAST(ts AS STRING) AS event_at", "'2024-01-31' AS run_date"]),
    "balances": ("events", [
        "'B' || CAST(event_id AS STRING) AS balance_id", "'E' || CAST(user_id AS STRING) AS entity_id", "CAST(ts AS STRING) AS event_at", "CASE WHEN event_id % 9 = 0 THEN '-1.5' ELSE '20.25' END AS balance_amount", "'false' AS hold_flag", "'2024-01-31' AS run_date"]),
    "outcomes": ("orders", [
        "'O' || CAST(o_orderkey AS STRING) AS outcome_id", "'E' || CAST(o_custkey AS STRING) AS entity_id", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS next_census_date", "o_orderstatus AS outcome_status", "'2024-01-30' AS run_date", "CASE WHEN o_orderkey % 83 = 0 THEN 'late' END AS note"]),
}
TERM = "CAST(year(o_orderdate) AS STRING) || 'Q' || CAST(quarter(o_orderdate) AS STRING)"


def score_sql(factor: int) -> str:
    return f"CAST((c_custkey * {factor} + day(as_of) * 104729) % 1000 AS DOUBLE) / 1000"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a landed file or a bucket.
PART_ROWS = 1_000_000


def parts(df: DataFrame, least: int) -> int:
    """How many files or buckets the rows take, so that none of them grows with the input."""
    return max(least, -(-df.count() // PART_ROWS))


def cutoffs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in CUTOFFS], "as_of string").select(F.col("as_of").cast("timestamp_ntz"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id")).distinct()
    return keys.crossJoin(F.broadcast(cutoffs(spark)))  # three rows


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumnRenamed("user_id", "entity_id")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "entity_id")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change images from events, a quarter of them delivered twice."""
    log = read(spark, sf_dir, "events").selectExpr(*CHANGE_LOG)
    again = log.where("lsn % 4 = 0").withColumn("delivered_at", F.expr("delivered_at + INTERVAL '1' MINUTE"))
    return log.unionByName(again)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*EVENT_LOG)


def score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all snapshots by model version 1, and of even entities by version 2."""
    base = snapshots(spark, sf_dir).withColumnRenamed("entity_id", "c_custkey")
    part = lambda version, factor: base.selectExpr("c_custkey AS entity_id", "as_of", f"{score_sql(factor)} AS risk_score", f"'{version}' AS model_version", "as_of + INTERVAL '6' HOUR AS scored_at")
    return part(1, 7919).unionByName(part(2, 6271).where("entity_id % 2 = 0"))


# The same tables as common table expressions
def _select(expressions: list[str], source: str) -> str:
    return f"SELECT {', '.join(expressions)} FROM {source}"


CTE = {
    "cut": "SELECT unnest([" + ", ".join(f"TIMESTAMP '{c}'" for c in CUTOFFS) + "]) AS as_of",
    "snap": "SELECT DISTINCT c_custkey AS entity_id, as_of FROM customer, cut",
    "dirty": _select(DIRTY_EVENTS, "events"),
    "log1": _select(CHANGE_LOG, "events"),
    "log": "SELECT * FROM log1 UNION ALL SELECT * REPLACE (delivered_at + INTERVAL '1' MINUTE AS delivered_at) FROM log1 WHERE lsn % 4 = 0",
    "elog": _select(EVENT_LOG, "events"),
    "audit": "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY intervention_id, change_type, lsn, sort_by ORDER BY delivered_at DESC) AS k FROM log) WHERE k = 1",
    "cur": "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY intervention_id ORDER BY lsn DESC, sort_by DESC) AS k FROM audit WHERE change_type <> 'update_preimage') WHERE k = 1 AND change_type <> 'delete'",
    "ev": "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY lsn, sort_by) AS k FROM elog WHERE change_type = 'insert') WHERE k = 1",
    "flags": "SELECT intervention_id, max(CASE WHEN event_type = 'follow_up_scheduled' THEN 1 ELSE 0 END) AS s, max(CASE WHEN event_type = 'closed' THEN 1 ELSE 0 END) AS c FROM ev GROUP BY 1",
    "sumrank": "SELECT cur.*, coalesce(s, 0) AS s, coalesce(c, 0) AS c, row_number() OVER (PARTITION BY entity_id ORDER BY CASE WHEN status <> 'closed' THEN 1 ELSE 0 END DESC, updated_at DESC, version DESC, lsn DESC, sort_by DESC) AS k FROM cur LEFT JOIN flags USING (intervention_id)",
    "summ": "SELECT entity_id, max(CASE WHEN k = 1 THEN status END) AS intervention_status, max(CASE WHEN k = 1 THEN priority END) AS intervention_priority, min(created_at) AS first_intervention_at, bool_or(status <> 'closed' AND next_follow_up_at IS NOT NULL AND next_follow_up_at <= TIMESTAMP '2024-01-31 00:00:00') AS follow_up_due, bool_or(s = 1 AND c = 1) AS follow_up_completed FROM sumrank GROUP BY 1",
    "f_rate": "SELECT s.entity_id, s.as_of, coalesce(avg(CASE WHEN e.event_type = 'purchase' THEN 1.0::DOUBLE WHEN e.event_id IS NOT NULL THEN 0.0::DOUBLE END), 0.0) AS rate_28d, max(e.ts) AS max_event_at FROM snap s LEFT JOIN events e ON e.user_id = s.entity_id AND e.ts <= s.as_of AND e.ts > s.as_of - INTERVAL 28 DAYS GROUP BY 1, 2",
    "f_counts": "SELECT s.entity_id, s.as_of, sum(CASE WHEN e.ts > s.as_of - INTERVAL 28 DAYS AND e.event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS missed_28d, sum(CASE WHEN e.ts > s.as_of - INTERVAL 90 DAYS AND e.event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS support_90d, coalesce(date_diff('day', max(CASE WHEN e.event_type = 'view' THEN e.ts END)::DATE, s.as_of::DATE), 999)::BIGINT AS days_since_activity, max(e.ts) AS max_event_at FROM snap s LEFT JOIN events e ON e.user_id = s.entity_id AND e.ts <= s.as_of GROUP BY 1, 2",
    "o_rank": "SELECT s.entity_id, s.as_of, o.*, row_number() OVER (PARTITION BY s.entity_id, s.as_of ORDER BY o.o_orderdate DESC NULLS LAST, o.o_orderkey DESC NULLS LAST) AS k FROM snap s LEFT JOIN orders o ON o.o_custkey = s.entity_id AND o.o_orderdate <= s.as_of",
    "f_state": "SELECT entity_id, as_of, coalesce(o_orderstatus, 'NONE') AS o_orderstatus, coalesce(o_orderpriority, 'NONE') AS o_orderpriority, o_orderdate AS max_event_at FROM o_rank WHERE k = 1",
    "f_hist": "SELECT entity_id, as_of, coalesce(max(CASE WHEN k = 1 THEN o_totalprice END), 0.0) AS current, coalesce(sum(CASE WHEN k > 1 THEN o_totalprice ELSE 0.0 END), 0.0) AS prior_sum, coalesce(max(CASE WHEN k = 1 THEN o_totalprice END) - max(CASE WHEN k = 2 THEN o_totalprice END), 0.0) AS trend, sum(CASE WHEN k > 1 AND o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS prior_flags, max(o_orderdate) AS max_event_at FROM o_rank GROUP BY 1, 2",
    "scores1": f"SELECT entity_id, as_of, {score_sql(7919).replace('c_custkey', 'entity_id')} AS risk_score, '1' AS model_version, as_of + INTERVAL '6' HOUR AS scored_at FROM snap",
    "scores": f"SELECT * FROM scores1 UNION ALL SELECT entity_id, as_of, {score_sql(6271).replace('c_custkey', 'entity_id')} AS risk_score, '2' AS model_version, as_of + INTERVAL '6' HOUR AS scored_at FROM snap WHERE entity_id % 2 = 0",
    "lscore": "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY as_of DESC, scored_at DESC, model_version::BIGINT DESC) AS k FROM scores) WHERE k = 1",
    "terms": f"SELECT o_custkey AS entity_id, arg_min({TERM}, (o_orderdate, o_orderkey)) AS cohort, arg_max({TERM}, (o_orderdate, o_orderkey)) AS last_term FROM orders GROUP BY 1",
    "outc": f"SELECT o_custkey AS entity_id, CASE arg_max(o_orderstatus, (o_orderdate, o_orderkey)) WHEN 'F' THEN 'PERSISTED' WHEN 'O' THEN 'RETAINED' ELSE 'LEFT' END AS outcome_status, arg_max(CASE WHEN o_orderkey % 3 <> 0 THEN {TERM} ELSE '' END, (o_orderdate, o_orderkey)) AS outcome_term FROM orders GROUP BY 1",
    "ctx": """SELECT r.entity_id, r.as_of, r.as_of::DATE AS score_date, r.risk_score, CASE WHEN r.risk_score >= 0.6 THEN 'high' WHEN r.risk_score >= 0.3 THEN 'medium' ELSE 'low' END AS risk_tier, r.model_version, r.scored_at,
        c.c_mktsegment AS program, c.c_custkey % 40 AS advisor_id, greatest(c.c_acctbal, 0.0) AS exposure, f.rate_28d, g.missed_28d, g.days_since_activity, t.cohort, coalesce(nullif(o.outcome_term, ''), t.last_term) AS term, o.outcome_status,
        coalesce(i.intervention_status, 'not_started') AS intervention_status, i.intervention_priority, i.first_intervention_at, coalesce(i.follow_up_due, false) AS follow_up_due, coalesce(i.follow_up_completed, false) AS follow_up_completed
        FROM lscore r JOIN customer c ON c.c_custkey = r.entity_id JOIN f_rate f ON f.entity_id = r.entity_id AND f.as_of = r.as_of JOIN f_counts g ON g.entity_id = r.entity_id AND g.as_of = r.as_of
        LEFT JOIN terms t ON t.entity_id = r.entity_id LEFT JOIN outc o ON o.entity_id = r.entity_id LEFT JOIN summ i ON i.entity_id = r.entity_id""",
    "load": "SELECT *, row_number() OVER (PARTITION BY advisor_id ORDER BY risk_score DESC, entity_id) AS caseload_priority FROM ctx WHERE risk_tier IN ('medium', 'high')",
    "exec": """SELECT program, cohort, term, score_date, risk_tier, intervention_status, count(DISTINCT entity_id) AS entity_count, count(*) FILTER (risk_tier IN ('medium', 'high')) AS at_risk_count,
        avg(CASE WHEN outcome_status IN ('PERSISTED', 'RETAINED') THEN 1.0::DOUBLE ELSE 0.0 END) AS retention_rate, avg(CASE WHEN outcome_status IN ('PERSISTED', 'RETAINED') THEN 1.0::DOUBLE WHEN outcome_status IS NOT NULL THEN 0.0 END) AS observed_retention_rate,
        avg(CASE WHEN risk_tier IN ('medium', 'high') THEN CASE WHEN intervention_status IN ('open', 'contacted', 'in_progress', 'deferred') THEN 1.0::DOUBLE ELSE 0.0 END END) AS intervention_coverage,
        avg(CASE WHEN date_sub('second', scored_at, first_intervention_at) >= 0 THEN date_sub('second', scored_at, first_intervention_at) / 86400.0::DOUBLE END) AS days_to_first_intervention,
        avg(CASE WHEN follow_up_due THEN follow_up_completed::INT::DOUBLE END) AS follow_up_completion_rate, sum(CASE WHEN risk_tier IN ('medium', 'high') THEN exposure ELSE 0.0 END) AS exposure, true AS exposure_is_estimate, max(scored_at) AS fresh_at
        FROM ctx GROUP BY ALL""",
    "landed": """SELECT 'entities' AS flow, CASE WHEN c_custkey % 61 = 0 THEN 'RESCUED_DATA' WHEN c_custkey % 47 = 0 THEN 'INVALID_RUN_DATE' END AS reason FROM customer
        UNION ALL SELECT 'periods', CASE WHEN o_orderkey % 67 = 0 THEN 'RESCUED_DATA' WHEN o_orderkey % 59 = 0 THEN 'MISSING_PARENT_ID' WHEN o_orderkey % 45 > 40 THEN 'GPA_OUT_OF_RANGE' END FROM orders
        UNION ALL SELECT 'presence', CASE WHEN event_id % 101 = 0 THEN 'RESCUED_DATA' WHEN event_id % 97 = 0 THEN 'MISSING_PARENT_ID' WHEN event_id % 71 = 0 AND ts::DATE > DATE '2024-01-02' THEN 'EVENT_AFTER_RUN_DATE' END FROM events
        UNION ALL SELECT 'activity', CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'UNKNOWN_EVENT_TYPE' END FROM events
        UNION ALL SELECT 'balances', CASE WHEN event_id % 9 = 0 THEN 'NEGATIVE_BALANCE' END FROM events
        UNION ALL SELECT 'outcomes', CASE WHEN o_orderkey % 83 = 0 THEN 'RESCUED_DATA' END FROM orders""",
    "trend": "SELECT program, cohort, term, score_date, risk_tier, intervention_status, count(DISTINCT entity_id) AS entity_count, avg(risk_score) AS average_score, min(risk_score) AS minimum_score, max(risk_score) AS maximum_score FROM ctx GROUP BY ALL",
}


def sql(body: str) -> str:
    """body with the common table expressions that it names, directly or through others, in order."""
    import re

    used: set[str] = set()

    def collect(text: str) -> None:
        for name in CTE:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                collect(CTE[name])

    collect(body)
    own = ", ".join(f"{name} AS ({CTE[name]})" for name in CTE if name in used)
    return f"WITH {own} {body}" if own else body


def rounded(names: list[str], others: list[str]) -> str:
    """Select list: others as they are, names rounded to six places."""
    return ", ".join([*others, *(f"round({n}, 6)::DOUBLE AS {n}" for n in names)])


def round_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})
