"""Queries over table maintenance, assignments, evaluation metrics, models and grounded text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import assign, text
from ..operators import metrics, model
from ..sources import keyed, sinks
from ..sources.workspace import kept, workspace
from . import feeds, hashing
from . import inputs as i
from . import products

SEED = 20_260_921
BUCKETS = 8  # of the tables that the queries make


def insert_only_append(spark, sf_dir):
    """Scores of two cutoffs, then all three: the third comes in, the others stay as they were; a replay adds nothing."""
    rows = products.scored_history(spark, sf_dir)
    t = keyed.Keyed(workspace(spark), ("entity_id", "as_of", "model_version"), ranged="as_of", buckets=BUCKETS)
    keyed.append_new(t, rows.where("as_of < TIMESTAMP_NTZ '2024-01-25 00:00:00'"))
    changed = rows.withColumn("risk_score", F.when(F.col("as_of") < F.lit("2024-01-25").cast("timestamp_ntz"), F.lit(-1.0)).otherwise(F.col("risk_score")))
    for _ in range(2):
        out = keyed.append_new(t, changed)
    return out


def upsert_by_key(spark, sf_dir):
    rows = i.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    t = keyed.Keyed(workspace(spark), ("o_orderkey",), buckets=BUCKETS)
    keyed.merge_upsert(t, rows.where("o_orderkey % 3 <> 0"))
    return keyed.merge_upsert(t, rows.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("U")))


def conditional_update(spark, sf_dir):
    rows = i.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    t = keyed.Keyed(workspace(spark), ("o_orderkey",), buckets=BUCKETS)
    keyed.merge_upsert(t, rows)
    updates = rows.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("checked").alias("o_orderpriority"))
    return keyed.merge_update(t, updates, ["o_orderpriority"], "o_orderstatus = 'F'")


def schema_evolve(spark, sf_dir):
    wanted = T.StructType().add("c_custkey", "long").add("c_mktsegment", "string").add("reviewed_at", "timestamp_ntz").add("reviewer", "string")
    return sinks.evolved(i.read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), wanted)


def run_partitions(spark, sf_dir):
    """Two run dates, one of them written twice."""
    path, rows = workspace(spark), i.read(spark, sf_dir, "events").select("event_id", "value")
    for day, keep in ((29, "event_id % 2 = 0"), (30, "event_id % 2 = 1"), (30, "event_id % 2 = 1")):
        sinks.write_run(rows.where(keep), path, dt.date(2024, 1, day))
    return spark.read.parquet(path).groupBy("run_date").agg(F.count(F.lit(1)).alias("row_count"))


def cohort_assign(spark, sf_dir):
    key = F.col("c_custkey")
    return i.read(spark, sf_dir, "customer").select("c_custkey", assign.in_cohort(key, SEED).alias("in_cohort"), assign.propensity(key, SEED).cast("long").alias("propensity"))


def bucket_ladder(spark, sf_dir):
    bucket = assign.propensity(F.col("c_custkey"), SEED)
    return i.read(spark, sf_dir, "customer").select("c_custkey", assign.ladder(bucket, [(2500, "NONE"), (5000, "LOW"), (8600, "MEDIUM")], "HIGH").alias("band"), assign.skewed(bucket, assign.SPACE, 5.0, 100.0).alias("amount"))


def period_expand(spark, sf_dir):
    entity, period = assign.entity_and_period(F.col("o_orderkey"), 4000, ["P1", "P2", "P3", "P4"])
    return i.read(spark, sf_dir, "orders").select("o_orderkey", entity.alias("entity"), period.alias("period"))


def defect_inject(spark, sf_dir):
    return i.read(spark, sf_dir, "customer").select("c_custkey", assign.without_last(F.col("c_custkey"), 1000, 50, F.col("c_mktsegment")).alias("c_mktsegment"))


def derived_keys(spark, sf_dir):
    return i.read(spark, sf_dir, "orders").select("o_orderkey", assign.derived_key(F.col("o_orderkey").cast("string"), F.col("o_orderstatus")).alias("row_key"))


def cohort_keys(spark, sf_dir):
    return assign.cohort_keys(i.read(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


def hash_buckets(spark, sf_dir):
    return i.read(spark, sf_dir, "orders").groupBy(assign.hash_bucket(["o_orderkey"], 16).alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))


def evaluated(spark, sf_dir):
    """Labels of documents with a score made from their length, and the score's decision at one half."""
    score = F.round(F.least(F.col("n_chars"), F.lit(5000)) / 5000.0, 4)
    rows = i.read(spark, sf_dir, "labels").join(i.read(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    return rows.select("doc_id", "lang", "toxic", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def avg_precision(spark, sf_dir):
    return i.round_columns(metrics.average_precision(metrics.checked(evaluated(spark, sf_dir), "toxic", "score"), "toxic", "score", "doc_id"), ["average_precision"])


def top_k_recall(spark, sf_dir):
    return i.round_columns(metrics.top_k_metrics(evaluated(spark, sf_dir), "toxic", "score", "doc_id"), ["recall", "precision"])


def clicked(spark, sf_dir):
    """Every event with a score made from its value, and whether it is a purchase; many events share a score.

    Scores are rounded by the value of the double, as the SQL does it: F.round to places goes by its shortest decimal form, where 0.5035 is half way.
    """
    score = F.round(F.least(F.col("value"), F.lit(500.0)) / 500.0 * 1000.0) / 1000.0
    return i.read(spark, sf_dir, "events").select("event_id", (F.col("event_type") == "purchase").cast("int").alias("label"), score.alias("score"))


FRACTIONS = [0.1, 0.3, 0.6, 0.9]


def top_k_ladder(spark, sf_dir):
    return i.round_columns(metrics.top_k_ladder(clicked(spark, sf_dir), "label", "score", "event_id", FRACTIONS), ["recall", "precision"])


def ranked_scores(spark, sf_dir):
    return metrics.ranked(clicked(spark, sf_dir), "score", "event_id", ["label"]).select("event_id", "rank", "running_label")


def calibration_error(spark, sf_dir):
    return i.round_columns(metrics.calibration_error(evaluated(spark, sf_dir), "toxic", "score"), ["calibration_error"])


def audited(spark, sf_dir):
    """evaluated, with the cohort of a table that knows only documents with an even id: the others have none."""
    cohorts = i.read(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("cohort"))
    return evaluated(spark, sf_dir).join(cohorts, "doc_id", "left")


def cohort_error_rates(spark, sf_dir):
    return i.round_columns(metrics.cohort_errors(audited(spark, sf_dir), "toxic", "predicted", "cohort"), ["false_positive_rate", "false_negative_rate"])


def fairness_gap(spark, sf_dir):
    return i.round_columns(metrics.fairness_gap(metrics.cohort_errors(evaluated(spark, sf_dir), "toxic", "predicted", "lang")), ["false_positive_rate_gap", "false_negative_rate_gap"])


def rule_score(spark, sf_dir):
    f = feeds.all_features(spark, sf_dir)
    score = metrics.rule_score(F.col("rate_28d"), F.col("missed_28d"), F.col("o_orderstatus") == "O", F.col("days_since_activity"), F.col("prior_flags"))
    return f.select("entity_id", "as_of", F.round(score, 6).alias("risk_score"))


def logistic_score(spark, sf_dir):
    score = metrics.logistic_score(-2.0, [(0.5, F.col("value") / 10), (1.25, F.col("event_type") == "error"), (-0.75, F.col("event_type") == "purchase")])
    return i.read(spark, sf_dir, "events").select("event_id", F.round(score, 6).alias("score"))


def chrono_split(spark, sf_dir):
    days = i.read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return metrics.chronological_split(days, "day").groupBy("split").agg(F.count(F.lit(1)).alias("row_count"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


#: What no model may see, whatever list it is on.
DENIED = ("entity_id", "as_of", "label", "max_feature_event_at", "o_orderstatus")
NUMERIC, CATEGORICAL = ["rate_28d", "missed_28d", "support_90d", "days_since_activity", "current", "prior_sum", "prior_flags"], ["program", "o_orderpriority"]


def training_rows(spark, sf_dir):
    """Features at each cutoff with the label whether the entity's score tier is high at it."""
    label = (F.expr(i.score_sql(7919).replace("c_custkey", "entity_id")) >= 0.6).cast("int")
    return feeds.all_features(spark, sf_dir).withColumn("label", label)


def feature_policy(spark, sf_dir):
    """The training rows as a model may see them: what is on the list of features and not denied."""
    rows = training_rows(spark, sf_dir)
    own = model.feature_columns(rows, [*NUMERIC, *CATEGORICAL, "o_orderstatus"], DENIED)
    return i.round_columns(rows.select("entity_id", "as_of", *own), ["rate_28d", "current", "prior_sum"])


def allowed(df):
    """The features that the policy lets through, numbers and categories."""
    own = model.feature_columns(df, NUMERIC + CATEGORICAL, DENIED)
    return [c for c in NUMERIC if c in own], [c for c in CATEGORICAL if c in own]


def fit_and_score(spark, sf_dir):
    """The latest period scored by a model of those before it. The features are made once, as each step of a fit reads them anew."""
    rows = kept(metrics.chronological_split(training_rows(spark, sf_dir), "as_of"))
    numeric, categorical = allowed(rows)
    fitted = model.fit_logistic(rows.where("split = 'train'").drop("split"), "label", numeric, categorical)
    return model.scored(fitted, rows.where("split = 'validation'"), ["entity_id", "as_of"])


def model_gates(spark, sf_dir):
    """Three candidates by their metrics on the latest period, with the one that is chosen."""
    rows = kept(metrics.chronological_split(training_rows(spark, sf_dir), "as_of"))
    numeric, categorical = allowed(rows)
    train, check = rows.where("split = 'train'").drop("split"), rows.where("split = 'validation'").drop("split")
    rule = check.withColumn("risk_score", metrics.rule_score(F.col("rate_28d"), F.col("missed_28d"), F.col("o_orderstatus") == "O", F.col("days_since_activity"), F.col("prior_flags")))
    fits = [model.fit_logistic(train, "label", numeric, categorical), model.fit_boosted(train, "label", numeric, categorical)]
    out = None
    for k, (name, scores) in enumerate(zip(("rule", "logistic", "boosted"), [rule, *(model.risk_scores(m, check) for m in fits)])):
        own = kept(scores.select("entity_id", "label", "risk_score"))
        one = metrics.ranking_metrics(own, "label", "risk_score", "entity_id", [0.1]).select("average_precision", F.col("top")[0]["recall"].alias("top_k_recall")).crossJoin(F.broadcast(metrics.calibration_error(own, "label", "risk_score")))  # one row each
        one = one.select(F.lit(name).alias("candidate"), F.lit(k).alias("complexity"), "*")
        out = one if out is None else out.unionByName(one)
    return metrics.gated(out)


def leading_factors(spark, sf_dir):
    f = feeds.all_features(spark, sf_dir)
    names = ["missed_28d", "support_90d", "prior_flags", "days_since_activity"]
    return f.select("entity_id", "as_of", F.array_join(metrics.leading_factors(names, [F.col(n) for n in names], [2.0, 3.0, 4.0, 500.0], [0.5, 0.25, 1.0, 0.0625]), ",").alias("factors"))


PROMPT, MODEL = "briefing-v1", "text-model-1"


def facts(spark, sf_dir):
    rows = products.context(spark, sf_dir).select("entity_id", "risk_score", "risk_tier", F.col("rate_28d").alias("attendance_rate_28d"), F.col("missed_28d").alias("missed_assignments_28d"), F.col("days_since_activity").alias("days_since_lms_activity"), F.when(F.col("entity_id") % 3 > 0, F.col("entity_id") % 2 == 0).alias("financial_hold_flag"), F.array(F.lit("missed_assignments_28d"), F.lit("program"), F.lit("risk_tier")).alias("leading_factors"))
    return text.fact_payload(rows, "entity_id")


def fact_payload(spark, sf_dir):
    return facts(spark, sf_dir).select("entity_id", F.array_join(F.transform("facts", lambda x: x["id"]), ",").alias("ids"), F.array_join("contributing_factors", ",").alias("factors"))


def render_facts(spark, sf_dir):
    return facts(spark, sf_dir).select("entity_id", text.rendered(F.filter("facts", lambda x: x["id"].isin("risk_tier", "missed_assignments_28d", "days_since_lms_activity", "financial_hold_flag"))).alias("briefing"))


def responses(spark, sf_dir):
    """A response for each entity, spoiled in one of eight ways by its id."""
    k = F.col("entity_id") % 8
    items = F.transform("facts", lambda x: F.concat(F.lit('{"fact_id":"'), x["id"], F.lit('","fact_value":'), F.when((k == 1) & (x["id"] == "risk_tier"), F.lit('"none"')).otherwise(x["value"]), F.lit("}")))
    ids = F.transform("facts", lambda x: F.concat(F.lit('"'), x["id"], F.lit('"')))
    body = F.concat(
        F.lit('{"briefing":['), F.array_join(items, ","), F.lit('],"suggested_action":"'), F.when(k == 2, "call_home").otherwise("ask_about_barriers"), F.lit('","citations":['), F.array_join(F.when(k == 3, F.reverse(ids)).otherwise(ids), ","),
        F.lit('],"unsupported_claims":['), F.when(k == 4, '"x"').otherwise(""), F.lit('],"prompt_version":"'), F.when(k == 5, "briefing-v0").otherwise(PROMPT), F.lit(f'","model_id":"{MODEL}"}}'))
    return facts(spark, sf_dir).select("entity_id", "facts", F.when(k == 6, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 7, F.concat(body, F.lit(" as asked"))).otherwise(body).alias("raw"))


def validate_response(spark, sf_dir):
    return text.validated(responses(spark, sf_dir), "raw", "facts", PROMPT, MODEL).select("entity_id", "error")


def grounding_score(spark, sf_dir):
    return text.grounding(responses(spark, sf_dir), "raw", "facts").select("entity_id", F.round("coverage", 6).alias("coverage"), F.array_join("unsupported", ",").alias("unsupported"))


def prohibited_scan(spark, sf_dir):
    said = i.read(spark, sf_dir, "conversations").withColumn("said", F.when(F.col("turn") % 5 == 0, F.concat("text", F.lit(" Probation will improve retention"))).when(F.col("turn") % 5 == 1, F.concat("text", F.lit(" MENTAL health"))).otherwise(F.col("text")))
    return said.groupBy(text.first_prohibited(F.col("said")).cast("long").alias("phrase")).agg(F.count(F.lit(1)).alias("row_count"))


def redact_text(spark, sf_dir):
    return i.read(spark, sf_dir, "documents").select("doc_id", F.md5(text.redacted(F.col("text"))).alias("redacted_md5"))


def secret_scan(spark, sf_dir):
    return text.secret_scan(i.read(spark, sf_dir, "documents"), "doc_id", "text")


def summary_records(spark, sf_dir):
    rows = text.summary_records(responses(spark, sf_dir), "entity_id", "raw", "facts", PROMPT, MODEL)
    return rows.select("entity_id", "summary_key", "generation_status", "evaluation_status", F.col("briefing").isNotNull().alias("has_briefing"), "suggested_action", F.array_join("citations", ",").alias("citations"), F.size("unsupported_claims").cast("long").alias("unsupported"), "error_message")


def pseudonyms(spark, sf_dir):
    key = F.col("c_custkey")
    return i.read(spark, sf_dir, "customer").select("c_custkey", assign.padded_id("C", key).alias("customer_id"), assign.pseudonym(assign.padded_id("C", key)).alias("pseudonym"))


def publication_gate(spark, sf_dir):
    """Gate metrics of the labelled documents, by language: the least share over the languages decides."""
    rows = i.read(spark, sf_dir, "labels").join(i.read(spark, sf_dir, "documents"), "doc_id").groupBy("lang").agg(
        F.max("quality").cast("double").alias("citation_coverage"), F.avg("quality").alias("grounding"), F.avg(F.when(text.first_prohibited(F.col("text")).isNull(), 1.0).otherwise(0.0)).alias("prohibited_claims"), F.avg(1.0 - F.col("toxic")).alias("safety"))
    names = ("citation_coverage", "grounding", "prohibited_claims", "safety")
    rows = rows.select(F.explode(F.array(*[F.struct(F.concat(F.lit(f"{n}/"), "lang").alias("name"), F.col(n).alias("value")) for n in names])).alias("r")).select("r.*")
    return text.publication_gate(rows).select("metric", F.round("value", 6).alias("value"), "passed")


QUERIES = {f.__name__: f for f in (
    insert_only_append, upsert_by_key, conditional_update, schema_evolve, run_partitions, cohort_assign, bucket_ladder, period_expand, defect_inject, derived_keys, cohort_keys, hash_buckets, avg_precision, top_k_recall, top_k_ladder, ranked_scores, feature_policy, calibration_error,
    cohort_error_rates, fairness_gap, rule_score, logistic_score, chrono_split, fit_and_score, model_gates, leading_factors, fact_payload, render_facts, validate_response, grounding_score, prohibited_scan, redact_text, secret_scan, publication_gate, summary_records, pseudonyms)}

_EVAL = "(SELECT l.doc_id, d.lang, l.toxic, round(least(n_chars, 5000) / 5000.0::DOUBLE, 4) AS score, CASE WHEN round(least(n_chars, 5000) / 5000.0::DOUBLE, 4) >= 0.5 THEN 1 ELSE 0 END AS predicted FROM labels l JOIN documents d USING (doc_id))"
_RANKED = f"(SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, sum(toxic) OVER (ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING) AS hits, count(*) OVER () AS n, sum(toxic) OVER () AS positives FROM {_EVAL})"
_CLICKED = "(SELECT *, row_number() OVER (ORDER BY score DESC, event_id) AS rank, sum(label) OVER (ORDER BY score DESC, event_id ROWS UNBOUNDED PRECEDING) AS hits, count(*) OVER () AS n, sum(label) OVER () AS positives FROM (SELECT event_id, (event_type = 'purchase')::INT AS label, round(least(value, 500.0) / 500.0::DOUBLE, 3) AS score FROM events))"
_AUDIT = "SELECT CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'UNKNOWN' END AS cohort, count(*) AS row_count, coalesce(count(*) FILTER (toxic = 0 AND predicted = 1) / nullif(count(*) FILTER (toxic = 0), 0), 0.0) AS false_positive_rate, coalesce(count(*) FILTER (toxic = 1 AND predicted = 0) / nullif(count(*) FILTER (toxic = 1), 0), 0.0) AS false_negative_rate FROM " + _EVAL + " GROUP BY ALL"
_ERRORS = f"SELECT lang, count(*) AS row_count, coalesce(count(*) FILTER (toxic = 0 AND predicted = 1) / nullif(count(*) FILTER (toxic = 0), 0), 0.0) AS false_positive_rate, coalesce(count(*) FILTER (toxic = 1 AND predicted = 0) / nullif(count(*) FILTER (toxic = 1), 0), 0.0) AS false_negative_rate FROM {_EVAL} GROUP BY ALL"
_AB = lambda f: f"((((c_custkey % 10000) * {f[0] % 10000} + {SEED * f[1] % 10000}) % 10000 + 10000) % 10000)"
_PIT = "SELECT a.entity_id, a.as_of, rate_28d, missed_28d, support_90d, days_since_activity, o_orderstatus, prior_flags FROM f_rate a JOIN f_counts USING (entity_id, as_of) JOIN f_state USING (entity_id, as_of) JOIN f_hist USING (entity_id, as_of)"
_CLIP = lambda c, h: f"greatest(least(({c})::DOUBLE, {h}.0), 0.0)"
_HOLD = "CASE WHEN entity_id % 3 > 0 THEN entity_id % 2 = 0 END"
_FACTS = f"(SELECT *, {_HOLD} AS hold FROM ctx)"
_SECRET_STEPS = [(r"(Authorization\s*:\s*Bearer\s+)[A-Za-z0-9._-]{12,}", r"\1[REDACTED]", "gi"), (r"\bdapi[A-Za-z0-9]{12,}\b", "[REDACTED]", "gi"), (r"\b(client_secret|oauth_token|access_token|refresh_token|workspace_token)(\s*[=:]\s*)\[REDACTED\]", r"\1\2;<kept>", "gi"), (r"\b(client_secret|oauth_token|access_token|refresh_token|workspace_token)(\s*[=:]\s*)[^\s,;\"'']+", r"\1\2[REDACTED]", "gi"), (";<kept>", "[REDACTED]", "g"), (r"\b(postgres(?:ql)?://[^\s:/]+:)[^\s@]+(@[^\s]+)", r"\1[REDACTED]\2", "gi"), (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[REDACTED]", "g")]
_REDACTED = "text"
for _find, _put, _how in _SECRET_STEPS:
    _REDACTED = f"regexp_replace({_REDACTED}, '{_find}', '{_put}', '{_how}')"
_says = lambda pattern, column: f"regexp_matches({column}, '{pattern}', 'i')"
_ANY = " OR ".join(_says(p, "text") for p in text.PROHIBITED)
_FAULT = "CASE entity_id % 8 " + " ".join(f"WHEN {k} THEN '{text.FAULTS[name]}'" for k, name in ((1, "value"), (2, "action"), (3, "cited"), (4, "unsupported"), (5, "prompt"), (7, "json"))) + " END"
_N_FACTS = "(6 + (hold IS NOT NULL)::INT)"
_SCORES2 = "SELECT entity_id, as_of, risk_score, model_version, scored_at, CASE WHEN risk_score >= 0.6 THEN 'high' WHEN risk_score >= 0.3 THEN 'medium' ELSE 'low' END AS risk_tier FROM scores"
_FACTOR = lambda n, m, w: f"{{'c': -abs(({n}::DOUBLE - {m}) * {w}), 'n': '{n}'}}"

ORACLES = {k: i.sql(v) for k, v in {
    "insert_only_append": _SCORES2,
    "upsert_by_key": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0",
    "conditional_update": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus = 'F' THEN 'checked' ELSE o_orderpriority END AS o_orderpriority FROM orders",
    "schema_evolve": "SELECT c_custkey, c_mktsegment, NULL::TIMESTAMP AS reviewed_at, NULL::VARCHAR AS reviewer FROM customer",
    "run_partitions": "SELECT CASE WHEN event_id % 2 = 0 THEN DATE '2024-01-29' ELSE DATE '2024-01-30' END AS run_date, count(*) AS row_count FROM events GROUP BY ALL",
    "cohort_assign": f"SELECT c_custkey, {_AB(assign.COHORT)} < 150 AS in_cohort, {_AB(assign.PROPENSITY)}::BIGINT AS propensity FROM customer",
    "bucket_ladder": f"SELECT c_custkey, CASE WHEN b < 2500 THEN 'NONE' WHEN b < 5000 THEN 'LOW' WHEN b < 8600 THEN 'MEDIUM' ELSE 'HIGH' END AS band, round(5.0::DOUBLE + pow(b / 10000.0::DOUBLE, 2.0::DOUBLE) * 100.0::DOUBLE, 2) AS amount FROM (SELECT c_custkey, {_AB(assign.PROPENSITY)} AS b FROM customer)",
    "period_expand": "SELECT o_orderkey, o_orderkey % 4000 AS entity, ['P1', 'P2', 'P3', 'P4'][(o_orderkey // 4000 + 1)::INT] AS period FROM orders",
    "defect_inject": "SELECT c_custkey, CASE WHEN c_custkey < 950 THEN c_mktsegment END AS c_mktsegment FROM customer",
    "derived_keys": "SELECT o_orderkey, sha256(o_orderkey::VARCHAR || '|' || o_orderstatus) AS row_key FROM orders",
    "cohort_keys": "SELECT o_orderpriority, sha256(array_to_string(list_sort(list(DISTINCT o_orderkey::VARCHAR)), '|')) AS cohort_key FROM orders GROUP BY ALL",
    "avg_precision": f"SELECT round(coalesce(sum(CASE WHEN toxic = 1 THEN hits / rank END) / nullif(max(positives), 0), 0.0), 6) AS average_precision FROM {_RANKED}",
    "top_k_recall": f"SELECT max(k)::BIGINT AS k, round(coalesce(sum(toxic) FILTER (rank <= k) / nullif(max(positives), 0), 0.0), 6) AS recall, round(sum(toxic) FILTER (rank <= k) / max(k), 6) AS precision FROM (SELECT *, greatest(1, round_even(n * 0.1::DOUBLE, 0)) AS k FROM {_RANKED})",
    "top_k_ladder": f"SELECT f AS fraction, k::BIGINT AS k, round(coalesce(sum(label) FILTER (rank <= k) / nullif(max(positives), 0), 0.0), 6) AS recall, round(sum(label) FILTER (rank <= k) / max(k), 6) AS precision FROM (SELECT *, greatest(1, round_even(n * f, 0)) AS k FROM {_CLICKED}, (SELECT unnest({FRACTIONS}::DOUBLE[]) AS f)) GROUP BY ALL",
    "ranked_scores": f"SELECT event_id, rank, hits::BIGINT AS running_label FROM {_CLICKED}",
    "hash_buckets": f"SELECT (({hashing.SIGNED} % 16) + 16)::BIGINT % 16 AS bucket, count(*) AS row_count FROM {hashing.with_hash('(SELECT o_orderkey FROM orders)', [('o_orderkey', 'long')])} GROUP BY ALL",
    "feature_policy": f"SELECT a.entity_id, a.as_of, missed_28d, support_90d, days_since_activity, prior_flags, c.c_mktsegment AS program, o_orderpriority, {i.rounded(['rate_28d', 'current', 'prior_sum'], [])} FROM f_rate a JOIN f_counts b USING (entity_id, as_of) JOIN f_state d USING (entity_id, as_of) JOIN f_hist e USING (entity_id, as_of) JOIN customer c ON c.c_custkey = a.entity_id",
    "calibration_error": f"SELECT round(sum(n * gap) / sum(n), 6) AS calibration_error FROM (SELECT least(floor(score * 10), 9) AS bin, count(*) AS n, abs(avg(score) - avg(toxic)) AS gap FROM {_EVAL} GROUP BY 1)",
    "cohort_error_rates": f"SELECT {i.rounded(['false_positive_rate', 'false_negative_rate'], ['cohort', 'row_count'])} FROM ({_AUDIT})",
    "fairness_gap": f"SELECT round(max(false_positive_rate) - min(false_positive_rate), 6) AS false_positive_rate_gap, round(max(false_negative_rate) - min(false_negative_rate), 6) AS false_negative_rate_gap FROM ({_ERRORS})",
    "rule_score": f"SELECT entity_id, as_of, round({_CLIP(f'''0.35 * (1.0::DOUBLE - {_CLIP('rate_28d', 1)}) + 0.20 * {_CLIP('missed_28d', 4)} / 4 + 0.20 * (o_orderstatus = 'O')::INT::DOUBLE + 0.15 * {_CLIP('days_since_activity', 60)} / 60 + 0.10 * {_CLIP('prior_flags', 2)} / 2''', 1)}, 6) AS risk_score FROM ({_PIT})",
    "logistic_score": "SELECT event_id, round(1 / (1 + exp(-(-2.0::DOUBLE + 0.5 * (value / 10) + 1.25 * (event_type = 'error')::INT + -0.75 * (event_type = 'purchase')::INT))), 6)::DOUBLE AS score FROM events",
    "chrono_split": "SELECT CASE WHEN ts::DATE = (SELECT max(ts::DATE) FROM events) THEN 'validation' ELSE 'train' END AS split, count(*) AS row_count, min(ts::DATE) AS first_day, max(ts::DATE) AS last_day FROM events GROUP BY ALL",
    "leading_factors": f"SELECT entity_id, as_of, array_to_string([x.n FOR x IN list_sort([{_FACTOR('missed_28d', 2.0, 0.5)}, {_FACTOR('support_90d', 3.0, 0.25)}, {_FACTOR('prior_flags', 4.0, 1.0)}, {_FACTOR('days_since_activity', 500.0, 0.0625)}])[1:3]], ',') AS factors FROM ({_PIT})",
    "fact_payload": f"SELECT entity_id, 'risk_score,risk_tier,attendance_rate_28d,missed_assignments_28d,days_since_lms_activity' || CASE WHEN hold IS NOT NULL THEN ',financial_hold_flag' ELSE '' END AS ids, 'missed_assignments_28d,risk_tier' AS factors FROM {_FACTS}",
    "render_facts": f"SELECT entity_id, 'Current governed risk tier is ' || risk_tier || ' [risk_tier]. ' || missed_28d || ' assignments were missed in the last 28 days [missed_assignments_28d]. Most recent LMS activity was ' || days_since_activity || ' days ago [days_since_lms_activity].' || CASE hold WHEN true THEN ' A financial hold is active [financial_hold_flag].' WHEN false THEN ' No financial hold is active [financial_hold_flag].' ELSE '' END AS briefing FROM {_FACTS}",
    "validate_response": f"SELECT entity_id, {_FAULT} AS error FROM ctx",
    "grounding_score": f"SELECT entity_id, round(CASE entity_id % 8 WHEN 1 THEN (n - 1) / n WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 7 THEN 0.0 ELSE 1.0 END, 6)::DOUBLE AS coverage, CASE WHEN entity_id % 8 = 1 THEN 'risk_tier' ELSE '' END AS unsupported FROM (SELECT *, ({_N_FACTS} - 1)::DOUBLE AS n FROM {_FACTS})",
    "prohibited_scan": f"SELECT CASE {' '.join(f'WHEN {_says(p, "said")} THEN {k}' for k, p in enumerate(text.PROHIBITED))} END::BIGINT AS phrase, count(*) AS row_count FROM (SELECT CASE turn % 5 WHEN 0 THEN text || ' Probation will improve retention' WHEN 1 THEN text || ' MENTAL health' ELSE text END AS said FROM conversations) GROUP BY ALL",
    "redact_text": f"SELECT doc_id, md5({_REDACTED}) AS redacted_md5 FROM documents",
    "secret_scan": f"SELECT doc_id FROM documents WHERE {_REDACTED} <> text",
    "publication_gate": f"""WITH m AS (SELECT lang, max(quality)::DOUBLE AS citation_coverage, avg(quality)::DOUBLE AS grounding, avg(1.0::DOUBLE - toxic) AS safety,
            avg(CASE WHEN {_ANY} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS prohibited_claims
            FROM labels JOIN documents USING (doc_id) GROUP BY lang),
        v AS (SELECT 'citation_coverage' AS metric, min(citation_coverage) AS value FROM m UNION ALL SELECT 'grounding', min(grounding) FROM m UNION ALL SELECT 'prohibited_claims', min(prohibited_claims) FROM m UNION ALL SELECT 'safety', min(safety) FROM m UNION ALL SELECT 'guidelines', NULL)
        SELECT metric, round(value, 6) AS value, coalesce(value = 1.0, false) AS passed FROM v""",
    "summary_records": f"""SELECT entity_id, sha256(entity_id::VARCHAR || '|briefing-v1|text-model-1') AS summary_key, CASE WHEN ok THEN 'succeeded' ELSE 'failed' END AS generation_status, CASE WHEN ok THEN 'pending' ELSE 'not_evaluated' END AS evaluation_status, ok AS has_briefing,
            CASE WHEN ok THEN 'Invite the student to discuss any barriers they would like support addressing.' END AS suggested_action, CASE WHEN ok THEN 'risk_score,risk_tier,attendance_rate_28d,missed_assignments_28d,days_since_lms_activity' || CASE WHEN hold IS NOT NULL THEN ',financial_hold_flag' ELSE '' END ELSE '' END AS citations, 0::BIGINT AS unsupported,
            {_FAULT} AS error_message
        FROM (SELECT *, entity_id % 8 IN (0, 6) AS ok FROM {_FACTS})""",
    "pseudonyms": "SELECT c_custkey, 'C' || lpad(c_custkey::VARCHAR, 6, '0') AS customer_id, sha256('C' || lpad(c_custkey::VARCHAR, 6, '0'))[1:12] AS pseudonym FROM customer",
}.items()}
