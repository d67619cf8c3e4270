import datetime as dt

import pytest
from pyspark.sql import functions as F

from earlymark.functions import assign, text
from earlymark.operators import metrics, products, rollups
from earlymark.sources import sinks

AT = dt.datetime(2026, 9, 21)
ROWS = "entity_id string, program string, cohort string, term string, score_date date, risk_tier string, intervention_status string, outcome_status string, scored_at timestamp_ntz, first_intervention_at timestamp_ntz, follow_up_due boolean, follow_up_completed boolean, exposure double"


def test_executive_measures(spark):
    row = lambda i, tier, status, outcome, first, due, done, exposure: (i, "P", "C", "T", AT.date(), tier, status, outcome, AT, first, due, done, exposure)
    rows = [row("S1", "high", "open", "PERSISTED", AT + dt.timedelta(days=2), True, True, 7000.0), row("S2", "high", "open", "LEFT", AT + dt.timedelta(days=1, hours=12), True, False, 5000.0), row("S3", "high", "open", None, AT - dt.timedelta(days=9), False, False, 0.0)]
    r = products.executive_metrics(spark.createDataFrame(rows, ROWS)).first()
    assert (r.entity_count, r.at_risk_count, r.intervention_coverage, r.days_to_first_intervention, r.follow_up_completion_rate, r.exposure) == (3, 3, 1.0, 1.75, 0.5, 12000.0)
    assert round(r.retention_rate, 6) == 0.333333 and r.observed_retention_rate == 0.5
    low = products.executive_metrics(spark.createDataFrame([row("S4", "low", "not_started", None, None, False, False, 1.0)], ROWS)).first()
    assert low.intervention_coverage is None and low.follow_up_completion_rate is None and low.exposure == 0.0


def test_latest_scores_take_odd_versions(spark):
    rows = [("e", AT, AT, 0.1, "9"), ("e", AT, AT, 0.2, "10"), ("e", AT, AT, 0.3, "beta"), ("e", AT - dt.timedelta(1), AT, 0.9, "99")]
    assert products.latest_scores(spark.createDataFrame(rows, "entity_id string, as_of timestamp_ntz, scored_at timestamp_ntz, risk_score double, model_version string")).first().risk_score == 0.2


@pytest.mark.parametrize(("score", "tier"), [(0.2999, "low"), (0.3, "medium"), (0.5999, "medium"), (0.6, "high")])
def test_tiers(spark, score, tier):
    assert spark.range(1).select(products.risk_tier(F.lit(score))).first()[0] == tier


def test_serving_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert products.serving_snapshot(df, ["k"], "gold", "serving", {"log"}).count() == 2
    with pytest.raises(ValueError):
        products.serving_snapshot(df, ["k"], "log", "serving", {"log"})
    for bad in (df.unionByName(df), spark.createDataFrame([(None, "a")], "k int, v string")):
        with pytest.raises(Exception, match="null or repeated"):
            products.serving_snapshot(bad, ["k"], "gold", "serving", {"log"}).collect()


def test_model_metrics(spark):
    df = spark.createDataFrame([(0, 1, 0.9, "a"), (1, 0, 0.8, "a"), (2, 1, 0.7, "b"), (3, 0, 0.1, "b")], "id int, y int, s double, c string")
    assert round(metrics.average_precision(df, "y", "s", "id").first()[0], 6) == round(5 / 6, 6)
    r = metrics.top_k_metrics(df, "y", "s", "id", 0.5).first()
    assert (r.k, r.recall, r.precision) == (2, 0.5, 0.5)
    assert metrics.average_precision(df.where("y = 0"), "y", "s", "id").first()[0] == 0.0
    assert abs(metrics.calibration_error(df, "y", "s", 2).first()[0] - (0.75 * abs(0.8 - 2 / 3) + 0.25 * 0.1)) < 1e-9
    errors = metrics.cohort_errors(df.withColumn("p", (F.col("s") > 0.5).cast("int")), "y", "p", "c")
    assert {r.c: (r.false_positive_rate, r.false_negative_rate) for r in errors.collect()} == {"a": (1.0, 0.0), "b": (0.0, 0.0)}
    assert metrics.fairness_gap(errors).first()[0] == 1.0
    with pytest.raises(Exception, match="labels must be"):
        metrics.checked(df.withColumn("y", F.lit(2)), "y", "s").collect()
    with pytest.raises(Exception, match="two periods"):
        metrics.chronological_split(df.withColumn("p", F.lit(1)), "p").collect()


def test_two_pass_ranks(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7 / 7).alias("s"), F.lit(1).alias("one"))
    rows = metrics.ranked(df, "s", "id", ["one"], parts=5).collect()
    assert [r.id for r in sorted(rows, key=lambda r: r["rank"])] == sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert all(r["rank"] == r.running_one for r in rows)


def test_gates(spark):
    rows = [("rule", 0, 0.1, 0.9, 0.0), ("logistic", 1, 0.5, 0.5, 0.05), ("boosted", 2, 0.9, 0.9, 0.01)]
    schema = "candidate string, complexity int, average_precision double, top_k_recall double, calibration_error double"
    assert [r.candidate for r in metrics.gated(spark.createDataFrame(rows, schema)).where("chosen").collect()] == ["logistic"]
    worse = [(n, k, a, 0.0, 1.0) for n, k, a, *_ in rows]
    assert [r.candidate for r in metrics.gated(spark.createDataFrame(worse, schema)).where("chosen").collect()] == ["boosted"]


def test_rule_and_logistic_scores(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    score = lambda *v: one(metrics.rule_score(*map(F.lit, v)))
    assert score(1.0, 0, False, 0, 0) == 0 and abs(score(0.0, 9, True, 999, 5) - 1) < 1e-12
    assert one(metrics.logistic_score(0.0, [(2.0, F.lit(3))])) - one(metrics.logistic_score(0.0, [(2.0, F.lit(0))])) >= 0.45


def test_top_k_rejects_negative(spark):
    with pytest.raises(ValueError):
        rollups.top_k(spark.range(3), -1, [F.asc("id")])


def test_cohort_share(spark):
    n = spark.range(20_000).where(assign.in_cohort(F.col("id"), 20_260_921)).count()
    assert 200 <= n <= 400
    assert spark.range(1000).select(assign.propensity(F.col("id"), 20_260_921)).distinct().count() > 900


def test_table_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    target, source = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (2, "b")], [(2, "x"), (3, "c"), (3, "c")]))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sinks.read_table(spark, path, target.schema)) == []
    sinks.write_version(target, path)
    for _ in range(2):
        sinks.write_version(sinks.insert_only(sinks.read_table(spark, path), source, ["k"]), path, ["k"])
    assert rows(sinks.read_table(spark, path)) == [(1, "a"), (2, "b"), (3, "c")] and sinks.versions(spark, path) == [1, 2, 3]
    assert rows(sinks.upsert(target, source.distinct(), ["k"])) == [(1, "a"), (2, "x"), (3, "c")]
    assert rows(sinks.update_where(target, spark.createDataFrame([(1, "n"), (2, "m"), (9, "z")], "k int, v string"), ["k"], ["v"], "v = 'b'")) == [(1, "a"), (2, "m")]


def test_redaction(spark):
    cases = {
        "Authorization: Bearer abcdefghijklmnop": "Authorization: Bearer [REDACTED]", "client_secret = s3cr3t, id 7": "client_secret = [REDACTED], id 7", "postgres://u:pw@host/db": "postgres://u:[REDACTED]@host/db",
        "mail a.b@c.org now": "mail [REDACTED] now", "access_token=ab[cd x": "access_token=[REDACTED] x", "refresh_token=[abc": "refresh_token=[REDACTED]", "oauth_token: [REDACTED]x": "oauth_token: [REDACTED]x", "my_token=abc csrf_token=1": "my_token=abc csrf_token=1", "S000017 retained 0.71": "S000017 retained 0.71",
    }
    got = {r.t: r.r for r in spark.createDataFrame([(t,) for t in cases], "t string").select("t", text.redacted(F.col("t")).alias("r")).collect()}
    assert got == cases
    one = spark.createDataFrame([("my_cloud_token=abc, id 7",)], "t string")
    assert [one.select(text.redacted(F.col("t"), n)).first()[0] for n in ((), ("my_cloud_token",))] == ["my_cloud_token=abc, id 7", "my_cloud_token=[REDACTED], id 7"]
    with pytest.raises(ValueError):
        text.redacted(F.col("t"), ("a|b",))


def test_all_sentences(spark):
    facts = [("risk_score", "0.75"), ("risk_tier", '"high"'), ("attendance_rate_28d", "0.5"), ("missed_assignments_28d", "2"), ("days_since_lms_activity", "12"), ("financial_hold_flag", "true"), ("cumulative_gpa", "3.25")]
    got = spark.createDataFrame([(facts,)], "f array<struct<id:string,value:string>>").select(text.rendered(F.col("f"))).first()[0]
    assert got == "Current governed risk score is 0.75 [risk_score]. Current governed risk tier is high [risk_tier]. Attendance was 50% in the last 28 days [attendance_rate_28d]. 2 assignments were missed in the last 28 days [missed_assignments_28d]. Most recent LMS activity was 12 days ago [days_since_lms_activity]. A financial hold is active [financial_hold_flag]. Cumulative GPA is 3.25 [cumulative_gpa]."


def test_response_checks(spark):
    facts = [("risk_score", "0.5"), ("financial_hold_flag", "false")]
    good = '{"briefing":[{"fact_id":"financial_hold_flag","fact_value":false}],"suggested_action":"ask_about_barriers","citations":["financial_hold_flag"],"unsupported_claims":[],"prompt_version":"p","model_id":"m"}'
    cases = [(good, None), (f"```json\n{good}\n```", None), (good.replace(":false", ":0"), "briefing fact value must exactly match the supplied fact"), (good.replace('"model_id":"m"', '"model_id":"n"'), "model_id does not match the selected endpoint"), ("no json", "model response is not strict JSON"), (good[:-1] + ',"x":1}', "response fields must exactly match the briefing schema"), (good.replace('"citations":["financial_hold_flag"]', '"citations":[]'), "citations must exactly match briefing fact IDs"), (good.replace("financial_hold_flag", "age"), "briefing fact is not an allowed fact ID")]
    swap = lambda a, b: good.replace(a, b)
    item = '{"fact_id":"financial_hold_flag","fact_value":false}'
    cases += [(swap(f"[{item}]", "[]"), text.FAULTS["briefing"]), (swap("ask_about_barriers", "call"), text.FAULTS["action"]), (swap('"citations":["financial_hold_flag"]', '"citations":"x"'), text.FAULTS["citations"]), (swap('"unsupported_claims":[]', '"unsupported_claims":1'), text.FAULTS["claims"])]
    cases += [(swap('"unsupported_claims":[]', '"unsupported_claims":["x"]'), text.FAULTS["unsupported"]), (swap('"prompt_version":"p"', '"prompt_version":"q"'), text.FAULTS["prompt"]), (swap(item, item[:-1] + ',"x":1}'), text.FAULTS["fact"]), (swap(item, f"{item},{item}"), text.FAULTS["repeated"])]
    df = spark.createDataFrame([(i, raw, facts) for i, (raw, _) in enumerate(cases)], "i int, raw string, facts array<struct<id:string,value:string>>")
    got = {r.i: r.error for r in text.validated(df, "raw", "facts", "p", "m").collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
