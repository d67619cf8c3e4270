"""Grounded text: facts, responses about them, and what must not be said or shown."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Approved facts, response fields, action codes, sentences, faults, prohibited phrases and secrets.
FACTS = ("attendance_rate_28d", "missed_assignments_28d", "days_since_lms_activity", "financial_hold_flag", "cumulative_gpa")
RESPONSE_FIELDS = ("briefing", "citations", "model_id", "prompt_version", "suggested_action", "unsupported_claims")
ACTIONS = {
    "offer_supportive_check_in": "Offer a supportive check-in and ask whether the student would like help identifying next steps.",
    "offer_resource_navigation": "Offer to help the student identify and navigate available support resources.",
    "ask_about_barriers": "Invite the student to discuss any barriers they would like support addressing.",
}
SENTENCES = {
    "risk_score": "Current governed risk score is %.2f",
    "risk_tier": "Current governed risk tier is %s",
    "attendance_rate_28d": "Attendance was %.0f%% in the last 28 days",
    "missed_assignments_28d": "%s assignments were missed in the last 28 days",
    "days_since_lms_activity": "Most recent LMS activity was %s days ago",
    "financial_hold_flag": "%s financial hold is active",
    "cumulative_gpa": "Cumulative GPA is %.2f",
}
FAULTS = {
    "json": "model response is not strict JSON",
    "fields": "response fields must exactly match the briefing schema",
    "briefing": "briefing must be a non-empty list of structured facts",
    "action": "suggested_action must be an approved action code",
    "citations": "citations must be a list of fact IDs",
    "claims": "unsupported_claims must be a list of strings",
    "unsupported": "unsupported claims cannot be accepted",
    "prompt": "prompt_version does not match the governed prompt",
    "model": "model_id does not match the selected endpoint",
    "fact": "briefing facts require exactly fact_id and fact_value",
    "unknown": "briefing fact is not an allowed fact ID",
    "value": "briefing fact value must exactly match the supplied fact",
    "repeated": "briefing facts must not repeat",
    "cited": "citations must exactly match briefing fact IDs",
    "prohibited": "prohibited claim: %s",
}
PROHIBITED = (
    r"\b(diagnos(?:e|ed|is|tic)|depression|anxiety|adhd|mental health)\b",
    r"\b(disciplin(?:ary|e|ed)|punish|punishment|probation|suspend|suspension|expel|expulsion)\b",
    r"\b(will|would|can|shall|may)\s+(cause|ensure|guarantee|improve|increase)\s+(?:the )?(?:student )?(?:to )?(retain|retention|persistence)\b",
    r"\b(first[ -]generation|gender|race|ethnicity|age band|residency status|female|male|nonbinary)\b",
)
REDACTED = "[REDACTED]"
SECRETS = (
    (r"(?i)(Authorization\s*:\s*Bearer\s+)[A-Za-z0-9._-]{12,}", "$1" + REDACTED),
    (r"(?i)\bdapi[A-Za-z0-9]{12,}\b", REDACTED),
    (r"(?i)\b(client_secret|oauth_token|access_token|refresh_token|workspace_token)(\s*[=:]\s*)(?!\[REDACTED\])[^\s,;\"']+", "$1$2" + REDACTED),
    (r"(?i)\b(postgres(?:ql)?://[^\s:/]+:)[^\s@]+(@[^\s]+)", "$1" + REDACTED + "$2"),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", REDACTED),
)
ERROR_LENGTH = 2000
GATE_METRICS = ("citation_coverage", "grounding", "prohibited_claims", "safety", "guidelines")


def redacted(text: Column, names: tuple[str, ...] = ()) -> Column:
    """text without credentials, connection passwords and addresses. names are further names of tokens (letters, digits and _), such as a platform's own."""
    if not all(re.fullmatch(r"\w+", n) for n in names):
        raise ValueError("names of tokens are letters, digits and _")
    more = [(rule.replace("workspace_token)", "|".join(["workspace_token", *names]) + ")"), put) for rule, put in SECRETS]
    return reduce(lambda t, rule: F.regexp_replace(t, F.lit(rule[0]), F.lit(rule[1])), more, text)


def has_secret(text: Column, names: tuple[str, ...] = ()) -> Column:
    return F.coalesce(redacted(text, names) != text, F.lit(False))


def secret_scan(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows that hold something to redact; a caller that publishes must find none."""
    return df.where(has_secret(F.col(text))).select(key)


def first_prohibited(text: Column) -> Column:
    """Number of the first prohibited phrase that the text has, null if none."""
    return F.coalesce(*[F.when(text.rlike(f"(?i){p}"), i) for i, p in enumerate(PROHIBITED)])


def fact_payload(df: DataFrame, key: str, fields: tuple[str, ...] = FACTS, factors: str = "leading_factors") -> DataFrame:
    """key, facts (id, value as JSON; score and tier first, nulls left out) and the leading factors among them.

    A score that is no finite number fails the job.
    """
    finite = F.when(F.isnan("risk_score") | F.col("risk_score").isin(float("inf"), float("-inf")) | F.col("risk_score").isNull(), F.raise_error(F.lit("risk_score must be finite")).cast("double")).otherwise(F.col("risk_score"))
    json = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"^\{\"v\":(.*)\}$", 1)
    fact = lambda name, c: F.when(c.isNotNull(), F.struct(F.lit(name).alias("id"), json(c).alias("value")))
    parts = F.array(fact("risk_score", finite), fact("risk_tier", F.col("risk_tier")), *[fact(f, F.col(f)) for f in fields if f in df.columns])
    facts = F.filter(parts, lambda x: x.isNotNull())
    supplied = F.transform(facts, lambda x: x["id"])
    return df.select(key, facts.alias("facts"), F.filter(F.coalesce(F.col(factors), F.array().cast("array<string>")), lambda x: F.array_contains(supplied, x)).alias("contributing_factors"))


def rendered(facts: Column) -> Column:
    """The only wording of facts that readers see, each with its id."""
    def sentence(x: Column) -> Column:
        number, tag = x["value"].try_cast("double"), F.concat(F.lit(" ["), x["id"], F.lit("]."))
        shown = {
            "risk_score": number, "attendance_rate_28d": number * 100, "cumulative_gpa": number, "risk_tier": F.regexp_replace(x["value"], '"', ""),
            "financial_hold_flag": F.when(x["value"] == "true", "A").otherwise("No"), "missed_assignments_28d": x["value"], "days_since_lms_activity": x["value"],
        }
        text = F.coalesce(*[F.when(x["id"] == name, F.format_string(SENTENCES[name], value)) for name, value in shown.items()])
        return F.concat(text, tag)

    return F.array_join(F.transform(facts, sentence), " ")


def unfenced(raw: Column) -> Column:
    """A response without the one code fence that it may stand in."""
    inner = F.regexp_extract(raw, r"(?s)\A```json\s*\n?(.*?)\n?```\s*\z", 1)
    return F.when(raw.rlike(r"(?s)\A```json\s*\n?.*?\n?```\s*\z"), inner).otherwise(raw)


def parsed_response(df: DataFrame, raw: str) -> DataFrame:
    """df with _json (the object's text; null if it isn't strict JSON) and its parts."""
    text = F.trim(unfenced(F.col(raw)))
    strict = F.when(text.startswith("{") & text.endswith("}") & F.expr("try_parse_json(_t) IS NOT NULL"), F.col("_t"))
    rows = df.withColumn("_t", text).withColumn("_json", strict)
    part = lambda name: F.get_json_object("_json", f"$.{name}")
    items = F.from_json(part("briefing"), "array<string>")
    return rows.select(
        *df.columns, "_json", F.array_sort(F.json_object_keys("_json")).alias("_keys"), *[part(f).alias(f"_{f}") for f in RESPONSE_FIELDS],
        items.alias("_items"), F.transform(items, lambda x: F.get_json_object(x, "$.fact_id")).alias("_ids"), F.transform(items, _value_text).alias("_values"))


def _value_text(item: Column) -> Column:
    """JSON text of fact_value: quotes stay, so "0" and 0, false and 0 differ."""
    return F.regexp_extract(item, r"\"fact_value\"\s*:\s*(\"(?:[^\"\\]|\\.)*\"|[^,}\s]+)", 1)


def validated(df: DataFrame, raw: str, facts: str, prompt_version: str, model_id: str) -> DataFrame:
    """df with error: null if the response says nothing but supplied facts in the agreed form, else the first fault."""
    rows = parsed_response(df, raw)
    strings = lambda c: F.from_json(c, "array<string>")
    known = F.map_from_entries(F.transform(F.col(facts), lambda f: F.struct(f["id"], f["value"])))
    each = F.arrays_zip(F.col("_ids").alias("i"), F.col("_values").alias("v"))
    words = F.concat_ws(" ", "_briefing", "_suggested_action")
    claims = strings(F.col("_unsupported_claims"))
    faults = {
        "json": F.col("_json").isNull(),
        "fields": F.col("_keys") != F.array(*map(F.lit, RESPONSE_FIELDS)),
        "briefing": ~F.col("_briefing").startswith("[") | (F.coalesce(F.size("_items"), F.lit(0)) < 1),
        "action": ~F.col("_suggested_action").isin(*ACTIONS),
        "citations": strings(F.col("_citations")).isNull(),
        "claims": claims.isNull(),
        "unsupported": F.size(claims) > 0,
        "prompt": F.col("_prompt_version") != prompt_version,
        "model": F.col("_model_id") != model_id,
        "fact": F.exists("_items", lambda x: F.coalesce(F.array_sort(F.json_object_keys(x)) != F.array(F.lit("fact_id"), F.lit("fact_value")), F.lit(True))),
        "unknown": F.exists("_ids", lambda x: ~F.coalesce(F.map_contains_key(known, x), F.lit(False))),
        "value": F.exists(each, lambda x: F.element_at(known, x["i"]) != x["v"]),
        "repeated": F.size(F.array_distinct("_ids")) != F.size("_ids"),
        "cited": strings(F.col("_citations")) != F.col("_ids"),
        "prohibited": first_prohibited(words).isNotNull(),
    }
    wording = lambda name: F.format_string(FAULTS[name], first_prohibited(words)) if name == "prohibited" else F.lit(FAULTS[name])
    error = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, broken in faults.items():  # the first one counts
        error = error.when(broken, wording(name))
    return rows.select(*df.columns, F.substring(error, 1, ERROR_LENGTH).alias("error"))


def grounding(df: DataFrame, raw: str, facts: str) -> DataFrame:
    """df with coverage (share of the briefing that is supplied facts, 0 if citations or action are off) and unsupported ids."""
    rows = parsed_response(df, raw)
    known = F.map_from_entries(F.transform(F.col(facts), lambda f: F.struct(f["id"], f["value"])))
    each = F.arrays_zip(F.col("_ids").alias("i"), F.col("_values").alias("v"))
    good = lambda x: F.coalesce(F.try_element_at(known, x["i"]) == x["v"], F.lit(False))
    n = F.coalesce(F.size("_items"), F.lit(0))
    cited = F.coalesce(F.from_json("_citations", "array<string>") == F.col("_ids"), F.lit(False))
    coverage = F.when((n > 0) & cited & F.coalesce(F.col("_suggested_action").isin(*ACTIONS), F.lit(False)), F.size(F.filter(each, good)) / n).otherwise(0.0)
    wrong = F.transform(F.filter(each, lambda x: ~good(x)), lambda x: x["i"])
    return rows.select(*df.columns, coverage.alias("coverage"), F.coalesce(wrong, F.array().cast("array<string>")).alias("unsupported"))


def action_text(code: Column) -> Column:
    """The agreed wording of an action code; null for any other code."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair]), code)


def summary_records(df: DataFrame, key: str, raw: str, facts: str, prompt_version: str, model_id: str) -> DataFrame:
    """One visible record for each response: what readers see of a valid one; status, error and empty lists of a faulty one.

    Neither kind holds a score. A failed record was not evaluated, any other awaits that.
    """
    checked = parsed_response(validated(df, raw, facts, prompt_version, model_id), raw)
    ok = F.col("error").isNull()
    shown = F.filter(facts, lambda x: F.array_contains("_ids", x["id"]))
    none = F.array().cast("array<string>")
    identity = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(prompt_version), F.lit(model_id)), 256)
    return checked.select(
        key, identity.alias("summary_key"), F.when(ok, "succeeded").otherwise("failed").alias("generation_status"), F.when(ok, "pending").otherwise("not_evaluated").alias("evaluation_status"),
        F.when(ok, rendered(shown)).alias("briefing"), F.when(ok, action_text(F.col("_suggested_action"))).alias("suggested_action"), F.when(ok, F.col("_ids")).otherwise(none).alias("citations"),
        none.alias("unsupported_claims"), F.col("error").alias("error_message"))


def publication_gate(metrics: DataFrame, required: tuple[str, ...] = GATE_METRICS) -> DataFrame:
    """metric, value, passed for each required metric from long rows (name, value): the least over name and name/…
    must be there, finite and exactly 1."""
    names = metrics.sparkSession.createDataFrame([(m,) for m in required], "metric string")
    found = metrics.select(F.split("name", "/")[0].alias("metric"), "value").groupBy("metric").agg(F.min("value").alias("value"), F.max(F.isnan("value")).alias("_nan"))
    return names.join(found, "metric", "left").select("metric", "value", F.coalesce((F.col("value") == 1.0) & ~F.col("_nan"), F.lit(False)).alias("passed"))
