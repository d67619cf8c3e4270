"""Contracts of the daily feeds: key, event time, parent key and the rules of each dataset."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Contract:
    """checks: (reason, SQL condition) in the order in which they are tried; a null condition fails."""

    name: str
    key: str
    event_time: str
    parent_key: str | None = None
    run_date: str = "run_date"
    checks: tuple[tuple[str, str], ...] = ()


# Reasons, ranges and the allowed kinds of activity.
ACTIVITY_TYPES = ("LMS_LOGIN", "ASSIGNMENT", "ADVISING", "SUPPORT")

CONTRACTS = {
    c.name: c
    for c in (
        Contract("entities", "entity_id", "record_effective_at"),
        Contract("periods", "period_id", "census_date", "entity_id", checks=(("GPA_OUT_OF_RANGE", "cumulative_gpa BETWEEN 0.0D AND 4.0D"),)),
        Contract("presence", "presence_id", "event_at", "entity_id"),
        Contract("activity", "activity_id", "event_at", "entity_id", checks=(("UNKNOWN_EVENT_TYPE", f"event_type IN {ACTIVITY_TYPES}"),)),
        Contract("balances", "balance_id", "event_at", "entity_id", checks=(("NEGATIVE_BALANCE", "balance_amount >= 0.0D"),)),
        Contract("outcomes", "outcome_id", "next_census_date", "entity_id"),
    )
}


def contract(name: str) -> Contract:
    if name not in CONTRACTS:
        raise ValueError(f"unknown dataset: {name}")
    return CONTRACTS[name]


# The columns of the six feeds; a value that doesn't fit its type is kept aside.
SCHEMAS = {
    "entities": "entity_id string, program string, advisor_id string, exposure double, record_effective_at timestamp_ntz, run_date date",
    "periods": "period_id string, entity_id string, term string, census_date date, credits_attempted long, credits_completed long, cumulative_gpa double, run_date date",
    "presence": "presence_id string, entity_id string, event_at timestamp_ntz, present_flag boolean, run_date date",
    "activity": "activity_id string, entity_id string, event_type string, event_at timestamp_ntz, run_date date",
    "balances": "balance_id string, entity_id string, event_at timestamp_ntz, balance_amount double, hold_flag boolean, run_date date",
    "outcomes": "outcome_id string, entity_id string, next_census_date date, outcome_status string, run_date date",
}
