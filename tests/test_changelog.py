import datetime as dt
import itertools
import random

import pytest

from earlymark.operators import changelog as c

T0 = dt.datetime(2026, 9, 1)
H = lambda n: T0 + dt.timedelta(hours=n)
LOG = "intervention_id int, change_type string, lsn long, sort_by long, status string, delivered_at timestamp_ntz"


def test_current_state_in_any_order(spark):
    rows = [(1, "insert", 1, 0, "open", H(1)), (1, "update_preimage", 2, 0, "open", H(2)), (1, "update_postimage", 2, 1, "contacted", H(2)), (2, "insert", 3, 0, "open", H(3)), (2, "delete", 4, 0, "open", H(4)), (3, "insert", 5, 0, "open", H(5)), (3, "delete", 6, 0, "open", H(6)), (3, "insert", 7, 0, "deferred", H(7))]
    for order in list(itertools.permutations(rows))[:: 40320 // 4]:
        got = c.current(spark.createDataFrame([*order, *order[:3]], LOG)).collect()
        assert sorted((r.intervention_id, r.status) for r in got) == [(1, "contacted"), (3, "deferred")]


def test_audit_keeps_every_image_once(spark):
    rows = [(1, "insert", 1, 0, "open", H(1)), (1, "insert", 1, 0, "open", H(3)), (1, "update_postimage", 2, 0, "closed", H(2))]
    got = c.audit(spark.createDataFrame(rows, LOG)).collect()
    assert sorted((r.lsn, r.delivered_at) for r in got) == [(1, H(3)), (2, H(2))]


def test_first_insert_of_an_event_stays(spark):
    rows = [("e1", "insert", 5, 0, "late", H(5)), ("e1", "insert", 2, 0, "first", H(2)), ("e1", "update_postimage", 1, 0, "no", H(1))]
    got = c.event_history(spark.createDataFrame(rows, "event_id string, change_type string, lsn long, sort_by long, what string, delivered_at timestamp_ntz")).collect()
    assert [r.what for r in got] == ["first"]


def test_summary(spark):
    current = spark.createDataFrame([(1, "s", "closed", "low", H(1), H(9), None, 3, 1, 1), (2, "s", "open", "high", H(2), H(3), H(4), 1, 2, 1), (3, "t", "closed", "low", H(1), H(1), H(1), 1, 3, 1)], "intervention_id int, entity_id string, status string, priority string, created_at timestamp_ntz, updated_at timestamp_ntz, next_follow_up_at timestamp_ntz, version int, lsn long, sort_by long")
    events = spark.createDataFrame([(1, "follow_up_scheduled"), (1, "closed"), (2, "follow_up_scheduled"), (3, "closed")], "intervention_id int, event_type string")
    got = {r.entity_id: r for r in c.summary(current, events, H(10)).collect()}
    s = got["s"]
    assert (s.intervention_status, s.intervention_priority, s.first_intervention_at, s.follow_up_due, s.follow_up_completed) == ("open", "high", H(1), True, True)
    assert (got["t"].follow_up_due, got["t"].follow_up_completed) == (False, False)
    assert not {r.entity_id: r for r in c.summary(current, events, H(3)).collect()}["s"].follow_up_due


def plain_fold(rows):
    """All commands, one after the other; keys are looked up whatever the entity."""
    state, used, out = {}, {}, {}
    for seq, entity, action, key, expected, new, said, at in rows:
        version, status, outcome, closed = state.get(entity, (0, None, None, None))
        result = "conflict"
        if key is not None and key in used:
            result, version = "replayed", used[key]
        elif (version == 0) if action == "create" else (version > 0 and version == expected):
            result, version, status = "applied", version + 1, "open" if action == "create" else new
            outcome, closed = said or outcome, at if status == "closed" else None
            state[entity] = (version, status, outcome, closed)
            if key is not None:
                used[key] = version
        out[entity, seq] = (result, version, status, outcome, closed)
    return out


COMMANDS = "seq long, entity_id int, action string, idempotency_key string, expected_version int, event_type string, new_status string, outcome string, at timestamp_ntz"


def test_commands(spark):
    rows = [(1, 1, "create", "k1", None, None, None, None, H(1)), (2, 1, "create", "k1", None, None, None, None, H(2)), (3, 1, "transition", "k2", 1, "closed", "closed", "done", H(3)), (4, 1, "transition", "k3", 1, "x", "open", None, H(4)), (5, 1, "transition", "k4", 2, "x", "contacted", None, H(5)), (6, 2, "transition", "k5", 1, "x", "open", None, H(6))]
    results, events = c.fold_commands(spark.createDataFrame(rows[::-1], COMMANDS))
    got = {r.seq: (r.result, r.version, r.status, r.outcome, r.closed_at) for r in results.collect()}
    assert got == {1: ("applied", 1, "open", None, None), 2: ("replayed", 1, "open", None, None), 3: ("applied", 2, "closed", "done", H(3)), 4: ("conflict", 2, "closed", "done", H(3)), 5: ("applied", 3, "contacted", "done", None), 6: ("conflict", 0, None, None, None)}
    assert sorted((e.seq, e.prior_status, e.new_status, e.result_version) for e in events.collect()) == [(1, None, "open", 1), (3, "open", "closed", 2), (5, "closed", "contacted", 3)]


def test_registered_fold_is_the_plain_one(spark):
    from earlymark.plans import feeds, inputs

    commands = inputs.read(spark, "/root/testdata/sf0.001", "events").selectExpr(*inputs.COMMANDS).toPandas().sort_values("seq")
    want = plain_fold([(r.seq, r.entity_id, r.action, r.idempotency_key, r.expected_version, r.new_status, r.outcome, r.at.to_pydatetime()) for r in commands.itertuples()])
    got = {(r.entity_id, r.seq): (r.result, r.version, r.status, r.outcome, r.closed_at) for r in feeds.command_fold(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and {"applied", "replayed", "conflict"} == {x[0] for x in want.values()}


def test_commands_of_a_large_entity_are_streamed(spark):
    rows = [(i, 1, "create" if i % 97 == 0 else "transition", None if i % 11 == 0 else f"k{i % 1500}", i % 3000, "x", ("open", "closed", "deferred")[i % 3], None if i % 4 else f"o{i}", H(i % 50)) for i in range(6000)]
    rows += [(6000, 1, "transition", "twice", None, "x", "open", None, H(1))] * 2 + [(1, None, "create", "k", None, None, None, None, H(1))] * 3
    results, events = c.fold_commands(spark.createDataFrame(rows, COMMANDS).repartition(4))
    assert "collect_list" not in results._jdf.queryExecution().toString()
    plain, used, version, want = sorted((r for r in rows if r[1]), key=lambda r: r[0]), {}, 0, []
    for seq, _, action, key, expected, *_ in plain:
        seen = used.get(key) if key else None
        applied = seen is None and (version == 0 if action == "create" else 0 < version == expected)
        version += applied
        if applied and key:
            used[key] = version
        want.append((seq, "replayed" if seen else "applied" if applied else "conflict", seen or version))
    got = results.collect()
    assert sorted((r.seq, r.result, r.version) for r in got if r.entity_id) == sorted(want)
    assert sorted(r.result for r in got if r.entity_id is None) == ["applied", "replayed", "replayed"]
    assert events.count() == sum(r.result == "applied" for r in got)


@pytest.mark.parametrize("together", [10**6, 0])
def test_keys_cross_entities(spark, together):
    rng = random.Random(3)
    rows = []
    for seq in range(400):
        entity = rng.randrange(12)
        rows.append((seq, entity, "create" if seq % 5 == 0 else "transition", f"k{rng.randrange(90)}" if seq % 9 else None, rng.randrange(4), "x", rng.choice(["open", "closed"]), None, H(seq % 20)))
    state, used, want = {}, {}, []
    for seq, entity, action, key, expected, *_ in rows:
        version = state.get(entity, 0)
        seen = used.get(key) if key else None
        applied = seen is None and (version == 0 if action == "create" else 0 < version == expected)
        state[entity] = version + applied
        if applied and key:
            used[key] = version + 1
        want.append((seq, "replayed" if seen else "applied" if applied else "conflict", seen or version + applied))
    results, events = c.fold_commands(spark.createDataFrame(rows, COMMANDS).repartition(3), together)
    assert sorted((r.seq, r.result, r.version) for r in results.collect()) == want
    assert events.count() == sum(w[1] == "applied" for w in want) and sum(w[1] == "replayed" for w in want) > 20


def chain(entities):
    """Each entity's third command applies only if its second one is a replay of the third one of the entity before it."""
    rows = []
    for e in range(entities):
        rows += [(4 * e, e, "create", f"c{e}", None, None, None, None, H(e % 9)), (4 * e + 1, e, "transition", f"t{e - 1}", 1, "x", "contacted", None, H(1)), (4 * e + 2, e, "transition", f"t{e}", 1, "x", "deferred", None, H(2))]
    return rows[:1] + rows[2:]


def test_long_chain_is_one_stream(spark, monkeypatch):
    folds, folded = [], c._folded
    monkeypatch.setattr(c, "_folded", lambda df, by: folds.append(by) or folded(df, by))
    rows = chain(1000)
    results, _ = c.fold_commands(spark.createDataFrame(rows, COMMANDS).repartition(3))
    want = plain_fold([(seq, e, a, k, v, n, o, at) for seq, e, a, k, v, _, n, o, at in rows])
    assert {(r.entity_id, r.seq): (r.result, r.version, r.status, r.outcome, r.closed_at) for r in results.collect()} == want
    assert folds == [["entity_id"], []] and sum(x[0] == "replayed" for x in want.values()) > 300


def test_later_rounds_fold_changed_entities_only(spark, monkeypatch):
    sizes, folded = [], c._folded

    def fold(df, by):
        sizes.append(df.select("entity_id").distinct().count())
        return folded(df, by)

    monkeypatch.setattr(c, "_folded", fold)
    rows = chain(8) + [(1000 + k, 100 + k, "create", f"own{k}", None, None, None, None, H(1)) for k in range(50)]
    results, events = c.fold_commands(spark.createDataFrame(rows, COMMANDS).repartition(3), 0)
    want = plain_fold([(seq, e, a, k, v, n, o, at) for seq, e, a, k, v, _, n, o, at in rows])
    assert {(r.entity_id, r.seq): (r.result, r.version, r.status, r.outcome, r.closed_at) for r in results.collect()} == want
    assert events.count() == sum(x[0] == "applied" for x in want.values())
    assert sizes[:2] == [50, 8] and len(sizes) > 4 and all(a >= b for a, b in zip(sizes[1:], sizes[2:])) and sizes[2] < 8
