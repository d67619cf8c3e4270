import datetime as dt

from pyspark.sql import functions as F

from earlymark.operators import pit

CUT = dt.datetime(2026, 9, 21, 23, 59, 59)
D = lambda n, h=8: dt.datetime(2026, 9, 21, h) - dt.timedelta(n)


def snapshots(spark):
    return spark.createDataFrame([("s1", CUT), ("s2", CUT), ("s1", CUT - dt.timedelta(40))], "entity_id string, as_of timestamp_ntz")


def at(df, entity="s1", cut=CUT):
    return next(r for r in df.collect() if r.entity_id == entity and r.as_of == cut)


def test_rate_window_is_open_at_its_start(spark):
    events = [("s1", D(1), True), ("s1", D(2), False), ("s1", CUT - dt.timedelta(28), True), ("s1", CUT + dt.timedelta(seconds=1), True), ("s1", D(60), True)]
    df = pit.rate(snapshots(spark), spark.createDataFrame(events, "entity_id string, event_at timestamp_ntz, present boolean"), "entity_id", "as_of", "event_at", F.col("present"))
    assert at(df).rate_28d == 0.5 and at(df).max_event_at == D(1)
    assert at(df, "s2").rate_28d == 0.0 and at(df, "s2").max_event_at is None
    assert at(df, cut=CUT - dt.timedelta(40)).rate_28d == 1.0


def test_counts_and_recency(spark):
    events = [("s1", D(3), "LMS_LOGIN", "OK"), ("s1", D(5), "ASSIGNMENT", "MISSED"), ("s1", D(6), "ASSIGNMENT", "DONE"), ("s1", D(30), "ASSIGNMENT", "MISSED"), ("s1", D(80), "SUPPORT", "OK"), ("s1", D(95), "SUPPORT", "OK"), ("s1", CUT + dt.timedelta(1), "LMS_LOGIN", "OK")]
    kind = lambda t: F.col("event_type") == t
    df = pit.counts(snapshots(spark), spark.createDataFrame(events, "entity_id string, event_at timestamp_ntz, event_type string, event_status string"), "entity_id", "as_of", "event_at", kind("ASSIGNMENT") & (F.col("event_status") == "MISSED"), kind("SUPPORT"), kind("LMS_LOGIN"))
    r = at(df)
    assert (r.missed_28d, r.support_90d, r.days_since_activity) == (1, 1, 3)
    r = at(df, "s2")
    assert (r.missed_28d, r.support_90d, r.days_since_activity) == (0, 0, pit.NO_ACTIVITY_DAYS)


def test_latest_state_and_defaults(spark):
    states = [("s1", D(9), "f1", "LOW", False), ("s1", D(2), "f2", "MEDIUM", False), ("s1", D(2), "f3", "HIGH", True), ("s1", CUT + dt.timedelta(1), "f9", "NONE", False)]
    df = pit.latest_state(snapshots(spark), spark.createDataFrame(states, "entity_id string, event_at timestamp_ntz, record string, band string, hold boolean"), "entity_id", "as_of", "event_at", "record", {"band": "NONE", "hold": False})
    assert (at(df).band, at(df).hold) == ("HIGH", True) and (at(df, "s2").band, at(df, "s2").hold) == ("NONE", False)


def test_ranked_history(spark):
    rows = [("s1", D(20), "n3", 12.0, False), ("s1", D(200), "n2", 15.0, True), ("s1", D(400), "n1", 9.0, False), ("s1", CUT + dt.timedelta(5), "n4", 99.0, True)]
    df = pit.ranked_history(snapshots(spark), spark.createDataFrame(rows, "entity_id string, at timestamp_ntz, record string, credits double, withdrawn boolean"), "entity_id", "as_of", "at", "record", "credits", F.col("withdrawn"))
    r = at(df)
    assert (r.current, r.prior_sum, r.trend, r.prior_flags) == (12.0, 24.0, -3.0, 1)
    r = at(df, "s2")
    assert (r.current, r.prior_sum, r.trend, r.prior_flags, r.max_event_at) == (0.0, 0.0, 0.0, 0, None)
    r = at(df, cut=CUT - dt.timedelta(40))
    assert (r.current, r.trend) == (15.0, 6.0)


def test_cutoffs_of_labels(spark):
    assert spark.range(1).select(pit.label_cutoff(F.lit(dt.date(2026, 9, 7)))).first()[0] == dt.datetime(2026, 9, 6, 23, 59, 59)


def test_leaks_show(spark):
    df = spark.createDataFrame([(1, CUT, CUT), (2, CUT, CUT + dt.timedelta(seconds=1)), (3, CUT, None)], "entity_id int, as_of timestamp_ntz, max_feature_event_at timestamp_ntz")
    assert [r.entity_id for r in pit.leaks(df, "as_of").collect()] == [2]


def test_cells_count_the_edges_before_a_time(spark):
    cuts = [CUT - dt.timedelta(hours=7 * k) for k in range(60)]
    snaps = spark.createDataFrame([("s", c) for c in cuts], "entity_id string, as_of timestamp_ntz")
    grid = pit.Grid(snaps, "as_of", [3])
    times = [CUT - dt.timedelta(hours=5 * k, seconds=k % 3 - 1) for k in range(-3, 120)] + grid.edges
    got = grid.with_cell(spark.createDataFrame([(t,) for t in times], "t timestamp_ntz"), "t").collect()
    assert sorted((r.t, r._cell) for r in got) == sorted((t, sum(e < t for e in grid.edges)) for t in times if t <= CUT)
    none = pit.Grid(snaps.limit(0), "as_of", [3])
    assert none.with_cell(spark.createDataFrame([(CUT,)], "t timestamp_ntz"), "t").count() == 0


def test_rows_grow_with_cells_and_cutoffs(spark, monkeypatch):
    """1000 daily cutoffs: the sweep takes cells + marks, and its answers are those of a look at every event."""
    cuts = [CUT - dt.timedelta(days=k) for k in range(1000)]
    events = [("s1", CUT - dt.timedelta(hours=61 * k + k * k % 7), k % 3 == 0, f"r{k:03}", float(k * k % 101)) for k in range(500)] + [(None, D(3), True, "r", 1.0)]
    snaps = spark.createDataFrame([("s1", c) for c in cuts] + [("s2", c) for c in cuts] + [(None, CUT)], "entity_id string, as_of timestamp_ntz")
    df = spark.createDataFrame(events, "entity_id string, event_at timestamp_ntz, flag boolean, record string, v double")
    taken, swept = [], pit.swept

    def counted(cells, marks, key, running):
        taken.append((cells.count(), marks.count()))
        return swept(cells, marks, key, running)

    monkeypatch.setattr(pit, "swept", counted)
    one = F.col("flag")
    got = pit.activity(snaps, df, "entity_id", "as_of", "event_at", one, one, one, one).collect()
    assert taken[0][0] <= 501 and taken[0][1] == 3 * 2001 and len(got) == 2001
    past = lambda c, d: [e for e in events if e[0] == "s1" and e[1] <= c and e[1] > c - dt.timedelta(d)]
    for r in got:
        if r.entity_id != "s1":
            assert (r.rate_28d, r.missed_28d, r.support_90d, r.days_since_activity, r.max_event_at) == (0.0, 0, 0, pit.NO_ACTIVITY_DAYS, None)
            continue
        month, all_ = past(r.as_of, 28), past(r.as_of, 99_999)
        assert r.missed_28d == sum(e[2] for e in month) and r.support_90d == sum(e[2] for e in past(r.as_of, 90))
        assert abs(r.rate_28d - (sum(e[2] for e in month) / len(month) if month else 0.0)) < 1e-12 and r.max_event_at == max((e[1] for e in all_), default=None)
    for r in pit.ranked_history(snaps, df, "entity_id", "as_of", "event_at", "record", "v", one).where("entity_id = 's1'").collect():
        own = sorted(past(r.as_of, 99_999), key=lambda e: (e[1], e[3]))[::-1]
        want = (own[0][4], sum(e[4] for e in own[1:]), own[0][4] - own[1][4] if len(own) > 1 else 0.0, sum(e[2] for e in own[1:]), own[0][1]) if own else (0.0, 0.0, 0.0, 0, None)
        assert (r.current, r.prior_sum, r.trend, r.prior_flags, r.max_event_at) == want
    assert taken[1] == (taken[1][0], 2001) and taken[1][0] <= 1001
