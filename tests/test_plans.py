import datetime as dt
import hashlib
import inspect
from pathlib import Path

import pytest

from earlymark.functions import assign
from earlymark.operators import model
from earlymark.plans import feeds, models

SF = "/root/testdata/sf0.001"


def test_snapshots_at_every_order_date(spark):
    days = {r.d for name, c in (("orders", "o_orderdate"), ("events", "ts")) for r in spark.read.parquet(f"{SF}/{name}.parquet").selectExpr(f"to_date({c}) AS d").distinct().collect()}
    suppliers = {r.s_suppkey for r in spark.read.parquet(f"{SF}/supplier.parquet").collect()}
    got = [(r.s_suppkey, r.as_of) for r in feeds.entity_snapshots(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == {(s, dt.datetime.combine(d, dt.time(23, 59, 59))) for s in suppliers for d in days}


def test_boosted_candidate_is_fitted_in_full(spark, monkeypatch):
    class Fitted(Exception):
        pass

    def fit(train, label, numeric, categorical, rounds=inspect.signature(model.fit_boosted).parameters["rounds"].default, **_):
        raise Fitted(rounds)

    monkeypatch.setattr(model, "fit_logistic", lambda *_: None)
    monkeypatch.setattr(model, "fit_boosted", fit)
    with pytest.raises(Fitted, match="^250$"):
        models.model_gates(spark, SF)


def test_a_fit_reads_features_that_were_made_once(spark, monkeypatch):
    class Fitted(Exception):
        pass

    def fit(train, *_):
        raise Fitted(" ".join(train.inputFiles()))

    monkeypatch.setattr(model, "fit_logistic", fit)
    for query in (models.fit_and_score, models.model_gates):
        with pytest.raises(Fitted) as e:
            query(spark, SF)
        assert "/work-" in str(e.value) and SF not in str(e.value)


def test_cohort_keys_digest_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(assign, "PIECE", 3)
    rows = [("a", i % 50) for i in range(130)] + [("b", 7), ("b", None), ("c", None), (None, 3), (None, 20)]
    out = assign.cohort_keys(spark.createDataFrame(rows, "cohort string, id long"), "cohort", "id")
    want = {c: hashlib.sha256("|".join(sorted({str(i) for k, i in rows if k == c and i is not None})).encode()).hexdigest() for c in "abc"}
    want[None] = hashlib.sha256(b"20|3").hexdigest()
    assert [(r.cohort, r.cohort_key) for r in out.orderBy("cohort").collect()] == sorted(want.items(), key=lambda x: x[0] or "")
    assert "collect_set" not in models.cohort_keys(spark, SF)._jdf.queryExecution().toString()
    orders = spark.read.parquet(f"{SF}/orders.parquet").collect()
    by = {p: hashlib.sha256("|".join(sorted({str(r.o_orderkey) for r in orders if r.o_orderpriority == p})).encode()).hexdigest() for p in {r.o_orderpriority for r in orders}}
    assert {r.o_orderpriority: r.cohort_key for r in models.cohort_keys(spark, SF).collect()} == by


def test_missing_categories_take_the_mode(spark):
    rows = spark.createDataFrame([("b", 1.0, 0), ("b", 2.0, 1), ("o'x", 3.0, 0), (None, 4.0, 1), ("a", None, 1)] * 4, "c string, x double, y int")
    assert model.modes(rows, ["c"]) == {"c": "b"}
    fitted = model.fit_logistic(rows, "y", ["x"], ["c"])
    out = fitted.transform(rows).select("c", "x", "_m_c", "features").collect()
    assert all(r._m_c == (r.c or "b") for r in out)


def test_queries_agree_with_their_sql(spark):
    import duckdb

    queries, oracles = feeds.QUERIES | models.QUERIES, feeds.ORACLES | models.ORACLES
    for name in ("command_fold", "command_events", "publication_gate", "summary_records", "pseudonyms", "redact_text", "secret_scan", "insert_only_append", "top_k_ladder", "hash_buckets", "feature_policy", "guarded_batch", "daily_workflow"):
        got = queries[name](spark, SF)
        con = duckdb.connect()
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.sql(oracles[name])
        cols = sorted(want.columns)
        assert cols == sorted(got.columns), name
        mine, theirs = sorted(map(str, got.select(*cols).collect())), want.select(*cols).fetchall()
        assert len(mine) == len(theirs) > 0 or name == "secret_scan", name
        key = lambda row: tuple(str(x) for x in row)
        assert sorted(key(tuple(r)) for r in got.select(*cols).collect()) == sorted(key(r) for r in theirs), name


def test_scores_half_way_are_ranked_as_by_sql(spark, tmp_path):
    import duckdb

    rows = [(k, ("purchase", "view")[k % 2], k / 8) for k in range(4400)] + [(5000, "view", None), (5001, "purchase", 251.75), (5002, "purchase", 253.75)]
    spark.createDataFrame(rows, "event_id long, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("ranked_scores", "top_k_ladder"):
        want = con.sql(models.ORACLES[name])
        got = models.QUERIES[name](spark, str(tmp_path)).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()), name


def test_landed_files_and_buckets_grow_in_number(spark, monkeypatch):
    def conform(rows=None):
        with monkeypatch.context() as m:
            made, stream = [], feeds.files.stream
            if rows:
                m.setattr(feeds.i, "PART_ROWS", rows)
            m.setattr(feeds.files, "stream", lambda spark, path, *a, **k: made.append(len(list(Path(path).glob("part-*")))) or stream(spark, path, *a, **k))
            m.setattr(feeds, "conform_stream", lambda source, table, *a, real=feeds.conform_stream: made.append(table.buckets) or real(source, table, *a))
            return sorted(map(tuple, feeds.conform_stream_latest(spark, SF).collect())), made

    few, many = conform(), conform(500)
    assert few[0] == many[0] and few[1] == [4, 8] and many[1] == [12, 12]
