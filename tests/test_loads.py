"""Loads: pruned reads, folding of days that are over, refreshes, and what consumers take once."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import jobs
from tidemark.sources import events
from tidemark.sources.tables import Load, Warehouse
from tidemark.streaming import ingest
from tidemark.topics import CLICKS, INVENTORY, ORDERS

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"))


def stock(spark, rows, at="2024-01-05 00:00:00"):
    lines = [json.dumps({"sku": s, "warehouse_id": "w", "stock_level": n, "event_time": "2024-01-05T01:00:00"}) for s, n in rows]
    return events.parse(spark.createDataFrame([(x,) for x in lines], "value string"), INVENTORY, F.lit(at).cast("timestamp_ntz"))


def orders(spark, rows, at="2024-01-05 00:00:00"):
    base = {"order_id": "O", "customer_id": "c", "product_id": "p", "quantity": 1, "status": "placed", "region": "in", "event_time": "2024-01-05T01:00:00"}
    lines = [json.dumps({**base, **r}) for r in rows]
    return events.parse(spark.createDataFrame([(x,) for x in lines], "value string"), ORDERS, F.lit(at).cast("timestamp_ntz"))


def store(warehouse, df, table, batch, source="s"):
    warehouse.write_load(df.select(*warehouse.read(table).columns), table, source, batch, "ingested_at")


def files(warehouse, table):
    return sorted(Path(warehouse.path(table)).rglob("*.parquet")) + sorted(Path(f"{warehouse.path(table)}_days").rglob("*.parquet"))


# ------------------------------------------------------------------ staging


def test_staging_opens_only_new_loads(spark, warehouse):
    for day in range(1, 6):
        store(warehouse, stock(spark, [(f"P{day}", day)], f"2024-01-0{day} 00:00:00"), "inventory_raw", day)
    jobs.run_staging(warehouse, AS_OF)
    store(warehouse, stock(spark, [("P9", 9)], "2024-01-06 00:00:00"), "inventory_raw", 9)
    what = jobs.pending(warehouse, "stg_inventory", "inventory_raw")
    assert what == ([Load("2024-01-06", "s", "9")], [])
    rows = jobs.taken(warehouse, "stg_inventory", "inventory_raw", what)
    assert [r.sku for r in rows.collect()] == ["P9"] and len(files(warehouse, "inventory_raw")) > 5
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert all(f"{c}#" in filters for c in ("load_date", "load_source", "load_batch"))
    jobs.run_staging(warehouse, AS_OF)
    assert warehouse.read("stg_inventory").count() == 6
    assert not jobs.pending(warehouse, "stg_inventory", "inventory_raw")


def test_a_load_that_comes_later_wins_whatever_the_times(spark, warehouse):
    store(warehouse, stock(spark, [("P", 100)]), "inventory_raw", 0)
    jobs.run_staging(warehouse, "2024-02-02 00:00:00")
    store(warehouse, stock(spark, [("P", 999)]), "inventory_raw", 1)
    jobs.run_staging(warehouse, "2024-02-01 00:00:00")
    assert [r.stock_level for r in warehouse.read("stg_inventory").collect()] == [999]


def test_many_loads_are_folded_by_the_run_and_read_without_settling(spark, warehouse, monkeypatch):
    monkeypatch.setattr(jobs, "MOST_LOADS", 3)
    for i in range(4):
        store(warehouse, stock(spark, [("P", i), (f"Q{i}", i)]), "inventory_raw", i)
        jobs.run_staging(warehouse, AS_OF)
        table = warehouse.staged("stg_inventory")
        got = sorted((r.sku, r.stock_level) for r in warehouse.read("stg_inventory").collect())
        assert got == sorted([("P", i), *((f"Q{k}", k) for k in range(i + 1))])
        plan = warehouse.read("stg_inventory")._jdf.queryExecution().executedPlan().toString()
        assert ("Window" in plan) == (i != 2) and len(table.loads()) == (1, 2, 1, 2)[i]


def test_a_key_that_a_load_has_twice_fails_the_check(spark, warehouse):
    one = spark.range(1).select(
        F.lit(7).cast("bigint").alias("anomaly_id"), F.lit(1).cast("bigint").alias("profile_id"), F.lit("t").alias("topic"),
        F.lit(0).cast("bigint").alias("batch_id"), F.lit(-0.2).alias("anomaly_score"), F.lit("MEDIUM").alias("severity"),
        F.lit(False).alias("is_schema_drift"), F.lit(AS_OF).alias("scored_at"), F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"))
    warehouse.write_load(one.unionByName(one), "anomaly_log", "s", 0, "created_at")
    with pytest.raises(quality.QualityError) as e:
        jobs.run_models(warehouse, AS_OF)
    assert e.value.failures == [("stg_anomaly_log", "unique", "anomaly_id", 1)]


# ------------------------------------------------------------------ folding


def test_days_that_are_over_are_folded_and_rows_stay(spark, warehouse, rows):
    for i in range(200):
        day = i % 4 + 1
        Path(warehouse.path("inventory_raw")).mkdir(parents=True, exist_ok=True)
        if i < 4:
            store(warehouse, stock(spark, [(f"P{i}", i)], f"2024-01-0{day} 00:00:00"), "inventory_raw", i)
        else:  # a copy of a small load under another batch number: what 200 batches leave behind
            at = Path(warehouse.path("inventory_raw"), f"load_date=2024-01-0{day}", "load_source=s")
            new = at / f"load_batch={i}"
            new.mkdir()
            for f in (at / f"load_batch={i % 4}").glob("*.parquet"):
                (new / f.name).write_bytes(f.read_bytes())
    jobs.run_staging(warehouse, AS_OF)
    before = rows(warehouse.read("inventory_raw", with_load=True))
    assert len(before) == 200 == len(warehouse.open_loads("inventory_raw"))
    assert jobs.fold_closed_days(warehouse, "2024-01-04", AS_OF)["inventory_raw"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert rows(warehouse.read("inventory_raw", with_load=True)) == before
    assert len(warehouse.open_loads("inventory_raw")) == 50 and len(files(warehouse, "inventory_raw")) == 50 + 3
    assert not jobs.pending(warehouse, "stg_inventory", "inventory_raw")  # what was staged stays so
    assert jobs.fold_closed_days(warehouse, "2024-01-04", AS_OF) == {}

    # a batch of an open day, and one of a day that was folded, are written again
    for batch, day in ((3, 4), (0, 1)):
        store(warehouse, stock(spark, [("new", 7)], f"2024-01-0{day} 00:00:00"), "inventory_raw", batch)
        found = [r for r in rows(warehouse.read("inventory_raw", with_load=True)) if r[-1] == str(batch)]
        assert [r[0] for r in found] == ["new"]
    assert warehouse.read("inventory_raw").count() == 200


def test_a_fold_that_stops_midway_changes_no_row(spark, warehouse, rows, monkeypatch):
    for i in range(3):
        store(warehouse, stock(spark, [(f"P{i}", i)]), "inventory_raw", i)
    before = rows(warehouse.read("inventory_raw", with_load=True))
    from tidemark.sources import folders

    for step in ("rename", "remove"):
        with monkeypatch.context() as m:
            m.setattr(folders, step, lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                warehouse.fold("inventory_raw", "2024-01-06")
        assert rows(warehouse.read("inventory_raw", with_load=True)) == before


def test_a_consumer_takes_from_a_folded_day_what_it_had_not(spark, warehouse):
    store(warehouse, stock(spark, [("A", 1)]), "inventory_raw", 0)
    jobs.run_staging(warehouse, AS_OF)
    store(warehouse, stock(spark, [("B", 2)]), "inventory_raw", 1)
    jobs.fold_closed_days(warehouse, "2024-01-06", AS_OF)
    what = jobs.pending(warehouse, "stg_inventory", "inventory_raw")
    assert what == ([], ["2024-01-05"])
    assert [r.sku for r in jobs.taken(warehouse, "stg_inventory", "inventory_raw", what).collect()] == ["B"]
    jobs.run_staging(warehouse, AS_OF)
    assert sorted(r.sku for r in warehouse.read("stg_inventory").collect()) == ["A", "B"]
    assert not jobs.pending(warehouse, "stg_inventory", "inventory_raw")


def test_retention_reaches_folded_days(spark, warehouse):
    for i in range(2):
        ingest.process_batch(orders(spark, [{"amount": -1.0, "order_id": str(i)}], "2023-10-01 00:00:00"), i, ORDERS, warehouse, "s")
    assert jobs.fold_closed_days(warehouse, "2024-01-01", AS_OF).keys() >= {"quarantine_log", "dead_letters", "stream_profiles"}
    assert warehouse.read("quarantine_log").count() == 2
    jobs.apply_retention(warehouse, AS_OF)
    assert warehouse.read("quarantine_log").count() == 0 and warehouse.read("dead_letters").count() == 2


# ------------------------------------------------------------------ refresh


def test_a_refresh_that_fails_leaves_the_old_mart(spark, warehouse):
    def mart(n):
        return spark.range(n).select(F.col("id").alias("total_orders"))

    for n in (1, 2, 3):
        warehouse.replace(mart(n), "mart_stream_overview")
        assert warehouse.read("mart_stream_overview").count() == n
    with pytest.raises(Exception, match="stopped"):
        bad = mart(9).withColumn("x", F.when(F.col("total_orders") > 4, F.raise_error(F.lit("stopped"))))
        warehouse.replace(bad, "mart_stream_overview")
    assert warehouse.read("mart_stream_overview").count() == 3
    warehouse.replace(warehouse.read("mart_stream_overview").limit(2), "mart_stream_overview")  # reads itself
    assert warehouse.read("mart_stream_overview").count() == 2
    assert len(list(Path(warehouse.path("mart_stream_overview")).glob("version=*"))) == 2


# ------------------------------------------------------------------ letters


def test_letters_and_replays_are_sent_once_and_a_broken_run_goes_on(spark, warehouse, tmp_path):
    sent = []

    def send(values, name):
        found = [r.value for r in values.collect()]
        if broken and len(sent) >= broken.pop():
            raise ConnectionError("gone")
        sent.extend(found)

    for i in range(3):
        ingest.process_batch(orders(spark, [{"amount": -1.0 - i}]), i, ORDERS, warehouse, "s")
    broken = [1, 9]
    with pytest.raises(ConnectionError):
        broken = [1, 1]
        jobs.send_dead_letters(warehouse, send, AS_OF)
    assert len(sent) == 1
    broken = []
    assert len(jobs.send_dead_letters(warehouse, send, AS_OF)) == 2
    assert sorted(json.loads(json.loads(x)["record"])["amount"] for x in sent) == [-3.0, -2.0, -1.0]
    assert jobs.send_dead_letters(warehouse, send, AS_OF) == []

    sent.clear()
    broken = [0]
    with pytest.raises(ConnectionError):
        jobs.replay_dead_letters(warehouse, ORDERS, send, "r1", AS_OF)
    ingest.process_batch(orders(spark, [{"amount": -9.0}]), 3, ORDERS, warehouse, "s")
    broken = []
    assert jobs.replay_dead_letters(warehouse, ORDERS, send, "r2", AS_OF) == {"reprocessed": 1}
    assert sorted(json.loads(x)["amount"] for x in sent) == [1.0, 2.0, 3.0, 9.0]
    assert jobs.replay_dead_letters(warehouse, ORDERS, send, "r1", AS_OF) == {"reprocessed": 3}
    assert jobs.replay_dead_letters(warehouse, ORDERS, send, "r3", AS_OF) == {} and len(sent) == 4


def test_a_run_that_broke_before_it_decided_is_finished_by_the_next(spark, warehouse, monkeypatch):
    sent = []
    send = lambda values, name: sent.extend((name, json.loads(r.value)["amount"]) for r in values.collect())
    ingest.process_batch(orders(spark, [{"amount": -1.0}]), 0, ORDERS, warehouse, "s")
    with monkeypatch.context() as m:
        m.setattr(jobs, "_decide", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.replay_dead_letters(warehouse, ORDERS, send, "r1", AS_OF)
    ingest.process_batch(orders(spark, [{"amount": -2.0}]), 1, ORDERS, warehouse, "s")
    assert jobs.replay_dead_letters(warehouse, ORDERS, send, "r2", AS_OF) == {"reprocessed": 1}
    assert sorted(sent) == [("r1", 1.0), ("r2", 2.0)]


# ------------------------------------------------------------------ keys


def test_healing_reads_the_loads_since_the_last_heal(spark, warehouse):
    def click(i, **more):
        line = json.dumps({"session_id": f"S{i}", "user_id": "u", "page": "/", "action": "view", "event_time": AS_OF, **more})
        raw = spark.createDataFrame([(line,)], "value string")
        ingest.process_batch(events.parse(raw, CLICKS, F.lit(AS_OF).cast("timestamp_ntz")), i, CLICKS, warehouse, "s")

    click(0, coupon=1)
    assert jobs.heal_schema(warehouse, CLICKS, 0, AS_OF) == ["coupon"]
    click(1, coupon=1, gift=2)
    what = jobs.pending(warehouse, "heal clickstream_topic", "quarantine_log")
    assert [n.batch for n in what.loads] == ["1"]
    assert jobs.heal_schema(warehouse, CLICKS, 1, "2024-02-02 00:00:00") == ["gift"]
    assert sorted((r.topic, r.key) for r in warehouse.read("payload_keys").collect())[:2] == [("clickstream_topic", "action"), ("clickstream_topic", "coupon")]
    assert warehouse.read("payload_keys").count() == warehouse.read("payload_keys").distinct().count() == 7


def test_a_fold_reads_its_day_without_a_shuffle(spark, warehouse, monkeypatch):
    """One task may not read a whole large day: the files are written as they are read."""
    for i in range(3):
        store(warehouse, stock(spark, [(f"P{i}", i)]), "inventory_raw", i)
    plans = []
    real = type(spark.range(1).write).parquet

    def parquet(writer, path, *a, **k):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return real(writer, path, *a, **k)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", parquet)
    assert warehouse.fold("inventory_raw", "2024-01-06") == ["2024-01-05"]
    assert plans and not any("Exchange" in p for p in plans)
    assert sorted(r.sku for r in warehouse.read("inventory_raw").collect()) == ["P0", "P1", "P2"]
