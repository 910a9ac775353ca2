"""Streams through files, and the jobs over the stored tables."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, validate
from tidemark.plans import jobs, staging
from tidemark.sources import events
from tidemark.sources.tables import ContractError, Warehouse, conform
from tidemark.streaming import ingest
from tidemark.topics import CLICKS, INVENTORY, ORDERS

AS_OF = "2024-02-01 00:00:00"


def click(i, **more):
    return json.dumps({"session_id": f"S{i}", "user_id": "u", "page": "/", "action": "view",
                       "event_time": "2024-01-05T01:00:00", "duration_ms": i, **more})


def order(i, **more):
    base = {"order_id": f"O{i}", "customer_id": "c", "product_id": "p", "quantity": 2, "amount": 5.0,
            "status": "placed", "region": "in", "event_time": "2024-01-05T01:00:00"}
    return json.dumps({**base, **more})


CLOCK = itertools.count(1_700_000_000)


def write(folder, name, lines):
    """A source file that is later than all before it."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (next(CLOCK),) * 2)


def run(spark, folder, topic, warehouse, tmp_path, **kw):
    q = ingest.start(
        events.text_stream(spark, str(folder), 1), topic, warehouse,
        str(tmp_path / f"progress-{topic.name}"), available_now=True, **kw,
    )
    q.awaitTermination()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, warehouse, rows):
    lines = [order(i) for i in range(6)] + [order(7, amount=-2.0), order(8, status=None), "not json"]
    src = tmp_path / "orders"
    write(src, "a.txt", lines[:5])
    write(src, "b.txt", lines[5:])
    for _ in range(2):  # the second start finds nothing new
        run(spark, src, ORDERS, warehouse, tmp_path)
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = validate.validate_and_route(events.parse(raw, ORDERS), "order", 0, AS_OF)
    fields = ORDERS.payload.names
    assert rows(warehouse.read("orders_raw"), *fields) == rows(good, *fields)
    letters = warehouse.read("dead_letters").collect()
    assert sorted(r.reason for r in letters) == sorted(r.reject_reason for r in bad.collect())
    log = warehouse.read("quarantine_log").collect()
    assert "not json" in {r.record_json for r in log} and len(log) == 3
    profiles = warehouse.read("stream_profiles").collect()
    assert sum(p.record_count for p in profiles) == len(lines) and len(profiles) == 2


def test_repeated_batch_replaces_its_output(spark, warehouse):
    raw = spark.createDataFrame([(order(1),), (order(2, amount=-1.0),)], "value string")
    batch = events.parse(raw, ORDERS, F.lit(AS_OF).cast("timestamp_ntz"))
    for _ in range(2):
        ingest.process_batch(batch, 5, ORDERS, warehouse, "s")
    for table, n in (("orders_raw", 1), ("dead_letters", 1), ("quarantine_log", 1), ("stream_profiles", 1)):
        assert warehouse.read(table).count() == n
    ingest.process_batch(batch, 6, ORDERS, warehouse, "s")
    assert warehouse.read("orders_raw").count() == 2


def test_empty_batch_is_skipped(spark, warehouse):
    raw = spark.createDataFrame([], "value string")
    ingest.process_batch(events.parse(raw, ORDERS), 1, ORDERS, warehouse, "s")
    assert not warehouse.exists("stream_profiles")


def test_drift_heals_and_old_files_read_null(spark, tmp_path, warehouse):
    src = tmp_path / "clicks"
    write(src, "a.txt", [click(1), click(2)])
    run(spark, src, CLICKS, warehouse, tmp_path)
    write(src, "b.txt", [click(3, Coupon="A"), click(4, **{"a-b": 1})])
    run(spark, src, CLICKS, warehouse, tmp_path)
    drifted = staging.stg_stream_profiles(warehouse.read("stream_profiles"))
    assert {r.batch_id: r.is_schema_drift for r in drifted.collect()} == {0: False, 1: True}
    assert warehouse.read("clickstream_raw").count() == 4  # a drifted record is still a good one

    assert jobs.heal_schema(warehouse, CLICKS, 1, AS_OF) == ["coupon"]
    assert jobs.heal_schema(warehouse, CLICKS, 1, "2024-02-02 00:00:00") == []
    write(src, "c.txt", [click(5, Coupon="B", extra=None)])
    run(spark, src, CLICKS, warehouse, tmp_path)
    got = {r.session_id: r.coupon for r in warehouse.read("clickstream_raw").collect()}
    assert got == {"S1": None, "S2": None, "S3": None, "S4": None, "S5": "B"}


def test_data_sent_as_keys_is_refused(spark, warehouse):
    raw = spark.createDataFrame([(click(i, **{f"k{i}": 1}),) for i in range(5)], "value string")
    batch = events.parse(raw, CLICKS, F.lit(AS_OF).cast("timestamp_ntz"))
    ingest.process_batch(batch, 0, CLICKS, warehouse, "s")
    with pytest.raises(jobs.TooManyColumns):
        jobs.heal_schema(warehouse, CLICKS, 0, AS_OF, at_most=4)
    assert warehouse.added_columns("clickstream_raw") == []
    assert len(jobs.heal_schema(warehouse, CLICKS, 0, AS_OF)) == 5


def test_stream_upsert_equals_batch_staging(spark, tmp_path, warehouse, rows):
    src = tmp_path / "orders"
    write(src, "a.txt", [order(1, amount=1.0), order(2)])
    write(src, "b.txt", [order(1, amount=9.0), order(3)])
    target = warehouse.staged("stg_orders")
    run(spark, src, ORDERS, warehouse, tmp_path,
        after=lambda good, batch_id: target.append(staging.stg_orders(good), f"{batch_id:012}"))
    batch = staging.stg_orders(warehouse.read("orders_raw"))
    assert rows(target.read(), "order_id", "amount") == rows(batch, "order_id", "amount")
    assert ("O1", 9.0) in rows(target.read(), "order_id", "amount")


def test_models_run_incrementally_and_the_gate_stops_marts(spark, tmp_path, warehouse, rows):
    src = tmp_path / "orders"
    write(src, "a.txt", [order(1), order(2)])
    run(spark, src, ORDERS, warehouse, tmp_path)
    jobs.run_models(warehouse, AS_OF)
    assert warehouse.read("mart_stream_overview").first().total_orders == 2
    write(src, "b.txt", [order(1, amount=7.5), order(3)])
    run(spark, src, ORDERS, warehouse, tmp_path)
    jobs.run_models(warehouse, "2024-02-02 00:00:00")
    assert rows(warehouse.read("stg_orders"), "order_id", "amount") == [("O1", 7.5), ("O2", 5.0), ("O3", 5.0)]
    assert warehouse.read("mart_stream_overview").first().total_orders == 3
    assert warehouse.read("quality_results").count() == 44

    write(src, "c.txt", [order(4, status="odd")])
    run(spark, src, ORDERS, warehouse, tmp_path)
    with pytest.raises(quality.QualityError) as e:
        jobs.run_models(warehouse, "2024-02-03 00:00:00")
    assert e.value.failures == [("stg_orders", "accepted_values", "status", 1)]
    assert warehouse.read("mart_stream_overview").first().total_orders == 3


def test_replay_publishes_each_letter_once(spark, tmp_path, warehouse):
    src = tmp_path / "orders"
    write(src, "a.txt", [order(1, amount=-4.0), order(2, amount=-5.0), order(3, amount=0), order(4)])
    run(spark, src, ORDERS, warehouse, tmp_path)
    out = tmp_path / "orders_again"
    first = jobs.replay_dead_letters(warehouse, ORDERS, str(out), "r1", AS_OF)
    assert first == {"reprocessed": 2, "unfixable": 1}
    assert jobs.replay_dead_letters(warehouse, ORDERS, str(out), "r1", AS_OF) == first
    assert jobs.replay_dead_letters(warehouse, ORDERS, str(out), "r2", AS_OF) == {}
    texts = [json.loads(r.value) for r in spark.read.text(str(out)).collect()]
    assert sorted(t["amount"] for t in texts) == [4.0, 5.0]
    assert jobs.replay_dead_letters(warehouse, INVENTORY, str(tmp_path / "i"), "r1", AS_OF) == {}

    run(spark, out, ORDERS, warehouse, tmp_path / "again", source="replay")
    assert warehouse.read("orders_raw").count() == 3
    drifted = staging.stg_stream_profiles(warehouse.read("stream_profiles"))
    assert not any(r.is_schema_drift for r in drifted.collect() if r.batch_id == 0)


def test_a_letter_of_a_repeated_batch_is_published_once(spark, tmp_path, warehouse):
    raw = spark.createDataFrame([(order(1, amount=-4.0),), (order(1, amount=-4.0),)], "value string")
    batch = events.parse(raw, ORDERS, F.lit(AS_OF).cast("timestamp_ntz"))
    out = tmp_path / "again"
    ingest.process_batch(batch, 3, ORDERS, warehouse, "s")
    assert jobs.replay_dead_letters(warehouse, ORDERS, str(out), "r1", AS_OF) == {"reprocessed": 2}
    ingest.process_batch(batch, 3, ORDERS, warehouse, "s")  # new files, same letters
    assert jobs.replay_dead_letters(warehouse, ORDERS, str(out), "r2", AS_OF) == {}
    assert spark.read.text(str(out)).count() == 2


def test_a_healed_column_is_replayed(spark, tmp_path, warehouse):
    raw = spark.createDataFrame([(order(1, amount=-4.0, coupon="A"),), (order(2),)], "value string")
    batch = events.parse(raw, ORDERS, F.lit(AS_OF).cast("timestamp_ntz"))
    ingest.process_batch(batch, 0, ORDERS, warehouse, "s")
    assert jobs.heal_schema(warehouse, ORDERS, 0, AS_OF) == ["coupon"]
    healed = events.parse(raw, ORDERS, F.lit(AS_OF).cast("timestamp_ntz"), healed=("coupon",))
    ingest.process_batch(healed, 0, ORDERS, warehouse, "s", healed=("coupon",))
    jobs.replay_dead_letters(warehouse, ORDERS, str(tmp_path / "o"), "r1", AS_OF)
    assert [json.loads(r.value).get("coupon") for r in spark.read.text(str(tmp_path / "o")).collect()] == ["A"]


def test_loads_are_staged_whatever_their_times(spark, warehouse):
    def profile(i, topic, at):
        return spark.range(1).select(
            F.lit(i).cast("bigint").alias("profile_id"), F.lit(topic).alias("topic"), F.lit(0).cast("bigint").alias("batch_id"),
            F.lit(1).cast("bigint").alias("record_count"), F.lit(0.0).alias("null_rate_avg"), F.lit(0.0).alias("null_rate_max"),
            F.lit("h").alias("schema_hash"), F.lit(1).alias("column_count"), F.lit("h").alias("expected_schema_hash"),
            F.lit("{}").alias("null_rates_json"), F.lit(at).alias("profile_ts"), F.lit(at).cast("timestamp_ntz").alias("created_at"))

    loads = [(1, "orders_topic", "2024-01-01 10:00:30"), (2, "inventory_topic", "2024-01-01 10:00:30"), (3, "clickstream_topic", "2024-01-01 10:00:20")]
    for i, topic, at in loads:
        warehouse.write_load(profile(i, topic, at), "stream_profiles", topic, 0, "created_at")
        jobs.run_staging(warehouse, f"2024-02-01 00:00:0{i}")
    assert sorted(r.profile_id for r in warehouse.read("stg_stream_profiles").collect()) == [1, 2, 3]
    assert not jobs.pending(warehouse, "stg_stream_profiles", "stream_profiles")


def test_runs_of_one_time_keep_each_others_loads(spark, warehouse):
    def arrive(i, levels):
        lines = [json.dumps({"sku": p, "warehouse_id": "w", "stock_level": n, "event_time": "2024-01-05T01:00:00"}) for p, n in levels]
        raw = spark.createDataFrame([(x,) for x in lines], "value string")
        ingest.process_batch(events.parse(raw, INVENTORY, F.lit(AS_OF).cast("timestamp_ntz")), i, INVENTORY, warehouse, "s")

    seen = []
    for i in range(3):
        arrive(i, [(f"P{i}", 5), ("P", 10 + i)])
        jobs.run_staging(warehouse, AS_OF)
        seen.append(sorted((r.sku, r.stock_level) for r in warehouse.read("stg_inventory").collect()))
    assert seen == [sorted([("P", 10 + i), *((f"P{k}", 5) for k in range(i + 1))]) for i in range(3)]
    assert warehouse.read("staged_loads").filter("model = 'stg_inventory'").count() == 3
    jobs.run_staging(warehouse, AS_OF)  # nothing new
    assert sorted((r.sku, r.stock_level) for r in warehouse.read("stg_inventory").collect()) == seen[-1]


def test_many_new_keys_are_all_healed(spark, warehouse):
    raw = spark.createDataFrame([(click(1, **{f"k{i}": 1 for i in range(250)}),)], "value string")
    ingest.process_batch(events.parse(raw, CLICKS, F.lit(AS_OF).cast("timestamp_ntz")), 0, CLICKS, warehouse, "s")
    assert len(jobs.heal_schema(warehouse, CLICKS, 0, AS_OF)) == 250


def test_retention_removes_old_days(spark, warehouse):
    raw = spark.createDataFrame([(order(1, amount=-1.0),)], "value string")
    for i, day in enumerate(("2023-10-01", "2024-01-20")):
        batch = events.parse(raw, ORDERS, F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
        ingest.process_batch(batch, i, ORDERS, warehouse, "s")
    jobs.apply_retention(warehouse, AS_OF)
    assert [str(r.quarantine_ts)[:10] for r in warehouse.read("quarantine_log").collect()] == ["2024-01-20"]


def test_train_score_and_act(spark, tmp_path, warehouse):
    stamp = F.expr("timestamp_ntz'2024-01-31 22:00:00' - make_dt_interval(0, 0, cast(id AS int))")
    profiles = spark.range(120).select(
        F.col("id").alias("profile_id"), F.lit("orders_topic").alias("topic"), F.col("id").alias("batch_id"),
        F.when(F.col("id") == 5, 90000).otherwise(100 + F.col("id") % 7).cast("bigint").alias("record_count"),
        F.lit(0.01).alias("null_rate_avg"), F.lit(0.1).alias("null_rate_max"), F.lit("h").alias("schema_hash"),
        F.lit(14).alias("column_count"), F.lit("h").alias("expected_schema_hash"), F.lit("{}").alias("null_rates_json"),
        stamp.cast("string").alias("profile_ts"), stamp.alias("created_at"),
    )
    warehouse.write_load(profiles, "stream_profiles", "test", 0, "created_at")
    model = jobs.retrain(warehouse, AS_OF, str(tmp_path / "model"))
    actions = jobs.score_profiles(warehouse, model, "2024-01-31 22:30:00", "run1", hours=4)
    assert warehouse.read("score_log").count() == 120
    alerts = warehouse.read("anomaly_log").collect()
    assert 5 in {r.profile_id for r in alerts} and len(alerts) == model.meta["flagged"]
    assert {r.action for r in actions.collect()} <= {"dlq_reprocess"}
    jobs.score_profiles(warehouse, model, "2024-01-31 22:40:00", "run2", hours=4)
    assert warehouse.read("score_log").count() == 120  # nothing is scored twice


def test_contract_is_checked_on_write(spark, warehouse):
    df = warehouse.read("stream_profiles")
    assert df.count() == 0
    with pytest.raises(ContractError):
        conform(df.drop("topic"), "stream_profiles")
    with pytest.raises(ContractError):
        conform(df.withColumn("other", F.lit(1)), "stream_profiles")
    with pytest.raises(ContractError):
        conform(df.withColumn("batch_id", F.lit("x")), "stream_profiles")
    one = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    with pytest.raises(Exception, match="is NULL"):
        conform(one, "stream_profiles").collect()


def test_views_answer_sql(spark, warehouse):
    raw = spark.createDataFrame([(order(1),)], "value string")
    batch = events.parse(raw, ORDERS, F.lit(AS_OF).cast("timestamp_ntz"))
    ingest.process_batch(batch, 0, ORDERS, warehouse, "s")
    warehouse.register()
    row = warehouse.query("SELECT count(*) AS n, sum(amount) AS s FROM orders_raw").first().asDict()
    assert row == {"n": 1, "s": 5.0}
    assert warehouse.query("SELECT * FROM anomaly_log").count() == 0


def test_kafka_options():
    opts = events.kafka_options(ORDERS, "host:1")
    assert opts["subscribe"] == "orders_topic" and "maxOffsetsPerTrigger" not in opts
    assert (opts["startingOffsets"], opts["failOnDataLoss"]) == ("latest", "true")
    opts = events.kafka_options(CLICKS, "h", per_trigger=9, starting="earliest", fail_on_data_loss=False)
    assert (opts["maxOffsetsPerTrigger"], opts["startingOffsets"], opts["failOnDataLoss"]) == ("9", "earliest", "false")


def test_messages_for_kafka(spark):
    rows = spark.createDataFrame([("k", "v")], "id string, value string")
    message, options = events.for_kafka(rows, "dead_letters", "host:1", key="id")
    assert [tuple(r) for r in message.collect()] == [("k", "v")] and message.columns == ["key", "value"]
    assert options == {"kafka.bootstrap.servers": "host:1", "topic": "dead_letters"}
    assert events.for_kafka(rows, "t", "h")[0].first().key is None
