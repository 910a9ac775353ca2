"""A replay through the stream: what it keeps on disk is compressed and bounded by the micro-batch."""

import os

from pyspark.sql import functions as F

from tidemark.operators import validate
from tidemark.sources.tables import Warehouse
from tidemark.streaming import ingest
from tidemark.topics import ORDERS


def test_replay_compresses_its_files_and_bounds_its_batches(spark, tmp_path, monkeypatch, rows):
    n = 400
    sent = spark.range(n).repartition(4).select(
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("O"), "id")).alias("order_id"), F.lit("c").alias("customer_id"),
        F.lit("p").alias("product_id"), F.lit(2).alias("quantity"), (F.col("id") % 7 - 1.0).alias("amount"),
        F.lit(None).cast("string").alias("currency"), F.lit("placed").alias("status"), F.lit("card").alias("payment_method"),
        F.lit("in").alias("region"), F.lit("2024-01-05").alias("event_time"), F.lit(None).cast("string").alias("created_at"),
    )
    folders = iter((tmp_path / "one", tmp_path / "many"))
    monkeypatch.setattr(ingest, "new_folder", lambda spark, purpose: str(next(folders)))
    one = rows(ingest.replay_as_stream(sent, ORDERS), *ORDERS.payload.names)
    many = rows(ingest.replay_as_stream(sent, ORDERS, batch_bytes=1), *ORDERS.payload.names)
    good = validate.good_rows(validate.with_reject_reason(sent, ORDERS.record_type))
    assert one == many == rows(good, *ORDERS.payload.names)

    names = [f for f in os.listdir(tmp_path / "many/events") if f.startswith("part-")]
    assert len(names) == 4 and all(f.endswith(".gz") for f in names)
    batches = []
    for folder in ("one", "many"):
        tables = Warehouse(spark, str(tmp_path / folder / "tables"))
        counts = [r.record_count for r in tables.read("stream_profiles").collect()]
        assert sum(counts) == n
        assert tables.read("quarantine_log").filter("record_json LIKE '{%'").count() == n - len(one)
        batches.append(len(counts))
    assert batches == [1, 4]  # one file a micro-batch at least
