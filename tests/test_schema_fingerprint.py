"""A batch's fingerprint comes with the keys it stands for."""

from checks.queries import QUERIES


def test_fingerprint_names_its_keys(spark, tmp_path):
    rows = [
        (1, "2024-01-01 01:00:00", 7, "click", 1.5, None),
        (101, "2024-01-01 02:00:00", 8, "view", 2.0, None),  # adds new_column_v2
        (109, "2024-01-02 01:00:00", 9, "view", 1.0, None),  # not json
        (2, "2024-01-02 02:00:00", 9, "click", 3.0, None),
    ]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .selectExpr("event_id", "cast(ts AS timestamp) AS ts", "user_id", "event_type", "value", "props") \
        .write.parquet(str(tmp_path / "events.parquet"))
    got = {r.batch_id: r.columns for r in QUERIES["schema_fingerprint"](spark, str(tmp_path)).collect()}
    base = "action,duration_ms,ingested_at,{}session_id,source_topic,user_id"
    assert got == {0: base.format("new_column_v2,"), 1: base.format("")}
