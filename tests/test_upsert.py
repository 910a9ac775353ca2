from pyspark.sql import functions as F

from tidemark.operators import upsert as up

DDL = "k string, k2 string, v int, t timestamp_ntz"


def frame(spark, *rows):
    return spark.createDataFrame(
        [(k, k2, v, t) for k, k2, v, t in rows], "k string, k2 string, v int, t string"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))


def table(spark, path, newest="t"):
    return up.StagedTable(spark, str(path), ("k", "k2"), newest)


def test_merge_is_null_safe_and_adds_columns(spark, rows):
    old = frame(spark, ("a", None, 1, "2024-01-01"), ("b", "x", 2, "2024-01-01"))
    new = frame(spark, ("a", None, 9, "2024-01-02")).withColumn("extra", F.lit("e"))
    assert rows(up.merge(old, new, ["k", "k2"]), "k", "v", "extra") == [("a", 9, "e"), ("b", 2, None)]
    assert rows(up.merge(old.limit(0), new, ["k", "k2"]), "k", "v") == [("a", 9)]


def test_merge_joins_by_hash_of_keys(spark):
    old, new = frame(spark, ("a", None, 1, "2024-01-01")), frame(spark, ("a", "x", 1, "2024-01-01"))
    plan = up.without_keys(old, new, ["k", "k2"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_newer_than(spark, rows):
    old = frame(spark, ("a", None, 1, "2024-01-01"))
    src = frame(spark, ("b", None, 1, "2024-01-01"), ("c", None, 2, "2024-01-02"))
    assert rows(up.newer_than(src, old, "t"), "k") == [("c",)]
    assert up.newer_than(src, old.limit(0), "t").count() == 2


def test_loads_add_columns_and_repeat(spark, tmp_path, rows):
    t = table(spark, tmp_path / "t")
    assert not t.exists()
    t.append(frame(spark, *[(str(i), None, i, f"2024-01-0{1 + i % 3}") for i in range(9)]), "1")
    assert t.exists() and t.read().count() == 9
    change = frame(spark, ("0", None, 100, "2024-01-05"), ("new", None, 1, "2024-01-01")).withColumn("extra", F.lit("e"))
    for _ in range(2):
        t.append(change, "2")
        got = rows(t.read(), "k", "v", "extra")
        assert len(got) == 10 and ("0", 100, "e") in got and ("1", 1, None) in got


def test_the_newest_row_wins_whenever_it_was_loaded(spark, tmp_path, rows):
    t = table(spark, tmp_path / "t")
    t.append(frame(spark, ("a", "x", 2, "2024-01-02"), ("b", None, 5, "2024-01-01")), "1")
    t.append(frame(spark, ("a", "x", 1, "2024-01-01"), ("b", None, 6, "2024-01-01")), "2")
    assert rows(t.read(), "k", "v") == [("a", 2), ("b", 6)]


def test_without_a_time_the_latest_load_of_a_key_is_kept_whole(spark, tmp_path, rows):
    t = table(spark, tmp_path / "t", None)
    t.append(frame(spark, ("a", None, 1, "2024-01-01"), ("a", None, 2, "2024-01-01"), ("b", "x", 3, "2024-01-01")), "1")
    t.append(frame(spark, ("a", None, 7, "2024-01-01"), ("a", None, 8, "2024-01-01")), "2")
    assert rows(t.read(), "k", "v") == [("a", 7), ("a", 8), ("b", 3)]


def test_compaction_keeps_rows_and_later_loads_go_on(spark, tmp_path, rows):
    t = table(spark, tmp_path / "t")
    for i in range(5):
        t.append(frame(spark, ("a", None, i, f"2024-01-0{i + 1}"), (f"k{i}", None, i, "2024-01-01")), str(i))
    before = rows(t.read(), "k", "v")
    t.compact("5")
    assert rows(t.read(), "k", "v") == before and len(before) == 6
    assert len(list((tmp_path / "t" / "generation=1").glob("load_id=*"))) == 1
    t.append(frame(spark, ("a", None, 99, "2024-02-01")), "6")
    assert ("a", 99) in rows(t.read(), "k", "v")


def test_a_second_load_reads_nothing_of_the_first(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    days = spark.range(900).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("k2"), F.lit(1).alias("v"),
                                   F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id AS int))").alias("t"))
    t.append(days, "1")
    files = list((tmp_path / "t").rglob("*.parquet"))
    t.append(days.withColumn("v", F.lit(2)), "2")
    assert len(files) <= 8 and set(files) < set((tmp_path / "t").rglob("*.parquet"))
    assert t.read().filter("v = 2").count() == 900 == t.read().count()
