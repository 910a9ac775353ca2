from pyspark.sql import functions as F

from tidemark.operators import repair as rp
from tidemark.topics import CLICKS, INVENTORY, ORDERS

OK = ('"order_id":"1","customer_id":"c","product_id":"p","amount":5.0,"status":"placed",'
      '"event_time":"t","region":"IN"')


def letters(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, batch_id long, reason string, record string")


def one(spark, topic, reason, record):
    return rp.repair(letters(spark, (topic.record_type, 1, reason, record)), topic).first()


def test_negative_amount_is_mended(spark):
    r = one(spark, ORDERS, "BUSINESS_RULE_VIOLATION", "{%s}" % OK.replace("5.0", "-5.0"))
    assert (r.amount, r.outcome, r.quantity) == (5.0, "reprocessed", None)


def test_zero_amount_and_missing_id_stay_broken(spark):
    assert one(spark, ORDERS, "BUSINESS_RULE_VIOLATION", "{%s}" % OK.replace("5.0", "0")).outcome == "unfixable"
    r = one(spark, ORDERS, "NULL_REQUIRED_FIELD", "{%s}" % OK.replace('"order_id":"1",', ""))
    assert (r.outcome, r.order_id, r.quantity, r.currency) == ("unfixable", None, 1, "INR")


def test_null_defaults(spark):
    r = one(spark, ORDERS, "NULL_REQUIRED_FIELD", "{%s}" % OK.replace('"placed"', "null").replace('"IN"', "null"))
    assert (r.status, r.region, r.payment_method, r.outcome) == ("unknown", "XX", "unknown", "reprocessed")
    r = one(spark, CLICKS, "NULL_REQUIRED_FIELD", '{"session_id":"s","user_id":"u","page":"/","event_time":"t"}')
    assert (r.action, r.device, r.referrer, r.outcome) == ("view", "unknown", "unknown", "reprocessed")
    r = one(spark, INVENTORY, "NULL_REQUIRED_FIELD", '{"sku":"s","warehouse_id":"w","stock_level":3}')
    assert (r.restock_flag, r.restock_qty, r.last_movement, r.outcome) == (False, 0, "unknown", "unfixable")


def test_negative_stock_becomes_zero(spark):
    r = one(spark, INVENTORY, "BUSINESS_RULE_VIOLATION",
            '{"sku":"s","warehouse_id":"w","stock_level":-3,"event_time":"t"}')
    assert (r.stock_level, r.outcome, r.restock_flag) == (0, "reprocessed", None)


def test_other_reasons_sources_and_unreadable_records(spark):
    df = letters(
        spark,
        ("order", 1, "OTHER", "{%s}" % OK), ("order", 1, None, "{%s}" % OK),
        ("order", 1, "NULL_REQUIRED_FIELD", "junk"), ("click", 1, "NULL_REQUIRED_FIELD", "{}"),
    )
    counts = {r.outcome: r.records for r in rp.outcome_counts(rp.repair(df, ORDERS)).collect()}
    assert counts == {"skipped": 2, "error": 1}


def test_replay_takes_all_and_stamps(spark):
    df = letters(spark, *[("order", b, "NULL_REQUIRED_FIELD", "{%s}" % OK) for b in range(700)])
    out = rp.replayable(rp.repair(df, ORDERS), "2024-01-01T00:00:00")
    got = out.collect()
    assert sorted(r.batch_id for r in got) == list(range(700))
    assert {r["_original_reason"] for r in got} == {"NULL_REQUIRED_FIELD"}
    text = rp.as_events(out, ORDERS).first().value
    assert '"order_id":"1"' in text and '"_reprocessed_at":"2024-01-01T00:00:00"' in text


def test_healed_columns_survive_repair(spark):
    df = letters(spark, ("order", 1, "NULL_REQUIRED_FIELD", '{%s,"Coupon":"A"}' % OK), ("order", 1, "NULL_REQUIRED_FIELD", '{%s,"Coupon":"A","coupon":"B"}' % OK))
    out = rp.replayable(rp.repair(df, ORDERS, healed=("coupon",)), "2024-01-01T00:00:00")
    assert sorted(r.coupon for r in out.collect()) == ["A", '["A","B"]']
    assert all('"coupon"' in r.value for r in rp.as_events(out, ORDERS, ("coupon",)).collect())


def test_repair_never_loses_a_row(spark):
    df = letters(spark, *[("order", i, r, "{%s}" % OK) for i in range(9)
                          for r in ("NULL_REQUIRED_FIELD", "BUSINESS_RULE_VIOLATION", "X")])
    assert rp.repair(df, ORDERS).count() == 27
