"""Values that results depend on. Everything here is data: names, types, limits and defaults."""

# ---------------------------------------------------------------------------
# Event payloads as they arrive on each topic
# ---------------------------------------------------------------------------
ORDER_PAYLOAD = (
    "order_id string, customer_id string, product_id string, quantity int, amount double, "
    "currency string, status string, payment_method string, region string, event_time string, "
    "created_at string"
)
CLICK_PAYLOAD = (
    "session_id string, user_id string, page string, action string, device string, "
    "browser string, referrer string, duration_ms int, region string, event_time string"
)
INVENTORY_PAYLOAD = (
    "sku string, warehouse_id string, stock_level int, reserved_qty int, restock_flag boolean, "
    "restock_qty int, unit_cost double, last_movement string, event_time string"
)
INGEST_METADATA = "ingested_at timestamp_ntz, source_topic string"

# ---------------------------------------------------------------------------
# Stored tables outside the raw layer
# ---------------------------------------------------------------------------
STREAM_PROFILES = (
    "profile_id bigint, topic string, batch_id bigint, record_count bigint, null_rate_avg double, "
    "null_rate_max double, schema_hash string, column_count int, expected_schema_hash string, "
    "null_rates_json string, profile_ts string, created_at timestamp_ntz"
)
ANOMALY_LOG = (
    "anomaly_id bigint, profile_id bigint, topic string, batch_id bigint, anomaly_score double, "
    "severity string, is_schema_drift boolean, scored_at string, created_at timestamp_ntz"
)
QUARANTINE_LOG = (
    "topic string, batch_id bigint, reject_reason string, record_json string, "
    "quarantine_ts timestamp_ntz"
)
SCHEMA_CHANGES = (
    "topic string, table_name string, new_columns array<string>, batch_id bigint, "
    "detected_at string, created_at timestamp_ntz"
)
DEAD_LETTERS = (
    "source string, batch_id bigint, reason string, record string, quarantine_ts timestamp_ntz"
)
SCORE_LOG = (
    "anomaly_id bigint, profile_id bigint, topic string, batch_id bigint, anomaly_score double, "
    "severity string, is_anomaly boolean, is_schema_drift boolean, scored_at string, "
    "created_at timestamp_ntz"
)
SCHEMA_BASELINES = "topic string, baseline_batch_id bigint, baseline_hash string"
DEAD_LETTER_REPLAYS = (
    "letter_id string, copies bigint, outcome string, value string, "
    "replayed_at timestamp_ntz"
)
STAGED_LOADS = (
    "model string, source_load_source string, source_load_batch string, staged_at timestamp_ntz"
)
PAYLOAD_KEYS = "topic string, key string, first_seen timestamp_ntz"
QUALITY_RESULTS = (
    "table_name string, check_kind string, column_name string, violations bigint, "
    "passed boolean, checked_at timestamp_ntz"
)
REQUIRED_IN_PROFILES = (
    "topic", "batch_id", "record_count", "null_rate_avg", "null_rate_max", "schema_hash",
    "column_count",
)

# ---------------------------------------------------------------------------
# validation
# ---------------------------------------------------------------------------
ORDER_REQUIRED = (
    "order_id", "customer_id", "product_id", "amount", "status", "event_time", "region",
)
CLICK_REQUIRED = ("session_id", "user_id", "page", "action", "event_time")
INVENTORY_REQUIRED = ("sku", "warehouse_id", "stock_level", "event_time")
NULL_REQUIRED_FIELD = "NULL_REQUIRED_FIELD"
BUSINESS_RULE_VIOLATION = "BUSINESS_RULE_VIOLATION"

# ---------------------------------------------------------------------------
# Dead-letter repair defaults
# ---------------------------------------------------------------------------
ORDER_DEFAULTS = {
    "status": "unknown", "currency": "INR", "region": "XX", "payment_method": "unknown",
    "quantity": 1,
}
CLICK_DEFAULTS = {
    "device": "unknown", "browser": "unknown", "referrer": "unknown", "action": "view",
}
INVENTORY_DEFAULTS = {"last_movement": "unknown", "restock_flag": False, "restock_qty": 0}
# Keys that producers and the replay add for their own use; they are never new columns
INTERNAL_KEYS = ("_fault_injected", "_reprocessed_at", "_original_reason")

# ---------------------------------------------------------------------------
# Retention and ingest settings
# ---------------------------------------------------------------------------
QUARANTINE_DAYS = 90
TRIGGER_INTERVAL = "30 seconds"
STARTING_OFFSETS = "latest"
# of compressed JSON files that a replay's micro-batch takes: some 10 million orders
REPLAY_BATCH_BYTES = 256 << 20

# ---------------------------------------------------------------------------
# Accepted values and bands
# ---------------------------------------------------------------------------
ORDER_STATUSES = (
    "PLACED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED", "UNKNOWN",
)
SEVERITIES = ("NORMAL", "MEDIUM", "HIGH", "CRITICAL")
SEVERITY_RANK = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2}
SEVERITY_BELOW = {"CRITICAL": -0.40, "HIGH": -0.25, "MEDIUM": -0.15}
STOCK_BELOW = {"CRITICAL": 50, "LOW": 200, "MEDIUM": 500}
CONVERSION_ACTIONS = ("purchase", "add_to_cart")
SLA_GREEN, SLA_AMBER = 99, 95
HEAL_ACTION, REPLAY_ACTION = "schema_heal", "dlq_reprocess"

# ---------------------------------------------------------------------------
# Anomaly model
# ---------------------------------------------------------------------------
FEATURES = (
    "record_count", "null_rate_avg", "null_rate_max", "column_count", "hour_of_day",
    "day_of_week",
)
TREES = 300
SUBSAMPLE = 256
CONTAMINATION = 0.05
SEED = 42
MIN_TRAINING_ROWS = 50
MIN_RETRAIN_ROWS = 100
