"""One declaration per event topic; every other module is driven by these."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import fixed_values as fv


@cache
def struct_of(ddl: str) -> StructType:
    """Schema of a DDL text. Needs a session, so never call it while modules load."""
    return StructType.fromDDL(ddl)


@dataclass(frozen=True)
class Topic:
    name: str
    record_type: str
    raw_table: str
    payload_ddl: str
    metadata_ddl: str
    required: tuple[str, ...]
    rule: str | None = None  # SQL condition a good record meets
    rule_repairs: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    null_defaults: dict[str, object] = field(default_factory=dict)

    @property
    def payload(self) -> StructType:
        return struct_of(self.payload_ddl)

    @property
    def table_schema(self) -> StructType:
        return struct_of(f"{self.payload_ddl}, {self.metadata_ddl}")

    @property
    def expected_columns(self) -> list[str]:
        return self.table_schema.names


ORDERS = Topic(
    name="orders_topic",
    record_type="order",
    raw_table="orders_raw",
    payload_ddl=fv.ORDER_PAYLOAD,
    metadata_ddl=f"{fv.INGEST_METADATA}, ingest_date date",
    required=fv.ORDER_REQUIRED,
    rule="amount > 0 AND amount < double('Infinity')",  # which NaN and infinities do not meet
    rule_repairs={"amount": F.abs},
    null_defaults=fv.ORDER_DEFAULTS,
)
CLICKS = Topic(
    name="clickstream_topic",
    record_type="click",
    raw_table="clickstream_raw",
    payload_ddl=fv.CLICK_PAYLOAD,
    metadata_ddl=fv.INGEST_METADATA,
    required=fv.CLICK_REQUIRED,
    null_defaults=fv.CLICK_DEFAULTS,
)
INVENTORY = Topic(
    name="inventory_topic",
    record_type="inventory",
    raw_table="inventory_raw",
    payload_ddl=fv.INVENTORY_PAYLOAD,
    metadata_ddl=fv.INGEST_METADATA,
    required=fv.INVENTORY_REQUIRED,
    rule="stock_level >= 0",
    rule_repairs={"stock_level": lambda c: F.when(c < 0, 0).otherwise(c)},
    null_defaults=fv.INVENTORY_DEFAULTS,
)

TOPICS: dict[str, Topic] = {t.name: t for t in (ORDERS, CLICKS, INVENTORY)}
BY_RECORD_TYPE: dict[str, Topic] = {t.record_type: t for t in TOPICS.values()}
