"""Stored tables: contracts, paths, checked writes and views for SQL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import fixed_values as fv
from tidemark.operators.drift import healed_columns
from tidemark.operators.upsert import StagedTable
from tidemark.plans.staging import MODELS, NEWEST, UNIQUE_KEYS
from tidemark.sources import folders
from tidemark.topics import TOPICS, struct_of


class ContractError(ValueError):
    """A frame does not fit the table it is written to."""


# Tables with a declared contract, and the columns that must not be NULL
CONTRACTS: dict[str, str] = {
    **{t.raw_table: f"{t.payload_ddl}, {t.metadata_ddl}" for t in TOPICS.values()},
    "stream_profiles": fv.STREAM_PROFILES,
    "anomaly_log": fv.ANOMALY_LOG,
    "quarantine_log": fv.QUARANTINE_LOG,
    "schema_changes": fv.SCHEMA_CHANGES,
    "dead_letters": fv.DEAD_LETTERS,
    "score_log": fv.SCORE_LOG,
    "schema_baselines": fv.SCHEMA_BASELINES,
    "dead_letter_replays": fv.DEAD_LETTER_REPLAYS,
    "quality_results": fv.QUALITY_RESULTS,
    "staged_loads": fv.STAGED_LOADS,
    "payload_keys": fv.PAYLOAD_KEYS,
}
NOT_NULL: dict[str, tuple[str, ...]] = {"stream_profiles": fv.REQUIRED_IN_PROFILES}
# Named sources of the models
SOURCES = (*[t.raw_table for t in TOPICS.values()], "stream_profiles", "anomaly_log",
           "quarantine_log", "schema_changes")
LAYERS = {
    **{t.raw_table: "raw" for t in TOPICS.values()},
    "stream_profiles": "metrics",
    "schema_baselines": "metrics",
    "anomaly_log": "alerts",
    "score_log": "alerts",
    "quarantine_log": "alerts",
    "schema_changes": "alerts",
    "dead_letters": "alerts",
    "dead_letter_replays": "alerts",
    "quality_results": "metrics",
    "staged_loads": "metrics",
    "payload_keys": "metrics",
    **{name: "staging" for name in UNIQUE_KEYS},
    "mart_pipeline_health": "marts",
    "mart_anomaly_summary": "marts",
    "mart_stream_overview": "marts",
}
LOAD_COLUMNS = ("load_date", "load_source", "load_batch")
#: what a file of a folded day holds at most, by the size of the files it comes from
FOLDED_BYTES = 128 << 20


class Load(NamedTuple):
    """One load of a table: a folder of its own, unless its day was folded."""

    date: str
    source: str
    batch: str


def contract_of(table: str, added: Sequence[str] = ()) -> StructType:
    schema = StructType([*struct_of(CONTRACTS[table]).fields])
    for name in added:
        schema = schema.add(name, "string")
    return schema


def conform(df: DataFrame, table: str, added: Sequence[str] = ()) -> DataFrame:
    """The frame in contract order and types; `added` are healed string columns.

    Unknown or missing columns and types that do not match are refused; a NULL in a NOT NULL
    column fails the write.
    """
    contract = contract_of(table, added)
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    unknown = [c for c in df.columns if c not in contract.names]
    got = dict(df.dtypes)
    wrong = [
        f"{f.name} {got[f.name]} not {f.dataType.simpleString()}"
        for f in contract.fields
        if f.name in got and got[f.name] != f.dataType.simpleString()
    ]
    if missing or unknown or wrong:
        raise ContractError(f"{table}: missing {missing}, unknown {unknown}, types {wrong}")
    required = NOT_NULL.get(table, ())
    return df.select(
        *[
            F.coalesce(
                F.col(f.name),
                F.raise_error(F.lit(f"{table}.{f.name} is NULL")).cast(f.dataType),
            ).alias(f.name)
            if f.name in required
            else F.col(f.name)
            for f in contract.fields
        ]
    )


@dataclass(frozen=True)
class Warehouse:
    """All tables under one root folder that driver and executors share."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{LAYERS[table]}/{table}"

    def work(self, purpose: str) -> str:
        """A new folder for an intermediate table."""
        return f"{self.root}/_work/{purpose}-{uuid.uuid4().hex}"

    def staged(self, table: str) -> StagedTable:
        return StagedTable(self.spark, self.path(table), UNIQUE_KEYS[table], NEWEST[table])

    def exists(self, table: str) -> bool:
        if table in UNIQUE_KEYS:
            return self.staged(table).exists()
        if table not in CONTRACTS:
            return bool(self._versions(table))
        return self.loads(table) is not None

    def loads(self, table: str, added: Sequence[str] = ()) -> DataFrame | None:
        """A loaded table with its load columns, None when it was never written.

        The schema is given, not inferred, so no file is opened to plan a read. A load that has a
        folder counts as it is there, also when its day was folded before.
        """
        schema = contract_of(table, added)
        names = list(schema.names)
        for name, kind in zip(LOAD_COLUMNS, ("date", "string", "string")):
            schema = schema.add(name, kind)
        open_loads, days = self.open_loads(table), self.folded_days(table)
        out = None
        if open_loads:
            out = self.spark.read.schema(schema).parquet(self.path(table))
        if days:
            folded = self.spark.read.schema(schema).parquet(self._days(table))
            again = [n for n in open_loads if n.date in days]
            if again:
                late = self.spark.createDataFrame(again, "load_date string, load_source string, load_batch string")
                late = late.withColumn("load_date", F.col("load_date").cast("date"))
                folded = folded.join(late, [*LOAD_COLUMNS], "left_anti")
            folded = folded.select(*names, *LOAD_COLUMNS)
            out = folded if out is None else out.unionByName(folded)
        return out

    def open_loads(self, table: str) -> list[Load]:
        """The loads that have folders, from their names. There are few: days that are over get folded."""
        return [Load(*x) for x in folders.partitions(self.spark, self.path(table), LOAD_COLUMNS)]

    def folded_days(self, table: str) -> set[str]:
        return {d for (d,) in folders.partitions(self.spark, self._days(table), ("load_date",))}

    def read_loads(self, table: str, loads: Sequence[Load]) -> DataFrame:
        """The rows of some loads that have folders. Which ones is a literal filter on the partition
        columns, so no other folder's files are planned or opened."""
        added = self.added_columns(table)
        schema = contract_of(table, added)
        names = list(schema.names)
        for name, kind in zip(LOAD_COLUMNS, ("date", "string", "string")):
            schema = schema.add(name, kind)
        groups: dict[tuple[str, str], list[str]] = {}
        for load in loads:
            groups.setdefault((load.date, load.source), []).append(load.batch)
        date, source, batch = map(F.col, LOAD_COLUMNS)
        one = [(date == F.lit(d).cast("date")) & (source == s) & batch.isin(b) for (d, s), b in groups.items()]
        rows = self.spark.read.schema(schema).parquet(self.path(table))
        return rows.filter(reduce(Column.__or__, one)).select(*names, *LOAD_COLUMNS)

    def fold(self, table: str, before: str) -> list[str]:
        """Rewrite each day before a date, which has several loads, as a few files; the days folded.

        The day is written beside the table, renamed into place, and then its folders go. At any
        moment in between the rows read are the same: a load that still has its folder is read from
        there. So is a load that is written again, or late, after its day was folded. A day is
        folded once.
        """
        days: dict[str, list[Load]] = {}
        for load in self.open_loads(table):
            days.setdefault(load.date, []).append(load)
        done, added, folded = self.folded_days(table), self.added_columns(table), []
        for date, loads in days.items():
            if date >= before or date in done or len(loads) < 2:
                continue
            beside = f"{self._days(table)}/_writing-{uuid.uuid4().hex}"
            files = 1 + folders.size(self.spark, f"{self.path(table)}/load_date={date}") // FOLDED_BYTES
            rows = self.read_loads(table, loads).drop("load_date")
            # no shuffle: each task reads about FOLDED_BYTES of the day's files, however large the day
            rows.coalesce(int(files)).write.parquet(beside)
            folders.rename(self.spark, beside, f"{self._days(table)}/load_date={date}")
            for load in loads:
                folders.remove(self.spark, self._folder(table, load))
            folded.append(date)
        return folded

    def _days(self, table: str) -> str:
        return f"{self.path(table)}_days"

    def _folder(self, table: str, load: Load) -> str:
        parts = [f"{n}={folders.escaped(self.spark, v)}" for n, v in zip(LOAD_COLUMNS, load)]
        return "/".join([self.path(table), *parts])

    def added_columns(self, table: str) -> list[str]:
        """String columns that healing has added to a raw table."""
        topic = next((t for t in TOPICS.values() if t.raw_table == table), None)
        changes = None if topic is None else self.loads("schema_changes")
        return [] if changes is None else healed_columns(changes, topic)

    def read(self, table: str, with_load: bool = False) -> DataFrame:
        """A table as a frame; a loaded one that was never written is empty.

        `with_load` adds the columns that tell which load a row came with. Files written before
        a column was added read as NULL there.
        """
        if table in UNIQUE_KEYS:
            staged = self.staged(table)
            if staged.exists():
                return staged.read()
            source, build = MODELS[table]
            return build(self.read(source)).limit(0)
        if table not in CONTRACTS:
            return self.spark.read.parquet(f"{self.path(table)}/version={self._versions(table)[-1]}")
        added = self.added_columns(table)
        schema = contract_of(table, added)
        rows = self.loads(table, added)
        if rows is None:
            for name, kind in zip(LOAD_COLUMNS, ("date", "string", "string")):
                schema = schema.add(name, kind) if with_load else schema
            return self.spark.createDataFrame([], schema)
        return rows.select(*schema.names, *(LOAD_COLUMNS if with_load else ()))

    def write_load(
        self,
        df: DataFrame,
        table: str,
        source: str,
        batch: int | str,
        stamp: str | Column,
        added: Sequence[str] = (),
    ) -> None:
        """Write one load into a folder of its own, (day of `stamp`, source, batch).

        Writing the same load again replaces it, so a repeated batch leaves no second copy.
        Errors reach the caller. `added` names healed columns that the load carries. Files are as
        the rows come; `fold` makes few of them when the day is over.
        """
        day = F.col(stamp) if isinstance(stamp, str) else stamp
        (
            conform(df, table, added)
            .withColumn("load_date", day.cast("date"))
            .withColumn("load_source", F.lit(source))
            .withColumn("load_batch", F.lit(str(batch)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*LOAD_COLUMNS)
            .parquet(self.path(table))
        )

    def replace(self, df: DataFrame, table: str) -> None:
        """Full refresh: readers have the old version until the new one is complete, and it may be
        read by `df` itself. A refresh that fails leaves the old one. The version before the last
        is removed, which a reader may have begun with."""
        versions = self._versions(table)
        beside = f"{self.path(table)}/_writing-{uuid.uuid4().hex}"
        df.write.parquet(beside)
        folders.rename(self.spark, beside, f"{self.path(table)}/version={1 + max(versions, default=0)}")
        for old in versions[:-1]:
            folders.remove(self.spark, f"{self.path(table)}/version={old}")

    def _versions(self, table: str) -> list[int]:
        return sorted(int(v) for (v,) in folders.partitions(self.spark, self.path(table), ("version",)))

    def drop_days(self, table: str, before: str) -> None:
        """Remove the folders of all days before a date: what retention no longer keeps."""
        for root in (self.path(table), self._days(table)):
            for (date,) in folders.partitions(self.spark, root, ("load_date",)):
                if date < before:
                    folders.remove(self.spark, f"{root}/load_date={date}")

    def register(self, *tables: str) -> None:
        """Make tables available to `query` under their names."""
        for table in tables or SOURCES:
            self.read(table).createOrReplaceTempView(table)

    def query(self, sql: str) -> DataFrame:
        """Any read query over the registered tables."""
        return self.spark.sql(sql)
