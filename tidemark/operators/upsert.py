"""Incremental load: high-water filter, merge by key, and staged tables that are appended to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.sources import folders


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows later than the target's latest; all rows when the target is empty."""
    latest = target.agg(F.max(column)).scalar()
    return source.filter(latest.isNull() | (F.col(column) > latest))


def merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows plus the target rows whose key did not come in again.

    Keys compare NULL-safe. A column that only one side has is NULL on the other.
    """
    return incoming.unionByName(without_keys(target, incoming, keys), allowMissingColumns=True)


def without_keys(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Distinct first: a key that came in many times is combined before the shuffle.
    arrived = incoming.select(*keys).distinct().alias("arrived")
    same = [F.col(f"kept.{k}").eqNullSafe(F.col(f"arrived.{k}")) for k in keys]
    return target.alias("kept").join(arrived, reduce(Column.__and__, same), "left_anti")


@dataclass(frozen=True)
class StagedTable:
    """Parquet table that loads are appended to; what a key's rows are is settled when it is read.

    A load is a folder named by its id, so that writing it again replaces it, and costs no look at
    the rows stored before. Read, a key has its latest row by `newest` (of equal times, of the
    latest load), or, with `newest` None, all rows of the latest load that has the key. Load ids
    sort in the order of the loads. `compact` writes what is read into a new generation, which
    readers see once it is complete, and which needs no settling until more is appended. One writer
    at a time.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    newest: str | None

    def append(self, rows: DataFrame, load_id: str) -> None:
        self._write(rows, self._generation() or 0, load_id)

    def exists(self) -> bool:
        return self._generation() is not None

    def loads(self) -> list[str]:
        """Ids of the loads that a read settles, in order."""
        now = self._generation()
        return [load.removeprefix("load ") for g, load in self._folders() if int(g) == now]

    def read(self) -> DataFrame:
        """The table's rows now. A column that a load lacks is NULL there."""
        now, loads = self._generation(), self.loads()
        settled = self._rows(now) if now and len(loads) == 1 else self._settled(now)
        return settled.drop("load_id")

    def unsettled(self, load_id: str) -> DataFrame:
        """The rows of one load as they were appended."""
        return self._rows(self._generation()).filter(F.col("load_id") == f"load {load_id}").drop("load_id")

    def compact(self, load_id: str) -> None:
        """Fold all loads into one, in a generation of its own. Older generations are left as
        they are and may be removed."""
        now = self._generation()
        if now is not None:
            self._write(self._settled(now).drop("load_id"), now + 1, load_id)

    def _rows(self, generation: int | None) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/generation={generation}")

    def _settled(self, generation: int | None) -> DataFrame:
        rows = self._rows(generation)
        if self.newest is not None:
            return latest_per_key(rows, self.keys, self.newest, ("load_id",))
        place = F.rank().over(Window.partitionBy(*self.keys).orderBy(F.desc("load_id")))
        return rows.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")

    def _folders(self) -> list[tuple[str, ...]]:
        return folders.partitions(self.spark, self.path, ("generation", "load_id"))

    def _generation(self) -> int | None:
        """The newest generation, from folder names; a table that was never written has none."""
        return max((int(g) for g, _ in self._folders()), default=None)

    def _write(self, rows: DataFrame, generation: int, load_id: str) -> None:
        """Written beside the table, then put in its place, so that a broken write is never read."""
        place = f"{self.path}/generation={generation}/load_id={folders.escaped(self.spark, f'load {load_id}')}"
        beside = f"{self.path}/_writing-{uuid.uuid4().hex}"
        rows.write.parquet(beside)
        folders.remove(self.spark, place)
        folders.rename(self.spark, beside, place)
