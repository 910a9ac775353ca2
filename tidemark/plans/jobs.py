"""Jobs over the stored tables: model runs with a quality gate, healing, replay, scoring."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import scalars as fx
from tidemark.operators import drift, forest, quality, repair
from tidemark.plans import marts, reports, staging
from tidemark.session import written_to
from tidemark.sources import events
from tidemark.sources.tables import CONTRACTS, LOAD_COLUMNS, Load, Warehouse
from tidemark.topics import Topic

#: loads of a staged table after which a model run folds them
MOST_LOADS = 16


class Pending(NamedTuple):
    """What a consumer has not taken from a table: loads with folders, and days that were folded."""

    loads: list[Load]
    days: list[str]

    def __bool__(self) -> bool:
        return bool(self.loads or self.days)


def pending(warehouse: Warehouse, consumer: str, table: str) -> Pending:
    """The table's loads that are not noted for the consumer. Tables are not read for it: loads are
    folder names, of which there are few, and only their notes are looked up."""
    loads, days = warehouse.open_loads(table), sorted(warehouse.folded_days(table))
    names = [(n.source, n.batch) for n in loads] + [(FOLDED, d) for d in days]
    if not names:
        return Pending([], [])
    wanted = warehouse.spark.createDataFrame(names, "source_load_source string, source_load_batch string")
    notes = warehouse.read("staged_loads").filter(F.col("model") == consumer)
    done = {tuple(r) for r in notes.join(F.broadcast(wanted), wanted.columns, "left_semi").select(*wanted.columns).distinct().collect()}
    return Pending([n for n in loads if (n.source, n.batch) not in done], [d for d in days if (FOLDED, d) not in done])


def taken(warehouse: Warehouse, consumer: str, table: str, what: Pending) -> DataFrame:
    """The rows of what is pending, with their load columns. Of a folded day, what the consumer had
    before the day was folded is left out."""
    rows = [warehouse.read_loads(table, what.loads)] if what.loads else []
    if what.days:
        notes = warehouse.read("staged_loads").filter(F.col("model") == consumer)
        had = notes.select(F.col("source_load_source").alias("load_source"), F.col("source_load_batch").alias("load_batch"))
        days = warehouse.loads(table, warehouse.added_columns(table)).filter(F.col("load_date").isin([date.fromisoformat(d) for d in what.days]))
        rows.append(days.join(had.distinct(), ["load_source", "load_batch"], "left_anti"))
    return reduce(DataFrame.unionByName, rows)


def note(warehouse: Warehouse, consumer: str, what: Pending, batch: str, as_of: str) -> None:
    """Note what a consumer has taken; the same batch again replaces its note."""
    names = [(consumer, n.source, n.batch) for n in what.loads] + [(consumer, FOLDED, d) for d in what.days]
    noted = warehouse.spark.createDataFrame(sorted(set(names)), "model string, source_load_source string, source_load_batch string")
    warehouse.write_load(noted.withColumn("staged_at", fx.as_of_ts(as_of)), "staged_loads", consumer, batch, F.lit(EPOCH).cast("date"))


def next_number(warehouse: Warehouse, consumer: str) -> str:
    """A running number: loads are in the order in which they are taken, whatever their times."""
    notes = warehouse.loads("staged_loads")
    if notes is None:
        return f"{1:012d}"
    last = notes.filter((F.col("model") == consumer) & F.col("load_batch").rlike("^[0-9]{12}$")).agg(F.max("load_batch")).first()[0]
    return f"{int(last or 0) + 1:012d}"


FOLDED, EPOCH = "folded day", "1970-01-01"


def run_staging(warehouse: Warehouse, as_of: str) -> None:
    """Stage the loads that a model has not staged yet, whatever times their rows or runs carry.

    A run that stops between storing rows and noting their loads stages these loads again, under
    the same number. Tables with many loads are folded into one.
    """
    for name, (source, build) in staging.MODELS.items():
        what = pending(warehouse, name, source)
        if not what:
            continue
        number = next_number(warehouse, name)
        table = warehouse.staged(name)
        table.append(build(taken(warehouse, name, source, what).drop(*LOAD_COLUMNS)), number)
        note(warehouse, name, what, number, as_of)
        if len(table.loads()) >= MOST_LOADS:
            table.compact(number)


def fold_closed_days(warehouse: Warehouse, before: str, as_of: str) -> dict[str, list[str]]:
    """Fold the days before a date of all tables that loads are written to; the days by table.

    Consumers that had taken all of a day before are noted to have it.
    """
    consumers = {r["model"] for r in warehouse.read("staged_loads").select("model").distinct().collect()}
    out = {}
    for table in CONTRACTS:
        if table == "staged_loads":
            continue
        left = {c: {n.date for n in pending(warehouse, c, table).loads} for c in consumers if reads(c) == table}
        out[table] = warehouse.fold(table, before)
        for consumer, open_days in left.items():
            whole = Pending([], [d for d in out[table] if d not in open_days])
            if whole:
                note(warehouse, consumer, whole, f"folded {before}", as_of)
    return {table: days for table, days in out.items() if days}


def reads(consumer: str) -> str:
    """The table that a consumer takes loads from."""
    if consumer in staging.MODELS:
        return staging.MODELS[consumer][0]
    kind = consumer.split(" ")[0]
    return {"heal": "quarantine_log", "replay": "dead_letters", "send": "dead_letters", "publish": "dead_letter_replays", "score": "stream_profiles"}[kind]


def run_marts(warehouse: Warehouse, as_of: str) -> None:
    stg = {name: warehouse.read(name) for name in staging.MODELS}
    warehouse.replace(
        marts.mart_pipeline_health(stg["stg_stream_profiles"], stg["stg_anomaly_log"], as_of),
        "mart_pipeline_health",
    )
    warehouse.replace(
        marts.mart_anomaly_summary(stg["stg_anomaly_log"], as_of), "mart_anomaly_summary"
    )
    warehouse.replace(
        marts.mart_stream_overview(
            stg["stg_orders"], stg["stg_clickstream"], stg["stg_inventory"], as_of
        ),
        "mart_stream_overview",
    )


def check_tables(warehouse: Warehouse, tables: list[str], as_of: str, stage: str) -> DataFrame:
    """Run the declared checks of the tables, store the results as rows and return them.

    Keys of a staged table are counted in its newest load as it came, since reading settles them.
    """
    results = []
    for name in tables:
        checks = quality.CHECKS.get(name, ())
        keys = [c for c in checks if c.kind == "unique" and name in staging.MODELS]
        rows = [c for c in checks if c not in keys]
        if rows:
            results.append(quality.run_checks(warehouse.read(name), name, rows))
        if keys:
            table = warehouse.staged(name)
            arrived = table.unsettled(table.loads()[-1]) if table.exists() else warehouse.read(name)
            results.append(quality.run_checks(arrived, name, keys))
    found = reduce(DataFrame.unionByName, results).withColumn("checked_at", fx.as_of_ts(as_of))
    found = written_to(found, warehouse.work(f"checks-{stage}"))
    warehouse.write_load(found, "quality_results", stage, as_of.replace(":", "-"), "checked_at")
    return found


def run_models(warehouse: Warehouse, as_of: str) -> None:
    """Staging, its checks, marts, their checks. A failing check stops the run."""
    run_staging(warehouse, as_of)
    quality.require_passed(check_tables(warehouse, list(staging.MODELS), as_of, "staging"))
    run_marts(warehouse, as_of)
    quality.require_passed(
        check_tables(
            warehouse, ["mart_pipeline_health", "mart_anomaly_summary", "mart_stream_overview"],
            as_of, "marts",
        )
    )


class TooManyColumns(ValueError):
    """More new columns than the caller allows; nothing was added."""


def heal_schema(
    warehouse: Warehouse, topic: Topic, batch_id: int, as_of: str, at_most: int | None = None
) -> list[str]:
    """Add a string column for every new, safely named key in the topic's quarantine.

    The stored change is what widens the table: reads name the column, and files without it
    give NULL. Running streams pick the columns up when they are next started. With `at_most`,
    more new columns at once are refused, not cut.
    """
    catalogue_keys(warehouse, topic, as_of)
    existing = warehouse.added_columns(topic.raw_table)
    found = drift.new_columns(warehouse.read("payload_keys"), topic, existing)
    found = written_to(found.filter("is_safe"), warehouse.work(f"new-columns-{topic.name}"))
    width = found.count()
    if at_most is not None and width > at_most:
        raise TooManyColumns(f"{topic.name}: {width} new columns, at most {at_most} are added")
    changes = drift.schema_change_rows(found, topic.raw_table, batch_id, as_of)
    row = changes.first()
    if row is None:
        return []
    warehouse.write_load(
        changes, "schema_changes", topic.name, f"{batch_id}-{as_of.replace(':', '-')}", "created_at"
    )
    return list(row["new_columns"])


def catalogue_keys(warehouse: Warehouse, topic: Topic, as_of: str) -> None:
    """Add the payload keys in the topic's new quarantine loads to the catalogue of those seen before."""
    consumer = f"heal {topic.name}"
    what = pending(warehouse, consumer, "quarantine_log")
    if not what:
        return
    number = next_number(warehouse, consumer)
    mine = taken(warehouse, consumer, "quarantine_log", what).filter(F.col("topic") == topic.name)
    known = warehouse.read("payload_keys").select("topic", "key").distinct()
    fresh = drift.incoming_keys(mine).join(known, ["topic", "key"], "left_anti")
    fresh = written_to(fresh.withColumn("first_seen", fx.as_of_ts(as_of)), warehouse.work("payload-keys"))
    warehouse.write_load(fresh, "payload_keys", topic.name, number, F.lit(EPOCH).cast("date"))
    note(warehouse, consumer, what, number, as_of)


Send = Callable[[DataFrame, str], None]


def to_folder(path: str) -> Send:
    """Sends texts to a folder, each load to one of its own, which a repeat replaces."""
    return lambda values, name: values.write.mode("overwrite").text(f"{path}/run={name}")


def to_kafka(topic_name: str, servers: str) -> Send:
    """Sends texts to a Kafka topic."""
    return lambda values, name: events.publish(values, topic_name, servers)


def send_pending(
    warehouse: Warehouse, consumer: str, table: str, values: Callable[[DataFrame], DataFrame], send: Send, as_of: str
) -> list[str]:
    """Send each load of a table that the consumer has not sent, and note it; the loads sent.

    A run that breaks off resends nothing that is noted: at most the load it broke in.
    """
    what, sent = pending(warehouse, consumer, table), []
    parts = [Pending([n], []) for n in what.loads] + [Pending([], [d]) for d in what.days]
    for part in parts:
        name = part.loads[0].batch if part.loads else part.days[0]
        number = next_number(warehouse, consumer)
        send(values(taken(warehouse, consumer, table, part)), name)
        note(warehouse, consumer, part, number, as_of)
        sent.append(name)
    return sent


def send_dead_letters(warehouse: Warehouse, send: Send, as_of: str) -> list[str]:
    """Send the envelopes of rejected records that were not sent yet, for instance to a Kafka topic."""
    envelope = F.to_json(F.struct("source", "batch_id", "reason", "record")).alias("value")
    return send_pending(warehouse, "send dead letters", "dead_letters", lambda rows: rows.select(envelope), send, as_of)


def replay_dead_letters(warehouse: Warehouse, topic: Topic, publish_to: str | Send, run_id: str, as_of: str) -> dict[str, int]:
    """Repair the topic's new dead letters and publish them again, each once.

    Only loads of letters that no run had are read; a batch that is written again is a load it had.
    The loads of a run are noted first, then what was decided is stored with the text to publish,
    then that is sent. A run that broke off in between is finished by the next, under its own id,
    so a repeated run with the same id changes nothing. Healed columns are published too.
    """
    consumer = f"replay {topic.name}"
    send = to_folder(publish_to) if isinstance(publish_to, str) else publish_to
    runs = _unfinished(warehouse, topic, consumer)
    if _decided(warehouse, run_id, topic) is None and run_id not in runs:
        what = pending(warehouse, consumer, "dead_letters")
        if what:
            note(warehouse, consumer, what, run_id, as_of)
            runs[run_id] = what
    for run, what in runs.items():
        _decide(warehouse, topic, what, run, as_of)
    mine = F.col("load_source") == topic.name
    send_pending(warehouse, f"publish {topic.name}", "dead_letter_replays", lambda rows: published_texts(rows.filter(mine)), send, as_of)
    decided = _decided(warehouse, run_id, topic)
    if decided is None:
        return {}
    totals = decided.filter("outcome IS NOT NULL").groupBy("outcome").agg(F.sum("copies").alias("records"))
    return {r["outcome"]: r["records"] for r in totals.collect()}


def _unfinished(warehouse: Warehouse, topic: Topic, consumer: str) -> dict[str, Pending]:
    """Runs that noted their loads and did not store what they decided, with these loads."""
    notes = warehouse.loads("staged_loads")
    if notes is None:
        return {}
    replays = warehouse.loads("dead_letter_replays")
    open_runs = notes.filter((F.col("model") == consumer) & ~F.col("load_batch").startswith("folded "))
    if replays is not None:
        done = replays.filter(F.col("load_source") == topic.name).select("load_batch").distinct()
        open_runs = open_runs.join(done, "load_batch", "left_anti")
    out: dict[str, Pending] = {}
    names = open_runs.select("load_batch", "source_load_source", "source_load_batch").collect()
    by_name: dict[tuple[str, str], list[Load]] = {}
    for load in warehouse.open_loads("dead_letters") if names else ():
        by_name.setdefault((load.source, load.batch), []).append(load)
    for run, source, batch in names:
        loads, days = out.setdefault(run, Pending([], []))
        if source == FOLDED:
            days.append(batch)
        loads.extend(by_name.get((source, batch), ()))
    return out


def _decide(warehouse: Warehouse, topic: Topic, what: Pending, run_id: str, as_of: str) -> None:
    healed = tuple(warehouse.added_columns(topic.raw_table))
    # the run's own notes are no reason to leave rows of a folded day out
    rows = taken(warehouse, f"replay {topic.name}, run {run_id}", "dead_letters", what)
    repaired = repair.repair(equal_letters(rows, topic), topic, ("letter_id", "copies"), healed)
    replay = repair.replayable(repaired, as_of)
    fields = [*topic.payload.names, *healed, "_reprocessed_at", "_original_reason"]
    known = ("letter_id", "copies", "outcome")
    published = replay.select(*known, F.to_json(F.struct(*fields)).alias("value"))
    settled = repaired.filter(F.col("outcome") != repair.REPROCESSED).select(*known, F.lit(None).cast("string").alias("value"))
    # a row without outcome, so that a run without letters is seen to be decided
    none = warehouse.spark.createDataFrame([(None, 0, None, None)], "letter_id string, copies bigint, outcome string, value string")
    decided = published.unionByName(settled).unionByName(none).withColumn("replayed_at", fx.as_of_ts(as_of))
    warehouse.write_load(decided, "dead_letter_replays", topic.name, run_id, "replayed_at")


def published_texts(decided: DataFrame) -> DataFrame:
    """A row `value` for each letter that was repaired, as often as it was sent."""
    ready = decided.filter(F.col("value").isNotNull())
    return ready.select("value", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).select("value")


def _decided(warehouse: Warehouse, run_id: str, topic: Topic) -> DataFrame | None:
    rows = warehouse.loads("dead_letter_replays")
    if rows is None:
        return None
    rows = rows.filter((F.col("load_batch") == run_id) & (F.col("load_source") == topic.name))
    return None if rows.isEmpty() else rows


def equal_letters(letters: DataFrame, topic: Topic) -> DataFrame:
    """The topic's letters, equal ones as one row with their number, counted before they travel."""
    held = ["source", "batch_id", "reason", "record"]
    counted = letters.filter(F.col("source") == topic.record_type).groupBy(*held).agg(F.count(F.lit(1)).alias("copies"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in held]
    return counted.withColumn("letter_id", F.sha2(F.to_json(F.array(*parts)), 256))


def apply_retention(warehouse: Warehouse, as_of: str, days: int = fv.QUARANTINE_DAYS) -> None:
    """Remove quarantined records of days that are out of retention."""
    limit = (date.fromisoformat(as_of[:10]) - timedelta(days=days)).isoformat()
    warehouse.drop_days("quarantine_log", limit)


def train(
    warehouse: Warehouse,
    as_of: str,
    model_path: str,
    days: int = 30,
    contamination: float = fv.CONTAMINATION,
) -> forest.Model:
    """Train on the stored profiles of the last days and save the model."""
    features = forest.feature_frame(warehouse.read("stream_profiles"), as_of, days)
    model = forest.fit(features, as_of, contamination)
    model.save(warehouse.spark, model_path)
    return model


def retrain(warehouse: Warehouse, as_of: str, model_path: str, days: int = 30) -> forest.Model:
    """The periodic training, which asks for more history than a first one."""
    forest.require_retrain_volume(warehouse.read("stream_profiles"), as_of, days)
    return train(warehouse, as_of, model_path, days)


def score_profiles(
    warehouse: Warehouse, model: forest.Model, as_of: str, run_id: str, hours: int | None = None
) -> DataFrame:
    """Score the profiles of new loads, of the last `hours` only if given; log all scores, the alerts, and return the actions.

    All scores are logged, not only the anomalies, so a normal profile is scored once. What is older
    than `hours` when its load is taken is not scored later either.
    """
    consumer = "score profiles"
    what = pending(warehouse, consumer, "stream_profiles")
    profiles = warehouse.read("stream_profiles")
    profiles = taken(warehouse, consumer, "stream_profiles", what).drop(*LOAD_COLUMNS) if what else profiles.limit(0)
    waiting = reports.unscored_profiles(profiles, warehouse.read("score_log"), as_of, hours)
    scored = written_to(
        forest.score(forest.feature_frame(waiting), model, as_of.replace(" ", "T")),
        warehouse.work("scores"),
    )
    # The score log comes after the alerts: it is what marks a profile as done.
    warehouse.write_load(forest.alerts(scored), "anomaly_log", "scoring", run_id, "created_at")
    warehouse.write_load(scored, "score_log", "scoring", run_id, "created_at")
    if what:
        note(warehouse, consumer, what, next_number(warehouse, consumer), as_of)
    return reports.remediation_actions(scored)
