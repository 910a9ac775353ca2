"""Isolation forest (Liu, Ting, Zhou: Isolation Forest, ICDM 2008) as Spark jobs.

Training: one hash-ranked draw gives every tree its sample, and all trees grow level by level in
the same window aggregations: a node's rows give the range of each feature, and digests of (seed,
tree, node) choose the feature and the place of the cut, so the forest is the same however the rows
are dealt out, and can be told from SQL alone. It is a table of nodes. Splits do not depend on the
scale of a feature, so the trees cut the features as they are. Scoring: the nodes, whose number is
bounded by trees and sample size, go to every task once and rows are scored in Arrow batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import scalars as fx
from tidemark.operators.ranks import kth_smallest
from tidemark.session import new_folder, written_to

NODES = (
    "tree_id int, node_id int, left_id int, feature int, threshold double, path double, "
    "sample_size int"
)
MODEL = (
    "trained_at string, feature_cols array<string>, means array<double>, stds array<double>, "
    "cutoff double, rows bigint, score_mean double, score_std double, threshold double, "
    "flagged bigint, contamination double"
)
_MAX_NODES = 2_000_000  # what is sent to every task stays below about 50 MB
#: a prime: ranks are remainders by it
_RANKS = (1 << 31) - 1
#: path lengths are whole millionths, so that their sums do not depend on order
_MICRO = 1_000_000


class TooFewRows(ValueError):
    """There are not enough profiles to train on."""


def feature_frame(profiles: DataFrame, as_of: str | None = None, days: int | None = None) -> DataFrame:
    """Ids, features and fingerprints of non-empty profiles, NULL features as 0.

    Hour and weekday come from the profile's own time, in training and in scoring alike.
    """
    ts = fx.text_to_ts("profile_ts")
    rows = profiles.filter(F.col("record_count") > 0)
    if days is not None:
        rows = rows.filter(ts >= fx.as_of_ts(as_of) - F.make_dt_interval(F.lit(days)))
    named = {"hour_of_day": F.hour(ts), "day_of_week": fx.weekday_of(ts)}
    features = [
        F.coalesce(named.get(c, F.col(c)).cast("double"), F.lit(0.0)).alias(c) for c in fv.FEATURES
    ]
    return rows.select(
        "profile_id", "topic", "batch_id", *features, "schema_hash", "expected_schema_hash"
    )


def training_volume(profiles: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Profiles of the last days and whether they suffice for training and for a retrain."""
    since = fx.as_of_ts(as_of) - F.make_dt_interval(F.lit(days))
    recent = profiles.filter(fx.text_to_ts("profile_ts") >= since)
    rows, non_empty = F.count(F.lit(1)), F.count_if(F.col("record_count") > 0)
    return recent.agg(
        rows.alias("profiles"),
        (non_empty >= fv.MIN_TRAINING_ROWS).alias("enough_to_train"),
        (rows >= fv.MIN_RETRAIN_ROWS).alias("enough_to_retrain"),
    )


def require_retrain_volume(profiles: DataFrame, as_of: str, days: int = 30) -> int:
    row = training_volume(profiles, as_of, days).first()
    if not row["enough_to_retrain"]:
        raise TooFewRows(f"{row['profiles']} profiles, {fv.MIN_RETRAIN_ROWS} needed to retrain")
    return row["profiles"]


def moments(features: DataFrame, columns: Sequence[str] = fv.FEATURES) -> DataFrame:
    """Row count, mean and population deviation of every feature in one aggregation."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    )


def standardize(features: DataFrame, columns: Sequence[str] = fv.FEATURES) -> DataFrame:
    """Features minus mean over population deviation; a constant feature becomes 0."""
    one_row = moments(features, columns).first().asDict()
    return features.select(
        *[c for c in features.columns if c not in columns],
        *_scaled(
            columns,
            [one_row[f"mean_{c}"] for c in columns],
            [one_row[f"std_{c}"] for c in columns],
        ),
    )


def _scaled(columns: Sequence[str], means: Sequence[float], stds: Sequence[float]) -> list[Column]:
    return [
        ((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c)
        for c, m, s in zip(columns, means, stds)
    ]


# --------------------------------------------------------------------------- training


def draw_samples(
    rows: DataFrame, n: int, trees: int, sample: int, seed: int, id_column: str, widen: float = 1.0
) -> DataFrame:
    """(tree_id, rank, row...) for the rows whose rank for a tree is small.

    A row's rank is a random linear function, one for each tree, of two numbers from the digest of
    its id. The rate leaves slack above `sample`, so the tree can keep exactly its `sample` smallest
    ranks. Trees are tested inside the row; only drawn pairs become rows, and their number is
    about trees x 1.5 x sample however large the input is.
    """
    rate = min(1.0, widen * (1.5 * sample + 64) / max(n, 1))
    below = int(rate * _RANKS)
    digest = F.md5(F.col(id_column).cast("string"))
    hashed = rows.select("*", _hex(digest, 1).alias("_h1"), _hex(digest, 8).alias("_h2"))
    lines = []
    for tree in range(trees):
        text = hashlib.md5(f"{seed}#{tree}".encode()).hexdigest()
        lines.append(F.struct(F.lit(tree).alias("tree_id"), *[F.lit(int(text[i : i + 7], 16)).cast("bigint").alias(n) for i, n in ((0, "a"), (7, "b"), (14, "c"))]))

    def rank(line: Column) -> Column:
        return F.pmod(F.col("_h1") * line["a"] + F.col("_h2") * line["b"] + line["c"], F.lit(_RANKS))

    ranked = F.transform(F.array(*lines), lambda line: F.struct(line["tree_id"].alias("tree_id"), rank(line).alias("rank")))
    drawn = hashed.select("*", F.inline(F.filter(ranked, lambda r: r["rank"] < below)))
    return drawn.drop("_h1", "_h2")


def _hex(text: Column, at: int, digits: int = 7) -> Column:
    return F.conv(F.substring(text, at, digits), 16, 10).cast("bigint")


def _uniform(seed: int, node: Column, purpose: str) -> Column:
    """A number in [0, 1) that hangs on seed, tree, node and purpose alone."""
    text = F.concat_ws("#", F.lit(str(seed)), F.col("tree_id").cast("string"), node.cast("string"), F.lit(purpose))
    return _hex(F.md5(text), 1, 13) / F.lit(float(1 << 52))


def grow_forest(
    rows: DataFrame,
    n: int,
    columns: Sequence[str],
    id_column: str,
    trees: int = fv.TREES,
    sample: int = fv.SUBSAMPLE,
    seed: int = fv.SEED,
) -> pd.DataFrame:
    """Node table of the forest. Its size is bounded: trees x (2 x sample - 1)."""
    if trees * (2 * sample - 1) > _MAX_NODES:
        raise ValueError("trees x sample is too large for a forest that every task can hold")
    psi = min(sample, n)
    widen = 1.0
    while True:
        drawn = draw_samples(rows, n, trees, sample, seed, id_column, widen)
        place = F.row_number().over(Window.partitionBy("tree_id").orderBy("rank", id_column))
        kept = drawn.withColumn("_place", place).filter(F.col("_place") <= psi)
        sampled = kept.select("tree_id", F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
        nodes = _grown(sampled, len(columns), psi, seed).toPandas()
        full = nodes.loc[(nodes.node_id == 0) & (nodes.sample_size == psi), "tree_id"].nunique()
        if full == trees:
            return nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
        widen *= 2.0  # a tree was drawn short: draw again with more slack


def _grown(sampled: DataFrame, features: int, psi: int, seed: int) -> DataFrame:
    """The nodes of all trees. Children of node i are 2i + 1 and 2i + 2; every row carries the nodes
    it went through. Rows are dealt by tree once; each level is a window over its nodes."""
    limit = int(np.ceil(np.log2(max(psi, 2))))
    size = F.count(F.lit(1)).over(Window.partitionBy("tree_id"))
    work = sampled.select("*", size.alias("sample_size"), F.lit(0).cast("bigint").alias("node"), F.array().cast("array<struct<node:bigint,feature:int,threshold:double,rows:bigint>>").alias("way"))
    for depth in range(limit + 1):
        here = Window.partitionBy("tree_id", "node")
        low, high = ([f(F.col("x")[j]).over(here) for j in range(features)] for f in (F.min, F.max))
        ranges = F.array(*[F.struct(F.lit(j).alias("j"), a.alias("low"), b.alias("high")) for j, (a, b) in enumerate(zip(low, high))])
        work = work.select("*", F.count(F.lit(1)).over(here).alias("_rows"), ranges.alias("_ranges"))
        work = work.withColumn("_varying", F.filter("_ranges", lambda r: r["high"] > r["low"]))
        split = (F.col("_rows") > 1) & (F.size("_varying") > 0) if depth < limit else F.lit(False)
        chosen = F.floor(_uniform(seed, F.col("node"), "feature") * F.size("_varying")).cast("int")
        work = work.withColumn("_by", F.when(split, F.get("_varying", chosen)))
        cut = F.col("_by.low") + _uniform(seed, F.col("node"), "cut") * (F.col("_by.high") - F.col("_by.low"))
        work = work.withColumn("_cut", F.when(cut < F.col("_by.high"), cut).otherwise(F.col("_by.low")))
        step = F.struct(F.col("node"), F.coalesce("_by.j", F.lit(-1)).alias("feature"), F.col("_cut").alias("threshold"), F.col("_rows").alias("rows"))
        right = (F.get("x", F.col("_by.j")) > F.col("_cut")).cast("bigint")
        below = F.when(F.col("_by").isNull(), F.col("node")).otherwise(2 * F.col("node") + 1 + right)
        work = work.select("tree_id", "x", "sample_size", below.alias("node"), F.array_append("way", step).alias("way"))
    nodes = work.select("tree_id", "sample_size", F.inline("way")).distinct()
    leaf = F.col("feature") < 0
    depth_of = F.length(F.bin(F.col("node") + 1)) - 1
    m = F.col("rows").cast("double")
    c = F.when(m > 2, 2.0 * (F.log(m - 1.0) + F.lit(float(np.euler_gamma))) - 2.0 * (m - 1.0) / m).when(m == 2, 1.0).otherwise(0.0)
    micro = F.round((depth_of + c) * _MICRO)
    return nodes.select(
        F.col("tree_id").cast("int"),
        F.col("node").cast("int").alias("node_id"),
        F.when(leaf, F.col("node")).otherwise(2 * F.col("node") + 1).cast("int").alias("left_id"),
        F.col("feature").cast("int"),
        F.coalesce("threshold", F.lit(float("nan"))).alias("threshold"),
        F.when(leaf, micro / _MICRO).otherwise(0.0).alias("path"),
        F.col("sample_size").cast("int"),
    )


def average_path(size: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary search tree of `size` keys."""
    m = np.asarray(size, dtype=np.float64)
    big = 2.0 * (np.log(np.maximum(m - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (m - 1.0) / np.maximum(m, 1.0)
    return np.where(m > 2, big, np.where(m == 2, 1.0, 0.0))


# --------------------------------------------------------------------------- scoring


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in flat arrays. A leaf points to itself and sends every row left."""

    roots: np.ndarray
    left: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    micro: np.ndarray
    depth: int
    norm: float

    @staticmethod
    def from_nodes(nodes: pd.DataFrame) -> Forest:
        """From a table of nodes with any ids; the first of a tree is its root, and a right child
        comes next to its left one."""
        nodes = nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
        trees = nodes.tree_id.to_numpy(np.int64)
        keys = trees << 32 | nodes.node_id.to_numpy(np.int64)
        psi = int(nodes.sample_size.iloc[0])
        leaf = nodes.feature.to_numpy() < 0
        return Forest(
            roots=np.flatnonzero(np.append(True, trees[1:] != trees[:-1])).astype(np.int32),
            left=np.searchsorted(keys, trees << 32 | nodes.left_id.to_numpy(np.int64)).astype(np.int32),
            feature=np.where(leaf, 0, nodes.feature.to_numpy()).astype(np.int16),
            threshold=np.where(leaf, np.inf, nodes.threshold.to_numpy()),
            micro=np.rint(nodes.path.to_numpy(np.float64) * _MICRO).astype(np.int64),
            depth=int(np.ceil(np.log2(max(psi, 2)))),
            norm=float(average_path(psi)) or 1.0,
        )

    def paths(self, x: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Sum of the path lengths over all trees, in millionths."""
        out = np.empty(len(x), np.int64)
        for start in range(0, len(x), chunk):
            part = x[start : start + chunk]
            row = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                node = self.left[node] + (part[row, self.feature[node]] > self.threshold[node])
            out[start : start + chunk] = self.micro[node].sum(axis=1)
        return out

    def normality(self, x: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Minus the anomaly measure 2^(-mean path / norm): in [-1, 0), higher is normal."""
        return -np.exp2(-self.paths(x, chunk) / (_MICRO * len(self.roots)) / self.norm)


def path_column(spark: SparkSession, forest: Forest, columns: Sequence[str | Column]) -> Column:
    """The summed path lengths of rows, in millionths."""
    held = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("bigint")
    def paths(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = held.value
        for part in parts:
            yield pd.Series(trees.paths(np.column_stack([p.to_numpy(np.float64) for p in part])))

    return paths(*columns)


def normality_of(paths: Column, forest: Forest) -> Column:
    return -F.pow(F.lit(2.0), -(paths / F.lit(float(_MICRO * len(forest.roots))) / F.lit(forest.norm)))


@dataclass(frozen=True)
class Model:
    nodes: pd.DataFrame
    meta: dict

    def nodes_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def meta_df(self, spark: SparkSession) -> DataFrame:
        names = [part.strip().split(" ")[0] for part in MODEL.split(",")]
        return spark.createDataFrame([tuple(self.meta[n] for n in names)], MODEL)

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        self.meta_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").limit(_MAX_NODES + 1).toPandas()
        if len(nodes) > _MAX_NODES:
            raise ValueError("the stored forest is too large to send to every task")
        meta = spark.read.schema(MODEL).parquet(f"{path}/meta").first().asDict()
        return Model(nodes.sort_values(["tree_id", "node_id"], ignore_index=True), meta)


def fit(
    features: DataFrame,
    trained_at: str,
    contamination: float = fv.CONTAMINATION,
    trees: int = fv.TREES,
    sample: int = fv.SUBSAMPLE,
    seed: int = fv.SEED,
    id_column: str = "profile_id",
    columns: Sequence[str] = fv.FEATURES,
) -> Model:
    """Train on the feature frame; at least 50 rows are needed.

    The score cut-off is the k-th lowest of the training scores, k being the contamination's share
    of the rows, rounded up; what scores below it is flagged.
    """
    spark = features.sparkSession
    columns = list(columns)
    same = F.struct(*columns)
    # of rows with one id the one with the smallest hash, however the rows are dealt out
    chosen = features.groupBy(id_column).agg(F.min_by(same, F.xxhash64(*columns)).alias("_row"))
    rows = written_to(chosen.select(id_column, "_row.*"), new_folder(spark, "training-rows"))
    stats = moments(rows, columns).first().asDict()
    n = stats["rows"]
    if n < fv.MIN_TRAINING_ROWS:
        raise TooFewRows(f"{n} profiles, {fv.MIN_TRAINING_ROWS} needed to train")
    nodes = grow_forest(rows, n, columns, id_column, trees, sample, seed)
    forest = Forest.from_nodes(nodes)
    paths = written_to(rows.select(path_column(spark, forest, columns).alias("paths")), new_folder(spark, "training-paths"))
    lowest = kth_smallest(paths, "paths", max(1, int(np.ceil(round(contamination * n, 9)))))
    scores = normality_of(F.col("paths"), forest)
    spread = paths.agg(
        F.max(F.when(F.col("paths") == lowest, scores)).alias("cutoff"),
        F.avg(scores).alias("mean"),
        F.stddev_pop(scores).alias("std"),
        F.count_if(F.col("paths") < lowest).alias("flagged"),
    ).first()
    score_mean = spread["mean"] - spread["cutoff"]
    meta = {
        "trained_at": trained_at,
        "feature_cols": columns,
        "means": [stats[f"mean_{c}"] for c in columns],
        "stds": [stats[f"std_{c}"] for c in columns],
        "cutoff": spread["cutoff"],
        "rows": n,
        "score_mean": score_mean,
        "score_std": spread["std"],
        "threshold": score_mean - 2 * spread["std"],
        "flagged": spread["flagged"],
        "contamination": contamination,
    }
    return Model(nodes, meta)


def score(features: DataFrame, model: Model, scored_at: str) -> DataFrame:
    """Score, grade and flag profiles: below 0 is an anomaly."""
    forest = Forest.from_nodes(model.nodes)
    paths = path_column(features.sparkSession, forest, model.meta["feature_cols"])
    raw = features.select("profile_id", "topic", "batch_id", paths.alias("_p"), "schema_hash", "expected_schema_hash")
    margin = normality_of(F.col("_p"), forest) - F.lit(model.meta["cutoff"])
    graded = raw.select("*", F.round(margin, 6).alias("anomaly_score"), (margin < 0).alias("is_anomaly"))
    return graded.select(
        fx.stable_id("profile_id", F.lit(scored_at)).alias("anomaly_id"),
        "profile_id",
        "topic",
        "batch_id",
        "anomaly_score",
        fx.severity_of("anomaly_score").alias("severity"),
        "is_anomaly",
        fx.is_drifted("schema_hash", "expected_schema_hash").alias("is_schema_drift"),
        F.lit(scored_at).alias("scored_at"),
        fx.as_of_ts(scored_at).alias("created_at"),
    )


def alerts(scored: DataFrame) -> DataFrame:
    """Anomalies in the layout of the stored log."""
    return scored.filter("is_anomaly").drop("is_anomaly")
