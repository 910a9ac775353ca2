"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component that makes all lengths equal, so that the largest inner product is
the smallest distance, and are rotated at random. A k-means on a bounded sample gives the lists;
every vector is put in the list of its nearest centroid, and lists are dealt into packs of bounded
size, each stored by blocks of rotated columns. A query reads the packs of its nearest lists. Its
distance to a candidate is summed block by block; after each block a test of the partial distance
against what the query has already found drops candidates that are very unlikely to be among the
nearest. What is left is scored exactly on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: vectors that centroids, number of probed lists and first thresholds are learned from, at most
SAMPLE = 10_000
LISTS = 128
#: up to so many vectors of the sample there is one list, and every vector is scanned
ONE_LIST = 2000
LEAST_PER_LIST = 64
PACK = 2048
QUERIES = 512
BLOCK = 16
#: of the test: how many deviations a partial distance may be too long
DEVIATIONS = 2.4
#: vectors beyond the wanted ones that reach a query's first threshold, should the test drop some
SPARE = 10
RECALL = 0.97
_TRIALS = 300
_SEED = 7


def usable(column: Column) -> Column:
    """Whether a vector takes part: not null or empty, not zero, every component a finite number."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch[column]
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _matrix(cells: pa.Array, dims: int) -> list[np.ndarray]:
    return [np.frombuffer(c, np.float64).reshape(-1, dims) for c in cells.to_pylist()]


@dataclass
class Index:
    dims: int
    longest: float  # length of the longest vector
    turn: np.ndarray  # rotation of the vectors with one more component
    centres: np.ndarray  # rotated
    probes: int
    ids: np.ndarray
    sample: np.ndarray
    lists: np.ndarray  # of the sample's vectors

    def turned(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.column_stack((x, more)) @ self.turn

    def turned_queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack((q, np.zeros(len(q)))) @ self.turn

    def order(self, rotated: np.ndarray, most: int) -> np.ndarray:
        """The nearest lists of each row, nearest first."""
        return np.argsort((self.centres**2).sum(axis=1) - 2 * rotated @ self.centres.T, axis=1, kind="stable")[:, :most]

    def floors(self, ids: np.ndarray, q: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """A score that k vectors, and some to spare, of the sample reach in the probed lists."""
        out = np.full(len(q), -np.inf)
        most = k + SPARE
        for i, (own, row, lists) in enumerate(zip(ids, q, probed)):
            asked = np.zeros(len(self.centres), bool)
            asked[lists] = True
            s = (self.sample[asked[self.lists] & (self.ids != own)] * row).sum(axis=1)
            if len(s) >= most:
                out[i] = np.partition(s, len(s) - most)[len(s) - most]
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(15):
        own = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(df: DataFrame, vec_id: str, embedding: str, k: int, lists: int = LISTS, sample: int = SAMPLE, recall: float = RECALL, one_list: int = ONE_LIST) -> Index | None:
    """Centroids, rotation and the number of lists to probe, from at most `sample` vectors.

    Only the length of the longest vector is taken over all of them. A sample of at most `one_list`
    vectors gives one list. None without any vector.
    """
    v = F.col(embedding)
    sizes = df.groupBy(F.size(v).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return None
    dims, n = sizes["dims"], sizes["count"]
    same = df.filter(F.size(v) == dims)
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = float(np.sqrt(same.agg(F.max(square)).first()[0])) * (1 + 1e-12)
    h = F.xxhash64(F.col(vec_id), v, F.monotonically_increasing_id())  # of the row: ids and vectors may repeat
    near = same.filter((h / F.lit(float(1 << 63)) + 1) / 2 < 2.0 * sample / n) if n > sample else same
    rows = near.select(h.alias("h"), F.col(vec_id).alias("id"), v.cast("array<double>").alias("v")).orderBy("h", "id").limit(sample).collect()
    ids = np.array([-1 if r["id"] is None else r["id"] for r in rows], np.int64)
    x = np.array([r["v"] for r in rows])
    rng = np.random.default_rng(_SEED)
    turn, _ = np.linalg.qr(rng.standard_normal((dims + 1, dims + 1)))
    index = Index(dims, longest, turn, np.zeros((1, dims + 1)), 1, ids, x, np.zeros(len(x), np.int64))
    k_lists = max(1, min(lists, len(x) // LEAST_PER_LIST if len(x) > one_list else 1))
    rotated = index.turned(x)
    index.centres = _kmeans(rotated, k_lists, rng)
    index.lists = index.order(rotated, 1)[:, 0]
    index.probes = _probes(index, x, k, recall)
    return index


def _probes(index: Index, x: np.ndarray, k: int, recall: float) -> int:
    """How many lists hold so large a share of the sample's own nearest neighbours."""
    trials = np.arange(len(x))[: _TRIALS]
    order = index.order(index.turned_queries(x[trials]), len(index.centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = []
    for t in trials:
        s = x @ x[t]
        s[t] = -np.inf
        needed.append(place[t][index.lists[np.argsort(-s, kind="stable")[: min(k, len(x) - 1)]]])
    flat = np.sort(np.concatenate(needed)) if needed else np.zeros(0, np.int64)
    return int(flat[min(len(flat) - 1, int(np.ceil(recall * len(flat))))]) + 1 if len(flat) else len(index.centres)


def scan(index: Index, q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """(query ids, vector ids, scores) of the pack's vectors that may be among a query's nearest."""
    blocks = np.array_split(np.asfortranarray(index.turned(x)), range(BLOCK, index.dims + 1, BLOCK), axis=1)
    turned = index.turned_queries(q)
    limit = (q * q).sum(axis=1) + index.longest**2 - 2 * floors
    limit += 1e-9 * np.abs(np.where(np.isfinite(limit), limit, 0))
    first, d = blocks[0], blocks[0].shape[1]
    head = turned[:, :d]
    partial = (head**2).sum(axis=1)[:, None] + (first**2).sum(axis=1)[None, :] - 2 * head @ first.T
    alive = partial <= _allowed(limit, d, index.dims + 1)[:, None]
    out = []
    for i in range(len(q)):
        left = np.flatnonzero(alive[i] & (ids != q_ids[i]))
        distance, seen = partial[i, left], d
        for block in blocks[1:]:
            if not len(left):
                break
            gap = block[left] - turned[i, seen : seen + block.shape[1]]
            distance = distance + (gap * gap).sum(axis=1)
            seen += block.shape[1]
            keep = distance <= _allowed(limit[i], seen, index.dims + 1)
            left, distance = left[keep], distance[keep]
        score = (x[left] * q[i]).sum(axis=1)
        keep = score >= floors[i]
        left, score = left[keep], score[keep]
        best = np.lexsort((ids[left], -score))[:k]
        out.append((np.full(len(best), q_ids[i]), ids[left][best], score[best]))
    return tuple(map(np.concatenate, zip(*out)))


def _allowed(limit, seen: int, dims: int):
    """The longest partial distance, squared, over so many columns of a vector that is kept."""
    return limit if seen >= dims else limit * (seen / dims) * (1 + DEVIATIONS / np.sqrt(seen)) ** 2


def search(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", lists: int = LISTS, sample: int = SAMPLE, recall: float = RECALL, one_list: int = ONE_LIST) -> DataFrame:
    """The k nearest rows of each query row, as query_id, rank, vec_id, score.

    Nearness is the inner product in double precision, largest first, ties to the smaller vec_id. A
    query's own id is no candidate. Rows without an id, or with a vector that is null, zero, of
    another length than most, or holding null or non-finite components, take no part. Repeated
    rows count each. With `lists` of 1, or at most `one_list` vectors in all, every vector is scanned,
    and the result is exact but for the test of partial distances.
    """
    v = F.col(embedding)
    taken = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"), is_query.alias("q")).filter(usable(F.col("v")) & F.col("vec_id").isNotNull())
    index = fit(taken, "vec_id", "v", k, lists, sample, recall, one_list)
    if index is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = df.sparkSession.sparkContext.broadcast(index)
    dims = index.dims
    same = taken.filter(F.size("v") == dims)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch, "v")
                own = shared.value.order(shared.value.turned(x), 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), batch["vec_id"], pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["list", "vec_id", "v"],
                )

    placed = stored(same.select("vec_id", "v").mapInArrow(assign, "list int, vec_id long, v binary"), "lists")
    counts = {r["list"]: -(-r["count"] // PACK) for r in placed.groupBy("list").count().collect()}  # a row per list
    packs_of = F.create_map(*[F.lit(z) for kv in counts.items() for z in kv])[F.col("list")]
    dealt = placed.withColumn("pack", F.pmod(F.monotonically_increasing_id(), packs_of).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        ids = group["vec_id"].to_numpy().astype(np.int64)
        return pa.table({"list": group["list"][:1], "ids": pa.array([ids.tobytes()], pa.binary()), "x": pa.array([b"".join(group["v"].to_pylist())], pa.binary())})

    packs = dealt.groupBy("list", "pack").applyInArrow(pack, "list int, ids binary, x binary")

    def probe(batches):
        ix = shared.value
        for batch in batches:
            if batch.num_rows:
                ids, q = batch["vec_id"].to_numpy(), _rows(batch, "v")
                order = ix.order(ix.turned_queries(q), ix.probes)
                floors = ix.floors(ids, q, order, k)
                for row, own, floor, lists_ in zip(q, ids, floors, order):
                    n = len(lists_)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists_, pa.int32()), pa.array([own] * n, pa.int64()), pa.array([floor] * n), pa.array([row.tobytes()] * n, pa.binary())],
                        names=["list", "query_id", "floor", "v"],
                    )

    asked = same.filter("q").select("vec_id", "v").mapInArrow(probe, "list int, query_id long, floor double, v binary")
    n_queries = same.filter("q").count()
    dealt_q = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-n_queries // QUERIES)))).cast("int"))

    def ask(group: pa.Table) -> pa.Table:
        cells = [group[c].to_numpy().tobytes() for c in ("query_id", "floor")] + [b"".join(group["v"].to_pylist())]
        return pa.table({"list": group["list"][:1], **{c: pa.array([b], pa.binary()) for c, b in zip(("q_ids", "floors", "q"), cells)}})

    questions = dealt_q.groupBy("list", "part").applyInArrow(ask, "list int, q_ids binary, floors binary, q binary")

    def answer(batches):
        ix = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                x, q = (_matrix(one[c], dims)[0] for c in ("x", "q"))
                ids, q_ids = (np.frombuffer(one[c][0].as_py(), np.int64) for c in ("ids", "q_ids"))
                floors = np.frombuffer(one["floors"][0].as_py(), np.float64)
                found = scan(ix, q, q_ids, floors, x, ids, k)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["query_id", "vec_id", "score"])

    matched = packs.join(questions, "list").select("ids", "x", "q_ids", "floors", "q")
    found = matched.mapInArrow(answer, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
