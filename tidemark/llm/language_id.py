"""Language by nearest centroid: TF-IDF vectors of letter n-grams, several centroids per language.

Texts are lower-cased, everything but letters becomes a single blank, and 1- to 3-grams are hashed
into a fixed number of features. The inverse document frequencies and, per language, spherical
k-means centroids are learned from a bounded sample of labelled texts; a low quantile of the sample's
own cosines, by length, gives the distance beyond which a text is rejected. Labels may be wrong: the
farthest texts of a language neither begin a centroid nor set the distance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.common import mapped, stored, texts_of

FEATURES = 4096
CENTROIDS = 4
#: labelled texts per language that the centroids are learned from, at most
SAMPLE = 2000
ROUNDS = 12
LENGTHS = 32
#: this share of a language's texts, those farthest from all centroids so far, begins none
FARTHEST = 0.1
#: a text is rejected if its cosine is under SLACK of the LOW quantile of texts of about its length;
#: shorter texts than SHORT say too little to be rejected
LOW = 0.1
SLACK = 0.6
SHORT = 32
MOST_LANGUAGES = 2000
UNKNOWN = "und"
_SLICE = 1_000_000
#: texts whose dense counts are held at a time, however short they are
_AT_ONCE = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 12)


def term_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts, a row per text, and each text's letters and blanks (0: no letter)."""
    n = len(texts)
    lower = [t.lower() for t in texts]
    # a blank behind each text and none before, so that its counts are the same wherever it stands
    points = pretokens.code_points("".join(f"{t} " for t in lower))
    doc = np.repeat(np.arange(n), [len(t) + 1 for t in lower])
    letter = pretokens.classes()[points] == pretokens.LETTER
    points = np.where(letter, points, 32)
    keep = np.append(True, letter[1:] | letter[:-1] | (doc[1:] != doc[:-1]))
    points, doc, letter = points[keep].astype(np.uint64), doc[keep], letter[keep]
    length = np.bincount(doc, minlength=n)
    length[np.bincount(doc[letter], minlength=n) == 0] = 0
    counts = np.zeros((n, FEATURES), np.float32)
    flat = counts.reshape(-1)
    code = points
    for size in (1, 2, 3):
        if size > 1:
            code = code[:-1] * np.uint64(0x110000) + points[size - 1 :]
        inside = doc[: len(code)] == doc[size - 1 :]
        if size == 1:
            inside = inside & letter
        feature = ((code * _ODD) >> _SHIFT).astype(np.int64)
        flat += np.bincount((doc[: len(code)] * FEATURES + feature)[inside], minlength=len(flat))
    counts[length == 0] = 0
    return counts, length


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = np.log1p(counts) * idf
    norm = np.sqrt((weight * weight).sum(axis=1, keepdims=True))
    return weight / np.maximum(norm, 1e-12)


def bucket(length: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(length, 1)).astype(np.int64).clip(0, LENGTHS - 1)


def centroids_of(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, begun at the text nearest to the mean and then at far ones, but not the farthest."""
    mean = x.mean(axis=0)
    at = [int(np.argmax(x @ mean))]
    nearest = x @ x[at[0]]
    while len(at) < min(k, len(x)):
        at.append(int(np.argsort(nearest, kind="stable")[int(FARTHEST * len(x))]))
        nearest = np.maximum(nearest, x @ x[at[-1]])
    centres = x[at]
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(axis=1)
        new = np.stack([x[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centres):
            break
        centres = new
    return centres


def floors_of(cosine: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The least cosine that is not rejected, by length; lengths that no text was near have none."""
    own = bucket(length)
    low = np.full(LENGTHS + 2, np.inf)
    for b in np.unique(own):
        low[b + 1] = np.quantile(cosine[own == b], LOW)
    near = np.minimum(np.minimum(low[:-2], low[1:-1]), low[2:])
    floor = np.where(np.isfinite(near), near * SLACK, 0.0)
    floor[: int(np.log2(SHORT))] = 0.0
    return floor


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centres: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # per centroid and length

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is rejected."""
        if not texts:
            return [], np.zeros(0), np.zeros(0, bool)
        if len(texts) > _AT_ONCE:
            parts = [self.predict(texts[i : i + _AT_ONCE]) for i in range(0, len(texts), _AT_ONCE)]
            return [x for p in parts for x in p[0]], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        counts, length = term_counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = vectors(counts, self.idf) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = cosine[np.arange(len(texts)), best].clip(0, 1).astype(np.float64)
        none = length == 0
        score[none] = 0
        found = [UNKNOWN if z else self.languages[b] for b, z in zip(best, none)]
        return found, score, none | (score < self.floors[best, bucket(length)])


def _sample(df: DataFrame, text: str, lang: str, most: int) -> DataFrame:
    """At most so many different texts of each language, those with the smallest hashes."""
    from pyspark.sql import Window

    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    # over different texts: a language may have few of them, each in very many rows
    share = rows.groupBy("lang").agg((F.lit(float(2 * most)) / F.approx_count_distinct(F.xxhash64("text"))).alias("share"))
    shares = {r["lang"]: r["share"] for r in share.limit(MOST_LANGUAGES + 1).collect()}
    if len(shares) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not shares:
        return rows.limit(0)
    asked = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(v))])[F.col("lang")]
    hashed = rows.withColumn("h", F.xxhash64("text"))
    # hashes are even over the long range, so this keeps about twice what is wanted
    near = hashed.filter((F.col("h") / F.lit(float(1 << 63)) + 1) / 2 < asked)
    different = near.dropDuplicates(["lang", "h"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return different.withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", "text")


def fit(df: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learns from at most `sample` different texts of each language that has a name.

    How often a text or its rows are repeated makes no difference. Texts without a letter, null
    texts and null labels teach nothing. Without any labelled text every prediction is `und`. More
    than MOST_LANGUAGES languages are refused with a ValueError, since their centroids go to every
    task.
    """
    chosen = stored(_sample(df, text, lang, sample), "language-sample")

    def features(group: pa.Table) -> np.ndarray:
        texts = sorted(group["text"].to_pylist())
        found = [term_counts(texts[i : i + 200]) for i in range(0, len(texts), 200)]
        counts, length = (np.concatenate(x) for x in zip(*found))
        return counts[length > 0], length[length > 0]

    def frequencies(group: pa.Table) -> pa.Table:
        counts, _ = features(group)
        share = (counts > 0).mean(axis=0).astype(np.float64) if len(counts) else np.zeros(FEATURES)
        return pa.table({"lang": group["lang"][:1], "share": [share.tolist()]})

    shares = chosen.groupBy("lang").applyInArrow(frequencies, "lang string, share array<double>").collect()
    seen = [r for r in shares if any(r["share"])]
    if not seen:
        return Model([], np.zeros((0, FEATURES)), np.ones(FEATURES), np.zeros((0, LENGTHS)))
    mean = np.mean([r["share"] for r in sorted(seen)], axis=0)
    idf = np.log(1 + 1 / np.maximum(mean, 1e-4)).astype(np.float32)

    def cluster(group: pa.Table) -> pa.Table:
        counts, length = features(group)
        if not len(counts):
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "floor": pa.array([], pa.list_(pa.float64()))})
        x = vectors(counts, idf)
        centres = centroids_of(x, centroids)
        cosine = (x @ centres.T).max(axis=1)
        floor = floors_of(cosine, length)
        k = len(centres)
        return pa.table({"lang": [group["lang"][0].as_py()] * k, "centre": [c.astype(np.float32).tobytes() for c in centres], "floor": [floor.tolist()] * k})

    rows = sorted(chosen.groupBy("lang").applyInArrow(cluster, "lang string, centre binary, floor array<double>").collect())
    centres = np.stack([np.frombuffer(bytes(r["centre"]), np.float32) for r in rows])
    return Model([r["lang"] for r in rows], centres, idf, np.array([r["floor"] for r in rows]))


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with lang_pred, lang_score (cosine, 0 to 1) and lang_rejected.

    A text that is null or has no letter is `und` with score 0, rejected. Ties go to the language
    that sorts first. Columns of these names are replaced.
    """

    def run(part):
        found, score, rejected = model.predict(texts_of(part, "_text"))
        return [found, score, rejected]

    return mapped(df, text, _SLICE, {"lang_pred": "string", "lang_score": "double", "lang_rejected": "boolean"}, run)
