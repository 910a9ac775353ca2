"""From raw documents to token ids, in five stages. Each stage's rows are stored and read again.

Rows may have null or empty texts, repeat, or carry any values in the other columns; every stage
keeps the columns of `documents` and its decisions take effect on the rows it was given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, common, decontaminate, language_id, line_templates, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts are long, so what goes to a Python worker at a time is bounded by bytes rather than by rows.
BATCH_BYTES = "8m"


def _documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents; from here on the session's Arrow batches hold at most BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs.select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those that the language model rejects, or without a letter, go."""
    docs = _documents(spark, docs)
    model = language_id.fit(docs)
    found = language_id.predict(docs, model)
    return found.filter(~F.col("lang_rejected")).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, all but one document's; documents of which nothing is left go."""
    cut = line_templates.dedup(_documents(spark, docs))
    emptied = F.col("dropped_lines").isNotNull() & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    length = F.when(F.col("dropped_lines").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return cut.filter(~emptied).withColumn("n_chars", length).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of three-word shingles are linked over at most 3 bits, the one
    with the smallest doc_id stays; a null doc_id is the greatest, of repeated rows any one stays.
    Null and blank texts share a fingerprint, as equal texts do."""
    hashed = simhash.fingerprints(_documents(spark, docs), words_each=3)
    hashed = common.stored(hashed.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    narrow = hashed.select("row", "doc_id", "fingerprint")
    grouped = simhash.groups(narrow, "row", ("fingerprint",), most=3).join(narrow.select("row", "doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = grouped.groupBy("group").agg(F.min_by("row", order).alias("row")).select("row")
    return hashed.join(chosen, "row", "left_semi").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, as it is or with other values, go."""
    marked = decontaminate.mark(_documents(spark, docs), common.table(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("leaks") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether decoding them gives the text again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(_documents(spark, docs), ranks, back="decoded")  # in one worker, not in two
    whole = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return encoded.select(*COLUMNS, F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES = [
    ("language ID", keep_languages),
    ("line dedup", drop_lines),
    ("near dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: Nearest centroids, fingerprints and byte pairs are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
