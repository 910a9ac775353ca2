"""The registered queries: one for each operator, and the pipeline."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, common, context_mixing, decontaminate, importance, language_id, line_templates, merkle, nearest, quality, simhash, substrings, token_counts, warc
from tidemark.llm.common import stored, table
from tidemark.session import new_folder

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    fitted = token_counts.within_budget(counted, 512)
    return fitted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "fit_chars")


@query
def op5_byte_bpe(spark, sf):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, ranks).select("doc_id", "ids")
    decoded = byte_bpe.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_simhash(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    hashed = stored(simhash.fingerprints(docs).select("doc_id", "fingerprint"), "simhash")
    found = simhash.near_duplicates(hashed)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_warc(spark, sf):
    folder = new_folder(spark, "warc")
    warc.write(warc.page_records(table(spark, sf, "pages"), "2024-01-01T00:00:00Z"), folder)

    def number(field):
        return F.col("fields")[field].cast("long")

    responses = warc.read(spark, folder).filter("record_type = 'response'").select(
        number("X-Page-Id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = warc.read(spark, folder, payload=False).filter("record_type = 'revisit'").select(
        number("X-Page-Id").alias("page_id"),
        number("X-Payload-Length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("X-Refers-To-Page").alias("refers_to"),
    )
    return responses.unionByName(revisits)


ORACLE["op8_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""


@query
def op3_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    seen = stored(quality.features(docs).select("doc_id", "features"), "quality")
    held_out = common.crc_remainder("doc_id", 5) == 0
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    model = quality.fit(stored(seen.filter(~held_out).join(labels, "doc_id").select("features", "quality"), "quality"))
    scored = quality.score(seen, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = common.crc_remainder("doc_id", 5) == 0
    model = language_id.fit(docs.filter(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_rejected")


@query
def op6_nearest(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, F.col("vec_id") % 20 == 0, 20)


@query
def op2_line_templates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cut = line_templates.dedup(docs)
    return cut.select("doc_id", "text", F.coalesce(F.size("dropped_lines"), F.lit(0)).alias("n_dropped"), "dropped_lines")


@query
def op7_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return marked.select("doc_id", "leak.*")


@query
def op9_context_mixing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.coalesce(common.crc_remainder("doc_id", 7) == 2, F.lit(False))
    scored = context_mixing.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op11_merkle(spark, sf):
    docs = table(spark, sf, "documents").select(*LEAF)
    lowered = {"text": lambda text: text.translate(common.LOWER)}
    leaves = merkle.leaves(docs, LEAF, ["doc_id", "source"], {"leaf": {}, "tampered": lowered})
    tampered = F.when(common.crc_remainder("doc_id", 5) == 0, F.col("tampered"))
    held = merkle.manifest(leaves.withColumn("tampered", tampered), replacement="tampered")
    proof = F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return held.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", verified)


def _merkle_sql(levels: int) -> str:
    """The trees of the sources and the one over them, each level from the one below, up to 16^levels leaves."""
    field = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
    row = " || ".join(field.format(c) for c in LEAF)
    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    other = " || ".join(field.format(c) for c in [*LEAF[:-1], lowered])
    # crc32 of the decimal digits, byte by byte; its table is made by the polynomial's rule
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    out = [f"""crc_table AS (
      SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(b, [0,0,0,0,0,0,0,0]), lambda c, i: {step}) AS c FROM (SELECT unnest(range(256)) AS b))
    ), docs AS (
      SELECT doc_id, source, sha256({row}) AS leaf, sha256({other}) AS other,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x))),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit
      FROM documents, crc_table
    ), leaves AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs
    ), d0 AS (
      SELECT doc_id, source, leaf, CASE WHEN hit THEN other ELSE leaf END AS v, pos, '' AS proof FROM leaves
    ), a0 AS (SELECT source AS tree, pos, leaf AS digest FROM leaves)"""]

    def rise(node: str, walk: str, tree: str, keep: str) -> None:
        for k in range(levels):
            out.append(f"""{node}{k}s AS (
              SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {node}{k}
            ), {node}{k}r AS (
              SELECT *,
                coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
              FROM {node}{k}s
            ), {node}{k + 1} AS (
              SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
              FROM {node}{k}s GROUP BY tree, pos // 16
            ), {walk}{k + 1} AS (
              SELECT {keep}, CASE WHEN n = 1 THEN v ELSE sha256(before || v || after) END AS v, w.pos // 16 AS pos, proof || before || after AS proof
              FROM {walk}{k} w JOIN {node}{k}r r ON {tree} IS NOT DISTINCT FROM r.tree AND w.pos = r.pos
            )""")

    rise("a", "d", "w.source", "w.doc_id, w.source, w.leaf")
    out.append(f"""b0 AS (
      SELECT 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos, digest, tree AS source FROM a{levels}
    ), e0 AS (
      SELECT d.doc_id, d.leaf, d.v, b.pos, d.proof, b.digest AS subroot
      FROM d{levels} d JOIN b0 b ON d.source IS NOT DISTINCT FROM b.source
    )""")
    rise("b", "e", "0", "w.doc_id, w.leaf, w.subroot")
    return "WITH " + ",\n".join(out) + f"""
    SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, v AS folded_root, v = digest AS verified
    FROM e{levels} JOIN b{levels} ON true"""


ORACLE["op11_merkle"] = _merkle_sql(4)


@query
def op12_importance(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    corpus = importance.bucket_counts(docs)
    gain = importance.gains(corpus, importance.bucket_counts(table(spark, sf, "benchmark")))
    weighed = importance.weigh(docs, gain).select("doc_id", "n_words", "n_features", "weight")
    return importance.draw(weighed, (5, 100)).select("doc_id", "n_features", "weight", "score", "rank")


# The crc32 of a feature goes through its UTF-8 bytes one by one, for each different feature.
ORACLE["op12_importance"] = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, [0,0,0,0,0,0,0,0]),
      lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))
), texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS r FROM texts
), runs AS (
  SELECT kind, id, r, w, unnest(range(1, len(w) + 1)) AS i FROM words
), features AS (
  SELECT kind, id, r, unnest([w[i], CASE WHEN i + 1 <= len(w) THEN w[i] || ' ' || w[i + 1] END,
    CASE WHEN i + 2 <= len(w) THEN w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END]) AS f FROM runs
), different AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features WHERE f IS NOT NULL)
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
      lambda k: (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * k + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM different, crc_table
), spread AS (SELECT kind, id, r, bucket FROM features JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 'b') AS t FROM spread GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * CAST(sum(s) OVER () + 10000 AS DOUBLE) / ((s + 1) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts
), sums AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM spread JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || id)[1:8] AS BIGINT) + 0.5) / 4294967296e0))) AS BIGINT) AS score
  FROM words LEFT JOIN sums USING (r) WHERE kind = 'd'
), ranked AS (
  SELECT *, count(*) FILTER (WHERE fit) OVER () AS n, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id, weight, n_features) AS place
  FROM (SELECT *, n_words >= 20 AND doc_id IS NOT NULL AS fit FROM scored)
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""


@query
def op13_substrings(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cut = substrings.cut(docs)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op13_substrings"] = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
), firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT r, i + unnest(range(13)) AS i FROM (SELECT r, i FROM windows JOIN firsts USING (s) WHERE first < doc_id)
), places AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM places ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


@query
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
