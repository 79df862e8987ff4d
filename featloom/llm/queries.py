"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.llm import (
    alignment,
    bpe,
    exact_dedup,
    fingerprints,
    jaccard_join,
    language,
    lexical_search,
    mixing,
    quality,
    sharding,
    suffix_dedup,
    url_graph,
    warc,
)
from featloom.llm.common import held_out
from featloom.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judge(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"), root)
    return warc.read_archives(spark, root, manifest).drop("url", "payload")


OP2_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex,
         min(page_id) OVER (PARTITION BY h) AS first,
         row_number() OVER (PARTITION BY h ORDER BY page_id) AS place
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, i // 4 * 5 + 1, 5))::INT >> (15 - i % 4 * 5)::INT) & 31) + 1, 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first END AS refers_to
FROM d
"""


# Fixed value of the contract: from this score on a document is predicted good.
GOOD_FROM = 0.3


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    """Learned from labelled documents outside the evaluation fold."""
    return quality.fit(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model(spark, sf_dir, docs)
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"))
    model = language.fit(docs, ~out)
    return language.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id",
        out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(_table(spark, sf_dir, "documents"))
    chars = F.length("text")
    kept = F.expr("substring(text, 1, length(text) - length(text) div 4)")
    rows = rows.withColumn("edited", F.concat(kept, F.col("next_start")))
    rows = fingerprints.with_sketch(rows, "edited", "edited_sketch")
    sketch, edited, following = map(F.col, ("sketch", "edited_sketch", "next_sketch"))
    return rows.select(
        F.col("id").alias("doc_id"),
        chars.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.written(sketch).alias("fingerprint"),
        fingerprints.written(edited).alias("edited_fingerprint"),
        fingerprints.likeness(sketch, edited).alias("near_edited"),
        fingerprints.likeness(sketch, following).alias("near_next"),
        fingerprints.containment(sketch, edited).alias("contained_in_edited"),
        fingerprints.containment(sketch, following).alias("contained_in_next"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "found.n_bytes", "found.n_removed", "found.n_spans",
        F.sha2("found.kept", 256).alias("kept_sha256"),
    )


# Fixed values of the contract.
URL_RULES = (
    url_graph.Rule("org", "/", True),
    url_graph.Rule("example.org", "/es/", False),
    url_graph.Rule("example.org", "/en/1", False),
    url_graph.Rule("com", "/fr/", True),
    url_graph.Rule("com", "/de/", False),
)


def op7_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.Tokenizer(spark, bpe.read_ranks(path), public_tokenizers.PATTERN)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = tokenizer(spark)
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", coder.round_trip(F.col("text")).alias("trip")
    )
    return rows.select("doc_id", "trip.*").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("links").alias("n_links")
    )


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * overlap >= 80 * (x.n + y.n - overlap)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(w.doc_id, (SELECT min(b) FROM reach WHERE a = w.doc_id)) AS component_id,
       (SELECT count(*) FROM links WHERE a = w.doc_id) AS n_links
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.totals(mixing.plan(docs)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan(_table(spark, sf_dir, "documents"), 16).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def tokenizers() -> alignment.Tokenizers:
    path = public_tokenizers.path
    return alignment.Tokenizers.read(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.aligned(_table(spark, sf_dir, "documents"), tokenizers(), digest=True)
    return rows.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return lexical_search.ranked(docs, items).withColumnsRenamed({"item": "item_id", "doc": "doc_id"})


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), c AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (
  SELECT doc_id, term, any_value(n)::BIGINT AS n, count(*) AS tf
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * (SELECT n FROM c) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf GROUP BY term
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 *
    (10 + (90 * tf.n * c.n) // c.l))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) CROSS JOIN c
  GROUP BY item_id, doc_id
), ranks AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranks WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_warc": op2_warc,
        "op3_quality": op3_quality,
        "op4_language": op4_language,
        "op5_fingerprints": op5_fingerprints,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_url_graph": op7_url_graph,
        "op8_bpe": op8_bpe,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_mix": op10_mix,
        "op11_sharding": op11_sharding,
        "op12_alignment": op12_alignment,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op2_warc": OP2_SQL,
        "op7_url_graph": url_graph.sql(URL_RULES),
        "op9_jaccard_join": OP9_SQL,
        "op10_mix": mixing.sql(),
        "op13_lexical_search": OP13_SQL,
    }
