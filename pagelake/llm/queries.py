"""One registered query per operator (``opN_<name>``) with its DuckDB oracle where SQL can express it.

Each query applies its operator, with production parameters, to the whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosted_quality, collocation, cuckoo_dedup, license_scan, simhash, sumsq_packing, text_cnn, token_cache, token_pack, turn_repair, vector_packing, warc, winnow
from .common import read_table, scratch_path

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 2
TOKEN_LIMIT = 1024
QUALITY_AT = 0.7
TOXIC_AT = 0.3


def op1_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_pack.write_token_files(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), END_ID)
    return token_pack.read_token_files(spark, folder, with_ids=False)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    return warc.read_warc(spark, folder, payload=True, verify=True).select(
        warc.record_key("record_id").alias("page_id"),
        "payload_bytes",
        F.expr("substring(payload_digest, 6)").alias("payload_digest"),
        "record_type",
        warc.record_key("refers_to").alias("refers_to"),
    )


def op3_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = winnow.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        winnow.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op5_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = boosted_quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


def op6_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = token_cache.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), scratch_path(spark, "token-cache"))
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op7_text_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = text_cnn.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "flagged")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    label = lambda x: x["label"]
    base, more = F.transform("places", label), F.transform("detections", label)
    word = F.transform("places", lambda x: x["word"])
    return got.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, more))).alias("labels"),
        "score",
    )


def op9_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cuckoo_dedup.deduplicate(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_sumsq_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sumsq_packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = collocation.top_phrases(collocation.phrases(read_table(spark, sf_dir, "documents")))
    return got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vector_packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(read_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_token_pack": op1_token_pack,
    "op2_warc": op2_warc,
    "op3_winnow": op3_winnow,
    "op4_simhash": op4_simhash,
    "op5_boosted_quality": op5_boosted_quality,
    "op6_token_cache": op6_token_cache,
    "op7_text_cnn": op7_text_cnn,
    "op8_license_scan": op8_license_scan,
    "op9_cuckoo_dedup": op9_cuckoo_dedup,
    "op10_sumsq_packing": op10_sumsq_packing,
    "op11_collocation": op11_collocation,
    "op12_vector_packing": op12_vector_packing,
    "op13_turn_repair": op13_turn_repair,
}

# ---------------------------------------------------------------- DuckDB oracles
# The tokenizers, XXH64 and the trained models cannot be said in SQL: operators 1, 4 to 8 and 10 are tested
# against brute-force versions in tests/llm instead.

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
-- base32 of the 160 bits: 32 digits of five bits each, cut from eight hexadecimal digits at a time
d AS (SELECT *, list_transform(range(0, 4), lambda i: ('0x' || substr(h, 10 * i + 1, 10))::BIGINT) AS quarters FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((quarters[(k // 8 + 1)::INT] >> (5 * (7 - k % 8))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d""",
    "op3_winnow": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda k: array_to_string(w[k:k + least(13, len(w)) - 1], ' '))) AS s
  FROM items WHERE len(w) > 0),
spots AS (SELECT doc_id, n, unnest(range(1, greatest(1, (len(w) - n + 2))::BIGINT)) AS k, w FROM docs, (SELECT DISTINCT n FROM wins)),
hits AS (SELECT doc_id, item_id, spots.n, k FROM spots JOIN wins ON spots.n = wins.n AND array_to_string(w[k:k + spots.n - 1], ' ') = wins.s),
cover AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_cuckoo_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(x) AS text_sha256
FROM t WINDOW g AS (PARTITION BY x)""",
}
