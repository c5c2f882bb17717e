"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm import align, bpe, chat, decontaminate, license_scan, line_dedup, merkle, packing, secrets, simhash, substring_dedup, topk, toxicity
from lumenflow.llm._common import store, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.array_join("item_ids", ","), 256)
    return report.select("doc_id", "n_words", "n_hit", "n_items", sha.alias("items_sha256"), decontaminate.contaminated(report).alias("contaminated"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "line", "early_doc_id", "early_line")


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256")
    return merkle.report(table(spark, sf_dir, "documents"), text).select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids"))
    n = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = store(align.align(table(spark, sf_dir, "documents")).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", sha, "a", "b", "n"))
    return align.scored(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_benchmark_decontamination, op3_substring_dedup, op4_line_dedup, op5_harmonic_packing, op6_voronoi_topk, op7_secret_scan, op8_toxicity, op9_chat_formatting, op10_simhash_near_dedup, op11_merkle_manifest, op12_bpe_codec, op13_token_alignment)}

_WORDS2 = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_WORDS3 = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL = {
    "op1_license_scan": license_scan.sql(),
    "op6_voronoi_topk": topk.SQL,
    "op9_chat_formatting": chat.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op2_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS2} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS2} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, dw.n, p, item_id FROM dw JOIN win ON dw.s = win.s AND dw.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS3} AS w FROM documents),
e AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM e) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS pos FROM later),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.pos) AS kept
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d) x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.pos = gone.pos GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
