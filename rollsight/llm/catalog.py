"""The text operators as named queries over whole tables, with check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import scratch_folder
from . import (
    bin_completion, conversation_repair, decontaminate, fill_middle, fingerprints, langid, line_chunks, masked_lm,
    packed_ids, rendezvous, simhash_index, toxicity, url_rules,
)
from .common import remainder, table

TOKENIZER = "byte_bpe_50k.json"
QUERIES: dict = {}
CHECKS: dict[str, str] = {
    "op5_line_chunks": line_chunks.CHECK,
    "op11_fill_middle": fill_middle.CHECK,
    "op12_conversation_repair": conversation_repair.CHECK,
    "op13_rendezvous_shards": rendezvous.CHECK,
}
SHARDS = 16


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_counterfactual_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of every document; learned from labels whose id hash leaves a remainder but 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = remainder("doc_id", 5)
    model = toxicity.fit(toxicity.training_rows(docs, labels.where(rest != 0)))
    scored = docs.select("doc_id", rest.alias("rest"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(F.col("rest") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op2_rank_order_language(spark, sf_dir) -> DataFrame:
    """Language of every document; learned from rows whose id hash leaves a remainder but 2."""
    docs = table(spark, sf_dir, "documents")
    rest = remainder("doc_id", 4)
    profiles = langid.learn(docs.where(rest != 2))
    found = docs.select("doc_id", rest.alias("rest"), langid.language(F.col("text"), profiles).alias("found"))
    return found.select(
        "doc_id", F.coalesce(F.col("rest") == 2, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
    )


@query
def op3_masked_lm(spark, sf_dir) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    return masked_lm.scored(table(spark, sf_dir, "documents"))


@query
def op4_simhash_components(spark, sf_dir) -> DataFrame:
    """SimHash of every document and the smallest id it is linked to."""
    found = simhash_index.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_index.hex_digits("fp").alias("fingerprint"), "component_id")


@query
def op5_line_chunks(spark, sf_dir) -> DataFrame:
    """Every document without the chunks of lines that another one has first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_chunks.without_repeats(docs, counts=("n_lines", "n_removed"))
    return cut.select("doc_id", "n_lines", "n_removed", "text")


@query
def op6_bin_completion(spark, sf_dir) -> DataFrame:
    """Pieces of every document in as few sequences as the search finds."""
    digest = {"ids_crc32": ("long", bin_completion.crc_of)}
    return bin_completion.packed(table(spark, sf_dir, "documents"), tokenizer_path(), derive=digest)


@query
def op7_packed_ids(spark, sf_dir) -> DataFrame:
    """Packed rows of every document, written and read back, with a digest of each row's ids."""
    folder = scratch_folder(spark, "packed")
    rows = packed_ids.write_packed(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op8_url_rules(spark, sf_dir) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_rules.judged(pages, url_rules.rule_table(spark))
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_decontamination(spark, sf_dir) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.marked(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("found.items")).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("found")).alias("contaminated"),
    )


@query
def op10_minhash_fingerprints(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    found = fingerprints.compared_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op11_fill_middle(spark, sf_dir) -> DataFrame:
    """Fill-in-middle form of every document, with digests of its output and of the text rebuilt from it."""
    return fill_middle.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_conversation_repair(spark, sf_dir) -> DataFrame:
    """Every conversation after damage: its faults and its cheapest repair."""
    damaged = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.summaries(damaged)


@query
def op13_rendezvous_shards(spark, sf_dir) -> DataFrame:
    """Shard and slot of every document, and its shard with one shard more."""
    weights = dict.fromkeys(range(SHARDS), 1.0)
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        rendezvous.shard_of(F.col("doc_id"), {**weights, SHARDS: 1.0}).alias("grown_shard"),
    )
    folder = scratch_folder(spark, "shards")
    return rendezvous.write_shards(rows, folder, weights, ties=("size", "text_crc32")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CHECKS["op8_url_rules"] = f"""
WITH r(rule_host, rule_path, verdict) AS (VALUES
  {", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in url_rules.RULES)}
), p AS (
  SELECT row_number() OVER () AS row, page_id, url, strpos(url, '://') AS pos FROM pages
), u AS (
  SELECT row, page_id,
    CASE WHEN pos > 0 THEN {_LOWER.format("regexp_extract(substr(url, pos + 3), '^[^/?#]*')")} ELSE '' END AS host,
    CASE WHEN pos > 0 THEN regexp_extract(substr(url, pos + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM p
), f AS (
  SELECT row, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY row ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN f ON u.row = f.row AND place = 1
"""

_WORDS = (
    f"regexp_extract_all({_LOWER.format('text')}, "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
CHECKS["op9_decontamination"] = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT item, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i, w FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bw
), d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT n FROM windows),
dw AS (
  SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT row, i, n, item FROM dw JOIN windows USING (n, win)),
hit AS (SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS pos FROM m) GROUP BY row),
items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT row, item FROM m) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""
