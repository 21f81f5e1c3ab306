"""The registered queries of this package and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import ngram_lm
from topicloom.llm.exact import exact_groups
from topicloom.llm.jaccard import jaccard_components
from topicloom.llm.language import languages, with_held_out
from topicloom.llm.merkle import manifest
from topicloom.llm.mixing import mix
from topicloom.llm.multiset import edited_fingerprints
from topicloom.llm.packing import byte_bpe, packed
from topicloom.llm.quotes import linked_conversations
from topicloom.llm.runs import RUN, periodic_runs
from topicloom.llm.sampling import crc_part
from topicloom.llm.simhash import near_components
from topicloom.llm.toxicity import toxicity
from topicloom.llm.windows import repeated_passages
from topicloom.sources.testdata import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_part("doc_id", 5) == 1
    found = ngram_lm.score(docs, ngram_lm.fit(docs.where(~held_out)))
    return found.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that several documents share."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return linked_conversations(table(spark, sf_dir, "conversations"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from three quarters of them and their labels."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_part("doc_id", 4) != 2)
    found = toxicity(docs, labels, with_held_out(docs, 4, 2))
    return found.select(
        "doc_id", (crc_part("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts; the largest id stays."""
    return exact_groups(table(spark, sf_dir, "documents"), stays="largest")


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    encoder = partial(byte_bpe, public_tokenizers.path("byte_bpe_50k.json"))
    return packed(table(spark, sf_dir, "documents"), encoder)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 5, 2, 1 to as many words as there are."""
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return mix(table(spark, sf_dir, "documents")).select(*columns)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are 90 % alike."""
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    found = languages(docs, with_held_out(docs, 4, 2))
    return found.select(
        "doc_id", (crc_part("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, of which about half are checked without their line breaks."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    broken = F.when(crc_part("doc_id", 2) == 0, F.translate("text", "\n", ""))
    claimed = [F.col(c) for c in columns[:-1]] + [F.coalesce(broken, F.col("text"))]
    return manifest(table(spark, sf_dir, "documents"), columns, claimed=claimed)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, in which a tenth of the texts repeat a part of themselves up to their end."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    words = docs.select("doc_id", "text", F.floor(number / 10).alias("g"),
                        F.when(number % 10 == 0, found).alias("w"))
    sized = words.withColumn("n", F.size("w").cast("bigint"))
    begin = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    placed = begin.withColumn("p", period)
    repeated = F.expr("transform(w, (word, i) -> if(i < a, word, w[cast(a + (i - a) % p as int)]))")
    text = F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods and more in all documents, of which a tenth get one planted."""
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.expr(
        f"""aggregate(runs, CAST(NULL AS {RUN}), (best, r) -> IF(
              best IS NULL OR r.length * best.period > best.length * r.period, r, best))"""
    )
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints of four-word shingles differ in four bits at most."""
    return near_components(table(spark, sf_dir, "documents"), size=4, distance=4)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_ngram_trie": op1_ngram_trie,
        "op2_multiset_hash": op2_multiset_hash,
        "op3_compact_windows": op3_compact_windows,
        "op4_quotation_linking": op4_quotation_linking,
        "op5_toxicity": op5_toxicity,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_harmonic_packing": op7_harmonic_packing,
        "op8_mix_sources": op8_mix_sources,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_language_id": op10_language_id,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_simhash_grid": op13_simhash_grid,
    }


def llm_oracle() -> dict[str, str]:
    return {
        "op6_exact_dedup": EXACT_SQL,
        "op8_mix_sources": MIX_SQL,
        "op11_merkle_manifest": MERKLE_SQL,
    }


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS text_hash,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT
           AS place
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS total,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(turn % 3 + 1)::INT] AS weight, 3 * total AS cap FROM sizes
), levels AS (
  -- sources that are full at or below each one's own level, those with the lowest first
  SELECT *, coalesce(sum(cap) OVER before, 0) AS full_below,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
         sum(total) OVER () AS words
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  -- with too few or too many sources taken as full the level comes out lower
  SELECT max((words - full_below)::DOUBLE / open_weight) AS height FROM levels
), targets AS (
  SELECT source, total, least(cap::DOUBLE, weight * (SELECT height FROM level)) AS target
  FROM weighed
), queue AS (
  SELECT r.*, t.total, t.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.place, r.doc_id, r.text_hash) AS done
  FROM sized r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT doc_id, source, text_hash, size, place, ((done + turn * total)::DOUBLE / target) AS finish
  FROM queue, (VALUES (0), (1), (2)) AS p(turn) WHERE size > 0 AND target > 0
), taken AS (
  SELECT doc_id, source, text_hash, count(*) AS copies
  FROM (SELECT *, sum(size) OVER (ORDER BY finish, place) AS reached FROM passes)
  WHERE reached <= (SELECT sum(size) FROM sized)
  GROUP BY ALL
)
SELECT q.doc_id, q.size, q.total AS source_size, q.target,
       (q.size * coalesce(t.copies, 0))::BIGINT AS taken
FROM queue q LEFT JOIN taken t ON q.doc_id = t.doc_id AND q.text_hash = t.text_hash
     AND q.source IS NOT DISTINCT FROM t.source
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_SIBLINGS = "array_to_string(hs[:pos % 3], ''), array_to_string(hs[pos % 3 + 2:], '')"

MERKLE_SQL = f"""
WITH RECURSIVE crc_bytes AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), checked AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295],
              list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::BIGINT)),
              lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS crc
  FROM documents, crc_bytes
), leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n,
         sha256({_HEAD} || {_field("text")}) AS leaf,
         sha256({_HEAD} || CASE WHEN crc % 2 = 0 THEN {_field("replace(text, chr(10), '')")}
                                ELSE {_field("text")} END) AS claimed
  FROM checked
), node(tree, level, pos, h, n) AS (
  SELECT tree, 0, rank, leaf, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM node WHERE n > 1 GROUP BY tree, level, pos // 3, n
), runs AS (
  SELECT tree, level, pos // 3 AS up, list(h ORDER BY pos) AS hs FROM node WHERE n > 1 GROUP BY ALL
), climb(doc_id, tree, level, pos, h, siblings) AS (
  SELECT doc_id, tree, 0, rank, claimed, '' FROM leaves
  UNION ALL
  SELECT c.doc_id, c.tree, c.level + 1, c.pos // 3,
         sha256(concat(array_to_string(hs[:pos % 3], ''), h, array_to_string(hs[pos % 3 + 2:], ''))),
         concat(siblings, {_SIBLINGS})
  FROM climb c JOIN runs r ON c.tree = r.tree AND c.level = r.level AND c.pos // 3 = r.up
), below AS (
  SELECT doc_id, tree, arg_max(h, level) AS h, arg_max(siblings, level) AS siblings FROM climb GROUP BY ALL
), subroots AS (
  SELECT tree, h AS subroot, count(*) OVER () AS n FROM node WHERE n = 1
), top_node(level, pos, h, n) AS (
  SELECT 0, tree, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM top_node WHERE n > 1 GROUP BY level, pos // 3, n
), top_runs AS (
  SELECT level, pos // 3 AS up, list(h ORDER BY pos) AS hs FROM top_node WHERE n > 1 GROUP BY ALL
), top_climb(doc_id, level, pos, h, siblings) AS (
  SELECT doc_id, 0, tree, h, siblings FROM below
  UNION ALL
  SELECT c.doc_id, c.level + 1, c.pos // 3,
         sha256(concat(array_to_string(hs[:pos % 3], ''), h, array_to_string(hs[pos % 3 + 2:], ''))),
         concat(siblings, {_SIBLINGS})
  FROM top_climb c JOIN top_runs r ON c.level = r.level AND c.pos // 3 = r.up
), proofs AS (
  SELECT doc_id, arg_max(h, level) AS folded_root, arg_max(siblings, level) AS siblings
  FROM top_climb GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(p.siblings) AS proof_sha256, p.folded_root,
       p.folded_root = t.h AS verified
FROM leaves l JOIN subroots s ON l.tree = s.tree JOIN proofs p ON l.doc_id = p.doc_id
     JOIN top_node t ON t.n = 1
"""
