"""One query for each operator, over its whole table, and SQL checks."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vasculum.llm import divergence, dropout, html_text, language, lattice, licences, minhash, mixing, packing, prefix_trie, preferences, quality, ranking

#: Parameters of the queries.
PACK_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PACK_LENGTH = 1024
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
DROP_RATE, DROP_SEED = 0.1, 2_024
#: Conversations that exchange their answers with each other, on average.
PARTNERS = 200


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(parts: int):
    """Fold of a document; documents without id are in none, and so are never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of packed sequences, with their checksums."""
    pieces = packing.pack(_table(spark, folder, "documents"), PACK_TOKENIZER, PACK_LENGTH)
    return packing.with_crc(pieces, PACK_TOKENIZER)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by profiles learned outside the held-out fold."""
    docs = _table(spark, folder, "documents")
    profiles = language.learn_profiles(docs, _fold(5) != 0)
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by neighbours learned outside the held-out fold."""
    docs = _table(spark, folder, "documents")
    voter = quality.learn(docs, _table(spark, folder, "labels"), _fold(4) != 2)
    found = quality.classify(docs.select("doc_id", "text"), voter)
    return found.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates by two-word shingles."""
    return minhash.near_duplicates(_table(spark, folder, "documents"), words=2, percent=80)


def op4_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """Merge-dropout segmentation of every document, with checksums of ids and of the text decoded from them."""
    docs = _table(spark, folder, "documents")
    encoded = dropout.encode(docs, PIECE_MODEL, DROP_RATE, DROP_SEED)
    decoded = dropout.decode(encoded, PIECE_MODEL)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"),
    )


def op5_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as the chosen one, against itself with its last answer exchanged for that of another.

    The other is the next conversation by id in a group of about PARTNERS, the first following the last.
    """
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    last = turns.groupBy("conv_id").agg(
        F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last"),
        F.max_by("text", F.when(F.col("role") == "assistant", F.col("turn"))).alias("answer"),
    )
    groups = max(1, -(-last.count() // PARTNERS))
    by_id = Window.partitionBy(F.pmod("conv_id", F.lit(groups))).orderBy("conv_id")
    whole = by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("answer").over(by_id), F.first("answer").over(whole), F.lit(""))
    last = last.withColumn("other", other)
    before = turns.join(last.select("conv_id", "last"), "conv_id").filter("last is null or turn < last")
    answer = last.select("conv_id", F.coalesce("last", F.lit(2**31 - 1)).alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text"))
    rejected = before.select("conv_id", "turn", "role", "text").unionByName(answer)
    sides = turns.withColumn("side", F.lit("chosen")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    found = preferences.format_preferences(sides.withColumnRenamed("conv_id", "pair_id"))
    trained = [F.aggregate(s, F.lit(0), lambda a, x: a + x["length"]).cast("long").alias(s.replace("spans", "trained")) for s in ("chosen_spans", "rejected_spans")]
    return found.select(
        "pair_id", "n_common", *[F.md5(c).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")],
        *[F.length(c).cast("long").alias(f"{c}_chars") for c in ("prompt", "chosen", "rejected")], *trained, "usable",
    )


def op6_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates of all embeddings."""
    return lattice.near_duplicates(_table(spark, folder, "embeddings"))


def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, folder, "pages"))


def op9_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules of every document."""
    return divergence.judge(_table(spark, folder, "documents"))


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licences.scan(_table(spark, folder, "documents"), windows=True)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.conversation_trie(_table(spark, folder, "conversations")).drop("name")


def op12_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return ranking.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes from every document."""
    return mixing.mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_quality": op3_quality,
    "op4_dropout": op4_dropout,
    "op5_preferences": op5_preferences,
    "op6_lattice": op6_lattice,
    "op7_html": op7_html,
    "op8_minhash": op8_minhash,
    "op9_divergence": op9_divergence,
    "op10_licences": op10_licences,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranking": op12_ranking,
    "op13_mixing": op13_mixing,
}
#: The result of `op5_preferences`.
PREFERENCES_SQL = f"""WITH last AS (
  SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last, arg_max({{'text': text}}, turn) FILTER (role = 'assistant') AS answer FROM conversations GROUP BY conv_id),
dealt AS (SELECT conv_id, last, answer.text AS answer, conv_id % (SELECT greatest(1, CAST(ceil(count(*) / {PARTNERS}.0) AS BIGINT)) FROM last) AS part FROM last),
paired AS (SELECT conv_id, last, coalesce(lead(answer) OVER (PARTITION BY part ORDER BY conv_id),
  first_value(answer) OVER (PARTITION BY part ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') AS other FROM dealt),
sides AS (SELECT conv_id, 1 AS side, turn, role, text FROM conversations
  UNION ALL SELECT t.conv_id, 2, t.turn, t.role, t.text FROM conversations t JOIN paired p ON t.conv_id = p.conv_id WHERE p.last IS NULL OR t.turn < p.last
  UNION ALL SELECT conv_id, 2, coalesce(last, 2147483647), 'assistant', other FROM paired),
cleaned AS (SELECT conv_id, side, turn, replace(replace(coalesce(role, 'user'), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS role,
  replace(replace(coalesce(text, ''), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS text FROM sides),
turns AS (SELECT conv_id, side, {{'role': role, 'text': text, 'shown': '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)}} AS t, turn, role, text FROM cleaned),
lists AS (SELECT conv_id, coalesce(list(t ORDER BY turn NULLS FIRST, role, text) FILTER (side = 1), []) AS c,
  coalesce(list(t ORDER BY turn NULLS FIRST, role, text) FILTER (side = 2), []) AS r FROM turns GROUP BY conv_id),
counted AS (SELECT *, coalesce(list_min(list_filter(generate_series(1, least(len(c), len(r))), lambda i: c[i].shown <> r[i].shown OR c[i].role <> r[i].role)) - 1,
  least(len(c), len(r))) AS n FROM lists),
cut AS (SELECT conv_id, n, c[1:n] AS head, c[n + 1:] AS c, r[n + 1:] AS r FROM counted),
texts AS (SELECT conv_id AS pair_id, CAST(n AS BIGINT) AS n_common, coalesce(array_to_string(list_transform(head, lambda t: t.shown), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(c, lambda t: t.shown), ''), '') AS chosen, coalesce(array_to_string(list_transform(r, lambda t: t.shown), ''), '') AS rejected,
  list_transform(list_filter(c, lambda t: t.role = 'assistant'), lambda t: length(t.text) + 10) AS cs,
  list_transform(list_filter(r, lambda t: t.role = 'assistant'), lambda t: length(t.text) + 10) AS rs FROM cut)
SELECT pair_id, n_common, md5(prompt) AS prompt_md5, md5(chosen) AS chosen_md5, md5(rejected) AS rejected_md5,
  CAST(length(prompt) AS BIGINT) AS prompt_chars, CAST(length(chosen) AS BIGINT) AS chosen_chars, CAST(length(rejected) AS BIGINT) AS rejected_chars,
  CAST(coalesce(list_sum(cs), 0) AS BIGINT) AS chosen_trained, CAST(coalesce(list_sum(rs), 0) AS BIGINT) AS rejected_trained, len(cs) > 0 AND len(rs) > 0 AS usable
FROM texts"""
ORACLES: dict[str, str] = {"op5_preferences": PREFERENCES_SQL, "op8_minhash": minhash.SQL, "op11_prefix_trie": prefix_trie.SQL, "op12_ranking": ranking.SQL, "op13_mixing": mixing.SQL}
