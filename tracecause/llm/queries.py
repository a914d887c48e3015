"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm import chat, kneserney, langid, linededup, negatives, neighbours, pieces, secretscan, simhash, templates, toxicity, warc, whitening
from tracecause.llm.common import cut_lineage, fold_of, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """Encoding of every document with begin and end ids, and its decoding, as digests."""
    out = pieces.round_trip(table(spark, sf_dir, "documents"), model_path, ["doc_id"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secretscan.report(table(spark, sf_dir, "documents"), ["doc_id"])


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id of its near-duplicate group."""
    prints = cut_lineage(simhash.fingerprints(table(spark, sf_dir, "documents"), ["doc_id"]))
    out = simhash.near_duplicates(prints)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to a sharded archive and read back."""
    folder = warc.archive_folder(spark)
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    out = warc.read(manifest, folder, payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
chiefs AS (SELECT d, max(page_id) AS chief FROM payloads WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN coalesce(page_id < chief, chief IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN coalesce(page_id < chief, chief IS NOT NULL) THEN chief END AS refers_to
FROM payloads p LEFT JOIN chiefs c ON p.d = c.d AND p.n >= 1000"""


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark items that every document holds, one row per pair."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = templates.with_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op6_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"), 4)
    languages = langid.profiles(docs.where(fold != 2))
    out = langid.predict(docs, languages, ["doc_id"])
    return out.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled documents of two thirds of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = fold_of(F.col("doc_id"), 3)
    model = toxicity.fit(toxicity.sample(docs, labels.where(fold != 1)))
    out = toxicity.score(docs, model, ["doc_id"])
    return out.select("doc_id", (fold == 1).alias("held_out"), "score", "predicted")


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed of every document, with offsets and the documents that keep it."""
    docs = table(spark, sf_dir, "documents")
    spans = linededup.repeated_spans(docs)
    removed = F.aggregate("spans", F.lit(0), lambda total, s: total + s["stop"] - s["start"])
    mine = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    same = mine["doc_id"].eqNullSafe(spans["doc_id"]) & (mine["text_key"] == spans["text_key"])
    return mine.join(spans, same, "left").select(
        mine["doc_id"], "chars", F.coalesce(removed, F.lit(0)).alias("removed_chars"),
        F.coalesce("removed_units", F.lit(0)).alias("removed_units"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("spans"),
        F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["origin"]))).alias("origin_ids"))


def op9_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"), 7)
    model = kneserney.train(docs.where(fold != 2))
    out = kneserney.score(docs, model)
    return out.select("doc_id", (fold == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op11_chat(spark, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """Every conversation, and one that says control strings, formatted in windows and read back from them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.windows(rows.unionByName(tricky), chat.piece_counts(model_path)))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh one counts as of the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


OP12_SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
         CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
  FROM part a JOIN part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10"""


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Every vector on the leading components of all, one row per component."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = out.select("*", F.posexplode("z").alias("at", "whitened"))
    return each.select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                       F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error", "deviation_exact")


QUERIES = [op1_sentencepiece, op2_secrets, op3_simhash, op4_warc, op5_decontamination, op6_language, op7_toxicity,
           op8_line_dedup, op9_kneser_ney, op10_neighbours, op11_chat, op12_hard_negatives, op13_whitening]
ORACLES: dict[str, str] = {"op4_warc": OP4_SQL, "op12_hard_negatives": OP12_SQL}
