"""Cleaning of a corpus in stages: language, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes all that the one before kept. Columns beyond those of ``documents`` are not carried. Null ids and texts,
empty texts, repeated rows and empty tables pass as each operator defines it (see ``tracecause.llm``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tracecause.llm import langid, pieces, secretscan, simhash, templates
from tracecause.llm.common import cut_lineage, fold_of, fresh_path, table
from tracecause.llm.queries import PIECE_MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least likeness (1 less the share of the largest distance) to the nearest language profile.
LEAST_LIKENESS = 0.1


def known_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those unlike every learned language, go. Nothing is rejected for its length."""
    docs = docs.select(*COLUMNS)
    languages = langid.profiles(docs.where(fold_of(F.col("doc_id"), 4) != 2))
    judged = langid.predict(docs, languages, COLUMNS)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LIKENESS)).select(*COLUMNS)


def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays (of several rows with that id, one).

    Documents with a null id stay only where their group has no other id, again one of them.
    """
    docs = docs.select(*COLUMNS)
    prints = cut_lineage(simhash.fingerprints(docs, ["doc_id"]))
    groups = cut_lineage(simhash.near_duplicates(prints))
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Ids are unique as a rule, and then no text needs to be compared with another.
    rows = stays.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    plain = rows.where("rows = 1").select("doc_id")
    kept = docs.join(plain, "doc_id", "left_semi")
    again = docs.join(rows.where("rows > 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id IS NULL")
    if not nameless.isEmpty():
        named = simhash.fingerprints(nameless, COLUMNS)
        alone = groups.where("component_id IS NULL").select("fp").distinct()
        again = again.unionByName(named.join(alone, "fp", "left_semi").dropDuplicates(["fp"]).select(*COLUMNS))
    return kept.unionByName(again).select(*COLUMNS)


def no_benchmark(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def no_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are replaced by a mark; every document stays, and ``n_chars`` follows its text."""
    shared = spark.sparkContext.broadcast(secretscan.ranks(docs))

    @pandas_udf("string")
    def redact(texts):
        return texts.map(lambda t: secretscan.redacted(t, ranked=shared.value), na_action="ignore")

    changed = docs.select(*COLUMNS).withColumn("__new", redact("text"))
    same = F.col("__new").eqNullSafe(F.col("text"))
    return changed.select("doc_id", F.col("__new").alias("text"), "lang", "source",
                          F.when(same, F.col("n_chars")).otherwise(F.length("__new").cast("long")).alias("n_chars"))


def as_pieces(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text with begin and end ids; decoding them gives the text back (``round_trip``)."""
    coded = pieces.checked_pieces(docs, PIECE_MODEL, ["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [("language", known_language), ("near_duplicates", one_of_each), ("benchmark", no_benchmark),
          ("secrets", no_secrets), ("pieces", as_pieces)]
#: The stages can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
