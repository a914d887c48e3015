"""The pipeline's stages on small tables."""

import pytest

import corpus_pipeline as pipeline
from tracecause.llm import secretscan, simhash
from tracecause.llm.queries import PIECE_MODEL

ROWS = [(1, "The quick brown fox jumps over the lazy dog. " * 20, "en"), (2, "The quick brown fox jumps over the lazy dog. " * 20, "en"),
        (2, "The quick brown fox jumps over the lazy dog. " * 20, "en"), (3, "123 456 !!!", "en"), (4, None, "en"),
        (5, "my token = \"" + "ab12" * 10 + "\" is here, and nothing else is", "en"), (6, "", None),
        (7, "he asked what is the colour of the sky on a clear day in summer and left", "en"), (None, "No name has this one text", "en"),
        (None, "No name has this one text", "en"), (8, "Ein Satz auf Deutsch, der nicht lang ist und mit der Sprache", "de")]


@pytest.fixture(scope="module")
def folder(spark, make_docs, table_dir):
    bench = spark.createDataFrame([(1, "What is the colour of the sky on a clear day in summer")], "item_id long, text string")
    return table_dir(documents=make_docs(ROWS, clash=True), benchmark=bench)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = dict(pipeline.STAGES)
    kept = steps["language"](spark, docs, folder)
    assert kept.columns == pipeline.COLUMNS
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 2, 5, 7, 8]
    single = steps["near_duplicates"](spark, kept, folder)
    assert sorted((r["doc_id"] or 0) for r in single.collect()) == [0, 1, 5, 7, 8]
    fresh = steps["benchmark"](spark, single, folder)
    assert sorted((r["doc_id"] or 0) for r in fresh.collect()) == [0, 1, 5, 8]
    safe = {r["doc_id"]: r for r in steps["secrets"](spark, fresh, folder).collect()}
    assert safe[5]["text"] == secretscan.redacted(ROWS[5][1]) and safe[5]["n_chars"] == len(safe[5]["text"])
    assert safe[1]["text"] == ROWS[0][1] and len(safe) == 4


def test_run(spark, folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = {r["doc_id"]: r for r in pipeline.run(spark, folder).collect()}
    assert set(rows) == {None, 1, 5, 8} and all(r["round_trip"] for r in rows.values())
    assert rows[8]["ids"] == library.encode(ROWS[-1][1], add_bos=True, add_eos=True)


def test_run_matches_brute_force(spark, sf_dir, sample_texts):
    kept = {r["doc_id"] for r in pipeline.run(spark, sf_dir).collect()}
    prints = {i: simhash.fingerprint(t or "") for i, t, _ in sample_texts}
    assert len({prints[i] for i in kept}) == len(kept)
    assert kept <= set(prints)


def test_empty_tables(spark, make_docs, table_dir):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert pipeline.run(spark, table_dir(documents=make_docs(ROWS).limit(0), benchmark=bench)).count() == 0
    assert pipeline.run(spark, table_dir(documents=make_docs(ROWS), benchmark=bench)).count() == 5
