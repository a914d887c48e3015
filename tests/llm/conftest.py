import pytest

#: Names that operators use themselves; a table that has them already must not disturb.
CLASHING = ["fp", "ids", "score", "n_tokens", "leaks", "component_id", "root", "node", "key", "hi", "bucket", "rank", "n",
            "decoded", "spans", "removed", "label", "digest", "x", "least", "first"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents of (doc_id, text[, lang]) rows, with columns whose names clash if asked for."""
    def make(rows, clash=False):
        rows = [(*r, None)[:3] for r in rows]
        df = spark.createDataFrame([(i, t, l, "src0", len(t) if t is not None else None) for i, t, l in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", *[f"'clash' AS `{c}`" for c in CLASHING]) if clash else df
    return make


@pytest.fixture(scope="session")
def sample_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [(r[0], r[1], r[2]) for r in rows]


@pytest.fixture(scope="session")
def table_dir(spark, tmp_path_factory):
    """Writes tables to a folder of their own and returns it, as queries expect it."""
    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)
    return write
