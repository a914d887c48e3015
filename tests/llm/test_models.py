"""Language ID, toxicity, the language model, archives and neighbours."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracecause.llm import kneserney, langid, neighbours, toxicity, warc
from tracecause.llm.queries import OP4_SQL, op4_warc, op6_language, op7_toxicity, op9_kneser_ney, op10_neighbours

MEDIUM = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def naive_grams(text):
    counts = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        counts.update(list(word))
        counts.update(padded[i:i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i:i + 3] for i in range(len(padded) - 2))
    return counts


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | (1 if c == " " else ord(c))
    return n


def test_language_by_brute_force(spark, make_docs, table_dir, sample_texts):
    rows = sample_texts[:80] + [(1000, "123 !!", "en"), (1001, None, "de"), (1002, "", None), (None, "the and of", None),
                                 (1003, "\u2764\ufe0f 123", "en"), (1005, "\u0301\u0302", "en")]  # marks are no letters
    got = op6_language(spark, table_dir(documents=make_docs(rows, clash=True))).collect()
    learned = defaultdict(Counter)
    for i, t, lang in rows:
        if fold(i, 4) != 2 and t is not None and lang is not None:
            learned[lang].update(naive_grams(t))
    profile = {lang: {g: r for r, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:langid.SIZE])}
               for lang, c in learned.items() if c}

    def nearest(t):
        if not any(c.isalpha() for c in t or ""):
            return "und", 0.0
        own = sorted(naive_grams(t or "").items(), key=lambda x: (-x[1], code(x[0])))[:langid.SIZE]
        if not own:
            return "und", 0.0
        d = {lang: sum(abs(p[g] - r) if g in p else langid.SIZE for r, (g, _) in enumerate(own)) for lang, p in profile.items()}
        best = min(d, key=lambda lang: (d[lang], lang))
        return best, 1 - d[best] / langid.SIZE / len(own)

    want = [(i, fold(i, 4) == 2, nearest(t)[0], round(nearest(t)[1], 9)) for i, t, _ in rows]
    assert sorted(map(str, ((*tuple(r)[:3], round(r[3], 9)) for r in got))) == sorted(map(str, want))
    nothing = op6_language(spark, table_dir(documents=make_docs(rows).withColumn("lang", F.lit(None).cast("string")))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert op6_language(spark, table_dir(documents=make_docs(rows).limit(0))).count() == 0


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = op6_language(spark, MEDIUM).join(docs, "doc_id").where("held_out AND text IS NOT NULL").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.95


def test_held_out_toxicity(spark, sf_dir, make_docs, table_dir):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    out = op7_toxicity(spark, MEDIUM).join(labels, "doc_id").where("held_out").toPandas()
    assert out.score.between(0, 1).all() and ((out.score >= 0.7) == (out.predicted == 1)).all()
    hit = out[out.toxic == 1].predicted.mean()
    assert hit > 0.5 and out[out.toxic == 0].predicted.mean() < 0.02
    rows = [(i, f"text {i} " + ("awful nastyword" if i % 2 else "calm"), None) for i in range(60)] + [(1000, None, None), (None, "calm", None), (3, "again", None)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(3, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in op7_toxicity(spark, table_dir(documents=make_docs(rows, clash=True), labels=marks)).collect()}
    assert len(got) == 62 and got[1]["score"] > 0.7 > got[2]["score"] and 0 <= got[1000]["score"] <= 1
    folder = table_dir(documents=make_docs(rows), labels=marks.limit(0))
    assert {r["score"] for r in op7_toxicity(spark, folder).collect()} == {0.0}
    assert op7_toxicity(spark, table_dir(documents=make_docs(rows).limit(0), labels=marks)).count() == 0


class Reference:
    """The same model in dictionaries."""

    def __init__(self, texts):
        self.c, self.pairs = Counter(), Counter()
        for t in texts:
            s = [*kneserney.tokens(t or ""), kneserney.END]
            self.c.update(s)
            self.pairs.update(zip([kneserney.END, *s[:-1]], s, strict=True))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.before, self.after, self.kinds = Counter(w for _, w in self.pairs), Counter(), defaultdict(Counter)
        for (u, _), k in self.pairs.items():
            self.after[u] += k
            self.kinds[u][min(k, 3)] += 1
        self.d = (0, *kneserney.discounts([sum(k == j for k in self.pairs.values()) for j in (1, 2, 3, 4)]))
        self.e = (0, *kneserney.discounts([sum(k == j for k in self.before.values()) for j in (1, 2, 3, 4)]))
        self.h = sum(self.e[min(k, 3)] for k in self.before.values()) / len(self.pairs)

    def word(self, w):
        k = self.before[w]
        return (k - self.e[min(k, 3)]) / len(self.pairs) + self.h / (self.v + 1)

    def p(self, u, w):
        if not self.after[u]:
            return self.word(w)
        k = self.pairs[u, w]
        return (k - self.d[min(k, 3)] + sum(self.d[j] * n for j, n in self.kinds[u].items()) * self.word(w)) / self.after[u]


def test_kneser_ney_by_brute_force(spark, make_docs, table_dir, sample_texts, monkeypatch):
    monkeypatch.setattr(kneserney, "TOKENS", 500)
    rows = sample_texts[:60] + [(1000, None, None), (1001, "", None), (1002, "never seen wordsxyz", None), (None, "The the", None), (1002, "x", None)]
    got = op9_kneser_ney(spark, table_dir(documents=make_docs(rows, clash=True))).collect()
    ref = Reference([t for i, t, _ in rows if fold(i, 7) != 2])
    for u in [kneserney.END, *list(ref.c)[:5], b"unseen"]:
        assert sum(ref.p(u, w) for w in ref.c) + ref.p(u, b"unseen") == pytest.approx(1, abs=1e-9)
    want = Counter()
    for i, t, _ in rows:
        s = [*kneserney.tokens(t or ""), kneserney.END]
        base = sum(math.log10((ref.c[w] + 1) / (ref.n + ref.v + 1)) for w in s)
        score = sum(math.log10(ref.p(u, w)) for u, w in zip([kneserney.END, *s[:-1]], s, strict=True))
        want[i, fold(i, 7) == 2, len(s), sum(ref.c[w] > 0 for w in s), ref.n, round(base, 6), round(score, 6)] += 1
    assert Counter((*tuple(r)[:5], round(r[5], 6), round(r[6], 6)) for r in got) == want
    assert op9_kneser_ney(spark, table_dir(documents=make_docs(rows).limit(0))).count() == 0


PAGES = [(1, "http://a/\r\nx", "x" * 2000), (2, None, "x" * 2000), (9, "http://b", "x" * 2000), (3, "http://c", "é" * 499), (4, "http://d", "é" * 499),
         (5, "http://e", "é" * 500), (6, "http://f", "é" * 500), (7, "http://g", None), (8, "http://h", ""), (None, "http://i", "x" * 2000),
         (9, "http://b", "x" * 2000), (10, "http://j", "a\r\n\r\nWARC/1.1\r\n" * 100)]


def test_archives(spark, table_dir, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "'r' AS refers_to", "2 AS n")
    folder = table_dir(pages=pages)
    got = sorted(map(str, map(tuple, op4_warc(spark, folder).collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    want = con.execute(OP4_SQL).fetchall()
    assert got == sorted(map(str, want))
    first = warc.write(pages, f"file://{tmp_path}/one", roll_bytes=300).orderBy("file").collect()
    again = warc.write(pages.orderBy(F.desc("url")), f"file://{tmp_path}/two", roll_bytes=300)
    assert again.orderBy("file").collect() == first and len(first) > 3
    assert sum(r["records"] for r in first) == len(PAGES)
    back = {(r["page_id"], bytes(r["payload"]).decode()) for r in warc.read(again, f"file://{tmp_path}/two").collect() if r["payload"] is not None}
    assert (5, "é" * 500) not in back and (6, "é" * 500) in back and (10, PAGES[-1][2]) in back and (7, "") in back
    none = warc.write(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read(none, f"file://{tmp_path}/none").count() == 0


def brute(rows, every, k):
    """{(query id, number of the row): [(id, score)]}, every row being a candidate of all others."""
    good = [(i, v) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (q, v) in enumerate(good):
        if q % every == 0:
            s = sorted((-float(np.dot(v, w)), i) for k, (i, w) in enumerate(good) if k != at)
            out[q, at] = [(i, -d) for d, i in s[:k]]
    return out


def test_neighbours_small_and_odd(spark, table_dir):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=8).astype(np.float32).astype(float).tolist()) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(200, None), (201, [0.0] * 8), (202, [1.0] * 7), (203, [None, *[1.0] * 7]),
                                                          (204, [float("nan")] * 8), (None, [1.0] * 8), (4, rows[4][1])]
    # A second row of an id with another vector, the nearest of row 0 by far; and a query whose row is there twice.
    rows += [(7, [3 * c for c in rows[0][1]]), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "0 AS label", "1 AS node", "2 AS x", "3 AS rank")
    got = defaultdict(list)
    for x in sorted(op10_neighbours(spark, table_dir(embeddings=df)).collect(), key=lambda x: x["rank"]):
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    want = defaultdict(list)
    for (q, _), found in brute(rows, 20, 20).items():
        want[q] += enumerate(found)
    assert set(got) == set(want) and got[0][0][0] == 7
    for q in want:
        expected = [x for _, x in sorted(want[q], key=lambda x: x[0])]
        assert [i for i, _ in got[q]] == [i for i, _ in expected]
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in expected])
    assert op10_neighbours(spark, table_dir(embeddings=df.limit(0))).count() == 0


def test_vectors_of_any_size(spark):
    """Inner products beyond 32-bit floats: shrinking all vectors alike changes no order."""
    r = np.random.default_rng(6)
    x = (r.normal(size=(1200, 8)) * 1e25).astype(np.float32)
    got = defaultdict(set)
    for row in neighbours.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect():
        got[row["query_id"]].add(row["vec_id"])
    wide, hits = x.astype(np.float64), 0
    for q in got:
        s = wide @ wide[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist())) / 20
    assert len(got) == 60 and hits / 60 >= 0.9


def test_recall(spark, sf_dir):
    df = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    x = np.array([v for _, v in rows])
    got = defaultdict(set)
    for r in neighbours.search(df).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            s = x @ np.array(v)
            s[at] = -np.inf
            hits += len(got[q] & {rows[i][0] for i in np.argsort(-s)[:20]}) / 20
    assert hits / len(got) >= 0.9
