"""SimHash groups, line dedup and decontamination against brute force."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracecause.llm import components, linededup, simhash, templates
from tracecause.llm.bktree import Forest
from tracecause.llm.queries import op3_simhash, op5_decontamination, op8_line_dedup


def roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def clustered(n, seed):
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        p = r.getrandbits(64)
        for _ in range(r.randint(1, 30)):
            out[p] = None
            for _ in range(r.randint(0, 3)):
                p ^= 1 << r.randrange(64)
    return list(out)[:n]


def test_fingerprint_by_definition(sample_texts):
    for t in ["", "One", "one two", "A b\x0bC d e", *[t or "" for _, t, _ in sample_texts[:40]]]:
        words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))]
        shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        assert simhash.fingerprint(t) & (1 << 64) - 1 == want


def test_forest_finds_all_within_the_radius():
    points = np.array(clustered(600, 1), dtype=np.uint64)
    tree = np.sort(np.random.default_rng(2).integers(0, 3, 600))
    got = set()
    for q, p in Forest(tree, points).near(tree, points, 3):
        got |= set(zip(q.tolist(), p.tolist(), strict=True))
    want = {(i, j) for i in range(600) for j in range(600) if tree[i] == tree[j] and int(points[i] ^ points[j]).bit_count() <= 3}
    assert got == want


@pytest.mark.parametrize("shard", [4096, 5])
def test_links_join_all_near_fingerprints(spark, shard):
    points = clustered(400, 3)
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    place = {p: i for i, p in enumerate(signed)}
    got = [(place[r[0]], place[r[1]]) for r in simhash.links(df, shard).collect()]
    near = [(i, j) for i, j in itertools.combinations(range(len(points)), 2) if (points[i] ^ points[j]).bit_count() <= 3]
    assert roots(len(points), got) == roots(len(points), near)


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7000, 6999), (7000, 6999)]
    got = dict(components.stars(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = sorted({x for e in edges for x in e})
    want = roots(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in edges])
    assert got == {n: nodes[w] for n, w in zip(nodes, want, strict=True)}
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_op3_groups(spark, make_docs, table_dir, sample_texts):
    base = " ".join(f"w{i}" for i in range(3000))
    rows = [(i, t) for i, t, _ in sample_texts[:60]] + [(900, base), (800, base + " end"), (850, base.upper()), (990, None), (980, ""),
                                                        (None, base), (800, base + " end"), (None, "lonely words")]
    got = op3_simhash(spark, table_dir(documents=make_docs(rows, clash=True))).collect()
    prints = [simhash.fingerprint(t or "") & (1 << 64) - 1 for _, t in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    members = defaultdict(list)
    for i, root in enumerate(roots(len(rows), near)):
        members[root].append(i)
    least = {i: min((rows[j][0] for j in m if rows[j][0] is not None), default=None) for m in members.values() for i in m}
    want = [(rows[i][0], f"{prints[i]:016x}", least[i]) for i in range(len(rows))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert op3_simhash(spark, table_dir(documents=make_docs(rows).limit(0))).count() == 0


UNIT, WORD = re.compile(r"[^\n.!?]+[.!?]*|[.!?]+"), re.compile(r"\w+")


def plain_units(text, least):
    """(start, end, words) by loops over characters and words; only hashes of words are asked of the operator."""
    pieces = []
    for m in UNIT.finditer(text):
        at, held = m.start(), []
        words = list(WORD.finditer(text, m.start(), m.end()))
        h = [int(linededup.words_of(w[0])[2][0]) for w in words]
        for i, w in enumerate(words):
            held.append("".join(c.lower() if len(c.lower()) == 1 else c for c in w[0]))
            if 3 <= i < len(h) - 3 and h[i] < min(h[i - 3:i]) and h[i] <= min(h[i + 1:i + 4]):
                pieces.append((at, w.end(), held))
                at, held = w.end(), []
        if held:
            pieces.append((at, m.end(), held))
    count = lambda a, b: sum(len(pieces[k][2]) for k in range(a, b + 1))
    runs = set()
    for a in range(len(pieces)):
        for b in range(a, len(pieces)):
            if count(a, b) >= least:
                runs.add((a, b))  # shortest from a on
                while count(a + 1, b) >= least:
                    a += 1
                runs.add((a, b))  # and shortest up to b
                break
    for b in range(len(pieces)):
        for a in range(b, -1, -1):
            if count(a, b) >= least:
                runs.add((a, b))
                break
    if pieces and not runs:
        runs = {(0, len(pieces) - 1)}
    shortest = [(a, b) for a, b in runs if count(a, b) < least or count(a + 1, b) < least or count(a, b - 1) < least]
    return [(pieces[a][0], pieces[b][1], [w for p in pieces[a:b + 1] for w in p[2]]) for a, b in sorted(shortest)]


def brute_spans(rows, least):
    seen, out = {}, {}
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    for i, t in docs:
        spans, last = [], None
        for seq, (start, stop, words) in enumerate(plain_units(t, least)):
            if tuple(words) not in seen:
                seen[tuple(words)] = i
            elif len(words) >= least:
                if spans and (start < spans[-1]["stop"] or seq == last + 1):
                    spans[-1]["stop"] = max(stop, spans[-1]["stop"])
                else:
                    spans.append({"start": start, "stop": stop, "origin": seen[tuple(words)]})
                last = seq
        if spans:
            out[i, t] = spans
    return out


def test_units_of_odd_texts(sample_texts):
    r = random.Random(3)
    odd = ["", "a", ".", "...!a.b", "a.\n.b\n\nc!?d", "İstanbul ǅ ß Σς", "word_1 x2\u0301 \U0001f600 東京", " . ", "a" * 50]
    odd += ["".join(r.choice("ab. \n!") for _ in range(200)) for _ in range(60)] + [t for _, t, _ in sample_texts[:40] if t and len(t) < 4000]
    table = linededup.unit_table(odd, 4)
    for k, t in enumerate(odd):
        mine = table["text"] == k
        got = list(zip(*(table[c][mine].tolist() for c in ("start", "stop", "words"))))
        want = plain_units(t, 4)
        assert got == [(a, b, len(w)) for a, b, w in want], t
        assert table["seq"][mine].tolist() == list(range(len(want)))
    digests = {}
    for k in range(len(table["hi"])):
        words = tuple(plain_units(odd[table["text"][k]], 4)[table["seq"][k]][2])
        assert digests.setdefault(words, (table["hi"][k], table["lo"][k])) == (table["hi"][k], table["lo"][k])
    assert len(set(digests.values())) == len(digests)


def test_units_do_not_depend_on_chunks(monkeypatch, sample_texts):
    texts = [t for _, t, _ in sample_texts if t][:50] + ["x" * 500, "long " * 300 + "y" * 300]
    want = linededup.unit_table(texts)
    monkeypatch.setattr(linededup, "CHUNK", 64)
    linededup.powers.cache_clear()
    got = linededup.unit_table(texts)
    linededup.powers.cache_clear()
    assert all((got[c] == want[c]).all() for c in want)


def test_repeated_spans(spark, make_docs, sample_texts):
    passage = "Shared words of a passage that goes on. " + " ".join(f"p{i}" for i in range(60)) + ". And its end is here too"
    rows = [(i, t) for i, t, _ in sample_texts[:60]] + [(500, "Own start, then " + passage + "."), (501, "Other\n" + passage + "!"), (502, ""),
                                                        (503, None), (499, "Yes. It is. No?"), (498, "Yes. It is. No?")]
    docs = make_docs(rows, clash=True)
    spans = linededup.repeated_spans(docs)
    got = {r["doc_id"]: [s.asDict() for s in r["spans"]] for r in spans.collect()}
    want = {i: s for (i, _), s in brute_spans(rows, linededup.LEAST_WORDS).items()}
    assert got == want and 501 in got and 499 not in got
    stripped = {r["doc_id"]: r["text"] for r in linededup.strip(make_docs(rows, clash=True), spans).collect()}
    assert len(stripped) == len(rows) and "p30 p31" in stripped[500] and "p30 p31" not in stripped[501]
    assert stripped[503] is None


def test_repeated_stretches_by_plain_search(spark, make_docs):
    r = random.Random(5)
    fresh = itertools.count()
    own = lambda n: " ".join(f"own{next(fresh)}" for _ in range(n))
    rows = []
    for k in range(40):  # sentences of 18 words, the passage glued to others of its own, before and after
        words = [f"w{r.randrange(10 ** 6)}" + "." * (i % 18 == 17) for i in range(50 + k)]
        rows += [(2 * k, f"{own(3 + k % 20)} {' '.join(words)} {own(k % 7)}"), (2 * k + 1, f"{own(k % 33)} {' '.join(words)} {own(15)}")]
    common = [f"c{i}" for i in range(30)]  # pieces of them agree by chance all the time, stretches of 8 words hardly
    rows += [(100 + k, " ".join(r.choice(common) for _ in range(400))) for k in range(20)]
    gone = {x["doc_id"]: x["spans"] for x in linededup.repeated_spans(make_docs(rows)).collect()}
    seen = {}
    for i, t in rows:
        words = [(m[0], *m.span()) for m in WORD.finditer(t)]
        cut = [any(s["start"] <= a and b <= s["stop"] for s in gone.get(i, ())) for _, a, b in words]
        again = [False] * len(words)
        for at in range(len(words) - 7):
            if seen.setdefault(" ".join(w for w, _, _ in words[at:at + 8]), (i, at)) != (i, at):
                again[at:at + 8] = [True] * 8
        assert all(b for a, b in zip(cut, again, strict=True) if a), i
        if i < 100 and i % 2:
            assert sum(cut) * 2 > sum(again) >= 50, i


def test_op8_edges(spark, make_docs, table_dir):
    line = "one two three four five six seven eight nine"
    rows = [(1, line), (2, line), (2, line), (None, line), (3, None)]
    got = {(r["doc_id"], r["removed_chars"], str(r["origin_ids"])) for r in op8_line_dedup(spark, table_dir(documents=make_docs(rows, clash=True))).collect()}
    assert got == {(1, len(line), "[None]"), (2, len(line), "[None]"), (None, 0, "None"), (3, 0, "None")}
    assert op8_line_dedup(spark, table_dir(documents=make_docs(rows).limit(0))).count() == 0


ITEMS = [(1, "A train leaves Boston at 60 km per hour and reaches Chicago after 12 hours. How far is Boston from Chicago in miles?"),
         (2, "What is the colour of the sky on a clear day in summer"), (3, "short one here"), (4, None), (5, "")]


def test_reparameterised_questions(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(1, "Some prose first. A train leaves Paris at 90 mph per hour and reaches Lyon after 3 hours. How far is Paris from Lyon in miles? More."),
            (2, "Some prose first. A train leaves Paris at 90 mph per hour and reaches Lyon after 3 hours. How far is Rome from Oslo in miles? More."),
            (3, "he asked what is the colour of the sky on a clear day in summer and left"), (4, "what is the colour of the sea"),
            (5, "a short one here"), (6, None), (7, ""), (None, "What is the colour of the sky on a clear day in summer"),
            (3, "he asked what is the colour of the sky on a clear day in summer and left")]
    docs = make_docs(rows, clash=True)
    for windows in (10 ** 6, 0):
        out = templates.with_leaks(docs, bench, index_windows=windows).collect()
        got = sorted(((r["doc_id"] or 0, sorted(x["item_id"] for x in r["leaks"])) for r in out))
        assert got == [(0, [2]), (1, [1]), (2, []), (3, [2]), (3, [2]), (4, []), (5, [3]), (6, []), (7, [])], windows
        assert sorted(r["doc_id"] for r in templates.clean(docs, bench, windows).collect()) == [2, 4, 6, 7]
    assert templates.with_leaks(docs, bench.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert templates.with_leaks(docs.limit(0), bench).count() == 0


ANNA = "If {} has {} apples and gives {} to {} and {} to {}, how many apples does {} have left for {} and {}?"


def anna(a, b, c, *numbers):
    return ANNA.format(a, numbers[0], numbers[1], b, numbers[2], c, a, b, c)


def test_copies_in_one_document_do_not_vote_for_each_other(spark, make_docs):
    copy, one, two = anna("Anna", "Ben", "Carla", 12, 3, 4), anna("Maria", "Otto", "Paul", 20, 5, 6), anna("Xaver", "Yves", "Zoe", 31, 7, 8)
    mixed = anna("Maria", "Otto", "Paul", 20, 5, 6).replace("left for Otto and Paul", "left for Kim and Lea").replace("does Maria", "does Joe")
    rows = [(1, copy), (2, f"{copy} {one}"), (3, f"{one} {copy} {two}"), (4, f"{one}\n{two}"), (5, "Prose. " * 50 + f"{two} {copy} {one} " + "More. " * 50),
            (6, mixed), (7, anna("Anna Maria", "Otto", "Paul", 20, 5, 6)), (8, copy[:55] + " Then prose goes on. " * 9 + copy[55:])]
    bench = spark.createDataFrame([(1, copy)], "item_id long, text string")
    out = [{r["doc_id"]: r["leaks"] for r in templates.with_leaks(make_docs(rows), bench, index_windows=n).collect()} for n in (10 ** 6, 0)]
    assert out[0] == out[1]
    assert [i for i, leaks in sorted(out[0].items()) if leaks] == [1, 2, 3, 4, 5, 7]
    assert all(leaks[0]["matched"] == leaks[0]["windows"] for i, leaks in out[0].items() if leaks and i != 7)
    wide = templates.Index([(1, *templates.item_windows(" ".join(["alpha beta gamma delta in Boston epsilon zeta eta theta"] * 3), templates.Codes()))])
    assert wide.find(" ".join(["alpha beta gamma delta in Boston epsilon zeta eta theta"] * 2 + ["alpha beta gamma delta in Boston Town epsilon zeta eta theta"]))


def test_copies_in_any_case_and_items_of_few_literals(spark, make_docs):
    items = [ITEMS[0], (6, "Compute 12, 15, 18, 21, 24"), (7, "What is 12 + 7 * 3 - 4 + 9?"), (7, "Which of these is it, 5 or 6 or 7?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, items[0][1].lower()), (2, "Prose. " + items[0][1].upper()), (3, "so compute 12, 15, 18, 21, 24 now"), (4, "Compute 1, 5, 8, 2, 4"),
            (5, "What is 1 + 2 * 3 - 4 + 5?"), (6, "And WHAT IS 12 + 7 * 3 - 4 + 9? And which of these is it, 5 or 6 or 7?"), (7, items[0][1])]
    out = [{r["doc_id"]: r["leaks"] for r in templates.with_leaks(make_docs(rows), bench, index_windows=n).collect()} for n in (10 ** 6, 0)]
    assert out[0] == out[1]
    assert {i: [x["item_id"] for x in leaks] for i, leaks in out[0].items()} == {1: [1], 2: [1], 3: [6], 4: [], 5: [], 6: [7, 7], 7: [1]}


def test_both_ways_agree_with_plain_search(spark, sf_dir, table_dir):
    got = {(r["doc_id"], r["item_id"]) for r in op5_decontamination(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    other = templates.with_leaks(docs, bench, index_windows=0).select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id")
    assert {tuple(r) for r in other.collect()} == got
    # Items that stand in a document word for word are all found.
    words = lambda t: " " + " ".join(WORD.findall((t or "").lower())) + " "
    plain = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in bench.collect() if words(b["text"]) in words(d["text"])}
    assert plain and plain <= got
