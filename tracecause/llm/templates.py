"""Benchmark decontamination by templates: finds questions even with other numbers, names and units in them.

Numbers, units after a number and capitalised words within a sentence become typed slots; other words are literals in
lower case. Windows of five such tokens are hashed. A document holds an item if at least 0.8 of the item's windows stand
in one place of it with consistent slots. A place is a document position less item position, up to ``DRIFT`` tokens more
or less (names may have more words); copies elsewhere in the document have no say in it. In a place one value in the item
stands for one value in the document (of several the most frequent; windows that disagree do not count). Of several
places that hold the item the one with most windows is reported, of equals the first. Windows with fewer than two literals say nothing and are left out on both sides;
an item shorter than five tokens is one window.

Every item has a second, literal entry: the same windows over its lower-cased words and numbers, all of them, so that a
copy is found in any letter case and however few literals it has. An item with fewer than ``FEW`` template windows has
only this one, and is held where its values are the same.

Up to ``INDEX_WINDOWS`` benchmark windows (counted first) the index is sent to the documents, and nothing is shuffled.
Beyond that the windows meet in a hash join, after a bitmap of fixed size has dropped most of the others.

Edge cases: null and empty texts on either side match nothing; null ids are kept in the result; repeated items are
reported once for each distinct id. A document row gives the same result however often it is repeated.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage

WINDOW, COVERAGE, LITERALS, DRIFT, FEW = 5, 0.8, 2, 8, 2
INDEX_WINDOWS = 1_000_000
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:;\n]")
#: Words that are units when they follow a number.
UNITS = frozenset("""mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer
kilometers kilometre kilometres mg g kg t oz lb lbs gram grams kilogram kilograms ton tons ounce ounces pound pounds ml l
liter liters litre litres gallon gallons cup cups s sec min h hr second seconds minute minutes hour hours day days week weeks
month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh kph w kw v""".split())
NUMBER, CAPITAL, STOP, UNIT = 1, 2, 4, 8
BITS = 20


def wide(value: int) -> np.uint64:
    return np.uint64(value & (1 << 64) - 1)


SLOTS = {kind: wide(xxhash.xxh64_intdigest(f"<{kind}>") & ~15) for kind in ("number", "unit", "name")}


class Codes(dict):
    """Token to 60 bits of hash and four flags; forgets when full."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        first, low = token[0], token.lower()
        flags = (NUMBER if first.isdigit() else STOP if not first.isalpha() else CAPITAL * first.isupper()) | UNIT * (low in UNITS)
        code = self[token] = xxhash.xxh64_intdigest(low) & ~15 | flags
        return code


def canonical(text: str, codes: Codes):
    """Hashes of the canonical tokens, which of them are slots, hashes of the tokens in lower case, their positions among all."""
    tokens = TOKEN.findall(text)
    raw = np.array([codes[t] for t in tokens], dtype=np.uint64)
    flags = (raw & np.uint64(15)).astype(np.int64)
    stop = flags & STOP != 0
    at = np.flatnonzero(~stop)
    opens = np.concatenate(([True], stop[:-1]))[at] if len(at) else np.zeros(0, bool)
    flags = flags[at]
    number = flags & NUMBER != 0
    unit = (flags & UNIT != 0) & ~opens & np.concatenate(([False], number[:-1])) if len(at) else number
    name = (flags & CAPITAL != 0) & ~opens
    plain = raw[at] & wide(~15)
    canon = np.where(number, SLOTS["number"], np.where(unit, SLOTS["unit"], np.where(name, SLOTS["name"], plain)))
    return canon, number | unit | name, plain, at, tokens


def windows(canon: np.ndarray, slot: np.ndarray, size: int, seed: int = 0):
    """Hash of every window, and which windows have enough literals."""
    n = len(canon) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    rolled = np.full(n, wide(size + seed), dtype=np.uint64)
    literals = np.zeros(n, dtype=np.int64)
    for k in range(size):
        rolled = (rolled ^ canon[k:k + n]) * wide(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(31)
        literals += ~slot[k:k + n]
    return rolled, literals >= min(LITERALS, size)


def literal_windows(plain: np.ndarray, size: int):
    """As ``windows``, of lower-cased tokens; all of them count, and none has the hash of a template window."""
    rolled, _ = windows(plain, np.zeros(len(plain), dtype=bool), size, seed=1 << 32)
    return rolled, np.ones(len(rolled), dtype=bool)


def item_windows(text: str, codes: Codes):
    """(hash, position) of an item's windows, with both readings of a capital at its start; their number; slots; size."""
    canon, slot, _, at, tokens = canonical(text, codes)
    size = min(WINDOW, len(canon))
    if not size:
        return [], 0, [], size
    rolled, good = windows(canon, slot, size)
    found = {(int(h), p) for p, h in enumerate(rolled) if good[p]}
    if tokens[at[0]][0].isupper():
        canon, slot = canon.copy(), slot.copy()
        canon[0], slot[0] = SLOTS["name"], True
        other, fine = windows(canon[:size], slot[:size], size)
        found |= {(int(other[0]), 0)} if fine[0] else set()
    values = [tokens[a].lower() if s else None for a, s in zip(at, slot, strict=True)]
    return sorted(found), len({p for _, p in found}), values, size


def entries(text: str, codes: Codes):
    """What the index has of an item: (windows, their number, slot values, size, literal), template entry first."""
    found, n, values, size = item_windows(text, codes)
    if not size:
        return []
    rolled, _ = literal_windows(canonical(text, codes)[2], size)
    literal = [(int(h), p) for p, h in enumerate(rolled)], len(rolled), [None] * len(values), size, True
    return [(found, n, values, size, False), literal] if n >= FEW else [literal]


def consistent(pairs: list[tuple[int, int]], item_values: list, doc_values: list, size: int) -> list[tuple[int, int]]:
    """The (document position, item position) pairs whose slots all agree with the most frequent value for each."""
    votes: dict[str, dict[str, int]] = {}
    for d, i in pairs:
        for k in range(size):
            if item_values[i + k] is not None:
                seen = votes.setdefault(item_values[i + k], {})
                seen[doc_values[d + k]] = seen.get(doc_values[d + k], 0) + 1
    if not votes:
        return pairs
    stands = {v: min(seen, key=lambda x: (-seen[x], x)) for v, seen in votes.items()}
    return [(d, i) for d, i in pairs if all(item_values[i + k] is None or doc_values[d + k] == stands[item_values[i + k]]
                                            for k in range(size))]


class Index:
    """Sorted window hashes of the items; finds the items that a text holds."""

    def __init__(self, items: list[tuple]):
        """items: (id, [(hash, position)], number of windows, slot values, window size[, literal[, key of the item's text]])"""
        self.items = [(*item, *(False, n)[len(item) - 5:]) for n, item in enumerate(items)]
        entries = sorted((h, n, p) for n, item in enumerate(items) for h, p in item[1])
        self.hashes = np.array([h for h, _, _ in entries], dtype=np.uint64)
        self.owner = np.array([n for _, n, _ in entries], dtype=np.int64)
        self.place = np.array([p for _, _, p in entries], dtype=np.int64)
        self.sizes = sorted({(item[5], item[4]) for item in self.items})
        self.needed = np.array([item[2] for item in items], dtype=np.int64)
        self.likely = bitmap(self.hashes)
        self.codes = Codes()

    def find(self, text: str) -> list[dict]:
        if not text or not len(self.hashes):
            return []
        read = None
        found = {}
        canon, slot, plain, at, tokens = canonical(text, self.codes)
        for literal, size in self.sizes:
            rolled, good = literal_windows(plain, size) if literal else windows(canon, slot, size)
            maybe = np.flatnonzero(self.likely[(rolled >> np.uint64(64 - BITS)).astype(np.int64)] & good)
            low = np.searchsorted(self.hashes, rolled[maybe])
            count = np.searchsorted(self.hashes, rolled[maybe], side="right") - low
            total = int(count.sum())
            if not total:
                continue
            entry = np.repeat(low, count) + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            where = np.repeat(maybe, count)
            owner, place = self.owner[entry], self.place[entry]
            distinct = np.unique(owner << 32 | place) >> 32
            owners, n = np.unique(distinct, return_counts=True)
            for o in owners[n >= COVERAGE * self.needed[owners]].tolist():
                key, _, needed, values, own_size, own_kind, item = self.items[o]
                if (own_kind, own_size) != (literal, size) or (key, item) in found:
                    continue
                read = read or [tokens[a].lower() for a in at]
                mine = owner == o
                leak = judged(list(zip(where[mine].tolist(), place[mine].tolist(), strict=True)), key, needed, values, read, size)
                if leak:
                    found[key, item] = leak
        return sorted(found.values(), key=lambda x: [(v is not None, v or 0) for v in x.values()])


def places(pairs: list[tuple[int, int]], needed: int):
    """The pairs of every place that could hold the item: first those of one alignment, then with drift around it.

    With drift an item position has one document position, the one nearest to the alignment.
    """
    by_shift: dict[int, list[tuple[int, int]]] = {}
    for d, i in pairs:
        by_shift.setdefault(d - i, []).append((d, i))
    shifts = np.array(sorted(by_shift), dtype=np.int64)
    count = np.concatenate(([0], np.cumsum([len(by_shift[s]) for s in shifts.tolist()])))
    low, high = np.searchsorted(shifts, shifts - DRIFT), np.searchsorted(shifts, shifts + DRIFT, side="right")
    for n in np.flatnonzero(count[high] - count[low] >= COVERAGE * needed).tolist():
        one = by_shift[int(shifts[n])]
        if len(one) >= COVERAGE * needed:
            yield one
        nearest: dict[int, int] = {}
        for s in sorted(shifts[low[n]:high[n]].tolist(), key=lambda s: (abs(s - int(shifts[n])), s)):
            for d, i in by_shift[s]:
                nearest.setdefault(i, d)
        if len(nearest) > len(one) and len(nearest) >= COVERAGE * needed:
            yield [(d, i) for i, d in nearest.items()]


def judged(pairs, key, needed, item_values, doc_values, size) -> dict | None:
    """The best place of the item in the document, if any holds it."""
    best = None
    for place in places(sorted(set(pairs)), needed):
        held = consistent(place, item_values, doc_values, size)
        if not held or len(held) < COVERAGE * needed:
            continue
        first, last = min(d for d, _ in held), max(d for d, _ in held) + size - 1
        if best is None or (-len(held), first, last) < best:
            best = -len(held), first, last
    return best and {"item_id": key, "windows": needed, "matched": -best[0], "first_word": best[1], "last_word": best[2]}


def bitmap(hashes: np.ndarray) -> np.ndarray:
    likely = np.zeros(1 << BITS, dtype=bool)
    likely[(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return likely


LEAK = "struct<item_id:long,windows:long,matched:long,first_word:long,last_word:long>"
LEAK_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "windows", "matched", "first_word", "last_word")]))
ITEMS = ("item_id long, item long, literal boolean, hash array<long>, place array<int>, windows long, slots array<string>, "
         "size int")
ITEM_SCHEMA = pa.schema([("item_id", pa.int64()), ("item", pa.int64()), ("literal", pa.bool_()), ("hash", pa.list_(pa.int64())),
                         ("place", pa.list_(pa.int32())), ("windows", pa.int64()), ("slots", pa.list_(pa.string())), ("size", pa.int32())])


def item_table(benchmark: DataFrame) -> DataFrame:
    """Windows of every distinct item, a row for its template entry, if it has one, and a row for its literal one."""
    def run(batches):
        codes = Codes()
        for b in batches:
            out = {n: [] for n in ITEM_SCHEMA.names}
            for row in b.to_pylist():
                for found, n, values, size, literal in entries(row["text"], codes):
                    hashes = [(h ^ 1 << 63) - (1 << 63) for h, _ in found]
                    for c, v in zip(out.values(), (row["item_id"], row["item"], literal, hashes, [p for _, p in found], n,
                                                   values, size), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_pydict(out, ITEM_SCHEMA)

    rows = benchmark.where("text IS NOT NULL").select("item_id", "text").distinct()
    return rows.withColumn("item", F.xxhash64("text")).mapInArrow(run, ITEMS)


def with_leaks(docs: DataFrame, benchmark: DataFrame, name: str = "leaks", index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """``docs`` with a column ``name``: the items found in ``text`` as an array, empty for a clean document."""
    items = cut_lineage(item_table(benchmark))
    n = items.agg(F.coalesce(F.sum(F.size("hash")), F.lit(0))).first()[0]
    return sent(docs, items, name) if n <= index_windows else joined(docs, items, name)


def add_column(docs: DataFrame, name: str, make, kind: str, arrow_type) -> DataFrame:
    """A column computed from ``text`` beside all others (one of the same name is replaced)."""
    rest = [c for c in docs.columns if c != name]
    source = docs.select(*[f"`{c}`" for c in rest])
    at = rest.index("text")
    schema = source.limit(0).withColumn(name, F.lit(None).cast(kind)).schema

    def run(batches):
        one = make()
        for b in batches:
            for start in range(0, b.num_rows, 1000):
                part = b.slice(start, 1000)
                made = pa.array([one(t) for t in part.column(at).to_pylist()], arrow_type)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*rest, name])

    return source.mapInArrow(run, schema)


def sent(docs: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """The bounded index goes to every task."""
    rows = [(r["item_id"], [(h & (1 << 64) - 1, p) for h, p in zip(r["hash"], r["place"], strict=True)], r["windows"],
             r["slots"], r["size"], r["literal"], r["item"]) for r in items.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    return add_column(docs, name, lambda: Index(shared.value).find, f"array<{LEAK}>", LEAK_TYPE)


def joined(docs: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Windows of both sides meet in a join on their hash; only windows in the bitmap of the items are shuffled."""
    about = ["item_id", "item", "literal", "windows", "slots", "size"]
    flat = items.select(*about, F.posexplode("hash").alias("k", "hash"), "place").select(
        *about, "hash", F.element_at("place", F.col("k") + 1).alias("place"))
    word = flat.select(F.shiftrightunsigned("hash", 64 - BITS).alias("word"))
    marks = word.groupBy(F.expr("cast(word div 32 AS int)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(word % 32 AS int)))").alias("bits"))
    likely = np.zeros(1 << BITS, dtype=bool)
    for r in marks.collect():  # at most 2 ** BITS / 32 rows
        for k in range(32):
            likely[r["at"] * 32 + k] = r["bits"] >> k & 1
    sizes = [(r["literal"], r["size"]) for r in items.select("literal", "size").distinct().collect()]
    shared = docs.sparkSession.sparkContext.broadcast((likely, sizes))
    schema = pa.schema([("text_key", pa.int64()), ("hash", pa.int64()), ("literal", pa.bool_()),
                        ("size", pa.int32()), ("at", pa.int64()), ("read", pa.list_(pa.string()))])

    def run(batches):
        likely, sizes = shared.value
        codes = Codes()
        for b in batches:
            out = {n: [] for n in schema.names}
            for i in range(b.num_rows):
                key, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                canon, slot, plain, at, tokens = canonical(text, codes)
                for literal, size in sizes:
                    rolled, good = literal_windows(plain, size) if literal else windows(canon, slot, size)
                    for p in np.flatnonzero(likely[(rolled >> np.uint64(64 - BITS)).astype(np.int64)] & good).tolist():
                        for c, v in zip(out.values(), (key, int(rolled[p].astype(np.int64)), literal, size, p,
                                                       [tokens[a].lower() for a in at[p:p + size]]), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_pydict(out, schema)

    key = F.xxhash64("text")
    texts = docs.where("text IS NOT NULL").select(key.alias("text_key"), "text")
    seen = texts.mapInArrow(run, "text_key long, hash long, literal boolean, size int, at long, read array<string>").distinct()
    pairs = seen.join(flat, ["hash", "literal", "size"])
    met = pairs.groupBy("text_key", *about).agg(
        F.collect_set(F.struct("at", "place", "read")).alias("pairs"))
    verdict = pa.schema([("text_key", pa.int64()), ("item_id", pa.int64()), ("item", pa.int64()), ("literal", pa.bool_()),
                         ("leak", LEAK_TYPE.value_type)])

    def judge(batches):
        for b in batches:
            out = {n: [] for n in verdict.names}
            for r in b.to_pylist():
                read = {}
                for p in r["pairs"]:
                    read.update({p["at"] + k: w for k, w in enumerate(p["read"])})
                leak = judged([(p["at"], p["place"]) for p in r["pairs"]], r["item_id"], r["windows"], r["slots"], read, r["size"])
                if leak:
                    for c, v in zip(out.values(), (r["text_key"], r["item_id"], r["item"], r["literal"], leak), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_pydict(out, verdict)

    found = met.mapInArrow(judge, f"text_key long, item_id long, item long, literal boolean, leak {LEAK}")
    leaks = found.groupBy("text_key", "item_id", "item").agg(F.min_by("leak", "literal").alias("leak")).groupBy("text_key").agg(
        F.sort_array(F.collect_list("leak")).alias(name))
    rest = docs.drop(name)
    return (rest.withColumn("__key", F.xxhash64("text")).join(leaks.withColumnRenamed("text_key", "__key"), "__key", "left")
            .drop("__key").withColumn(name, F.coalesce(F.col(name), F.array().cast(f"array<{LEAK}>"))))


def clean(docs: DataFrame, benchmark: DataFrame, index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """The documents that hold no benchmark item, all their columns as they are."""
    return with_leaks(docs, benchmark, "__leaks", index_windows).where(F.size("__leaks") == 0).drop("__leaks")
