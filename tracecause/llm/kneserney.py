"""An interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Words are runs without ASCII white space, A-Z in lower case; a text is its words and one end mark, which is also the
context of the first word. Three jobs make the model: counts of words; counts of word pairs; and, from these, how many
followers and predecessors each word has. Each task sends one sorted block per shard, so a word or pair of any frequency
is one entry per task before it is shuffled. Word ids are ranks among the sorted hashes of the words.

    p(w|u) = max(c(uw) - D(c), 0) / c(u) + g(u) p(w),   p(w) = max(n(w) - E(n), 0) / n + h / (V + 1)

where n(w) is the number of words before w, D and E are three discounts each, and g(u) and h spread what they take away.
Unknown words share the last term; after an unknown word p(w) stands alone.

Words are known by 64-bit hashes: two of a billion words agree with a probability of about 3 %. Pairs are exact.

Edge cases: null texts count as empty and consist of the end mark. Rows with null ids or repeated rows count each time.
Without training rows every token scores as unknown with probability 1.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage, fresh_path, map_batches
from tracecause.llm.hashstore import Arrays, folded, pack_sorted, save, shard_of, unpack_sorted

END = b"\n"  # no word holds white space
#: Distinct words counted, pairs gathered and tokens scored at a time in one task.
WORDS, PAIRS, TOKENS = 400_000, 4_000_000, 1_000_000
MEMO = 600_000
BLOCKS = "shard int, keys binary, a binary, b binary, c binary, d binary"
BLOCK_SCHEMA = pa.schema([("shard", pa.int32()), *((n, pa.binary()) for n in ("keys", "a", "b", "c", "d"))])
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
HALF = np.uint64(32)


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A pair of 32-bit ids as a 64-bit key without order; one to one."""
    key = (first.astype(np.uint64) << HALF | second.astype(np.uint64)) * MULTIPLY
    return (key ^ key >> HALF) * MULTIPLY


def unmixed(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = key * UNDO
    key = (key ^ key >> HALF) * UNDO
    return (key >> HALF).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def blocks(shards: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """One row per shard of keys in ascending order (of the shard, then the key)."""
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(shards)) + 1, [len(keys)])) if len(keys) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    columns = {"shard": [int(shards[i]) for i, _ in spans], "keys": [pack_sorted(keys[i:j]) for i, j in spans]}
    for name, v in zip("abcd", (*values, *[None] * (4 - len(values))), strict=True):
        columns[name] = [None if v is None else v[i:j].astype("<u4").tobytes() for i, j in spans]
    return pa.RecordBatch.from_pydict(columns, BLOCK_SCHEMA)


def gathered(table: pa.Table, n: int):
    """All keys of a shard's blocks with the sums of their ``n`` values."""
    keys = np.concatenate([unpack_sorted(k) for k in table.column("keys").to_pylist()])
    values = [np.frombuffer(b"".join(table.column(c).to_pylist()), "<u4").astype(np.int64) for c in "abcd"[:n]]
    return folded(keys, *values)


class Words:
    """Ids of words by binary search in the sorted hashes; -1 for unknown ones."""

    def __init__(self, arrays: Arrays, sizes: list[int]):
        self.arrays, self.sizes = arrays, sizes
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.memo: dict[bytes, int] = {}

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        order = np.argsort(hashes)
        hashes = hashes[order]
        found = np.full(len(hashes), -1, dtype=np.int64)
        for s, lo, hi in spans(shard_of(hashes, len(self.sizes))):
            keys = self.arrays.get(f"words-{s}", np.uint64, self.sizes[s])
            at = np.searchsorted(keys, hashes[lo:hi])
            hit = at < len(keys)
            hit[hit] = keys[at[hit]] == hashes[lo:hi][hit]
            found[lo:hi][hit] = at[hit] + self.starts[s]
        out = np.empty_like(found)
        out[order] = found
        return out

    def ids(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        new = list({w for w in words if w not in memo})
        if new:
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = list(set(words))
            memo.update(zip(new, self.look_up(np.array([word_hash(w) for w in new], dtype=np.uint64)).tolist(), strict=True))
        return np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))


def spans(shards: np.ndarray):
    """(shard, start, stop) of the runs of equal values."""
    if len(shards):
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield int(shards[i]), i, j


def sequences(texts, limit: int):
    """Texts in portions of up to ``limit`` tokens (one longer text alone): words with an end mark after each, and lengths."""
    words, lengths = [], []
    for text in texts:
        own = tokens(text or "")
        if words and len(words) + len(own) + 1 > limit:
            yield words, lengths
            words, lengths = [], []
        words += own
        words.append(END)
        lengths.append(len(own) + 1)
    if lengths:
        yield words, lengths


class Model:
    """Where the arrays lie, how large each shard is, and the sums the formula needs. Small: it goes to every task."""

    def __init__(self, folder: str):
        self.folder = folder
        self.word_sizes: list[int] = []
        self.pair_sizes: list[int] = []
        self.tokens = self.types = 0
        self.pair_discounts = self.word_discounts = (0.0, 0.0, 0.0)
        self.spread = 0.0

    @property
    def vocabulary(self) -> int:
        return sum(self.word_sizes)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts for counts of one, two and more from how many entries have counts 1 to 4; 0.5 where undefined."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[0] and n[k] else 0.5 for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) if d > 0 else 0.5 for k, d in enumerate(found))


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """The model of all rows of ``text``. Only sizes and sums per shard reach the driver."""
    spark = docs.sparkSession
    folder = folder or model_folder(spark)
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    texts = docs.select("text")
    # A shard gathers about as much as one task reads.
    shards = max(8, texts.rdd.getNumPartitions())
    model = Model(folder)

    def count_words(batches):
        seen: Counter = Counter()

        def flush():
            hashes = np.array([word_hash(w) for w in seen], dtype=np.uint64)
            keys, n = folded(hashes, np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()
            return blocks(shard_of(keys, shards), keys, n & 0xFFFFFFFF, n >> 32)

        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(tokens(text or ""))
                seen[END] += 1
                if len(seen) > WORDS:
                    yield flush()
        yield flush()

    def keep_words(key, table):
        shard = key[0].as_py()
        hashes, low, high = gathered(table, 2)
        n = low + (high << 32)
        save(folder, f"words-{shard}", hashes)
        save(folder, f"counts-{shard}", n)
        return pa.table({"shard": [shard], "size": [len(hashes)], "total": [int(n.sum())]},
                        schema=pa.schema([("shard", pa.int32()), ("size", pa.int64()), ("total", pa.int64())]))

    rows = (texts.mapInArrow(count_words, BLOCKS).groupBy("shard")
            .applyInArrow(keep_words, "shard int, size long, total long")).collect()
    model.word_sizes = [0] * shards
    for r in rows:
        model.word_sizes[r["shard"]] = r["size"]
        model.tokens += r["total"]
    if model.vocabulary >= 1 << 32:
        raise ValueError("pairs hold word ids of 32 bits")
    if not model.tokens:
        return model
    count_pairs(texts, model, shards)
    count_neighbours(spark, model, shards)
    return model


PAIR_STATS = ("shard int, size long, n1 long, n2 long, n3 long, n4 long, side int, part int, keys binary, a binary, b binary, "
              "c binary, d binary")
PAIR_STATS_SCHEMA = pa.schema([("shard", pa.int32()), *((n, pa.int64()) for n in ("size", "n1", "n2", "n3", "n4")),
                               ("side", pa.int32()), ("part", pa.int32()),
                               *((n, pa.binary()) for n in ("keys", "a", "b", "c", "d"))])


def count_pairs(texts: DataFrame, model: Model, shards: int) -> None:
    folder, sizes, starts = model.folder, model.word_sizes, np.concatenate(([0], np.cumsum(model.word_sizes)))

    def pairs(batches):
        words = Words(Arrays(folder), sizes)
        end = words.ids([END])[0]
        held, n = [], 0

        def flush():
            keys, counts = folded(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            return blocks(shard_of(keys, shards), keys, counts)

        for b in batches:
            for portion, _ in sequences(chain.from_iterable(b.slice(i, 500).column(0).to_pylist() for i in range(0, b.num_rows, 500)), TOKENS):
                ids = words.ids(portion)
                keys = mixed(np.concatenate(([end], ids[:-1])), ids)  # the end mark before also opens a text
                keys, counts = folded(keys, np.ones(len(keys), np.int64))
                held.append((keys, counts))
                n += len(keys)
                if n >= PAIRS:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    def keep_pairs(key, table):
        shard = key[0].as_py()
        keys, n = gathered(table, 1)
        save(folder, f"pairs-{shard}", keys)
        save(folder, f"times-{shard}", n.astype(np.uint32))
        first, second = unmixed(keys)
        one = np.ones(len(keys), np.int64)
        out = {"shard": [shard], "size": [len(keys)], **{f"n{k}": [int((n == k).sum())] for k in (1, 2, 3, 4)},
               **{c: [None] for c in ("side", "part", "keys", "a", "b", "c", "d")}}
        followers = folded(first, n, (n == 1) * one, (n == 2) * one, (n > 2) * one)
        for side, (ids, *values) in enumerate((followers, folded(second, one))):
            part = np.searchsorted(starts, ids, side="right") - 1
            cut = blocks(part, ids.astype(np.uint64), *values).to_pydict()
            rows = len(cut["shard"])
            for c in ("keys", "a", "b", "c", "d"):
                out[c] += cut[c]
            out["side"] += [side] * rows
            out["part"] += cut["shard"]
            for c in ("shard", "size", "n1", "n2", "n3", "n4"):
                out[c] += [None] * rows
        return pa.table(out, schema=PAIR_STATS_SCHEMA)

    counted = cut_lineage(texts.mapInArrow(pairs, BLOCKS).groupBy("shard").applyInArrow(keep_pairs, PAIR_STATS))
    model.pair_sizes, n = [0] * shards, [0] * 4
    for r in counted.where("shard IS NOT NULL").select("shard", "size", "n1", "n2", "n3", "n4").collect():
        model.pair_sizes[r["shard"]] = r["size"]
        n = [x + r[f"n{k + 1}"] for k, x in enumerate(n)]
    model.types, model.pair_discounts, model.stats = sum(model.pair_sizes), discounts(n), counted


def count_neighbours(spark, model: Model, shards: int) -> None:
    folder, sizes, starts = model.folder, model.word_sizes, np.concatenate(([0], np.cumsum(model.word_sizes)))

    def keep(key, table):
        part = key[0].as_py()
        dense = np.zeros((5, sizes[part]), dtype=np.int64)
        for side, n in ((0, 4), (1, 1)):
            own = table.filter(pa.compute.equal(table.column("side"), side))
            if own.num_rows:
                ids, *values = gathered(own, n)
                at = ids.astype(np.int64) - starts[part]
                for k, v in enumerate(values):
                    dense[4 * side + k, at] = v
        save(folder, f"after-{part}", dense[0])
        save(folder, f"kinds-{part}", dense[1:4].T.astype(np.uint32))
        save(folder, f"before-{part}", dense[4].astype(np.uint32))
        m = [int((dense[4] == k).sum()) for k in (1, 2, 3, 4)]
        return pa.table({"m1": [m[0]], "m2": [m[1]], "m3": [m[2]], "m4": [m[3]], "more": [int((dense[4] > 2).sum())]})

    stats = model.__dict__.pop("stats").where("part IS NOT NULL").select("part", "side", "keys", "a", "b", "c", "d")
    found = stats.groupBy("part").applyInArrow(keep, "m1 long, m2 long, m3 long, m4 long, more long").agg(
        *[F.sum(c).alias(c) for c in ("m1", "m2", "m3", "m4", "more")]).first()
    model.word_discounts = d = discounts([found[f"m{k}"] for k in (1, 2, 3, 4)])
    model.spread = (d[0] * found["m1"] + d[1] * found["m2"] + d[2] * found["more"]) / model.types


class Scorer:
    def __init__(self, model: Model):
        self.model, self.arrays = model, Arrays(model.folder)
        self.words = Words(self.arrays, model.word_sizes)
        self.fitted = model.tokens > 0

    def of_ids(self, kind: str, ids: np.ndarray, dtype, width: int = 1) -> np.ndarray:
        """Entries of a dense array for known ids in ascending order."""
        out = np.zeros((len(ids), width) if width > 1 else len(ids), dtype=dtype)
        part = np.searchsorted(self.words.starts, ids, side="right") - 1
        for s, lo, hi in spans(part):
            flat = self.arrays.get(f"{kind}-{s}", dtype, self.model.word_sizes[s] * width)
            own = flat.reshape(-1, width) if width > 1 else flat
            out[lo:hi] = own[ids[lo:hi] - self.words.starts[s]]
        return out

    def times(self, keys: np.ndarray) -> np.ndarray:
        """How often each pair (ascending keys) was seen."""
        out = np.zeros(len(keys), dtype=np.int64)
        for s, lo, hi in spans(shard_of(keys, len(self.model.pair_sizes))):
            own = self.arrays.get(f"pairs-{s}", np.uint64, self.model.pair_sizes[s])
            at = np.searchsorted(own, keys[lo:hi])
            hit = at < len(own)
            hit[hit] = own[at[hit]] == keys[lo:hi][hit]
            n = self.arrays.get(f"times-{s}", np.uint32, self.model.pair_sizes[s])
            out[lo:hi][hit] = n[at[hit]]
        return out

    def score(self, words: list[bytes], lengths: list[int]):
        """Per text: known tokens, base score, score."""
        m = self.model
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        if not self.fitted:
            return np.zeros(len(lengths), np.int64), np.zeros(len(lengths)), np.zeros(len(lengths))
        ids = self.words.ids(words)
        end = self.words.ids([END])[0]
        before = np.concatenate(([end], ids[:-1]))
        vocabulary = m.vocabulary
        distinct, where = np.unique(ids, return_inverse=True)
        known = distinct[distinct >= 0]
        gap = len(distinct) - len(known)  # 1 if unknown words are among them, which come first

        def spread_out(values, unknown):
            return np.concatenate((np.full(gap, unknown), values))

        count = spread_out(self.of_ids("counts", known, np.int64), 0)
        preceded = self.of_ids("before", known, np.uint32).astype(np.float64)
        e = np.array((0.0, *m.word_discounts))[np.minimum(preceded, 3).astype(np.int64)]
        p_word = spread_out((preceded - e) / m.types, 0.0) + m.spread / (vocabulary + 1)
        after = spread_out(self.of_ids("after", known, np.int64), 0).astype(np.float64)
        kinds = self.of_ids("kinds", known, np.uint32, 3) @ np.array(m.pair_discounts)
        left_over = spread_out(kinds, 0.0)
        base = np.log10((count + 1) / (m.tokens + vocabulary + 1))
        # Contexts are the tokens before; the end mark stands first.
        context = np.concatenate(([np.searchsorted(distinct, end)], where[:-1]))
        both = np.flatnonzero((before >= 0) & (ids >= 0))
        keys = mixed(before[both], ids[both])
        order = np.argsort(keys)
        c = np.zeros(len(ids))
        c[both[order]] = self.times(keys[order])
        total = after[context]
        seen = total > 0
        d = np.array((0.0, *m.pair_discounts))[np.minimum(c, 3).astype(np.int64)]
        safe = np.where(seen, total, 1.0)
        p = np.where(seen, (c - d) / safe + left_over[context] / safe * p_word[where], p_word[where])
        return (np.add.reduceat((count[where] > 0).astype(np.int64), starts), np.add.reduceat(base[where], starts),
                np.add.reduceat(np.log10(p), starts))


def score(docs: DataFrame, model: Model, keep: str = "doc_id") -> DataFrame:
    """(keep, n_tokens, n_known, train_tokens, base_score, score) of every whole ``text``, both scores in log10."""
    kind = docs.schema[keep].dataType.simpleString()

    def batch(b):
        if "scorer" not in held:
            held["scorer"] = Scorer(model)
        scorer = held["scorer"]
        at = 0
        for words, lengths in sequences((t for i in range(0, b.num_rows, 500) for t in b.slice(i, 500).column(1).to_pylist()), TOKENS):
            known, base, own = scorer.score(words, lengths)
            yield {keep: b.column(0).slice(at, len(lengths)), "n_tokens": lengths, "n_known": known,
                   "train_tokens": [model.tokens] * len(lengths), "base_score": base, "score": own}
            at += len(lengths)

    held: dict = {}
    return map_batches(docs.select(keep, "text"), batch,
                       f"`{keep}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(log10_probability: float, n_tokens: int) -> float:
    return math.pow(10.0, -log10_probability / n_tokens)


def model_folder(spark) -> str:
    path = fresh_path(spark, "kneserney")
    return path if ":" in path.split("/")[0] else f"file://{path}"
