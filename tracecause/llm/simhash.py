"""SimHash near-duplicates: fingerprints within a few bits of one another link, and links form groups.

Fingerprints are made distinct first, so a group of copies of any size counts as one. Two fingerprints that differ in
at most three bits agree on two of five blocks of bits, so every distinct fingerprint enters ten shards, one per pair of
blocks with its values there. A shard is searched with a BK-tree. Shards of up to ``SHARD`` fingerprints are whole
trees, many to a task; a larger one is cut into trees of that size, and each tree is sent to the tasks that hold
a slice of the shard's fingerprints as queries, every slice against every tree. No shard is skipped. Each shard gives a
spanning set of its links (not all pairs), and connected components join those of all shards.

Edge cases: null texts count as empty. A text without words has fingerprint zero, one with fewer words than a shingle
is one shingle. Rows with a null id take part in links, but a group's id is its smallest id that is not null (null if
it has none). Repeated rows give repeated results.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.bktree import Forest
from tracecause.llm.common import cut_lineage, map_rows
from tracecause.llm.components import stars

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Bits per block; every pair of blocks is a table of shards.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints in one tree.
SHARD = 4096


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if it is in more than half of the hashes of the shingles, as a signed integer."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    if len(words) < shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), seed)).astype(np.int64))
    joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in joined], dtype=np.uint64)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.uint64).astype(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``fp`` (signed 64 bits) of every whole ``text``, beside the columns ``keep``."""
    return map_rows(docs, lambda: lambda text: (fingerprint(text, shingle),), keep, "fp long")


def block_keys(fp: np.ndarray) -> list[np.ndarray]:
    """One key per pair of blocks: the number of the pair and the bits of both blocks."""
    bits = fp.astype(np.int64).view(np.uint64)
    values, shift = [], 0
    for width in BLOCKS:
        values.append((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1))
        shift += width
    return [(np.uint64(t) << np.uint64(32) | values[i] << np.uint64(13) | values[j]).astype(np.int64)
            for t, (i, j) in enumerate(itertools.combinations(range(len(BLOCKS)), 2))]


def spanning(links: list[tuple[np.ndarray, np.ndarray]], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, root) that keep connected what the given links of indices connect."""
    root = np.arange(len(points))
    if links:
        a, b = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            while not np.array_equal(new, new[new]):
                new = new[new]
            if np.array_equal(new, root):
                break
            root = new
    moved = np.flatnonzero(root != np.arange(len(points)))
    return points[moved], points[root[moved]]


EDGES = "a long, b long"
EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def search_whole(batches):
    """Links of whole shards; rows (key, fp) arrive in order of the key."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def edges(keys, fps):
        forest = Forest(keys, fps)
        links = []
        for q, p in forest.near(keys, fps, RADIUS):
            links.append((q[q < p], p[q < p]))
        a, b = spanning(links, fps)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=EDGE_SCHEMA)

    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy()))
        fps = np.concatenate((fps, batch.column(1).to_numpy()))
        last = np.searchsorted(keys, keys[-1]) if len(keys) else 0  # the last shard may go on in the next batch
        if last:
            yield edges(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
    if len(keys):
        yield edges(keys, fps)


def search_cell(rows: pa.Table) -> pa.Table:
    """Links between one tree of a large shard and one slice of its fingerprints."""
    fp, query = rows.column("fp").to_numpy(), rows.column("query").to_numpy()
    points, queries = np.unique(fp[~query]), np.unique(fp[query])
    forest = Forest(np.zeros(len(points), np.int64), points)
    together = np.concatenate((points, queries))
    links = [(p, q + len(points)) for q, p in forest.near(np.zeros(len(queries), np.int64), queries, RADIUS)]
    links += [(np.searchsorted(points, same), len(points) + np.searchsorted(queries, same))
              for same in [np.intersect1d(points, queries)] if len(same)]
    a, b = spanning(links, together)
    return pa.Table.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], schema=EDGE_SCHEMA)


def links(distinct: DataFrame, shard: int = SHARD) -> DataFrame:
    """Spanning links (a, b) of the distinct fingerprints ``fp``."""
    def keyed(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            yield pa.RecordBatch.from_pydict(
                {"key": np.concatenate(block_keys(fp)), "fp": np.tile(fp, len(BLOCKS) * (len(BLOCKS) - 1) // 2)})

    rows = cut_lineage(distinct.select("fp").mapInArrow(keyed, "key long, fp long"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sizes = cut_lineage(sizes)
    small = rows.join(sizes.where(F.col("n") <= shard).select("key"), "key", "left_semi")
    small = small.repartition("key").sortWithinPartitions("key").mapInArrow(search_whole, EDGES)
    trees = F.ceil(F.col("n") / shard).cast("int")
    large = rows.join(sizes.where(F.col("n") > shard), "key").withColumn("trees", trees)
    large = large.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("trees") - 1))
    held = large.select("key", F.col("part").alias("tree"), every.alias("slice"), "fp", F.lit(False).alias("query"))
    held = held.where("tree <= slice")
    asked = large.select("key", every.alias("tree"), F.col("part").alias("slice"), "fp", F.lit(True).alias("query"))
    asked = asked.where("tree <= slice")
    cells = held.unionByName(asked).groupBy("key", "tree", "slice").applyInArrow(search_cell, EDGES)
    return small.unionByName(cells)


def near_duplicates(prints: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``component_id`` beside the columns of ``prints`` (which has ``fp``): the smallest id reachable over links."""
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min(id_column).alias("least")))
    groups = stars(links(distinct)).withColumnRenamed("node", "fp")
    member = cut_lineage(distinct.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    component = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(component, "root").select("fp", "component_id")
    return prints.join(named, "fp")
