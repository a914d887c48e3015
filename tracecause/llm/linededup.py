"""Removal of repeated lines and sentences, with offsets into the original texts.

A text is cut at line ends, after sentence ends and after words whose hash is the least among the ``REACH`` words on either
side, all within their sentence, so that a passage falls into the same pieces wherever it stands and cuts lie close. A unit is a run of neighbouring pieces, the shortest from a piece on or up to a piece that has
``LEAST_WORDS`` words: short pieces that agree by chance make no repeat. A unit's normal form is its words, each character
in lower case; the digest of that is grouped over all documents. The occurrence first in rank (id, then offset) stays, the
words of the others go.

Texts are handled many at a time as arrays of code points. A word's hash is a polynomial in its characters, a unit's digest
two polynomials in the hashes of its words; both come from prefix sums, so a unit costs the same however long it is.

Edge cases: null texts count as empty, have no units and lose nothing. Rows that agree in id and text count as one
document. Null ids rank first. Units without a word are never removed. A column of the table named ``removed`` is replaced.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage

LEAST_WORDS = 8
#: Most bits of the map of repeated digests that tasks get (32 MB); beyond that it lets more other units through.
MOST_BITS = 28
REACH = 3
CHUNK = 1 << 19   # characters that are handled at a time
HOT = 1000        # a digest that one unit in so many has, of those in the map, meets its rows by a broadcast
BASE = 0x9E3779B97F4A7C15                      # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)


def scrambled(z: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@functools.cache
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: does it belong to words, and a hash of its lower case (its own where that has several characters)."""
    chars = [chr(i) for i in range(0x110000)]
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(chars)), np.uint64, len(chars))
    return np.fromiter((c.isalnum() or c == "_" for c in chars), np.bool_, len(chars)), scrambled(lower + np.uint64(BASE))


@functools.cache
def powers(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(CHUNK - 1, base, np.uint64))))


def runs_of(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each run values[first..last]: a polynomial whose lowest power belongs to its first value, modulo 2^64."""
    if len(values) > CHUNK:  # longer than the tables of powers: built as needed
        up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(values) - 1, BASE, np.uint64))))
        down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(values) - 1, INVERSE, np.uint64))))
    else:
        up, down = powers(BASE), powers(INVERSE)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)])))
    return scrambled((total[last + 1] - total[first]) * down[first] + (last - first + 1).astype(np.uint64))


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words, and (places, are line ends) of line and sentence ends, ``CHUNK`` at a time."""
    member, mixed = alphabet()
    found, at = [], 0
    while at < len(text):
        code = np.frombuffer(text[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        inside = member[code]
        stop = len(code)
        if at + stop < len(text) and inside[-1] and not inside.all():  # a word may go on: end after the last other character
            stop = int(np.flatnonzero(~inside)[-1]) + 1
        elif at + stop < len(text) and inside.all():  # a word longer than a chunk
            tail = at + stop
            while tail < len(text) and member[ord(text[tail])]:
                tail += 1
            code = np.frombuffer(text[at:tail].encode("utf-32-le", "surrogatepass"), "<u4")
            inside, stop = np.ones(len(code), np.bool_), len(code)
        code, inside = code[:stop], inside[:stop]
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        hashed = runs_of(np.where(inside, mixed[code], np.uint64(0)), first, last)
        ends = np.flatnonzero((code == 10) | (code == 33) | (code == 46) | (code == 63))  # line end ! . ?
        found.append((first + at, last + at + 1, hashed, ends + at, code[ends] == 10))
        at += stop
    return tuple(np.concatenate(part) for part in zip(*found)) if found else tuple(np.zeros(0, t) for t in (
        np.int64, np.int64, np.uint64, np.int64, np.bool_))


def unit_table(texts: list[str], least_words: int = LEAST_WORDS) -> dict[str, np.ndarray]:
    """Units of texts in order: ``text`` (its number), ``seq`` in it, ``start``, ``stop``, ``words``, ``hi`` and ``lo`` of the
    digest. A text of fewer words is one unit."""
    joined = "\n".join(texts)
    offset = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    start, end, hashed, ends, is_line = words_of(joined)
    n = len(start)
    if not n:
        return {c: np.zeros(0, np.int64) for c in ("text", "seq", "start", "stop", "words", "hi", "lo")}
    # Where the next line or sentence end stands, and where the run of sentence ends that it opens is over.
    after = np.searchsorted(ends, end)
    place = np.append(ends, len(joined))
    gap = place[after] < np.append(start[1:], len(joined) + 1)
    fresh = np.ones(len(ends), np.bool_)
    if len(ends) > 1:
        fresh[1:] = (np.diff(ends) != 1) | is_line[1:] | is_line[:-1]
    group = np.cumsum(fresh) - 1
    over = np.append(ends[np.searchsorted(group, group, side="right") - 1] + 1 - is_line, len(joined))
    sentence = np.append(0, np.cumsum(gap[:-1]))
    cut = np.zeros(n, np.bool_)
    if n > 2 * REACH:
        middle = hashed[REACH:n - REACH]
        inner = sentence[:n - 2 * REACH] == sentence[2 * REACH:]
        for d in range(1, REACH + 1):  # of equal words the first is the least
            inner &= (middle < hashed[REACH - d:n - REACH - d]) & (middle <= hashed[REACH + d:n - REACH + d])
        cut[REACH:n - REACH] = inner
    breaks = cut | gap
    breaks[-1] = True
    last = np.flatnonzero(breaks)
    first = np.append(0, last[:-1] + 1)
    before = np.searchsorted(ends, start[first]) - 1
    begin = np.where(before >= 0, np.append(ends, -1)[before] + 1, 0)
    glued = first > 0
    glued[1:] &= ~gap[first[1:] - 1]
    begin[glued] = end[first[glued] - 1]
    close = np.where(cut[last], end[last], over[after[last]])
    # Units: for each piece the shortest run from it on, and the shortest up to it.
    pieces = len(first)
    text = np.searchsorted(offset, start[first], side="right") - 1
    total = np.append(first, n)
    a = np.arange(pieces)
    to = np.searchsorted(total, total[:-1] + least_words) - 1
    fits = to < pieces
    fits[fits] = text[to[fits]] == text[fits]
    back = np.searchsorted(total, total[1:] - least_words, side="right") - 1
    ok = back >= 0
    ok[ok] = text[back[ok]] == text[ok]
    runs = [a[fits] * pieces + to[fits], back[ok] * pieces + a[ok]]
    head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    tail = np.append(head[1:], pieces) - 1
    small = total[tail + 1] - total[head] < least_words
    runs.append(head[small] * pieces + tail[small])
    run = np.unique(np.concatenate(runs))
    one, two = run // pieces, run % pieces
    owner = text[one]
    opened = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    seq = np.arange(len(run)) - np.repeat(opened, np.diff(np.append(opened, len(run))))
    hi = runs_of(hashed, first[one], last[two])
    lo = runs_of(scrambled(hashed ^ np.uint64(INVERSE)), first[one], last[two])
    return {"text": owner, "seq": seq, "start": begin[one] - offset[owner], "stop": close[two] - offset[owner],
            "words": last[two] - first[one] + 1, "hi": hi.view(np.int64), "lo": lo.view(np.int64)}


def chunks(column: pa.Array):
    """(first row, texts) of about ``CHUNK`` characters; a longer text comes alone."""
    texts, size, first = [], 0, 0
    for i in range(len(column)):
        t = column[i].as_py()
        if texts and size + len(t) > CHUNK:
            yield first, texts
            texts, size, first = [], 0, i
        texts.append(t)
        size += len(t)
    if texts:
        yield first, texts


UNITS = "doc_id long, text_key long, seq int, start int, stop int, words int, hi long, lo long"
UNIT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("seq", pa.int32()), ("start", pa.int32()),
                         ("stop", pa.int32()), ("words", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def repeated_digests(docs: DataFrame, least_words: int) -> DataFrame:
    """First halves of digests that more than one unit has; only counts of these halves are shuffled."""
    schema = pa.schema([("hi", pa.int64())])

    def run(batches):
        for b in batches:
            for _, texts in chunks(b.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(unit_table(texts, least_words)["hi"])], schema=schema)

    return keyed(docs).mapInArrow(run, "hi long").groupBy("hi").count().where("count > 1").select("hi")


def bitmap(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """Bytes of a map with a bit for the leading bits of every hash, and how many bits of a hash it takes."""
    bits = max(16, min(MOST_BITS, (8 * hashes.count()).bit_length()))
    word = hashes.select(F.shiftrightunsigned("hi", 64 - bits).alias("word"))
    marks = word.groupBy(F.expr("word div 32").cast("int").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(word % 32 AS int)))").alias("bits")).toArrow()  # at most 2 ** MOST_BITS / 32 rows
    likely = np.zeros(1 << bits - 5, dtype="<u4")
    likely[marks["at"].to_numpy()] = marks["bits"].to_numpy().astype("<u4")
    return likely.view(np.uint8), bits


def all_units(docs: DataFrame, likely: tuple[np.ndarray, int], least_words: int = LEAST_WORDS) -> DataFrame:
    """The units whose digests are in the map, numbered among all of their text."""
    shared = docs.sparkSession.sparkContext.broadcast(likely)

    def run(batches):
        marks, bits = shared.value
        for b in batches:
            for first, texts in chunks(b.column("text")):
                found = unit_table(texts, least_words)
                word = found["hi"].view(np.uint64) >> np.uint64(64 - bits)
                stays = np.flatnonzero(marks[(word >> np.uint64(3)).astype(np.int64)] >> (word & np.uint64(7)).astype(np.uint8) & 1)
                rows = pa.array(found["text"][stays] + first)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").take(rows), b.column("text_key").take(rows),
                    *[pa.array(found[c][stays].astype(t.to_pandas_dtype())) for c, t in list(zip(UNIT_SCHEMA.names, UNIT_SCHEMA.types))[2:]]],
                    schema=UNIT_SCHEMA)

    return keyed(docs).mapInArrow(run, UNITS)


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_key, spans, units): what to remove of each document that loses something.

    ``spans`` has (start, stop, origin) in order, ``origin`` the id of the document that keeps the unit that opens the
    span. A map of the digests that repeat drops most other units before anything of them is written or shuffled; the rest
    is grouped by whole digests. Digests fold to one row per task and value before they are grouped; a common unit's rows
    meet their group in a join that can be split.
    """
    found = cut_lineage(all_units(docs, bitmap(cut_lineage(repeated_digests(docs, least_words))), least_words))
    place = F.struct("doc_id", "start", "text_key")
    firsts = (found.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
              .where(F.col("first") != F.col("last")).select("hi", "lo", "first", "n"))
    firsts = cut_lineage(firsts)
    often = F.col("n") > found.count() // HOT
    # Fewer than HOT digests can have more than one unit in HOT, whatever the size of the corpus.
    hot = firsts.where(often).drop("n")
    seldom = found.join(F.broadcast(hot.select("hi", "lo")), ["hi", "lo"], "left_anti").join(firsts.where(~often).drop("n"), ["hi", "lo"])
    again = found.join(F.broadcast(hot), ["hi", "lo"]).unionByName(seldom).where(~place.eqNullSafe(F.col("first")))
    lists = again.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct(
        "seq", "start", "stop", "words", F.col("first.doc_id").alias("origin")))).alias("again"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield joined_runs(b, least_words)

    return lists.mapInArrow(run, SPANS)


SPANS = "doc_id long, text_key long, spans array<struct<start:int,stop:int,origin:long>>, removed_units long"
SPAN_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(pa.struct([
    ("start", pa.int32()), ("stop", pa.int32()), ("origin", pa.int64())]))), ("removed_units", pa.int64())])


def joined_runs(b: pa.RecordBatch, least_words: int) -> pa.RecordBatch:
    """Spans of the repeated units that are long enough, joined where they overlap or follow each other; their number."""
    lists = b.column("again")
    unit = lists.flatten()
    row = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
    column = {c: unit.field(c).to_numpy(zero_copy_only=False) for c in ("seq", "start", "stop", "words")}
    kept = np.flatnonzero(column["words"] >= least_words)
    row, seq, start, stop = row[kept], *(column[c][kept] for c in ("seq", "start", "stop"))
    opens = np.ones(len(row), np.bool_)
    if len(row) > 1:  # units come in order of their ends, too
        opens[1:] = (row[1:] != row[:-1]) | ~((start[1:] < stop[:-1]) | (seq[1:] == seq[:-1] + 1))
    at = np.flatnonzero(opens)
    until = np.append(at[1:], len(row)) - 1
    spans = pa.StructArray.from_arrays([pa.array(start[at].astype(np.int32)), pa.array(stop[until].astype(np.int32)),
                                        unit.field("origin").take(pa.array(kept[at]))], names=["start", "stop", "origin"])
    rows = np.unique(row)
    ends = np.append(0, np.cumsum(np.bincount(row[at], minlength=b.num_rows)[rows])) if len(rows) else np.zeros(1)
    units = np.bincount(row, minlength=b.num_rows)[rows] if len(rows) else np.zeros(0)
    take = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([
        b.column("doc_id").take(take), b.column("text_key").take(take),
        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans.cast(SPAN_SCHEMA.field("spans").type.value_type)),
        pa.array(units.astype(np.int64))], schema=SPAN_SCHEMA)


def strip(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``, and the spans themselves as ``removed`` (null: nothing)."""
    from pyspark.sql.pandas.functions import pandas_udf

    @pandas_udf("string")
    def cut(text, removed):
        def one(t, gone):
            if t is None or gone is None:
                return t
            at, parts = 0, []
            for s in gone:
                parts.append(t[at:s["start"]])
                at = s["stop"]
            return "".join((*parts, t[at:]))
        return text.combine(removed, one)

    gone = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__removed"))
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key"))
    joined = docs.join(gone, same, "left").drop("__id", "__key", "removed")
    return joined.withColumn("text", cut("text", "__removed")).withColumnRenamed("__removed", "removed")
