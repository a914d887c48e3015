"""Secret scan: fixed patterns, and values in a credential context that would be hard to guess.

The patterns give base spans. Beyond them, a value that follows a credential word (``pwd: ...``, ``"client_secret" =>
"..."``, ``Authorization: Bearer ...``) is costed as a guesser would: the cheapest way to cut it into words, dates,
repeats, sequences, keyboard walks and characters tried by brute force, found by dynamic programming over the log10 of
guesses. A word costs its rank by document frequency, counted over all documents (``ranks``), or by a fixed list, whichever
is less. Values of ``HARD`` or more are ``guess`` spans, unless a base span covers part of them. Placeholders such as
``changeme`` or ``qwerty12345`` stay below.

Edge cases: null texts count as empty. Offsets are code points. Letters in patterns are ASCII, either case where stated.
A value of any length is costed whole, in time linear in its length.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import map_rows

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is found whole from its first character
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code|key)?|pwd|secret|token|(?:api|access|private|auth|encryption)[_\x20-]?key|credentials?|authorization)"""
    r"""["'\]]?\x20*(?:=>|:=|[:=]|\bis\b)\x20*(?:(?:bearer|basic)\x20+)?"""
    r"""(?:"([^"\n]{4,})"|'([^'\n]{4,})'|([^\s"',;<>(){}]{4,}))""", re.I | re.A)
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization")
#: log10 of the guesses from which a value is hard, and what one more segment adds.
HARD, JOIN = 10.0, 0.3

#: Common words of passwords and of placeholders, the most usual first (fixed values).
WORDS = """password admin welcome login qwerty letmein monkey dragon master hello freedom whatever trustno shadow sunshine princess
football baseball superman batman secret test testing user guest root default changeme change example sample demo temp temporary
pass passwd pwd token apikey key access private public server client service system database backup office company internet
computer windows linux google amazon azure apple microsoft facebook twitter github spring summer autumn winter january february
march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday
love money jesus angel lucky happy family friend friends summer flower banana orange purple yellow silver golden diamond tiger
eagle falcon phoenix ninja hunter killer soccer hockey tennis golf guitar music movie matrix starwars pokemon naruto minecraft
the and you for are with that this from your have none null true false undefined required optional string value here insert enter
placeholder redacted hidden masked removed unknown production staging development local localhost""".split()
#: Neighbours on a keyboard are next to each other in these rows (fixed values).
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik,9ol.0p;/",
        "abcdefghijklmnopqrstuvwxyz")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}:"<>?', "`1234567890-=[];',./")
LEET = str.maketrans("4@8(3610!$5+7", "aabcegiioss" + "tt")
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)\d{1,2}\1\d{1,2})?|\d{1,2}([-/._])\d{1,2}\2(?:19|20)?\d\d|"
                  r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d")
REPEAT = re.compile(r"(.{1,4}?)\1{2,}", re.S)
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LONGEST = 24
#: Words of this many documents or more are ranked, so many at most: the table sent to the tasks has under 10 MB.
LEAST_DOCS, MOST_WORDS = 5, 100_000
LETTERS = re.compile(rf"\b[^\W\d_]{{3,{LONGEST}}}\b")
NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)} | {(b, a) for row in ROWS for a, b in zip(row, row[1:], strict=False)}


def alphabet(ch: str) -> int:
    """How many characters a brute-force guesser tries for one like this."""
    if ch.isdigit():
        return 10
    if ch.isalpha():
        return 26 if ch.isascii() else 100
    return 33


def words_of(text: str) -> set[str]:
    """Distinct words; values in a credential context do not count, else a secret that is copied would become a word."""
    low = text.lower()
    return set(LETTERS.findall(CONTEXT.sub(" ", low) if any(h in low for h in CONTEXT_HINTS) else low))


def ranks(docs: DataFrame) -> dict[str, int]:
    """Rank of the most frequent words by number of documents, merged with the fixed list."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts = Counter()
        for b in batches:
            for at in range(b.num_rows):
                counts.update(words_of(b.column(0)[at].as_py()))
                if len(counts) >= 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)
                    counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    counted = docs.where("text IS NOT NULL").select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= LEAST_DOCS).orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect()
    found = {row["word"]: i for i, row in enumerate(top, 1)}
    return found | {w: min(i, found.get(w, i)) for w, i in RANK.items()}


def matches(value: str, ranked: dict[str, int] = RANK):
    """(start, stop, log10 of guesses) of all spans that follow a pattern."""
    low = value.lower()
    plain = low.translate(LEET)
    for text, extra in ((low, 0.0), *(((plain, 0.3),) if plain != low else ())):
        for i in range(len(text)):
            for j in range(i + 3, min(len(text), i + LONGEST) + 1):
                rank = ranked.get(text[i:j])
                if rank:
                    own = value[i:j]
                    case = 0.0 if own.islower() or not own.isalpha() else math.log10(2) if own.istitle() or own.isupper() else 1.0
                    yield i, j, math.log10(rank + 1) + extra + case
    for m in DATE.finditer(low):
        digits = sum(c.isdigit() for c in m[0])
        yield m.start(), m.end(), math.log10(120) if digits <= 4 else math.log10(365 * 120) + 0.6 * (digits < len(m[0]))
    for m in REPEAT.finditer(value):
        yield m.start(), m.end(), sum(math.log10(alphabet(c)) for c in m[1]) + math.log10(len(m[0]) // len(m[1]))
    flat = low.translate(SHIFTED)
    start = 0
    for i in range(1, len(flat) + 1):
        if i == len(flat) or (flat[i - 1], flat[i]) not in NEXT:
            if i - start >= 3:
                turns = sum(flat[k] == flat[k + 2] for k in range(start, i - 2))
                yield start, i, math.log10(len(NEXT)) + math.log10(i - start) + 0.5 * turns
            start = i


def guess_cost(value: str, ranked: dict[str, int] = RANK) -> float:
    """log10 of the guesses for the cheapest segmentation of the value."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, stop, cost in matches(value, ranked):
        ending.setdefault(stop, []).append((start, cost + JOIN))
    best = [0.0] * (len(value) + 1)
    for i, ch in enumerate(value, 1):
        best[i] = best[i - 1] + math.log10(alphabet(ch))
        for start, cost in ending.get(i, ()):
            best[i] = min(best[i], best[start] + cost)
    return best[-1]


def scan(text: str, ranked: dict[str, int] = RANK) -> list[tuple[str, int, int, int]]:
    """(kind, start, stop, start of the secret value) by start, then kind. All secrets of a whole text."""
    found = []
    low = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    if any(h in low for h in ASSIGN_HINTS):
        found += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    if any(h in low for h in CONTEXT_HINTS):
        base = [(start, stop) for _, start, stop, _ in found]
        for m in CONTEXT.finditer(text):
            start, stop = m.span(m.lastindex)
            if not any(s < stop and start < e for s, e in base) and guess_cost(text[start:stop], ranked) >= HARD:
                found.append(("guess", start, stop, start))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def written(spans) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, start, stop, *_ in spans)


def summary(text: str, ranked: dict[str, int] = RANK) -> tuple:
    found = scan(text, ranked)
    n = {k: sum(x[0] == k for x in found) for k in KINDS}
    base = written(x for x in found if x[0] != "guess")
    return n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), written(found), n["guess"]


def report(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts per kind and all spans of every whole ``text``, beside the columns ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks(docs))
    return map_rows(docs, lambda: functools.partial(summary, ranked=shared.value), keep, "n_assign long, n_access long, n_hex long, base_sha256 string, "
                                                 "spans string, n_guess long")


def redacted(text: str, mark: str = "[SECRET]", ranked: dict[str, int] = RANK) -> str:
    """The text with every secret value replaced by ``mark``; overlapping values become one."""
    parts, at = [], 0
    for _, start, stop in sorted((0, value, stop) for _, _, stop, value in scan(text, ranked)):
        if stop <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = stop
    return "".join((*parts, text[at:]))
