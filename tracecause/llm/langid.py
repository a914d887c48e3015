"""Language ID by rank-order profiles.

Each language keeps its most frequent 1- to 3-grams in order of rank. A document ranks its own n-grams the same way;
its distance to a language is the sum over them of how far each is out of place, ``size`` where the language lacks it.
The nearest language wins, the first in alphabetical order of equals.

Edge cases: null texts count as empty. Texts without a letter (combining marks are none) are ``und`` with score 0, and so is every text when
there is nothing to learn from. Rows with a null language or text are not learned from. Repeated rows count each time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracecause.llm.common import map_batches, map_rows
from tracecause.llm.ngrams import counted, has_letters, letter_grams

#: N-grams in a profile, and characters that are sorted at a time while counting.
SIZE, CHUNK = 400, 1_000_000
UNKNOWN = "und"


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``text`` and ``lang``; each task folds its rows before they are shuffled."""
    rows = train.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())

    def batch(b):
        texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
        pending: dict[str, list[np.ndarray]] = {}
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[str, int] = {}

        def fold(lang):
            found.setdefault(lang, []).append(counted(np.concatenate(pending.pop(lang))))
            held[lang] = 0

        for text, lang in zip(texts, langs, strict=True):
            pending.setdefault(lang, []).append(letter_grams(text))
            held[lang] = held.get(lang, 0) + len(text)
            if held[lang] >= CHUNK:
                fold(lang)
        for lang in list(pending):
            fold(lang)
        for lang, parts in found.items():
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes))
            yield {"lang": [lang] * len(codes), "gram": codes, "n": n.astype(np.int64)}

    parts = map_batches(rows, batch, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(train: DataFrame, size: int = SIZE) -> dict[str, list[int]]:
    """Per language its ``size`` most frequent n-grams in order. One short list per language reaches the driver."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = gram_counts(train).withColumn("rank", rank).where(F.col("rank") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(grams)] for lang, grams in sorted(found.items())}


class Ranker:
    """Distances of one document to all profiles at once."""

    def __init__(self, languages: dict[str, list[int]], size: int):
        self.names, self.size = sorted(languages), size
        self.grams = np.unique(np.array([g for v in languages.values() for g in v], dtype=np.int64))
        self.ranks = np.full((len(self.names), len(self.grams) + 1), -1, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.grams, languages[name])] = np.arange(len(languages[name]))

    def nearest(self, text: str) -> tuple[str, float]:
        """The language, and 1 less the share of the largest possible distance."""
        if not self.names or not has_letters(text):
            return UNKNOWN, 0.0
        codes, n = counted(letter_grams(text))
        own = codes[np.argsort(-n, kind="stable")[:self.size]]
        at = np.searchsorted(self.grams, own)
        at[at < len(self.grams)] = np.where(self.grams[at[at < len(self.grams)]] == own[at < len(self.grams)],
                                            at[at < len(self.grams)], len(self.grams))
        ranks = self.ranks[:, at]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(distance))
        return self.names[best], 1.0 - float(distance[best]) / (self.size * len(own))


def predict(docs: DataFrame, languages: dict[str, list[int]], keep: list[str], size: int = SIZE) -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1) of every whole ``text``, beside the columns ``keep``."""
    return map_rows(docs, lambda: Ranker(languages, size).nearest, keep, "lang_pred string, score double")
