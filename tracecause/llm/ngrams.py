"""Character n-grams of whole texts as numpy arrays."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

MAX_CODE = 0x110000


@functools.cache
def letter_table() -> np.ndarray:
    """For each code point: itself if it is a letter or a combining mark, else 0."""
    table = np.zeros(MAX_CODE, dtype=np.int64)
    for c in range(MAX_CODE):
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] in "LM":
            table[c] = c
    return table


@functools.cache
def plain_letters() -> np.ndarray:
    """For each code point: is it a letter? Combining marks alone make no word."""
    return np.fromiter((not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] == "L" for c in range(MAX_CODE)), bool, MAX_CODE)


def has_letters(text: str) -> bool:
    return bool(plain_letters()[code_points(text)].any())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def letters(text: str) -> np.ndarray:
    """Lower-case letters with one 0 between words, before the first and after the last; empty without letters."""
    marked = letter_table()[code_points(text.lower())]
    padded = np.zeros(len(marked) + 2, dtype=np.int64)
    padded[1:-1] = marked
    keep = (padded != 0) | np.concatenate(([True], padded[:-1] != 0))
    out = padded[keep]
    return out if len(out) > 1 else out[:0]


def letter_grams(text: str) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams within words, blanks at their ends included (21 bits per character, a blank is 1)."""
    s = letters(text)
    if not len(s):
        return s
    letter = s != 0
    s = s + ~letter
    two = s[:-1] << 21 | s[1:]
    three = (two[:-1] << 21 | s[2:])[letter[1:-1]]
    return np.concatenate((s[letter], two, three))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    if not len(codes):
        return codes, codes
    codes = np.sort(codes)
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[starts], np.diff(np.append(starts, len(codes)))


def hashed_grams(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashes of the n-grams of a lower-cased text, one per position and order, ``bits`` wide."""
    s = code_points(f" {text.lower()} ").astype(np.uint64)
    parts = []
    rolling = np.zeros(len(s), dtype=np.uint64)
    for n in range(1, max(orders) + 1):
        size = len(s) - n + 1
        if size <= 0:
            break
        rolling = rolling[:size] * np.uint64(0x9E3779B97F4A7C15) + s[n - 1:] + np.uint64(1)
        if n in orders:
            mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            parts.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
