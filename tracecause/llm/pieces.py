"""SentencePiece encoding and decoding by backtracking over longest matches.

A byte-pair encoding is the one segmentation in which every two neighbours stay apart when their joint text is merged
anew. So a text can be read from left to right: take the longest piece (Aho-Corasick) that is compatible with the
piece before; where none leads on, mark the position as failed in a bitfield and step back. No position is tried
twice from a failed state, so the work is linear in the text.

Pieces never cross from a word into the space that follows it, nor between letters, digits and other characters (the
codec checks its vocabulary for this), and characters outside the vocabulary never merge. The text is cut at all these
places, and encodings of short cuts are remembered in a dictionary of bounded size.

Null texts count as empty. Empty texts have the begin and end ids only.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import map_rows

SPACE = "▁"
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Remembered encodings per Python worker, and the longest cut that is remembered.
CACHE_ENTRIES, CACHE_CHARS = 500_000, 48

def kind_of(ch: str) -> str:
    if ch == SPACE:
        return ch
    return "letter" if ch.isalpha() else "digit" if ch.isdecimal() else "other"


class PieceCodec:
    """Encoder and decoder of one byte-fallback BPE model with identity normalisation."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with identity normalisation and escaped spaces are supported")
        if model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback:
            raise ValueError("only models with space prefixes and byte fallback are supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER, UNUSED)}
        self.scores = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, USER, UNUSED)}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        crossing = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if any(a != SPACE and kind_of(a) != kind_of(b) for a, b in crossing):
            raise ValueError("pieces that cross between letters, digits, other characters and spaces are not supported")
        self.known = {p for p in self.ids if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        numerals = "".join(sorted(ch for ch in set("".join(self.ids)) if ch.isalnum() and kind_of(ch) == "other"))
        other = re.escape(numerals) + "_"
        self.cuts = re.compile(f"{SPACE}*(?:[^\\W\\d{other}]+|\\d+|(?:(?!{SPACE})[\\W{other}])+)|{SPACE}+").findall
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), None) for p in self.ids}
        self.apart: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.plain = [self.plain_text(i) for i in range(len(self.pieces))]

    def plain_text(self, i: int) -> str | None:
        """Text of a piece that is the same between any neighbours: all but unknown ones and bytes of longer characters."""
        kind, piece = self.kinds[i], self.pieces[i]
        if kind == BYTE:
            return chr(int(piece[3:5], 16)) if int(piece[3:5], 16) < 0x80 else None
        return "" if kind == CONTROL else None if kind == UNKNOWN else piece.replace(SPACE, " ")

    # Merging: the definition, used for checks on short texts only.

    def merge(self, text: str) -> list[str]:
        """Repeatedly join the neighbours whose joint piece scores best, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Do the two pieces stay as they are when their joint text is merged anew? ``left`` may be empty."""
        key = (left, right)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= CACHE_ENTRIES:
                self.apart.clear()
            found = self.apart[key] = self.merge(left + right) == ([left, right] if left else [right])
        return found

    def next_shorter(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix of this one."""
        return self.shorter[piece]

    def segment(self, text: str) -> list[str]:
        """Pieces of a text all of whose characters are in the vocabulary."""
        longest: list[str] = list(text)
        for end, (before_end, piece) in self.automaton.iter(text):
            longest[end - before_end] = piece  # ends ascend, so the last for a start is the longest
        failed = 0  # a bit per position from which no way leads to the end
        apart, compatible, next_shorter = self.apart, self.compatible, self.next_shorter
        stack: list[str] = []
        size, at, before, piece = len(text), 0, "", longest[0]
        while True:
            while piece is not None:
                if not failed >> at + len(piece) & 1:
                    good = apart.get((before, piece))
                    if good or good is None and compatible(before, piece):
                        break
                piece = next_shorter(piece)
            if piece is not None:
                stack.append(piece)
                at += len(piece)
                if at == size:
                    return stack
                before, piece = piece, longest[at]
            else:
                if not stack:
                    raise ValueError("no segmentation: the vocabulary lacks a character")
                failed |= 1 << at
                piece = stack.pop()
                at -= len(piece)
                before = stack[-1] if stack else ""
                piece = next_shorter(piece)

    def cut_ids(self, cut: str) -> list[int]:
        if self.known.issuperset(cut):
            return [self.ids[p] for p in self.segment(cut)]
        ids: list[int] = []
        start = 0
        for i, ch in enumerate(cut):
            if ch not in self.known:
                if start < i:
                    ids += [self.ids[p] for p in self.segment(cut[start:i])]
                ids += [self.bytes[b] for b in ch.encode()]
                start = i + 1
        if start < len(cut):
            ids += [self.ids[p] for p in self.segment(cut[start:])]
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """Ids without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " " or not self.dummy_prefix:
            return self.marked_bytes((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))
        words = text.split(" ")
        words_seen = self.words
        out = [words_seen.get(w) for w in words]
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    word = words[i]
                    found = out[i] = words_seen.get(word) or self.marked_bytes(SPACE + word)
                    if len(word) <= CACHE_CHARS:
                        if len(words_seen) >= CACHE_ENTRIES:
                            words_seen.clear()
                        words_seen[word] = found
        return b"".join(out)

    def marked_bytes(self, text: str) -> bytes:
        """Ids of a text whose spaces are marks already."""
        cache, out = self.cache, []
        for cut in self.cuts(text):
            found = cache.get(cut)
            if found is None:
                found = array("I", self.cut_ids(cut)).tobytes()
                if len(cut) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[cut] = found
            out.append(found)
        return b"".join(out)

    def encode(self, text: str, begin: bool = False, end: bool = False) -> list[int]:
        ids = list(memoryview(self.encode_bytes(text)).cast("I"))
        return [self.begin] * begin + ids + [self.end] * end

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control pieces vanish, byte pieces join to UTF-8 (bad bytes: U+FFFD), one leading space goes."""
        texts = [self.plain[i] for i in ids]
        if None not in texts and self.dummy_prefix:
            text = "".join(texts)
            first = next((i for i, t in zip(ids, texts, strict=True) if t), None)
            return text[1:] if text.startswith(" ") and self.kinds[first] != BYTE else text
        parts: list[str] = []
        pending = bytearray()
        first = self.dummy_prefix
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                pending.append(int(self.pieces[i][3:5], 16))
                first = False
                continue
            if pending:
                parts.append(utf8(pending))
                pending.clear()
            if kind == CONTROL:
                continue
            piece = " ⁇ " if kind == UNKNOWN else self.pieces[i].replace(SPACE, " ")
            parts.append(piece[1:] if first and piece.startswith(" ") and kind != UNKNOWN else piece)
            first = False
        if pending:
            parts.append(utf8(pending))
        return "".join(parts)


def utf8(raw: bytearray) -> str:
    """UTF-8 text in which every byte that is part of no character is one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_codecs: dict[str, PieceCodec] = {}


def codec(model_path: str) -> PieceCodec:
    """One codec per worker process; its dictionary outlives the task."""
    if model_path not in _codecs:
        _codecs[model_path] = PieceCodec(model_path)
    return _codecs[model_path]


def encode_documents(docs: DataFrame, model_path: str, keep: list[str], begin: bool = True, end: bool = True) -> DataFrame:
    """Column ``ids`` (array of int) of every whole ``text``, beside the columns ``keep``."""
    def make():
        c = codec(model_path)
        return lambda text: (c.encode(text, begin, end),)

    return map_rows(docs, make, keep, "ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """Column ``decoded`` of every ``ids`` (null: empty), beside the columns ``keep``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    source = encoded.select(*[F.col(f"`{k}`") for k in keep], F.col("ids").alias("__ids"))
    schema = StructType([*source.schema.fields[:-1], StructField("decoded", StringType())])
    out = to_arrow_schema(schema)

    def run(batches):
        c = codec(model_path)
        for b in batches:
            decoded = pa.array([c.decode(i or []) for i in b.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], decoded], schema=out)

    return source.mapInArrow(run, schema)


def checked_pieces(docs: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """``ids`` with begin and end ids, and ``round_trip``: do they decode to the text (its marks being spaces)? One pass."""
    def make():
        import numpy as np

        c = codec(model_path)
        begin, end = c.begin.to_bytes(4, "little"), c.end.to_bytes(4, "little")

        def one(text: str):
            ids = np.frombuffer(begin + c.encode_bytes(text) + end, dtype="<i4")
            return ids, c.decode(ids.tolist()) == text.replace(SPACE, " ")
        return one

    return map_rows(docs, make, keep, "ids array<int>, round_trip boolean")


def round_trip(docs: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """Encode with begin and end ids and decode again, in one pass: the decoded text and digests of both sides.

    Adds ``n_tokens``, ``ids_sha256`` (ids as little-endian 32-bit integers), ``decoded`` and ``decoded_sha256``.
    """
    def make():
        c = codec(model_path)
        begin, end = c.begin.to_bytes(4, "little"), c.end.to_bytes(4, "little")

        def one(text: str):
            raw = begin + c.encode_bytes(text) + end
            decoded = c.decode(memoryview(raw).cast("I").tolist())
            return (len(raw) // 4, hashlib.sha256(raw).hexdigest(), decoded,
                    hashlib.sha256(decoded.encode()).hexdigest())
        return one

    return map_rows(docs, make, keep, "n_tokens long, ids_sha256 string, decoded string, decoded_sha256 string")
