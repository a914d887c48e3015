"""Conversations as training windows of a token budget.

A window is a run of whole turns. Prefix sums of the turns' token counts choose where it ends: the last turn whose sum, less
the sum where the window starts, still fits. A first turn of role ``system`` is repeated at the head of every later window,
and after it as many of the latest turns as ``history`` tokens hold (fewer if the next turn would not fit otherwise). What
is repeated carries no loss; of the new turns, the texts of the assistant do. So every turn is new once, and every
assistant text is under the mask once. A turn that does not fit a window even alone gets one of its own, marked ``over``.

``Template`` marks the turns, and escapes its control strings inside texts by a backslash after their first character (a
string that already looks escaped gets one more), so that a window is read back exactly. Roles it has no marks for keep
their name.

Windows are made while sorted rows stream by; a task holds one window and its history. A conversation over ``cell`` bytes is
cut into cells by prefix sums of bytes (range partitions and their offsets, no conversation in one task); windows end
where a cell ends, and the system turn and the last turns are copied into the next cell. Digests of a conversation are
sequential by definition and stream through one task; only conversations of several cells travel for them.

Edge cases: turns are ordered by ``turn`` (null first), then role, hash of the text, and text; repeated rows are turns like
others. Null texts and roles are empty. Rows with a null conversation id form one conversation. No turn has a length limit.
An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracecause.llm.common import arrow_schema, cut_lineage

#: Marks before and after the text of a turn, by role.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")
CELL, TURN_BYTES, BYTES_PER_TOKEN = 1 << 20, 32, 16
SYSTEM, HISTORY, NEW = 0, 1, 2
KEY = ["conv_id", "turn", "role", "text_key"]
WINDOWS = ("cell int, whole boolean, window int, formatted string, repeated int, new_turns int, tokens int, over boolean, "
           "loss array<struct<start:int,stop:int>>")


@dataclass(frozen=True)
class Template:
    """Marks of turns. Reading back needs control strings whose first character stands in none of them again."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(MARKS))
    other: tuple[str, str] = OTHER
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        controls = [c for pair in (*self.marks.values(), self.other) for c in pair]
        heads = {c[:1] for c in controls}
        if len(set(controls)) < len(controls) or any(len(c) < 2 or set(c[1:]) & heads or "\\" in c for c in controls):
            raise ValueError("control strings must differ, and must not hold a first character again or a backslash")
        tails = [(re.escape(c[0]), re.escape(c[1:])) for c in controls]
        object.__setattr__(self, "plain", re.compile("|".join(rf"{a}(?=\\*{b})" for a, b in tails)))
        object.__setattr__(self, "escaped", re.compile("|".join(rf"{a}\\(?=\\*{b})" for a, b in tails)))
        object.__setattr__(self, "control", re.compile("|".join(a + b for a, b in tails)))
        object.__setattr__(self, "role_of", {pair[0]: role for role, pair in self.marks.items()})

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0], text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """A formatted turn, and where its text starts and stops."""
        before, after = self.marks.get(role, self.other)
        head = before + " "
        if role not in self.marks:
            head += self.escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
        body = self.escape(text)
        return f"{head}{body} {after}\n", len(head), len(head) + len(body)

    def read(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """(role, text, start, stop) of every turn of a window."""
        out, marks = [], list(self.control.finditer(formatted))
        for first, last in zip(marks[::2], marks[1::2]):
            start, stop = first.end() + 1, last.start() - 1
            role = self.role_of.get(first[0])
            if role is None:
                line = formatted.index("\n", start)
                name = self.unescape(formatted[start:line])
                role, start = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name), line + 1
            out.append((role, self.unescape(formatted[start:stop]), start, stop))
        return out


def piece_counts(model_path: str) -> Callable[[], Callable[[list[str]], list[int]]]:
    """Counts the pieces of texts with a SentencePiece model; loaded once per task."""
    def make():
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    return make


class Spans:
    """Windows of one cell, closed as turns come in order."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system = None
        self.system_is_new = False
        self.turns: list[tuple] = []
        self.ends = [0]  # prefix sums: ends[i] is what stands before turn i
        self.first_new = 0

    def room(self) -> int:
        return self.budget - (self.system[1] if self.system else 0)

    def lead(self, turn: tuple, new: bool) -> None:
        """The system turn; ``new`` in the first window of a conversation."""
        self.system, self.system_is_new = turn, new

    def past(self, turn: tuple) -> None:
        """A turn that an earlier cell has as new."""
        self.turns.append(turn)
        self.ends.append(self.ends[-1] + turn[1])
        self.first_new = len(self.turns)

    def trim(self, coming: int) -> None:
        """Keep the history that fits beside a turn of ``coming`` tokens."""
        fits = min(self.history, self.room() - coming)
        start = min(bisect_left(self.ends, self.ends[-1] - fits), len(self.turns)) if fits > 0 else len(self.turns)
        self.turns, self.ends = self.turns[start:], self.ends[start:]
        self.first_new = len(self.turns)

    def add(self, turn: tuple):
        closed = None
        if self.first_new < len(self.turns) and self.ends[-1] + turn[1] - self.ends[0] > self.room():
            closed = self.close()
        if self.first_new == len(self.turns):
            self.trim(turn[1])
        self.turns.append(turn)
        self.ends.append(self.ends[-1] + turn[1])
        return closed

    def close(self):
        """(turns, how many of them are repeated, tokens), or None without a new turn."""
        fresh = self.first_new < len(self.turns)
        if not fresh and not self.system_is_new:
            return None
        head = [self.system] if self.system else []
        turns = head + (self.turns if fresh else [])
        repeated = self.first_new if fresh else 0
        tokens = (self.system[1] if self.system else 0) + (self.ends[-1] - self.ends[0] if fresh else 0)
        out = turns, repeated + (len(head) if not self.system_is_new else 0), tokens
        self.system_is_new, self.first_new = False, len(self.turns)
        return out


def placed(turns: DataFrame, cell: int, history: int) -> DataFrame:
    """Turns with their cell, how they stand in it, and whether the cell is their whole conversation."""
    size = F.octet_length("role") + F.octet_length("text") + F.lit(TURN_BYTES)
    sized = turns.withColumn("size", size.cast("long"))
    long = cut_lineage(sized.groupBy("conv_id").agg(F.sum("size").alias("total")).where(F.col("total") > cell).select("conv_id"))
    alone = [F.lit(0).cast("int").alias("cell"), F.lit(NEW).alias("kind"), F.lit(True).alias("whole")]
    columns = [*turns.columns, "cell", "kind", "whole"]
    if long.isEmpty():
        return turns.select("*", *alone)
    of_long = sized["conv_id"].eqNullSafe(long["conv_id"])
    short = turns.join(long, turns["conv_id"].eqNullSafe(long["conv_id"]), "left_anti").select("*", *alone)
    narrow = sized.join(long, of_long, "left_semi").groupBy(*KEY).agg(F.sum("size").alias("size"))
    ranged = cut_lineage(narrow.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()))
    # One row per conversation and range partition: the sum of those before is where a partition starts.
    parts = ranged.groupBy("conv_id", "part").agg(F.sum("size").alias("held"))
    before = F.sum("held").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("before"))
    inner = F.sum("size").over(Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text_key"))
    at = ranged.withColumn("inner", inner).join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    stop = F.col("before") + F.col("inner")
    at = cut_lineage(at.select(*KEY, (stop - F.col("size")).alias("start"), stop.alias("stop"), "size"))

    def cell_of(place):
        return F.floor(place / F.lit(cell)).cast("int")

    reach = F.lit(BYTES_PER_TOKEN * history)
    own = F.struct(cell_of(F.col("start")).alias("cell"), F.lit(NEW).alias("kind"))
    later = F.array_distinct(F.array(cell_of(F.col("stop")), cell_of(F.col("stop") + reach)))
    later = F.filter(later, lambda c: (c > cell_of(F.col("start"))) & (F.col("size") <= reach))
    copies = F.transform(later, lambda c: F.struct(c.alias("cell"), F.lit(HISTORY).alias("kind")))
    places = at.select(*KEY, F.inline(F.concat(F.array(own), copies)))
    heads = at.where((F.col("start") == 0) & (F.col("role") == "system")).select(*KEY)
    cells = at.select(F.col("conv_id").alias("c"), cell_of(F.col("start")).alias("cell")).where("cell > 0").distinct()
    heads = heads.join(cells, F.col("conv_id").eqNullSafe(F.col("c"))).select(*KEY, "cell", F.lit(SYSTEM).alias("kind"))
    places = places.unionByName(heads).select(*[F.col(k).alias(f"at_{k}") for k in KEY], "cell", "kind")
    same = [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in KEY]
    put = turns.join(long, turns["conv_id"].eqNullSafe(long["conv_id"]), "left_semi").join(places, same)
    return short.unionByName(put.select(*turns.columns, "cell", "kind", F.lit(False).alias("whole")).select(columns))


def windows(conversations: DataFrame, count: Callable[[], Callable[[list[str]], list[int]]], *, budget: int = 1024,
            history: int = 256, template: Template | None = None, cell: int = CELL) -> DataFrame:
    """(conv_id, cell, whole, window, formatted, repeated, new_turns, tokens, over, loss) per window.

    ``repeated`` is the number of turns at the head that an earlier window has; ``loss`` holds character spans of ``formatted``.
    """
    if budget < 1 or history < 0:
        raise ValueError("the budget must be positive and the history not negative")
    template = template or Template()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    turns = turns.withColumn("text_key", F.xxhash64("text"))
    order = ["conv_id", "cell", "kind", "turn", "role", "text_key", "text"]
    dealt = placed(turns, cell, history).repartition("conv_id", "cell").sortWithinPartitions(*order)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {id_type}, {WINDOWS}"
    schema = arrow_schema(ddl)

    def run(batches):
        counts = count()
        current, spans, rows, chars, number = None, None, [], 0, 0

        def written(window):
            nonlocal number, chars
            members, repeated, tokens = window
            parts, loss, at = [], [], 0
            for i, (formatted, _, role, start, stop) in enumerate(members):
                if i >= repeated and role in template.trained:
                    loss.append({"start": at + start, "stop": at + stop})
                parts.append(formatted)
                at += len(formatted)
            number += 1
            chars += at
            return (*current, number - 1, "".join(parts), repeated, len(members) - repeated, tokens, tokens > budget, loss)

        def flushed():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids, cells, kinds, whole = (part.column(n).to_pylist() for n in ("conv_id", "cell", "kind", "whole"))
                roles = part.column("role").to_pylist()
                made = [template.turn(r, t) for r, t in zip(roles, part.column("text").to_pylist())]
                for i, (turn, tokens) in enumerate(zip(made, counts([m[0] for m in made]))):
                    turn = (turn[0], tokens, roles[i], turn[1], turn[2])
                    key = (ids[i], cells[i], whole[i])
                    window, first = None, key != current
                    if first:
                        window = spans.close() if spans else None
                        if window:
                            rows.append(written(window))
                        current, spans, number, window = key, Spans(budget, history), 0, None
                    if kinds[i] == SYSTEM:
                        if first:
                            spans.lead(turn, False)
                    elif kinds[i] == HISTORY:
                        spans.past(turn)
                    elif first and cells[i] == 0 and roles[i] == "system":
                        spans.lead(turn, True)
                    else:
                        window = spans.add(turn)
                    if window:
                        rows.append(written(window))
                    if len(rows) >= 500 or chars > 4_000_000:
                        yield flushed()
                        rows, chars = [], 0
        window = spans.close() if spans else None
        if window:
            rows.append(written(window))
        if rows:
            yield flushed()

    return dealt.select("conv_id", "cell", "kind", "whole", "role", "text").mapInArrow(run, ddl)


@dataclass
class Digest:
    """What is read back of a conversation so far."""

    n_turns: int = 0
    loss_chars: int = 0
    formatted_chars: int = 0

    def __post_init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, n_turns: int, turns: bytes, loss_chars: int, loss: bytes, formatted_chars: int) -> None:
        self.n_turns += n_turns
        self.loss_chars += loss_chars
        self.formatted_chars += formatted_chars
        self.turns.update(turns)
        self.loss.update(loss)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(found: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) per conversation, from its windows alone.

    ``found`` are rows of ``windows`` as they come, those of a cell together and in order.
    """
    template = template or Template()
    id_type = found.schema["conv_id"].dataType.simpleString()
    digests = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    part_ddl = f"conv_id {id_type}, cell int, window int, {digests}, turns binary, loss binary"
    part_schema, schema = arrow_schema(part_ddl), arrow_schema(f"conv_id {id_type}, {digests}")

    def contents(formatted: str, repeated: int, spans: list[dict]) -> tuple:
        fresh = template.read(formatted)[repeated:]
        turns = "".join(f"{role}\n{text}\n" for role, text, _, _ in fresh)
        loss = "".join(template.unescape(formatted[s["start"]:s["stop"]]) for s in spans)
        return len(fresh), turns.encode(), len(loss), loss.encode(), len(formatted)

    def of_cells(batches):
        """Whole conversations as digests, windows of others as their contents."""
        current, digest, rows, held = None, None, [], 0
        for b in batches:
            for at in range(0, b.num_rows, 500):
                columns = [b.slice(at, 500).column(n).to_pylist() for n in
                           ("conv_id", "cell", "whole", "window", "formatted", "repeated", "loss")]
                for i, cell, whole, window, formatted, repeated, spans in zip(*columns):
                    part = contents(formatted, repeated, spans)
                    if (i, cell) != current and digest:
                        rows.append((current[0], 0, 0, *digest.row(), None, None))
                        digest = None
                    current = (i, cell)
                    if whole:
                        digest = digest or Digest()
                        digest.add(*part)
                    else:
                        rows.append((i, cell, window, part[0], None, part[2], None, part[4], part[1], part[3]))
                        held += len(part[1])
                    if len(rows) >= 2000 or held > 4_000_000:
                        yield as_batch(rows, part_schema)
                        rows, held = [], 0
        if digest:
            rows.append((current[0], 0, 0, *digest.row(), None, None))
        if rows:
            yield as_batch(rows, part_schema)

    def of_conversations(batches):
        current, digest, rows = None, None, []
        for b in batches:
            for at in range(0, b.num_rows, 500):
                for r in b.slice(at, 500).to_pylist():
                    if digest and r["conv_id"] != current:
                        rows.append((current, *digest.row()))
                        digest = None
                    current = r["conv_id"]
                    if r["turns"] is None:
                        rows.append(tuple(r[n] for n in schema.names))
                    else:
                        digest = digest or Digest()
                        digest.add(r["n_turns"], r["turns"], r["loss_chars"], r["loss"], r["formatted_chars"])
            if rows:
                yield as_batch(rows, schema)
                rows = []
        if digest:
            yield as_batch([(current, *digest.row())], schema)

    parts = found.select("conv_id", "cell", "whole", "window", "formatted", "repeated", "loss").mapInArrow(of_cells, part_ddl)
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "cell", "window")
    return dealt.mapInArrow(of_conversations, f"conv_id {id_type}, {digests}")


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
