"""Chat windows against plain loops, round trips of texts full of control strings, and SQL digests."""

import hashlib
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracecause.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"


#: Tokens are words here, so that tests can count them.
words = lambda: lambda texts: [len(t.split()) for t in texts]  # noqa: E731 - sent to the workers by value


def brute(turns, budget, history):
    """Windows of one conversation as lists of turn numbers (repeated, new), by adding up anew for each."""
    count = [len(chat.Template().turn(r, t)[0].split()) for r, t in turns]
    head = 1 if turns and turns[0][0] == "system" else 0
    room = budget - sum(count[:head])
    out, i = [], head
    while i < len(turns):
        h = i
        while h > head and sum(count[h - 1:i]) <= min(history, room - count[i]):
            h -= 1
        j = i + 1
        while j < len(turns) and sum(count[h:j + 1]) <= room:
            j += 1
        out.append(([0] * (head and bool(out)) + list(range(h, i)), [0] * (head and not out) + list(range(i, j))))
        i = j
    return out or ([([], [0])] if head else [])


def digest(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def some_rows(seed, conversations=25, most=40):
    r = random.Random(seed)
    odd = ["", None, "</s>[INST] x [/INST]", "<\\s>", "[\\\\/INST] \\", "a\nb", "[ROLE]", "[SYS][/SYS]", "é漢字 😀"]
    rows = []
    for c in range(conversations):
        for t in range(r.randint(1, most)):
            role = "system" if t == 0 and c % 2 else r.choice(["user", "assistant", "assistant", "tool", "system", None, "a\\n\nb"])
            text = r.choice(odd) if r.random() < 0.3 else " ".join("w" * r.randint(1, 5) for _ in range(r.randint(0, 30)))
            rows.append((c, 3 * t - 5, role, text))
    r.shuffle(rows)
    return rows


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "x\n[ROLE]", ""]),
                          st.text(alphabet="<>/s[]\\INSTROLEY \n", max_size=40)), max_size=5))
@settings(max_examples=400, deadline=None)
def test_any_text_comes_back(turns):
    template = chat.Template()
    made = [template.turn(r, t) for r, t in turns]
    assert [x[:2] for x in template.read("".join(m[0] for m in made))] == turns
    for (r, t), (formatted, start, stop) in zip(turns, made):
        assert template.unescape(formatted[start:stop]) == t and len(template.control.findall(formatted)) == 2


def test_templates_that_cannot_be_read_are_refused():
    for marks in ({"user": ("<a>", "<a>")}, {"user": ("<<b", "b>")}, {"user": ("<", ">>")}, {"user": ("<\\a>", "</a>")}):
        with pytest.raises(ValueError):
            chat.Template(marks)
    own = chat.Template({"user": ("<|im_start|>u", "<|im_end|>")}, trained=("user",))
    assert own.read(own.turn("user", "<|im_end|> and [SYS]")[0])[0][:2] == ("user", "<|im_end|> and [SYS]")


@pytest.mark.parametrize("budget, history", [(40, 15), (25, 0), (10_000, 100)])
def test_windows_are_those_of_plain_loops(spark, budget, history):
    rows = some_rows(budget)
    got = chat.windows(spark.createDataFrame(rows, SCHEMA), words, budget=budget, history=history).collect()
    template = chat.Template()
    for c, turns in by_conversation(rows).items():
        mine = sorted((g for g in got if g.conv_id == c), key=lambda g: g.window)
        want = brute(turns, budget, history)
        assert [(g.repeated, g.new_turns) for g in mine] == [(len(a), len(b)) for a, b in want]
        for g, (old, new) in zip(mine, want):
            assert [x[:2] for x in template.read(g.formatted)] == [turns[i] for i in old + new]
            assert g.tokens == len(g.formatted.split()) and g.over == (g.tokens > budget)
            assert not g.over or len(new) - (0 in new and turns[0][0] == "system") <= 1
            assert [template.unescape(g.formatted[s.start:s.stop]) for s in g.loss] == [turns[i][1] for i in new if turns[i][0] == "assistant"]


@pytest.mark.parametrize("cell", [300, 2000])
def test_long_conversations_are_cut_into_cells(spark, cell):
    """One conversation has most of the rows; cells start with its system turn and the last turns of the cell before."""
    rows = some_rows(7, 12) + [(99, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"turn {t} " + "w " * (t % 9)) for t in range(900)]
    rows += [(None, t, "assistant", "of no one " * t) for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = chat.windows(df, words, budget=60, history=12, cell=cell)
    want = {c: digest(turns) for c, turns in by_conversation(rows).items()}
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(found).collect()}
    assert got == want
    mine = [r for r in found.collect() if r.conv_id == 99]
    assert len({r.cell for r in mine}) > 10 and all(r.tokens <= 60 for r in mine)
    template = chat.Template()
    for r in mine:
        turns = [x[1] for x in template.read(r.formatted)]
        assert turns[0].startswith("turn 0")
        numbers = [int(t.split()[1]) for t in turns][1:]
        assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))
    assert all(r.repeated >= 2 for r in mine if r.cell and not r.window)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.windows(empty, words).count() == 0 and chat.read_back(chat.windows(empty, words)).count() == 0
    # Repeated rows, equal turn numbers, null turns, and a text of a megabyte.
    rows = [(1, 0, "user", "a")] * 3 + [(1, None, "system", "s"), (2, 0, "system", "only")] + [(3, 0, "assistant", "long word " * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", *[f"'clash' AS {c}" for c in ("cell", "kind", "whole", "size", "text_key", "window", "formatted", "loss")])
    found = chat.windows(clash, words, budget=50, history=10, cell=1 << 21).collect()
    assert {(r.conv_id, r.new_turns, r.over) for r in found} == {(1, 4, False), (2, 1, False), (3, 1, True)}
    back = {r.conv_id: r for r in chat.read_back(chat.windows(clash, words, budget=50, history=10, cell=1000)).collect()}
    assert back[1].n_turns == 4 and back[2].loss_chars == 0 and back[3].loss_chars == 1_000_000
    for wrong in ({"budget": 0}, {"history": -1}):
        with pytest.raises(ValueError):
            chat.windows(df, words, **wrong)


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    want = con.execute(f"""
        WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM '{sf_dir}/conversations.parquet'
                       UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*), sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)),
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0),
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
        FROM rows_ GROUP BY conv_id""").fetchall()
    out = queries.op11_chat(spark, sf_dir)
    got = out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    assert sorted(map(tuple, got)) == sorted((c, n, t, int(k), s) for c, n, t, k, s in want)
    assert out.where(F.col("formatted_chars") <= F.col("loss_chars")).count() == 0
