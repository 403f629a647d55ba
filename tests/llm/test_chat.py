"""Chat formatting: a plain parser reads every conversation back, DuckDB agrees, odd rows survive."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stockout.llm import chat

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_parse(formatted):
    """Character by character: (role, text, start, end) of every turn; texts unescaped."""
    out, at = [], 3
    assert formatted.startswith("<s>")
    undo = lambda s: re.sub(r"<\\(?=\\*/?s>)|\[\\(?=\\*/?(?:INST|ROLE)\])", lambda m: m[0][0], s)
    while at < len(formatted):
        if formatted.startswith("[INST] ", at):
            role, start, close = "user", at + 7, " [/INST]"
        elif formatted.startswith("[ROLE] ", at):
            gap = formatted.index(" [/ROLE] ", at)
            role, start, close = undo(formatted[at + 7:gap]), gap + 9, " </s>"
        else:
            assert formatted[at] == " "
            role, start, close = "assistant", at + 1, " </s>"
        end = formatted.index(close, start)
        out.append((role, undo(formatted[start:end]), start, end))
        at = end + len(close)
    return out


def _key(row):
    turn = row["turn"]
    return (turn is not None, turn or 0, row["role"] or "", row["text"] or "")


def _check(rows, formatted):
    for conv in formatted:
        mine = sorted((r for r in rows if r["conv_id"] == conv["conv_id"]), key=_key)
        want = [(r["role"] or "", r["text"] or "") for r in mine]
        turns = plain_parse(conv["formatted"])
        assert [t[:2] for t in turns] == want
        ends = [0]
        for n in conv["loss_runs"]:
            ends.append(ends[-1] + n)
        assert ends[-1] == len(conv["formatted"])
        under = [(a, b) for a, b in zip(ends[1::2], ends[2::2]) if a < b]
        assert under == [(t[2], t[3]) for t in turns if t[0] == "assistant" and t[2] < t[3]]


def test_hard_texts_come_back(spark):
    rng = random.Random(5)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<", "[", "\\", "s>", "INST]", " ", "\n", "é", "😀", "$1", "ok"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
    roles = ["user", "assistant", "system", "User", "", None, "</s>", " [/ROLE] ", "a\nb"]
    rows = [(rng.randrange(40), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice([text(), None]) if rng.random() < .1 else text())
            for _ in range(600)]
    table = spark.createDataFrame(rows, SCHEMA)
    out = chat.format_conversations(table).collect()
    assert len(out) == len({r[0] for r in rows})
    _check([r.asDict() for r in table.collect()], out)


def test_unchanged_where_nothing_looks_like_a_marker(spark):
    table = spark.createDataFrame([(1, 0, "user", "a <b> [c] \\ s>"), (1, 1, "assistant", "<S> </ s>")], SCHEMA)
    [row] = chat.format_conversations(table).collect()
    assert row["formatted"] == "<s>[INST] a <b> [c] \\ s> [/INST] <S> </ s> </s>"


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]" * 40_000, "<" + "\\" * 400_000 + "s>", "<" * 300_000, "x" * 2_000_000])
def test_very_long_texts(spark, text):
    table = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], SCHEMA)
    [row] = chat.read_back(chat.format_conversations(table)).collect()
    assert [t["text"] for t in row["turns"]] == [text, text] and row["loss_texts"] == [text]


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 0, "user", "a", "y"), (None, None, None, None, "x"), (2, 5, "assistant", "", "z")]
    table = spark.createDataFrame(rows, SCHEMA + ", formatted string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    assert [t["text"] for t in out[1]["turns"]] == ["a", "a"]
    assert [(t["role"], t["text"]) for t in out[None]["turns"]] == [("", "")]
    assert out[2]["loss_texts"] == [""]
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_parser_refuses_what_is_no_conversation(spark):
    texts = ["", "<s>", "[INST] a [/INST]", "<s>[INST] a [/INST] rest", "<s>a </s>", "<s> </s>", "<s> a [INST] </s>",
             "<s>[ROLE] a </s>", "<s>[INST] [/INST]"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(chat.parse(F.col("t")).alias("p")).collect()
    assert [r["p"] and [x and x["text"] for x in r["p"]] if r["p"] is not None else None for r in got] == \
        [None, [], None, None, [None], [None], [None], [None], [None]]


def test_query_matches_sql(spark):
    df = chat.chat_query(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = {tuple(r) for r in con.execute(chat.CHAT_SQL).fetchall()}
    got = {tuple(r) for r in df.collect()}
    assert got == want and any(r[0] == -7 and r[1] == 2 and r[3] == 21 for r in got)
