"""Formatting and parsing against plain versions."""

import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from terrasieve.llm import chat_format as chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted int, loss string"
SHOWN = {"System": "system", "User": "user", "Assistant": "assistant"}


def parsed(text):
    """A plain parser: turns as (role, text, text as written)."""
    turns = []
    while text:
        assert text.startswith("### ")
        piece, _, text = text[4:].partition("</turn>\n")
        name, _, raw = piece.partition(": ")
        assert "### " not in piece and "</turn>" not in piece
        free = lambda s, marks: re.sub(rf"(?s)([{marks}])\\(\\*)(## |/turn>| )", lambda m: m[1] + m[2] + m[3] if (m[1], m[3]) in (("#", "## "), ("<", "/turn>"), (":", " ")) else m[0], s)
        turns.append((free(name[1:], "#<:") if name.startswith("\\") else SHOWN.get(name, name), free(raw, "#<"), raw))
    return turns


def rows_of(n=400, seed=1):
    rnd = random.Random(seed)
    bits = ["### ", "</turn>", "<\\/turn>", "#\\## ", "\\", "#", " ", ": ", ":", "\n", "</turn>\n", "User", "Assistant", "a", "é\U0001f600", "<", "$1"]
    some = lambda k: "".join(rnd.choice(bits) for _ in range(rnd.randrange(k)))
    return [(i // 4, i % 4, rnd.choice(["user", "assistant", "User", "\\user", "", some(4)]), some(9)) for i in range(n)]


ODD = [(None, 0, "user", "x"), (None, None, None, None), (2, None, "assistant", "first"), (2, 0, "assistant", None), (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (3, 0, "user", "### User: </turn>\n" * 20_000), (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@pytest.mark.parametrize("rows", [rows_of(), ODD])
def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    source = defaultdict(list)
    for c, turn, role, text in rows:
        source[c].append((turn is not None, turn or 0, role or "", text or ""))
    source = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in source.items()}
    formats = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert set(formats) == set(source) and all(r.intact for r in formats.values())
    for c, want in source.items():
        turns = parsed(formats[c].formatted)
        assert [t[:2] for t in turns] == want
        spans = [formats[c].formatted[s.start : s.start + s.length] for s in formats[c].loss]
        assert spans == [raw for role, _, raw in turns if role == "assistant"]
        plain = [t for t in turns if not re.search(r"#\\*## |<\\*/turn>", t[1])]
        assert all(raw == text for _, text, raw in plain)  # what doesn't conflict stays as it is
    sha = lambda s: sha256(s.encode()).hexdigest()
    for r in chat.round_trip(df).collect():
        want = source[r.conv_id]
        under = "".join(t for role, t in want if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(want), sha("".join(f"{a}\n{b}\n" for a, b in want)), len(under), sha(under), len(formats[r.conv_id].formatted))


def test_parser_refuses_what_is_no_turn(spark):
    texts = ["### User: a</turn>\n", "### User: a</turn>", "User: a</turn>\n", "### User a</turn>\n", "### User: ### b</turn>\n", "### User: a</turn>b</turn>\n", ""]
    got = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(chat.parse(F.col("t")).alias("p")).collect()]
    assert got[0][0].text == "a" and got[1] is None and got[6] == []
    assert all(p[0] is None for p in got[2:6])


def test_empty_table_and_native_plan(spark, capsys):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.round_trip(df).count() == 0
    formats = chat.format_conversations(spark.range(3).select(F.col("id").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text")))
    formats.explain()
    assert "Python" not in capsys.readouterr().out
