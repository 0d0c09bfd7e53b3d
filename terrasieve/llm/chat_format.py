r"""Chat formatting by a grammar round trip, in column expressions only.

    conversation := turn*        turn := "### " name ": " text "</turn>" newline

A parser of this grammar reads rendered turns back: it cuts at `</turn>` and a newline, takes the name up to the first `: `, and fails where
a mark stands inside a turn. A text in which a mark, or what an escaped mark looks like, occurs doesn't come back as it was; so each turn is
rendered as it is, parsed and compared with its source, and where they differ its content is escaped step by step, first the text, then
the name, until they are equal. The whole conversation is parsed and compared once more; a difference would raise an error.

Escaping puts one backslash into a mark, behind its first character, and one more where there are some already (`</turn>`, `<\/turn>`,
`<\\/turn>`); parsing takes one away. Names of the known roles are written with a capital. A name that begins with a backslash is the role
itself, with its marks escaped.

Defined results: rows are ordered by turn (null first), then role, then text. Null text and null role are empty. A null conv_id is a
conversation like any other. Repeated rows are turns of their own. An empty table gives no rows. Other columns aren't read.

Plan: one shuffle of the turns by conversation, and a staged table of the formatted texts with their loss spans, from which every result is
read back. A conversation's turns meet in one row, because its formatted text is one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import stage

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>"
ASSISTANT = "assistant"
# Roles and the names that stand for them.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
#: Marks as (first character, rest).
_TEXT_MARKS = (("#", "## "), ("<", "/turn>"))
_NAME_MARKS = (*_TEXT_MARKS, (":", " "))


def _stuffed(c: Column, marks: tuple[tuple[str, str], ...]) -> Column:
    for first, rest in marks:
        c = F.regexp_replace(c, rf"{first}(\\*){rest}", rf"{first}\\$1{rest}")
    return c


def _freed(c: Column, marks: tuple[tuple[str, str], ...]) -> Column:
    for first, rest in marks:
        c = F.regexp_replace(c, rf"{first}\\(\\*){rest}", rf"{first}$1{rest}")
    return c


def escape_text(text: Column) -> Column:
    return _stuffed(text, _TEXT_MARKS)


def unescape_text(text: Column) -> Column:
    return _freed(text, _TEXT_MARKS)


def _name(role: Column) -> Column:
    out = role
    for known, name in NAMES.items():
        out = F.when(role == known, F.lit(name)).otherwise(out)
    return out


def _role(name: Column) -> Column:
    out = name
    for known, shown in NAMES.items():
        out = F.when(name == shown, F.lit(known)).otherwise(out)
    return F.when(name.startswith("\\"), _freed(F.substring(name, 2, 1 << 30), _NAME_MARKS)).otherwise(out)


def _spelled(role: Column) -> Column:
    return F.concat(F.lit("\\"), _stuffed(role, _NAME_MARKS))


def _turn(name: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), name, F.lit(SEPARATOR), text, F.lit(CLOSE + "\n"))


def _parsed_turn(piece: Column) -> Column:
    """A turn without its closing mark as (role, text, lead, raw): lead counts what stands before its text, raw is the text as written. Null if
    it isn't a turn of the grammar."""
    rest = F.substring(piece, len(OPEN) + 1, 1 << 30)
    cut = F.instr(rest, SEPARATOR)
    raw = F.substring(rest, cut + F.lit(len(SEPARATOR)), F.lit(1 << 30))
    holds = piece.startswith(OPEN) & (cut > 0) & ~F.contains(rest, F.lit(OPEN)) & ~F.contains(rest, F.lit(CLOSE))
    turn = F.struct(_role(F.substring(rest, F.lit(1), cut - 1)).alias("role"), unescape_text(raw).alias("text"), (cut + len(OPEN) + len(SEPARATOR) - 1).alias("lead"), raw.alias("raw"))
    return F.when(holds, turn)


def _let(value: Column, use) -> Column:
    """use(value), where value is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, an array of (role, text, lead, raw); a null stands for what isn't a turn. Null where the last mark is
    missing."""

    def turns(pieces: Column) -> Column:
        return F.when(F.element_at(pieces, -1) == "", F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _parsed_turn))

    return _let(F.split(formatted, f"{CLOSE}\n", -1), turns)


def _same(formatted: Column, turns: Column) -> Column:
    """Whether parsing gives back turns, an array of (role, text)."""
    plain = F.transform(parse(formatted), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(plain == turns, F.lit(False))


def render_turn(t: Column) -> Column:
    """A turn (role, text) in the first of its spellings that parses back to it alone: as it is, its text escaped, its name spelled out, both."""
    name, text = _name(t["role"]), t["text"]
    spellings = [_turn(name, text), _turn(name, escape_text(text)), _turn(_spelled(t["role"]), text), _turn(_spelled(t["role"]), escape_text(text))]
    one = F.array(F.struct(t["role"].alias("role"), text.alias("text")))
    return F.coalesce(*[_let(s, lambda s: F.when(_same(s, one), s)) for s in spellings])


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, formatted, loss (an array of (start from 0, length) in code points: the assistant's texts as written), intact
    (whether parsing gives back the source)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    # an array's order puts null first, as the turns' order does
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    turns = grouped.select("conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    rendered = turns.select("conv_id", "turns", F.transform("turns", render_turn).alias("spelled"))
    rendered = rendered.select("conv_id", "turns", F.array_join("spelled", "").alias("formatted"))
    return rendered.select("conv_id", "formatted", loss_spans(parse(F.col("formatted"))).alias("loss"), _same(F.col("formatted"), F.col("turns")).alias("intact"))


def loss_spans(parsed: Column, role: str = ASSISTANT) -> Column:
    """Where the texts of one role stand in a formatted text, as written there: an array of (start from 0, length) in code points."""
    tail = len(CLOSE) + 1
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        length, start = F.char_length(t["raw"]), s["at"] + t["lead"]
        span = F.array(F.struct(start.cast("int").alias("start"), length.cast("int").alias("length")))
        return F.struct((start + length + tail).cast("int").alias("at"), F.when(t["role"] == role, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(parsed, zero, step, lambda s: s["spans"])


def round_trip(conversations: DataFrame, **columns: str) -> DataFrame:
    """Formats, writes, and reads back: conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars and loss_sha256
    (the text under the loss mask, unescaped), formatted_chars. A conversation that doesn't come back as it was raises an error."""
    formatted = format_conversations(conversations, **columns)
    checked = F.when(F.col("intact"), F.col("formatted")).otherwise(F.raise_error(F.lit("a formatted conversation doesn't parse back to its source")))
    held = stage(formatted.select("conv_id", checked.alias("formatted"), "loss"), "chat-formatted")
    text = F.col("formatted")
    turns = F.array_join(F.transform(parse(text), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join(F.transform("loss", lambda s: unescape_text(F.substring(text, s["start"] + 1, s["length"]))), "")
    read = held.select("conv_id", text, F.size(parse(text)).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), under.alias("under"))
    return read.select("conv_id", "n_turns", "turns_sha256", F.char_length("under").cast("long").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))
