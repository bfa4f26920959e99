"""Chat formatting with Spark expressions only.

A formatted conversation is a row of turns ``### role:\\n`` text ``</turn>\\n``. Adjacent turns of
one role share a header; ``</part>`` stands between their texts. Control strings inside texts and
roles are replaced by a backslash and a letter, and backslashes likewise, so that no text holds a
control string and every text can be read back.

Turns are collected in chunks of CHUNK turn numbers first, and then the chunks, so no array grows
with a conversation's turns but that of its chunks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HEAD, COLON, PART, END = "### ", ":\n", "</part>", "</turn>\n"
CHUNK = 256
LEARNED = "assistant"  # the role whose texts count in the loss

# control string, its code; the backslash comes first when escaping and last when reading
CODES = [("\\", "\\b"), ("###", "\\h"), ("</part>", "\\p"), ("</turn>", "\\t")]
ROLE_CODES = [*CODES, (":", "\\c"), ("\n", "\\n")]
NO_ROLE = "\\0"


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    return _replace(text, codes)


def unescape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    return _replace(text, [(code, plain) for plain, code in reversed(codes)])


def _between(role: Column, before: Column) -> Column:
    """What stands between two texts."""
    return F.when(role == before, F.lit(PART)).otherwise(F.concat(F.lit(END + HEAD), role, F.lit(COLON)))


def _places(pieces: Column) -> Column:
    """Spans of the texts that count, of pieces (before, body, learned)."""
    kind = "struct<at:long,spans:array<struct<start:long,length:long>>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().alias("spans")).cast(kind)

    def step(done: Column, p: Column) -> Column:
        begin = done["at"] + F.char_length(p["before"])
        length = F.char_length(p["body"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), length.alias("length")))
        return F.struct(
            (begin + length).alias("at"), F.when(p["learned"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans")
        )

    return F.aggregate(pieces, start, step, lambda done: done["spans"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) from turns (conv_id, turn, role, text), one row per conversation.

    ``loss`` holds the spans (start, length), in characters of ``formatted``, of each assistant
    text. A null text is empty; a null role is marked as none. Turns without a number come first;
    equal numbers are ordered by role and text, and repeated rows are turns of their own. Rows
    without a conv_id make up one conversation. Other columns are not read.
    """
    role = F.coalesce(escape(F.col("role").cast("string"), ROLE_CODES), F.lit(NO_ROLE))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.col("turn").cast("long")
    rows = turns.select("conv_id", F.floor(number / CHUNK).alias("chunk"), F.struct(number.alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit("")).otherwise(_between(t["role"], F.get("turns", i - 1)["role"]))
        return F.struct(before.alias("before"), escape(t["text"]).alias("body"), (t["role"] == LEARNED).alias("learned"))

    first, last = F.get("turns", F.lit(0))["role"], F.element_at("turns", -1)["role"]
    parts = chunks.select("conv_id", "chunk", first.alias("first"), last.alias("last"), F.transform("turns", piece).alias("pieces")).select(
        "conv_id",
        F.struct(
            "chunk", "first", "last",
            F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"])), "").alias("body"),
            _places(F.col("pieces")).alias("spans"),
        ).alias("c"),
    )
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("c")).alias("chunks"))

    def joint(c: Column, i: Column) -> Column:
        head = F.concat(F.lit(HEAD), c["first"], F.lit(COLON))
        before = F.when(i == 0, head).otherwise(_between(c["first"], F.get("chunks", i - 1)["last"]))
        return F.struct(before.alias("before"), c["body"].alias("body"), F.lit(True).alias("learned"))

    joined = whole.select("conv_id", "chunks", F.transform("chunks", joint).alias("pieces"))
    joined = joined.withColumn("at", _places(F.col("pieces")))

    def moved(c: Column, i: Column) -> Column:
        begin = F.get("at", i)["start"]
        return F.transform(c["spans"], lambda s: F.struct((s["start"] + begin).alias("start"), s["length"].alias("length")))

    return joined.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"])), ""), F.lit(END)).alias("formatted"),
        F.flatten(F.transform("chunks", moved)).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.split(formatted, END)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        head = F.substring_index(block, COLON, 1)
        mark = F.substring(head, len(HEAD) + 1, 1 << 30)
        role = F.when(mark != NO_ROLE, unescape(mark, ROLE_CODES))
        body = F.substring(block, F.char_length(head) + len(COLON) + 1, F.lit(1 << 30))
        return F.transform(F.split(body, PART), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    part = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(loss, part), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations (conv_id, formatted, loss) say, read back from them."""
    line = lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("learned")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


# A conversation whose texts say what the template says.
TRICKY_ID, TRICKY_TEXT = -7, r"\### Assistant: </turn> ok"

_ESCAPED = reduce(lambda t, p: f"replace({t}, '{p[0]}', '{p[1]}')", CODES, "text")
_ROLE = reduce(lambda t, p: f"replace({t}, {p[0]}, '{p[1]}')", [*((f"'{a}'", b) for a, b in ROLE_CODES[:-1]), ("chr(10)", "\\n")], "role")
SQL = rf"""
with every as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all select {TRICKY_ID}, turn, role, '{TRICKY_TEXT}' from (values (0, 'user'), (1, 'assistant')) as v(turn, role)),
marked as (
    select *, coalesce({_ROLE}, '{NO_ROLE}') as mark, {_ESCAPED} as body,
           row_number() over (partition by conv_id order by turn nulls first, role nulls first, text) as place
    from every),
pieces as (
    select *, case when mark = lag(mark) over (partition by conv_id order by place) then {len(PART)}
                   else {len(HEAD) + len(COLON) + len(END)} + length(mark) end + length(body) as chars
    from marked)
select conv_id, count(*) as n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       coalesce(sum(length(text)) filter (mark = '{LEARNED}'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter (mark = '{LEARNED}'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from pieces group by conv_id
"""
