"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted. A block opens where the
role differs from the turn before, and adjacent turns of one role share a block; array
aggregation adds up the pieces' lengths, which gives the loss mask. The text is

    <|im_start|>role \\n text [<|im_more|> text]* <|im_end|> \\n   for each block

and ``loss_spans`` has the ranges of the assistant's texts in code points and in UTF-8
bytes. Inside roles and texts a backslash is doubled and one is put after the first
character of every control string, so no control string of this or of other common
templates is left, and dropping each backslash before its character gives the text
back. A newline in a role is a backslash and n, so the first newline ends the role.

An aggregation that appends to an array copies it at every step. So turns are added up
in chunks of CHUNK, then the chunks: the work is in proportion to the turns and texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

START, MORE, END = "<|im_start|>", "<|im_more|>", "<|im_end|>\n"
#: What no text may hold after escaping.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: Turns whose lengths are added up at a time.
CHUNK = 256


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.array_join(parts, "\\")


def _with(value: Column, f) -> Column:
    """f(value), where the value is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, stop, start_byte, stop_byte of texts by the role ``learn``).

    Turns are ordered by ``turn`` (null first), then role, then text, so repeated rows and ties
    have one order. A null role or text counts as empty; null identifiers form one conversation.
    Roles and texts may be of any length. Other columns are ignored. An empty table gives no
    rows. One shuffle, by the identifier; a conversation is one output string, so its turns
    meet in one task.
    """
    rows = turns.select(turns[conv_id].alias("conv_id"), turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        same = F.coalesce(F.get(F.col("turns"), i - 1)["role"] == x["role"], F.lit(False))
        head = F.when(same, F.lit(MORE)).otherwise(F.concat(F.when(i == 0, F.lit("")).otherwise(F.lit(END)), F.lit(START), _escape_role(x["role"]), F.lit("\n")))
        return F.struct(head.alias("head"), escape(x["text"]).alias("body"), (x["role"] == learn).alias("learn"))

    pieces = settled(chats, "conv_id", F.transform("turns", piece).alias("pieces"))
    size = lambda p: F.struct(F.length(p["head"]).cast("long").alias("head"), F.length(p["body"]).cast("long").alias("body"), F.octet_length(p["head"]).cast("long").alias("head_bytes"), F.octet_length(p["body"]).cast("long").alias("body_bytes"), p["learn"].alias("learn"))
    measured = settled(pieces, "conv_id", F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""), F.lit(END)).alias("formatted"), F.transform("pieces", size).alias("sizes"))
    return measured.select("conv_id", "formatted", _spans(F.col("sizes")).alias("loss_spans"))


def _spans(sizes: Column) -> Column:
    """The ranges of the bodies to learn, from running sums of the pieces' sizes."""
    zero = F.lit(0).cast("long")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")), lambda k: F.slice(sizes, k * CHUNK + 1, F.lit(CHUNK)))
    place = lambda chars, bytes_: F.struct(chars.alias("chars"), bytes_.alias("bytes"))
    total = lambda chunk: F.aggregate(chunk, place(zero, zero), lambda a, p: place(a["chars"] + p["head"] + p["body"], a["bytes"] + p["head_bytes"] + p["body_bytes"]))

    def begin(state: Column, t: Column) -> Column:
        return F.struct(place(state["at"]["chars"] + t["chars"], state["at"]["bytes"] + t["bytes"]).alias("at"), F.concat(state["all"], F.array(state["at"])).alias("all"))

    begins = F.aggregate(F.transform(chunks, total), F.struct(place(zero, zero).alias("at"), F.array().cast("array<struct<chars:long,bytes:long>>").alias("all")), begin, lambda s: s["all"])

    def step(state: Column, p: Column) -> Column:
        start, start_byte = state["at"]["chars"] + p["head"], state["at"]["bytes"] + p["head_bytes"]
        stop, stop_byte = start + p["body"], start_byte + p["body_bytes"]
        span = F.array(F.struct(start.alias("start"), stop.alias("stop"), start_byte.alias("start_byte"), stop_byte.alias("stop_byte")))
        return F.struct(place(stop, stop_byte).alias("at"), F.when(p["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:long,stop:long,start_byte:long,stop_byte:long>>")
    within = lambda chunk, at: F.aggregate(chunk, F.struct(at.alias("at"), none.alias("spans")), step, lambda s: s["spans"])
    return F.flatten(F.zip_with(chunks, begins, within))


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def cut(block: Column) -> Column:
        n = F.length(F.substring_index(block, "\n", 1))
        role = F.substring(block, F.lit(len(START) + 1), n - len(START))
        return F.struct(_unescape_role(role).alias("role"), F.split(F.substring(block, n + 2, F.length(block)), r"<\|im_more\|>", -1).alias("texts"))

    turns = F.transform(F.transform(blocks, cut), lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))))
    return F.flatten(turns)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order; found by bytes, so that no text is walked for each span."""
    cut = lambda b: F.transform(spans, lambda s: unescape(F.substring(b, (s["start_byte"] + 1).cast("int"), (s["stop_byte"] - s["start_byte"]).cast("int")).cast("string")))
    return _with(formatted.cast("binary"), cut)
