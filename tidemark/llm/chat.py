"""Chat formatting with a grammar round trip, with DataFrame functions only.

Grammar of the rendered text::

    conversation = turn*
    turn         = "<s>[INST]" mark role "[/INST]" text "</s>"
    mark         = "" or "\\\\"  (role and text are escaped)

The deterministic parser cuts at the first ``</s>``, then at the first
``[/INST]``. Every turn is rendered as it stands, parsed again and compared
with its source; where they differ, role and text are escaped: a backslash
becomes ``\\\\b`` and each control string a backslash and its letter, so no
control string is left. The whole conversation is parsed and compared once
more; should it differ, all its turns are escaped, and the result is parsed
and compared again: a text that would not be read back fails the job.

Segments carry the loss mask: the texts of assistant turns and nothing else.

Cases: null text is empty; a null role is the empty role; turns with equal
numbers go by role and text, and repeated rows are turns of their own; a null
turn number sorts first; rows without a conversation id form one conversation;
an empty table gives an empty table; further columns are ignored. A very long
text is formatted whole; a conversation of more than 2 GB fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .quality import _let

BEGIN, HEAD, MIDDLE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: Escapes: the letter after the backslash for each control string; "b" is the backslash.
LETTERS = {END: "e", BEGIN: "s", MIDDLE: "o", HEAD: "i"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for control, letter in LETTERS.items():
        out = F.replace(out, F.lit(control), F.lit("\\" + letter))
    return out


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text stands before its letter, so letters can be replaced one after another, the backslash last."""
    for control, letter in LETTERS.items():
        text = F.replace(text, F.lit("\\" + letter), F.lit(control))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def header(role: Column, escaped: Column) -> Column:
    return F.concat(F.lit(BEGIN + HEAD), F.when(escaped, F.concat(F.lit("\\"), escape(role))).otherwise(role), F.lit(MIDDLE))


def body(text: Column, escaped: Column) -> Column:
    return F.when(escaped, escape(text)).otherwise(text)


def parse(rendered: Column) -> Column:
    """The turns of a rendered text as array<struct<role, text>>; null where it does not follow the grammar."""
    start = len(BEGIN + HEAD)

    def turn(chunk: Column) -> Column:
        inner = F.substring(chunk, start + 1, 1 << 30)
        role = F.substring_index(inner, MIDDLE, 1)
        text = F.substring(inner, F.length(role) + 1 + len(MIDDLE), F.lit(1 << 30))
        escaped = F.startswith(role, F.lit("\\"))
        good = F.startswith(chunk, F.lit(BEGIN + HEAD)) & F.contains(inner, F.lit(MIDDLE))
        plain = F.struct(role.alias("role"), text.alias("text"))
        bare = F.struct(unescape(F.substring(role, 2, 1 << 30)).alias("role"), unescape(text).alias("text"))
        return F.when(good, F.when(escaped, bare).otherwise(plain))

    chunks = F.split(rendered, END, -1)
    turns = _let(chunks, lambda c: F.transform(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), turn))
    return F.when(rendered == "", F.array().cast("array<struct<role:string,text:string>>")).when(F.endswith(rendered, F.lit(END)), turns)


def _segments(turns: Column, escaped) -> Column:
    """Three segments a turn, with the loss mask."""
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.flatten(F.transform(turns, lambda t: F.array(segment(header(t["role"], escaped(t)), F.lit(False)), segment(body(t["text"], escaped(t)), t["role"] == "assistant"), segment(F.lit(END), F.lit(False)))))


def _joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def _pairs(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_chats(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Rows (conv_id, formatted, segments, escaped_turns), one for each conversation.

    ``segments`` is array<struct<text, loss>>; ``formatted`` is their texts in
    a row. One shuffle, of the turns by conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = turns.select(F.col(id_col).alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rendered = F.concat(header(F.col("role"), F.lit(False)), F.col("text"), F.lit(END))
    same = parse(rendered) == F.array(F.struct("role", "text"))
    checked = plain.withColumn("escaped", ~F.coalesce(same, F.lit(False)))
    whole = checked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "escaped"))).alias("turns"))
    first = whole.withColumn("segments", _segments(F.col("turns"), lambda t: t["escaped"])).withColumn("formatted", _joined(F.col("segments")))
    again = F.coalesce(parse(F.col("formatted")) == _pairs(F.col("turns")), F.lit(False))
    second = first.withColumn("identical", again)
    final = second.withColumn("segments", F.when(F.col("identical"), F.col("segments")).otherwise(_segments(F.col("turns"), lambda t: F.lit(True))))
    count = F.when(F.col("identical"), F.size(F.filter("turns", lambda t: t["escaped"]))).otherwise(F.size("turns"))
    lost = F.raise_error(F.concat(F.lit("a conversation is not read back as it was: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    kept = _let(_joined(F.col("segments")), lambda text: F.when(parse(text) == _pairs(F.col("turns")), text).otherwise(lost.cast("string")))
    return final.select("conv_id", F.when(F.col("identical"), F.col("formatted")).otherwise(kept).alias("formatted"), "segments", count.alias("escaped_turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output says: turns parsed from the formatted text, and the text under the loss mask, unescaped."""
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")

    def lost(s: Column, i: Column) -> Column:
        mark = F.startswith(F.get("segments", i - 1)["text"], F.lit(BEGIN + HEAD + "\\"))
        return F.when(s["loss"], F.when(mark, unescape(s["text"])).otherwise(s["text"])).otherwise("")

    loss = F.array_join(F.transform("segments", lost), "")
    return parsed.withColumn("_loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
