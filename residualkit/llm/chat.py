"""Chat formatting with typed content parts.

Everything here is DataFrame functions; no Python runs on the executors.

A turn is a role and a list of parts: text, image, audio, document. A visitor
goes over the parts in order. Text is escaped; every other part becomes a
placeholder and is recorded as an attachment with its reference, its place and
the number of tokens it expands to. A turn is written as

    <|im_start|>role<|im_sep|>parts<|im_end|>

In roles and texts a backslash is put after every ``<`` and every backslash, so
no control string can stand in them, also not across two parts, and taking
the backslashes off again gives the text back exactly. The loss mask is a list of
spans in code points of the formatted conversation: the texts of the assistant.

Turns are formatted before they are shuffled. A conversation is one output row,
so all of its turns meet in one task, as its order demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import known

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,tokens:int>"
# Tokens that a part expands to where it does not say so itself.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}


def escape(text: Column) -> Column:
    return F.regexp_replace(known(text), r"([\\<])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<])\\", "$1")


def text_part(text: Column) -> Column:
    """A turn's parts for tables that hold only text."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"),
        text.alias("text"),
        none.cast("string").alias("ref"),
        none.cast("int").alias("tokens"),
    )
    return F.array(part)


def _written(part: Column) -> Column:
    """A part as it stands in the conversation. An unknown type is a document."""
    kind = F.coalesce(part["type"], F.lit("text"))
    placeholder = F.lit("<|document|>")
    for name in EXPANDED:
        placeholder = F.when(kind == name, F.lit(f"<|{name}|>")).otherwise(placeholder)
    return F.when(kind == "text", escape(part["text"])).otherwise(placeholder)


def _tokens(part: Column) -> Column:
    usual = F.lit(EXPANDED["document"])
    for name, n in EXPANDED.items():
        usual = F.when(part["type"] == name, F.lit(n)).otherwise(usual)
    return F.coalesce(part["tokens"], usual)


def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation from rows ``conv_id, turn, role, parts``.

    Returns ``conv_id``, ``n_turns``, ``formatted``, ``loss_spans`` (start and
    end in code points, end exclusive), ``attachments`` (turn, part, type, ref,
    tokens, start) and ``expanded_tokens``, the sum over the attachments.

    Turns are ordered by ``turn`` (NULL first), then role, then content; repeated
    rows are turns of their own. A NULL role or text is empty, NULL parts are
    none. Rows with a NULL ``conv_id`` form one conversation. An empty table
    gives an empty result. Other columns are not looked at.
    """
    none = F.array().cast(f"array<{PART}>")
    rows = turns.select(
        "conv_id", "turn", known("role").alias("role"), F.coalesce(F.col("parts"), none).cast(f"array<{PART}>").alias("parts")
    )
    written = rows.select(
        "*", escape(F.col("role")).alias("head"), F.transform("parts", lambda p: _written(p)).alias("pieces")
    )
    pieces = written.select(
        "*",
        F.concat(F.lit(START), F.col("head"), F.lit(SEP), F.array_join("pieces", ""), F.lit(END)).alias("piece"),
        F.transform(F.sequence(F.lit(1), F.size("pieces") + 1), lambda i: F.length(F.array_join(F.slice("pieces", 1, i - 1), ""))).alias(
            "ends"
        ),
        (F.length("head") + len(START) + len(SEP)).alias("body"),
    )
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        "*",
        F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)).alias("begin"),
        F.row_number().over(by_turn).alias("place"),
    )
    base = F.col("begin") + F.col("body")
    numbers = F.when(F.size("parts") > 0, F.sequence(F.lit(1), F.size("parts"))).otherwise(F.array().cast("array<int>"))
    parts, ends = F.col("parts"), F.col("ends")

    def is_text(i: Column) -> Column:
        return F.coalesce(parts[i - 1]["type"], F.lit("text")) == "text"

    spans = F.transform(
        F.filter(numbers, lambda i: is_text(i) & (ends[i] > ends[i - 1])),
        lambda i: F.struct((base + ends[i - 1]).alias("start"), (base + ends[i]).alias("end")),
    )
    attached = F.transform(
        F.filter(numbers, lambda i: ~is_text(i)),
        lambda i: F.struct(
            F.col("turn").alias("turn"),
            i.alias("part"),
            parts[i - 1]["type"].alias("type"),
            parts[i - 1]["ref"].alias("ref"),
            _tokens(parts[i - 1]).alias("tokens"),
            (base + ends[i - 1]).alias("start"),
        ),
    )
    row = F.struct(
        "place",
        "piece",
        F.when(F.col("role") == loss_role, spans).otherwise(F.filter(spans, lambda s: F.lit(False))).alias("spans"),
        attached.alias("attached"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("t"))
    attachments = F.flatten("t.attached")
    return gathered.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join("t.piece", "").alias("formatted"),
        F.flatten("t.spans").alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """``(role, text)`` of every turn, read back from a formatted conversation; placeholders stay as they are."""
    pieces = F.split(formatted, r"\Q" + END + r"\E", -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(START) + 1)), r"\Q" + SEP + r"\E", 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(turns, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
        ),
        "",
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back from formatted conversations."""
    turns = read_turns(F.col("formatted"))
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
