"""Chat format: typed content parts become one text per conversation, with attachments, token counts and a loss mask.

A turn is a list of parts (text, image, audio or document). A visitor walks them in order: text is escaped, any other part
becomes a placeholder, and its reference and number of tokens are recorded beside it. Turns are marked

    <|im_start|>role NEWLINE content <|im_end|> NEWLINE

Inside texts and roles every `<`, backslashes, `|` gets one more backslash, so no text can hold a control string, and reading
back takes it away again. Roles also write line breaks as `\\n`.

Everything is built from DataFrame functions, turn by turn; only finished turns meet, one conversation's in one row.
Null texts, roles and part lists are empty. A null kind is text; an unknown kind is a placeholder of its own name. Turns
follow their number (null first), then role and content, so equal rows stay and are interchangeable. Null conv_ids form one
conversation. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,tokens:int>"
START, END = "<|im_start|>", "<|im_end|>\n"
TEXT = "text"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # A doubled backslash is set aside first, so that it cannot pair with an `n` after it.
    aside = F.replace(role, F.lit("\\\\"), F.lit("<|"))
    return unescape(F.replace(F.replace(aside, F.lit("\\n"), F.lit("\n")), F.lit("<|"), F.lit("\\")))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit(TEXT).alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def _visit(part: Column) -> Column:
    """A part as it stands in the content."""
    kind = F.coalesce(part["kind"], F.lit(TEXT))
    text = escape(F.coalesce(part["text"], F.lit("")))
    return F.when(kind == TEXT, text).otherwise(F.concat(F.lit("<|"), F.regexp_replace(kind, r"[<|>\\\s]", "_"), F.lit("|>")))


def _attachments(parts: Column) -> Column:
    """Kind, reference and expanded tokens of each part that is no text, in order."""
    others = F.filter(parts, lambda part: F.coalesce(part["kind"], F.lit(TEXT)) != TEXT)
    return F.transform(
        others,
        lambda part: F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), F.coalesce(part["tokens"], F.lit(0)).alias("tokens")),
    )


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, attachments, text) of turns (conv_id, turn, role, parts): each turn by itself."""
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col("role"), F.lit(""))
    visited = turns.select("conv_id", "turn", role.alias("role"), F.array_join(F.transform(parts, _visit), "").alias("content"), _attachments(parts).alias("attachments"))
    return visited.withColumn("text", F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"), F.col("content"), F.lit(END)))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans, attachments, n_expanded.

    loss_spans: start and length, in code points of `formatted`, of each assistant turn's content. attachments: those of all
    turns in order, each with its turn's place. n_expanded: tokens that all placeholders stand for.
    """
    ready = format_turns(turns).select(
        "conv_id",
        F.struct(
            "turn", "role", "text", F.char_length("text").alias("size"),
            F.when(F.col("role") == LEARNED_ROLE, F.char_length("content")).alias("learned"), "attachments",
        ).alias("t"),
    )
    whole = ready.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        after = (acc["at"] + t["size"]).alias("at")
        span = F.struct((acc["at"] + t["size"] - len(END) - t["learned"]).alias("start"), t["learned"].alias("length"))
        return F.struct(after, F.when(t["learned"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"))

    numbered = F.transform("t", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(i.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["text"]), "").alias("formatted"),
        F.aggregate("t", start, step, lambda acc: acc["spans"]).alias("loss_spans"),
        F.flatten(numbered).alias("attachments"),
    ).withColumn("n_expanded", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: role and content, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        content = F.substring(piece, cut + 1, F.char_length(piece) - cut - len(END))
        return F.struct(_unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescape(content).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
