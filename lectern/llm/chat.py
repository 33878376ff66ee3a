"""Chat formatting that is proven by parsing it back, in DataFrame functions only.

Grammar: a conversation is its turns one after another; a turn is `<s>[TAG] body [/TAG]</s>` with the tag INST for
user, SYS for system, ANS for assistant, and `ROLE:` with the role's bytes in hex for any other role. In a body `\\x`
stands for the character x. Control strings (`<s>`, `</s>`, and what starts like a tag) belong to the grammar alone.

Each turn is rendered as it is, parsed, and compared to its source; if a control string stands in the body or the
parsed text differs, the body is escaped (a backslash before each backslash and inside each control string), which the
grammar always reads back. Then turns are joined in order, the whole is parsed again, and compared once more: `intact`.

Turns are ordered by turn, role and text; null turns come first, null texts and roles are empty. A conversation's turns
have to fit in one row, as its rendered text is one value; a null conversation id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = {"user": "INST", "system": "SYS", "assistant": "ANS"}
#: What may not stand in a body as it is; the first group is the character that an escape goes behind.
CONTROL = r"([<\[])(/?(?:s>|INST|SYS|ANS|ROLE))"
TURN = r"(?s)<s>\[(INST|SYS|ANS|ROLE:[0-9A-F]*)\] (.*?) \[/\1\]</s>"
#: Characters of a turn besides its body and twice its tag.
FRAME = len("<s>[] ") + len(" [/]</s>")


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tag_of(role: Column) -> Column:
    out = F.concat(F.lit("ROLE:"), F.hex(role.cast("binary")))
    for name, tag in TAGS.items():
        out = F.when(role == name, F.lit(tag)).otherwise(out)
    return out


def role_of(tag: Column) -> Column:
    out = F.decode(F.unhex(F.substring(tag, len("ROLE:") + 1, 1 << 30)), "utf-8")
    for name, own in TAGS.items():
        out = F.when(tag == own, F.lit(name)).otherwise(out)
    return out


def rendered(tag: Column, body: Column) -> Column:
    return F.concat(F.lit("<s>["), tag, F.lit("] "), body, F.lit(" [/"), tag, F.lit("]</s>"))


def parsed(text: Column) -> Column:
    """Tags and bodies of a rendered text as an array of (tag, body); what the grammar doesn't cover shows in the lengths."""
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(TURN), 1).alias("tag"), F.regexp_extract_all(text, F.lit(TURN), 2).alias("body"))


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per row of df: conv, turn, role, text, tag, body; the body is escaped only if parsing it back asks for that."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tag", tag_of(F.col("role")))
    back = F.regexp_extract_all(rendered(F.col("tag"), F.col("text")), F.lit(TURN), 2)
    # with the space that follows each body, which a last backslash would take for its own
    same = unescaped(F.concat(F.get(back, F.lit(0)), F.lit(" "))) == F.concat("text", F.lit(" "))
    plain = ~F.col("text").rlike(CONTROL) & (F.size(back) == 1) & F.coalesce(same, F.lit(False))
    return rows.withColumn("body", F.when(plain, F.col("text")).otherwise(escaped(F.col("text"))))


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, formatted text, loss_spans (start and length of each body under the loss mask, from 1, in code points), turns read back (role, text) and intact."""
    each = turns(df, conv_col, turn_col, role_col, text_col)
    packed = each.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "tag", "body"))).alias("source"))
    joined = packed.select("conv", "source", F.array_join(F.transform("source", lambda t: rendered(t["tag"], t["body"])), "").alias("formatted"))
    read = joined.withColumn("parts", parsed(F.col("formatted")))
    read = read.withColumn("turns", F.transform("parts", lambda p: F.struct(role_of(p["tag"]).alias("role"), unescaped(p["body"]).alias("text"))))
    covered = F.aggregate("parts", F.lit(0), lambda n, p: n + FRAME + 2 * F.length(p["tag"]) + F.length(p["body"]))
    intact = (covered == F.length("formatted")) & (F.col("turns") == F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        body = acc["at"] + F.lit(len("<s>[] ")) + F.length(p["tag"])
        span = F.struct(body.alias("start"), F.length(p["body"]).alias("length"))
        masked = role_of(p["tag"]) == F.lit(loss_role)
        return F.struct((acc["at"] + FRAME + 2 * F.length(p["tag"]) + F.length(p["body"])).alias("at"), F.when(masked, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("parts", start, add, lambda acc: acc["spans"])
    return read.select(F.col("conv").alias(conv_col), "formatted", spans.alias("loss_spans"), "turns", intact.alias("intact"))


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of what is read back from format_chats(): turns, the text under the loss mask, and lengths."""
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"], s["length"]))), "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "intact",
    )
