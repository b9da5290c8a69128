"""Chat formatting by prefix-target expansion, in SQL functions only.

Every assistant turn becomes one example: all turns before it as context, and
only its reply under the loss mask. Turns that follow the last assistant turn
(or all turns, where there is no assistant) go into one example without a
target, so the output holds every turn. A turn is written as
``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts the escape
character and the opening of a control string are replaced reversibly
(``\\`` by ``\\s``, ``<|`` by ``\\l``; a newline in a role by ``\\n``), so no text can
forge a turn.

The mask of an example is a pair of code-point offsets into ``formatted``
(``target_start`` from 0, ``target_chars``), the escaped reply alone.

Defined results: turns are ordered by turn (nulls first), role and text; equal turns
and repeated rows all stay. Null text and null role are empty strings. Rows
with a null conv_id form one conversation. An empty table gives no rows.
Work and output grow with the sum of the prefixes: a conversation of n turns
yields up to n(n+1)/2 turns, which is what the expansion asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, newline: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("\\l"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if newline else out


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: every backslash opens a pair, so the backslash itself comes last."""
    out = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<|"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def format_examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, n_turns, formatted, target_start, target_chars.

    ``example`` counts from 0 within the conversation; ``target_start`` is null
    in the example that only holds trailing turns.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    conv = (conversations.groupBy(F.col("conv_id").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns")))
    head = lambda t: F.concat(F.lit(START), escape(t["role"], newline=True), F.lit("\n"))
    body = lambda t: escape(t["text"])
    conv = conv.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == "assistant").alias("reply"), head(t).alias("head"), body(t).alias("body"))).alias("turns"))
    last = F.size("turns") - 1
    ends = F.filter(F.sequence(F.lit(0), last),
                    lambda i: F.element_at("turns", i + 1)["reply"] | (i == F.size("turns") - 1))
    one = conv.select("conv_id", "turns", F.posexplode(ends).alias("example", "last_turn"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))
    final = F.element_at("turns", F.col("last_turn") + 1)
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("last_turn")), whole), "")
    one = one.select("conv_id", "example", (F.col("last_turn") + 1).alias("n_turns"), context.alias("context"),
                     final.alias("final"))
    return one.select(
        "conv_id", "example", "n_turns",
        F.concat("context", whole(F.col("final"))).alias("formatted"),
        F.when(F.col("final.reply"), F.length("context") + F.length("final.head")).alias("target_start"),
        F.when(F.col("final.reply"), F.length("final.body")).alias("target_chars"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> parsed back out of a formatted text."""
    raw = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda s: s != "")
    cut = lambda s: F.substr(s, F.lit(len(START) + 1))
    return F.transform(raw, lambda s: F.struct(
        unescape(F.substring_index(cut(s), "\n", 1)).alias("role"),
        unescape(F.regexp_replace(cut(s), r"\A[^\n]*\n", "")).alias("text")))


def summarise(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: turns, and what lies under the loss mask.

    The longest example holds every turn. Masked texts are joined in example order.
    """
    target = F.substr(F.col("formatted"), F.col("target_start") + 1, F.col("target_chars"))
    per = examples.select(
        "conv_id", "example", F.length("formatted").alias("chars"), "formatted",
        F.when(F.col("target_start").isNotNull(), unescape(target)).alias("reply"))
    out = per.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("replies", lambda r: F.coalesce(r["reply"], F.lit(""))), "")
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumn("turns", read_turns(F.col("longest"))).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(text, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.col("formatted_chars").cast("long").alias("formatted_chars")))
