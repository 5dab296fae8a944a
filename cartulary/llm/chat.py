"""Chat formatting: prefix-target expansion with built-in functions only.

Every assistant turn becomes an example of its own: all preceding turns as
context, then that reply, which alone is trainable.  A conversation whose last
turn is not the assistant's has one more example without a trainable part, so
that no turn is lost.  A turn is written as ``### role: text </turn>`` and a
line feed; ``&``, ``###``, ``</turn>`` (and ``:`` in roles) inside texts are
escaped as entities and can be restored exactly, so no text can forge a turn.

One shuffle, by conversation.  An example holds its context, so the output
grows with the square of the turns of a conversation, as the method has it.

Defined results: a null text or role is empty; a null turn comes first; equal
turns are ordered by role and text; repeated rows are turns of their own; a null
conversation id is a conversation; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", " </turn>\n"
#: (literal, entity); the entity mark itself comes first when escaping and last when restoring.
ENTITIES = (("&", "&amp;"), ("###", "&head;"), ("</turn>", "&end;"))
ROLE_ENTITIES = (*ENTITIES, (":", "&colon;"))


def escape(text: Column, entities: tuple = ENTITIES) -> Column:
    for plain, entity in entities:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def restore(text: Column, entities: tuple = ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def expand_prefix_targets(conversations: DataFrame) -> DataFrame:
    """conv_id, example (number of turns it holds), formatted, loss_start, loss_chars (code points in ``formatted``), final (holds all turns)."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    written = F.transform(
        "_turns",
        lambda t: F.struct(
            (t["role"] == "assistant").alias("target"),
            F.concat(F.lit(HEAD), escape(t["role"], ROLE_ENTITIES), F.lit(": ")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    turns = whole.select("conv_id", F.size("_turns").alias("_n"), written.alias("_w"))
    examples = turns.select("conv_id", "_n", "_w", F.posexplode("_w").alias("_i", "_t")).where("_t.target or _i = _n - 1")
    before = F.transform(F.slice("_w", F.lit(1), F.col("_i")), lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    prompt = F.concat(F.array_join(before, ""), F.col("_t.head"))
    return examples.select("conv_id", "_n", "_i", "_t", prompt.alias("_prompt")).select(
        "conv_id",
        (F.col("_i") + 1).cast("bigint").alias("example"),
        F.concat("_prompt", "_t.body", F.lit(END)).alias("formatted"),
        F.length("_prompt").cast("bigint").alias("loss_start"),
        F.when(F.col("_t.target"), F.length("_t.body")).otherwise(0).cast("bigint").alias("loss_chars"),
        (F.col("_i") == F.col("_n") - 1).alias("final"),
    )


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted example."""
    parts = F.split(formatted, END)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            restore(F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), ": ", 1), ROLE_ENTITIES).alias("role"),
            restore(F.regexp_replace(p, "^### [^:]*: ", "")).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted examples: turns, trainable text and their digests."""
    loss = F.struct("example", F.expr("substring(formatted, cast(loss_start + 1 as int), cast(loss_chars as int))").alias("text"))
    per = examples.groupBy("conv_id").agg(
        F.max(F.when(F.col("final"), F.col("formatted"))).alias("_all"),
        F.sort_array(F.collect_list(loss)).alias("_loss"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    trained = F.array_join(F.transform("_loss", lambda x: restore(x["text"])), "")
    read = per.select("conv_id", "formatted_chars", parse(F.col("_all")).alias("_turns"), trained.alias("_trained"))
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("_trained").cast("bigint").alias("loss_chars"),
        F.sha2("_trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )
