r"""Chat formatting with typed content parts, with DataFrame operations only.

A turn has a role and either a text or ordered parts, structs (type, text, ref, width, height, seconds, pages) of type
text, image, audio or document. The visitor flattens parts in order: text as itself, any other part as a placeholder
``<type:n>``, n counting the turn's attachments, and keeps for each attachment its type, reference, place and the
number of tokens the placeholder stands for.

Template: ``<turn>`` role ``<says>`` content ``</turn>`` for each turn. Inside roles and texts a backslash becomes two
and ``<`` becomes backslash l; so ``<`` marks control strings only, and parsing back is a literal split.

A plain text is visited as its one text part. Defined results: null texts and roles are empty; a null turn comes first;
turns that tie stand by role, then by their text as it was before escaping, then by their attachments; a null conv_id is
a conversation of its own; an empty table gives an empty one; an unknown part type, and a null one, is flattened as a
document; other columns play no part. A conversation is one row of the output, so it must fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.llm.common import table

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
#: Tokens that a placeholder stands for: an image has one for each square patch, audio and documents so many a second and a page.
PATCH, PER_SECOND, PER_PAGE = 14, 25, 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    """Escaped text holds no ``<``, which stands in for a backslash until the two change places."""
    return F.translate(F.replace(F.replace(text, F.lit("\\\\"), F.lit("<")), F.lit("\\l"), F.lit("\\")), "<\\", "\\<")


def tokens_of(part: Column) -> Column:
    patches = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["type"] == "text", F.lit(0))
        .when(part["type"] == "image", F.greatest(patches, F.lit(1)))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0)) * PER_SECOND))
        .otherwise(F.coalesce(part["pages"], F.lit(1)) * PER_PAGE)
        .cast("long")
    )


def text_part(text: Column) -> Column:
    """A text as ordered parts: itself."""
    absent = (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))
    fields = [F.lit("text").alias("type"), text.cast("string").alias("text"), *(F.lit(None).cast(kind).alias(name) for name, kind in absent)]
    return F.array(F.struct(*fields))


def flattened(parts: Column) -> tuple[Column, Column, Column]:
    """The content of ordered parts, the same before its texts are escaped, and their attachments."""
    kind = lambda p: F.when(p["type"].isin("image", "audio"), p["type"]).otherwise(F.lit("document"))
    is_text = lambda p: F.coalesce(p["type"] == "text", F.lit(False))
    seen = F.filter(F.transform(parts, lambda p, i: F.struct(p.alias("part"), i.alias("place"))), lambda x: ~is_text(x["part"]))
    attached = F.transform(
        seen,
        lambda x, n: F.struct(
            (n + 1).alias("n"), kind(x["part"]).alias("type"), x["part"]["ref"].alias("ref"), x["place"].alias("place"),
            tokens_of(x["part"]).alias("tokens"),
        ),
    )
    placeholder = lambda p, i: F.concat(F.lit("<"), kind(p), F.lit(":"), F.element_at(F.filter(attached, lambda a: a["place"] == i), 1)["n"].cast("string"), F.lit(">"))
    visited = lambda write: F.concat_ws("", F.transform(parts, lambda p, i: F.when(is_text(p), write(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder(p, i))))
    return visited(escaped), visited(lambda text: text), attached


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, spans (the place of each turn, its content's and its loss flag, in code points), attachments.

    turns: conv_id, turn, role, and text or parts."""
    parts = F.col("parts") if "parts" in turns.columns else text_part(F.col("text"))
    visits = [flattened(parts)]
    if {"parts", "text"} <= set(turns.columns):  # a row without parts has its text
        visits.append(flattened(text_part(F.col("text"))))
    content, raw, attached = (F.when(F.col("parts").isNull(), plain).otherwise(own) for own, plain in zip(*visits, strict=True)) if len(visits) > 1 else visits[0]
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    laid = turns.select(
        "conv_id",
        F.col("turn").alias("_turn"),
        role.alias("_role"),
        F.concat(F.lit(OPEN), escaped(role), F.lit(SAYS)).alias("_head"),
        content.alias("_content"),
        raw.alias("_raw"),
        attached.alias("_attached"),
    )
    size = F.length("_head") + F.length("_content") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_raw", "_attached")
    placed = laid.withColumns({"_at": F.row_number().over(order), "_start": F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    turn = F.struct(
        F.col("_at").alias("at"),
        F.concat("_head", "_content", F.lit(CLOSE)).alias("block"),
        F.struct(
            F.col("_start").alias("turn_start"),
            (F.col("_start") + F.length("_head")).alias("start"),
            (F.col("_start") + F.length("_head") + F.length("_content")).alias("end"),
            (F.col("_role") == "assistant").alias("loss"),
        ).alias("span"),
        F.transform("_attached", lambda a: F.struct(F.col("_at").alias("turn"), a["n"].alias("n"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attached"),
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn), lambda a, b: a["at"] - b["at"]).alias("_turns"))
        .select(
            "conv_id",
            F.concat_ws("", F.transform("_turns", lambda t: t["block"])).alias("formatted"),
            F.transform("_turns", lambda t: t["span"]).alias("spans"),
            F.flatten(F.transform("_turns", lambda t: t["attached"])).alias("attachments"),
        )
    )


def parsed(formatted: DataFrame) -> DataFrame:
    """formatted with turns, an array of (role, text) read back from the formatted string, and loss, the text under the mask."""
    blocks = F.slice(F.split("formatted", CLOSE), 1, F.greatest(F.lit(0), F.size(F.split("formatted", CLOSE)) - 1))
    says = lambda b: F.split(F.substring(b, len(OPEN) + 1, 2147483647), SAYS)
    turn = lambda b: F.struct(unescaped(says(b)[0]).alias("role"), unescaped(says(b)[1]).alias("text"))
    masked = lambda b, s: F.when(s["loss"], unescaped(F.substring(b, (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))).otherwise(F.lit(""))
    return (
        formatted.withColumn("_blocks", blocks)
        .withColumn("turns", F.transform("_blocks", turn))
        .withColumn("loss", F.concat_ws("", F.zip_with("_blocks", "spans", masked)))
        .drop("_blocks")
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    turns = turns.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    digest = F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256)
    return parsed(format_turns(turns)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest.alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )
