"""Chat formatting by perspective rotation (DataFrame operations only).

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and all others as named users; a system message stays
a system message and its role is no participant.  Masks mark what is learned:
the assistant's words and the end marker after them.

    <|im_start|>system\\n...<|im_end|>\\n
    <|im_start|>user name=NAME\\n...<|im_end|>\\n
    <|im_start|>assistant\\n...<|im_end|>\\n

A rendered dialogue is cut, between messages, into parts: part k holds the
messages that start in characters [k * part_chars, (k + 1) * part_chars), so a
conversation of any length is kept whole and no group outgrows a part and one
message.  Ordinary conversations are one part.  ``part_chars=None`` gives whole renderings, however long.

A text is moved once.  Conversations that one part holds in every view (known from
sums of lengths, which move no text) are gathered by id, and their views are built
from the gathered row.  The others go a longer way: character offsets come from
running sums of lengths inside contiguous ranges of the sorted turns plus the sums of
the ranges before, so a conversation with a third of all rows is spread over tasks;
texts join their places last and meet in their parts.

Order: turn (nulls first), then speaker, then text; equal rows are all rendered.
Cases: a null role is the participant ``unknown``; a null text is empty; a
conversation of system messages alone has no participant and no row; names keep
letters, digits, ``_`` and ``-``, others become ``_``; markers inside texts get
a backslash after ``<``; a null conversation id is a conversation of its own; an
empty table gives no rows; only the four named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbi.llm.common import stored

PART_CHARS = 65_536
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


#: ids of long conversations that are broadcast; more are joined
BROADCAST_IDS = 100_000


def _header(speaker: Column, view: Column) -> Column:
    name = F.regexp_replace(speaker, "[^A-Za-z0-9_-]", "_")
    who = (F.when(speaker == SYSTEM, F.lit("system")).when(speaker == view, F.lit("assistant"))
           .otherwise(F.concat(F.lit("user name="), name)))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def _rendered(messages: Column, view: Column) -> Column:
    """Struct (text, masks) of a conversation's messages in order, seen by ``view``."""
    lines = F.transform(messages, lambda m: F.struct(
        _header(m["speaker"], view).alias("head"), F.concat(m["text"], F.lit(CLOSE + "\n")).alias("body"),
        (m["speaker"] == view).alias("learn")))

    def add(so_far: Column, line: Column) -> Column:
        start = so_far["at"] + F.char_length(line["head"])
        end = start + F.char_length(line["body"])
        mask = F.array(F.struct(start.cast("long").alias("start"), (end - 1).cast("long").alias("end")))
        return F.struct(end.alias("at"), F.when(line["learn"], F.concat(so_far["masks"], mask))
                        .otherwise(so_far["masks"]).alias("masks"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("masks"))

    # bound once, so that the lines are not built again for each use
    def both(line_list: Column) -> Column:
        return F.struct(
            F.array_join(F.transform(line_list, lambda x: F.concat(x["head"], x["body"])), "").alias("text"),
            F.aggregate(line_list, nothing, add)["masks"].alias("masks"))
    return F.get(F.transform(F.array(lines), both), 0)


def _short(rows: DataFrame) -> DataFrame:
    """Conversations that one part holds: gathered by id, every view from one row."""
    talks = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("m"))
    speakers = F.array_distinct(F.transform("m", lambda x: x["speaker"]))
    views = talks.select("conv", "m", F.explode(F.filter(speakers, lambda x: x != SYSTEM)).alias("view"))
    return views.select("conv", "view", F.lit(0).cast("long").alias("part"),
                        F.size("m").cast("long").alias("n_turns"),
                        _rendered(F.col("m"), F.col("view")).alias("r")) \
        .select("conv", "view", "part", "n_turns", "r.text", "r.masks")


def _long(rows: DataFrame, part_chars: int) -> DataFrame:
    """Conversations over several parts: places are worked out without the texts."""
    order = ["turn", "speaker", "text", "nth"]
    # contiguous ranges of the whole order; a hot conversation spans many
    ranged = stored(rows.withColumn("nth", F.monotonically_increasing_id())
                    .repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
                    .withColumn("block", F.spark_partition_id())
                    .withColumn("pos", F.monotonically_increasing_id()), "chat-turns")
    light = ranged.select("conv", "speaker", "block", "pos", F.char_length("text").alias("length"))
    views = (light.where(F.col("speaker") != SYSTEM).groupBy("conv", "speaker").count()
             .select(F.col("conv").alias("c1"), F.col("speaker").alias("view")))
    head = F.char_length(_header(F.col("speaker"), F.col("view")))
    said = (light.join(views, F.col("conv").eqNullSafe(F.col("c1")))
            .select("conv", "view", "block", "pos",
                    (head + F.col("length") + len(CLOSE) + 1).alias("chars")))
    in_block = (Window.partitionBy("conv", "view", "block").orderBy("pos")
                .rowsBetween(Window.unboundedPreceding, -1))
    placed = said.withColumn("at", F.coalesce(F.sum("chars").over(in_block), F.lit(0)))
    # what the blocks before hold: one row per conversation, view and block
    totals = said.groupBy("conv", "view", "block").agg(F.sum("chars").alias("chars"))
    earlier = (Window.partitionBy("conv", "view").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (totals.withColumn("before", F.sum("chars").over(earlier)).where("before is not null")
               .select(F.col("conv").alias("c2"), F.col("view").alias("v2"),
                       F.col("block").alias("b2"), "before"))
    start = F.coalesce("before", F.lit(0)) + F.col("at")
    # a message's places in all views: one row per message meets its text
    places = (placed.join(offsets, F.col("conv").eqNullSafe(F.col("c2"))
                          & (F.col("view") == F.col("v2")) & (F.col("block") == F.col("b2")), "left")
              .groupBy("pos").agg(F.collect_list(F.struct("view", start.alias("start"))).alias("places")))
    whole = (ranged.select("conv", "pos", "speaker", "text").join(places, "pos")
             .select("conv", "speaker", "text", F.explode("places").alias("p"))
             .select("conv", F.col("p.view").alias("view"), F.col("p.start").alias("start"),
                     F.struct(F.col("p.start").alias("start"), "speaker", "text").alias("message")))
    parts = whole.groupBy("conv", "view", F.floor(F.col("start") / part_chars).alias("part")).agg(
        F.sort_array(F.collect_list("message")).alias("m"))
    return parts.select("conv", "view", "part", F.size("m").cast("long").alias("n_turns"),
                        _rendered(F.col("m"), F.col("view")).alias("r")) \
        .select("conv", "view", "part", "n_turns", "r.text", "r.masks")


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 part_chars: int | None = PART_CHARS) -> DataFrame:
    """(conv_id, speaker, part, n_turns, text, masks) of every participant's
    rendering; masks: array<struct<start, end>> of characters of that part."""
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|im_"), F.lit("<\\|im_"))
        .alias("text"))
    if part_chars is None:
        out = _short(rows)
    else:
        # no view's rendering of a message is longer
        most = F.char_length("text") + F.char_length("speaker") + len(f"{OPEN}user name=\n{CLOSE}\n")
        sizes = rows.select("conv", most.alias("most")).groupBy("conv").agg(F.sum("most").alias("most"))
        long = stored(sizes.where(F.col("most") > part_chars).select(F.col("conv").alias("c0"),
                                                                     F.lit(True).alias("is_long")), "chat-long")
        many = long.count()
        if many:
            ids = F.broadcast(long) if many <= BROADCAST_IDS else long
            same = F.col("conv").eqNullSafe(F.col("c0"))
            out = _short(rows.join(ids, same, "left_anti")).unionByName(
                _long(rows.join(ids, same, "left_semi"), part_chars))
        else:
            out = _short(rows)
    return out.select(F.col("conv").alias(conv_col), F.col("view").alias("speaker"), "part", "n_turns",
                      "text", "masks")


def mask_text(masks: Column) -> Column:
    """``start:end`` of each mask, comma-joined."""
    return F.array_join(F.transform(masks, lambda x: F.concat_ws(
        ":", x["start"].cast("string"), x["end"].cast("string"))), ",")
