"""Multi-party dialogues rendered once from the perspective of each participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ordered import with_row_index
from clickloom.session import pin

BEGIN, END = "<|im_start|>", "<|im_end|>"
NOBODY = "unknown"
PART_TURNS = 64         # turns of a dialogue that one row of renderings holds


def turns_in_order(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role",
                   text: str = "text") -> DataFrame:
    """Written table (conv, ordinal, speaker, text): turns numbered gaplessly from 0 inside their conversation.

    Ties of the turn number go by speaker and text, nulls first.  A null speaker is called ``unknown``, a null text is empty, a null
    conversation is a conversation.  Numbering goes by ranges of the whole order, so a conversation with a third of all turns is not one task.
    """
    rows = df.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(speaker).cast("string"), F.lit(NOBODY)).alias("speaker"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    numbered = pin(with_row_index(rows, ["conv", "turn", "speaker", "text"], "_place"), "chat-turns")
    first = pin(numbered.groupBy(F.col("conv").alias("_conv")).agg(F.min("_place").alias("_first")), "chat-starts")
    return (numbered.join(first, F.col("conv").eqNullSafe(F.col("_conv")))
            .select("conv", (F.col("_place") - F.col("_first")).alias("ordinal"), "speaker", "text"))


def perspectives(turns: DataFrame, system: str = "system") -> DataFrame:
    """Segments (conv, participant, ordinal, header, body, train) of every dialogue from every participant's side.

    The participant's own turns are the assistant's and are trained on (``train``: the mask over ``body``, which ends
    with the end mark); the others are users with a name.  Turns of ``system`` are system turns for
    everybody and its speaker is no participant.  Control marks inside texts or names are broken up, so that a
    text cannot open a turn.  A dialogue of system turns only has no perspective.
    """
    people = pin(turns.filter(F.col("speaker") != system).select(F.col("conv").alias("_conv"), F.col("speaker").alias("participant"))
                 .distinct(), "chat-participants")

    def plain(c: str):
        return F.replace(F.col(c), F.lit("<|im_"), F.lit("<| im_"))

    own = F.col("speaker") == F.col("participant")
    name = F.regexp_replace(plain("speaker"), r"[\r\n]+", " ")
    role = (F.when(F.col("speaker") == system, F.lit("system")).when(own, F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), name)))
    return turns.join(people, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        "conv", "participant", "ordinal", F.concat(F.lit(BEGIN), role, F.lit("\n")).alias("header"),
        F.concat(plain("text"), F.lit(END + "\n")).alias("body"), own.alias("train"))


def _rendered(segments: DataFrame, *keys: str) -> DataFrame:
    """One row for each of ``keys``: its segments joined in order, and begin and end of the trained characters in that text."""
    parts = F.array_sort(F.collect_list(F.struct("ordinal", "header", "body", "train")))
    rows = segments.groupBy(*keys).agg(parts.alias("_parts"))
    rows = rows.withColumn("_upto", F.expr(
        "transform(_parts, (p, i) -> aggregate(slice(_parts, 1, i), 0, (a, q) -> a + length(q.header) + length(q.body)))"))
    spans = F.expr("filter(transform(_parts, (p, i) -> if(p.train, struct(_upto[i] + length(p.header) as first, "
                   "_upto[i] + length(p.header) + length(p.body) as last), null)), s -> s is not null)")
    return rows.select(*keys, F.expr("array_join(transform(_parts, p -> p.header || p.body), '')").alias("rendered"),
                       spans.alias("spans"))


def dialogues(segments: DataFrame) -> DataFrame:
    """Whole renderings (conv, participant, rendered, spans): one row each, for dialogues that fit a row.

    ``spans``: begin and end of the trained characters (code points).  Dialogues of any length are rendered by ``renderings``.
    """
    return _rendered(segments, "conv", "participant")


def renderings(segments: DataFrame, turns: int = PART_TURNS) -> DataFrame:
    """Renderings of dialogues of any length (conv, participant, part, begin, rendered, spans): ``turns`` turns a row.

    A dialogue of at most so many turns is one row, as ``dialogues`` gives it.  A longer one is the ``rendered`` of its parts in order;
    ``begin`` is where a part stands in the whole, and ``spans`` count from the start of the whole, too (code points).  No task holds more than a part.
    """
    segments = segments.withColumn("part", F.floor(F.col("ordinal") / turns).cast("long"))
    sizes = segments.groupBy("conv", "participant", "part").agg(F.sum(F.length("header") + F.length("body")).cast("long").alias("size"))
    before = Window.partitionBy("conv", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = pin(sizes.select(F.col("conv").alias("_conv"), F.col("participant").alias("_participant"), F.col("part").alias("_part"),
                             F.sum("size").over(before).alias("begin")).filter(F.col("_part") > 0), "chat-parts")
    begin, spans = F.coalesce("begin", F.lit(0)).cast("long"), F.col("spans")
    moved = F.transform(spans, lambda s: F.struct((s["first"] + F.col("begin")).alias("first"), (s["last"] + F.col("begin")).alias("last")))
    rows = _rendered(segments, "conv", "participant", "part").join(
        later, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("participant") == F.col("_participant")) & (F.col("part") == F.col("_part")), "left")
    return rows.withColumn("begin", begin).select("conv", "participant", "part", "begin", "rendered", moved.alias("spans"))


def rendering_digests(rendered: DataFrame, turns: int = PART_TURNS) -> DataFrame:
    """``digests`` read from ``renderings``: their texts are cut where turns open, which nothing else can, and the mask is that of the spans."""
    rows = rendered.select("conv", "participant", "part", "begin", "spans", F.length("rendered").alias("size"),
                           F.slice(F.split("rendered", BEGIN.replace("|", "\\|")), 2, turns).alias("_turns"))
    rows = rows.withColumn("_upto", F.expr(f"transform(_turns, (t, i) -> begin + aggregate(slice(_turns, 1, i), 0L, "
                                           f"(a, q) -> a + length(q) + {len(BEGIN)}))"))
    firsts = F.transform("spans", lambda s: s["first"])

    def value(turn: Column, i: Column) -> Column:
        body = F.get("_upto", i) + len(BEGIN) + F.instr(turn, "\n")
        mark = F.concat_ws(":", (F.col("part") * turns + i).cast("string"), F.array_contains(firsts, body).cast("int").cast("string"),
                           F.concat(F.lit(BEGIN), turn))
        return F.conv(F.substring(F.md5(mark), 1, 8), 16, 10).cast("long")

    own = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    total = F.aggregate(F.transform("_turns", value), F.lit(0).cast("long"), lambda a, v: a + v)
    return rows.groupBy("conv", "participant").agg(
        F.sum(F.size("_turns")).alias("n_turns"), F.sum(F.size("spans")).alias("n_own_turns"), F.sum("size").alias("n_chars"),
        F.sum(own).alias("n_train_chars"), F.sum(total).alias("digest"))


def digests(segments: DataFrame) -> DataFrame:
    """One row per perspective: turns, own turns, characters, trained characters, and a digest of text, order and mask.

    The digest is the sum of 32 bits of the md5 of each numbered segment: it combines in the map task, so the length of
    a dialogue does not matter.
    """
    size = F.length("header") + F.length("body")
    mark = F.concat_ws(":", F.col("ordinal").cast("string"), F.col("train").cast("int").cast("string"),
                       F.concat("header", "body"))
    value = F.conv(F.substring(F.md5(mark), 1, 8), 16, 10).cast("long")
    return segments.groupBy("conv", "participant").agg(
        F.count("*").alias("n_turns"), F.count_if("train").alias("n_own_turns"), F.sum(size).cast("long").alias("n_chars"),
        F.sum(F.when(F.col("train"), F.length("body")).otherwise(0)).cast("long").alias("n_train_chars"),
        F.sum(value).alias("digest"))
