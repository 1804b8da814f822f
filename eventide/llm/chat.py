"""Chat formatting: every participant's perspective of a multi-party dialogue.

For each participant the dialogue is rendered with that speaker's turns as ``assistant``, the other
speakers' as ``user`` with their name, and system turns as they are.  The
loss mask is the list of character spans of the speaker's own turns, each with its end mark.

A dialogue is cut into parts of ``TURNS`` rows by running position, so no row grows with a
long dialogue, also if its turn numbers repeat or are null; null conv_ids are one dialogue.
Every part is rendered for every participant of the whole dialogue, so a participant's parts, put
together in order, are the whole rendering, each turn once; spans count from the start of their part.
Turns order by number (null first), role, the first ``BEGINNING`` characters of the text, then its SHA-256, at every
length (so what a distributed sort samples stays small).
A null role speaks as ``unknown``, a null text is empty; repeated rows are repeated turns (so ties between them do not show);
very long texts are rendered whole.
``<|`` inside a text is written ``< |``, so a text cannot end its own turn.  A dialogue of system turns only has no
participant, hence no row.  An empty table gives no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.plans.broadcast import bounded_broadcast
from eventide.plans.lineage import materialize

TURNS = 256
#: Parts of one dialogue that meet its participants in one group.
PARTS = 64
BEGINNING = 32
_ORDER = ["turn", "role", "begins", "digest"]
SYSTEM = "system"
_END = "<|im_end|>"


def _rows(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
                        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    return rows.withColumns({"begins": F.substring("text", 1, BEGINNING), "digest": F.sha2("text", 256)})


def _in_order() -> Column:
    """The turns of a group in their order, as structs of turn, role and text."""
    ordered = F.sort_array(F.collect_list(F.struct(*_ORDER, "text")))
    return F.transform(ordered, lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text")))


def dialogues(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """One row per dialogue part and participant: conv_id, part (from 0), participant, n_turns, text, loss_spans, loss_chars."""
    rows = _rows(turns, conv_id, turn, role, text)
    long = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TURNS)
    long = materialize(long.select(F.col("conv_id").alias("long_id")), "chat-long")
    side, same = bounded_broadcast(long), F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = (rows.join(side, same, "left_anti").groupBy("conv_id")
             .agg(_in_order().alias("turns"))
             .select("conv_id", F.lit(0).cast("long").alias("part"), "turns"))
    if long.isEmpty():
        return render(with_speakers(short))
    rows = rows.join(side, same, "left_semi")
    return render(with_speakers(short).unionByName(with_participants(long_parts(rows), rows)))


def long_parts(rows: DataFrame) -> DataFrame:
    """(conv_id, part, turns) of dialogues of any length.

    One distributed sort puts all turns in order; a turn's position is its number within its sorted partition plus
    the sizes of the partitions before, less the position at which its dialogue begins.  No window runs over a
    dialogue: the only one has a row per partition.
    """
    # Equal turns are told apart by where they were read, so that many copies of one spread over partitions too.
    rows = rows.withColumn("copy", F.monotonically_increasing_id()).orderBy("conv_id", *_ORDER, "copy")
    rows = materialize(rows.drop("copy").withColumn("n", F.monotonically_increasing_id()), "chat-turns")
    chunk, nth = F.shiftright("n", 33).alias("chunk"), F.col("n").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(chunk).agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    chunks = materialize(sizes.select(F.col("chunk").alias("c"), before.alias("before")), "chat-chunks")
    placed = rows.select("*", chunk, nth.alias("nth")).join(F.broadcast(chunks), F.col("chunk") == F.col("c"))
    placed = placed.select("conv_id", *_ORDER, "text", (F.col("before") + F.col("nth")).alias("place"))
    begin = placed.groupBy(F.col("conv_id").alias("id")).agg(F.min("place").alias("begin"))
    placed = placed.join(bounded_broadcast(materialize(begin, "chat-begins")), F.col("conv_id").eqNullSafe(F.col("id")))
    part = F.floor((F.col("place") - F.col("begin")) / TURNS).cast("long")
    return placed.groupBy("conv_id", part.alias("part")).agg(_in_order().alias("turns"))


def with_speakers(parts: DataFrame) -> DataFrame:
    speakers = F.array_distinct(F.filter(F.col("turns.role"), lambda r: r != SYSTEM))
    return parts.select("conv_id", "part", "turns", F.explode(speakers).alias("participant"))


def with_participants(parts: DataFrame, rows: DataFrame) -> DataFrame:
    """Every part with every participant of its dialogue, ``PARTS`` parts of one dialogue at a time."""
    people = rows.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("participant")).distinct()
    groups = (rows.groupBy(F.col("conv_id").alias("d")).agg(F.count(F.lit(1)).alias("turns_all"))
              .select("d", F.explode(F.sequence(F.lit(0), F.floor((F.col("turns_all") - 1) / (TURNS * PARTS)).cast("int"))).alias("g")))
    people = people.join(groups, F.col("c").eqNullSafe(F.col("d")))
    met = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c")) & (F.floor(F.col("part") / PARTS) == F.col("g")))
    return met.select("conv_id", "part", "turns", "participant")


def render(parts: DataFrame) -> DataFrame:
    """The rendering of every (conv_id, part, turns, participant)."""
    me = F.col("participant")
    head = lambda t: F.concat(F.lit("<|im_start|>"), F.when(t["role"] == SYSTEM, F.lit(SYSTEM))
                              .when(t["role"] == me, F.lit("assistant"))
                              .otherwise(F.concat(F.lit("user name="), t["role"])), F.lit("\n"))
    said = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit(_END)).alias("body"), (t["role"] == me).alias("own")))
    parts = parts.select("conv_id", "part", "participant", said.alias("said"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("long").alias("n"))

    def step(acc, s):
        begin = acc["at"] + F.length(s["head"])
        end = begin + F.length(s["body"])
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct((end + 1).alias("at"),
                        F.when(s["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
                        F.when(s["own"], acc["n"] + F.length(s["body"])).otherwise(acc["n"]).alias("n"))

    parts = parts.withColumn("mask", F.aggregate("said", start, step))
    whole = F.array_join(F.transform("said", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "")
    return parts.select("conv_id", "part", "participant", F.size("said").cast("long").alias("n_turns"), whole.alias("text"),
                        F.array_join("mask.spans", ",").alias("loss_spans"), F.col("mask.n").alias("loss_chars"))
