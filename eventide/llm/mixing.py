"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; within a source each document
expects ``target / source_size`` copies.  The documents of a source are put
in one order (size bands, then a hash), the expected copies are summed
along it, one random offset per source is added, and a document is emitted
once for every integer that its step of the running sum crosses.  Because
the order goes by size, the words taken come near the target too.

The running sum is a count of rows times a constant, so it needs ranks only:
counts per (source, band, sub-bucket) are summed at two small levels and a
row number is added inside each sub-bucket.  No task sees a whole source.

Null text has size 0; a null source is a source of its own and sorts last;
null ids order by their size; repeated rows are separate documents. Empty input gives no rows.
A source without words has target 0 and is not taken.  Very long texts count whole.  Extra columns of any name are passed on; a
column named as one of the results is an error, as it would be lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.batches import quoted

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Per source: key, source_size, target.  ``sizes`` has source, key, size.

    Sources in code point order (null last) get the weights in turn.  A target
    stops at ``limit`` times its source's size; what is cut off goes to the
    others by weight, until none is above: with sources sorted by limit / weight, the
    level is that of the first source that stays below its limit.
    The windows here hold one pre-aggregated row per source.
    """
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(limit))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    up_to = by_level.rowsBetween(Window.unboundedPreceding, 0)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", (F.sum("source_size").over(every) * F.lit(share) - (F.sum("cap").over(up_to) - F.col("cap")))
                         / F.sum("w").over(onward)).withColumn("at", F.row_number().over(by_level))
    free = F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct("at", "level"))
    per = per.withColumn("free", F.min(free).over(every))
    return per.select("key", "source_size", F.coalesce(
        F.least("cap", F.col("free.level") * F.col("w")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, size: str = "size", source: str = "source", doc_id: str = "doc_id", *, seed: str = "mix",
        out: tuple[str, str, str] = ("source_size", "target", "copies"), **kw) -> DataFrame:
    """``docs`` with three columns named ``out``: source size, target and copies (how often the mix takes the row)."""
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in out}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already: give other names as out")
    # The row travels whole in one column, so no column of it can clash with those below.
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), quoted(doc_id).alias("id"),
                       quoted(source).alias("source"), quoted(size).alias("size"))
    text_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    bits = F.bin("size")
    band = F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 5))
    # Rows without an id are dealt by their size.
    digest = F.md5(F.concat(F.lit(seed + ":"), text_id, F.when(F.col("id").isNull(), F.col("size").cast("string")).otherwise("")))
    rows = rows.withColumns({"key": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")), "band": band,
                             "md5": digest}).withColumn("sub", F.substring("md5", 1, 2))

    counts = rows.groupBy("key", "band", "sub").agg(F.count(F.lit(1)).alias("n"))
    in_band = Window.partitionBy("key", "band").orderBy("sub").rowsBetween(Window.unboundedPreceding, 0)
    in_key = Window.partitionBy("key").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    bands = counts.groupBy("key", "band").agg(F.sum("n").alias("n")).select(
        "key", "band", (F.sum("n").over(in_key) - F.col("n")).alias("band_start"))
    subs = counts.withColumn("start", F.sum("n").over(in_band) - F.col("n")).drop("n")
    starts = (subs.join(bands, ["key", "band"]).join(targets(rows, **kw), "key")
              .select(F.col("key").alias("k"), F.col("band").alias("b"), F.col("sub").alias("s"),
                      (F.col("start") + F.col("band_start")).alias("start"), "source_size", "target"))

    inside = Window.partitionBy("key", "band", "sub").orderBy("size", "md5", "id")
    rank = F.col("start") + F.col("nth")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), F.col("key"))), 1, 4), 16, 10).cast("double") / 65536
    crossed = F.floor(F.col("rate") * rank + F.col("u")) - F.floor(F.col("rate") * (rank - 1) + F.col("u"))
    placed = rows.withColumn("nth", F.row_number().over(inside)).join(
        starts, (F.col("key") == F.col("k")) & (F.col("band") == F.col("b")) & (F.col("sub") == F.col("s")))
    return (placed.withColumns({"rate": rate, "u": offset})
            .withColumn("copies", F.least(crossed, F.ceil("rate")).cast("long"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns],
                    *[F.col(a).alias(b) for a, b in zip(("source_size", "target", "copies"), out)]))
