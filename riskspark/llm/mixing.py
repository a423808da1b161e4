"""Mixing sources to target weights by hash-threshold histograms.

Every document has a reproducible 60-bit hash. Words are summed by source and top hash bits, the running sums
find the bucket in which a source's budget ends, and only that bucket is refined with the next bits until it
holds one hash value. Documents then pass a plain filter against their source's threshold; nothing is sorted.

Budgets: sources by code point, null last, weigh 1, 2, 3, repeating. They share all words by weight; a target
stops at ``max_repeat`` times its source's words and the excess is reshared by weight until none is above.
A target of q whole copies and a remainder takes each document q times, and once more below the threshold.

A null text has size 0. Documents whose hash ties (equal id and text) are taken together. A null source is a
source of its own. An empty table gives an empty table; extra columns are ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from riskspark.sources.staging import stage

HASH_BITS = 60
STEP_BITS = 12
SALTS = 64
BROADCAST_SOURCES = 4096  # up to so many sources, checked by a count, their lines are broadcast: under 20 MB
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 over id and text, the same in every engine that has md5."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def weigh_sources(totals: DataFrame) -> DataFrame:
    """Add ``weight`` 1, 2, 3, repeating, in the order of sources; ``totals`` has one row per source.

    Ranks come from a range-partitioned sort and per-partition counts, so no task holds all sources.
    """
    spark = totals.sparkSession
    ordered = stage(
        totals.orderBy(F.col("source").asc_nulls_last()).select("*", F.monotonically_increasing_id().alias("__at"))
    )
    part = F.shiftrightunsigned("__at", 33)
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    offsets = spark.createDataFrame(rows, "p long, before long")
    rank = F.col("before") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return (
        ordered.join(F.broadcast(offsets), part == F.col("p"))
        .withColumn("weight", (F.pmod(rank, F.lit(3)) + 1).cast("double"))
        .drop("__at", "p", "before")
    )


def add_targets(weighed: DataFrame, max_repeat: float = 3.0) -> DataFrame:
    """Add ``target``: the common level times weight, or the cap. Each round caps more sources; the last caps none."""
    cap = F.col("source_size") * F.lit(float(max_repeat))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped_before = 0.0, -1
    while True:
        capped = (cap <= F.col("weight") * F.lit(level)) if capped_before >= 0 else F.lit(False)
        r = weighed.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("capped"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("weight"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        if not r["weight"] or r["n"] == capped_before:
            break
        capped_before, level = r["n"], (total - r["capped"]) / r["weight"]
    return weighed.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _salted(per_source: DataFrame, name: str, sources: int) -> DataFrame:
    """A source may hold most rows: its line is repeated for every salt, or broadcast where sources are few."""
    salted = per_source.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return F.broadcast(salted) if sources <= BROADCAST_SOURCES else salted


def thresholds(sized: DataFrame, targets: DataFrame, sources: int) -> DataFrame:
    """(source, below): documents with a hash of at most ``below`` are taken once more than the whole copies."""
    same = sized["source"].eqNullSafe(F.col("b_source")) & (sized["salt"] == F.col("b_salt"))
    open_ = targets.select(
        F.col("source").alias("b_source"),
        (F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
    ).where(F.col("source_size") > 0)
    done = None
    for used in range(0, HASH_BITS, STEP_BITS):
        left = HASH_BITS - used - STEP_BITS
        inside = sized.join(_salted(open_, "b_salt", sources), same & (F.shiftright("h", HASH_BITS - used) == F.col("prefix")))
        histogram = inside.groupBy("b_source", F.shiftright("h", left).alias("bucket")).agg(
            F.first("budget").alias("budget"), F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"),
        )
        running = F.sum("words").over(W.partitionBy("b_source").orderBy("bucket"))
        step = stage(histogram.withColumn("upto", running))
        # The last bucket that fits whole, and the first that does not.
        bounds = step.groupBy("b_source").agg(
            F.max(F.when(F.col("upto") <= F.col("budget"), F.struct("bucket", "hi", "upto"))).alias("fits"),
            F.min(F.when(F.col("upto") > F.col("budget"), F.struct("bucket", "lo", "hi", "upto", "words", "budget"))).alias("over"),
        )
        single = F.col("over.lo") == F.col("over.hi")
        nearer = F.col("over.upto") - F.col("over.budget") < F.col("over.budget") - (F.col("over.upto") - F.col("over.words"))
        before = F.coalesce(F.col("fits.hi"), F.shiftleft(F.col("over.bucket"), left) - 1)
        part = bounds.select(
            F.col("b_source").alias("source"),
            F.when(F.col("over").isNull(), F.col("fits.hi")).when(single & nearer, F.col("over.hi"))
            .when(single, before).alias("below"),
        ).where(F.col("below").isNotNull())
        done = part if done is None else done.unionByName(part)
        open_ = stage(
            bounds.where(F.col("over").isNotNull() & ~single).select(
                "b_source",
                (F.col("over.budget") - (F.col("over.upto") - F.col("over.words"))).alias("budget"),
                F.col("over.bucket").alias("prefix"),
            )
        )
        if open_.isEmpty():
            break
    return done


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeat: float = 3.0
) -> DataFrame:
    """``docs`` with (size, source_size, target, copies, taken); a row with no copies is not in the mix."""
    text = F.col(text_col)
    h = row_hash(F.col(id_col), text)
    sized = stage(
        docs.select(F.col(source_col).alias("source"), n_words(text).alias("size"), h.alias("h")).withColumn(
            "salt", F.pmod("h", F.lit(SALTS)).cast("int")
        )
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(add_targets(stage(weigh_sources(totals)), max_repeat))
    sources = targets.count()
    limits = targets.join(
        thresholds(sized, targets, sources).withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")), "left"
    ).select(F.col("source").alias("l_source"), "source_size", "target", "below")
    limits = _salted(limits, "l_salt", sources)
    mine = F.col("__source").eqNullSafe(F.col("l_source")) & (F.pmod("__h", F.lit(SALTS)) == F.col("l_salt"))
    extra = (F.col("__h") <= F.coalesce(F.col("below"), F.lit(-1))).cast("int")
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("int")
    copies = F.least(whole + extra, F.lit(int(max_repeat)))
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    return (
        docs.select(*own, F.col(source_col).alias("__source"), n_words(text).alias("size"), h.alias("__h"))
        .join(limits, mine)
        .select(*own, "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
    )
