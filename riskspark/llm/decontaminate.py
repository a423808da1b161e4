"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``width`` consecutive item words (a shorter item is one window). Exact containment of a window needs
all of its words, so of its words ordered by rarity in the documents the necessary prefix is the single rarest
one: only occurrences of those words are joined. A word at item place q and document place p fixes the
alignment p - q; alignments whose windows would start before the document or end behind it fall to the length
and positional bounds. What is left is verified word by word over the item-sized stretch of the document.

Null and empty texts have no words, no windows and no hits; repeated rows get equal results, repeated items
count by id; a null item id takes no part in the list of ids. Empty tables give zeros or no rows. Extra columns
are ignored by ``judge`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from riskspark.llm.base import lower_ascii
from riskspark.sources.staging import stage

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same for texts that are not lower-cased


def words(text: Column) -> Column:
    """Words of the text after lower-casing A-Z; none for null."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), BREAKS), "")


def word_count(text: Column) -> Column:
    """The number of ``words``, without lower-casing the text."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), CASED_BREAKS), ""))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_words): items with equal words are compared once; ``ids`` lists them."""
    found = benchmark.select(F.col(id_col).alias("__id"), words(F.col(text_col)).alias("item_words"))
    found = found.where(F.size("item_words") > 0)
    return found.groupBy("item_words").agg(F.collect_set("__id").alias("ids")).withColumn(
        "item", F.sha2(F.concat_ws(" ", "item_words").cast("binary"), 256)
    )


def _rarest(items: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """(item, place, word, length): the place of the rarest word of each window; none where a word is nowhere."""
    placed = items.select("item", F.posexplode("item_words").alias("place", "word"), F.size("item_words").alias("length"))
    placed = placed.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ahead = W.partitionBy("item").orderBy("place").rowsBetween(0, width - 1)
    least = F.min(F.struct("n", "word", "place")).over(ahead)
    starts = F.col("place") <= F.greatest(F.col("length") - width, F.lit(0))
    best = placed.withColumn("best", least).where(starts & (F.col("best.n") > 0))
    return best.select("item", "length", F.col("best.place").alias("place"), F.col("best.word").alias("word")).distinct()


def judge(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 13,
    share: int = 20,
) -> DataFrame:
    """(id, n_words, n_hit, item_ids, contaminated) for every document.

    Contaminated: at least one word in ``share`` lies in an occurrence of a window. Documents are told apart by
    id and text hash, so repeated ids with different texts stay separate.
    """
    items = stage(_items(benchmark, item_col, item_text_col))
    key = [F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__h")]
    split = docs.select(*key, words(F.col(text_col)).alias("words"))

    vocabulary = items.select(F.explode("item_words").alias("word")).distinct()
    counts = split.select(F.explode("words").alias("word")).join(vocabulary, "word", "left_semi")
    prefix = stage(_rarest(items, stage(counts.groupBy("word").agg(F.count("*").alias("n"))), width))

    seen = split.select("__id", "__h", F.size("words").alias("n_words"), F.posexplode("words").alias("at", "word"))
    shortest = F.least(F.col("length"), F.lit(width))
    aligned = (
        seen.join(prefix, "word")
        .withColumn("start", F.col("at") - F.col("place"))
        .where(
            # A window around the place must fit: before it in the item, and inside the document.
            (F.col("n_words") >= shortest)
            & (F.least(F.col("place") + width, F.col("length"), F.col("n_words") - F.col("start"))
               - F.greatest(F.col("place") - width + 1, F.lit(0), -F.col("start")) >= shortest)
        )
        .select("__id", "__h", "item", "length", "start")
        .distinct()
    )
    stretches = stage(
        aligned.groupBy("__id", "__h").agg(F.collect_list(F.struct("item", "length", "start")).alias("candidates"))
    )

    # Each candidate takes its stretch of the document along; words outside the document are null. Texts travel whole and are
    # split where they arrive, as an array of words takes several times their room.
    whole = docs.select(*key, F.col(text_col).alias("__text"))
    mine = whole["__id"].eqNullSafe(stretches["__id"]) & (whole["__h"] == stretches["__h"])
    arrived = whole.join(stretches, mine).select(whole["__id"], whole["__h"], "candidates", words(F.col("__text")).alias("words"))
    cut = arrived.select(
        "__id", "__h",
        F.explode(
            F.transform(
                "candidates",
                lambda c: F.struct(
                    c["item"].alias("item"), F.greatest(c["start"], F.lit(0)).alias("begin"),
                    F.greatest(-c["start"], F.lit(0)).alias("skip"),
                    F.slice("words", F.greatest(c["start"], F.lit(0)) + 1, c["length"] - F.greatest(-c["start"], F.lit(0))).alias("seen"),
                ),
            )
        ).alias("c"),
    ).select("__id", "__h", "c.*")
    wanted = F.slice("item_words", F.col("skip") + 1, F.size("seen"))
    compared = cut.join(items, "item").select(
        "__id", "__h", "ids", "begin", F.least(F.size("item_words"), F.lit(width)).alias("need"),
        F.transform(F.zip_with("seen", wanted, lambda a, b: a == b), lambda same, i: F.when(~same, i)).alias("broken"),
    )
    # Maximal runs of equal words lie between the places that differ.
    ends = F.concat(F.array(F.lit(-1)), F.array_compact("broken"), F.array(F.size("broken")))
    runs = F.filter(
        F.zip_with(F.slice(ends, 1, F.size(ends) - 1), F.slice(ends, 2, F.size(ends) - 1), lambda a, b: F.struct((a + 1).alias("a"), b.alias("b"))),
        lambda r: r["b"] - r["a"] >= F.col("need"),
    )
    hits = stage(
        compared.select("__id", "__h", "ids", "begin", F.explode(runs).alias("r")).select(
            "__id", "__h", "ids", (F.col("begin") + F.col("r.a")).alias("a"), (F.col("begin") + F.col("r.b")).alias("b")
        )
    )
    doc = W.partitionBy("__id", "__h").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1)
    new = F.greatest(F.col("b") - F.greatest(F.col("a"), F.coalesce(F.max("b").over(doc), F.lit(0))), F.lit(0))
    spans = hits.select("__id", "__h", "a", "b").distinct()
    n_hit = spans.withColumn("new", new).groupBy("__id", "__h").agg(F.sum("new").alias("n_hit"))
    found = hits.select("__id", "__h", F.explode("ids").alias("i")).groupBy("__id", "__h").agg(
        F.array_sort(F.collect_set(F.col("i").cast("string"))).alias("item_ids")
    )
    found = n_hit.join(found, n_hit["__id"].eqNullSafe(found["__id"]) & (n_hit["__h"] == found["__h"]), "left").select(
        n_hit["__id"].alias("f_id"), n_hit["__h"].alias("f_h"), "n_hit", "item_ids"
    )
    result = docs.select(*key, word_count(F.col(text_col)).cast("long").alias("n_words")).join(
        stage(found), F.col("__id").eqNullSafe(F.col("f_id")) & (F.col("__h") == F.col("f_h")), "left"
    )
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return result.select(
        F.col("__id").alias(id_col), F.col("__h").alias("text_hash"), "n_words", hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kind) -> DataFrame:
    """The rows of ``docs`` that ``judge`` does not call contaminated; every other row stays, repeats included.

    The contaminated ones are written first, two numbers a row: where their size allows it they go to every task, and no text
    is shuffled to drop them.
    """
    bad = stage(
        judge(docs, benchmark, id_col, text_col, **kind).where("contaminated").select(
            F.col(id_col).alias("__id"), F.col("text_hash").alias("__h")
        )
    )
    mine = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("__h"))
    return docs.join(bad, mine, "left_anti")
