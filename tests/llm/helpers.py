"""Small tables with every awkward row: null, empty and long texts, repeated rows and ids, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple], schema: str = SCHEMA) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def awkward(spark: SparkSession, texts: list[str] = ()) -> DataFrame:
    words = " ".join(f"word{i % 997}" for i in range(30_000))
    fixed = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, "  \n\t ", "en", "a", 4), (4, "one", "en", None, 3),
        (5, words, "en", "b", len(words)), (6, "same text here", "en", "a", 14), (6, "same text here", "en", "a", 14),
        (None, "no id at all", "de", "c", 12), (7, "ünïcode ÜPPER straße \U0001f600 ok", None, "ä", 5),
    ]
    more = [(100 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    return documents(spark, fixed + more)


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = "size target copies taken fp root text_hash n_words words spans score data covers mark begin end word item label id kind".split()
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
