"""Which columns are model features: rules on names, one pass over the data where a name is not enough."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark.functions.values import is_numeric
from riskspark.operators.validate import require_columns

FEATURE, NON_FEATURE, AMBIGUOUS = "feature", "non_feature", "ambiguous"

# Name patterns, prefixes and their order decide the class and must stay as published.
LABEL_PREFIXES = ("fpd", "dpd")
FLAG_PREFIXES = ("if_", "is_", "has_", "flag_")
NAME_PATTERNS = (
    (r"(?i)(^|_)date$", "date"),
    (r"(?i)(^|_)time$|(_|^)time_", "timestamp"),
    (r"(?i)order_?id$|order_?id_", "order number"),
    (r"(?i)(^|_)(id|uid)$", "id"),
    (r"(?i)(^|_)(rn|seq|no)$", "sequence number"),
    (r"(?i)^f_p_", "partition date"),
)
ANONYMOUS = r"^([a-zA-Z]+)_(\d+)$"


# What a rule says of a column; ``None`` leaves it to the values (a column of 0 and 1 is a flag).
_Verdict = tuple[str | None, str]


def _rules(
    label_prefixes: Sequence[str], flag_prefixes: Sequence[str], extra_patterns: Iterable[str]
) -> list[tuple[str, bool | None, _Verdict]]:
    """Rows of (pattern, needs a number, verdict), the first that applies decides."""

    def starts(prefixes: Sequence[str]) -> str:
        return f"^(?:{'|'.join(map(re.escape, prefixes))})" if prefixes else r"(?!)"

    return [
        (starts(label_prefixes), None, (NON_FEATURE, "label")),
        *[(pattern, None, (NON_FEATURE, reason)) for pattern, reason in NAME_PATTERNS],
        *[(pattern, None, (NON_FEATURE, "custom rule")) for pattern in extra_patterns],
        (starts(flag_prefixes), True, (None, "flag")),
        (starts(flag_prefixes), False, (AMBIGUOUS, "flag prefix, values unchecked")),
        (ANONYMOUS, None, (AMBIGUOUS, "anonymous code")),
        ("", None, (FEATURE, "default")),
    ]


def classify_columns(
    df: DataFrame,
    excluded: Sequence[str | None] = (),
    label_prefixes: Sequence[str] = LABEL_PREFIXES,
    flag_prefixes: Sequence[str] = FLAG_PREFIXES,
    extra_patterns: Sequence[str] = (),
) -> DataFrame:
    """Profile rows ``(feature, category, reason, dtype, null_ratio)``, one scan for all columns."""
    fields = [f for f in df.schema.fields if f.name not in set(excluded)]
    if not fields:
        raise ValueError("no columns left to classify")
    rules = _rules(label_prefixes, flag_prefixes, extra_patterns)
    classes = [
        next(v for p, number, v in rules if number in (None, is_numeric(f.dataType)) and re.search(p, f.name))
        for f in fields
    ]
    measures = [F.avg(F.col(f.name).isNull().cast("double")).alias(f"n{i}") for i, f in enumerate(fields)]
    measures += [
        F.bool_and(F.col(f.name).isin(0, 1)).alias(f"b{i}")
        for i, f in enumerate(fields)
        if classes[i][0] is None
    ]
    rows = []
    for i, (f, (category, reason)) in enumerate(zip(fields, classes)):
        kind, why = F.lit(category), F.lit(reason)
        if category is None:
            pure = F.coalesce(F.col(f"b{i}"), F.lit(True))
            kind = F.when(pure, F.lit(NON_FEATURE)).otherwise(F.lit(AMBIGUOUS))
            why = F.when(pure, F.lit("0/1 flag")).otherwise(F.lit("flag prefix, values unchecked"))
        rows.append(
            F.struct(
                F.lit(f.name).alias("feature"),
                kind.alias("category"),
                why.alias("reason"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.round(F.col(f"n{i}"), 4).alias("null_ratio"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls (4 digits) and type per column."""
    chosen = df.select(*columns) if columns else df
    return classify_columns(chosen).select("feature", "dtype", "null_ratio")


def class_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def column_groups(profile: DataFrame, names: Sequence[str], min_group: int = 2) -> DataFrame:
    """Fold columns that share a first alphabetic token into ``token_*`` groups.

    A token's size is counted over ``names``, once per token; names that the profile lacks count too.
    """
    token = F.regexp_extract(F.col("name"), "^([a-zA-Z]+)_", 1)
    listed = profile.sparkSession.createDataFrame([(n,) for n in names], "name string")
    sizes = W.partitionBy("token")
    tokens = listed.withColumn("token", token).withColumn("size", F.count(F.lit(1)).over(sizes))
    folded = (F.col("token") != "") & (F.col("size") >= min_group)
    groups = tokens.select("name", F.when(folded, F.concat("token", F.lit("_*"))).otherwise(F.col("name")).alias("group")).distinct()
    ratios = F.array_sort(F.collect_list("null_ratio"))
    size = F.count(F.lit(1))
    return (
        profile.join(groups, F.col("feature") == F.col("name"), "left")
        .groupBy("group")
        .agg(
            size.alias("n"),
            (F.count_distinct("category") > 1).alias("mixed"),
            F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
            F.element_at(ratios, (F.floor(size / 2) + 1).cast("int")).alias("null_median"),
        )
    )


def finalize_columns(
    profile: DataFrame, names: Sequence[str], exclude: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Overlay a person's decisions: excluded columns drop out, kept rule hits come back."""
    unknown = [c for c in (*exclude, *keep) if c not in set(names)]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    excluded, kept = F.col("feature").isin(list(exclude)), F.col("feature").isin(list(keep))
    after_exclude = F.when(excluded, F.lit(NON_FEATURE)).otherwise(F.col("category"))
    return profile.select(
        "feature",
        F.when(kept & (after_exclude == NON_FEATURE), F.lit(FEATURE)).otherwise(after_exclude).alias("category"),
        F.when(kept, F.lit("kept by user"))
        .when(excluded, F.lit("excluded by user"))
        .otherwise(F.col("reason"))
        .alias("reason"),
        "dtype",
        "null_ratio",
        F.when(excluded | kept, F.lit("user")).otherwise(F.lit("rule")).alias("decided_by"),
    )


def final_features(finalized: DataFrame) -> DataFrame:
    """The feature list: every column that is not a non-feature."""
    require_columns(finalized, ["feature", "category"])
    return finalized.where(F.col("category") != NON_FEATURE).select(F.col("feature").alias("feature_name"))
