"""Validation, projection, cleaning and column classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry import query
from registry.base import ALL, FEATURES, S, sample, table
from riskspark import SampleSpec
from riskspark.functions.dates import is_date, iso_date, month_prefix, normalize_date, shift_days
from riskspark.operators import classify, clean, project, validate
from riskspark.plans.flows import clean_sample


@query(
    "label_violations",
    "SELECT DISTINCT l_linenumber FROM lineitem WHERE l_linenumber IS NOT NULL AND l_linenumber NOT IN (0, 1)",
)
def _(spark, sf):
    return validate.label_violations(table(spark, sf, "lineitem"), "l_linenumber")


# Ship dates written in four styles: two accepted layouts, one without padding, one with month 13.
DATE_TEXT_SQL = """d AS (SELECT CASE CAST(l_linenumber AS INTEGER) % 4
    WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%Y%m%d')
    WHEN 2 THEN concat(year(l_shipdate), '-', month(l_shipdate), '-', day(l_shipdate))
    ELSE concat(year(l_shipdate), '13', strftime(l_shipdate, '%d')) END AS day_text FROM lineitem),
  p AS (SELECT day_text, CASE WHEN regexp_full_match(day_text, '\\d{4}-\\d{2}-\\d{2}') THEN CAST(try_strptime(day_text, '%Y-%m-%d') AS DATE)
    WHEN regexp_full_match(day_text, '\\d{8}') THEN CAST(try_strptime(day_text, '%Y%m%d') AS DATE) END AS day FROM d)"""


def _date_texts(spark, sf) -> DataFrame:
    d, style = F.col("l_shipdate"), F.col("l_linenumber") % 4
    return table(spark, sf, "lineitem").select(
        F.when(style == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(d, "yyyyMMdd"))
        .when(style == 2, F.date_format(d, "yyyy-M-d"))
        .otherwise(F.concat(F.year(d).cast("string"), F.lit("13"), F.date_format(d, "dd")))
        .alias("day_text")
    )


@query("date_violations", f"WITH {DATE_TEXT_SQL} SELECT DISTINCT day_text FROM p WHERE day IS NULL")
def _(spark, sf):
    return validate.date_violations(_date_texts(spark, sf), "day_text")


@query(
    "normalize_dates",
    f"""WITH {DATE_TEXT_SQL} SELECT DISTINCT day_text, strftime(day, '%Y%m%d') AS day8, strftime(day, '%Y%m') AS month6,
      strftime(day, '%Y-%m-%d') AS iso, day IS NOT NULL AS valid, strftime(day + INTERVAL 45 DAY, '%Y%m%d') AS later,
      strftime(day - INTERVAL 45 DAY, '%Y%m%d') AS earlier FROM p""",
)
def _(spark, sf):
    c = F.col("day_text")
    return _date_texts(spark, sf).distinct().select(
        "day_text", normalize_date(c).alias("day8"), month_prefix(c).alias("month6"), iso_date(c).alias("iso"),
        is_date(c).alias("valid"), shift_days(c, 45).alias("later"), shift_days(c, -45).alias("earlier"),
    )


@query(
    "population_filter",
    "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
)
def _(spark, sf):
    return project.population_filter(
        table(spark, sf, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F", "not_a_column": 1}
    )


@query(
    "split_slice",
    "SELECT l_orderkey, l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2001-11-30'",
)
def _(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity")
    return project.split_slice(t, "l_shipdate", ("20000101", "2001-11-30"))


@query(
    "fit_slice",
    "SELECT l_orderkey, l_shipdate FROM lineitem WHERE strftime(l_shipdate, '%Y%m%d') BETWEEN '19990101' AND '19991231'",
)
def _(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    return project.fit_slice(t, "l_shipdate", ("1999-01-01", "19991231"))


@query("feature_projection", "SELECT l_suppkey, l_shipdate, l_tax, l_quantity FROM lineitem")
def _(spark, sf):
    kept, missing = project.feature_projection(
        table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate"], ["l_tax", "gone", "l_quantity", "l_tax"]
    )
    assert missing == ["gone"]
    return kept


@query("score_passthrough", f"WITH {S} SELECT * EXCLUDE (qty, price, disc, tax) FROM s")
def _(spark, sf):
    return project.score_passthrough(sample(spark, sf), FEATURES)


@query(
    "numeric_coercion",
    """SELECT o_orderkey, CAST(try_cast(left(o_orderpriority, 1) AS DOUBLE) AS DOUBLE) AS level,
      try_cast(o_orderpriority AS DOUBLE) AS bad FROM orders""",
)
def _(spark, sf):
    t = table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"), F.col("o_orderpriority").alias("bad")
    )
    return project.align_features(t, ["level", "bad"])


_WORD = "[\\p{L}\\p{N}_]"
_SCAN = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows,
      count(*) FILTER (regexp_matches({c}, '(^|[^\\p{{L}}\\p{{N}}_])\\d{{17}}[\\dxX]($|[^\\p{{L}}\\p{{N}}_])')) AS n_id_card,
      count(*) FILTER (regexp_matches({c}, '(^|[^\\p{{L}}\\p{{N}}_])1[3-9]\\d{{9}}($|[^\\p{{L}}\\p{{N}}_])')) AS n_mobile
    FROM documents"""
    for c in ("text", "lang", "source")
)


@query("sensitive_scan", _SCAN)
def _(spark, sf):
    return validate.sensitive_scan(table(spark, sf, "documents"))


_RAW = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "sentinel_replace",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
      CASE WHEN l_discount NOT IN (0, 0.05) THEN l_discount END AS l_discount,
      CASE WHEN l_tax NOT IN (0, 0.05) THEN l_tax END AS l_tax, l_returnflag FROM lineitem""",
)
def _(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_RAW, "l_returnflag")
    return clean.sentinel_replace(t, [*_RAW, "l_returnflag"], [0.0, 0.05])


@query(
    "sentinel_report",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS feature,
        concat_ws(',', CASE WHEN count(*) FILTER ({c} = 50) > 0 THEN '50' END,
          CASE WHEN count(*) FILTER ({c} = 0) > 0 THEN '0' END, CASE WHEN count(*) FILTER ({c} = 0.05) > 0 THEN '0.05' END) AS hit_values,
        count(*) FILTER ({c} IN (50, 0, 0.05)) AS n_hit,
        round(count(*) FILTER ({c} IN (50, 0, 0.05)) / count(*), 6) AS hit_ratio FROM lineitem) WHERE n_hit > 0"""
        for c in _RAW
    ),
)
def _(spark, sf):
    return clean.sentinel_report(table(spark, sf, "lineitem"), [*_RAW, "l_returnflag"], [50.0, 0.0, 0.05])


_ORDER = ["okey", "line"]
_REST = [c for c in ALL if c not in ("uid", "dt", *_ORDER)]
_BY = ", ".join(f"{c} NULLS FIRST" for c in [*_ORDER, *_REST])


@query(
    "dedup_label_first",
    f"""WITH {S} SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY uid, dt ORDER BY y IS NULL, {_BY}) AS k FROM s)
    WHERE k = 1""",
)
def _(spark, sf):
    return clean.dedup_label_first(sample(spark, sf), "uid", "dt", "y", _ORDER)


_FIRST = ["y", "disc", "tax", "score_old", "price"]


@query(
    "dedup_first_nonnull",
    f"WITH {S} SELECT month, uid, "
    + ", ".join(f"first({c} ORDER BY okey, line, {c}) FILTER ({c} IS NOT NULL) AS {c}" for c in _FIRST)
    + ", min(okey) AS okey, first(line ORDER BY okey, line) AS line FROM s GROUP BY month, uid",
)
def _(spark, sf):
    t = sample(spark, sf).select("month", "uid", *_FIRST, "okey", "line")
    return clean.dedup_first_nonnull(t, ["month", "uid"], _ORDER)


@query(
    "dedup_report",
    f"""WITH {S} SELECT count(*) AS n_before, (SELECT count(*) FROM (SELECT DISTINCT uid, dt FROM s)) AS n_after,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT uid, dt FROM s)) AS n_removed FROM s""",
)
def _(spark, sf):
    return clean.dedup_report(sample(spark, sf), "uid", "dt")


_KEEP = ["l_suppkey", "l_shipdate", "y", "l_orderkey", "l_linenumber"]
_SELECT = ", ".join([*_KEEP, *_RAW])
_CLEANED = ", ".join(f"CASE WHEN {c} <> 0 THEN {c} END AS {c}" for c in _RAW)
_CBY = ", ".join(f"{c} NULLS FIRST" for c in ["l_orderkey", "l_linenumber", *_RAW])


@query(
    "clean_sample",
    f"""WITH v AS (SELECT l_suppkey, l_shipdate, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS DOUBLE) AS y,
      l_orderkey, l_linenumber, {_CLEANED} FROM lineitem)
    SELECT {_SELECT} FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY y IS NULL, {_CBY}) AS k FROM v)
    WHERE k = 1""",
)
def _(spark, sf):
    flag = F.col("l_returnflag")
    t = table(spark, sf, "lineitem").withColumn("y", F.when(flag == "R", 1.0).when(flag == "A", 0.0))
    spec = SampleSpec("l_suppkey", "l_shipdate", ("y",), tuple(_RAW), order_cols=("l_orderkey", "l_linenumber"))
    return clean_sample(t, spec, [0.0], allow_list=[*_RAW, "gone"], auto_confirm=True).table


# Column names chosen so that every rule fires.
_NAMES = {
    "order_id": "l_orderkey", "ship_date": "l_shipdate", "line_no": "l_linenumber", "is_filled": "(l_linestatus = 'F')::int",
    "has_levels": "l_linenumber", "if_text": "l_linestatus", "dpd30_x": "l_linenumber", "score_80002": "l_tax",
    "amt_price": "l_extendedprice", "amt_paid": "nullif(l_discount, 0)", "amt_7": "nullif(l_tax, 0)",
    "f_p_day": "l_shipdate", "qty": "l_quantity",
}
_CLASS = {
    "order_id": ("non_feature", "order number", "bigint"), "ship_date": ("non_feature", "date", "timestamp_ntz"),
    "line_no": ("non_feature", "sequence number", "int"), "is_filled": ("non_feature", "0/1 flag", "int"),
    "has_levels": ("ambiguous", "flag prefix, values unchecked", "int"),
    "if_text": ("ambiguous", "flag prefix, values unchecked", "string"), "dpd30_x": ("non_feature", "label", "int"),
    "score_80002": ("ambiguous", "anonymous code", "double"), "amt_price": ("feature", "default", "double"),
    "amt_paid": ("feature", "default", "double"), "amt_7": ("ambiguous", "anonymous code", "double"),
    "f_p_day": ("non_feature", "partition date", "timestamp_ntz"), "qty": ("feature", "default", "double"),
}
_PROFILE = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, '{_CLASS[n][0]}' AS category, '{_CLASS[n][1]}' AS reason, '{_CLASS[n][2]}' AS dtype, "
    f"round(avg(CASE WHEN ({e}) IS NULL THEN 1.0 ELSE 0.0 END), 4) AS null_ratio FROM lineitem"
    for n, e in _NAMES.items()
)


def _named(spark, sf) -> DataFrame:
    exprs = {n: e.replace("(l_linestatus = 'F')::int", "cast(l_linestatus = 'F' as int)") for n, e in _NAMES.items()}
    t = table(spark, sf, "lineitem").selectExpr("l_suppkey", *[f"{e} AS {n}" for n, e in exprs.items()])
    return t.withColumns({c: F.col(c).cast("double") for c in ("amt_paid", "amt_7")})


@query("classify_columns", _PROFILE)
def _(spark, sf):
    return classify.classify_columns(_named(spark, sf), ["l_suppkey"])


@query("null_ratios", f"SELECT feature, dtype, null_ratio FROM ({_PROFILE})")
def _(spark, sf):
    return classify.null_ratios(_named(spark, sf).drop("l_suppkey"))


@query("class_counts", f"SELECT category, count(*) AS n FROM ({_PROFILE}) GROUP BY category")
def _(spark, sf):
    return classify.class_counts(classify.classify_columns(_named(spark, sf), ["l_suppkey"]))


@query(
    "column_groups",
    f"""SELECT "group", count(*) AS n, count(DISTINCT category) > 1 AS mixed,
      array_to_string(list_sort(list_distinct(list(category))), ',') AS categories,
      list_sort(list(null_ratio))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS null_median
    FROM (SELECT *, CASE WHEN feature LIKE 'amt\\_%' ESCAPE '\\' THEN 'amt_*' ELSE feature END AS "group" FROM ({_PROFILE}))
    GROUP BY "group" """,
)
def _(spark, sf):
    return classify.column_groups(classify.classify_columns(_named(spark, sf), ["l_suppkey"]), list(_NAMES))


@query(
    "finalize_columns",
    f"""SELECT feature,
      CASE WHEN feature IN ('qty', 'amt_7') THEN 'non_feature' WHEN feature = 'line_no' THEN 'feature' ELSE category END AS category,
      CASE WHEN feature IN ('qty', 'amt_7') THEN 'excluded by user' WHEN feature IN ('line_no', 'if_text') THEN 'kept by user' ELSE reason END AS reason,
      dtype, null_ratio, CASE WHEN feature IN ('qty', 'amt_7', 'line_no', 'if_text') THEN 'user' ELSE 'rule' END AS decided_by
    FROM ({_PROFILE})""",
)
def _(spark, sf):
    profile = classify.classify_columns(_named(spark, sf), ["l_suppkey"])
    return classify.finalize_columns(profile, list(_NAMES), ["qty", "amt_7"], ["line_no", "if_text"])


@query(
    "final_features",
    f"""SELECT feature AS feature_name FROM ({_PROFILE}) WHERE CASE WHEN feature IN ('qty', 'amt_7') THEN 'non_feature'
      WHEN feature = 'line_no' THEN 'feature' ELSE category END <> 'non_feature'""",
)
def _(spark, sf):
    profile = classify.classify_columns(_named(spark, sf), ["l_suppkey"])
    return classify.final_features(classify.finalize_columns(profile, list(_NAMES), ["qty", "amt_7"], ["line_no", "if_text"]))
