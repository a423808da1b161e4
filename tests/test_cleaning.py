import pytest
from pyspark.sql import functions as F

from riskspark import SampleSpec, SplitSpec
from riskspark.functions import dates, values
from riskspark.operators import classify, clean, project, validate
from riskspark.plans.flows import clean_sample


def test_sentinels_touch_numeric_features_only(spark):
    df = spark.createDataFrame(
        [("u1", -1, -1.0, -2.0, 10, "-1"), ("u2", 0, 1.0, 3.0, 20, "x"), ("u3", 1, -999.0, 4.0, 30, "x"), ("u4", 1, 5.0, -99.0, 40, "x")],
        "fuid string, label int, f0 double, f1 double, f2 int, cat string",
    )
    features = ["f0", "f1", "f2", "cat"]
    rows = sorted(clean.sentinel_replace(df, features).collect(), key=lambda r: r["fuid"])
    assert [r["f0"] for r in rows] == [None, 1.0, None, 5.0]
    assert [r["f1"] for r in rows] == [None, 3.0, 4.0, None]
    assert [r["f2"] for r in rows] == [10, 20, 30, 40] and rows[0]["cat"] == "-1" and rows[0]["label"] == -1
    report = {r["feature"]: r for r in clean.sentinel_report(df, features).collect()}
    assert set(report) == {"f0", "f1"}
    assert (report["f0"]["hit_values"], report["f0"]["n_hit"], report["f0"]["hit_ratio"]) == ("-1,-999", 2, 0.5)


def test_dedup_prefers_label_then_first(spark):
    schema = "u string, d string, y int, f double, pos int"
    df = spark.createDataFrame(
        [("u1", "20250101", None, 1.0, 0), ("u1", "20250101", 1, 2.0, 1), ("u2", "20250102", 0, 3.0, 2),
         ("u3", "20250101", None, 1.0, 3), ("u3", "20250101", None, 2.0, 4), (None, None, 1, 9.0, 5), (None, None, 0, 8.0, 6)],
        schema,
    )
    got = {r["u"]: (r["y"], r["f"]) for r in clean.dedup_label_first(df, "u", "d", "y", ["pos"]).collect()}
    assert got == {"u1": (1, 2.0), "u2": (0, 3.0), "u3": (None, 1.0), None: (1, 9.0)}
    plain = {r["u"]: r["f"] for r in clean.dedup_label_first(df, "u", "d", None, ["pos"]).collect()}
    assert plain["u1"] == 1.0
    assert tuple(clean.dedup_report(df, "u", "d").first()) == (7, 4, 3)


def test_first_nonnull_mixes_rows(spark):
    df = spark.createDataFrame(
        [("m", "u", None, 5.0, 1), ("m", "u", 2.0, None, 2), ("m", "u", 3.0, 7.0, 3), (None, "u", 1.0, 1.0, 4)],
        "m string, u string, a double, b double, pos int",
    )
    rows = clean.dedup_first_nonnull(df, ["m", "u"], ["pos"]).collect()
    assert len(rows) == 1 and (rows[0]["a"], rows[0]["b"], rows[0]["pos"]) == (2.0, 5.0, 1)


def test_clean_sample_gate_and_result(spark):
    df = spark.createDataFrame(
        [("u1", "20250101", -1.0, 10.0, None), ("u1", "20250101", 2.0, 20.0, 1), ("u2", "20250102", 3.0, 30.0, 0)],
        "fuid string, f_p_date string, f0 double, f1 double, label int",
    )
    spec = SampleSpec()
    with pytest.raises(ValueError):
        clean_sample(df, spec)
    table, features, report, counts = clean_sample(df, spec, auto_confirm=True)
    assert features == ["f0", "f1"]
    assert {r["fuid"]: (r["label"], r["f0"]) for r in table.collect()} == {"u1": (1, 2.0), "u2": (0, 3.0)}
    assert clean_sample(df, spec, confirm=lambda report: report.count() == 1)[0].count() == 2
    with pytest.raises(ValueError):
        clean_sample(df.drop("fuid"), spec, auto_confirm=True)


def test_dates(spark):
    cases = {"2026-03-05": "20260305", "20260305": "20260305", "2026-3-5": None, "20261305": None, "2026-02-30": None, "2026": None}
    df = spark.createDataFrame([(c,) for c in cases], "d string")
    got = {r["d"]: r["n"] for r in df.select("d", dates.normalize_date(F.col("d")).alias("n")).collect()}
    assert got == cases
    r = spark.range(1).select(
        dates.shift_days(F.lit("2026-03-01"), -1).alias("a"), dates.month_prefix(F.lit(20260312)).alias("b"),
        dates.iso_date(F.lit("20260312")).alias("c"),
    ).first()
    assert tuple(r) == ("20260228", "202603", "2026-03-12")
    assert {x["d"] for x in validate.date_violations(df, "d").collect()} == {c for c, n in cases.items() if n is None}


def test_splits_and_projection(spark):
    with pytest.raises(ValueError):
        SplitSpec({"train": ("20260201", "20260101")})
    df = spark.createDataFrame([("20260101", 1), ("2026-01-31", 2), ("bad", 3), ("20260201", 4)], "d string, x int")
    assert sorted(r["x"] for r in project.split_slice(df, "d", ("2026-01-01", "20260131")).collect()) == [1, 2]
    with pytest.raises(ValueError):
        project.fit_slice(df, "d", ("20300101", "20300201"))
    assert project.match_features(["a", "b"], ["b", "z", "b", "a"]) == (["b", "a"], ["z"])
    assert project.derive_features(["id", "a", "b"], ["id", None]) == ["a", "b"]
    assert project.interval_features(["a", "b", "c"], "a", "b", ["c"]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        project.align_features(df, ["x", "gone"])
    with pytest.raises(ValueError):
        project.population_filter(df, {"x": "13812345678"})
    real = df.select(F.to_timestamp(F.lit("2026-01-31 23:00:00")).alias("d"))
    assert project.split_slice(real, "d", ("20260101", "20260131")).count() == 4


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.sql("SELECT DATE'2026-01-01' AS d, 1 AS x, 2 AS unused").write.parquet(path)
    plan = project.split_slice(spark.read.parquet(path).select("d", "x"), "d", ("20260101", "20260131"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2026-01-01)" in text and "unused" not in text


def test_validation_and_sensitive_text(spark):
    df = spark.createDataFrame([(0, "call 13812345678 now"), (2, "id 11010119900307123X."), (None, "138123456789")], "y int, t string")
    assert [r["y"] for r in validate.label_violations(df, "y").collect()] == [2]
    assert tuple(validate.sensitive_scan(df).first()) == ("t", 3, 1, 1)
    with pytest.raises(ValueError):
        values.reject_personal_number("x = 13812345678")
    values.reject_personal_number("amount > 138")


NAMES = {
    "fser_date": "non_feature", "ftrans_time": "non_feature", "sx_order_id": "non_feature", "if_tf": "non_feature",
    "dpd30_1c": "non_feature", "fpd7_sx30": "non_feature", "i_30": "ambiguous", "m_1221": "ambiguous",
    "score_80002": "ambiguous", "f1_loan_cnt": "feature", "f2_loan_amt": "feature", "ym_tag": "feature",
}


def test_classification_grouping_and_decisions(spark):
    text = {"fser_date", "ftrans_time", "sx_order_id"}
    row = [("t" if c in text else float(c != "if_tf")) for c in NAMES]
    df = spark.createDataFrame([row, row], ", ".join(f"{c} {'string' if c in text else 'double'}" for c in NAMES))
    profile = classify.classify_columns(df)
    assert {r["feature"]: r["category"] for r in profile.collect()} == NAMES
    wide = df.select("if_tf").withColumn("if_tf", F.col("if_tf") + 2)
    assert classify.classify_columns(wide).first()["category"] == "ambiguous"
    assert {r["category"]: r["n"] for r in classify.class_counts(profile).collect()} == {"non_feature": 6, "ambiguous": 3, "feature": 3}
    groups = {r["group"]: r["n"] for r in classify.column_groups(profile, list(NAMES)).collect()}
    assert groups["ym_tag"] == 1
    assert "ym_*" in {r["group"] for r in classify.column_groups(profile, list(NAMES), 1).collect()}
    final = classify.finalize_columns(profile, list(NAMES), ["ym_tag"], ["if_tf", "i_30"])
    got = {r["feature"]: (r["category"], r["decided_by"]) for r in final.collect()}
    assert got["ym_tag"] == ("non_feature", "user") and got["if_tf"] == ("feature", "user")
    assert got["i_30"] == ("ambiguous", "user") and got["m_1221"] == ("ambiguous", "rule")
    assert classify.final_features(final).count() == 6
    with pytest.raises(ValueError):
        classify.finalize_columns(profile, list(NAMES), ["nope"])
