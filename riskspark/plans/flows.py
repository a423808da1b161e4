"""End-to-end flows: cleaning a sample, delivering scores, the whole evaluation report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from riskspark.operators.clean import DEFAULT_SENTINELS, dedup_label_first, dedup_report, sentinel_replace, sentinel_report
from riskspark.operators.models import model_features, score_rows, train_model
from riskspark.operators.tree_sql import score_with_sql
from riskspark.operators.project import derive_features, match_features
from riskspark.operators.quality import ks_delta, ks_grid, ks_oot, split_evaluation, split_score_psi
from riskspark.operators.report import (
    label_grid, lift_table, month_stats, report_checks, report_frame, score_cells, score_distribution, score_psi,
    segment_bad_rate, swap_matrix,
)
from riskspark.operators.scorecard import apply_scorecard
from riskspark.operators.select import time_weight
from riskspark.operators.validate import require_columns
from riskspark.sources.staging import stage
from riskspark.spec import SampleSpec


class CleanedSample(NamedTuple):
    """Outputs of the cleaning flow; ``report`` lists sentinel hits, ``counts`` rows before and after."""

    table: DataFrame
    features: list[str]
    report: DataFrame
    counts: DataFrame


def clean_sample(
    df: DataFrame, spec: SampleSpec, sentinels: Sequence[float] = DEFAULT_SENTINELS,
    allow_list: Sequence[str] | None = None, confirm: Callable[[DataFrame], bool] | None = None,
    auto_confirm: bool = False,
) -> CleanedSample:
    """Validate → sentinels → de-duplicate → feature list, with the sentinel report and the row counts.

    Unless ``auto_confirm`` is set, sentinel hits must be approved by ``confirm``; otherwise nothing is
    returned and an error is raised.
    """
    label = spec.label_cols[0] if spec.label_cols else None
    require_columns(df, [spec.id_col, spec.dt_col, label])
    features = list(spec.feature_cols) or derive_features(df.columns, [spec.id_col, spec.dt_col, *spec.label_cols])
    if allow_list is not None:
        features, _ = match_features(features, allow_list)
    report = sentinel_report(df, features, sentinels)
    if sentinels and not auto_confirm and not report.isEmpty() and not (confirm and confirm(report)):
        raise ValueError("sentinel hits were not confirmed")
    cleaned = sentinel_replace(df, features, sentinels)
    keep = [c for c in (spec.id_col, spec.dt_col, *spec.label_cols, *spec.order_cols) if c]
    narrow = cleaned.select(*dict.fromkeys([*keep, *features]))
    table = dedup_label_first(narrow, spec.id_col, spec.dt_col, label, spec.order_cols)
    return CleanedSample(table, features, report, dedup_report(df, spec.id_col, spec.dt_col))


def deliver_scores(
    df: DataFrame, model: PipelineModel, sentinels: Sequence[float] = DEFAULT_SENTINELS,
    calibration: tuple[float, float] | None = None,
) -> DataFrame:
    """Batch delivery: sentinels on the model's features → score → optional score-card. No de-duplication.

    The model is compiled to SQL, so that delivery is one projection in generated code.
    """
    features = model_features(model)
    require_columns(df, features)
    scored = score_with_sql(sentinel_replace(df, features, sentinels), model)
    return apply_scorecard(scored, "score", *calibration) if calibration else scored


@dataclass(frozen=True)
class Cell:
    """One trained and judged cell: ``evaluation`` has a row per split, ``row`` is its line of the run table."""

    model: PipelineModel
    evaluation: DataFrame
    row: DataFrame


def run_cell(
    train: DataFrame, val: DataFrame, oot: DataFrame, features: Sequence[str], label: str, run: str, dt: str | None = None,
    algo: str = "gbt", params: dict | None = None,
) -> Cell:
    """One experiment cell: weigh rows by time when ``dt`` is given, train, score all splits, evaluate, summarise.

    The scored rows are written once; evaluation, PSI and the summary row read them. Schemes and feature lists are
    applied by the caller with the operators of ``select``.
    """
    weighed = time_weight(train, dt) if dt else train
    model = train_model(weighed, val, features, label, "weight" if dt else None, params)
    parts = {"train": train, "val": val, "oot": oot}
    rows = [d.select(label, *features).withColumn("split", F.lit(name)) for name, d in parts.items()]
    scored = stage(score_rows(rows[0].unionByName(rows[1]).unionByName(rows[2]), model))
    evaluation = split_evaluation(scored, "score", label, "split")
    wide = [
        F.max(F.when(F.col("split") == name, F.col(m))).alias(f"{name}_{m}") for name in parts for m in ("auc", "ks", "n")
    ]
    psi = split_score_psi(scored, "score", "split").select("psi").scalar()
    row = evaluation.agg(*wide).select(
        F.lit(run).alias("run"), F.lit(algo).alias("algo"), F.lit(len(features)).alias("n_features"), "*", psi.alias("psi_oot")
    )
    return Cell(model, evaluation, row)


@dataclass(frozen=True)
class ReportConfig:
    id_col: str
    dt_col: str
    models: dict[str, str]  # display name → score column; first is the new model
    labels: tuple[str, ...]
    oot_months: tuple[str, str]
    base_month: str
    order_cols: tuple[str, ...]
    conditions: dict[str, object] | None = None
    lift_bins: int = 10
    swap_bins: int = 5
    min_cnt: int = 30


def evaluation_report(df: DataFrame, config: ReportConfig) -> dict[str, DataFrame]:
    """Every table of the report, lazily, over a frame that is de-duplicated and written once."""
    needed = dict.fromkeys(
        [config.id_col, config.dt_col, *config.models.values(), *config.labels, *config.order_cols,
         *(config.conditions or {})]
    )
    require_columns(df, [*config.models.values(), *config.labels])
    frame = stage(
        report_frame(
            df.select(*[c for c in needed if c in df.columns]), config.id_col, config.dt_col,
            config.order_cols, config.conditions,
        )
    )
    names, primary = list(config.models), config.labels[0]
    new = config.models[names[0]]
    oot = frame.where(frame["month"].between(*config.oot_months))
    cells = score_cells(frame, "month", new)
    grid = ks_grid(frame, "month", config.models, config.labels, config.min_cnt)
    tables = {
        "frame": frame,
        "month_stats": month_stats(frame, "month", config.id_col, primary, config.min_cnt),
        "label_grid": label_grid(frame, "month", config.labels, config.min_cnt),
        "ks_grid": grid,
        "ks_oot": ks_oot(frame, "month", config.models, config.labels, config.oot_months),
        "lift": lift_table(oot, config.models, config.labels, config.lift_bins, config.min_cnt),
        "score_distribution": score_distribution(frame, "month", new, cells),
        "score_psi": score_psi(frame, "month", new, config.base_month, cells),
        "segments": segment_bad_rate(frame, "month", new, config.labels, config.min_cnt, cells),
        "checks": report_checks(frame, "month", config.models, config.labels, config.oot_months, config.base_month),
    }
    if len(names) > 1:
        old = config.models[names[1]]
        tables["ks_delta"] = ks_delta(grid, "month", names[0], names[1])
        tables["swap"] = swap_matrix(oot, old, new, primary, config.swap_bins, config.min_cnt)
    return tables
