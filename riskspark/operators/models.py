"""Training and scoring of binary classifiers with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskspark.functions.values import to_number
from riskspark.operators.project import align_features
from riskspark.operators.quality import multi_label_metrics, rank_metrics
from riskspark.operators.select import stratified_split
from riskspark.operators.tree_sql import model_expressions, probability
from riskspark.operators.validate import require_columns
from riskspark.sources.staging import stage, staged

# Starting point of every fit; a grid passed to ``tune_model`` overrides single entries.
DEFAULT_PARAMS = {"maxIter": 40, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "minInstancesPerNode": 20}

# Rows of one task of a fit. Files of the training rows hold millions each, and boosting keeps about 200 bytes a row.
TASK_ROWS = 250_000

# Boosting sees a row only by its bins. Beyond this number, rows with the same bins in all features are fitted in blocks of equal
# size limit, about as many as this, with their weights summed; below, every row is its own block.
FIT_ROWS = 1_000_000
BINS = 32  # Spark's default number of bins of a feature


def _flag(name: str) -> str:
    return f"{name}__missing"


def _prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Numeric features plus a 0/1 column per feature for "was missing" (trees here reject NaN)."""
    aligned = align_features(df, features)
    return aligned.withColumns({_flag(c): F.col(c).isNull().cast("double") for c in features})


def _training_rows(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, weight: str | None
) -> DataFrame:
    """The few columns that every boosting round reads: ``__val``, ``__y``, ``__w`` and prepared features."""
    require_columns(train, [label, weight, *features])
    both = train.withColumn("__val", F.lit(False)).unionByName(
        val.withColumn("__val", F.lit(True)), allowMissingColumns=True
    ).where(F.col(label).isNotNull())
    y = (F.col(label) > 0).cast("double").alias("__y")
    base_weight = (F.coalesce(F.col(weight), F.lit(1.0)) if weight else F.lit(1.0)).alias("__w")
    return _prepare(both.select("__val", y, base_weight, *features), features)


def _assembled(rows: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list]:
    """Balanced rows with their feature vector, and the fitted stages that made it.

    Medians, class weights and bins are taken from the training rows alone. More than ``FIT_ROWS`` rows come as blocks.
    """
    fit_rows = rows.where(~F.col("__val"))
    sizes = fit_rows.agg(F.count_if(F.col("__y") == 1).alias("p"), F.count_if(F.col("__y") == 0).alias("n")).first()
    if not sizes["p"] or not sizes["n"]:
        raise ValueError("training rows need both classes")
    balance = F.when(F.col("__y") == 1, F.lit(sizes["n"] / sizes["p"])).otherwise(F.lit(1.0))
    filled = [f"{c}__filled" for c in features]
    imputer = Imputer(inputCols=list(features), outputCols=filled, strategy="median").fit(fit_rows)
    flags = [_flag(c) for c in features]
    complete = imputer.transform(rows.withColumn("__w", F.col("__w") * balance))
    if rows.count() <= FIT_ROWS:
        stages = [imputer, VectorAssembler(inputCols=[*filled, *flags], outputCol="__x")]
    else:
        binned = [f"{c}__bin" for c in features]
        bins = Bucketizer(
            splitsArray=_bin_edges(complete.where(~F.col("__val")), filled), inputCols=filled, outputCols=binned, handleInvalid="keep"
        )
        complete = _blocks(bins.transform(complete), [*binned, *flags], sizes["p"] + sizes["n"])
        stages = [imputer, bins, VectorAssembler(inputCols=[*binned, *flags], outputCol="__x")]
    return stages[-1].transform(complete).select("__val", "__y", "__w", "__x"), stages


def _bin_edges(rows: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Edges of at most ``BINS`` bins per column: a bin for each value where there are few, else quantiles of all rows."""
    distinct = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    few = [c for c in columns if distinct[c] <= 2 * BINS]
    values = rows.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    many = [c for c in columns if c not in few or len(values[c]) > BINS]
    ranks = [i / BINS for i in range(1, BINS)]
    cuts = dict(zip(many, rows.approxQuantile(many, ranks, 0.001))) if many else {}
    inner = {c: sorted(set(cuts[c])) if c in cuts else sorted(values[c])[1:] for c in columns}
    inf = float("inf")
    # A column of one value keeps one cut, as a bucketizer needs two buckets.
    return [[-inf, *([x for x in inner[c] if abs(x) < inf] or [0.0]), inf] for c in columns]


def _blocks(binned: DataFrame, bins: Sequence[str], fit_rows: int) -> DataFrame:
    """Rows with equal bins, class and side as blocks of at most ``fit_rows / FIT_ROWS`` rows that share their weight evenly.

    Every row is in a block. A fit draws blocks in place of rows, and a leaf that needs k rows gets k blocks, so k rows at least.
    Validation rows are not drawn: a block each.
    """
    cells = binned.groupBy("__val", "__y", *bins).agg(F.count(F.lit(1)).alias("__n"), F.sum("__w").alias("__w"))
    limit = -(-fit_rows // FIT_ROWS)
    pieces = F.when(F.col("__val"), F.lit(1)).otherwise(F.ceil(F.col("__n") / F.lit(limit)).cast("int"))
    split = cells.withColumns({"__w": F.col("__w") / pieces, "__pieces": pieces})
    ordered = [F.col(c).alias(c, metadata={"ml_attr": {"type": "numeric"}}) for c in bins]  # a bucketizer marks categories
    return split.withColumn("__piece", F.explode(F.sequence(F.lit(1), F.col("__pieces")))).select("__val", "__y", "__w", *ordered)


def _held_cells(rows: DataFrame, before: Sequence, features: Sequence[str]) -> DataFrame:
    """Validation rows as ``__y``, the features and ``__n``, the number of rows that one stands for.

    Trees fitted on bins give rows with the same bins the same score, so one of them is judged for all.
    """
    held, bins = rows.where("__val"), next((s for s in before if isinstance(s, Bucketizer)), None)
    if bins is None:
        return held.select("__y", *features, F.lit(1).cast("long").alias("__n"))
    binned = bins.transform(before[0].transform(held))
    cells = binned.groupBy("__y", *bins.getOutputCols(), *[_flag(c) for c in features])
    return cells.agg(*[F.first(c).alias(c) for c in features], F.count(F.lit(1)).alias("__n")).select("__y", *features, "__n")


@contextmanager
def _dealt(vectors: DataFrame, rows: DataFrame) -> Iterator[DataFrame]:
    """The vectors of ``rows`` in even parts, at most ``TASK_ROWS`` each and one per core at least, kept while fits read them."""
    with staged(vectors) if rows.count() > FIT_ROWS else nullcontext(vectors) as made:
        parts = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-made.count() // TASK_ROWS))
        kept = made.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield kept
        finally:
            kept.unpersist()


def _boost(vectors: DataFrame, params: dict | None, seed: int) -> GBTClassificationModel:
    return GBTClassifier(
        featuresCol="__x", labelCol="__y", weightCol="__w", validationIndicatorCol="__val", seed=seed,
        **{**DEFAULT_PARAMS, **(params or {})},
    ).fit(vectors)


def train_model(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str,
    weight: str | None = None, params: dict | None = None, seed: int = 42,
) -> PipelineModel:
    """Boosted trees with median imputation, missing flags, row weights and a validation set.

    Positives are weighted by negatives/positives of the training rows. Rows without a label are dropped.
    """
    with staged(_training_rows(train, val, features, label, weight)) as rows:
        made, before = _assembled(rows, features)
        with _dealt(made, rows) as vectors:
            return PipelineModel([*before, _boost(vectors, params, seed)])


def model_features(model: PipelineModel) -> list[str]:
    """Feature order a model was trained with, read back from its imputer."""
    return list(model.stages[0].getInputCols())


def score_rows(df: DataFrame, model: PipelineModel, score: str = "score") -> DataFrame:
    """Probability of class 1 next to the non-feature columns; every model feature must be present."""
    features = model_features(model)
    out = model.transform(_prepare(df, features))
    keep = [c for c in df.columns if c not in features and c != score]
    return out.select(*keep, vector_to_array("probability")[1].alias(score))


def importance_table(model: PipelineModel) -> DataFrame:
    """Gain per feature (a feature's missing flag counts towards it), share in percent, falling."""
    from pyspark.sql import SparkSession

    features = model_features(model)
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(gains[i] + gains[i + len(features)])) for i, f in enumerate(features)]
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, total_gain double")
    total = sum(g for _, g in rows) or 1.0
    share = F.round(F.col("total_gain") / F.lit(total) * 100, 4)
    return table.withColumn("gain_pct", share).orderBy(F.desc("total_gain"), "feature")


def train_adversarial(
    dev: DataFrame, oot: DataFrame, features: Sequence[str], key_cols: Sequence[str],
    params: dict | None = None, seed: int = 42,
) -> tuple[PipelineModel, DataFrame, float]:
    """Tell development (0) from out-of-time (1) rows: model, importance, AUC on the held-out 30 %."""
    keep = list(dict.fromkeys([*key_cols, *features]))
    both = dev.select(*keep).withColumn("__oot", F.lit(0)).unionByName(
        oot.select(*keep).withColumn("__oot", F.lit(1))
    )
    parts = stage(stratified_split(both, "__oot", key_cols, 0.7, seed, "__part"))
    held = parts.where(F.col("__part") == "val").drop("__part")
    model = train_model(parts.where(F.col("__part") == "train").drop("__part"), held, features, "__oot", params=params, seed=seed)
    row = rank_metrics(score_rows(held, model), "score", "__oot").first()
    return model, importance_table(model), row["auc"]


def neighbourhood(start: dict | None = None) -> list[dict]:
    """The grid around a starting point: one level less and more of depth, half and double the step."""
    p = {**DEFAULT_PARAMS, **(start or {})}
    depths = sorted({max(1, p["maxDepth"] - 1), p["maxDepth"], p["maxDepth"] + 1})
    return [{**p, "maxDepth": d, "stepSize": s} for d in depths for s in (p["stepSize"] / 2, p["stepSize"], p["stepSize"] * 2)]


def tune_model(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, grid: Sequence[dict],
    weight: str | None = None, seed: int = 42,
) -> tuple[PipelineModel, dict, list[tuple[dict, float]]]:
    """Fit every parameter set of a neighbourhood grid and keep the best by AUC on the fixed ``val`` rows.

    The vectors are made and dealt once, and validation rows with the same bins are judged as one that counts so often; a trial
    is its boosting rounds and one pass over those.
    """
    trials: list[tuple[dict, float]] = []
    best: tuple[float, GBTClassificationModel, dict] | None = None
    with staged(_training_rows(train, val, features, label, weight)) as rows:
        made, before = _assembled(rows, features)
        with _dealt(made, rows) as vectors, staged(_held_cells(rows, before, features)) as held:
            for params in grid:
                model = _boost(vectors, params, seed)
                score = probability(model_expressions(PipelineModel([*before, model]))[1])
                judged = held.select("__y", "__n", score.alias("score"))
                auc = rank_metrics(judged, "score", "__y", times="__n").first()["auc"]
                trials.append((params, auc))
                if auc is not None and (best is None or auc > best[0]):
                    best = (auc, model, params)
    if best is None:
        raise ValueError("no parameter set could be evaluated")
    return PipelineModel([*before, best[1]]), best[2], trials


# Boosting rounds and survivors of a search: all trials start, the best go on with more rounds, the last rung is the full fit.
RUNGS = ((3, 8), (10, 3), (None, 1))


def sampled_trials(n: int = 25, seed: int = 42, start: dict | None = None) -> list[dict]:
    """The starting point and ``n - 1`` reproducible draws around it: depth, step, row share, rows per leaf."""
    draw, base = random.Random(seed), {**DEFAULT_PARAMS, **(start or {})}
    return [base] + [
        {
            **base, "maxDepth": draw.randint(3, 6), "stepSize": round(0.03 * 10 ** draw.random(), 4),
            "subsamplingRate": round(draw.uniform(0.6, 1.0), 3), "minInstancesPerNode": draw.choice([10, 20, 50, 100, 200]),
        }
        for _ in range(n - 1)
    ]


def halving_search(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, trials: Sequence[dict],
    weight: str | None = None, seed: int = 42, rungs: Sequence[tuple[int | None, int]] = RUNGS,
) -> tuple[PipelineModel, dict, list[dict]]:
    """Successive halving over boosting rounds: ``(model, parameters, report)``.

    A rung fits its trials with that many rounds (None: the trial's own ``maxIter``) and passes on as many as it says. All
    models of a rung are compiled to SQL and judged by AUC in one pass over the validation rows. ``report`` has a line per
    trial: its number, parameters, the rounds it got and its AUC there. Ties go to the earlier trial.
    """
    report = [{"trial": i, **p, "rounds": 0, "auc": None} for i, p in enumerate(trials)]
    alive, fitted = list(range(len(trials))), {}
    with staged(_training_rows(train, val, features, label, weight)) as rows:
        made, before = _assembled(rows, features)
        held = rows.where("__val")
        with _dealt(made, rows) as vectors:
            for rounds, survivors in rungs:
                fitted = {
                    i: _boost(vectors, {**trials[i], "maxIter": min(rounds or trials[i]["maxIter"], trials[i]["maxIter"])}, seed) for i in alive
                }
                scores = {f"t{i}": probability(model_expressions(PipelineModel([*before, m]))[1]) for i, m in fitted.items()}
                judged = multi_label_metrics(held.select("__y", *[c.alias(n) for n, c in scores.items()]), [], {n: n for n in scores}, ["__y"])
                found = {int(r["model"][1:]): r["auc"] for r in judged.collect()}  # a row per trial
                for i in alive:
                    report[i] |= {"rounds": fitted[i].getMaxIter(), "auc": found.get(i)}
                alive = sorted((i for i in alive if found.get(i) is not None), key=lambda i: (-found[i], i))[:survivors]
                if not alive:
                    raise ValueError("no parameter set could be evaluated")
    best = alive[0]
    return PipelineModel([*before, fitted[best]]), dict(trials[best]), report
