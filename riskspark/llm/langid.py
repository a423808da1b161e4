"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are byte 2-, 3- and 4-grams inside words, word borders included, hashed to a fixed number of buckets; a
text is the mean of its subword embeddings over the whole text. Embeddings and softmax are trained by stochastic
gradient descent in numpy on a bounded, reproducible sample of labelled rows (``max_per_label``); a part of it is
set aside to fit the temperature and the rejection threshold. Scoring folds embedding and softmax into one table,
so that a text costs one histogram and one product.

A softmax only tells the learned languages apart, so a second signal tells them from everything else: familiarity,
the mean log-likelihood of a text's subwords under the learned labels, averaged over the labels (a text mixed of two
learned languages is familiar). It counts ``PRIOR`` subwords of the usual familiarity, so that a short text is not
judged by a few letters.

``und`` with score 0 is given to null texts, texts without a letter, and everything when no label was learned.
A text is rejected when it is ``und``, when its score is below that of all but a thousandth of the calibration rows,
or when it is less familiar than the floor: the thousandth quantile of the sample, each row judged by the others,
moved away from the median by half their distance (``MARGIN``). Ties go to the first label by code point; repeated
rows get equal results. Extra columns are ignored by ``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.base import id_mix, map_rows

BUCKET_BITS = 14
ORDERS = (2, 3, 4)
PIECE = 1 << 20
REJECTED_SHARE = 0.001
MARGIN = 0.5
PRIOR = 50
SMOOTH = 0.5
UNKNOWN = "und"
_SAMPLE_SPACE = 1 << 30

_CLASS = np.full(256, 32, np.uint8)
for _b in (*range(97, 123), *range(128, 256)):
    _CLASS[_b] = _b
for _b in range(65, 91):
    _CLASS[_b] = _b + 32


def subword_counts(data: bytes) -> np.ndarray:
    """Occurrences of each bucket in the whole text."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    longest = max(ORDERS)
    for at in range(0, len(raw), PIECE):
        part = _CLASS[raw[at : at + PIECE + longest - 1]].astype(np.uint32)
        space = part == 32
        for n in ORDERS:
            m = min(PIECE, len(part) - n + 1)
            if m <= 0:
                continue
            packed, inner, ends = part[:m].copy(), np.zeros(m, bool), space[:m] & space[n - 1 : n - 1 + m]
            for k in range(1, n):
                packed = packed << np.uint32(8) | part[k : k + m]
                if k < n - 1:
                    inner |= space[k : k + m]
            packed = packed[~(inner | ends)]
            mixed = (packed + np.uint32(n * 0x51ED27)) * np.uint32(2654435761)
            counts += np.bincount(mixed >> np.uint32(32 - BUCKET_BITS), minlength=len(counts))
    return counts


def _packed(counts: np.ndarray) -> bytes:
    """The seen buckets as gaps, and their counts, compressed: about a quarter of two numbers a bucket."""
    seen = np.flatnonzero(counts)
    return zlib.compress(np.diff(seen, prepend=0).astype(np.uint16).tobytes() + counts[seen].astype(np.int32).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    size = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, np.uint16, size), dtype=np.uint16), np.frombuffer(raw, np.int32, size, 2 * size).copy()


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    table: np.ndarray  # bucket x label: embedding times softmax weights, at the fitted temperature
    bias: np.ndarray
    threshold: float
    familiar: np.ndarray  # log-likelihood of each bucket
    usual: float
    floor: float

    def score(self, data: bytes) -> tuple[str, float, bool]:
        """Label, score, and whether the text is rejected."""
        if not self.labels:
            return UNKNOWN, 0.0, True
        counts = subword_counts(data)
        seen = np.flatnonzero(counts)
        total = counts.sum()
        p = _softmax((counts[seen] @ self.table[seen] / max(1, total) + self.bias)[None, :])[0]
        best = int(p.argmax())
        known = _shrunk(counts[seen] @ self.familiar[seen], total, self.usual)
        return self.labels[best], float(p[best]), bool(p[best] < self.threshold or known < self.floor)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _shrunk(likelihood: float, n: int, usual: float) -> float:
    return float((likelihood + PRIOR * usual) / (n + PRIOR))


def familiarity(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_labels: int) -> tuple[np.ndarray, float, float]:
    """Log-likelihood of each bucket, its usual mean in a text, and the floor; a row is judged without its own counts."""
    size = 1 << BUCKET_BITS
    held = np.zeros((n_labels, size))
    for (bucket, n), label in zip(rows, y):
        held[label, bucket] += n
    total = held.sum(axis=1)
    likelihood, length = np.zeros(len(rows)), np.zeros(len(rows))
    for i, ((bucket, n), label) in enumerate(zip(rows, y)):
        part, rest = held[:, bucket], total.copy()
        part[label] -= n
        rest[label] -= n.sum()
        likelihood[i] = n @ np.log(((part + SMOOTH) / (rest + SMOOTH * size)[:, None]).mean(axis=0))
        length[i] = n.sum()
    some = length > 0
    usual = float(np.median(likelihood[some] / length[some])) if some.any() else 0.0
    known = [_shrunk(a, n, usual) for a, n in zip(likelihood, length)]
    middle, low = np.quantile(known, (0.5, REJECTED_SHARE))
    table = np.log(((held + SMOOTH) / (total + SMOOTH * size)[:, None]).mean(axis=0))
    return table, usual, float(low - MARGIN * (middle - low))


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Mean bucket counts of a few rows."""
    x = np.zeros((len(rows), 1 << BUCKET_BITS), np.float32)
    for i, (bucket, n) in enumerate(rows):
        x[i, bucket] = n / max(1, n.sum())
    return x


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, labels: list[str], dims: int = 16, epochs: int = 12,
          rate: float = 2.0, batch: int = 32, seed: int = 7) -> Model:
    """``rows``: seen buckets and their counts; ``y``: label indices. Every fifth row calibrates."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.3, (1 << BUCKET_BITS, dims)).astype(np.float32)
    weights, bias = np.zeros((dims, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    held = np.arange(len(rows)) % 5 == 4
    fit = np.flatnonzero(~held)
    scale = np.float32(20.0)  # means are small numbers; this keeps one rate good for both layers
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        order = rng.permutation(fit)
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            x = _dense([rows[i] for i in some])
            h = scale * (x @ embed)
            g = _softmax(h @ weights + bias)
            g[np.arange(len(some)), y[some]] -= 1
            g /= len(some)
            gh = g @ weights.T
            weights -= step * (h.T @ g)
            bias -= step * g.sum(axis=0)
            embed -= step * scale * (x.T @ gh)
    check = np.flatnonzero(held) if held.any() else fit
    z = np.concatenate([_dense([rows[i]]) @ embed for i in check]) @ weights * scale + bias
    best, loss = 1.0, np.inf
    for heat in np.geomspace(0.25, 16, 49):
        p = _softmax(z / heat)[np.arange(len(check)), y[check]]
        now = -np.log(np.maximum(p, 1e-12)).mean()
        if now < loss:
            best, loss = heat, now
    threshold = float(np.quantile(_softmax(z / best).max(axis=1), REJECTED_SHARE))
    table = (scale * (embed @ weights) / best).astype(np.float32)
    return Model(tuple(labels), table, bias / best, threshold, *familiarity(rows, y, len(labels)))


def _nothing_learned() -> Model:
    size = 1 << BUCKET_BITS
    return Model((), np.zeros((size, 0), np.float32), np.zeros(0, np.float32), 0.0, np.zeros(size), 0.0, 0.0)


def fit(docs: DataFrame, learn: Column, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
        max_per_label: int = 600, max_labels: int = 256) -> Model:
    """Train on about ``max_per_label`` rows of each of the ``max_labels`` most frequent labels where ``learn`` holds."""
    label = F.col(label_col)
    known = docs.where(learn & label.isNotNull() & F.col(text_col).isNotNull())
    counts = known.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    counts = {r["label"]: r["n"] for r in counts.orderBy(F.desc("n"), "label").limit(max_labels).collect()}
    labels = sorted(counts)
    if not labels:
        return _nothing_learned()
    cut = F.create_map(*(F.lit(v) for k in labels for v in (k, int(_SAMPLE_SPACE * min(1.0, max_per_label / counts[k])))))
    mix = id_mix(F.col(id_col), F.lit("language"))
    chosen = known.where(F.pmod(mix, F.lit(_SAMPLE_SPACE)) < F.element_at(cut, label))

    def features(mixed, name, data) -> Iterator[tuple]:
        yield mixed, name, _packed(subword_counts(data))

    schema = "mix long, label string, features binary"
    source = chosen.select(mix.alias("mix"), label.alias("label"), F.col(text_col).cast("binary").alias("data"))
    sample = map_rows(source, schema, features).limit(2 * max_per_label * len(labels)).toArrow()
    # Bounded: max_per_label times labels rows of at most two numbers per bucket, packed on the way and kept once.
    order = sorted(zip(sample["mix"].to_pylist(), sample["label"].to_pylist(), range(sample.num_rows)))
    if not order:
        return _nothing_learned()
    rows = [_unpacked(sample["features"][i].as_py()) for _, _, i in order]
    del sample
    return train(rows, np.array([labels.index(name) for _, name, _ in order]), labels)


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), prefix: str = ""
) -> DataFrame:
    """``keep`` columns and, with ``prefix``, ``lang_pred``, ``score`` and ``rejected`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)

    def row(*values) -> Iterator[tuple]:
        *kept, data, lettered = values
        yield *kept, *(shared.value.score(data) if lettered else (UNKNOWN, 0.0, True))

    text = F.col(text_col).cast("string")
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{prefix}lang_pred string, {prefix}score double, {prefix}rejected boolean"])
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return map_rows(docs.select(*keep, text.cast("binary").alias("__data"), lettered.alias("__lettered")), schema, row)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, unchanged."""
    kept = predict(docs, model, text_col, tuple(docs.columns), "__llm_")
    return kept.where(~F.col("__llm_rejected")).select(*docs.columns)
