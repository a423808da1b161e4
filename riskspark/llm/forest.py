"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long hash string (signs against random planes, then bits that order equal strings by
id) and keeps all strings sorted. A query descends to its longest matching prefix in every tree and then ascends
in all trees at once, one bit at a time, until the ranges of strings with that prefix hold enough candidates.
Trees are cut into parts of bounded size at quantiles of a bounded sample; a query visits the parts that its
range overlaps, scores all vectors of the range exactly, and the best of all trees are merged.

Inner products become angles by one more component that gives all vectors the same length; queries get zero there.
Hashes use planes drawn from a fixed seed. The sample (``sample_rows``, chosen by a mix of ids) sets part bounds and
estimates how many strings a prefix has; every vector is indexed. Candidates per query grow with the square root
of the table (``breadth``).

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor
do rows without id. A repeated id counts once with its best score, and a query never finds its own id. Ties go to
the smaller id. Fewer candidates than ``k`` give fewer rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from riskspark.llm.base import id_mix
from riskspark.sources.staging import stage

BITS = 44
TIE_BITS = 63 - BITS
EXACT_STEP = 128


@dataclass(frozen=True)
class Forest:
    planes: np.ndarray  # (dims + 1) x (trees * BITS)
    trees: int
    length2: float  # largest squared length
    first_id: int
    id_range: int
    sample: np.ndarray  # trees x rows, sorted strings
    cuts: np.ndarray  # trees x parts - 1
    rows: int
    wanted: int

    def strings(self, x: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """rows x trees hash strings; without ids (queries) the ordering bits are zero and the added component too."""
        gap = np.sqrt(np.maximum(0, self.length2 - (x * x).sum(axis=1))) if ids is not None else np.zeros(len(x))
        signs = (np.hstack([x, gap[:, None]]) @ self.planes > 0).reshape(len(x), self.trees, BITS)
        powers = np.int64(1) << np.arange(BITS - 1 + TIE_BITS, TIE_BITS - 1, -1, dtype=np.int64)
        out = signs.astype(np.int64) @ powers
        if ids is not None:
            place = (ids - self.first_id).astype(np.float64) / self.id_range
            out += np.minimum((place * (1 << TIE_BITS)).astype(np.int64), (1 << TIE_BITS) - 1)[:, None]
        return out

    def ranges(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last string of each tree's range, for one query's strings: the deepest level with enough rows."""
        scale = self.rows / max(1, self.sample.shape[1])
        low, high = 0, BITS + TIE_BITS

        def at(level: int) -> tuple[np.ndarray, np.ndarray, float]:
            free = np.int64((1 << (BITS + TIE_BITS - level)) - 1)
            first, last = strings & ~free, strings | free
            n = sum(
                np.searchsorted(s, b, "right") - np.searchsorted(s, a) for s, a, b in zip(self.sample, first, last)
            )
            return first, last, float(n) * scale

        while low < high:  # the count falls with the level
            middle = (low + high + 1) // 2
            low, high = (middle, high) if at(middle)[2] >= self.wanted else (low, middle - 1)
        first, last, _ = at(low)
        return first, last


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, vec as array of doubles, and their number of components."""
    vec = F.col(vector_col).cast("array<double>")
    limit = F.lit(1e150)
    fine = F.forall(vec, lambda v: v.isNotNull() & (F.abs(v) < limit)) & F.exists(vec, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(fine, F.lit(False))
    )
    most = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = most["d"] if most else 0
    return rows.where(F.size("vec") == dims), dims


def grow(rows: DataFrame, dims: int, trees: int, breadth: float, sample_rows: int, part_rows: int, seed: int) -> Forest:
    length2 = F.aggregate(F.col("vec"), F.lit(0.0), lambda s, v: s + v * v)
    got = rows.agg(F.count("*").alias("n"), F.max(length2).alias("l"), F.min("id").alias("a"), F.max("id").alias("b")).first()
    n = got["n"]
    planes = np.random.default_rng(seed).normal(size=(dims + 1, trees * BITS))
    plain = Forest(
        planes, trees, got["l"] or 0.0, got["a"] or 0, max(1, (got["b"] or 0) - (got["a"] or 0) + 1),
        np.empty((trees, 0), np.int64), np.empty((trees, 0), np.int64), n, math.ceil(breadth * math.sqrt(max(n, 1)) * trees),
    )
    share = min(1.0, sample_rows / max(1, n))
    space = 1 << 30
    taken = rows.where(F.pmod(id_mix(F.col("id"), F.lit("forest")), F.lit(space)) < int(share * space) + 1).limit(2 * sample_rows)
    local = taken.toArrow()
    if not local.num_rows:
        return plain
    ids = local.column("id").to_numpy()
    x = _matrix(local.column("vec").combine_chunks(), dims)
    sample = np.sort(np.concatenate([plain.strings(x[i : i + 1024], ids[i : i + 1024]) for i in range(0, len(x), 1024)]), axis=0).T.copy()
    parts = max(1, min(n // max(part_rows, plain.wanted // trees), len(x) // 4))
    at = (np.arange(1, parts) * len(x)) // parts
    return Forest(planes, trees, plain.length2, plain.first_id, plain.id_range, sample, sample[:, at].copy(), n, plain.wanted)


_ENTRY = pa.schema(
    [("tree", pa.int32()), ("part", pa.int32()), ("string", pa.int64()), ("last", pa.int64()), ("id", pa.int64()),
     ("query", pa.bool_()), ("vec", pa.binary())]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _entries(shared, dims: int, every: int):
    """One entry per tree for each vector; for each query, one per part that its range overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids = batch.column("id").to_numpy()
                x = _matrix(batch.column("vec"), dims)
                out: list[list] = [[] for _ in _ENTRY]
                strings = forest.strings(x, ids)
                packed = [v.tobytes() for v in x]
                for t in range(forest.trees):
                    parts = np.searchsorted(forest.cuts[t], strings[:, t], "right")
                    for column, values in zip(
                        out, ([t] * len(ids), parts.tolist(), strings[:, t].tolist(), [0] * len(ids), ids.tolist(), [False] * len(ids), packed)
                    ):
                        column += values
                asked = np.flatnonzero(ids % every == 0)
                for i, own in zip(asked, forest.strings(x[asked], None)):
                    first, last = forest.ranges(own)
                    for t in range(forest.trees):
                        a, b = np.searchsorted(forest.cuts[t], (first[t], last[t]), "right")
                        for part in range(int(a), int(b) + 1):
                            for column, value in zip(out, (t, part, int(first[t]), int(last[t]), int(ids[i]), True, packed[i])):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ENTRY)], schema=_ENTRY)

    return run


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def _search(dims: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        vec = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(-1, dims)
        asks = table.column("query").to_numpy()
        string, ids = table.column("string").to_numpy(), table.column("id").to_numpy()
        data = np.flatnonzero(~asks)
        data = data[np.lexsort((ids[data], string[data]))]
        x, own, sorted_ = vec[data], ids[data], string[data]
        q = np.flatnonzero(asks)
        first = np.searchsorted(sorted_, string[q])
        last = np.searchsorted(sorted_, table.column("last").to_numpy()[q], "right")
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(q), EXACT_STEP):
            some = slice(at, at + EXACT_STEP)
            rough = vec[q[some]] @ x.T
            for i, a, b, line in zip(q[some], first[some], last[some], rough):
                near = np.arange(a, b)[own[a:b] != ids[i]]
                if len(near) > k:
                    kth = np.partition(line[near], len(near) - k)[len(near) - k]
                    near = near[line[near] >= kth - 1e-9 * (1 + abs(kth))]
                # Products summed in one fixed order, so that equal vectors get equal scores in every tree.
                score = (x[near] * vec[i]).sum(axis=1)
                top = best_of(score, own[near], k)
                out.append((np.full(len(top), ids[i]), own[near][top], score[top]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, f.type.to_pandas_dtype()) for f in _FOUND]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=_FOUND)

    return run


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
    trees: int = 24, breadth: float = 12.0, sample_rows: int = 16384, part_rows: int = 4096, seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, by inner product, of every id divisible by ``every``."""
    rows, dims = usable(vectors, id_col, vector_col)
    rows = stage(rows)
    forest = grow(rows, dims, trees, breadth, sample_rows, part_rows, seed)
    shared = rows.sparkSession.sparkContext.broadcast(forest)
    entries = rows.mapInArrow(
        _entries(shared, dims, every),
        "tree int, part int, string long, last long, id long, query boolean, vec binary",
    )
    found = entries.groupBy("tree", "part").applyInArrow(_search(dims, k), "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
