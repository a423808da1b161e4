"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index is a bounded, reproducible sample of labelled rows, up to ``per_class`` of each label; texts that repeat
count once with their mean label. Terms are words and are kept when a chi-square test ties them to the label
(``max_terms`` at most). Postings lie in blocks of examples with the block's largest weight per term. A query sums
those maxima into an upper bound per block and scores blocks in falling order of bound until none can still reach
the k nearest; that is exact. Votes weigh by cosine, and a logistic curve fitted on left-one-out votes and the
number of indexed words in the text, weighted back to the label's share among all labelled rows, gives a calibrated score. Evidence is the
examples that voted.

Null and empty texts and texts without an indexed term have no neighbours and get the calibrated score of such
examples. Ties go to the smaller example number. Without labels of both kinds every text gets the share of label 1
(0 without any). Repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.base import id_mix, map_rows
from riskspark.sources.staging import stage

BLOCK = 64
CHI_SQUARE = 30.0  # strict, as every word of the sample is tested
_SPACE = 1 << 30
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(data: bytes | None) -> Counter:
    """Words (letters, digits, non-ASCII) of the whole text after lower-casing A-Z."""
    return Counter(_TERM.findall((data or b"").lower()))


@dataclass
class Index:
    """Postings by term, in blocks of examples; weights are unit-length TF-IDF."""

    term_ids: dict[bytes, int]
    idf: np.ndarray
    starts: np.ndarray  # first posting of each (term, block) entry
    entry_of_term: np.ndarray  # first entry of each term
    entry_block: np.ndarray
    entry_max: np.ndarray
    post_doc: np.ndarray
    post_weight: np.ndarray
    labels: np.ndarray
    names: list
    k: int = 15
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)  # vote, log of indexed words, constant
    empty: float = 0.0

    def query(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        found = [(self.term_ids[w], n) for w, n in counts.items() if w in self.term_ids]
        found.sort()
        t = np.array([i for i, _ in found], np.int64)
        w = (1 + np.log(np.array([n for _, n in found], float))) * self.idf[t]
        length = math.sqrt((w * w).sum())
        return t, w / length if length else w

    def nearest(self, t: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines of the k nearest with a common term."""
        if not len(t):
            return np.empty(0, np.int64), np.empty(0)
        entries = [np.arange(self.entry_of_term[i], self.entry_of_term[i + 1]) for i in t]
        weights = np.repeat(w, [len(e) for e in entries])
        entries = np.concatenate(entries)
        blocks = self.entry_block[entries]
        bound = np.bincount(blocks, weights * self.entry_max[entries])
        order = np.argsort(-bound, kind="stable")
        by_block = np.argsort(blocks, kind="stable")
        first = np.searchsorted(blocks[by_block], np.arange(len(bound) + 1))
        best_docs, best = np.empty(0, np.int64), np.empty(0)
        for at in range(0, len(order), 4):
            some = order[at : at + 4]
            if bound[some[0]] <= 0 or (len(best) == self.k and bound[some[0]] < best[-1] - 1e-12):
                break
            docs, scores = [], []
            for b in some:
                mine = by_block[first[b] : first[b + 1]]
                total = np.zeros(BLOCK)
                for e in mine:
                    a, z = self.starts[entries[e]], self.starts[entries[e] + 1]
                    total[self.post_doc[a:z] - b * BLOCK] += weights[e] * self.post_weight[a:z]
                hit = np.flatnonzero(total > 0)
                docs.append(hit + b * BLOCK)
                scores.append(total[hit])
            best_docs, best = np.concatenate([best_docs, *docs]), np.concatenate([best, *scores])
            if skip >= 0:
                best, best_docs = best[best_docs != skip], best_docs[best_docs != skip]
            keep = np.lexsort((best_docs, -best))[: self.k]
            best_docs, best = best_docs[keep], best[keep]
        return best_docs, best

    def vote(self, docs: np.ndarray, cosines: np.ndarray) -> float:
        weight = cosines**2
        return float((weight * self.labels[docs]).sum() / weight.sum()) if weight.sum() > 0 else 0.0

    def features(self, counts: Counter, docs: np.ndarray, cosines: np.ndarray) -> tuple[float, float, float]:
        seen = sum(n for w, n in counts.items() if w in self.term_ids)
        return self.vote(docs, cosines), math.log1p(seen), 1.0

    def score(self, data: bytes | None) -> tuple[float, list[tuple]]:
        counts = terms(data)
        docs, cosines = self.nearest(*self.query(counts))
        if not len(docs):
            return self.empty, []
        z = sum(a * b for a, b in zip(self.curve, self.features(counts, docs, cosines)))
        p = 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))
        return p, [(self.names[d], float(self.labels[d]), float(c)) for d, c in zip(docs, cosines)]


def build(examples: list[tuple], vocabulary: list[bytes], share: float, k: int) -> Index:
    """``examples``: (name, label, {term: count}); ``share``: label 1 among all labelled rows."""
    merged: dict[tuple, list] = {}
    for name, label, counts in examples:
        merged.setdefault(tuple(sorted(counts.items())), []).append((name, label))
    kept = sorted((min(str(n) for n, _ in v), v[0][0], float(np.mean([y for _, y in v])), len(v), c) for c, v in merged.items())
    with_terms = [e for e in kept if e[4]]
    names, labels = [e[1] for e in with_terms], np.array([e[2] for e in with_terms])
    ids = {w: i for i, w in enumerate(vocabulary)}
    df = np.zeros(len(vocabulary))
    for e in with_terms:
        for w, _ in e[4]:
            df[ids[w]] += 1
    idf = np.log((1 + len(with_terms)) / (1 + df)) + 1
    rows = []
    for d, e in enumerate(with_terms):
        weight = {ids[w]: (1 + math.log(n)) * idf[ids[w]] for w, n in e[4]}
        length = math.sqrt(sum(v * v for v in weight.values()))
        rows += [(t, d, v / length) for t, v in weight.items()]
    rows.sort()
    term, doc = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    weight = np.array([r[2] for r in rows])
    key = term * (len(with_terms) // BLOCK + 1) + doc // BLOCK
    opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    index = Index(
        ids, idf, np.append(opens, len(rows)), np.searchsorted(term[opens], np.arange(len(vocabulary) + 1)), doc[opens] // BLOCK,
        np.maximum.reduceat(weight, opens) if len(opens) else weight, doc, weight, labels, names, k,
    )
    # Left-one-out votes; weights bring the classes back to their share of all labelled rows.
    votes, ys, ns = [], [], []
    for d, e in enumerate(with_terms):
        counts = Counter(dict(e[4]))
        docs, cosines = index.nearest(*index.query(counts), skip=d)
        votes.append(index.features(counts, docs, cosines))
        ys.append(e[2])
        ns.append(e[3])
    ones = sum(y for _, y, _ in examples)
    up, down = share / max(1, ones), (1 - share) / max(1, len(examples) - ones)
    index.curve = _logistic(np.array(votes).reshape(-1, 3), np.array(ys), np.array(ns, float), up, down)
    blank = [(e[2] * e[3], e[3]) for e in kept if not e[4]]
    one, all_ = sum(b[0] for b in blank), sum(b[1] for b in blank)
    mass = up * one + down * (all_ - one)
    index.empty = float((up * one + share / len(examples)) / (mass + 1 / len(examples))) if examples else share
    return index


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, up: float, down: float) -> tuple[float, ...]:
    """Weights by Newton's method; y may be a mean label of n rows. A small ridge keeps separable data finite."""
    w, ridge = np.zeros(x.shape[1]), 0.05 * np.eye(x.shape[1])
    pos, neg = len(x) * up * y * n, len(x) * down * (1 - y) * n
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        v = np.maximum((pos + neg) * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * v[:, None]).T @ x + ridge, x.T @ ((pos + neg) * p - pos) + ridge @ w)
        w = w - step
        if abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = 2000, max_terms: int = 2048, min_rows: int = 3, k: int = 15) -> Index:
    """Index up to about ``per_class`` labelled rows of each label; ``learn`` is a condition on the labels' id."""
    label = F.col(label_col).cast("int")
    known = labels.where(learn & label.isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), label.alias("__label"))
    counts = {r["__label"]: r["n"] for r in known.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return Index({}, np.empty(0), *(np.zeros(1, np.int64) for _ in range(2)), *(np.empty(0) for _ in range(5)), [], k, empty=share)
    cut = F.when(F.col("__label") == 1, int(_SPACE * min(1, per_class / counts[1]))).otherwise(int(_SPACE * min(1, per_class / counts[0])))
    chosen = known.where(F.pmod(id_mix(F.col("__id"), F.lit("toxicity")), F.lit(_SPACE)) < cut).limit(4 * per_class)
    # At most 4 * per_class rows of two numbers: a proven bound.
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select(
        F.col(id_col).cast("string").alias("name"), F.col("__label").alias("label"), F.col(text_col).cast("binary").alias("data")
    )

    def split(name, y, data) -> Iterator[tuple]:
        counts = terms(data)
        yield name, y, [w for w in counts], [n for n in counts.values()]

    rows = stage(map_rows(sample, "name string, label int, terms array<binary>, counts array<int>", split))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Index({}, np.empty(0), *(np.zeros(1, np.int64) for _ in range(2)), *(np.empty(0) for _ in range(5)), [], k, empty=share)
    by_term = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b")
    ).where(F.col("a") + F.col("b") >= min_rows)
    a, b, n = F.col("a"), F.col("b"), float(n1 + n0)
    chi = n * F.pow(a * (n0 - b) - b * (n1 - a), 2) / ((a + b) * (n - a - b + 1e-9) * n1 * n0)
    vocabulary = stage(by_term.withColumn("chi", chi).where(F.col("chi") > CHI_SQUARE).orderBy(F.desc("chi"), "term").limit(max_terms).select("term"))
    words = sorted(bytes(r["term"]) for r in vocabulary.collect())
    found = rows.select("name", "label", F.arrays_zip("terms", "counts").alias("z"))
    wanted = set(words)

    def only(name, y, z) -> Iterator[tuple]:
        kept = [(bytes(p["terms"]), p["counts"]) for p in z if bytes(p["terms"]) in wanted]
        yield name, y, [w for w, _ in kept], [c for _, c in kept]

    small = map_rows(found, "name string, label int, terms array<binary>, counts array<int>", only)
    examples = [(r["name"], r["label"], {bytes(w): c for w, c in zip(r["terms"], r["counts"])}) for r in small.collect()]
    examples.sort(key=lambda e: (e[0], e[1]))
    return build(examples, words, share, k)


def predict(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence): calibrated score of every whole text and the examples that voted."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def row(doc_id, data) -> Iterator[tuple]:
        score, found = shared.value.score(data)
        yield doc_id, score, [{"example": n, "label": y, "cosine": c} for n, y, c in found]

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double, evidence array<struct<example:string,label:double,cosine:double>>"
    return map_rows(docs.select(id_col, F.col(text_col).cast("binary")), schema, row)
