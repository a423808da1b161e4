"""SimHash near-duplicates by anchor-point covering.

Anchors are the codewords of two perfect binary Golay codes side by side, over 46 of the 64 bits: every
fingerprint has exactly one codeword within 3 bits of each half, its home. A fingerprint linked to it by at most
``bits`` differing bits lies at most that many bits further out, summed over the halves, so each fingerprint is
replicated to all codewords in that range (about 61 for two bits) and every link meets at the home of either
end. Fingerprints are compared per anchor on all 64 bits. Only distinct fingerprints are replicated, and each
anchor reports a spanning forest of its links, which keeps components whole without listing pairs.

Words are runs of non-whitespace after lower-casing A-Z; a fingerprint takes all 3-word shingles, repeats
included. A text of one or two words is one shingle; no words (null, empty) give fingerprint zero, which links
like any other. Repeated rows share a fingerprint. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.base import map_rows
from riskspark.llm.components import components
from riskspark.sources.staging import stage

GOLAY = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LENGTH, RADIUS = 23, 3
SEED = 42
PAIRWISE = 2048  # above so many fingerprints at an anchor, neighbours are looked up instead of compared
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(data: bytes | None, width: int = 3) -> int:
    """64 unsigned bits."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist())), np.uint64, n
    )
    by_byte = hashes.view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(by_byte[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = 3) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["fp long"])

    def row(*values) -> Iterator[tuple]:
        yield *values[:-1], _signed(fingerprint(values[-1], width))

    return map_rows(docs.select(*keep, F.col(text_col).cast("binary")), schema, row)


@lru_cache(1)
def _syndromes() -> np.ndarray:
    table = np.zeros(1 << LENGTH, np.uint16)
    low = np.zeros(LENGTH, np.int64)
    for i in range(LENGTH):
        r = 1 << i
        for j in range(i, 10, -1):
            if r >> j & 1:
                r ^= GOLAY << (j - 11)
        low[i] = r
    for i in range(LENGTH):
        table[1 << i : 2 << i] = table[: 1 << i] ^ low[i]
    return table


@lru_cache(4)
def _moves(bits: int) -> tuple[np.ndarray, ...]:
    """For each pair of halves: the error patterns of each syndrome, in rows, by how far beyond the radius they reach."""
    found: list[list[list[int]]] = [[[] for _ in range(1 << 11)] for _ in range(bits + 1)]
    syndromes = _syndromes()
    for weight in range(RADIUS + bits + 1):
        for at in combinations(range(LENGTH), weight):
            pattern = sum(1 << i for i in at)
            found[max(0, weight - RADIUS)][syndromes[pattern]].append(pattern)
    return tuple(tuple(np.array(p, np.int64) for p in level) for level in found)


def anchors(fp: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All anchors of one fingerprint, the home first, and which is the home."""
    syndromes, moves = _syndromes(), _moves(bits)
    mask = (1 << LENGTH) - 1
    a, b = fp & mask, fp >> LENGTH & mask
    out = []
    for i in range(bits + 1):
        left = moves[i][syndromes[a]] ^ a
        for j in range(bits + 1 - i):
            right = moves[j][syndromes[b]] ^ b
            out.append((left[:, None] | right[None, :] << LENGTH).ravel())
    found = np.concatenate(out)
    home = np.zeros(len(found), bool)
    home[0] = True
    return found, home


def _replicate(bits: int):
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 1024):
                part = values[at : at + 1024]
                found = [anchors(int(x) & 0xFFFFFFFFFFFFFFFF, bits) for x in part]
                sizes = [len(f) for f, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([f for f, _ in found])),
                        pa.array(np.repeat(part, sizes)),
                        pa.array(np.concatenate([h for _, h in found])),
                    ],
                    schema=schema,
                )

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each component of n nodes under edges (a, b)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label != label[label]).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _links(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among distinct fingerprints of one anchor."""
    fp = np.unique(fp)
    label = np.arange(len(fp))
    if len(fp) <= PAIRWISE:
        step = max(1, (1 << 20) // len(fp))
        pairs = [np.nonzero(np.bitwise_count(fp[i : i + step, None] ^ fp[None, :]) <= bits) for i in range(0, len(fp), step)]
        rows = np.concatenate([p[0] + k * step for k, p in enumerate(pairs)])
        label = _forest(len(fp), rows, np.concatenate([p[1] for p in pairs]))
    else:
        for weight in range(1, bits + 1):
            for at in combinations(range(64), weight):
                other = fp ^ np.uint64(sum(1 << i for i in at))
                where = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
                hit = np.flatnonzero(fp[where] == other)
                if len(hit):
                    label = _forest(len(fp), np.concatenate([np.arange(len(fp)), hit]), np.concatenate([label, where[hit]]))
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked].view(np.int64), fp[label[linked]].view(np.int64)


def _compare(bits: int, step: int = 1 << 16):
    """Links per anchor, over rows sorted by anchor; a group is held until the next anchor begins."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def done(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        sizes = np.diff(np.append(starts, len(anchor)))
        out = []
        small = np.repeat(sizes <= 32, sizes)
        for gap in range(1, min(32, int(sizes.max(initial=1)))):
            i = np.flatnonzero((anchor[gap:] == anchor[:-gap]) & small[gap:] & (home[gap:] | home[:-gap]))
            i = i[np.bitwise_count(fp[i] ^ fp[i + gap]) <= bits]
            out.append((fp[i].view(np.int64), fp[i + gap].view(np.int64)))
        for k in np.flatnonzero(sizes > 32):
            out.append(_links(fp[starts[k] : starts[k] + sizes[k]], bits))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            anchor, fp, home = (np.concatenate(c) for c in zip(*held))
            cut = len(anchor) if last else int(np.searchsorted(anchor, anchor[-1]))
            held = [(anchor[cut:], fp[cut:], home[cut:])]
            count = len(anchor) - cut
            if cut:
                found = done(anchor[:cut], fp[:cut], home[:cut])
                u, v = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for batch in batches:
            held.append(
                (batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False))
            )
            count += batch.num_rows
            if count >= max(step, 2 * len(held[0][0])):
                yield from flush(False)
        if held:
            yield from flush(True)

    return run


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """(u, v): links of distinct ``fp`` values, enough of them to hold every component together."""
    copies = distinct.select("fp").mapInArrow(_replicate(bits), "anchor long, fp long, home boolean")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = copies.repartition(n, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(_compare(bits), "u long, v long")


def groups(fps: DataFrame, bits: int = 2) -> DataFrame:
    """``fps`` (with ``fp``) and ``root``, a fingerprint that stands for the component. ``fps`` should be staged."""
    distinct = stage(fps.select("fp").distinct())
    roots = stage(components(links(distinct, bits)))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select(
        *(fps[c] for c in fps.columns), F.coalesce("root", fps["fp"]).alias("root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 2) -> DataFrame:
    """(id, fp, component_id): the smallest id that links reach, itself included."""
    found = stage(groups(stage(fingerprints(docs, text_col, (id_col,))), bits))
    # Written first: a join of two shuffles splits the rows of a large group, an aggregate's own shuffle would not.
    least = stage(found.groupBy("root").agg(F.min(id_col).alias("component_id")))
    return found.join(least.withColumnRenamed("root", "__root"), F.col("root") == F.col("__root")).select(
        id_col, "fp", "component_id"
    )


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest id, and of repeated ids one row."""
    numbered = stage(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = stage(groups(stage(fingerprints(numbered, text_col, (id_col, "__row"))), bits))
    first = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("__row").alias("r"))
    kept = found.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.r").alias("__kept"))
    return numbered.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(*docs.columns)
