"""Suffix-array dedup of exact repeats: Burrows-Wheeler transforms of shards, merged by interleave refinement.

Result: each byte covered by a ``length``-byte string that also starts anywhere else is removed. Suffixes compare
by symbols of ``SYMBOL`` bytes, so ``length`` bytes are ``length / SYMBOL`` refinement rounds.

1. Every start of a string has an anchor, the smallest hashed ``SEED_LENGTH``-gram in it; equal strings have equal
   anchors at equal places. Anchors seen once cannot lie in a repeat, so their starts need no suffix order.
2. Starts with a repeated anchor keep their context, the bytes that their strings span. Equal contexts collapse to
   one with a weight before they are shuffled by anchor, so copies cost little.
3. Contexts of an anchor come from several shards of documents. Each shard's transform is built alone; merging scans
   the transforms in the order of the current interleave and places each entry by its preceding symbol. The round
   in which neighbours part is their common prefix in symbols; blocks that never part are the repeated intervals,
   and those of weight two or more give the starts to remove. No suffix is compared or sorted again.
4. Runs of removed bytes are put together per text.

An anchor with very many different contexts is cut finer: its contexts are split into pieces of few starts and
keyed by the bytes that all strings of the piece share, and beyond that into single strings, which Spark counts.

Null texts count as empty; texts shorter than ``length`` keep all bytes. Equal texts share one result, so repeated
ids or rows do no harm. An empty table gives an empty table. Extra columns are ignored. Texts are told apart by 80
bits of hash, symbols by 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.base import map_rows
from riskspark.sources.staging import stage

LENGTH, SYMBOL, SEED_LENGTH = 200, 50, 40
PIECE = 1 << 19  # starts of a long text handled at a time
PIECE_STARTS = 16
CHUNK = 1 << 18  # bytes of contexts merged at a time; small arrays stay in the processor's caches
SHARDS = 4
WIDE, HUGE = 1024, 65536  # different contexts of an anchor beyond which it is cut finer, and finest
_FACTOR = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(PIECE + LENGTH + 1, _FACTOR)
_DOWN = _powers(PIECE + LENGTH + 1, pow(_FACTOR, -1, 1 << 64))


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from every place; the same bytes hash alike anywhere."""
    out = []
    step = len(_UP) - width
    for at in range(0, len(data) - width + 1, step):
        part = data[at : at + step + width - 1]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=total[1:])
        h = (total[width:] - total[:-width]) * _DOWN[: len(part) - width + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Hash, first start, place of the anchor after it, and number of starts of each run of starts with one anchor."""
    found: list[list[np.ndarray]] = [[], [], [], []]
    window = length - SEED_LENGTH + 1
    for at in range(0, len(data) - length + 1, PIECE):
        hashes = gram_hashes(data[at : at + PIECE + length - 1], SEED_LENGTH)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        have = 1
        while have < window:
            step = min(have, window - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        for out, values in zip(found, (hashes[place[first]], first + at, place[first] - first, np.diff(np.append(first, len(place))))):
            out.append(values)
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in found)


def _pack(start: np.ndarray, after: np.ndarray, count: np.ndarray, mark: int) -> np.ndarray:
    return start << 32 | after << 24 | (count - 1) << 16 | mark


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text: its anchors, a digest of each context, and their places."""
    schema = pa.schema([("text", pa.int64()), ("a", pa.list_(pa.struct([("anchor", pa.int64()), ("digest", pa.int64()), ("at", pa.int64())])))])
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        ids, arrays = [], []
        for i in range(batch.num_rows):
            data = batch.column(2)[i].as_py()
            hashes, start, after, count = anchors(np.frombuffer(data, np.uint8))
            if len(hashes):
                ends = (start + count + (LENGTH - 1)).tolist()
                marks = np.fromiter((digest(data[a:b]) for a, b in zip(start.tolist(), ends)), np.uint64, len(start))
                ids.append(batch.column(0)[i].as_py())
                arrays.append((hashes.view(np.int64), marks.view(np.int64), _pack(start, after, count, batch.column(1)[i].as_py() & 0xFFFF)))
            if len(ids) >= 512 or (ids and i == batch.num_rows - 1):
                offsets = np.concatenate([[0], np.cumsum([len(x[0]) for x in arrays])])
                parts = [pa.array(np.concatenate([x[k] for x in arrays])) for k in range(3)]
                items = pa.StructArray.from_arrays(parts, names=["anchor", "digest", "at"])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)], schema=schema)
                ids, arrays = [], []


_CONTEXT = pa.schema(
    [("key", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("weight", pa.int64()), ("owners", pa.binary()), ("context", pa.binary())]
)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pieces(data: bytes, anchor: int, start: int, after: int, count: int) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of a run's contexts in pieces, cut at fixed distances from the anchor."""
    place, end = start + after, start + count
    while start < end:
        group = (place - start) // PIECE_STARTS
        stop = min(end, place - group * PIECE_STARTS + 1)
        core = data[place - group * PIECE_STARTS : place - (group + 1) * PIECE_STARTS + 1 + LENGTH]
        yield _signed(xxhash.xxh3_64_intdigest(core, anchor & 0xFFFFFFFF)), start, stop
        start = stop


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the repeated anchors of each text, equal ones of a batch collapsed."""
    for batch in batches:
        found: dict[tuple, list] = {}

        def add(key: int, data: bytes, start: int, end: int, text: int, mark: int) -> None:
            context = data[start : end + LENGTH - 1]
            c = xxhash.xxh3_128_intdigest(context)
            entry = found.get((key, c))
            if entry is None:
                entry = found[key, c] = [0, set(), context]
            entry[0] += 1
            entry[1].add((text, start << 16 | mark))

        def flush() -> pa.RecordBatch:
            rows = [
                (key, _signed(c >> 64), _signed(c & 0xFFFFFFFFFFFFFFFF), n, np.array(sorted(owners), np.int64).tobytes(), context)
                for (key, c), (n, owners, context) in found.items()
            ]
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _CONTEXT)], schema=_CONTEXT)

        for i in range(batch.num_rows):
            text, mark, data, listed = (batch.column(k)[i].as_py() for k in range(4))
            for item in listed:
                at, anchor = item["at"], item["anchor"]
                if at & 0xFFFF != mark & 0xFFFF:
                    continue  # another text with the same 64 bits
                start, after, count = at >> 32, at >> 24 & 0xFF, (at >> 16 & 0xFF) + 1
                if item["wide"]:
                    for key, a, b in _pieces(data, anchor, start, after, count):
                        add(key, data, a, b, text, mark & 0xFFFF)
                else:
                    add(anchor, data, start, start + count, text, mark & 0xFFFF)
            if len(found) >= 50_000:
                yield flush()
                found.clear()
        if found:
            yield flush()


def _stable(symbols: np.ndarray) -> np.ndarray:
    """Stable order of symbols (32 bits, unsigned), by one counting pass or two."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    if len(symbols) and symbols.max() > 0xFFFF:
        order = order[np.argsort((symbols[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Shard:
    """Burrows-Wheeler transform of contexts over symbols: each context is one string per residue of its places."""

    def __init__(self, before: np.ndarray, leads_to: np.ndarray, places: np.ndarray, rounds: int):
        order = leads_to[_stable(before)]
        for _ in range(rounds - 1):  # sorts by the first ``rounds`` symbols, last symbol first
            order = leads_to[order[_stable(before[order])]]
        self.transform = before[order]
        self.suffixes = places[order]


def merge(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all suffixes in merged order, their block of equal prefixes, and common prefixes with the one before."""
    origin = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.transform) for s in shards])
    transforms = np.concatenate([s.transform for s in shards])
    block = np.zeros(len(origin), np.int32)
    prefix = np.full(len(origin), rounds, np.int8)
    symbols = np.empty_like(transforms)
    parted = np.ones(len(origin), bool)
    for done in range(rounds):
        symbols[np.argsort(origin, kind="stable")] = transforms  # each shard's transform, read in its own order
        order = _stable(symbols)
        origin, block, sorted_ = origin[order], block[order], symbols[order]
        parted[1:] = (sorted_[1:] != sorted_[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(parted, dtype=np.int32) - 1
        prefix = np.where(parted, done, rounds)
    places = np.empty(len(origin), np.int32)
    places[np.argsort(origin, kind="stable")] = np.concatenate([s.suffixes for s in shards])
    return places, block, prefix


def repeated_starts(contexts: list[bytes], weights: np.ndarray, length: int = LENGTH, symbol: int = SYMBOL, shards: int = SHARDS) -> list[np.ndarray]:
    """For each context, which of its starts begin a string of weight two or more among all contexts.

    Only symbols that occur in more than one place, or in a context of weight two or more, can lie in such a string;
    all others share one number, and no start whose string holds that number is repeated.
    """
    rounds = length // symbol
    sizes = np.array([len(c) for c in contexts])
    joined = np.frombuffer(b"".join(contexts), np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    # Places 0..size of a context; one more than its bytes, for the strings' ends.
    starts = (begins[:-1] + np.arange(len(sizes))).astype(np.int32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    inside = np.arange(len(owner), dtype=np.int32) - starts[owner]
    has = np.flatnonzero(inside >= symbol).astype(np.int32)
    at = has - symbol - owner[has]  # place in the joined bytes of the symbol before
    _, dense, times = np.unique(gram_hashes(joined, symbol)[at], return_inverse=True, return_counts=True)
    heavy = np.zeros(len(times), bool)
    heavy[dense[weights[owner[has]] > 1]] = True
    kept = heavy | (times > 1)
    number = np.where(kept, np.cumsum(kept) + 1, 1).astype(np.uint32)  # 0: no symbol before, 1: the lone ones
    before = np.zeros(len(owner), np.uint32)
    before[has] = number[dense]
    # A suffix leads to the one a symbol earlier; a string's first one to its end.
    leads = (starts + sizes)[owner] - (sizes[owner] - inside) % symbol
    leads[has] = has - symbol
    parts, which = [], (np.arange(len(sizes)) % shards).astype(np.int8)
    local = np.empty(len(owner), np.int32)
    for k in range(shards):
        mine = np.flatnonzero(which[owner] == k).astype(np.int32)
        if len(mine):
            local[mine] = np.arange(len(mine), dtype=np.int32)
            parts.append(Shard(before[mine], local[leads[mine]], mine, rounds))
    places, block, _ = merge(parts, rounds)
    weight = np.bincount(block, weights[owner[places]])
    hit = np.zeros(len(owner), bool)
    hit[places[weight[block] >= 2]] = True
    start = np.flatnonzero(hit & (inside <= (sizes - length)[owner]))
    lone = np.zeros(len(start), bool)
    for k in range(1, rounds + 1):
        lone |= before[start + k * symbol] == 1
    hit[:] = False
    hit[start[~lone]] = True
    return [hit[a : a + n - length + 1] for a, n in zip(starts.tolist(), sizes.tolist())]


_COVER = pa.schema([("text", pa.int64()), ("mark", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered ranges of texts, from contexts sorted by key; a chunk ends where a key does."""
    held: dict[tuple, list] = {}
    size, last = 0, None

    def flush() -> Iterator[pa.RecordBatch]:
        entries = list(held.values())
        hits = repeated_starts([e[2] for e in entries], np.array([e[0] for e in entries], float))
        rows: list[np.ndarray] = []
        for (_, owners, _), hit in zip(entries, hits):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            if len(edges):
                who = np.frombuffer(b"".join(owners), np.int64).reshape(-1, 2)
                who = np.unique(who, axis=0) if len(owners) > 1 else who
                for a, b in edges.reshape(-1, 2):
                    at = who[:, 1] >> 16
                    rows.append(np.stack([who[:, 0], who[:, 1] & 0xFFFF, at + a, at + b - 1 + LENGTH], axis=1))
        if rows:
            out = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, k].astype(f.type.to_pandas_dtype())) for k, f in enumerate(_COVER)], schema=_COVER)

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(6)]
        for key, c1, c2, weight, owners, context in zip(*columns):
            if key != last and size >= CHUNK:
                yield from flush()
                held.clear()
                size = 0
            last = key
            entry = held.get((key, c1, c2))
            if entry is None:
                held[key, c1, c2] = [weight, [owners], context]
                size += len(context)
            else:
                entry[0] += weight
                entry[1].append(owners)
    if held:
        yield from flush()


def _text_key(data: Column) -> list[Column]:
    return [F.xxhash64(data).alias("text"), F.xxhash64(F.lit(17), data).bitwiseAND(0xFFFF).cast("int").alias("mark")]


def _single_strings(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """Covered ranges for the anchors with very many contexts: every string is counted by its hash."""
    schema = "c1 long, c2 long, text long, mark int, begin long"

    def row(text, mark, data, listed) -> Iterator[tuple]:
        for item in listed:
            at = item["at"]
            if at & 0xFFFF == mark:
                for s in range(at >> 32, (at >> 32) + (at >> 16 & 0xFF) + 1):
                    c = xxhash.xxh3_128_intdigest(data[s : s + LENGTH])
                    yield _signed(c >> 64), _signed(c & 0xFFFFFFFFFFFFFFFF), text, mark, s

    strings = stage(map_rows(texts.join(lists, "text"), schema, row))
    repeated = stage(strings.groupBy("c1", "c2").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    return strings.join(repeated, ["c1", "c2"]).select("text", "mark", "begin", (F.col("begin") + LENGTH).alias("end")).distinct()


def covered(docs: DataFrame, text_col: str = "text", wide: int = WIDE, huge: int = HUGE) -> DataFrame:
    """(text, mark, covers): ranges to remove of every text that has some, by the text's hashes."""
    spark = docs.sparkSession
    data = F.col(text_col).cast("binary").alias("data")
    texts = docs.select(data).where(F.length("data") >= LENGTH).select(*_text_key(F.col("data")), "data")
    placed = stage(texts.mapInArrow(_anchor_rows, "text long, a array<struct<anchor:long,digest:long,at:long>>"))
    rows = placed.select("text", F.inline("a"))
    counts = rows.groupBy("anchor", "digest").agg(F.count("*").alias("n")).groupBy("anchor").agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds")
    )
    repeated = stage(counts.where(F.col("n") > 1).select("anchor", F.when(F.col("kinds") > huge, 2).when(F.col("kinds") > wide, 1).otherwise(0).alias("cut")))
    # Nothing above the join needs an anchor's rows together, so those of a frequent one can be split.
    kept = rows.select("text", "anchor", "at").join(repeated, "anchor").select("text", "anchor", "at", "cut")
    item = F.struct("anchor", "at", (F.col("cut") == 1).alias("wide"))
    lists = stage(
        kept.groupBy("text").agg(
            F.collect_set(F.when(F.col("cut") < 2, item)).alias("listed"), F.collect_set(F.when(F.col("cut") == 2, item)).alias("single")
        )
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = texts.join(lists.select("text", "listed").where(F.size("listed") > 0), "text").select("text", "mark", "data", "listed")
    contexts = joined.mapInArrow(_context_rows, "key long, c1 long, c2 long, weight long, owners binary, context binary")
    covers = contexts.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_merge_rows, "text long, mark int, begin long, end long")
    single = lists.select("text", F.col("single").alias("listed")).where(F.size("listed") > 0)
    if not single.isEmpty():
        covers = covers.union(_single_strings(texts, single))
    return stage(covers.groupBy("text", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("covers")))


def _union(covers: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((c["begin"], c["end"]) for c in covers or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, **cuts: int) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256), and the kept bytes if wanted, for every document."""
    spans = covered(docs, text_col, **cuts)
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(id_col).alias("__id"), data.alias("data")).select("__id", *_text_key(F.col("data")), "data")
    both = rows.join(spans, (rows["text"] == spans["text"]) & (rows["mark"] == spans["mark"]), "left").select("__id", "data", "covers")

    def row(doc_id, data, covers) -> Iterator[tuple]:
        runs = _union(covers)
        edges = [0, *(x for r in runs for x in r), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if runs else data
        out = doc_id, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()
        yield (*out, kept) if keep_text else out

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_rows(both, schema + ", kept binary" * keep_text, row)
