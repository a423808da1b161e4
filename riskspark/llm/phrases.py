"""Phrase collocations from FM-indexes over word ids, one per shard, their counts summed across shards.

A shard is a run of whole texts of about ``shard_words`` words. Its words are numbered, pieces are closed by a break
symbol, and the Burrows-Wheeler transform is taken of the contexts ordered by their first ``longest`` words, which is
all that phrases of that length ask for. The index is the transform and its last-to-first map, staged once; all that
follows reads the index and not the texts.

Intervals are extended in both directions. To the left: the rows of an interval whose transform symbol is c go, by the
last-to-first map, to one stretch of rows, the interval of c followed by the phrase. To the right: the intervals of a
phrase one word longer split that of the phrase. All intervals of one depth are extended in one array operation.

Phrases go by 64-bit hashes of their words until the last step. A count of hashes keeps their first 32 + b bits; the first
b name a bucket, and a task sends each bucket one row of sorted differences and counts for several shards, a few bytes a
hash in place of a row. One task sums a bucket, and hashes that reach ``min_count`` over all shards are frequent.

1. Shards report the hashes of their words; then those of pairs of frequent words; then those of phrases of 3 to
   ``longest`` words made of frequent pairs (a phrase is at most as frequent as its parts). What is frequent goes to every
   task: the hashes up to ``BROADCAST_KEYS``, of more a table of ``FILTER_BITS`` bits.
2. Tasks report the frequent phrases of their shards by their words, so that a hash shared by chance adds work but never a
   count: a row lists the phrases of a kind whose first words share a bucket. Sums over tasks give exact counts.
3. Cuts, scores, one-word extensions on either side and ranks are joins and aggregates of frequent phrases.

A phrase lies inside a longer one that is ``inside_percent`` as frequent exactly if a phrase one word longer is (counts
only fall on the way), so the greatest counts of left and right extensions decide what is dropped.

Words are runs of anything but spaces and tabs, after lower-casing A-Z, inside pieces that end at ``.,;:!?`` and line
breaks. Null and empty texts have no words; null kinds are ``und``. Texts of any length are taken whole, by one shard.
Repeated rows count again. Empty tables give no rows. Equal scores and counts are ordered by phrase. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from riskspark.llm.wordhash import LOWER, byte_kinds, mix, words
from riskspark.sources.staging import stage

SHARD_WORDS = 1 << 18
BROADCAST_KEYS = 1 << 20  # frequent hashes up to this number (8 MB) go to every task, of more a table of bits
FILTER_BITS = 1 << 26  # of that table (8 MB), whatever the number of hashes
BUCKET_WORDS, LEAST_BITS = 1 << 22, 7  # words of the input for each bucket of hashes; 128 buckets at least
TASK_KEYS, TASK_ROWS = 1 << 21, 1 << 20  # hashes and phrases that a task holds before it sums them
TASK_WORDS = 1 << 23  # words of the input for each task that spells frequent phrases
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_IS_WORD = byte_kinds(b" \t" + _BREAKS)
_IS_BREAK = ~byte_kinds(_BREAKS)

SHARD_SCHEMA = (
    "names array<string>, sizes array<long>, kinds array<string>, words array<string>, counts array<long>, codes array<long>, bwt binary"
)
PACKED_SCHEMA = "bucket int, steps binary, small binary, large binary"
PHRASES_SCHEMA = "bucket int, kind string, phrases string, small binary, large binary"


def _gather(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Array:
    """Strings from (bytes, starts, lengths) of several blocks, lower-cased."""
    lengths = np.concatenate([p[2] for p in parts])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = np.empty(int(offsets[-1]), np.uint8)
    at = 0
    for source, starts, sizes in parts:
        begin = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        data[at : at + total] = LOWER[source[np.repeat(starts - begin, sizes) + np.arange(total)]]
        at += total
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def context_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a text (read as a ring) by the ``depth`` symbols that begin there."""
    rank, width = text.astype(np.int64), 1
    order = np.argsort(rank)
    while width < depth:
        step = min(width, depth - width)
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key)
        sorted_key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        width += step
    return order


class Index:
    """The FM-index of one shard: ``first`` is the sorted column, ``back`` the row of the context one word on."""

    def __init__(self, bwt: np.ndarray):
        n = len(bwt)
        keyed = np.sort(bwt.astype(np.int64) << 32 | np.arange(n))
        self.back = keyed & 0xFFFFFFFF
        self.first = keyed >> 32
        # The interval of each row for phrases of one word; breaks begin no phrase.
        self.words = np.where(self.first > 0, self.first, -1)

    def extended(self, inner: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Intervals of one word more: each row's word before the phrase whose interval ``inner`` holds the next row."""
        tail = inner[self.back]
        open_ = (self.first > 0) & (tail >= 0)
        if allowed is not None:
            open_ &= allowed
        change = np.ones(len(tail), bool)
        change[1:] = (self.first[1:] != self.first[:-1]) | (tail[1:] != tail[:-1]) | (open_[1:] != open_[:-1])
        return np.where(open_, np.cumsum(change) - 1, -1)

    @staticmethod
    def intervals(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, rows) of every interval."""
        starts = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]])) if len(labels) else np.empty(0, np.int64)
        sizes = np.diff(np.append(starts, len(labels)))
        held = labels[starts] >= 0
        return starts[held], sizes[held]


def _build(shard_words: int, longest: int):
    """Texts and kinds to shards."""

    def flush(held: list[tuple], names: list[str]) -> pa.RecordBatch:
        symbols, new, kind = (np.concatenate([h[i] for h in held]) for i in (3, 4, 5))
        unique, first, numbers, counts = np.unique(symbols, return_index=True, return_inverse=True, return_counts=True)
        places = np.arange(len(symbols)) + np.cumsum(new)
        text = np.zeros(len(symbols) + int(new.sum()), np.int64)
        text[places] = numbers + 1
        order = context_order(text, longest)
        bwt = text[order - 1].astype(np.int32)
        sizes = np.bincount(kind, minlength=len(names))
        del symbols, new, numbers, places, text, order
        # Strings of the distinct words, block by block, then in the order of their numbers.
        edges = np.cumsum([0] + [len(h[3]) for h in held])
        by_place = np.argsort(first)
        cut = np.searchsorted(first[by_place], edges)
        parts = []
        for i, h in enumerate(held):
            at = first[by_place[cut[i] : cut[i + 1]]] - edges[i]
            parts.append((h[0], h[1][at], (h[2] - h[1])[at]))
        back = np.empty(len(unique), np.int64)
        back[by_place] = np.arange(len(unique))
        strings = _gather(parts).take(pa.array(back)).cast(pa.string())
        kinds = pa.array(names, pa.string()).take(pa.array(kind[first]))
        lists = [
            pa.array(names, pa.string()), pa.array(sizes, pa.int64()), kinds, strings, pa.array(counts, pa.int64()), pa.array(unique.view(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(
            [*(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists), pa.array([bwt.tobytes()], pa.binary())],
            ["names", "sizes", "kinds", "words", "counts", "codes", "bwt"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names: dict[str, int] = {}
        size = 0
        for batch in batches:
            for kind in batch.column(1).unique().to_pylist():
                names.setdefault(kind, len(names))
            codes = np.array([names[k] for k in batch.column(1).to_pylist()], np.int64)
            tags = np.array([_tag(k) for k in names], np.uint64)
            for _, _, data, owner, starts, ends, hashes in words(batch.column(0), _IS_WORD):
                if not len(starts):
                    continue
                broken = np.concatenate([[0], np.cumsum(_IS_BREAK[data])])[starts]
                new = np.ones(len(starts), bool)
                new[1:] = (broken[1:] != broken[:-1]) | (owner[1:] != owner[:-1])
                kind = codes[owner]
                # Equal words of different kinds are different symbols.
                held.append((data.copy(), starts, ends, mix(hashes ^ tags[kind]), new, kind))
                size += len(starts)
                if size >= shard_words:
                    yield flush(held, list(names))
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield flush(held, list(names))

    return run


def _tag(kind: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(kind.encode(), 7)


def shards(docs: DataFrame, kind: Column, text_col: str, shard_words: int = SHARD_WORDS, longest: int = 5) -> DataFrame:
    """One row per shard: words of each kind, the kinds, words and counts of its symbols, their hashes, and the transform."""
    return docs.select(F.col(text_col).cast("binary").alias("t"), kind.alias("k")).mapInArrow(_build(shard_words, longest), SHARD_SCHEMA)


def _keys(index: Index, symbols: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words that begin the contexts of ``rows``."""
    key = symbols[index.first[rows] - 1]
    for _ in range(size - 1):
        rows = index.back[rows]
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + symbols[index.first[rows] - 1])
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _pack_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].tobytes()


def _unpack_counts(small: bytes, large: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, np.int64)
    return counts


def _pack(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row per bucket. Steps between its keys lie byte by byte, the first bytes first, so that empty ones compress."""
    keys, counts = _summed(keys, counts)
    buckets = (keys >> np.uint64(32)).astype(np.int32)
    edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1))
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        steps = np.diff(keys[a:b].astype(np.uint32), prepend=np.uint32(0))
        rows.append((int(buckets[a]), steps.view(np.uint8).reshape(-1, 4).T.tobytes(), *_pack_counts(counts[a:b])))
    columns = zip(*rows) if rows else [()] * 4
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["bucket", "steps", "small", "large"])


def _unpack(steps: bytes, small: bytes, large: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys within the bucket and counts."""
    by_byte = np.frombuffer(steps, np.uint8).reshape(4, -1)
    keys = np.cumsum(np.ascontiguousarray(by_byte.T).view(np.uint32).ravel(), dtype=np.uint64)
    return keys, _unpack_counts(small, large)


class Filter:
    """The frequent hashes, by their first 32 + ``bits`` bits: all of them, or a table of bits that holds them and others."""

    def __init__(self, bits: int, keys: np.ndarray | None, table: np.ndarray | None = None):
        self.bits, self.keys, self.table = bits, keys, table

    def holds(self, keys: np.ndarray) -> np.ndarray:
        keys = keys >> np.uint64(32 - self.bits)
        if self.keys is None:
            place = _place(keys, self.bits)
            return self.table[place >> 3] & (128 >> (place & 7)) != 0
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(33 + bits - FILTER_BITS.bit_length())).astype(np.int64)


def _frequent_keys(rows: DataFrame, keys_of: Callable[[list[pa.Scalar]], Iterator[tuple[np.ndarray, np.ndarray]]], bits: int, min_count: int) -> Filter:
    """The hashes whose counts, as ``keys_of`` finds them in each row, sum up to ``min_count``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                for keys, counts in keys_of([c[i] for c in batch.columns]):
                    held.append((keys >> np.uint64(32 - bits), counts))
                    size += len(keys)
                    if size >= TASK_KEYS:
                        yield _pack(*(np.concatenate(x) for x in zip(*held)))
                        held, size = [], 0
        if held:
            yield _pack(*(np.concatenate(x) for x in zip(*held)))

    def total(group: pa.Table) -> pa.Table:
        bucket = group.column(0)[0].as_py()
        parts = [_unpack(*row) for row in zip(*(c.to_pylist() for c in group.columns[1:]))]
        keys, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
        found = keys[counts >= min_count] | np.uint64(bucket << 32)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "n": pa.array([len(found)], pa.int64()), "keys": pa.array([found.tobytes()], pa.binary())})

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FILTER_BITS >> bits
        for batch in batches:
            tables = []
            for keys in batch.column(1).to_pylist():
                table = np.zeros(width, np.uint8)
                table[_place(np.frombuffer(keys, np.uint64), bits) & (width - 1)] = 1
                tables.append(np.packbits(table).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tables, pa.binary())], ["bucket", "bits"])

    found = stage(rows.mapInArrow(pack, PACKED_SCHEMA).groupBy("bucket").applyInArrow(total, "bucket int, n long, keys binary")).where("n > 0")
    if (found.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_KEYS:
        got = sorted(zip(*(c.to_pylist() for c in found.select("bucket", "keys").toArrow().columns)))
        return Filter(bits, np.frombuffer(b"".join(k for _, k in got), np.uint64))
    table = np.zeros((1 << bits, FILTER_BITS >> bits >> 3), np.uint8)
    for bucket, row in zip(*(c.to_pylist() for c in found.select("bucket", "keys").mapInArrow(flags, "bucket int, bits binary").toArrow().columns)):
        table[bucket] = np.frombuffer(row, np.uint8)
    return Filter(bits, None, table.ravel())


def _word_keys(row: list[pa.Scalar]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes, counts = (x.values.to_numpy() for x in row)
    yield codes.view(np.uint64), counts


def _opened(codes: pa.Scalar, bwt: pa.Scalar) -> tuple[Index, np.ndarray]:
    return Index(np.frombuffer(bwt.as_buffer(), np.int32)), codes.values.to_numpy().view(np.uint64)


def _pairs(index: Index, symbols: np.ndarray, single: Filter) -> np.ndarray:
    """Labels of the intervals of pairs of frequent words."""
    known = np.concatenate([[False], single.holds(symbols)])[index.first]
    return index.extended(np.where(known, index.words, -1), known)


def _held(index: Index, symbols: np.ndarray, labels: np.ndarray, size: int, among: Filter) -> np.ndarray:
    """``labels`` without the phrases that are not ``among`` the frequent ones."""
    starts, _ = index.intervals(labels)
    known = np.zeros(int(labels.max(initial=-1)) + 2, bool)  # the last place is that of -1
    known[labels[starts]] = among.holds(_keys(index, symbols, starts, size))
    return np.where(known[labels], labels, -1)


def _pair_keys(single: Filter):
    def keys_of(row: list[pa.Scalar]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        index, symbols = _opened(*row)
        starts, counts = index.intervals(_pairs(index, symbols, single))
        yield _keys(index, symbols, starts, 2), counts

    return keys_of


def _longer_keys(longest: int, single: Filter, pairs: Filter):
    def keys_of(row: list[pa.Scalar]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        index, symbols = _opened(*row)
        labels = _held(index, symbols, _pairs(index, symbols, single), 2, pairs)
        allowed = labels >= 0
        for size in range(3, longest + 1):
            labels = index.extended(labels, allowed)
            starts, counts = index.intervals(labels)
            yield _keys(index, symbols, starts, size), counts

    return keys_of


def _phrases(longest: int, single: Filter, pairs: Filter, longer: Filter):
    """Shards to frequent phrases of 1 to ``longest`` words: a row for those of a kind whose first words share a bucket."""
    names = ["bucket", "kind", "phrase"]

    def of_shard(kinds, strings, counts, codes, bwt) -> Iterator[pa.Table]:
        index, symbols = _opened(codes, bwt)
        kinds, strings = kinds.values, strings.values
        buckets = (symbols >> np.uint64(64 - single.bits)).astype(np.int32)

        def listed(first: np.ndarray, phrase: pa.Array, n: pa.Array) -> pa.Table:
            return pa.table([pa.array(buckets[first]), kinds.take(pa.array(first)), phrase, n], [*names, "n"])

        held = np.flatnonzero(single.holds(symbols))
        yield listed(held, strings.take(pa.array(held)), counts.values.take(pa.array(held)))
        labels = _pairs(index, symbols, single)
        for size in range(2, longest + 1):
            if size > 2:
                labels = index.extended(labels, allowed)
            labels = _held(index, symbols, labels, size, pairs if size == 2 else longer)
            if size == 2:
                allowed = labels >= 0
            row, n = index.intervals(labels)
            first, parts = index.first[row] - 1, []
            for _ in range(size):
                parts.append(strings.take(pa.array(index.first[row] - 1)))
                row = index.back[row]
            yield listed(first, pc.binary_join_element_wise(*parts, " "), pa.array(n))

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(names, use_threads=False).aggregate([("n", "sum")]).rename_columns([*names, "n"])

    def pack(table: pa.Table) -> pa.RecordBatch:
        """Phrases in order, so that what they share compresses; no word holds a line break."""
        bucket, kind, phrase, n = (c.combine_chunks() for c in table.sort_by([(c, "ascending") for c in names]).columns)
        number = kind.dictionary_encode().indices.to_numpy().astype(np.int64) + (bucket.to_numpy().astype(np.int64) << 32)
        edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]])) if len(number) else np.zeros(1, np.int64)
        first = pa.array(edges[:-1])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), phrase), "\n")
        counts = [_pack_counts(n.to_numpy()[a:b]) for a, b in zip(edges[:-1], edges[1:])]
        small, large = (pa.array([c[i] for c in counts], pa.binary()) for i in range(2))
        return pa.RecordBatch.from_arrays([bucket.take(first), kind.take(first), joined, small, large], ["bucket", "kind", "phrases", "small", "large"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                for table in of_shard(*(c[i] for c in batch.columns)):
                    held.append(table)
                    size += len(table)
                if size >= TASK_ROWS:
                    held = [summed(held)]
                    size = len(held[0])
                    if 2 * size >= TASK_ROWS:
                        yield pack(held[0])
                        held, size = [], 0
        if held:
            yield pack(summed(held))

    return run


def _phrase_sums(min_count: int):
    def run(group: pa.Table) -> pa.Table:
        parts = []
        for phrases, small, large in zip(group["phrases"], group["small"], group["large"]):
            phrase = pc.split_pattern(pa.array([phrases.as_py()], pa.string()), "\n").flatten()
            parts.append(pa.table({"phrase": phrase, "n": _unpack_counts(small.as_py(), large.as_py())}))
        table = pa.concat_tables(parts).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        table = table.filter(pc.greater_equal(table["n_sum"], min_count))
        size = pc.add(pc.count_substring(table["phrase"], " "), pa.scalar(1, pa.int32()))
        return pa.table({"kind": pa.repeat(group["kind"][0], len(table)), "phrase": table["phrase"], "size": size, "f": table["n_sum"]})

    return run


def frequent(
    docs: DataFrame, kind: Column, text_col: str = "text", min_count: int = 100, longest: int = 5, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(kind, n): words of each kind; and (kind, phrase, size, f): phrases of 1 to ``longest`` words that occur ``min_count`` times."""
    with _rows_per_batch(docs.sparkSession, 256):
        index = stage(shards(docs, kind, text_col, shard_words, longest), large_rows=True)
    each = index.select(F.explode(F.arrays_zip("names", "sizes")).alias("e")).where("e.sizes > 0")
    totals = each.groupBy(F.col("e.names").alias("kind")).agg(F.sum("e.sizes").alias("n"))
    n_words = each.agg(F.sum("e.sizes")).first()[0] or 0
    bits = min(max(LEAST_BITS, (n_words // BUCKET_WORDS).bit_length()), FILTER_BITS.bit_length() - 4)

    with _rows_per_batch(docs.sparkSession, 1):
        single = _frequent_keys(index.select("codes", "counts"), _word_keys, bits, min_count)
        of_shards = index.select("codes", "bwt")
        pairs = _frequent_keys(of_shards, _pair_keys(single), bits, min_count)
        longer = _frequent_keys(of_shards, _longer_keys(longest, single, pairs), bits, min_count)
        # A task sends each of its phrases once, so tasks are as large as their words allow.
        own = index.select("kinds", "words", "counts", "codes", "bwt").coalesce(1 + n_words // TASK_WORDS)
        found = own.mapInArrow(_phrases(longest, single, pairs, longer), PHRASES_SCHEMA)
        return totals, stage(found.groupBy("bucket", "kind").applyInArrow(_phrase_sums(min_count), "kind string, phrase string, size int, f long"))


@contextmanager
def _rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside hand so many rows to Python at a time: a text is kilobytes, a shard megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _part(words_of: str, begin: str, length: str) -> Column:
    return F.expr(f"array_join(slice({words_of}, {begin}, {length}), ' ')")


def collocations(
    docs: DataFrame, kind_col: str = "lang", text_col: str = "text", min_count: int = 100, longest: int = 5,
    inside_percent: int = 100, top: int = 2000, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(kind, rank, phrase, a, l, r, n, score, left_most, right_most): the best phrases of every kind.

    ``l`` and ``r`` belong to the cut that scores lowest. ``left_most`` and ``right_most`` are the counts of the most
    frequent phrases one word longer on that side, null where none is frequent.
    """
    totals, known = frequent(docs, F.coalesce(F.col(kind_col).cast("string"), F.lit("und")), text_col, min_count, longest, shard_words)
    split = known.where(F.col("size") > 1).withColumn("w", F.split("phrase", " ", -1))

    def most(begin: str, name: str) -> DataFrame:
        part = split.where("size > 2").select("kind", _part("w", begin, "size - 1").alias("phrase"), "f")
        return part.groupBy("kind", "phrase").agg(F.max("f").alias(name))

    cuts = split.select("kind", "phrase", F.col("f").alias("a"), "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "kind", "phrase", "a", "k", _part("w", "1", "k").alias("first"), _part("w", "k + 1", "size - k").alias("rest")
    )
    part = known.select(F.col("kind").alias("__k"), F.col("phrase").alias("__p"), "f")

    def with_count(rows: DataFrame, column: str, name: str) -> DataFrame:
        same = (F.col("kind") == F.col("__k")) & (F.col(column) == F.col("__p"))
        return rows.join(part.withColumnRenamed("f", name), same).drop("__k", "__p", column)

    cuts = with_count(with_count(cuts, "first", "l"), "rest", "r")
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= 1 << 16 else totals, "kind")
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    best = cuts.withColumn("score", score).groupBy("kind", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    best = best.join(most("2", "left_most"), ["kind", "phrase"], "left").join(most("1", "right_most"), ["kind", "phrase"], "left")
    longer = F.greatest("left_most", "right_most")
    kept = best.where(longer.isNull() | (100 * longer < inside_percent * F.col("a")))
    line = W.partitionBy("kind").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top).select(
        F.col("kind").alias(kind_col), F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score", "left_most", "right_most"
    )
