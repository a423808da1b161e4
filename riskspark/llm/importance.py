"""Target-distribution importance resampling over hashed word runs, read off an Aho-Corasick dictionary.

Features of a text are its runs of 1 to ``RUN`` consecutive words joined by one space; a feature's bucket is the
crc32 of its bytes modulo ``buckets``. The dictionary is an automaton over delimiter-bounded distinct words (``" the "``);
each carries the crc32 of the word, of the word behind a space, and its length. A scan of the text, all breaks
turned into spaces, emits those payloads in order. The crc32 of two joined strings follows from theirs and the second
length (a linear map over bits), so the payloads of neighbours compose to the buckets of longer runs and no longer
string is ever built or hashed. A word outside the dictionary gets its crc32 from its bytes in the same place, so the
dictionary steers speed alone and never a result; it holds the ``dictionary_words`` most frequent words among those seen
``SEEN`` times in one block, of ``LONGEST`` bytes at most.

One scan counts the buckets of all documents (a task reports each bucket once), one those of the target, and one more
scores every document: the log ratio of smoothed bucket shares, in whole thousandths, summed over its features, plus
Gumbel noise fixed by the id. Highest scores are drawn without replacement; the cut and the ranks come from counted
ranges, not from one sorted task.

Null and empty texts, and texts without a word, have no features and weight 0. Texts of any length are scanned whole.
Repeated rows count and are drawn on their own; rows of equal score and id are interchangeable. A null id is hashed as
the empty string and comes behind all others of its score. Empty tables give no rows; an empty target has no counts, so that gains come from
the smoothing. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.wordhash import LOWER, NOT_ALNUM, bounds, byte_kinds, words
from riskspark.operators.ranks import rank_threshold, ranked
from riskspark.sources.staging import stage

RUN = 3
SEEN, LONGEST = 8, 64
SCAN_BYTES = 1 << 20
SHORT = 256  # lengths with a table of their own; longer ones take one step for each set bit above

_IS_WORD = byte_kinds(NOT_ALNUM)
_TO_SPACES = np.where(_IS_WORD, LOWER, 32).astype(np.uint8).tobytes()
_SPACE = np.uint32(zlib.crc32(b" "))


@lru_cache(1)
def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """What appending zero bytes does to a crc32, by place and value of its bytes: for 0 to 255 zeros, and for 2**8, 2**9, …"""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    plain = one ^ one[0]  # without the inversions at both ends

    def step(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint32(8)) ^ plain[x & np.uint32(255)]

    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    short = np.empty((SHORT, 4, 256), np.uint32)
    for length in range(SHORT):
        short[length] = now
        now = step(now)
    long = [now]
    for _ in range(32):
        long.append(_apply(long[-1], long[-1]))
    return short, long


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & np.uint32(255)] ^ table[1][(crc >> np.uint32(8)) & np.uint32(255)]
        ^ table[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ table[3][crc >> np.uint32(24)]
    )


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of a string followed by another, from both crc32 and the second one's length in bytes."""
    short, long = _shift_tables()
    low = length % SHORT
    flat = short.reshape(-1)
    at = low * 1024
    moved = (
        flat[at + (first & np.uint32(255))] ^ flat[at + 256 + ((first >> np.uint32(8)) & np.uint32(255))]
        ^ flat[at + 512 + ((first >> np.uint32(16)) & np.uint32(255))] ^ flat[at + 768 + (first >> np.uint32(24))]
    )
    high = length // SHORT
    bit = 0
    while high.any():
        here = (high & 1).astype(bool)
        moved[here] = _apply(long[bit], moved[here])
        high, bit = high >> 1, bit + 1
    return moved ^ second


class Dictionary:
    """The automaton of a list of words, and their payloads."""

    def __init__(self, entries: tuple[bytes, ...]):
        self.crc = np.array([zlib.crc32(w) for w in entries] or [0], np.uint32)
        self.length = np.array([len(w) for w in entries] or [0], np.int64)
        self.automaton = ahocorasick.Automaton()
        for i, w in enumerate(entries):
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        self.automaton.make_automaton()
        self.any = bool(entries)

    def payloads(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, crc32, length) of every word of a text that begins and ends with a space, all breaks being spaces."""
        data = np.frombuffer(text, np.uint8)
        starts, ends = bounds(data != 32, np.empty(0, np.int64))
        entry = np.full(len(starts), -1, np.int64)
        if self.any:
            found = np.fromiter(chain.from_iterable(self.automaton.iter(text.decode("latin-1"))), np.int64).reshape(-1, 2)
            entry[np.searchsorted(ends, found[:, 0])] = found[:, 1]
        crc, length = self.crc[entry], ends - starts
        crc32 = zlib.crc32
        for i in np.flatnonzero(entry < 0).tolist():
            crc[i] = crc32(text[starts[i] : ends[i]])
        return starts, crc, length


@lru_cache(2)
def _dictionary(entries: tuple[bytes, ...]) -> Dictionary:
    return Dictionary(entries)


def _features(texts: pa.Array, entries: tuple[bytes, ...], buckets: int, run: int) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first text, one after the last, [(owner, bucket) for runs of 1, 2, … words]) over stretches of whole texts."""
    dictionary = _dictionary(entries)
    column = texts.cast(pa.binary()).fill_null(b"")
    sizes = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(column):
        stop, held = at + 1, int(sizes[at])
        while stop < len(column) and held + sizes[stop] <= SCAN_BYTES:
            held += int(sizes[stop])
            stop += 1
        text = (b" " + b" ".join(column[at:stop].to_pylist()) + b" ").translate(_TO_SPACES)
        begin = 1 + np.concatenate([[0], np.cumsum(sizes[at:stop] + 1)])
        starts, crc, length = dictionary.payloads(text)
        owner = at + np.searchsorted(begin, starts, "right") - 1
        spaced = joined_crc(np.full(len(crc), _SPACE), crc, length)
        found, now = [(owner, crc % buckets)], crc
        for k in range(1, run):
            now = joined_crc(now[:-1], spaced[k:], length[k:] + 1)
            inside = owner[k:] == owner[: len(owner) - k] if len(owner) > k else np.zeros(0, bool)
            found.append((owner[k:][inside], now[inside] % buckets))
        yield at, stop, found
        at = stop


def dictionary_words(docs: DataFrame, text_col: str, limit: int) -> tuple[bytes, ...]:
    """The most frequent words of the whole table; at most ``limit`` words of ``LONGEST`` bytes reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, _, starts, ends, hashes in words(batch.column(0), _IS_WORD):
                _, first, count = np.unique(hashes, return_index=True, return_counts=True)
                keep = (count >= SEEN) & (ends[first] - starts[first] <= LONGEST)
                first, count = first[keep], count[keep]
                found = [LOWER[data[a:b]].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(count, pa.int64())], ["word", "n"])

    counted = docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "word binary, n long")
    best = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(limit)
    return tuple(bytes(r["word"]) for r in best.collect())


def bucket_counts(docs: DataFrame, text_col: str, entries: tuple[bytes, ...], buckets: int, run: int = RUN) -> np.ndarray:
    """How many features of the table fall into each bucket: ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found in _features(batch.column(0), entries, buckets, run):
                for _, bucket in found:
                    total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of the buckets' smoothed shares."""
    size, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    ratio = ((target + 1.0) * (all_source + size)) / ((source + 1.0) * (all_target + size))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, entries: tuple[bytes, ...], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), run: int = RUN
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_features`` and ``weight`` of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    picked = docs.select(*keep, F.col(text_col).cast("binary").alias("__text"))
    new = [StructField(n, LongType()) for n in ("n_words", "n_features", "weight")]
    schema = StructType([*picked.schema.fields[:-1], *new])
    arrow = to_arrow_schema(schema)
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for at, stop, found in _features(batch.column(batch.num_columns - 1), entries, buckets, run):
                for k, (owner, bucket) in enumerate(found):
                    # Sums of whole numbers below 2**53 are exact in doubles, in any order.
                    count = np.bincount(owner - at, minlength=stop - at)
                    weight[at:stop] += np.bincount(owner - at, gain[bucket], minlength=stop - at).astype(np.int64)
                    n_features[at:stop] += count
                    if k == 0:
                        n_words[at:stop] = count
            kept = [batch.column(i).cast(arrow.field(i).type) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, (n_words, n_features, weight))], schema=arrow)

    return picked.mapInArrow(score, schema)


def noise(id_col: Column, salt: str) -> Column:
    """Gumbel noise in whole thousandths, from the first 32 bits of sha256 of ``salt:id``."""
    text = F.concat(F.lit(salt + ":"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    buckets: int = 10_000, percent: int = 5, min_words: int = 20, salt: str = "42", dictionary_size: int = 1 << 16, run: int = RUN,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document.

    ``rank`` counts from 1 over the ``percent`` of the documents of ``min_words`` words or more that score highest, ties to
    the smaller id; it is null for all others.
    """
    entries = dictionary_words(docs, text_col, dictionary_size)
    source = bucket_counts(docs, text_col, entries, buckets, run)
    wanted = bucket_counts(target, target_text_col, entries, buckets, run)
    weighed = weigh(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), gains(source, wanted), entries, "__t", ("__id",), run)
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(F.col("__id"), salt)).withColumn("__row", F.monotonically_increasing_id()))
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = percent * eligible.count() // 100
    # Order columns are never null; the row number parts repeated rows.
    lined = eligible.select(
        (-F.col("score")).alias("__down"), F.col("__id").isNull().alias("__none"), F.coalesce("__id", F.lit(0).cast(scored.schema["__id"].dataType)).alias("__at"), "__row"
    )
    order = ["__down", "__none", "__at", "__row"]
    if drawn:
        cut = rank_threshold(lined, [], order, F.lit(drawn - 1)).select("cut.*").first()
        inside = F.struct(*order) <= F.struct(*[F.lit(cut[c]).cast(lined.schema[c].dataType) for c in order])
        places = ranked(lined.where(inside), [], order, "__rank").select(F.col("__row").alias("__drawn"), (F.col("__rank") + 1).alias("rank"))
    else:
        places = lined.where("false").select(F.col("__row").alias("__drawn"), F.lit(0).cast("long").alias("rank"))
    return scored.join(places, F.col("__row") == F.col("__drawn"), "left").select(
        F.col("__id").alias(id_col), "n_words", "n_features", "weight", "score", "rank"
    )
