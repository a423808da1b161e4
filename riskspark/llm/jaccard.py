"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

A document's set holds its distinct shingles of ``WIDTH`` words. Two sets link at ``percent`` of intersection over union.

Bands and tiles. Bands of set sizes grow by half. A set belongs to its own band and, if it is small enough to link into
the one below, to that as a guest, so every linked pair shares the band of its smaller set. Linked sets of a band differ
in at most D shingles, which the sizes give. The 64-bit hash space is cut into D + 1 + x equal stretches; linked sets are
equal on at least 1 + x of them. A tile is (band, stretch, hash of the shingles in it). A stretch of at most ``WEAK``
shingles says little; a set leaves such stretches out when it has no more than x of them, which still leaves each pair
a common tile. Sets that share no tile are never looked at, and those that do share several shingles at once, so that
frequent words and passages do not fill tiles.

Comparison. A signature has a bit for each hash class, turned by every shingle in it. Bits in which two signatures
differ are shingles that only one set has, so their count bounds the overlap from above. Pairs that pass are
intersected as sorted arrays.

1. Each tile's sets are compared with its least one, the hub; hubs and members come from aggregates that combine before
   they shuffle, and equal comparisons of several tiles are made once.
2. Tiles whose sets now lie in one component are done. In the others, signatures of sets outside the largest component
   are compared with those of all sets of other components, in blocks of ``BLOCK_SETS``; equal tiles are taken once.
   The nearest set of each component and block is intersected first, which joins most of what links.
3. The same once more, now for every pair of different components that the signatures leave.

Each comparison group holds one set and at most about ``BLOCK_SETS`` others, read one after the other. Nothing is
dropped: every linked pair is compared, or lies in a component by other links already. Sets are named by a 64-bit
hash of their text (about three mistaken pairs among 10**10 texts), shingles by 64 bits.

With one or two words the whole sequence is the one shingle. Null and wordless texts have empty sets, link with nothing and
are components of their own. Repeated rows and equal texts share a component; a null id never names one while
another id is there. Texts of any length are read whole. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.components import components
from riskspark.llm.wordhash import SPACES, byte_kinds, mix, words
from riskspark.sources.staging import stage

WIDTH, PERCENT = 3, 90
GROWTH = 1.5
WEAK = 2
BLOCK_SETS = 512
BROADCAST_ROWS = 1 << 19  # tables of two longs up to this number of rows are broadcast, after counting

_IS_WORD = byte_kinds(SPACES)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    k = min(width, len(hashes))
    if not k:
        return hashes
    n = len(hashes) - k + 1
    found = np.full(n, k, np.uint64)
    for i in range(k):
        found = (found ^ hashes[i : i + n]) * _ODD[i % len(_ODD)]
        found ^= found >> np.uint64(29)
    found = mix(found)
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, set) of every text that has words."""
    for _, _, _, owner, _, _, hashes in words(texts, _IS_WORD):
        edges = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]]) if len(owner) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            yield int(owner[a]), _shingles(hashes[a:b], width)


def needed(a, b, percent: int):
    """Least intersection of sets of sizes a and b that link: 100·i >= percent·(a + b - i)."""
    return -((-percent * (a + b)) // (100 + percent))


@lru_cache(1)
def _bands() -> list[int]:
    """Band starts; a band ends before the next start."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * GROWTH)))
    return starts


@lru_cache(1024)
def _stretches(band: int, percent: int) -> tuple[int, int]:
    """(number of stretches, spare ones) of a band."""
    small = _bands()[band + 1] - 1
    # Both sizes together decide; rounding repeats with a period, so the last few sums hold the maximum.
    both = np.arange(max(2, small + small * 100 // percent - 2 * (100 + percent)), small + small * 100 // percent + 1)
    most = int((both - 2 * needed(both, 0, percent)).max())
    spare = -(-most // 8)
    return most + 1 + spare, spare


def tiles(found: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Tile hashes of one set."""
    starts = _bands()
    n = len(found)
    own = int(np.searchsorted(starts, n, "right")) - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(found + _ODD[0]), out=sums[1:])
    out = []
    for band in range(own, -1, -1):
        if band < own and (starts[band + 1] - 1) * 100 < percent * n:
            break
        count, spare = _stretches(band, percent)
        step = ((1 << 64) - 1) // count
        cuts = np.searchsorted(found, np.arange(1, count, dtype=np.uint64) * np.uint64(step))
        cuts = np.concatenate([[0], cuts, [n]])
        keys = mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 40)))
        weak = np.diff(cuts) <= WEAK
        out.append(keys[~weak] if weak.sum() <= spare else keys)
    return np.concatenate(out)


def signature(found: np.ndarray) -> np.ndarray:
    """A bitmap of at least four times as many bits as the set has shingles, 64 to 2**18: a power of two."""
    bits = min(1 << 18, max(64, 1 << (4 * len(found) - 1).bit_length()))
    turned = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words64: int) -> np.ndarray:
    """A narrower signature of the same set."""
    while len(bits) > words64:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def differing(one: np.ndarray, other: np.ndarray) -> int:
    """Bits that differ, at the narrower one's width."""
    width = min(len(one), len(other))
    return int(np.bitwise_count(folded(one, width) ^ folded(other, width)).sum())


def may_link(a: int, b: int, bits: int, percent: int) -> bool:
    """False only where sizes and differing bits rule a link out."""
    least = needed(a, b, percent)
    return min(a, b) >= least and (a + b - bits) // 2 >= least


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    return int((other[np.minimum(at, len(other) - 1)] == one).sum())


def _sign(width: int, percent: int):
    names = ["place", "n", "bits", "tiles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, None] = {}  # texts of this task whose tiles are out already; the oldest go first
        for batch in batches:
            codes = batch.column(1).to_pylist()
            rows = batch.num_rows
            n, bits, keys, done = np.zeros(rows, np.int64), [b""] * rows, [None] * rows, 0
            for i, found in sets(batch.column(2), width):
                n[i] = len(found)
                if codes[i] not in seen:
                    if len(seen) >= 1 << 16:
                        del seen[next(iter(seen))]
                    seen[codes[i]] = None
                    bits[i] = signature(found).tobytes()
                    keys[i] = tiles(found, percent).view(np.int64)
            while done < rows:
                stop, held = done, 0
                while stop < rows and held < 1 << 18:
                    held += 0 if keys[stop] is None else len(keys[stop])
                    stop += 1
                part = [k if k is not None else np.empty(0, np.int64) for k in keys[done:stop]]
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in part])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[done:stop], batch.column(1)[done:stop], pa.array(n[done:stop]), pa.array(bits[done:stop], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part))),
                    ],
                    names=["id", "code", *names[1:]],
                )
                done = stop

    return run


def _compare(width: int, percent: int):
    """Rows (grp, role, code, text) sorted by group and role: the hub (role 0) against each of the others."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, code, group = None, None, None
        for batch in batches:
            found: list[np.ndarray] = [np.empty(0, np.uint64)] * batch.num_rows
            for i, s in sets(batch.column(3), width):
                found[i] = s
            links = []
            for i, (g, role, c) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                if role == 0:
                    hub, code, group = found[i], c, g
                elif group == g and 100 * (both := overlap(hub, found[i])) >= percent * (len(hub) + len(found[i]) - both):
                    links.append((code, c))
            if links:
                u, v = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without those of a text that this task has sent to the same group lately: copies travel once a task or so."""
    seen: dict[tuple[int, int], None] = {}
    for batch in batches:
        keep = []
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            if key not in seen:
                if len(seen) >= 1 << 16:
                    del seen[next(iter(seen))]
                seen[key] = None
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v): the pairs (hub, code) that link. Each hub meets its partners in groups of about ``BLOCK_SETS``."""
    sizes = pairs.groupBy("hub").agg(F.count("*").alias("n"))
    salted = pairs.join(sizes, "hub").withColumn("salt", F.pmod(F.xxhash64("code"), F.ceil(F.col("n") / BLOCK_SETS)))
    group = F.xxhash64("hub", "salt").alias("grp")
    roles = stage(
        salted.select(group, F.lit(1).alias("role"), F.col("code").alias("__code"))
        .unionByName(salted.select(group, F.lit(0).alias("role"), F.col("hub").alias("__code")).distinct())
    )
    if roles.count() <= BROADCAST_ROWS:
        roles = F.broadcast(roles)
    rows = docs.select("code", "text").join(roles, F.col("code") == F.col("__code")).select("grp", "role", "code", "text")
    rows = rows.mapInArrow(_once, "grp long, role int, code long, text binary")
    return rows.repartition("grp").sortWithinPartitions("grp", "role").mapInArrow(_compare(width, percent), "u long, v long")


def _block_pairs(percent: int, nearest: bool):
    """Pairs of different components in one block pair that the signatures do not rule out.

    ``nearest``: of each left set and component of the right block, only the pair that differs in the fewest bits.
    """
    names = ["hub", "code"]

    def run(table: pa.Table) -> pa.Table:
        code, comp, n, side = (table.column(k).to_numpy() for k in ("code", "comp", "n", "side"))
        bits = [np.frombuffer(b, np.uint64) for b in table.column("bits").to_pylist()]
        left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
        widths = np.array([len(b) for b in bits])
        stacks = {(w, w): np.stack([bits[j] for j in right[widths[right] == w]]) for w in np.unique(widths[right]).tolist()}

        def stack(w: int, to: int) -> np.ndarray:
            """Signatures of width ``w``, folded to ``to``."""
            if (w, to) not in stacks:
                wide = stack(w, 2 * to)
                stacks[w, to] = wide[:, :to] ^ wide[:, to:]
            return stacks[w, to]

        out: set[tuple[int, int]] = set()
        for i in left.tolist():
            best: dict[int, tuple[int, int]] = {}
            for w in np.unique(widths[right]).tolist():
                mine, to = right[widths[right] == w], min(w, len(bits[i]))
                differ = np.bitwise_count(stack(w, to) ^ folded(bits[i], to)).sum(1, dtype=np.int64)
                least = needed(n[mine], n[i], percent)
                fits = (comp[mine] != comp[i]) & (np.minimum(n[mine], n[i]) >= least) & ((n[mine] + n[i] - differ) // 2 >= least)
                near = zip(comp[mine[fits]].tolist(), differ[fits].tolist(), code[mine[fits]].tolist())
                if nearest:
                    for c, bits_off, other in near:
                        best[c] = min(best.get(c, (bits_off, other)), (bits_off, other))
                else:
                    out |= {(min(int(code[i]), other), max(int(code[i]), other)) for _, _, other in near}
            out |= {(min(int(code[i]), other), max(int(code[i]), other)) for _, other in best.values()}
        u, v = zip(*out) if out else ((), ())
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names)

    return run


def _rest(members: DataFrame, signed: DataFrame, roots: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(hub, code): pairs still to compare in tiles that hold several components, or the nearest of them."""
    placed = members.join(roots, F.col("code") == F.col("node"), "left").select("tile", "code", F.coalesce("root", "code").alias("comp"))
    held = placed.groupBy("tile", "comp").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("code")).alias("mark")
    )
    several = held.groupBy("tile").agg(
        F.count("*").alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("main"),
        F.sum("n").alias("sets"), F.max("n").alias("most"), F.bit_xor("mark").alias("mark"),
    ).where(F.col("comps") > 1)
    # Tiles with the same sets are one.
    open_ = stage(several.groupBy("mark", "sets", "main", "most").agg(F.min("tile").alias("tile")))
    few = F.ceil((F.col("sets") - F.col("most")) / BLOCK_SETS)
    rows = placed.join(open_, "tile").select(
        "tile", "code", "comp", (F.col("comp") == F.col("main")).alias("is_main"),
        few.alias("few"), F.ceil(F.col("most") / BLOCK_SETS).alias("many"),
    )
    # Blocks of the sets outside the main component meet each other and the blocks of the main component.
    own = F.when(F.col("is_main"), F.pmod(F.xxhash64("code"), F.col("many"))).otherwise(F.pmod(F.xxhash64("code"), F.col("few")))
    rows = rows.withColumn("own", own)
    as_left = rows.where("NOT is_main").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("few") + F.col("many") - 1)).alias("other")).select(
        "tile", "code", "comp", F.col("own").alias("i"), F.col("other").alias("j"), F.when(F.col("other") == F.col("own"), F.lit(3)).otherwise(F.lit(1)).alias("side")
    ).where(F.col("j") >= F.col("i"))
    as_right = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("few") - 1)).alias("other")).select(
        "tile", "code", "comp", F.col("other").alias("i"), F.when(F.col("is_main"), F.col("few") + F.col("own")).otherwise(F.col("own")).alias("j"), F.lit(2).alias("side")
    ).where(F.col("j") > F.col("i"))
    both = as_left.unionByName(as_right).join(signed.select(F.col("code").alias("__code"), "n", "bits"), F.col("code") == F.col("__code"))
    return both.select("tile", "i", "j", "code", "comp", "side", "n", "bits").groupBy("tile", "i", "j").applyInArrow(
        _block_pairs(percent, nearest), "hub long, code long"
    ).distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id) of every document: the size of its set, and the smallest id that links reach.

    Links inside a component that is known already are not looked for, so there is no count of links.
    """
    code = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(F.col(id_col).alias("id"), code.alias("code"), F.col(text_col).cast("binary").alias("text"))
    kind = dict(docs.dtypes)[id_col]
    every = stage(texts.mapInArrow(_sign(width, percent), f"id {kind}, code long, n long, bits binary, tiles array<long>"))
    placed = every.select("code", F.explode("tiles").alias("tile"))

    # Hubs and members of tiles with at least two sets.
    hubs = placed.groupBy("tile").agg(F.min("code").alias("hub"), F.max("code").alias("last")).where(F.col("hub") < F.col("last")).select("tile", "hub")
    members = stage(placed.join(stage(hubs), "tile").select("tile", "hub", "code").distinct())
    stars = stage(members.where(F.col("code") != F.col("hub")).select("hub", "code").distinct())
    one = every.where(F.length("bits") > 0).groupBy("code").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    signed = stage(one.join(members.select("code").distinct(), "code", "left_semi"))

    source = texts.select("code", "text")
    first = stage(_verified(source, _unruled(stars, signed, percent), width, percent))
    roots = stage(components(first))
    links = first
    for nearest in (True, False):
        rest = stage(_rest(members, signed, roots, percent, nearest))
        if rest.isEmpty():
            break
        links = stage(links.unionByName(_verified(source, rest, width, percent)))
        roots = stage(components(links))

    found = every.join(roots, F.col("code") == F.col("node"), "left").select("id", "code", "n", F.coalesce("root", "code").alias("root"))
    found = stage(found)
    least = stage(found.where("n > 0").groupBy("root").agg(F.min("id").alias("least")))
    out = found.join(least.withColumnRenamed("root", "__root"), (F.col("root") == F.col("__root")) & (F.col("n") > 0), "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id")
    )


def _unruled(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, code) that sizes and signatures do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            one, other = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            keep = [
                may_link(a[i], b[i], differing(np.frombuffer(one[i], np.uint64), np.frombuffer(other[i], np.uint64)), percent)
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["hub", "code"]).filter(pa.array(keep, pa.bool_()))

    mine = signed.select(F.col("code").alias("__c"), F.col("n").alias("n_c"), F.col("bits").alias("bits_c"))
    hubs = signed.select(F.col("code").alias("__h"), F.col("n").alias("n_h"), F.col("bits").alias("bits_h"))
    both = pairs.join(mine, F.col("code") == F.col("__c")).join(hubs, F.col("hub") == F.col("__h"))
    return both.select("hub", "code", "n_h", "bits_h", "n_c", "bits_c").mapInArrow(run, "hub long, code long")
