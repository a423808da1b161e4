"""Language-model scoring with a gated recurrent network.

A gated recurrent unit reads word after word; a class-factored softmax first predicts the class of the next word
and then the word within the class. One class, the rest, stands for all words outside the model's vocabulary: its
words share its probability by smoothed corpus counts, so that the whole is a distribution over all words and one
slot for unseen ones. Training is truncated backpropagation in numpy: a bounded sample of windows gives a start on
the driver, then each task goes on from it over every token of its own training texts, and the networks are averaged
by their tokens. The average thus depends, a little, on how the input is dealt out. Scoring carries the state across
windows over each whole text, many texts side by side.

Counts cover the whole corpus: one pass ranks all words of all training texts, and the network pass also lists each
text's words. The most frequent words have numbers, found by a 64-bit hash, and are summed before the shuffle; all
others go by that hash to the task that counts them.

Words are runs of non-whitespace after lower-casing A-Z; each text ends with an end token. Null and empty texts
hold the end token only. Repeated rows count, and are scored, as often as they occur. Without training rows every
count is zero. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.llm import wordhash
from riskspark.llm.base import as_batch, id_mix, map_rows
from riskspark.sources.staging import stage

HIDDEN, CLASS_WORDS, MODEL_WORDS, ENDINGS = 24, 64, 2048, 256
NUMBERED = 65536
LANES, WINDOW = 256, 64
BLOCK_TOKENS = 2_500_000
LEARN_TOKENS, LEARN_PIECE, LEARN_WINDOW, LEARN_RATE = 1_000_000, 4096, 32, 0.006
TALLY_WORDS = 200_000
PARAMETERS = ("inputs", "gates", "class_w", "class_b", "word_w", "word_b")
SLICES = 32
ALPHA = 0.1
END = 0
_SPACE = 1 << 30
_IS_WORD = wordhash.byte_kinds(wordhash.SPACES)


def _ending(word: bytes) -> int:
    return (word[-1] + 31 * word[-2 if len(word) > 1 else -1]) % ENDINGS


@dataclass
class Network:
    """Parameters; ``words`` model tokens (the end token is number 0), then the rest class."""

    words: int
    inputs: np.ndarray  # (words + ENDINGS) x 3 HIDDEN: gate inputs of each token
    gates: np.ndarray  # HIDDEN x 3 HIDDEN
    class_w: np.ndarray
    class_b: np.ndarray
    word_w: np.ndarray  # classes x HIDDEN x CLASS_WORDS
    word_b: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.word_b)


def network(words: int, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    classes = math.ceil(words / CLASS_WORDS)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    word_b = np.zeros((classes, CLASS_WORDS), np.float32)
    word_b[-1, words - (classes - 1) * CLASS_WORDS :] = -1e9  # places of the last class without a word
    return Network(
        words, draw(words + ENDINGS, 3 * HIDDEN, scale=0.2), draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        draw(HIDDEN, classes + 1, scale=0.1), np.zeros(classes + 1, np.float32), draw(classes, HIDDEN, CLASS_WORDS, scale=0.1), word_b,
    )


def _exp_sums(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(e, sums, top): exponentials of rows less ``top``, and their sums. One ``top`` serves all rows unless some row is far below it."""
    top = z.max(initial=0)
    e = z - top
    np.exp(e, out=e)
    sums = e @ np.ones(z.shape[1], z.dtype)
    if len(sums) and not sums.min() > 1e-25:
        top = z.max(axis=1)
        e = np.exp(z - top[:, None])
        sums = e.sum(axis=1)
    return e, sums, top


def _lse(z: np.ndarray) -> np.ndarray:
    _, sums, top = _exp_sums(z)
    return np.log(sums) + top


def _with_one(h: np.ndarray) -> np.ndarray:
    """Rows with a 1 behind, so that a product adds the bias, too."""
    out = np.empty((len(h), HIDDEN + 1), h.dtype)
    out[:, :HIDDEN], out[:, HIDDEN] = h, 1
    return out


def _weights(net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and of the words of each class, the bias as the last row."""
    return np.concatenate([net.class_w, net.class_b[None]]), np.concatenate([net.word_w, net.word_b[:, None]], axis=1)


def _word_rows(weights: np.ndarray, h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Rows of ``h`` up to the last edge by the words of their class; those of a class lie together."""
    z = np.empty((edges[-1], CLASS_WORDS), h.dtype)
    for c in np.flatnonzero(np.diff(edges)):
        rows = slice(edges[c], edges[c + 1])
        np.matmul(h[rows], weights[c], out=z[rows])
    return z


def log_probability(net: Network, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of target tokens (``words`` for the rest) after states h."""
    group = np.minimum(target // CLASS_WORDS, net.classes)
    group[target >= net.words] = net.classes
    order = np.argsort(group.astype(np.uint16), kind="stable")
    h, group, goal = _with_one(h[order]), group[order], target[order]
    edges = np.searchsorted(group, np.arange(net.classes + 1))
    class_w, word_w = _weights(net)
    z = h @ class_w
    found = z[np.arange(len(z)), group] - _lse(z)
    z, known = _word_rows(word_w, h, edges), edges[-1]
    found[:known] += z[np.arange(known), goal[:known] % CLASS_WORDS] - _lse(z)
    out = np.empty_like(found)
    out[order] = found
    return out


def _shares(z: np.ndarray, scale: float = 1) -> np.ndarray:
    e, sums, _ = _exp_sums(z)
    e *= (scale / sums)[:, None]
    return e


def _descent(z: np.ndarray, goal: np.ndarray, count: int) -> tuple[np.ndarray, float]:
    """Gradients, by the rows z, of the mean loss over ``count`` tokens, and the sum of these rows' losses."""
    p, at = _shares(z, 1 / count), (np.arange(len(z)), goal)
    own = p[at]
    p[at] = own - 1 / count
    return p, -np.log(np.maximum(own * count, 1e-30)).sum()


def _step(gates: np.ndarray, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next states. Gates and states come first, lanes last, so that each gate is one stretch; ``x``: what each lane reads."""
    x, u = np.ascontiguousarray(x.T), gates @ h
    zr = x[: 2 * HIDDEN]
    zr += u[: 2 * HIDDEN]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r, un = zr[:HIDDEN], zr[HIDDEN:], u[2 * HIDDEN :]
    n = r * un
    n += x[2 * HIDDEN :]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, z, r, n, un


@dataclass
class Lanes:
    """Texts laid end to end in lanes of nearly equal length; a text starts where ``first`` is set."""

    read: np.ndarray  # steps x lanes: token read before each prediction
    target: np.ndarray  # -1: no token
    first: np.ndarray
    text: np.ndarray


def lay_out(reads: list[np.ndarray], targets: list[np.ndarray], lanes: int) -> Lanes:
    sizes = [len(t) for t in targets]
    lanes = max(1, min(lanes, sum(sizes) // max(1, max(sizes, default=1))))
    heap = [(0, k) for k in range(lanes)]
    place = {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        used, k = heapq.heappop(heap)
        place[i] = used, k
        heapq.heappush(heap, (used + sizes[i], k))
    steps = max(used for used, _ in heap)
    out = Lanes(np.zeros((steps, lanes), np.int32), np.full((steps, lanes), -1, np.int32), np.zeros((steps, lanes), bool), np.zeros((steps, lanes), np.int32))
    for i, (a, k) in place.items():
        b = a + sizes[i]
        out.read[a:b, k], out.target[a:b, k], out.text[a:b, k], out.first[a, k] = reads[i], targets[i], i, True
    return out


def score_texts(net: Network, reads: list[np.ndarray], targets: list[np.ndarray], lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
    """Natural log probability of each whole text, rest tokens as their class; the state runs on between windows."""
    total = np.zeros(len(targets))
    if not targets:
        return total
    laid = lay_out(reads, targets, lanes)
    steps, width = laid.read.shape
    h, gates = np.zeros((HIDDEN, width), np.float32), np.ascontiguousarray(net.gates.T)
    for at in range(0, steps, window):
        read, target, first, text = (x[at : at + window] for x in (laid.read, laid.target, laid.first, laid.text))
        states, opens = np.empty((len(read), HIDDEN, width), np.float32), first.any(axis=1)
        for t in range(len(read)):
            if opens[t]:
                h = h * ~first[t]
            h = states[t] = _step(gates, net.inputs.take(read[t], 0), h)[0]
        live = target >= 0
        states = states.transpose(0, 2, 1)
        total += np.bincount(text[live], log_probability(net, states[live], target[live]), minlength=len(total))
    return total


@dataclass
class _Adam:
    rate: float
    moments: dict[str, tuple] = field(default_factory=dict)
    steps: int = 0

    def update(self, net: Network, grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, g in grads.items():
            m, v = self.moments.get(name) or (np.zeros_like(g), np.zeros_like(g))
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * (g * g)
            self.moments[name] = m, v
            ahead = self.rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            by = np.sqrt(v)
            by += 1e-6
            np.divide(m, by, out=by)
            by *= ahead
            getattr(net, name).__isub__(by.astype(np.float32, copy=False))


def gradients(net: Network, read: np.ndarray, target: np.ndarray, first: np.ndarray, h: np.ndarray) -> tuple[dict, float, np.ndarray]:
    """Gradients of the mean loss over one window, cut off at its start; the loss and the last state."""
    gates, kind, h = np.ascontiguousarray(net.gates.T), net.gates.dtype, np.ascontiguousarray(h.T)
    steps, lanes = read.shape
    states, before, z, r, n, un = (np.empty((steps, HIDDEN, lanes), kind) for _ in range(6))
    opens = first.any(axis=1)
    for t in range(steps):
        if opens[t]:
            h = h * ~first[t]
        before[t] = h
        h, z[t], r[t], n[t], un[t] = _step(gates, net.inputs.take(read[t], 0), h)
        states[t] = h
    live = np.flatnonzero(target.ravel() >= 0)
    goal = target.ravel()[live]
    count = max(1, len(goal))
    group = np.where(goal >= net.words, net.classes, goal // CLASS_WORDS)
    order = np.argsort(group.astype(np.uint16), kind="stable")
    live, goal, group = live[order], goal[order], group[order]
    flat = _with_one(states.transpose(0, 2, 1).reshape(-1, HIDDEN)[live])
    edges = np.searchsorted(group, np.arange(net.classes + 1))
    class_w, word_w = _weights(net)
    p, loss = _descent(flat @ class_w, group, count)
    dclass, dword, dflat = flat.T @ p, np.zeros_like(word_w), p @ net.class_w.T
    q, more = _descent(_word_rows(word_w, flat, edges), goal[: edges[-1]] % CLASS_WORDS, count)
    loss += more
    for c in np.flatnonzero(np.diff(edges)):
        rows = slice(edges[c], edges[c + 1])
        np.matmul(flat[rows].T, q[rows], out=dword[c])
        dflat[rows] += q[rows] @ net.word_w[c].T
    grads = {"class_w": dclass[:-1], "class_b": dclass[-1], "word_w": dword[:, :-1], "word_b": dword[:, -1]}
    dstates = np.zeros((steps * lanes, HIDDEN), kind)
    dstates[live] = dflat
    dstates = np.ascontiguousarray(dstates.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
    dh, du, dns = np.zeros_like(h), np.empty((3 * HIDDEN, steps, lanes), kind), np.empty((HIDDEN, steps, lanes), kind)
    for t in range(steps - 1, -1, -1):
        dh += dstates[t]
        dn, now = dns[:, t], du[:, t]
        part = 1 - z[t]
        part *= dh
        np.multiply(part, 1 - n[t] * n[t], out=dn)
        part *= before[t] - n[t]
        np.multiply(part, z[t], out=now[:HIDDEN])
        np.multiply(dn, r[t], out=now[2 * HIDDEN :])
        part = 1 - r[t]
        part *= un[t]
        np.multiply(part, now[2 * HIDDEN :], out=now[HIDDEN : 2 * HIDDEN])
        dh *= z[t]
        dh += net.gates @ now
        if opens[t]:
            dh *= ~first[t]
    grads["gates"] = before.transpose(1, 0, 2).reshape(HIDDEN, -1) @ du.reshape(3 * HIDDEN, -1).T
    token = read.ravel().astype(np.intp)
    grads["inputs"] = np.empty_like(net.inputs)
    for k, row in enumerate([*du[: 2 * HIDDEN], *dns]):
        grads["inputs"][:, k] = np.bincount(token, row.ravel(), len(net.inputs))
    norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
    if norm > 1:
        grads = {k: g / norm for k, g in grads.items()}
    return grads, loss / count, h.T


def train(net: Network, reads: list[np.ndarray], targets: list[np.ndarray], epochs: int = 3, lanes: int = 64, window: int = 24, rate: float = 0.01) -> list[float]:
    """Truncated backpropagation; returns the mean loss of each epoch."""
    losses = []
    if not targets:
        return losses
    laid, adam = lay_out(reads, targets, lanes), _Adam(rate)
    starts = range(0, len(laid.read), window)
    for epoch in range(epochs):
        h, seen = np.zeros((laid.read.shape[1], HIDDEN), np.float32), []
        adam.rate = rate * (1 - epoch / epochs)
        for at in starts:
            cut = slice(at, at + window)
            grads, loss, h = gradients(net, laid.read[cut], laid.target[cut], laid.first[cut], h)
            adam.update(net, grads)
            seen.append(loss)
        losses.append(float(np.mean(seen)))
    return losses


@dataclass
class Vocabulary:
    """Frequent words by number: 0 is the end token, numbers below ``words`` belong to the model."""

    numbers: dict[bytes, int]
    words: int
    endings: np.ndarray  # by number

    def encode(self, words: list[bytes], end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(number or -1 of each token, what is read, what is predicted, the words without number)."""
        get = self.numbers.get
        number = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        rare_at = np.flatnonzero(number < 0)
        rare = [words[i] for i in rare_at.tolist()]
        shown = np.where(number < self.words, number, self.words + self.endings[number])
        if rare:
            shown[rare_at] = np.fromiter((self.words + _ending(w) for w in rare), np.int32, len(rare))
        target = np.where((number < 0) | (number >= self.words), self.words, number)
        if end:
            number, shown, target = (np.append(x, np.int32(END)) for x in (number, shown, target))
        read = np.concatenate([[END], shown[:-1]]).astype(np.int32)
        return number, read, target.astype(np.int32), rare


@dataclass
class Numbering:
    """A vocabulary by the hashes of its words, to number whole columns of texts at once."""

    hashes: np.ndarray  # in order
    numbers: np.ndarray
    words: int
    endings: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Numbering:
        listed = pa.array(list(vocabulary.numbers), pa.binary())
        hashes = np.concatenate([np.empty(0, np.uint64), *(w[-1] for w in wordhash.words(listed, _IS_WORD))])
        order = np.argsort(hashes)
        numbers = np.fromiter(vocabulary.numbers.values(), np.int32, len(vocabulary.numbers))
        return cls(hashes[order], numbers[order], vocabulary.words, vocabulary.endings)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``Vocabulary.encode`` of every text of a column, with its end; words without number by their hashes."""
        for first, stop, data, owner, starts, ends, hashes in wordhash.words(texts, _IS_WORD):
            number = np.full(len(hashes), -1, np.int32)
            if len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                number = np.where(self.hashes[at] == hashes, self.numbers[at], number)
            shown = np.where(number < self.words, number, self.words + self.endings[number])
            rare = np.flatnonzero(number < 0)
            last = ends[rare] - 1
            before = wordhash.LOWER[data[np.maximum(last - 1, starts[rare])]]
            shown[rare] = self.words + (wordhash.LOWER[data[last]] + 31 * before.astype(np.int32)) % ENDINGS
            target = np.where((number < 0) | (number >= self.words), self.words, number)
            # Each text's end token, number ``END``, follows its words.
            edges = np.searchsorted(owner, np.arange(first, stop + 1)) + np.arange(stop - first + 1)
            place = np.arange(len(number)) + owner - first
            flat = np.full((3, edges[-1]), END, np.int32)
            flat[:, place] = number, shown, target
            read = np.concatenate([[END], flat[1, :-1]]).astype(np.int32)
            rare_edges = np.searchsorted(owner[rare], np.arange(first, stop + 1))
            for i in range(stop - first):
                own = slice(edges[i], edges[i + 1])
                yield flat[0, own], read[own], flat[2, own], hashes[rare[rare_edges[i] : rare_edges[i + 1]]]


def _words(data: bytes | None) -> list[bytes]:
    return (data or b"").lower().split()


def _vocabulary(rows: DataFrame) -> Vocabulary:
    """The most frequent words of all of ``rows``; of equally frequent ones the first by bytes."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for data in batch.column(0):
                counts.update(_words(data.as_py()))
                if len(counts) >= TALLY_WORDS:
                    yield listed()
                    counts.clear()
        yield listed()

    words = rows.select("data").mapInArrow(tally, "word binary, n long")
    counted = stage(words.groupBy("word").agg(F.sum("n").alias("n")))
    # The smallest count that can still get a number, so that only as many words, and ties, are sorted.
    kinds = counted.groupBy("n").agg(F.count("*").alias("kinds")).orderBy(F.desc("n")).limit(NUMBERED).collect()
    least, seen = 1, 0
    for r in kinds:
        seen += r["kinds"]
        if seen >= NUMBERED - 1:
            least = r["n"]
            break
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(NUMBERED - 1).toArrow()  # a proven bound
    ranked = sorted(zip(top["n"].to_pylist(), top["word"].to_pylist()), key=lambda x: (-x[0], x[1]))
    listed = [bytes(w) for _, w in ranked]
    return Vocabulary(
        {w: i + 1 for i, w in enumerate(listed)}, min(MODEL_WORDS, len(listed) + 1), np.array([0, *(_ending(w) for w in listed)], np.int32)
    )


def learn_all(rows: DataFrame, vocabulary: Vocabulary, start: Network) -> tuple[Network, float, int]:
    """``start`` taught every token of ``rows``: each task its own texts, then the mean by tokens; loss and tokens.

    Long texts are learned in pieces of ``LEARN_PIECE`` tokens side by side, each of which reads the word before it.
    """
    shared = rows.sparkSession.sparkContext.broadcast((Numbering.of(vocabulary), start))
    schema = "slice int, tokens long, loss double, data binary"
    target_schema = pa.schema([("slice", pa.int32()), ("tokens", pa.int64()), ("loss", pa.float64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, start = shared.value
        net = Network(start.words, *(getattr(start, k).copy() for k in PARAMETERS))
        adam, tokens, loss = _Adam(LEARN_RATE), 0, 0.0
        reads: list[np.ndarray] = []
        targets: list[np.ndarray] = []
        waiting = 0

        def flush() -> None:
            nonlocal tokens, loss
            laid = lay_out(reads, targets, LANES)
            h = np.zeros((laid.read.shape[1], HIDDEN), np.float32)
            for at in range(0, len(laid.read), LEARN_WINDOW):
                cut = slice(at, at + LEARN_WINDOW)
                adam.rate = LEARN_RATE * math.sqrt(laid.read.shape[1] / LANES / (1 + adam.steps / 500))  # few lanes, small steps
                grads, mean, h = gradients(net, laid.read[cut], laid.target[cut], laid.first[cut], h)
                adam.update(net, grads)
                seen = int((laid.target[cut] >= 0).sum())
                tokens, loss = tokens + seen, loss + float(mean) * seen

        for batch in batches:
            for _, read, target, _ in numbering.encode(batch.column(0)):
                for at in range(0, len(target), LEARN_PIECE):
                    reads.append(read[at : at + LEARN_PIECE])
                    targets.append(target[at : at + LEARN_PIECE])
                    waiting += len(targets[-1])
                    if waiting >= LEARN_TOKENS:
                        flush()
                        reads, targets, waiting = [], [], 0
        if reads:
            flush()
        if tokens:
            flat = np.concatenate([getattr(net, k).ravel() for k in PARAMETERS]).astype(np.float64) * tokens
            yield as_batch([(k, tokens, loss, part.tobytes()) for k, part in enumerate(np.array_split(flat, SLICES))], target_schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for k, tokens, loss, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(data)
                if k in sums:
                    sums[k] = [sums[k][0] + tokens, sums[k][1] + loss, sums[k][2] + part]
                else:
                    sums[k] = [tokens, loss, part]
        yield as_batch([(k, tokens, loss, part.tobytes()) for k, (tokens, loss, part) in sums.items()], target_schema)

    taught = rows.select("data").mapInArrow(run, schema)
    got = sorted(tuple(r) for r in taught.repartition(SLICES, "slice").mapInArrow(add, schema).collect())  # SLICES rows
    if not got:
        return start, 0.0, 0
    tokens, loss = got[0][1:3]
    flat = np.concatenate([np.frombuffer(r[3]) for r in got]) / tokens
    sizes = np.cumsum([getattr(start, k).size for k in PARAMETERS])[:-1]
    parts = zip(PARAMETERS, np.split(flat, sizes))
    return Network(start.words, *(part.reshape(getattr(start, k).shape).astype(np.float32) for k, part in parts)), loss / tokens, tokens


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", sample_texts: int = 3000,
        window_words: int = 300, epochs: int = 3, seed: int = 5) -> tuple[Vocabulary, Network, list[float]]:
    """Vocabulary and network from all rows where ``learn`` holds, and the mean loss of each pass of the start.

    The network starts with ``epochs`` passes over one window of each of about ``sample_texts`` rows; the last pass
    takes every token of every row.
    """
    rows = docs.where(learn).select(F.col(text_col).cast("binary").alias("data"), id_mix(F.col(id_col), F.lit("language model")).alias("mix"))
    vocabulary = _vocabulary(rows)
    n = rows.count()
    share = int(_SPACE * min(1.0, sample_texts / max(1, n)))
    sample = rows.where(F.pmod("mix", F.lit(_SPACE)) < share).limit(2 * sample_texts)

    def windows(data, mix) -> Iterator[tuple]:
        tokens = _words(data)
        start = mix % max(1, len(tokens) - window_words + 1)
        cut = tokens[start : start + window_words]
        yield mix, start + window_words >= len(tokens), b" ".join(cut)

    got = map_rows(sample, "mix long, tail boolean, words binary", windows).toArrow()
    texts = sorted(zip(got["mix"].to_pylist(), got["words"].to_pylist(), got["tail"].to_pylist()))
    pairs = [vocabulary.encode(bytes(w).split(), end)[1:3] for _, w, end in texts]
    pairs = [p for p in pairs if len(p[1])]
    net = network(vocabulary.words, seed)
    losses = train(net, [r for r, _ in pairs], [t for _, t in pairs], epochs)
    return vocabulary, learn_all(rows, vocabulary, net)[0], losses


_LISTED = pa.schema(
    [("n_tokens", pa.int64()), ("n_rest", pa.int64()), ("network", pa.float64()), ("numbers", pa.binary()), ("counts", pa.binary()),
     ("rare", pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int32())])))]
)


def _network_rows(shared, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("held_out", pa.bool_()), *_LISTED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, net = shared.value
        rows: list[list] = []
        reads: list[np.ndarray] = []
        targets: list[np.ndarray] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for row, score in zip(rows, score_texts(net, reads, targets)):
                row[4] = float(score) / math.log(10)
            for at in range(0, len(rows), 2048):
                *columns, word, times = zip(*rows[at : at + 2048])
                arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
                offsets = np.concatenate([[0], np.cumsum([len(w) for w in word])]).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(word)), pa.array(np.concatenate(times).astype(np.int32))], names=["word", "n"]
                )
                yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets), pairs)], schema=schema)

        for batch in batches:
            ids, held_out = (batch.column(k).to_pylist() for k in range(2))
            for doc_id, held, (number, read, target, rare) in zip(ids, held_out, numbering.encode(batch.column(2))):
                seen, n = np.unique(number[number >= 0], return_counts=True)
                word, times = np.unique(rare.view(np.int64), return_counts=True)
                rows.append([
                    doc_id, held, len(number), int((target == net.words).sum()), 0.0, seen.astype(np.int32).tobytes(), n.astype(np.int32).tobytes(),
                    word, times,
                ])
                reads.append(read)
                targets.append(target)
                waiting += len(number)
                if waiting >= BLOCK_TOKENS:
                    yield from flush()
                    rows, reads, targets, waiting = [], [], [], 0
        if rows:
            yield from flush()

    return run


def _number_counts(listed: DataFrame) -> np.ndarray:
    """Training counts of the numbered words; at most ``NUMBERED`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(NUMBERED, np.int64)
        for batch in batches:
            for numbers, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[np.frombuffer(numbers, np.int32)] += np.frombuffer(counts, np.int32)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["number", "n"])

    parts = listed.where(~F.col("held_out")).select("numbers", "counts").mapInArrow(run, "number int, n long")
    got = parts.groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(NUMBERED, np.int64)
    out[got["number"].to_numpy()] = got["n"].to_numpy()
    return out


def score(docs: DataFrame, held_out: Column, vocabulary: Vocabulary, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text."""
    from pyspark.sql.pandas.types import to_arrow_type

    context = docs.sparkSession.sparkContext
    shared = context.broadcast((Numbering.of(vocabulary), net))
    id_type = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("data"))
    schema = (
        f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_rest long, network double, numbers binary, counts binary, "
        "rare array<struct<word:bigint,n:int>>"
    )
    listed = stage(source.mapInArrow(_network_rows(shared, to_arrow_type(id_type)), schema).withColumn("row", F.monotonically_increasing_id()))

    # Words without a number: their training count meets every text that holds them in the task of their hash.
    rare = listed.select("row", "held_out", F.inline("rare"))
    same = W.partitionBy("word")
    counted = rare.select(
        "row", "n", F.sum(F.when(F.col("held_out"), 0).otherwise(F.col("n"))).over(same).alias("c"),
        (F.row_number().over(same.orderBy("row")) == 1).alias("once"),
    )
    gain = F.log10((F.col("c") + ALPHA) / ALPHA)
    known = F.col("c") > 0
    per_text = stage(
        counted.groupBy("row").agg(
            F.sum(F.col("n") * gain).alias("rare_gain"), F.sum(F.when(known, F.col("n"))).alias("rare_known"),
            F.sum(F.when(known & F.col("once"), 1)).alias("kinds"),
        )
    )
    numbered = _number_counts(listed)
    tokens = listed.where(~F.col("held_out")).agg(F.sum("n_tokens")).first()[0] or 0
    kinds = int((numbered > 0).sum()) + (per_text.agg(F.sum("kinds")).first()[0] or 0)
    in_model = numbered[: net.words]
    base_norm = math.log10(tokens + ALPHA * (kinds + 1))
    rest_norm = math.log10(tokens - int(in_model.sum()) + ALPHA * (kinds - int((in_model > 0).sum()) + 1))
    gains = context.broadcast((np.log10((numbered + ALPHA) / ALPHA), numbered > 0, net.words))

    def sums(row, numbers, counts) -> Iterator[tuple]:
        gain_of, is_known, words = gains.value
        at, n = np.frombuffer(numbers, np.int32), np.frombuffer(counts, np.int32)
        value = n * gain_of[at]
        yield row, float(value.sum()), float(value[at >= words].sum()), int(n[is_known[at]].sum())

    own = map_rows(listed.select("row", "numbers", "counts"), "row long, gain double, rest_gain double, known long", sums)
    joined = listed.drop("numbers", "counts", "rare").join(own, "row").join(per_text, "row", "left")
    rare_gain = F.coalesce("rare_gain", F.lit(0.0))
    floor = math.log10(ALPHA)
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("gain") + rare_gain + F.col("n_tokens") * (floor - base_norm)).alias("base_score"),
        (F.col("network") + F.col("rest_gain") + rare_gain + F.col("n_rest") * (floor - rest_norm)).alias("score"),
    )
