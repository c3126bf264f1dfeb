"""LM scoring by online logistic mixing of hashed-context bit predictors.

A text is a sequence of tokens: its words in lower case (A-Z), and one end. Each
token is coded in bits, each bit is predicted by several contexts, their stretched
probabilities are mixed with weights that two gates choose, and the mix is refined by
an adaptive table. The score is the sum of the logarithms over all bits.

The code. The most frequent tokens, at most ``hot_words``, and classes of all others
by their last two bytes are the leaves of a tree, sorted by their spelling from behind
and split by weight. The first ``DEPTH`` bits of a leaf are mixed from contexts:

* the last frequent word; the last two frequent words; the token before, or the class
  of it; the two tokens before, hashed.

What lies below has the probability of its share. A token of a class is either known,
with the share of its exact count in the class, or new, and spelled from behind in
bits of bytes that contexts of its two to five last bytes and its class predict, mixed
and refined likewise. So probabilities depend on the tokens before, those of all
tokens sum to at most one, and what is counted grows with the corpus.

Learning is online. A task goes through its rows in their order, in batches: it
predicts a batch from its counts so far, moves the weights and the refinement, then
adds the batch to the counts. Counts of all tasks are summed, and their weights
averaged by the bits they saw. The spelling learns from all tokens seen once, which
stand for new ones.

Scoring reads each text where it lies, as the numbers of its leaves; the exact counts
of rarer tokens are joined by token, of which none is hot, and summed.

Memory: context tables have fixed sizes, about 25 MB, and travel as a broadcast;
counts of tokens stay distributed. The driver sees the hot words and sums by two last
bytes, both bounded.

Defined results: null text is the end token alone; a document without an id is
learned from and is not held out; repeated rows are scored each on its own and
counted each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import crc_mod, cut, slices, sweep, texts_of

#: No UTF-8 text has this byte.
END = b"\xff"
#: Bits of a leaf that are mixed, and frequent words that are contexts.
DEPTH, FREQUENT = 8, 32
NODES = 1 << DEPTH
#: Most frequent tokens that are a context by themselves; others are one by their class.
NEAR = 1024
CLASSES = 256
#: First slot of each context's table: of leaves (the last is hashed), and of spelling (all hashed).
LEAF_SLOTS = np.cumsum([0, (FREQUENT + 1) * NODES, (FREQUENT + 1) ** 2 * NODES, (NEAR + CLASSES + 1) * NODES, 1 << 19])
SPELL_BITS = (18, 19, 19, 19)
SPELL_SLOTS = np.cumsum([0, *[1 << b for b in SPELL_BITS]])
#: Added to both counts of a slot.
PRIOR = np.float32(0.4)
#: Tokens, or bytes, to a batch.
BATCH = 1 << 15
CHUNK = 4096
BUCKETS = 33
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Mixer:
    """Weights by two gates, and the adaptive table by a place and the mix."""

    def __init__(self, inputs: int, gates: tuple[int, int], places: int):
        self.weights = [np.full((inputs + 1, g), 0.6 / inputs, np.float32) for g in gates]
        self.seen = [np.full(w.shape, 1e-4, np.float32) for w in self.weights]
        for w in self.weights:
            w[-1] = 0
        self.gates = gates
        self.refine = np.zeros((places * BUCKETS, 2), np.float32)
        self.bits = 0.0

    def mixed(self, x: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """gate: first gate times the number of second ones, plus the second gate."""
        both = (self.weights[0][:, :, None] + self.weights[1][:, None, :]).reshape(len(x) + 1, -1)
        z = (both[-1] * np.float32(0.3)).take(gate, mode="clip")
        for own, w in zip(x, both):
            z += own * w.take(gate, mode="clip")
        return np.clip(z, -16, 16, out=z)

    @staticmethod
    def slot(z: np.ndarray, place: np.ndarray) -> np.ndarray:
        return place * BUCKETS + np.clip(np.rint(z * 2) + BUCKETS // 2, 0, BUCKETS - 1).astype(np.int64)

    def refined(self, z: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The probability of a one: the mean of the mix and of what was seen where it stood like that."""
        p = 1 / (1 + np.exp(-z))
        zero, one = _pairs(self.refine.reshape(-1), self.slot(z, place))
        return (p + (one + 20 * p) / (zero + one + 20)) / 2

    def learn(self, x: list[np.ndarray], gate: np.ndarray, place: np.ndarray, bit: np.ndarray) -> None:
        """A step of descent on a batch, then its bits in the refinement."""
        z = self.mixed(x, gate)
        error = bit - 1 / (1 + np.exp(-z))
        size = self.gates[0] * self.gates[1]
        sums = np.stack([np.bincount(gate, error * own, size) for own in [*x, np.float32(0.3)]]).reshape(-1, *self.gates)
        n = np.bincount(gate, minlength=size).reshape(self.gates)
        for axis, w, seen in zip((2, 1), self.weights, self.seen):
            step = (sums.sum(axis) / np.maximum(n.sum(axis - 1), 1)).astype(np.float32)
            seen += step * step
            w += np.float32(0.02) * step / np.sqrt(seen)
        np.add.at(self.refine.reshape(-1), 2 * self.slot(z, place) + bit.astype(np.int64), np.float32(1))
        self.bits += len(bit)

    def state(self) -> np.ndarray:
        """What averages to the mean weights by bits, and sums to the refinement."""
        return np.concatenate([[self.bits], *[w.ravel() * self.bits for w in self.weights], self.refine.ravel()]).astype(np.float64)

    def restore(self, total: np.ndarray) -> Mixer:
        self.bits, at = float(total[0]), 1
        for w in self.weights:
            if self.bits:
                w[:] = (total[at : at + w.size] / self.bits).reshape(w.shape)
            at += w.size
        self.refine[:] = total[at:].reshape(self.refine.shape)
        return self


def _pairs(table: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of zeros and ones of each slot, in one look into the table."""
    both = table.view(np.uint64).take(slot, mode="clip").view(np.float32)
    return both[::2], both[1::2]


def _inputs(table: np.ndarray, slots: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Stretched probabilities of a one, and how often each context was seen."""
    x, n = [], []
    for at in slots:
        zero, one = _pairs(table, at)
        x.append(np.log((one + PRIOR) / (zero + PRIOR)))
        n.append(zero + one)
    return x, n


def _level(n: np.ndarray, edges: tuple[float, ...]) -> np.ndarray:
    """How many edges n is above."""
    out = (n > np.float32(edges[0])).view(np.int8)
    for e in edges[1:]:
        out = out + (n > np.float32(e)).view(np.int8)
    return out


class Leaves:
    """The tree of hot tokens and classes.

    hot: tokens with their counts, most frequent first, END among them. tails: (last two
    bytes, tokens in the training documents, those of them seen once) of all other tokens.
    """

    def __init__(self, hot: list[tuple[bytes, int]], tails: list[tuple[bytes, int, int]]):
        self.place = {w: k for k, (w, _) in enumerate(hot)}
        by_tail = {t[::-1]: (n, once) for t, n, once in tails}
        keys = sorted(by_tail)
        # runs of tails of about equal weight are a class; a tail that nothing has is of the class before it
        edges, share, held = [b""], max(1, sum(n + 1 for n, _ in by_tail.values()) // (CLASSES - 1)), 0
        sums = [[0, 0]]
        for k in keys:
            if held + by_tail[k][0] + 1 > share and held and len(edges) < CLASSES:
                edges.append(k)
                sums.append([0, 0])
                held = 0
            held += by_tail[k][0] + 1
            sums[-1][0] += by_tail[k][0]
            sums[-1][1] += by_tail[k][1]
        self.edges, self.n_hot = edges, len(hot)
        self.total, self.once = (np.array([s[j] for s in sums], np.float64) for j in (0, 1))
        #: share of new tokens in a class
        self.new = np.where(self.total > 0, (self.once + 0.5) / (self.total + 1), 1.0)
        leaves = sorted([(w[::-1], c, k) for k, (w, c) in enumerate(hot)] + [(e, int(n) + 1, len(hot) + j) for j, (e, n) in enumerate(zip(edges, self.total))])
        self.length, self.code, self.tail = (np.zeros(len(leaves), t) for t in (np.int64, np.int64, np.float64))
        before = np.concatenate([[0], np.cumsum([c for _, c, _ in leaves])]).astype(np.float64)
        open_ = [(0, len(leaves), 0, 0)]
        while open_:
            i, j, depth, code = open_.pop()
            if j - i == 1 or depth == DEPTH:
                for m in range(i, j):
                    at = leaves[m][2]
                    self.length[at], self.code[at] = depth, code << (DEPTH - depth)
                    self.tail[at] = math.log10((before[m + 1] - before[m]) / (before[j] - before[i]))
                continue
            m = min(max(int(np.searchsorted(before, (before[i] + before[j]) / 2)), i + 1), j - 1)
            if m - 1 > i and before[m] - (before[i] + before[j]) / 2 > (before[i] + before[j]) / 2 - before[m - 1]:
                m -= 1
            open_ += [(i, m, depth + 1, 2 * code), (m, j, depth + 1, 2 * code + 1)]
        # the class of a hot token is that of its tail, and its context that class unless it is one of the nearest
        own = [k if k < NEAR else NEAR + self.class_of(w) for k, (w, _) in enumerate(hot)]
        self.near = np.array([*own, *range(NEAR, NEAR + len(edges)), NEAR + CLASSES], np.int64)  # the last: no token

    def class_of(self, word: bytes) -> int:
        from bisect import bisect_right

        return bisect_right(self.edges, word[-2:][::-1]) - 1


def _leaf_batches(texts: list[np.ndarray], leaves: Leaves) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(leaf of each token, its text, first slots of the contexts, is the token before of a class) in batches of whole texts."""
    held: list[tuple[int, np.ndarray]] = []

    def batch():
        idx = np.concatenate([t for _, t in held])
        lengths = np.array([len(t) for _, t in held])
        text = np.repeat([k for k, _ in held], lengths)
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at, none = np.arange(len(idx)), len(leaves.near) - 1
        one = np.where(at > starts, np.concatenate([[none], idx[:-1]]), none)
        two = np.where(at > starts + 1, np.concatenate([[none, none], idx[:-2]])[: len(idx)], none)
        # the last frequent word before each token, and the last before that
        last = np.maximum.accumulate(np.where(idx < FREQUENT, at, -1))
        before = np.concatenate([[-1], last[:-1]])
        lf = np.where(before >= starts, idx[before], FREQUENT)
        further = before[np.maximum(before, 0)]
        lf2 = np.where((before >= starts) & (further >= starts), idx[further], FREQUENT)
        pair = (one.astype(np.uint64) * np.uint64(0x100003) + two.astype(np.uint64) + np.uint64(1)) * _MIX
        return idx, text, [lf * NODES, (lf * (FREQUENT + 1) + lf2) * NODES, leaves.near[one] * NODES, pair], one >= leaves.n_hot

    n = 0
    for k, t in enumerate(texts):
        held.append((k, t))
        n += len(t)
        if n >= BATCH:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _leaf_bits(leaves: Leaves, idx: np.ndarray, firsts: list[np.ndarray], rare: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """For each bit: (tokens that have it, the bit, its node, its slots, the second gate)."""
    length, code = leaves.length[idx], leaves.code[idx]
    for d in range(DEPTH):
        at = np.flatnonzero(length > d)
        if not len(at):
            return
        own = code[at]
        node = (1 << d) | (own >> (DEPTH - d))
        slots = [LEAF_SLOTS[k] + f[at] + node for k, f in enumerate(firsts[:3])]
        hashed = (firsts[3][at] ^ (node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _MIX
        slots.append(LEAF_SLOTS[3] + (hashed >> np.uint64(45)).astype(np.int64))
        yield at, ((own >> (DEPTH - 1 - d)) & 1).astype(np.float32), node, slots, 2 * d + rare[at]


def leaf_mixer() -> Mixer:
    return Mixer(4, (20, 2 * DEPTH), NODES)


def _leaf_gate(n: list[np.ndarray]) -> np.ndarray:
    return (_level(n[1], (0.5, 3.5, 15.5, 255.5)) * 4 + _level(n[3], (0.5, 3.5, 15.5))).astype(np.int64)


def learn_leaves(texts: list[np.ndarray], leaves: Leaves, table: np.ndarray, mixer: Mixer) -> None:
    for idx, _, firsts, rare in _leaf_batches(texts, leaves):
        added = []
        for _, bit, node, slots, spot in _leaf_bits(leaves, idx, firsts, rare):
            x, n = _inputs(table, slots)
            mixer.learn(x, _leaf_gate(n) * (2 * DEPTH) + spot, node, bit)
            one = bit.astype(np.int64)
            added += [2 * s + one for s in slots]
        for at in added:
            np.add.at(table, at, np.float32(1))


def score_leaves(texts: list[np.ndarray], leaves: Leaves, table: np.ndarray, mixer: Mixer) -> np.ndarray:
    """log10 of the probability of the leaves of each text."""
    out = np.zeros(len(texts))
    for idx, text, firsts, rare in _leaf_batches(texts, leaves):
        cost = leaves.tail[idx].copy()
        for at, bit, node, slots, spot in _leaf_bits(leaves, idx, firsts, rare):
            x, n = _inputs(table, slots)
            p = mixer.refined(mixer.mixed(x, _leaf_gate(n) * (2 * DEPTH) + spot), node)
            cost[at] += np.log10(np.abs((1 - bit) - p))
        out += np.bincount(text, cost, len(texts))
    return out


class Bytes:
    """A prefix code of bytes by their counts; a new token is spelled from behind, a zero byte last."""

    def __init__(self, counts: np.ndarray):
        import heapq

        heap = [(float(c) + 0.01, k, k) for k, c in enumerate(counts)]
        heapq.heapify(heap)
        parents, n = {}, 256
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parents[x], parents[y] = (n, 0), (n, 1)
            heapq.heappush(heap, (a + b, n, n))
            n += 1
        codes = []
        for k in range(256):
            own, x = [], k
            while x in parents:
                x, bit = parents[x]
                own.append((x - 255, bit))
            codes.append(own[::-1])
        deepest = max(map(len, codes))
        self.length = np.array([len(c) for c in codes])
        self.node, self.bit = np.zeros((deepest, 256), np.int64), np.zeros((deepest, 256), np.float32)
        for k, own in enumerate(codes):
            for d, (node, bit) in enumerate(own):
                self.node[d, k], self.bit[d, k] = node, bit

    def batches(self, words: list[bytes], classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """(byte, its word, hashes of the contexts, place up to 3) of about BATCH bytes at a time. A longer word is cut into pieces that know the bytes before."""
        spelled, held, n = [], [], 0

        def batch():
            data = np.concatenate([np.frombuffer(s, np.uint8) for s, _, _ in held]).astype(np.int64)
            lengths = np.array([len(s) for s, _, _ in held])
            word = np.repeat(np.arange(len(held)), lengths)
            starts = (np.cumsum(lengths) - lengths)[word]
            skip = np.array([m for _, _, m in held])[word]
            at = np.arange(len(data))
            cls = classes[[k for _, k, _ in held]][word].astype(np.uint64) + np.uint64(257)
            hashes, h = [], np.zeros(len(data), np.uint64)
            for k in range(1, 6):
                before = np.where(at - starts >= k, np.concatenate([np.zeros(k, np.int64), data[:-k]])[: len(data)].astype(np.uint64), cls if k <= 2 else np.uint64(256))
                h = (h + before + np.uint64(1)) * _MIX
                h ^= h >> np.uint64(29)
                if k > 1:
                    hashes.append(h)
            own = np.flatnonzero(at - starts >= skip)
            ids = np.array([k for _, k, _ in held])[word]
            return data[own], ids[own], [x[own] for x in hashes], np.minimum(at - starts, 3)[own]

        for k, w in enumerate(words):
            s = w[::-1] + b"\0"
            spelled = [(s[:BATCH], k, 0)] + [(s[i - 5 : i + BATCH], k, 5) for i in range(BATCH, len(s), BATCH)]
            for piece in spelled:
                held.append(piece)
                n += len(piece[0])
                if n >= BATCH:
                    yield batch()
                    held, n = [], 0
        if held:
            yield batch()

    def bits(self, data: np.ndarray, hashes: list[np.ndarray], place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        length = self.length[data]
        for d in range(len(self.node)):
            at = np.flatnonzero(length > d)
            if not len(at):
                return
            node, bit = self.node[d][data[at]], self.bit[d][data[at]]
            extra = node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            slots = [SPELL_SLOTS[k] + (((h[at] ^ extra) * _MIX) >> np.uint64(64 - SPELL_BITS[k])).astype(np.int64) for k, h in enumerate(hashes)]
            yield at, bit, node, slots, 4 * min(d, 7) + place[at]


def spell_mixer() -> Mixer:
    return Mixer(4, (48, 32), 256)


def _spell_gate(n: list[np.ndarray]) -> np.ndarray:
    return ((_level(n[1], (0.5, 3.5, 31.5)) * 4 + _level(n[2], (0.5, 3.5, 15.5))) * 3 + _level(n[3], (0.5, 3.5))).astype(np.int64)


def learn_spelling(words: list[bytes], classes: np.ndarray, code: Bytes, table: np.ndarray, mixer: Mixer) -> None:
    for data, _, hashes, place in code.batches(words, classes):
        added = []
        for _, bit, node, slots, spot in code.bits(data, hashes, place):
            x, n = _inputs(table, slots)
            mixer.learn(x, _spell_gate(n) * 32 + spot, node, bit)
            one = bit.astype(np.int64)
            added += [2 * s + one for s in slots]
        for at in added:
            np.add.at(table, at, np.float32(1))


def score_spelling(words: list[bytes], classes: np.ndarray, code: Bytes, table: np.ndarray, mixer: Mixer) -> np.ndarray:
    """log10 of the probability of each word's spelling."""
    out = np.zeros(len(words))
    for data, word, hashes, place in code.batches(words, classes):
        cost = np.zeros(len(data))
        for at, bit, node, slots, spot in code.bits(data, hashes, place):
            x, n = _inputs(table, slots)
            p = mixer.refined(mixer.mixed(x, _spell_gate(n) * 32 + spot), node)
            cost[at] += np.log10(np.abs((1 - bit) - p))
        out += np.bincount(word, cost, len(words))
    return out


def _tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # both as of ASCII alone


def count_tokens(docs: DataFrame, held: str, text: str = "text") -> DataFrame:
    """(word, c): every token of docs, with its count in rows whose column held is false; checkpointed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        size = 0

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        for batch in slices(batches):
            for t, out in zip(texts_of(batch.column(1)), batch.column(0).to_pylist()):
                if out:
                    counts.update(dict.fromkeys((*_tokens(t), END), 0))
                else:
                    counts.update(_tokens(t))
                    counts[END] += 1
                size += len(t)
            if len(counts) > 400_000 or size > 64 << 20:
                yield flush()
                size = 0
        if counts:
            yield flush()

    counted = docs.select(F.col(held).alias("h"), F.col(text).alias("t")).mapInArrow(run, "word binary, c long")
    return cut(counted.groupBy("word").agg(F.sum("c").alias("c")))


def _threshold(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` tokens reach, of the whole powers of 2 ** (1 / 8)."""
    level = F.floor(F.log2("c") * 8).cast("int").alias("level")
    levels = words.where("c > 0").groupBy(level).count().orderBy(F.desc("level")).collect()  # a row for each eighth of a power
    held, least = 0, None
    for r in levels:
        held += r["count"]
        if held > most:
            break
        least = r["level"]
    return 1 << 62 if least is None else math.ceil(2 ** (least / 8) - 1e-9)


def _learned(rows: DataFrame, work, slots: int, blank) -> tuple[np.ndarray, Mixer]:
    """The sum over all tasks of the counts that work(batch, table, mixer) makes, and the mean mixer. The state of a task
    travels in compressed chunks of its table, so that no task takes more than one chunk of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, mixer, any_ = np.zeros(2 * slots, np.float32), blank(), False
        for batch in batches:
            if batch.num_rows:
                any_ = True
                work(batch, table, mixer)
        if any_:
            parts = [table[i : i + 2 * CHUNK] for i in range(0, len(table), 2 * CHUNK)]
            used = [k for k, x in enumerate(parts) if x.any()]
            for i in range(0, len(used), 64):
                own = used[i : i + 64]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in own], pa.binary())], names=["chunk", "data"])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([zlib.compress(mixer.state().tobytes(), 1)], pa.binary())], names=["chunk", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by chunk; one sum is held at a time."""
        at, total = None, None
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(zlib.decompress(x.as_buffer()), np.float64 if k < 0 else np.float32)
                if k == at:
                    total += own
                    continue
                if at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "data"])
                at, total = k, own.copy()
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "data"])

    parts = rows.mapInArrow(run, "chunk int, data binary").repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, data binary")
    table, mixer = np.zeros(2 * slots, np.float32), blank()
    for r in parts.toLocalIterator():  # the table is of fixed size
        if r["chunk"] < 0:
            mixer.restore(np.frombuffer(zlib.decompress(r["data"]), np.float64))
        else:
            own = np.frombuffer(zlib.decompress(r["data"]), np.float32)
            table[2 * CHUNK * r["chunk"] : 2 * CHUNK * r["chunk"] + len(own)] = own
    return table, mixer


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 7, remainder: int = 2, hot_words: int = 60_000,
) -> DataFrame:
    """Per document: the id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte.

    Held out are documents whose id's crc32 has the remainder; the others are learned
    from. base_score is an add-one unigram score. n_bytes counts the bytes of the
    tokens, each but the end with a blank, which score covers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(crc_mod(F.col(doc_id), modulus) == remainder, F.lit(False)).alias("_held"), F.col(text).alias("_t"))
    words = count_tokens(rows, "_held", "_t")
    stats = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.max(F.when(F.col("word") == F.lit(END), F.col("c"))).alias("end")).first()
    n, v = stats["n"], stats["v"]
    below = math.log10(n + v + 1)
    least = _threshold(words, hot_words)
    is_hot = (F.col("c") >= least) | (F.col("word") == F.lit(END))
    hot = [(r["word"], r["c"]) for r in words.where(is_hot & (F.col("c") > 0)).collect()]  # at most hot_words and the end
    hot = sorted([(bytes(w), c) for w, c in hot] or [(END, 1)], key=lambda x: (-x[1], x[0]))
    if not any(w == END for w, _ in hot):
        hot.append((END, 1))
    rare = words.where(~is_hot & (F.col("c") > 0))
    tail = F.substring("word", -2, 2).alias("tail")
    tails = rare.groupBy(tail).agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("once")).collect()  # at most a row for two bytes
    leaves = Leaves(hot, [(bytes(r["tail"]), r["n"], r["once"]) for r in tails])
    base_of = np.log10(np.array([c for _, c in hot]) + 1.0) - below
    known_of = np.array([w != END or bool(stats["end"]) for w, _ in hot])
    shared = spark.sparkContext.broadcast((leaves, base_of, known_of))

    names = ["uid", "_id", "held", "tokens", "bytes", "base", "known", "leaves", "rare", "times"]
    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("_id", docs.schema[doc_id].dataType), T.StructField("held", T.BooleanType()), T.StructField("tokens", T.LongType()), T.StructField("bytes", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("known", T.LongType()), T.StructField("leaves", T.BinaryType()), T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.IntegerType())),
    ])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text as the numbers of its leaves, and its tokens that are not hot with their counts."""
        from pyspark import TaskContext

        leaves, base_of, known_of = shared.value
        place = leaves.place.get

        class Tails(dict):
            def __missing__(self, tail):
                self[tail] = out = leaves.n_hot + leaves.class_of(tail)
                return out

        tails = Tails()
        uid = TaskContext.get().partitionId() << 36
        for batch in slices(batches, 2):
            out: list[list] = [[] for _ in names]
            for t, held in zip(texts_of(batch.column(2)), batch.column(1).to_pylist()):
                tokens = [*_tokens(t), END]
                found = np.fromiter(map(place, tokens, repeat(-1)), np.int64, len(tokens))
                here, lacking = found[found >= 0], np.flatnonzero(found < 0)
                others = [tokens[k] for k in lacking.tolist()]
                found[lacking] = [tails[w[-2:]] for w in others]
                counted = Counter(others)
                for j, x in zip((0, 2, 3, 4, 5, 6, 7, 8, 9), (uid, held, len(tokens), sum(map(len, tokens)) + len(tokens) - 1, float(base_of[here].sum()), int(known_of[here].sum()), found.astype("<u2").tobytes(), list(counted), list(counted.values()))):
                    out[j].append(x)
                uid += 1
            kinds = [pa.int64(), None, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0) if k is None else pa.array(x, k) for x, k in zip(out, kinds)], names=names)

    coded = cut(rows.mapInArrow(code, schema))

    def numbers(column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u2").astype(np.int64) for x in column.to_pylist()]

    def learn_texts(batch: pa.RecordBatch, table: np.ndarray, mixer: Mixer) -> None:
        for i in range(0, batch.num_rows, 256):
            learn_leaves(numbers(batch.column(0).slice(i, 256)), shared.value[0], table, mixer)

    leaf_table, mixer = _learned(coded.where("not held").select("leaves"), learn_texts, int(LEAF_SLOTS[-1]), leaf_mixer)
    # the bytes of hot words, seldom as they are new, give the code of bytes
    counts = np.bincount(np.frombuffer(b"".join(w + b"\0" for w, _ in hot), np.uint8), minlength=256)
    letters = Bytes(counts)

    def learn_words(batch: pa.RecordBatch, table: np.ndarray, mixer: Mixer) -> None:
        own = batch.column(0).to_pylist()
        learn_spelling(own, np.array([shared.value[0].class_of(w) for w in own]), letters, table, mixer)

    spell_table, speller = _learned(rare.where("c = 1").select("word"), learn_words, int(SPELL_SLOTS[-1]), spell_mixer)
    model = spark.sparkContext.broadcast((leaf_table, mixer, spell_table, speller))
    del leaf_table, spell_table
    sweep(spark)

    def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, mixer, _, _ = model.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lp = score_leaves(numbers(part.column(7)), shared.value[0], table, mixer)
                yield pa.RecordBatch.from_arrays([*part.columns[:7], pa.array(lp)], names=[*names[:7], "lp"])

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A known token's share of its class; a new one's spelling."""
        leaves, (_, _, table, speller) = shared.value[0], model.value
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                part = batch.slice(i, 20_000)
                own, c = part.column(0).to_pylist(), part.column(1).to_numpy().astype(np.float64)
                cls = np.array([leaves.class_of(w) for w in own], np.int64)
                lp = np.log10((1 - leaves.new[cls]).clip(1e-300)) + np.log10(np.maximum(c, 1) / np.maximum(leaves.total[cls], 1))
                new = np.flatnonzero(c == 0)
                lp[new] = np.log10(leaves.new[cls[new]]) + score_spelling([own[k] for k in new], cls[new], letters, table, speller)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lp)], names=["word", "wc", "wlp"])

    own = coded.select(*names[:8]).mapInArrow(score_texts, T.StructType([*schema.fields[:7], T.StructField("lp", T.DoubleType())]))
    scored = words.where(~is_hot).mapInArrow(score_words, "word binary, wc long, wlp double")
    rest = coded.where(F.size("rare") > 0).select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("uid", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    rest = rest.join(scored, "word").groupBy("uid").agg(
        F.sum(F.col("times") * (F.log10(F.col("wc") + 1.0) - below)).alias("base"), F.sum(F.col("times") * F.col("wlp")).alias("lp"), F.sum(F.when(F.col("wc") > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    out = own.unionByName(rest, allowMissingColumns=True).groupBy("uid").agg(
        F.max("_id").alias(doc_id), F.max("held").alias("held_out"), F.max("tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("lp").alias("score"), F.max("bytes").alias("n_bytes"),
    )
    return out.select(
        doc_id, "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
        (-F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
