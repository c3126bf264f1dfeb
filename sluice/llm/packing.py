"""Best-fit packing of documents into token sequences, with swap-based local search.

Documents become pieces of at most ``capacity`` tokens; a longer one is cut so that
all pieces but the first are full. Pieces are dealt by a hash to blocks of about
``BLOCK`` pieces, and each block is packed by itself: best fit over descending
lengths, then a local search among its underfull bins that empties bins by moving a
piece, or exchanging one piece for one or for two, wherever that raises the sum of
squared fills. The bins that stay underfull in a block are opened again and their
pieces packed together in the next round, with fewer blocks, down to one; each
round has a small part of the pieces of the one before. No task holds more than a
block, and only lengths and keys are moved, never tokens.

Defined results: null text is empty, and each document has at least the end token;
equal rows are packed each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import cut, slices

BLOCK = 1 << 16
#: Bins filled below this share of the capacity are opened again in the next round.
FULL = 0.995


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's tokens, the end token last."""
    fields = [
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_ids
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.llm.tokens import byte_encoder

        encode, end = byte_encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            rows, column = [], batch.column(1)
            for k, ids in enumerate(encode([t or "" for t in column.to_pylist()])):
                ids += end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                for p, stop in enumerate(range(first, n + 1, capacity)):
                    start = max(0, stop - capacity) if p else 0
                    data = ids[4 * start : 4 * stop]
                    rows.append((k, p, start, stop - start, zlib.crc32(data), data))
            k, p, start, length, crc, data = (list(x) for x in zip(*rows)) if rows else ([],) * 6
            columns = [batch.column(0).take(pa.array(k, pa.int64())), pa.array(p, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(data, pa.binary())] * with_ids, names=names)

    return docs.select(doc_id, text).mapInArrow(run, T.StructType(fields))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in lengths: each piece, longest first, goes to the fullest bin that has room."""
    by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # rooms that some bin has, ascending
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[k]
        at = bisect_left(rooms, n)
        if at == len(rooms):
            bin_, room = [], capacity
        else:
            room = rooms[at]
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bin_.append(k)
        room -= n
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append(bin_)
    return [b for bins in by_room for b in bins]


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, effort: int | None = 1, reach: int | None = 64) -> list[list[int]]:
    """bins with fewer, or the same bins fuller: moves and swaps among underfull bins that raise squared fill.

    The emptiest bin gives. It moves a piece to the fullest bin with room, else
    exchanges one piece for a shorter one, else two pieces for a shorter one, of a
    bin that becomes fuller. When it is stuck, other bins exchange one for one, at most
    ``effort`` times the number of underfull bins. Each step raises the sum of squared
    fills; the search ends when no bin can be saved any more or no step is left.

    A step is looked for among the ``reach`` bins with most room or least, and pieces
    and pairs as many; without a reach and an effort among all, to the end.
    """
    some = reach if reach is not None else len(lengths) ** 2 + 1
    full = [b for b in bins if sum(lengths[k] for k in b) == capacity]
    open_ = [b for b in bins if sum(lengths[k] for k in b) < capacity]
    fill = [sum(lengths[k] for k in b) for b in open_]
    heap = [(f, i) for i, f in enumerate(fill)]
    heapq.heapify(heap)
    #: (length, bin) of every piece in an open bin, and (room, bin) of the bins
    items = sorted((lengths[k], i, k) for i, b in enumerate(open_) for k in b)
    rooms = sorted((capacity - f, i) for i, f in enumerate(fill))

    def resize(i: int, by: int) -> None:
        rooms.pop(bisect_left(rooms, (capacity - fill[i], i)))
        fill[i] += by
        insort(rooms, (capacity - fill[i], i))

    def shift(k: int, source: int, target: int) -> None:
        n = lengths[k]
        items.pop(bisect_left(items, (n, source, k)))
        open_[source].remove(k)
        open_[target].append(k)
        insort(items, (n, target, k))
        resize(source, -n)
        resize(target, n)

    def swap(giver: int, given: list[int]) -> bool:
        """given out of the giver for one piece of another bin, of most length, that leaves that bin fuller and not over."""
        total = sum(lengths[k] for k in given)
        for room, j in rooms[-some:][::-1]:
            if j == giver or room == 0:
                continue
            for k in sorted(open_[j], key=lambda k: -lengths[k]):
                d = total - lengths[k]
                if 0 < d <= room and fill[j] + d > fill[giver]:  # then the sum of squares rises
                    items.pop(bisect_left(items, (lengths[k], j, k)))
                    open_[j].remove(k)
                    open_[giver].append(k)
                    insort(items, (lengths[k], giver, k))
                    resize(j, -lengths[k])
                    resize(giver, lengths[k])
                    for x in given:
                        shift(x, giver, j)
                    return True
        return False

    def fill_up(j: int) -> bool:
        """One piece of bin j for a longer one of a bin no fuller than j will be; the longest that fits."""
        room = capacity - fill[j]
        for k in sorted(open_[j], key=lambda k: lengths[k]) if room else ():
            at = bisect_left(items, (lengths[k] + room + 1, -1, -1)) - 1
            for at in range(at, max(at - some, -1), -1):
                if items[at][0] <= lengths[k]:
                    break
                n, i, other = items[at]
                if i != j and fill[j] + n - lengths[k] > fill[i]:  # then the sum of squares rises
                    items.pop(bisect_left(items, (lengths[k], j, k)))
                    open_[j].remove(k)
                    open_[i].append(k)
                    insort(items, (lengths[k], i, k))
                    resize(j, -lengths[k])
                    resize(i, lengths[k])
                    shift(other, i, j)
                    heapq.heappush(heap, (fill[i], i))
                    return True
        return False

    steps = math.inf if effort is None else effort * len(open_)
    while len(heap) > 1:
        f, giver = heapq.heappop(heap)
        if f != fill[giver]:
            heapq.heappush(heap, (fill[giver], giver))
            continue
        changed = True
        while changed and open_[giver]:
            changed = False
            for k in sorted(open_[giver], key=lambda k: -lengths[k]):
                at = bisect_left(rooms, (lengths[k], -1))
                target = next((j for _, j in rooms[at : at + 2] if j != giver), None)
                if target is not None and fill[target] + lengths[k] > fill[giver]:
                    shift(k, giver, target)
                    changed = True
                    break
            if not changed:
                own = sorted(open_[giver], key=lambda k: -lengths[k])[:some]
                pairs = [[a, b] for i, a in enumerate(own) for b in own[i + 1 :]][:some]
                changed = any(swap(giver, g) for g in [*([k] for k in own), *pairs])
        if open_[giver]:
            # the emptiest bin can't be emptied as things are: other bins exchange, the fullest first, to make room
            if steps <= 0 or sum(capacity - f for f in fill if f) < capacity or not any(fill_up(j) for _, j in list(rooms[:some])):
                break
            steps -= 1
            heapq.heappush(heap, (fill[giver], giver))
    return full + [b for b in open_ if b]


def _packer(capacity: int, round_: int, effort: int | None, reach: int | None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held = [f for f in frames if len(f)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        rows = rows.sort_values(["length", "ids_crc32", "start"], kind="stable", ignore_index=True)
        lengths = rows["length"].tolist()
        base = (round_ << 56) | (TaskContext.get().partitionId() << 28)
        bins = local_search(best_fit(lengths, capacity), lengths, capacity, effort, reach)
        order = np.array([k for b in bins for k in b], np.int64)
        sizes = rows["length"].to_numpy()[order]
        starts = np.cumsum([0, *[len(b) for b in bins]])[:-1]
        before = np.cumsum(sizes) - sizes
        which = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = rows.iloc[order].reset_index(drop=True)
        out["sequence_id"] = base + which
        out["offset"] = before - before[starts][which]
        out["_fill"] = np.add.reduceat(sizes, starts)[which]
        yield out

    return run


def pack(parts: DataFrame, capacity: int = 1024, effort: int | None = 1, reach: int | None = 64) -> DataFrame:
    """parts (with length, ids_crc32 and start among its columns) with sequence_id and offset.

    The narrow table is written to the shared folder first: the rounds read it, not
    the tokenizer's work.
    """
    parts = cut(parts)
    fields = [*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*fields, T.StructField("_fill", T.LongType())])
    names = [f.name for f in fields]
    done: list[DataFrame] = []
    rest, n, round_ = parts, parts.count(), 0
    while True:
        blocks = max(1, -(-n // BLOCK))
        dealt = rest.repartition(blocks, F.xxhash64("ids_crc32", "start", "length", F.monotonically_increasing_id()))
        packed = cut(dealt.mapInPandas(_packer(capacity, round_, effort, reach), schema))
        if blocks == 1:
            break
        whole = packed.where(F.col("_fill") >= FULL * capacity)
        open_ = packed.where(F.col("_fill") < FULL * capacity)
        left = open_.count()
        if left > n // 2:  # little to gain: keep what there is
            break
        done.append(whole.select(*names))
        rest, n, round_ = open_.select(*parts.columns), left, round_ + 1
    out = packed.select(*names)
    for d in done:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2, effort: int | None = 1, reach: int | None = 64) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset. effort and reach bound the search of a block; None takes the bound away."""
    return pack(pieces(docs, path, doc_id, text, capacity, end_id), capacity, effort, reach)


def sequences(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(sequence_id, ids, n_ids): the packed sequences themselves, ids as little-endian unsigned 32-bit integers."""
    placed = pack(pieces(docs, path, doc_id, text, capacity, end_id, with_ids=True), capacity)
    own = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(F.transform(own, lambda x: x["ids"]), "")).alias("ids"), F.sum("length").alias("n_ids")
    )
