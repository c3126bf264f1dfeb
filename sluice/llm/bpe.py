"""BPE encoding by speculation and verification, and decoding.

For each new word a greedy longest match over the vocabulary proposes tokens. A
split is the BPE split exactly when every adjacent pair of its tokens is what BPE
makes of those two tokens laid together, so the distinct pairs of a batch are
tested together with arrays: both tokens are taken apart along the seam, the one
merged later first, and the pair fails when a merge across the seam would have come
before the merges that built its sides. Only words with a failing pair, or with a
token that BPE never makes of its own string, are merged exactly.

Encoding is row-local, without shuffle; a task's memory of words is bounded.

Defined results: null text is empty and has no tokens; special tokens that stand in
a text are their ids, as the library has them; equal texts get equal results; a word of
any length takes time in proportion to n log n.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.common import slices, texts_of
from sluice.llm.tokens import plain_chunks

MOST = 300_000
#: Symbols of a word up to which its pairs are looked through at each merge.
SHORT = 48
#: The last character whose words are found without the library.
LATIN = "\u024f"
NONE = np.int64(1 << 40)
#: Stands for no merge among the (rank, id) of merges.
FREE = (1 << 40, 0)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(spare))
        spare += b not in printable
    return out


class Vocabulary:
    """A BPE vocabulary with word ends, as arrays.

    ``rank`` is the place of the merge that makes a token (-1: none does), ``left``
    and ``right`` its two parts; ``pair_keys`` (sorted) and ``pair_ranks`` are the
    merges by their parts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for s, i in [*self.ids.items(), *self.special.items()]:
            self.strings[i] = s
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.rank, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            i, j, k = self.ids[a], self.ids[b], self.ids[a + b]
            self.merge.setdefault((i, j), (r, k))
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = r, i, j
        self.size = size
        keys = np.array([i * size + j for i, j in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.longest = max(len(s) for s in self.ids)
        self.letters = byte_letters()
        #: Tokens that BPE makes of their own string; the others are never proposed.
        self.proposable = {s: i for s, i in self.ids.items() if self.exact(self.symbols(s)) == [i]}

    def symbols(self, string: str) -> list[int]:
        """Ids of the single characters of a vocabulary string, the last with the word end if the string has it."""
        if self.end and string.endswith(self.end) and len(string) > len(self.end):
            body = string[: -len(self.end)]
            return [*[self.ids[c] for c in body[:-1]], self.ids[body[-1] + self.end]]
        return [self.ids[c] for c in string if c in self.ids]

    def exact(self, ids: list[int]) -> list[int]:
        """Merges the pair of least rank, leftmost first, until none is left."""
        if len(ids) > SHORT:
            return self._exact_by_heap(ids)
        ids, get = list(ids), self.merge.get
        ranks = [get(p, FREE) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is FREE:
                break
            k = ranks.index(best)
            ids[k : k + 2] = [best[1]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), FREE)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), FREE)
        return ids

    def _exact_by_heap(self, ids: list[int]) -> list[int]:
        """As exact; the pairs wait in a heap by rank and place, so that a word of n characters takes about n log n steps.

        A place keeps its token until it is taken into the token on its left; what the heap
        holds of a place is out of date where its pair has another rank by now.
        """
        get, n = self.merge.get, len(ids)
        token = list(ids)  # -1: taken in
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = sorted(m[0] * n + k for k, p in enumerate(zip(ids, ids[1:])) if (m := get(p)) is not None)
        while heap:
            rank, k = divmod(heappop(heap), n)
            right = after[k]
            if right >= n or (m := get((token[k], token[right]))) is None or m[0] != rank:
                continue
            made = token[k] = m[1]
            token[right] = -1
            far = after[k] = after[right]
            if far < n:
                before[far] = k
                if (m := get((made, token[far]))) is not None:
                    heappush(heap, m[0] * n + k)
            left = before[k]
            if left >= 0 and (m := get((token[left], made))) is not None:
                heappush(heap, m[0] * n + left)
        return [t for t in token if t >= 0]

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each merge (a, b); NONE where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves each pair of tokens apart when their strings stand together."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        # the merges that made what has been taken apart: a seam merge of less rank would have come first
        limit_a, limit_b = np.full(len(a), NONE), np.full(len(a), NONE)
        while len(live):
            x, y = a[live], b[live]
            seam = self.ranks_of(x, y)
            # left of the seam an equal rank would come first too, being further left; a right part merged at the same rank comes later
            fails = (seam < limit_a[live]) & (seam <= limit_b[live]) & (seam < NONE)
            good[live[fails]] = False
            rx, ry = self.rank[x], self.rank[y]
            stop = fails | ((rx < 0) & (ry < 0))
            live, x, y, rx, ry = live[~stop], x[~stop], y[~stop], rx[~stop], ry[~stop]
            by_left = rx >= ry
            i, j = live[by_left], live[~by_left]
            limit_a[i], a[i] = rx[by_left], self.right[x[by_left]]
            limit_b[j], b[j] = ry[~by_left], self.left[y[~by_left]]
        return good


class Codec:
    """Encodes words of one vocabulary; counts how many were proposed right and how many merged exactly."""

    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    BLANKS = regex.compile(r"\s+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # for normal forms and pieces of text beyond Latin letters
        self.v = Vocabulary(path)
        #: Ids and token strings of each chunk; silent: some chunk has none.
        self.ids: dict[bytes, bytes] = {}
        self.shown: dict[bytes, str] = {}
        self.silent = False
        self.word_ids: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.proposed = self.merged = 0
        self.to_letters = {b: x for b, x in enumerate(self.v.letters) if chr(b) != x}
        n = len(self.v.end)
        #: Proposable tokens that end a word, without the end; and the most characters of a token by its first four.
        self.ends = {s[:-n]: i for s, i in self.v.proposable.items() if n and s.endswith(self.v.end) and len(s) > n} or dict(self.v.proposable)
        self.reach: dict[str, int] = {}
        for s in [*self.v.proposable, *self.ends]:
            body = s[:-n] if n and s.endswith(self.v.end) and len(s) > n else s
            self.reach[body[:4]] = max(self.reach.get(body[:4], 0), len(body), 3)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.v.special, key=len, reverse=True)) or r"(?!)")

    def words(self, text: str) -> list[str]:
        """Pieces of a text without special tokens: normal form C, lower case, split, bytes as letters."""
        if text.isascii():
            lowered = text.lower()
            if lowered.isalpha():
                return [lowered]
            pieces = self.PIECES.findall(lowered)
            return pieces if lowered.isprintable() else [w.translate(self.to_letters) for w in pieces]
        if max(text) > LATIN:  # by the library, whose tables of letters may be older than Python's
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        lowered = unicodedata.normalize("NFC", text).lower()
        pieces = [lowered] if lowered.isalpha() else self.PIECES.findall(lowered)
        return [w.encode().decode("latin-1").translate(self.to_letters) for w in pieces]

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match; the last token carries the word end. None where nothing fits."""
        out, at, n = [], 0, len(word)
        get, ends, reach = self.v.proposable.get, self.ends.get, self.reach.get
        while at < n:
            to = at + reach(word[at : at + 4], 3)
            if to >= n:
                if (i := ends(word[at:])) is not None:
                    out.append(i)
                    break
                to = n - 1
            while to > at:
                if (i := get(word[at:to])) is not None:
                    break
                to -= 1
            else:
                return None
            out.append(i)
            at = to
        return out

    def encode_words(self, words: list[str]) -> None:
        """Puts the ids of new words into ``word_ids``."""
        proposals = {w: self.propose(w) for w in words}
        if len(self.pairs) > MOST:
            self.pairs.clear()
        pairs = self.pairs
        new = list({p for x in proposals.values() if x for p in zip(x, x[1:]) if p not in pairs})
        if new:
            two = np.array(new, np.int64)
            pairs.update(zip(new, self.v.compatible(two[:, 0], two[:, 1]).tolist()))
        for w, x in proposals.items():
            if x is not None and (len(x) == 1 or all(map(pairs.__getitem__, zip(x, x[1:])))):
                self.proposed += 1
                self.word_ids[w] = x
            else:
                self.merged += 1
                self.word_ids[w] = self.v.exact([*[self.v.ids[c] for c in w[:-1]], self.v.ids[w[-1] + self.v.end]])

    def _learn(self, chunks: list[bytes]) -> None:
        """Chunks are runs without ASCII white space; each has its ids and token strings from then on."""
        parts = {}
        for c in chunks:
            text = c.decode()
            found, at = [], 0
            for m in self.specials.finditer(text) if "<|" in text else ():
                found += [*self.words(text[at : m.start()]), self.v.special[m[0]]]
                at = m.end()
            parts[c] = found + self.words(text[at:])
        if len(self.word_ids) > MOST:
            self.word_ids.clear()
        ids_of, strings = self.word_ids, self.v.strings
        self.encode_words([w for w in dict.fromkeys(w for x in parts.values() for w in x) if w.__class__ is str and w not in ids_of])
        for c, x in parts.items():
            ids = ids_of[x[0]] if len(x) == 1 and x[0].__class__ is str else [i for w in x for i in (ids_of[w] if w.__class__ is str else [w])]
            self.ids[c], self.shown[c] = array("I", ids).tobytes(), " ".join(map(strings.__getitem__, ids))
            self.silent = self.silent or not ids

    def _know(self, own: set[bytes]) -> None:
        """All chunks of own are known afterwards; a full memory keeps those alone."""
        if len(self.ids) > MOST:
            self.ids = {x: self.ids[x] for x in own if x in self.ids}
            self.shown = {x: self.shown[x] for x in own if x in self.shown}
        if new := own.difference(self.ids):
            self._learn(list(new))

    def _joined(self, chunks: list[bytes]) -> tuple[bytes, str]:
        strings = map(self.shown.__getitem__, chunks)
        return b"".join(map(self.ids.__getitem__, chunks)), " ".join(filter(None, strings) if self.silent else strings)

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        split = [plain_chunks(t) for t in texts]
        out: list[tuple[bytes, str]] = []
        i = 0
        while i < len(split):
            held, to = 0, i
            while to < len(split) and (to == i or held + len(split[to]) <= MOST):
                held += len(split[to])
                to += 1
            if to == i + 1 and held > MOST:  # a text of more chunks than the memory has: by parts
                got = []
                for at in range(0, held, MOST):
                    part = split[i][at : at + MOST]
                    self._know(set(part))
                    got.append(self._joined(part))
                out.append((b"".join(x[0] for x in got), " ".join(x[1] for x in got if x[1])))
            else:
                self._know(set().union(*split[i:to]))
                out += map(self._joined, split[i:to])
            i = to
        return out

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.v.strings[i] for i in ids)


#: The codec of each vocabulary in this process; a Python worker keeps it from task to task.
_made: dict[str, Codec] = {}


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """A row per document: the id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, ids and decoded themselves."""
    fields = [T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _made.get(path) or _made.setdefault(path, Codec(path))
        for batch in slices(batches):
            got = codec.encode(texts_of(batch.column(1)))
            columns = [
                batch.column(0), pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i, _ in got]), pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in got]),
            ]
            if with_ids:
                columns += [pa.array([i for i, _ in got], pa.binary()), pa.array([s for _, s in got])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(doc_id, text).mapInArrow(run, T.StructType(fields))
