"""Token ids of whole texts by a tokenizer file, with a bounded memory of chunks.

A tokenizer that splits text at white space gives a text the ids of its chunks,
laid end to end. Most chunks of a corpus repeat, so a task encodes each new chunk
once by the library and looks the others up. The memory has two generations of at
most ``KEPT`` chunks each, and those of one slice of texts, whatever the input.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 150_000
#: Chunks of a generation of the memory.
KEPT = 250_000
#: New chunks that go to the library in one call.
TOGETHER = 250
#: Where a space follows a character that is not white space, a byte-level split always begins a new piece.
EDGE = re.compile(r"(?<=\S)(?= )")
AFTER_SPACE = re.compile(r"\s ")


#: A letter or digit before common punctuation, where a split at white space, letters, digits and other signs always cuts.
PUNCTUATED = re.compile(rb"([a-z0-9])(?=[.,;:!?])")


#: Letters that no step before the merges changes or splits, in files that lower case and split at other signs.
LETTERS = re.compile("[a-zß-öø-ÿ]+")


#: Bytes of lower-case letters and digits, and of the signs that a split cuts from them whatever follows; an apostrophe may begin a piece of its own.
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_SIGN_BYTES = np.zeros(256, bool)
_SIGN_BYTES[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True


def plain_chunks(text: bytes) -> list[bytes]:
    """Chunks for a tokenizer that drops white space and lowers case: punctuation apart from words, ASCII in lower case.

    Special tokens are lower case, so a text that may have one is left as it is.
    """
    return PUNCTUATED.sub(rb"\1 ", text if b"<|" in text else text.lower()).split()


def _spread(text: bytes) -> bytes:
    """The text with blanks between the chunks of plain_chunks, and before other signs behind a word; for special tokens' sake only where there is none."""
    if b"<|" in text:
        return PUNCTUATED.sub(rb"\1 ", text)
    data = np.frombuffer(text.lower(), np.uint8)
    at = np.flatnonzero(_WORD_BYTES[data[:-1]] & _SIGN_BYTES[data[1:]]) + 1
    return np.insert(data, at, 32).tobytes()


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, as the library encodes without special tokens added.

    spaced: the tokenizer keeps white space (byte-level); chunks then carry the space
    before them. Otherwise white space only separates and is dropped.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = spaced
        normalizer = json.loads(self.tokenizer.to_str())["normalizer"]
        self.lowers = not spaced and "Lowercase" in json.dumps(normalizer)
        self.mark_id, token = next(iter(self.tokenizer.get_added_tokens_decoder().items()))
        self.mark = token.content
        self.known: dict = {}
        self.old: dict = {}
        self.words = self._word_tokenizer() if self.lowers else None

    def _word_tokenizer(self):
        """(tokenizer, which ids end a word) for words of LETTERS with blanks between: the same merges without the steps before them; null
        for a file whose tokens do not tell the end of a word, or where a sample differs."""
        from tokenizers import Tokenizer

        file = json.loads(self.tokenizer.to_str())
        suffix = file["model"].get("end_of_word_suffix")
        if file["model"]["type"] != "BPE" or not suffix:
            return None
        file["normalizer"] = None
        file["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        ends = np.zeros(max(file["model"]["vocab"].values()) + 1, bool)
        ends[[i for w, i in file["model"]["vocab"].items() if w.endswith(suffix)]] = True
        made = Tokenizer.from_str(json.dumps(file))
        sample = "the übung l été straße niño x tokenisation zzzq".split()
        whole = [made.encode(" ".join(sample), add_special_tokens=False).ids, [i for w in sample for i in self.tokenizer.encode(w, add_special_tokens=False).ids]]
        return (made, ends) if whole[0] == whole[1] and ends[whole[0]].sum() == len(sample) else None

    def chunks(self, text: str | bytes) -> list:
        if not self.spaced:
            data = text if isinstance(text, bytes) else text.encode()
            return data.split()
        if AFTER_SPACE.search(text):
            return EDGE.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def _know(self, own: set) -> None:
        """All chunks of own are in ``known`` afterwards. A full memory becomes the old one, and what is asked for again comes back."""
        if len(self.known) > KEPT:
            self.known, self.old = {}, self.known
        lacking = own.difference(self.known)
        back = lacking.intersection(self.old)
        self.known.update(zip(back, map(self.old.__getitem__, back)))
        new = list(lacking.difference(back) if back else lacking)
        if b"" in lacking:  # where a text begins or ends with white space
            self.known[b""] = b""
            new = [x for x in new if x]
        texts = new if self.spaced else [x.decode() for x in new]
        if self.words:
            plain = [LETTERS.fullmatch(t) is not None for t in texts]
            own = [t for t, p in zip(texts, plain) if p]
            for i in range(0, len(own), TOGETHER):
                self._encode_words(own[i : i + TOGETHER])
            new, texts = [x for x, p in zip(new, plain) if not p], [t for t, p in zip(texts, plain) if not p]
        for i in range(0, len(new), TOGETHER):
            self._encode(new[i : i + TOGETHER], texts[i : i + TOGETHER])

    def _encode_words(self, words: list[str]) -> None:
        """One call for many words; the ids that end a word keep them apart."""
        made, ends = self.words
        ids = np.array(made.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = (np.flatnonzero(ends[ids]) + 1).tolist()
        if len(stops) != len(words):
            return self._encode([w.encode() for w in words], words)
        data = ids.tobytes()
        self.known.update((w.encode(), data[4 * s : 4 * e]) for w, s, e in zip(words, [0, *stops], stops))

    def _encode(self, chunks: list, texts: list[str]) -> None:
        """One call for many chunks: a special token between them keeps them apart."""
        joined = self.mark.join(texts)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(ids == self.mark_id)
        if len(at) == len(texts) - 1:
            starts, ends = [0, *(at + 1).tolist()], [*at.tolist(), len(ids)]
            data = ids.tobytes()
            self.known.update((c, data[4 * s : 4 * e]) for c, s, e in zip(chunks, starts, ends))
        else:  # the mark stands in a chunk
            for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                self.known[chunk] = array("I", e.ids).tobytes()

    def _by_chunk(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one chunk after another, how many each has): each distinct chunk is looked up once, its ids are laid by arrays."""
        coded = chunks.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        self._know(set(own))
        parts = list(map(self.known.__getitem__, own))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        index = coded.indices.to_numpy()
        n = sizes[index]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1])) + np.repeat((np.cumsum(sizes) - sizes)[index] - ends + n, n)
        return np.frombuffer(b"".join(parts), "<u4")[at], n

    def _together(self, texts: list[bytes]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(list(map(_spread, texts)), pa.large_binary()).cast(pa.large_string()))
        chunks = split.flatten().cast(pa.large_binary())
        got = [self._by_chunk(chunks.slice(i, MOST)) for i in range(0, len(chunks), MOST)]
        ids = np.concatenate([x for x, _ in got] or [np.zeros(0, "<u4")])
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *[n for _, n in got]]))[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def __call__(self, texts: list) -> list[bytes]:
        if self.lowers:
            return self._together([t if isinstance(t, bytes) else t.encode() for t in texts])
        split = [self.chunks(t) for t in texts]
        out: list[bytes] = []
        i = 0
        while i < len(split):
            held, to = 0, i
            while to < len(split) and (to == i or held + len(split[to]) <= MOST):
                held += len(split[to])
                to += 1
            if to == i + 1 and held > MOST:  # a text of more chunks than the memory has: by parts
                parts = []
                for at in range(0, held, MOST):
                    self._know(set(split[i][at : at + MOST]))
                    parts += map(self.known.__getitem__, split[i][at : at + MOST])
                out.append(b"".join(parts))
            else:
                self._know(set().union(*split[i:to]))
                get = self.known.__getitem__
                out += [b"".join(map(get, g)) for g in split[i:to]]
            i = to
        return out


_made: dict = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this process; a Python worker keeps it from task to task."""
    if (path, spaced) not in _made:
        _made[path, spaced] = Encoder(path, spaced)
    return _made[path, spaced]


class ByteEncoder:
    """Ids of a byte-level tokenizers file whose merges are in the order of their ids, as Encoder gives them.

    The merges run in tiktoken, several times as fast; tests hold its ids against the
    tokenizers library's. A text that it can't split is left to the library.
    """

    #: The split of byte-level files, a fixed value of the format.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        from sluice.llm.bpe import byte_letters

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        special = {x["content"]: x["id"] for x in file["added_tokens"]}
        ranks = {bytes(map(to_byte.__getitem__, s)): i for s, i in file["model"]["vocab"].items() if s not in special}
        made = [ranks[bytes(map(to_byte.__getitem__, "".join(m.split(" ") if isinstance(m, str) else m)))] for m in file["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("the merges of this file are not in the order of their ids")
        self.core = tiktoken.Encoding("own", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special, self.path = list(special), path

    def _one(self, text: str) -> bytes:
        try:
            return self.core.encode_to_numpy(text, allowed_special="all" if any(s in text for s in self.special) else set(), disallowed_special=()).tobytes()
        except ValueError:  # the split gave up, as on very long white space; the library does not
            return encoder(self.path, spaced=True)([text])[0]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) for t in texts]


def byte_encoder(path: str) -> ByteEncoder:
    if path not in _made:
        _made[path] = ByteEncoder(path)
    return _made[path]
