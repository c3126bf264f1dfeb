"""SentencePiece BPE encoding by a table of prefixes, and decoding.

The BPE split of each prefix of a string ends in one token, and a token can follow the
split of a shorter prefix exactly when BPE leaves the two tokens apart where their
strings stand together. So one pass of an Aho-Corasick automaton over the string finds,
at each place, the one token among those that end there which fits the last token of
the prefix before it; the ids are then read off backwards from the end of the table.
Whether two tokens fit is found by taking both apart along the seam, the one merged
later first: they do not, where a merge across the seam would have come before a merge
that built its sides.

A merge of this kind of model is any two neighbours whose string is a piece, the best
score first, then the leftmost; a piece is made in one way, so its parts are those of
its own string. Pieces that BPE does not make of their own string never occur.

Texts are cut where no piece reaches across, and a task remembers a bounded number of
chunks. Encoding is row-local, without shuffle, and linear in a text's length, whatever
the length of its words.

Defined results: null text is empty and has no tokens; control pieces that stand in a
text are ordinary text; characters that the model lacks become byte pieces; equal texts,
repeated rows among them, get equal results; a very long text is encoded chunk by chunk,
a very long chunk by one table; an empty table gives no rows; columns other than the id
and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.common import slices, texts_of

#: The character that stands for a space in a piece, a fixed value of the format.
BLANK = "▁"
#: Chunks that a task remembers, and pairs of tokens.
MOST = 400_000
MOST_PAIRS = 2_000_000
#: Longer chunks are not remembered.
LONGEST = 64
#: No rank.
NONE = 1 << 40
#: Types of pieces that have an influence on the split of a text; the others are control pieces. Fixed values of the format.
NORMAL, UNKNOWN, USER_DEFINED, UNUSED, BYTE = 1, 2, 4, 5, 6
#: Letters and digits, and the signs behind which a chunk may begin.
WORD, SIGNS = "A-Za-z0-9À-ÖØ-öø-ÿ", ".,;:!?"


class Pieces:
    """The pieces of one model: the merge that makes each, and which of them fit together."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            data = f.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(data)
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.model_type != train.BPE or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("this is for BPE models without user-defined or unused pieces")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        #: Only a space is put before a text and no space is taken away.
        self.plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not train.treat_whitespace_as_suffix
        self.strips = norm.remove_extra_whitespaces
        self.drops_first = norm.add_dummy_prefix or norm.remove_extra_whitespaces
        self.strings = [p.piece for p in model.pieces]
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.byte_of[i] = int(p.piece[3:5], 16)
        self.silent = {i for i, p in enumerate(model.pieces) if p.type not in (NORMAL, UNKNOWN, BYTE)}
        self.plain_texts = {i: p.piece.replace(BLANK, " ") for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_shown = train.unk_surface
        self.falls_back = train.byte_fallback
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        places = {s: r for r, s in enumerate(sorted({model.pieces[i].score for i in self.ids.values()}, reverse=True))}
        #: The place of a piece among scores, the best first; single characters are not merged.
        self.score = {i: places[model.pieces[i].score] for i in self.ids.values()}
        size = len(self.strings)
        self.rank, self.left, self.right, self.length = [-1] * size, [-1] * size, [-1] * size, [len(s) for s in self.strings]
        self.merges: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for s, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            parts = self._parts(s)
            if parts is None:
                continue
            self.automaton.add_word(s, i)
            if len(s) > 1:
                self.left[i], self.right[i] = parts
                self.rank[i] = self.score[i]
                self.merges[parts[0] << 20 | parts[1]] = self.rank[i]
                if max(self.rank[parts[0]], self.rank[parts[1]]) > self.rank[i]:
                    raise ValueError("a piece of this model is merged before its parts")
        self.automaton.make_automaton()
        self.chars = {s for s in self.ids if len(s) == 1}
        self.pairs: dict[int, bool] = {}
        #: A space begins a chunk, for no piece has one behind another character; so do signs behind a word, and newlines apart, where no piece joins them.
        inside = {s[k : k + 2] for s in self.ids for k in range(len(s) - 1)}
        word, apart = re.compile(f"[{WORD}]"), "\n" if not any("\n" in x for x in inside) else ""
        self.chunk = re.compile(f" *+[{WORD}]++(?=[{SIGNS}])| *+[^ {apart}]++" + (f"|{apart}" if apart else "") + "| +")
        if any(word.match(x[0]) and x[1] in SIGNS for x in inside):
            self.chunk = re.compile(f" *+[^ {apart}]++" + (f"|{apart}" if apart else "") + "| +")
        if any(x[1] == BLANK and x[0] != BLANK for x in inside):
            self.chunk = re.compile(r"[\s\S]+")

    def _parts(self, s: str) -> tuple[int, int] | None:
        """The two pieces of the last merge that makes s of its characters; None if BPE makes no single piece of it."""
        at, ids, score = list(s), self.ids, self.score
        parts = (-1, -1)
        while len(at) > 1:
            best = min(((score[ids[x + y]], k) for k, (x, y) in enumerate(zip(at, at[1:])) if x + y in ids), default=None)
            if best is None:
                return None
            k = best[1]
            parts = ids.get(at[k], -1), ids.get(at[k + 1], -1)
            at[k : k + 2] = [at[k] + at[k + 1]]
        return parts if min(parts) >= 0 or len(s) == 1 else None

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b apart where b follows a."""
        rank, merge = self.rank, self.merges.get
        limit_a = limit_b = NONE
        while True:
            seam = merge(a << 20 | b, NONE)
            # at one rank the left merge comes first: a merge left of the seam before it, one right of it after it
            if seam < limit_a and seam <= limit_b:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit_a, a = ra, self.right[a]
            else:
                limit_b, b = rb, self.left[b]

    def tokens(self, s: str) -> list[int]:
        """Ids of a string of known characters, by the table of the last token of each prefix."""
        last, length, pairs = [-1] * (len(s) + 1), self.length, self.pairs
        for end, i in self.automaton.iter(s):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[i]
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 20 | i
                fit = pairs.get(key)
                if fit is None:
                    fit = pairs[key] = self.fits(before, i)
                if not fit:
                    continue
            last[end] = i
        if len(pairs) > MOST_PAIRS:
            pairs.clear()
        out, at = [], len(s)
        while at:
            i = last[at]
            out.append(i)
            at -= length[i]
        out.reverse()
        return out

    def split(self, chunk: str) -> list[int]:
        """Ids of a chunk, its spaces as themselves."""
        s = chunk.replace(" ", BLANK)
        strange = set(s) - self.chars
        if not strange:
            return self.tokens(s)
        out: list[int] = []
        for part in re.split("([" + re.escape("".join(sorted(strange))) + "]+)", s):
            if part and part[0] in strange:
                out += [self.byte_ids[b] for b in part.encode()] if self.falls_back else [self.unknown]
            elif part:
                out += self.tokens(part)
        return out

    def shown(self, ids: list[int]) -> str:
        """The text of ids, spaces in front kept; bytes that are no UTF-8 are U+FFFD each."""
        try:
            return "".join(map(self.plain_texts.__getitem__, ids))
        except KeyError:  # some id is a byte, unknown or a control piece
            pass
        out: list[str] = []
        held = bytearray()

        def flush() -> None:
            data, at = bytes(held), 0
            while at < len(data):
                n = next((n for n in (1, 2, 3, 4) if _utf8(data[at : at + n])), 0)
                out.append(data[at : at + n].decode() if n else "�")
                at += n or 1
            held.clear()

        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                flush()
            if i == self.unknown:
                out.append(self.unknown_shown)
            elif i not in self.silent:
                out.append(self.plain_texts[i])
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts first; only a piece of characters gives up its own."""
        text, first = self.shown(ids), next((i for i in ids if i not in self.silent), self.unknown)
        if first not in self.plain_texts:
            return text
        return text.lstrip(" ") if self.strips else text.removeprefix(" ") if self.drops_first else text


def _utf8(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


class Codec:
    """Encodes and decodes texts by chunks, each found once while the memory holds it.

    The memory has two generations of at most MOST chunks each, and those of one part of a text.
    """

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        #: (decimal ids joined by commas, their text) of each chunk.
        self.known: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        p = self.pieces
        # a character that stands for a space is one to the model
        return p.chunk.findall(" " + text.replace(BLANK, " ") if p.plain else p.library.normalize(text).replace(BLANK, " "))

    def _know(self, own: set[str]) -> dict[str, tuple[bytes, str]]:
        """All chunks of own are in ``known`` afterwards, but for long ones, which are returned. A full memory becomes the old one, and what is asked for again comes back."""
        if len(self.known) > MOST:
            self.known, self.old = {}, self.known
        p, old, known, long = self.pieces, self.old.get, self.known, {}
        for c in own.difference(known):
            if (got := old(c)) is None:
                ids = p.split(c)
                shown = p.shown(ids)
                got = ",".join(map(str, ids)).encode(), c if shown == c else shown  # one string, not two
            (known if len(c) <= LONGEST else long)[c] = got
        return long

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(decimal ids joined by commas, decoded text) of each text."""
        out: list[tuple[bytes, str]] = []
        for text in texts:
            chunks, got = self.chunks(text), []
            for at in range(0, len(chunks), MOST):  # a text of more chunks than the memory has goes by parts
                part = chunks[at : at + MOST]
                long = self._know(set(part))
                pairs = [self.known.get(c) or long[c] for c in part] if long else list(map(self.known.__getitem__, part))
                got.append((b",".join([x[0] for x in pairs]), "".join([x[1] for x in pairs])))
            ids, shown = (got[0] if len(got) == 1 else (b",".join(x[0] for x in got), "".join(x[1] for x in got)))
            out.append((ids, shown.lstrip(" ") if self.pieces.strips else shown.removeprefix(" ") if self.pieces.drops_first else shown))
        return out


#: The codec of each model in this process; a Python worker keeps it from task to task.
_made: dict[str, Codec] = {}


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """A row per document: the id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, ids (an array) and decoded themselves."""
    fields = [T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _made.get(path) or _made.setdefault(path, Codec(path))
        for batch in slices(batches):
            got = codec.encode([t.decode() for t in texts_of(batch.column(1))])
            columns = [
                batch.column(0), pa.array([i.count(b",") + 1 if i else 0 for i, _ in got], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i, _ in got], pa.string()), pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in got], pa.string()),
            ]
            if with_ids:
                columns += [pa.array([[int(x) for x in i.split(b",")] if i else [] for i, _ in got], pa.list_(pa.int32())), pa.array([s for _, s in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(doc_id, text).mapInArrow(run, T.StructType(fields))
