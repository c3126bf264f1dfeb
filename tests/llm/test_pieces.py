"""The piece codec against the sentencepiece library."""

import hashlib
import random
import time

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import pieces, queries

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(PATH)


def check(codec, library, texts):
    for text, (ids, shown) in zip(texts, codec.encode(texts), strict=True):
        want = library.encode(text)
        assert ids.decode() == ",".join(map(str, want)), text[:200]
        assert shown == library.decode(want) == codec.pieces.decode(want), text[:200]


def test_texts_of_all_kinds(codec, library):
    rng = random.Random(7)
    known = [s for s in codec.pieces.strings if s]
    texts = []
    for _ in range(1500):
        texts.append("".join(rng.choice("ab \n.") for _ in range(rng.randint(0, 30))))
        texts.append("".join(rng.choice(known) for _ in range(rng.randint(0, 8))))
        texts.append("".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0x3000, 0x9FFF), rng.randint(0x1F300, 0x1F700), 0x2581, 32])) for _ in range(20)))
        texts.append(" " * rng.randint(0, 60) + rng.choice(["", "x", " \n  "]) + " " * rng.randint(0, 40))
        texts.append("".join(rng.choice(["the", "ing", "é", "  ", ".", ",", "__", "²", "1", "\t", "<s>", "<0x0A>"]) for _ in range(rng.randint(0, 20))))
    check(codec, library, texts)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(*_both(), [text])


def _both(made=[]):
    if not made:
        made += [pieces.Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)]
    return made


def test_decoding_of_any_ids(codec, library):
    rng = random.Random(3)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(3, 258), rng.randint(259, 31_999), rng.randint(0, 2)]) for _ in range(rng.randint(0, 12))]
        assert codec.pieces.decode(ids) == library.decode(ids), ids


def test_one_last_token_for_each_prefix(codec, library):
    """The table of a string holds the last token of the split of each of its prefixes."""
    for word in ("internationalisation", "▁▁▁▁▁unbelievably", "acgtacgtacg"):
        for n in range(1, len(word) + 1):
            got = codec.pieces.tokens(word[:n])
            assert [library.id_to_piece(i) for i in got] == _merged(word[:n], codec.pieces), word[:n]


def _merged(word, p):
    at = list(word)
    while True:
        best = min(((p.score[p.ids[x + y]], k) for k, (x, y) in enumerate(zip(at, at[1:])) if x + y in p.ids), default=None)
        if best is None:
            return at
        at[best[1] : best[1] + 2] = [at[best[1]] + at[best[1] + 1]]


def test_long_words_take_linear_time(codec, library):
    for text in ("acgt" * 250_000, "a" * 300_000, " " * 300_000, "é日" * 100_000):
        start = time.time()
        (ids, shown), = codec.encode([text])
        assert time.time() - start < 20
        assert ids.decode() == ",".join(map(str, library.encode(text))) and shown == text


def test_more_chunks_than_the_memory_has(library, monkeypatch):
    monkeypatch.setattr(pieces, "MOST", 50)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 80))) for _ in range(rng.randint(0, 300))) for _ in range(20)]
    check(pieces.Codec(PATH), library, texts)


ROWS = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (3, "a"), (None, "a b"), (4, "Σας ▁ don't İ 日本語 é́ x <s>"), (5, "word " * 60_000), (6, "z" * 50_000)]


def test_frames(spark, library):
    schema = "doc_id long, text string, n_tokens string, ids int, decoded double"
    docs = spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in ROWS], schema)
    got = sorted(map(tuple, pieces.encode(docs, PATH).collect()), key=repr)
    want = []
    for i, text in ROWS:
        ids = library.encode(text or "")
        shown = library.decode(ids)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest(), ids, shown))
    assert got == sorted(want, key=repr)
    assert pieces.encode(docs.limit(0), PATH).collect() == []


def test_query(spark, sf, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op11_piece_codec"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
