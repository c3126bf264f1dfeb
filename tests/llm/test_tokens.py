"""Token ids by chunks against the tokenizers library."""

import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("most", [tokens.MOST, 7])
def test_ids_of_odd_texts(monkeypatch, most):
    monkeypatch.setattr(tokens, "MOST", most)
    library, encode = Tokenizer.from_file(PATH), tokens.Encoder(PATH, spaced=False)
    rng = random.Random(2)
    alphabet = [*"abcABC019'’s \n\t\x0b\x0c\r\x1c.,;:!?*#$%&|<>_-\"()éÉñß中 İǅ", "'s", "'ll", "don't", *[t.content for t in library.get_added_tokens_decoder().values()][:2]]
    texts = ["", " ", "  a ", "a'", "word***", "it's|a<b", "a<|b", "x" * 3000, *["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]]
    for i in range(0, len(texts), 500):
        part = texts[i : i + 500]
        assert encode([t.encode() for t in part]) == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in part]
    assert encode([]) == []


def test_a_word_is_known_once_whatever_sign_follows():
    encode = tokens.Encoder(PATH, spaced=False)
    encode([b"word*** word### Word, word"])
    assert set(encode.known) - {b""} == {b"word", b"***", b"###", b","}
