"""Ids and texts against the tokenizers library; the automaton against a dictionary."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe
from ledgerloom.llm.common import read

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = ("aaab'sStTrRe<|>.,!? \t\n\x1c\x1f\x85\xa0é́ΣσςİIıß日本\U0001f600​　ñ0123½²"
           "ⅷ_-'vemlldd")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, texts, words):
    encoder = bpe.Encoder(bpe.Codec(PATH).with_lexicon(words))
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("words", [[], ["the", "and", "é", "aaa", "'s", "日本"]])
def test_odd_texts(library, words):
    rng = random.Random(2)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(800)]
    same(library, texts + ["<|endoftext|>a<|startoftext|> <|endoftext|>", "", " ", "a" * 99], words)


def test_given_table(spark, library):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    words = bpe.frequent_words(docs, words=500)
    assert len(words) == 500
    coded = bpe.encode_decode(docs, bpe.Codec(PATH).with_lexicon(words)).collect()
    for r in coded:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_automaton_numbers_words_and_shares_suffixes():
    words = sorted({f"{a}{b}{c}".encode() for a in "abc" for b in ("", "x", "yy") for c in
                    ("ing", "ed", "")})
    auto = bpe.Automaton.build(words)
    assert auto.rank(words).tolist() == list(range(len(words)))
    assert (auto.rank([b"", b"a" * 9, b"abing", b"in", "é".encode()]) == -1).all()
    assert len(auto.final) < sum(map(len, words)) / 4
    assert bpe.Automaton.build([]).rank([b"a"]).tolist() == [-1]


def test_lexicon_file():
    codec = bpe.Codec(PATH).with_lexicon(["thing", "things", "zzzqx"])
    lexicon = bpe.Lexicon.mapped(codec.compiled)
    rank = lexicon.automaton.rank([b"things"])[0]
    ids = lexicon.ids[lexicon.offsets[rank]:lexicon.offsets[rank + 1]]
    assert ids.tolist() == bpe.merge_array(codec.merges, ["things"]).flat.tolist()


def test_awkward_rows(hard, nothing, library):
    codec = bpe.Codec(PATH).with_lexicon(bpe.frequent_words(hard))
    rows = bpe.encode_decode(hard, codec).collect()
    assert len(rows) == 12
    for r in rows:
        assert len(r.ids) == 4 * len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert bpe.encode_decode(nothing, codec).count() == 0
    assert bpe.frequent_words(nothing) == []
