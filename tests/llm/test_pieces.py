"""Ids and texts against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerloom.llm import pieces
from ledgerloom.llm.common import read

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = ("aaab'sStTrRe<|>.,!? \t\n\x00\x1c\x1f\x85\xa0é́ΣσςİIıß日本\U0001f600​　ñ01²"
           "▁▁  the")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PATH)


def same(library, codec, texts):
    for text, coded in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(coded, "<i4")
        want = library.encode(text, add_eos=True)
        assert ids.tolist() == want, text
        assert codec.decode(ids) == library.decode(want)


def test_odd_texts(library, vocabulary):
    rng = random.Random(3)
    codec = pieces.Codec(vocabulary)
    same(library, codec, ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(50)))
                          for _ in range(3000)])
    same(library, codec, ["", " ", "  ", "\n", "▁", "a" * 3000, " " * 2001, "<s></s><unk><0x41>"])


def test_one_agenda_for_a_whole_text_gives_the_same(library, vocabulary):
    rng = random.Random(4)
    codec = pieces.Codec(vocabulary)
    codec.words = None
    same(library, codec, ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60)))
                          for _ in range(500)])


class Small:
    """A vocabulary without a model."""

    def __init__(self, costs, letters):
        self.names = [*letters, *costs]
        self.ids = {p: i for i, p in enumerate(self.names)}
        self.costs = dict.fromkeys(letters, 99.0) | costs


def test_best_score_first_and_ties_from_the_left():
    v = Small({"ab": 3.0, "bc": 1.0, "abc": 5.0, "aa": 2.0, "aaaa": 2.0}, "ac")
    agendas = pieces.Agendas(v)

    def both(text):
        flat, ends = agendas.merge([text])
        found = pieces.merged(text, v.costs)
        assert ends.tolist() == [len(found)] and [
            v.names[i] for i in flat.tolist() if i < len(v.names)] == [
            p for p in found if p in v.ids]
        return found

    assert both("abc") == ["abc"]      # bc first, then a + bc
    assert both("abca") == ["abc", "a"]
    assert both("aaa") == ["aa", "a"]
    assert both("aaaaa") == ["aaaa", "a"]
    assert both("bbzb") == ["b", "b", "z", "b"]   # b is a letter of pieces, z of none
    assert both("a") == ["a"] and pieces.merged("", v.costs) == []
    rng = random.Random(6)
    words = ["".join(rng.choice("aaabcz") for _ in range(rng.randrange(1, 49)))
             for _ in range(400)]
    for w in words:
        both(w)
    flat, ends = agendas.merge(words)
    assert np.diff(np.r_[0, ends]).tolist() == [len(pieces.merged(w, v.costs)) for w in words]


def test_words_are_forgotten_and_met_again(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "LONG_WORD", 4)
    codec = pieces.Codec(vocabulary)
    same(library, codec, ["one two three four five", "six one, seven (eight) one", "one"] * 2)


def test_any_ids_decode_like_the_library(library, vocabulary):
    rng = random.Random(5)
    codec = pieces.Codec(vocabulary)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), rng.randrange(259, 300)])
               for _ in range(rng.randrange(7))]
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_given_table(spark, library, vocabulary):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = pieces.encode_decode(docs, vocabulary, check="agrees").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_eos=True)
        assert r.decoded == library.decode(r.ids) and r.agrees


def test_awkward_rows(hard, nothing, library, vocabulary):
    rows = pieces.encode_decode(hard, vocabulary).collect()
    assert len(rows) == 12 and set(hard.columns) - {"ids"} < set(rows[0].asDict())
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_eos=True)
        assert r.decoded == library.decode(r.ids)
    assert pieces.encode_decode(nothing, vocabulary, check="ok").count() == 0


def test_the_check_sees_a_difference(vocabulary):
    codec = pieces.Codec(vocabulary, checks=True)
    texts = ["one  two\nthree", "four one", "", " ", "five"]
    codec.encode(texts)
    assert codec.unchecked
    codec.check()
    assert not codec.unchecked and all(map(codec.agrees, texts))
    ids = codec.known.pop("▁five")
    codec.agendas.merge = lambda words: (np.frombuffer(ids * 2, "<i4").astype(np.int32),
                                         np.array([len(ids) // 2]))
    codec.encode(texts)
    codec.check()
    assert [codec.agrees(t) for t in texts] == [True, True, True, True, False]
