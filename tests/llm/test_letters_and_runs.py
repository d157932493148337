"""Letters of language ID, many languages, and words handed to the tokenizer in runs."""

from __future__ import annotations

from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallywood.llm import byte_bpe, language_spans, wavelet_shards
from tallywood.llm.language_spans import LanguageModel, Labeller, UNDETERMINED, viterbi
from tallywood.llm.word_memory import WordMemory


@pytest.fixture(scope="module")
def two_languages():
    words = {"aa": "river stone morning", "bb": "fluss stein morgen"}
    codes, counts = [], []
    for lang in words:
        found, times = np.unique(language_spans._triples(words[lang].split())[0], return_counts=True)
        codes.append(found)
        counts.append(times)
    every = np.unique(np.concatenate(codes))
    table = np.zeros((len(every), 2))
    for k in range(2):
        table[np.searchsorted(every, codes[k]), k] = counts[k]
    totals = table.sum(axis=0) + 0.5 * (len(every) + 1)
    candidates = np.ones((len(language_spans._NAMES) + 1, 2), bool)
    return LanguageModel(["aa", "bb"], every, np.log((table + 0.5) / totals), np.log(0.5 / totals), candidates)


@pytest.mark.parametrize("text", [None, "", "½", "Ⅷ", "①", "², ³ and".replace(" and", ""), "12 ¾ ⅻ _ --"])
def test_texts_without_letters_are_undetermined(two_languages, text):
    # The second text has letters, so that the batch as a whole is labelled.
    found = list(Labeller(two_languages, 10.0).label([text, "river"]))
    assert found[0] == (UNDETERMINED, 0.0, None)
    assert found[1][0] == "aa"


def test_word_scores_are_sums_over_triples(two_languages):
    words = ["river", "morgen", "x", "stones"]
    known = dict(zip(two_languages.codes.tolist(), two_languages.scores, strict=True))
    for word, row in zip(words, two_languages.word_scores(words), strict=True):
        padded = f"\2{word}\3"
        expected = np.zeros(2)
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            expected += known.get(ord(a) << 42 | ord(b) << 21 | ord(c), two_languages.unseen)
        np.testing.assert_allclose(row, expected)


def test_more_languages_than_a_signed_byte_holds():
    scores = np.full((5, 300), -10.0)
    scores[:4, 290] = 0.0
    scores[4, 7] = 0.0
    assert viterbi(scores, np.array([4, 1]), 10.0).tolist() == [290] * 4 + [7]


def test_runs_give_the_ids_of_single_strings():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        shared = type("Shared", (), {"value": file.read()})
    memory, _ = wavelet_shards._encoder("runs of a test", shared, False)
    odd = [" a", "b", " it's", " 12ab", " é", " 漢字", " <|endoftext|>", " x<|endoftext|>y", " 's", " \U0001f600!", "", " ..."]
    strings = [w + str(i) if i % 3 else w for i in range(700) for w in odd]
    found = memory.encode(strings)
    assert found == [array("H", tokenizer.encode(s, add_special_tokens=False).ids).tobytes() for s in strings]


def test_runs_with_a_border_inside_a_token_are_encoded_one_by_one():
    asked = []

    def encode(strings):
        # A tokenizer that merges "a b" across the space: three letters, one token.
        asked.extend(strings)
        return [np.array([0] if s == " a b" else [1] * len(s), np.uint16).tobytes() for s in strings]

    ids = wavelet_shards._in_runs(encode, np.array([4, 1]), np.uint16)
    assert [np.frombuffer(raw, np.uint16).tolist() for raw in ids([" a", " b"])] == [[1, 1], [1, 1]]
    assert asked == [" a b", " a", " b"]


def test_words_whose_hashed_tokens_do_not_spell_them_are_encoded_anew(monkeypatch):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    bpe = byte_bpe.PrefixBpe(ranks, public_tokenizers.PATTERN)
    many = byte_bpe.ManyWords(bpe)
    words = [b"qzxv", b"morningstone", b" riverbank"]
    expected = [bpe.encode_piece(w) for w in words]
    plain = [bpe.tokens(bpe.prefixes(w)) for w in words]
    assert many.encode(words) == plain
    # Every token found stands for another one of the same length, as a collision would have it.
    right = many._encode
    monkeypatch.setattr(many, "_encode", lambda w, s: [[bpe.ranks[b"a"]] * len(x) for x in right(w, s)])
    assert many.encode(words) == expected


ODD_TEXTS = [
    None, "", " ", "a", " a", "a ", "a  b", "a b a b", "a\tb c", "a \tb", "a\u2003 b", "\na b", "é 漢字 é", "it's 12 ab's <|endoftext|> x",
    "a b<|endoftext|>c d", "one two " * 40, "x" * 100 + " y " + "x" * 100, "\x1c a", "a\u00a0 b a", " ".join(f"w{i} é{i}" for i in range(900)),
]


@pytest.mark.parametrize("remembered", [1, 20, 5000])
@pytest.mark.parametrize("slice_size", [1, 200, 2_000_000])
def test_words_of_a_slice_make_up_the_ids_of_the_library(remembered, slice_size):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        shared = type("Shared", (), {"value": file.read()})
    memory, _ = wavelet_shards._encoder(f"slices of a test {remembered} {slice_size}", shared, False)
    memory.remembered, memory.together = remembered, slice_size
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD_TEXTS]
    for order in ODD_TEXTS, ODD_TEXTS[::-1], ODD_TEXTS:
        found = [ids.tolist() for ids in memory.ids(pa.array(order, pa.string()))]
        assert found == (expected if order[0] is None else expected[::-1])
        assert all(len(word) <= WordMemory.LONGEST for word in memory.words.to_pylist())


def test_words_are_looked_up_once_in_a_slice_and_kept_in_arrays():
    handed = []

    def words(found):
        handed.extend(found.to_pylist())
        return np.arange(len(found), dtype=np.uint16), np.ones(len(found), np.int64)

    memory = WordMemory(lambda strings: [np.array([9], np.uint16).tobytes()] * len(strings), np.uint16, 100_000, words)
    texts = pa.array([f"first {' '.join(f'word{i}' for i in range(60_000))} word7"] * 3)
    for _ in range(2):
        assert [ids[-1] for ids in memory.ids(texts)] == [7] * 3
    assert handed == [f"word{i}" for i in range(60_000)]
    kept = memory.words.nbytes + memory.ids_of_words.nbytes + memory.counts.nbytes + memory.again.nbytes
    assert kept < 3_000_000 and not any(isinstance(value, (dict, list, set)) for value in vars(memory).values())


def test_batches_are_put_together_by_the_bytes_of_their_texts():
    batches = [(pa.array([i]), pa.array(["x" * 60 if i else None], pa.string())) for i in range(5)]
    found = list(wavelet_shards._together(iter(batches), 100))
    assert [ids.to_pylist() for ids, _ in found] == [[0, 1, 2], [3, 4]]
    assert list(wavelet_shards._together(iter([]))) == []


def test_bpe_of_arrays_and_lists_of_texts():
    bpe = byte_bpe.PrefixBpe(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    encoder, expected = byte_bpe.TextEncoder(bpe), [bpe.encode(t) for t in ODD_TEXTS]
    assert list(encoder.encode(ODD_TEXTS)) == expected
    assert list(encoder.encode(pa.array(["skipped", *ODD_TEXTS])[1:])) == expected
    assert list(encoder.encode([None])) == [[]] and list(encoder.encode([])) == []
