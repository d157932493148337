"""Operators against brute force, and their own interfaces."""

import collections
import itertools
import math
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as hypothesis_given
from hypothesis import settings
from hypothesis import strategies as st

from tallywood.llm import decontamination, language_spans, lm_difference, partenum, site_lines, toxicity, wavelet_shards
from tallywood.llm.byte_bpe import PrefixBpe, TextEncoder, read_ranks
from tallywood.llm.components import components
from tallywood.llm.quartile_digest import digests, likeness


@pytest.fixture(scope="module")
def bpe():
    return PrefixBpe(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def merged(ranks, data):
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == math.inf:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@settings(deadline=None, max_examples=60)
@hypothesis_given(st.text(alphabet="abeinst é汉h'\n1", max_size=40), st.integers(0, 40), st.integers(0, 40), st.text(alphabet="the an", max_size=6))
def test_prefixes(bpe, text, a, b, new):
    data = text.encode()
    known = bpe.prefixes(data)
    assert data in bpe.ranks or bpe.tokens(known) == merged(bpe.ranks, data)
    assert bpe.append(known, new.encode()).last == bpe.prefixes(data + new.encode()).last
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    assert bpe.edit(known, a, b, new.encode()).last == bpe.prefixes(data[:a] + new.encode() + data[b:]).last
    assert list(TextEncoder(bpe).encode([text, None])) == [bpe.encode(text), []]
    assert bpe.decode(bpe.encode(text)) == data


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for size, top in ((0, 5), (1, 1), (511, 9), (1500, 300)):
        ids = rng.integers(0, top, size)
        matrix = wavelet_shards.unpack(wavelet_shards.pack(ids, [4], [0, size], 9))[0]
        assert matrix.ids().tolist() == ids.tolist()
        assert [matrix.access(i) for i in range(size)] == ids.tolist()
        for value in (0, 1, top - 1, 511, 600):
            assert matrix.places(value) == np.flatnonzero(ids == value).tolist()
            assert matrix.count(value, size // 3, size) == (ids[size // 3:] == value).sum()


def test_occurrences(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a")], "doc_id long, text string")
    path = str(tmp_path / "shards")
    wavelet_shards.write_shards(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    assert wavelet_shards.occurrences(spark, path, 2).count() == 2


def test_digest_bounds():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abcde fgh", k=n)) for n in (0, 1, 2, 3, 50, 4000, 4000)]
    prints = digests(texts)
    assert len({len(p) for p in prints}) == 1 and likeness(prints, prints).tolist() == [1.0] * len(texts)
    for a, b in itertools.product(prints, prints):
        assert 0 <= likeness([a], [b])[0] == likeness([b], [a])[0] <= 1


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_signatures_are_complete(percent):
    """Sets at the limit of similarity always share a signature, and their parity rows pass."""
    rng = np.random.default_rng(percent)
    enumerated = partenum.PartEnum(percent)
    for size in [1, 2, 3, 5, 9, 10, 11, 19, 20, 37, 64, 150, 400]:
        for _ in range(12):
            whole = rng.integers(0, 2**64, size + 200, dtype=np.uint64)
            base, fresh = np.sort(whole[:size]), whole[size:]
            removed = int(rng.integers(0, size * (100 - percent) // 100 + 1))
            added = max(0, (100 * (size - removed) - percent * size) // percent)
            other = np.unique(np.concatenate([base[removed:], fresh[:min(added, 200)]]))
            if not partenum.similar(base, other, percent) or not len(other):
                continue
            shared = set(enumerated.signatures(base).tolist()) & set(enumerated.signatures(other).tolist())
            assert shared
            rows = [partenum.parity(s, enumerated.band(enumerated.number(len(s))).distance) for s in (base, other)]
            marks = partenum.folded(rows, min(map(len, rows)))
            distance = int(np.bitwise_count(marks[0] ^ marks[1]).sum())
            assert not partenum.apart(np.array([distance]), np.array([len(base)]), np.array([len(other)]), percent)[0]


def components_by_hand(links):
    root = {n: n for pair in links for n in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 3), (2, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(random.Random(5).randint(0, 50), i) for i in range(60)],
])
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = components_by_hand([p for p in links if p[0] != p[1]])
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("block", [4, 1024])
def test_similarity_components(spark, monkeypatch, block):
    """Chains of near copies, large groups and ties against all pairs, also in small blocks."""
    monkeypatch.setattr(partenum, "BLOCK", block)
    rng = random.Random(block)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows, current = [], list(base)
    for i in range(40):
        copy = list(current)
        copy[rng.randrange(len(copy))] = f"x{i}"
        if i % 4 == 0:
            current = copy
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, "a b c d") for i in range(5)] + [(200, "A  b\tc d"), (201, "a"), (202, "a"), (203, ""), (204, None)]
    rows += [(300 + i, " ".join(f"y{rng.randint(0, 9)}" for _ in range(rng.randint(1, 14)))) for i in range(40)]
    for width, percent in ((3, 90), (2, 80)):
        sets = {}
        for i, text in rows:
            words = (text or "").lower().split()
            sets[i] = {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
        links = [(a, b) for a, b in itertools.combinations(sets, 2)
                 if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        want = components_by_hand(links)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = partenum.similarity_components(docs, width, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want.get(i, i)) for i, s in sets.items()}


def test_substitutions_are_found(spark):
    rng = random.Random(2)
    item = [f"word{i}" for i in range(30)]
    rows = []
    for i in range(20):
        words = list(item)
        for k in range(3 + i % 5, 30, 7):
            words[k] = "other"
        rows.append((i, " ".join(["before"] * i + words + ["after"] * 3)))
    rows += [(50 + i, " ".join(rng.choices(item, k=60))) for i in range(10)]
    rows += [(70, " ".join(item[10:19])), (71, " ".join(item[10:21])), (72, None), (73, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contaminated(docs, benchmark).collect()}
    assert set(got) == {*range(20), 71}
    assert (got[0].doc_start, got[0].item_start, got[0].n_words, got[0].n_equal) == (0, 0, 30, 26)
    assert (got[7].doc_start, got[7].item_words) == (7, 30) and got[71].item_start == 10


def test_language_spans(spark):
    english, german = "the house stands on a hill over quiet water ", "das haus steht auf dem hügel über stillem wasser "
    greek = "το σπίτι στέκεται στον λόφο "
    docs = [(i, t * 8, lang) for i in range(30) for t, lang in ((english, "en"), (german, "de"), (greek, "el"))]
    model = language_spans.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "el", "en"]
    mixed = english * 5 + german * 4 + greek
    rows = [(1, mixed, "x"), (2, "123", "x"), (3, None, "x"), (4, "ω", "x"), (5, "汉字", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {r.doc_id: r for r in language_spans.predict(frame, model, keep=("lang_pred",), names=("l", "s", "spans")).collect()}
    assert got[1].spans == "0-45:en 45-81:de 81-86:el" and got[1].l == "en"
    assert (got[2].l, got[3].l, got[4].l) == ("und", "und", "el") and got[5].l in model.languages


def test_viterbi_is_best():
    rng = np.random.default_rng(4)
    sizes = np.array([0, 1, 4, 6, 3])
    scores = rng.normal(0, 3, (sizes.sum(), 3))
    labels = language_spans.viterbi(scores, sizes, 2.0)
    for start, size in zip(np.cumsum(sizes) - sizes, sizes):
        def value(path):
            return sum(scores[start + t, p] for t, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(size)), key=value)
        assert value(tuple(labels[start:start + size])) == pytest.approx(value(best))


def test_lm_difference(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices("a b c d e f".split() if i % 2 else "a b x y z".split(), k=rng.randint(1, 30)))) for i in range(30)]
    docs += [(40, None), (41, ""), (42, docs[0][1]), (0, docs[0][1])]
    good = {i for i, _ in docs if i % 2}
    target = spark.createDataFrame([(i,) for i in sorted(good)] + [(None,), (77,), (1,)], "doc_id long")
    scored = lm_difference.cross_entropy_difference(
        spark.createDataFrame(docs, "doc_id long, text string"), target, block_bytes=200).collect()
    own, total = [], [[collections.Counter() for _ in range(3)] for _ in range(2)]
    for i, text in docs:
        words = (text or "").lower().split()
        after, before = (words + ["$"], ["^"] + words) if words else ([], [])
        counts = [collections.Counter(after), collections.Counter(before), collections.Counter(zip(before, after))]
        own.append((after, before, counts, int(i not in good)))
        for k in range(3):
            total[own[-1][3]][k] += counts[k]
    words = len(set(total[0][0]) | set(total[1][0]))
    want = []
    for (i, _), (after, before, counts, side) in zip(docs, own, strict=True):
        losses = []
        for k in (0, 1):
            word, history, pair = ({key: n - (k == side) * c[key] for key, n in t.items()} for t, c in zip(total[k], counts, strict=True))
            n, loss = sum(word.values()), 0.0
            for h, w in zip(before, after, strict=True):
                p = (word.get(w, 0) + 0.5) / (n + 0.5 * words)
                loss -= math.log((pair.get((h, w), 0) + 4 * p) / (history.get(h, 0) + 4))
            losses.append(loss / len(after) if after else None)
        want.append((i, len(after), *losses))
    key = lambda r: (r[0], r[1])
    for got, row in zip(sorted(scored, key=key), sorted(want, key=key), strict=True):
        assert (got.doc_id, got.n_tokens) == row[:2]
        assert got.target_loss == (None if row[2] is None else pytest.approx(row[2]))
        assert got.background_loss == (None if row[3] is None else pytest.approx(row[3]))


def test_boilerplate(spark):
    rows = [(i, "big" if i < 40 else None, f"line {i}\n Menu \n\nFooter" if i % 2 else f"line {i}\nMenu") for i in range(50)]
    rows += [(90, "big", None), (91, "big", "Menu"), (92, "big", "")]
    pages = spark.createDataFrame(rows, "page_id long, site string, text string")
    got = {r.page_id: r for r in site_lines.drop_boilerplate(pages, "site", "text", ratio=0.6).collect()}
    assert len(got) == len(rows) and got[1].text == "line 1\n\nFooter" and got[0].text == "line 0"
    assert (got[90].text, got[91].text, got[92].text) == (None, "", "") and got[45].text == "line 45\n\nFooter"
    kept = {r.page_id: r.text for r in site_lines.drop_boilerplate(pages, "site", "text", keep_whole=True).collect()}
    assert kept[91] == "Menu"


def test_toxicity_held_out(spark):
    rng = random.Random(9)
    neutral = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(neutral, k=rng.randint(10, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "you scum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "you 1d!ot " * 4 + " ".join(neutral[:20]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = spark.createDataFrame([r for r in labels if r[0] < 300], "doc_id long, toxic int")
    model = toxicity.fit(docs, learned)
    assert {"idiot", "moron", "scum"} <= set(model.lexicon)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i].predicted == t for i, t in labels if i >= 300) >= 97
    assert got[1000].score == got[1001].score < 0.5
    one_class = toxicity.fit(docs, learned.where("toxic = 0"))
    assert one_class.trees is None and toxicity.score(docs, one_class).agg({"score": "max"}).first()[0] == 0.0
