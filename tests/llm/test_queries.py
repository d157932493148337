"""Every registered query on odd, empty and clashing tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from odd_tables import given, odd_vectors, tables  # noqa: F401
from tokenizers import Tokenizer

import check
import corpus_pipeline
from tallywood.llm import queries
from tallywood.llm.byte_bpe import read_ranks
from tallywood.llm.quartile_digest import digests, likeness

ALL = {**{name: query for name, (query, _) in queries.QUERIES.items()}, "pipeline": corpus_pipeline.run}
CLASHING = "a b at words sig rep n parity score spans lines n_lines component_id shard part block keys label features item shift text_crc32 size fp place id vector ids x cluster distance component i j members"


@pytest.mark.parametrize("name", ALL)
def test_empty_tables(spark, tables, name):
    assert ALL[name](spark, tables([])).collect() == []


@pytest.mark.parametrize("name", ["op1_spaced_seeds", "op6_byte_shards", "op9_language_spans", "op10_lm_difference", "op4_ngram_jaccard",
                                  "op11_simhash_tiles", "op12_jacobi_davidson", "op13_hadamard_clusters", "pipeline"])
def test_clashing_columns(spark, given, tables, name):
    rows, passage, labels, path = given
    plain = ALL[name](spark, path).collect()
    clash = ALL[name](spark, tables(rows, passage, labels, extra=CLASHING, vectors=odd_vectors())).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, clash))


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_sql(spark, name):
    con = check.connect("/root/testdata/sf0.001")
    assert check.compare(spark, con, name, "/root/testdata/sf0.001") == []


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0], r[1] or ""))


def test_wavelet_shards(spark, given):
    rows, _, _, path = given
    got = sorted(queries.wavelet(spark, path).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for row, (doc_id, text, *_) in zip(got, by_id(rows), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_byte_bpe(spark, given):
    rows, _, _, path = given
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest(), True))
    assert sorted(map(tuple, queries.byte_bpe(spark, path).collect())) == sorted(want)


def test_byte_shards(spark, given):
    rows, _, _, path = given
    got = queries.byte_shards(spark, path).collect()
    sizes = sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sizes
    total, largest = sum(s for _, s, _ in sizes), max(s for _, s, _ in sizes)
    order = sorted(got, key=lambda r: (r.doc_id, r.size, r.shard, r.slot))
    assert [r.shard for r in order] == sorted(r.shard for r in got)
    for shard in range(16):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
        assert sum(r.size for r in got if r.shard == shard) <= total / 16 + largest


def test_quartile_digest(spark, given):
    rows, _, _, path = given
    texts = [(r[0], r[1] or "") for r in sorted(rows, key=lambda r: (r[0], r[1] or ""), reverse=True)]
    want = []
    for (doc_id, text), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True):
        cut = len(text) // 3
        edited = (text[:len(text) - cut] + after[:cut]).encode()
        own, changed, following = digests([text.encode(), edited, after.encode()])
        want.append((doc_id, len(text), hashlib.sha256(edited).hexdigest(), own, changed,
                     likeness([own], [changed])[0], likeness([own], [following])[0]))
    assert sorted(map(tuple, queries.quartile_digest(spark, path).collect())) == sorted(want)


def test_language(spark, given):
    rows, _, _, path = given
    got = queries.language(spark, path).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows if r[1] and len(r[1]) > 40}
    assert all(r.lang_pred == lang[r.doc_id] for r in got if r.doc_id in lang)
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und") == (r.score == 0) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_toxicity(spark, given):
    rows, _, _, path = given
    got = queries.toxic(spark, path).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_site_lines(spark, given):
    _, _, _, path = given
    got = {r.page_id: r for r in queries.site_lines(spark, path).collect()}
    assert got[0].text == "Page 0 text" and (got[0].host, got[0].n_lines, got[0].n_dropped) == ("host0.example", 2, 1)
    assert got[12].text is None and got[12].n_lines == 0 and got[13].text == ""


def test_pipeline_by_hand(spark, given):
    """Each stage against a plain computation on what the one before it has kept."""
    rows, passage, _, path = given
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language ID"](spark, docs, path).collect()
    assert {r.doc_id for r in first} == {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    assert len(first) == sum(bool(r[1]) and any(c.isalpha() for c in r[1]) for r in rows)
    second = stages["line dedup"](spark, spark.createDataFrame(first, docs.schema), path).collect()
    pages = {}
    for r in first:
        pages.setdefault(r.source, []).append({x.strip(" \t\r") for x in r.text.split("\n")} - {""})
    for before, after in zip(sorted(first), sorted(second), strict=True):
        seen = pages[before.source]
        share = {x.strip(" \t\r"): sum(x.strip(" \t\r") in p for p in seen) for x in before.text.split("\n")}
        kept = [x for x in before.text.split("\n") if not (share[x.strip(" \t\r")] >= 3 and share[x.strip(" \t\r")] > 0.1 * len(seen))]
        assert after.text == ("\n".join(kept) if any(x.strip(" \t\r") for x in kept) else before.text)
    third = stages["n-gram Jaccard join"](spark, spark.createDataFrame(second, docs.schema), path).collect()
    sets = {}
    for r in second:
        words = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
        if all(group[group[a]] == group[a] for a in sets):
            break
    assert sorted(r.doc_id for r in third) == sorted(set(group.values()))
    fourth = stages["benchmark decontamination"](spark, spark.createDataFrame(third, docs.schema), path).collect()
    assert {r.doc_id for r in third} - {r.doc_id for r in fourth} == {r.doc_id for r in third if passage in r.text}
    whole = corpus_pipeline.run(spark, path).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in fourth)
