"""Stages of the pipeline on planted documents."""

import random

from odd_tables import DOCUMENTS, tables  # noqa: F401

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)


def lines(rng, n, words=12):
    return [" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(words)) for _ in range(n)]


def documents(spark, texts, source="src"):
    return spark.createDataFrame([(i, t, "en", source, len(t)) for i, t in enumerate(texts)], DOCUMENTS)


def similarity(a, b):
    a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_near_copies_pass_line_dedup_whole(spark):
    """A third of a source in one group: exact copies and near copies with words changed on some lines."""
    rng = random.Random(3)
    base = lines(rng, 10, 40)
    texts = ["\n".join([*lines(rng, 6), "All rights reserved."]) for _ in range(80)] + ["\n".join(base)] * 20
    for _ in range(20):
        copy = list(base)
        for at in rng.sample(range(10), 7):
            words = copy[at].split()
            words[rng.randrange(5, 35)] = "changed"
            copy[at] = " ".join(words)
        texts.append("\n".join(copy))
    assert all(similarity(texts[80], t) >= 0.8 for t in texts[100:])
    docs = documents(spark, texts)
    second = STAGES["line dedup"](spark, docs, "").collect()
    got = {r.doc_id: r.text for r in second}
    assert [got[i] for i in range(80, 120)] == texts[80:]
    assert all(got[i] == texts[i].removesuffix("\nAll rights reserved.") for i in range(80))
    third = STAGES["n-gram Jaccard join"](spark, spark.createDataFrame(second, docs.schema), "").collect()
    assert sorted(r.doc_id for r in third) == list(range(81))


def test_repeated_lines_far_below_a_tenth_go(spark):
    rng = random.Random(4)
    own = [lines(rng, 4) for _ in range(600)]
    passage, notice = lines(rng, 1, 50)[0], "Some rights reserved."
    texts = ["\n".join([*x, passage] if i % 100 == 7 else [*x, notice] if i % 60 == 9 else [*x, own[0][0]] if i == 5 else x) for i, x in enumerate(own)]
    docs = documents(spark, texts)
    got = {r.doc_id: r.text for r in STAGES["line dedup"](spark, docs, "").collect()}
    want = {i: "\n".join([*x, own[0][0]] if i == 5 else x) for i, x in enumerate(own)}
    assert got == want


def test_repeated_lines_go_from_copies_too(spark):
    """A notice on many texts goes from the members of a group as from others; the group's own lines stay."""
    rng = random.Random(8)
    notice = "Some rights reserved, see the page of terms."
    base = lines(rng, 8, 30)
    texts = ["\n".join([*lines(rng, 5), notice] if i % 10 == 0 else lines(rng, 5)) for i in range(60)]
    copies = []
    for i in range(30):
        copy = list(base)
        copy[i % 8] = copy[i % 8] + f" word{i}"
        copies.append("\n".join(copy))
    docs = documents(spark, texts + [f"{c}\n{notice}" for c in copies])
    second = STAGES["line dedup"](spark, docs, "").collect()
    got = {r.doc_id: r.text for r in second}
    assert got == dict(enumerate([t.removesuffix("\n" + notice) for t in texts] + copies))
    third = STAGES["n-gram Jaccard join"](spark, spark.createDataFrame(second, docs.schema), "").collect()
    assert sorted(r.doc_id for r in third) == list(range(61))


def test_rows_go_for_their_own_text(spark):
    rng = random.Random(5)
    a, b, c, d = (" ".join(lines(rng, 1, 40)) for _ in range(4))
    near = " ".join([*a.split()[:-1], "changed"])
    rows = [(1, a), (2, near), (2, b), (3, c), (3, d), (None, c), (None, b + " " + d), (None, near), (4, d), (4, d), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], DOCUMENTS)
    kept = [(r.doc_id, r.text) for r in STAGES["n-gram Jaccard join"](spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (2, b), (3, c), (3, d), (None, b + " " + d), (None, "")], key=str)


def test_benchmark_takes_single_rows(spark, tables):
    rng = random.Random(6)
    a, b, passage = (" ".join(lines(rng, 1, 30)) for _ in range(3))
    rows = [(i, t, "en", "src", 0) for i, t in [(1, a), (1, passage), (None, b), (None, a + " " + passage)]]
    path = tables(rows, passage)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = STAGES["benchmark decontamination"](spark, docs, path).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, a), (None, b)], key=str)
