"""Passages of few words, with many changes, and with very many alignments."""

import time
from itertools import accumulate

import duckdb

from tallywood.llm.decontamination import LEAST_WORDS, MASKS, SUBSTITUTION, contaminated
from tallywood.llm.oracles import DECONTAMINATION


def test_short_items_agree_as_a_whole(spark):
    items = [(1, "Who wrote it?"), (2, "Forty-two"), (3, "one two three four five six seven eight"), (4, "..."), (5, "Who")]
    rows = [
        (10, "and who WROTE it, then"), (11, "who wrote"), (12, "a forty two"), (13, "one two three four five other seven eight"),
        (14, "zero one two three four five six seven eight nine"), (15, None), (16, "Forty"), (17, "..."),
    ]
    got = contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id, r.doc_start, r.n_words, r.n_equal, r.item_words) for r in got} == {
        (10, 1, 1, 3, 3, 3), (10, 5, 1, 1, 1, 1), (11, 5, 0, 1, 1, 1), (12, 2, 1, 2, 2, 2), (14, 3, 1, 8, 8, 8),
    }


def test_every_fourth_word_replaced(spark):
    words = [f"word{i}" for i in range(20)]
    rows = [(p, " ".join("other" if i % 4 == p else w for i, w in enumerate(words))) for p in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    item = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert {r.doc_id: r.n_equal for r in contaminated(docs, item).collect()} == {0: 15, 1: 12, 2: 12, 3: 15}
    assert contaminated(docs, item, masks=("110110111", "101101101011")).collect() == []


def orders() -> list[str]:
    """All orders of equal (1) and different (0) words up to the last equal word of a passage."""
    found, open_ = [], [("1", 1)]
    while open_:
        order, score = open_.pop()
        if order.count("1") == LEAST_WORDS:
            found.append(order)
            continue
        open_.append((order + "1", score + 1))
        if score > SUBSTITUTION:
            open_.append((order + "0", score - SUBSTITUTION))
    return found


def test_no_order_of_changes_is_missed(spark):
    found = orders()
    assert all(
        any(all(order[at + k] == "1" for k, use in enumerate(mask) if use == "1") for mask in MASKS for at in range(len(order) - len(mask) + 1))
        for order in found
    )
    # Where an earlier stretch scores as much, that one is the best and has fewer equal words.
    scores = [list(accumulate(1 if x == "1" else -SUBSTITUTION for x in order)) for order in found]
    passages = {n for n, score in enumerate(scores) if score[-1] > max(score[:-1])}
    longest = max(map(len, found))
    words = [f"word{i}" for i in range(longest)]
    rows = [
        (n, "before " + " ".join(w if n_ == "1" else f"other{n}" for w, n_ in zip(words, order)) + " behind")
        for n, order in enumerate(found)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    item = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: r for r in contaminated(docs, item).collect()}
    assert passages and set(got) == passages
    assert all(r.n_equal == LEAST_WORDS and r.doc_start == 1 and r.item_start == 0 for r in got.values())


def test_sql_knows_short_items_and_all_masks(spark):
    rows = [
        (1, "and who WROTE it, then"), (2, "one two three four five six seven"), (3, "a b c x d e f x g h i j"), (4, None),
        (5, "who wrote"), (6, "x a b c d e f g h i j"),
    ]
    items = [(1, "Who wrote it?"), (2, "seven"), (3, "a b c d e f g h i j"), (4, "a b c y d e f y g h i j"), (5, "...")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    result = con.execute(DECONTAMINATION)
    names = [c[0] for c in result.description]
    want = sorted(result.fetchall())
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.select(*names).collect())) == want
    assert {r[:2] for r in want} == {(1, 1), (2, 2), (3, 4), (6, 3)}


def test_very_many_alignments_take_seconds(spark):
    docs = spark.createDataFrame([(1, "again " * 20_000), (2, "once again")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "again"), (2, "never")], "item_id long, text string")
    start = time.monotonic()
    got = contaminated(docs, items).collect()
    assert {(r.doc_id, r.doc_start) for r in got} == {(1, 0), (2, 1)}
    assert time.monotonic() - start < 60
    assert contaminated(docs, items, least_item=2).collect() == []
