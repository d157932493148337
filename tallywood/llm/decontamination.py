"""Passages of a benchmark in documents, found by spaced seeds.

A mask selects some of the word positions of a window and ignores the others, so a window with a
changed word at an ignored position keeps its hash. Windows of documents whose hash a benchmark
item has as well are hits; around a hit the words of both are compared one by one, and the best
stretch of agreeing words, substitutions included, decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import materialize

# Selected positions of a window. Every passage as defined below holds a window that fits one of
# these masks: of all orders of equal and different words that make ten equal ones, none is missed.
MASKS = ("11101101", "11110001001", "11101000101")
# A stretch counts one for an equal word and loses so much for a different one.
SUBSTITUTION = 2
# Equal words that make a passage; items with fewer words must agree as a whole.
LEAST_WORDS = 10
# Alignments that are read from one copy of the words of a document.
ALIGNMENTS = 4096


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text: runs of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, key: str, masks: tuple[str, ...], whole: tuple[int, ...] = (), docs: bool = True) -> DataFrame:
    """``key, at, mask, seed``: the seeds of every window of ``words``.

    ``whole`` are numbers of words of items that are shorter than any mask; such an item has one
    seed of all its words, and a document one of as many words from each place on.
    """
    shortest = min([*map(len, masks), *whole])
    starts = F.sequence(F.lit(0), F.size("words") - shortest)
    rows = rows.where(F.size("words") >= shortest).select(key, "words", F.explode(starts).alias("at"))
    seeds = []
    for number, mask in enumerate([*masks, *("1" * n for n in whole)]):
        picked = [F.get("words", F.col("at") + k) for k, use in enumerate(mask) if use == "1"]
        fits = F.col("at") + len(mask) <= F.size("words")
        if number >= len(masks) and not docs:
            fits = F.size("words") == len(mask)
        seeds.append(F.struct(F.lit(number).alias("mask"), F.when(fits, F.xxhash64(*picked)).alias("seed")))
    return rows.select(key, "at", F.inline(F.array(*seeds))).where("seed IS NOT NULL")


def hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``doc, item, shift``: alignments of documents and items that share a seed.

    ``docs`` has ``doc`` and ``words``, ``items`` has ``item`` and ``words``. ``shift`` is the
    position in the document less that in the item. Items with fewer words than a window are looked
    up as a whole. The seeds of the items are written once, and Spark broadcasts them where their
    size allows and joins by a shuffle where not.
    """
    sizes = items.select(F.size("words").alias("n")).where(F.col("n").between(1, min(map(len, masks)) - 1)).distinct()
    whole = tuple(sorted(r["n"] for r in sizes.collect()))  # fewer than the words of a window
    wanted = materialize(_seeds(items, "item", masks, whole, docs=False).withColumnRenamed("at", "place"))
    found = _seeds(docs, "doc", masks, whole).join(wanted, ["mask", "seed"])
    return found.select("doc", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()


def _stretch(words: str, item: str, shift: str) -> Column:
    """Best stretch on an alignment: ``score, first, last, equal`` in positions of the item."""
    equal = F.transform(
        F.sequence(F.lit(0), F.size(item) - 1),
        lambda j: F.struct(
            j.alias("j"),
            # A position before the document would count from its end.
            (((j + F.col(shift)) >= 0) & F.coalesce(F.get(F.col(words), j + F.col(shift)) == F.get(F.col(item), j), F.lit(False))).alias("same"),
        ),
    )
    zero = F.lit(0)
    start = F.struct(
        zero.alias("now"), zero.alias("since"), zero.alias("count"),
        F.struct(zero.alias("score"), zero.alias("first"), F.lit(-1).alias("last"), zero.alias("equal")).alias("best"),
    )

    def step(state: Column, x: Column) -> Column:
        gain = F.when(x["same"], 1).otherwise(-SUBSTITUTION)
        anew = state["now"] <= 0
        now = F.when(anew, 0).otherwise(state["now"]) + gain
        since = F.when(anew, x["j"]).otherwise(state["since"])
        count = F.when(anew, 0).otherwise(state["count"]) + F.when(x["same"], 1).otherwise(0)
        best = F.when(
            now > state["best"]["score"],
            F.struct(now.alias("score"), since.alias("first"), x["j"].alias("last"), count.alias("equal")),
        ).otherwise(state["best"])
        return F.struct(now.alias("now"), since.alias("since"), count.alias("count"), best.alias("best"))

    return F.aggregate(equal, start, step)["best"]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = MASKS,
    least_words: int = LEAST_WORDS, least_item: int = 1,
) -> DataFrame:
    """``id, item_id, doc_start, item_start, n_words, n_equal, item_words``: one row per document
    and item of which it holds a passage.

    A passage is a stretch on one alignment with ``least_words`` equal words, or as many as the
    item has; of several alignments the one with the best score counts, then the first in the
    document. Positions count words from 0. Null texts and texts without words hold and are no
    passages, and neither are items with fewer than ``least_item`` words, of which a document may
    hold any by chance. Rows that share an id are searched one by one and reported once; a null id
    is an id like any other.

    The words of a document with hits are hashed once more for all of them, and each alignment
    takes the stretch of them that lies beside its item.
    """
    words = docs.select(F.col(id_column).alias("doc"), word_hashes(F.col(text)).alias("words"))
    items = benchmark.select(F.col(item_id).alias("item"), word_hashes(F.col(item_text)).alias("words")).distinct()
    items = materialize(items.where(F.size("words") >= least_item))
    found = materialize(hits(words, items, masks))
    sizes = items.groupBy("item").agg(F.max(F.size("words")).alias("most"))
    copies = found.groupBy("doc").agg(F.ceil(F.count("*") / ALIGNMENTS).alias("copies"))
    dealt = found.alias("f").join(sizes.alias("s"), F.col("f.item").eqNullSafe(F.col("s.item")))
    dealt = dealt.join(copies.alias("c"), F.col("f.doc").eqNullSafe(F.col("c.doc"))).select(
        "f.doc", F.pmod(F.xxhash64("f.item", "shift"), F.col("copies")).alias("copy"), F.struct("f.item", "shift", "most").alias("x")
    )
    dealt = dealt.groupBy("doc", "copy").agg(F.collect_list("x").alias("alignments")).alias("f")
    held = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("__text")).alias("d")
    held = held.join(dealt, F.col("d.doc").eqNullSafe(F.col("f.doc")))
    # Written, so that the words are not hashed anew for each alignment.
    held = materialize(held.select("d.doc", word_hashes(F.col("__text")).alias("words"), "alignments"))
    beside = held.select("doc", F.inline(F.transform("alignments", lambda x: F.struct(
        x["item"].alias("item"), x["shift"].alias("shift"),
        F.slice("words", F.greatest(x["shift"], F.lit(0)) + 1, x["most"] + F.least(x["shift"], F.lit(0))).alias("words"),
    )))).alias("d")
    both = beside.join(items.alias("i"), F.col("d.item").eqNullSafe(F.col("i.item"))).select(
        "d.doc", "d.item", "shift", F.least("shift", F.lit(0)).alias("before"), "d.words", F.col("i.words").alias("item_words")
    )
    both = both.select("doc", "item", "shift", F.size("item_words").cast("long").alias("size"), _stretch("words", "item_words", "before").alias("best"))
    both = both.where(F.col("best.equal") >= F.least(F.lit(least_words).cast("long"), F.col("size")))
    order = F.struct(F.col("best.score"), -(F.col("shift") + F.col("best.first")), -F.col("best.first"))
    best = both.groupBy("doc", "item").agg(F.max_by(F.struct("shift", "best", "size"), order).alias("x"))
    return best.select(
        F.col("doc").alias(id_column), F.col("item").alias(item_id),
        (F.col("x.shift") + F.col("x.best.first")).cast("long").alias("doc_start"),
        F.col("x.best.first").cast("long").alias("item_start"),
        (F.col("x.best.last") - F.col("x.best.first") + 1).cast("long").alias("n_words"),
        F.col("x.best.equal").cast("long").alias("n_equal"), F.col("x.size").alias("item_words"),
    )
