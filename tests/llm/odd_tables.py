"""Small tables with odd rows, as fixtures."""

import random

import pytest

WORDS = {
    "en": "the house on a hill stands over quiet water and old trees grow there with every spring that comes".split(),
    "de": "das haus auf dem hügel steht über stillem wasser und alte bäume wachsen dort mit jedem frühling".split(),
}
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", rng.choice("abcdefgh")]) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents of two languages with copies, near copies, passages and odd rows."""
    rng = random.Random(seed)
    passage = sentence(rng, "en", 24)
    rows = []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        text = "\n".join(sentence(rng, lang, rng.randint(5, 40)) for _ in range(rng.randint(1, 4)))
        if i % 10 == 4:
            text += "\nAll rights reserved."
        if i % 12 == 5:
            text += " " + passage
        if i % 9 == 7:
            text += " you idiot, you " + "stupid clown " * 3
        rows.append((i, text, lang, f"src{i % 2}", len(text)))
    for i in range(12):  # copies and near copies of a long one
        base = rows[1][1] + " " + " ".join(rows[2][1].split())
        words = (base * 3).split()
        if i % 3:
            words[i * 3] = "changed"
        rows.append((n + i, " ".join(words), "en", "src0", 0))
    tail = n + 12
    rows += [
        (tail, None, None, None, None), (tail + 1, "", "en", "src0", 0), (tail + 2, "  \n\t ", "de", "src1", 4),
        (tail + 3, "12 34 !!!", None, "src0", 9), (tail + 4, "ab", "en", "src0", 2), (tail + 5, "汉字 \U0001f600 é", None, "src1", 6),
        (tail + 6, sentence(rng, "en", 4000), "en", "src1", 1), rows[3], rows[3],
    ]
    return rows, passage


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables to a new folder, as the queries read them."""
    def write(documents, passage="", labels=(), extra="", pages=(), vectors=()):
        path = str(tmp_path / f"tables{len(list(tmp_path.iterdir()))}")
        docs = spark.createDataFrame(documents, DOCUMENTS)
        for name in extra.split():
            docs = docs.selectExpr("*", f"doc_id AS `{name}`")
        docs.write.parquet(f"{path}/documents.parquet")
        bench = [(7, passage), (8, None), (9, "two words")] if passage else []
        spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame(list(pages), "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
        embeddings = spark.createDataFrame(list(vectors), "vec_id long, embedding array<float>, label int")
        for name in set(extra.split()) - {"label"}:
            embeddings = embeddings.selectExpr("*", f"vec_id AS `{name}`")
        embeddings.write.parquet(f"{path}/embeddings.parquet")
        return path
    return write


def odd_vectors(seed=5, n=120, size=64):
    """Vectors of a table ``vec_id, embedding, label`` with repeated, broken and other ones."""
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.02 * (1 + j % 7)) for j in range(size)], i % 3) for i in range(n)]
    rows += [rows[4], rows[4], (n, rows[4][1], 0), (None, rows[5][1], None), (n + 1, [0.0] * size, 0)]
    broken = [float("nan"), float("inf"), None]
    rows += [(n + 2 + i, [*rows[i][1][:-1], value], 0) for i, value in enumerate(broken)]
    return rows + [(n + 9, None, 0), (n + 10, [], 0), (n + 11, [1.0], 0), (n + 12, [1.0] * (size + 1), 0)]


@pytest.fixture
def given(tables):
    rows, passage = corpus()
    labels = [(r[0], r[0] % 2, int("idiot" in (r[1] or ""))) for r in rows] + [(999, 1, 1), (3, None, None)]
    pages = [
        (i, f"http://Host{i % 2}.example/{i}", f"<p>Home</p><p>Page {i} <b>text</b></p><script>x</script>") for i in range(12)
    ] + [(12, None, None), (13, "x", ""), (13, "x", "")]
    return rows, passage, labels, tables(rows, passage, labels, pages=pages, vectors=odd_vectors())
