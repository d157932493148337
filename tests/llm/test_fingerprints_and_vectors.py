"""SimHash tiles, whitening and clustering against plain computations."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from odd_tables import given, odd_vectors, tables  # noqa: F401

from tallywood.llm import hadamard_clusters, jacobi_davidson, queries, simhash_tiles, whitening


def fingerprint_by_hand(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, radius):
    """The first place that links reach, for each number."""
    label = list(range(len(fps)))
    for _ in fps:
        before = list(label)
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if bin(a ^ b).count("1") <= radius:
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return label
    return label


def test_simhash_query(spark, given):
    rows, _, _, path = given
    ids = sorted((r[0], r[1]) for r in rows if r[1]) + [(r[0], r[1]) for r in rows if not r[1]]
    ids.sort(key=lambda r: r[0])
    fps = [fingerprint_by_hand(t) for _, t in ids]
    label = components_by_hand(fps, 2)
    want = sorted((i, f"{fp:016x}", ids[c][0]) for (i, _), fp, c in zip(ids, fps, label, strict=True))
    assert sorted(map(tuple, queries.simhash_tiles(spark, path).collect())) == want
    assert len(set(label)) < len(set(fps)) < len(fps)  # links between different fingerprints, and equal ones


def test_shingles_of_spark_agree(spark):
    """The native function has the same hash and seed."""
    hashed = spark.sql("SELECT xxhash64('the house on') AS h").first().h
    assert hashed % 2**64 == int(simhash_tiles.shingle_hashes("The  house\non", 3)[0])


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("block", [4, 512])
def test_links_reach_all(spark, monkeypatch, radius, block):
    monkeypatch.setattr(simhash_tiles, "BLOCK", block)
    rng = random.Random(radius)
    fps = {0, 2**64 - 1, 1, 3, 7}
    for _ in range(12):
        fp = rng.getrandbits(64)
        for _ in range(rng.randint(1, 9)):
            fps.add(fp)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                fp ^= 1 << bit
    fps = sorted(fps)
    table = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "i long, fp long")
    place = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
    label = list(range(len(fps)))
    found = [(place[r.a], place[r.b]) for r in simhash_tiles.links(table, radius).collect()]
    for _ in fps:
        for a, b in found:
            label[a] = label[b] = min(label[a], label[b])
    assert label == components_by_hand(fps, radius)


def test_hot_cluster_has_few_links(spark):
    """A cluster in which all are near each other gives about a link a member and tile, not a pair each."""
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << i) for i in range(64)} | {base})
    table = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    assert simhash_tiles.links(table, 2).count() <= 33 * len(fps)


def test_null_ids(spark):
    rows = [(None, "one two three four"), (None, "other words of some length"), (7, "one two three four"), (3, None), (5, ""), (None, None)]
    got = simhash_tiles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    zero = "0" * 16
    assert sorted((r.component_id for r in got if r.fingerprint == zero)) == [3, 3, 3]
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got if r.fingerprint != zero) == [("7", "7"), ("None", "7"), ("None", "None")]


def test_long_text():
    words = [f"w{i}" for i in range(200_000)]
    hashes = simhash_tiles.shingle_hashes(" ".join(words), 3)
    bits = ((hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0) * 2 > len(hashes)
    assert int(simhash_tiles.majority([hashes])[0]) == sum(1 << i for i in range(64) if bits[i])


# Whitening


def test_minres():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((40, 40))
    a, b = a + a.T, rng.standard_normal((40, 3))
    assert np.allclose(a @ jacobi_davidson.minres(lambda v: a @ v, b, 80), b, atol=1e-9)
    sizes = [np.linalg.norm(a @ jacobi_davidson.minres(lambda v: a @ v, b, k) - b, axis=0) for k in range(1, 20)]
    assert all((x >= y - 1e-9).all() for x, y in zip(sizes, sizes[1:], strict=False))


@pytest.mark.parametrize(("size", "count", "block"), [(1, 3, 16), (5, 5, 2), (64, 32, 16), (150, 20, 8), (220, 32, 16)])
def test_eigenpairs(size, count, block):
    """Also with restarts: the larger ones never fill their space."""
    rng = np.random.default_rng(size)
    rows = rng.standard_normal((4 * size, size)) * np.linspace(1, 3, size)
    a = rows.T @ rows / len(rows)
    values, vectors = jacobi_davidson.largest_eigenpairs(lambda v: a @ v, size, count, block)
    want = np.linalg.eigvalsh(a)[::-1][:count]
    assert np.allclose(values, want, rtol=1e-13) and len(values) == min(size, count)
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_equal_eigenvalues():
    a = np.diag([5.0, 5, 5, 2, 2, 1, 0, 0])
    values, vectors = jacobi_davidson.largest_eigenpairs(lambda v: a @ v, 8, 5, 2)
    assert np.allclose(values, [5, 5, 5, 2, 2]) and np.allclose(a @ vectors, vectors * values)


def test_whitening_query(spark, given):
    _, _, _, path = given
    rows = [(i, v) for i, v, _ in odd_vectors() if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = {}
    for (i, _), row, z in zip(rows, x, y @ vectors[:, :32] / np.sqrt(values[:32]), strict=True):
        deviation = sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, sums, strict=True))
        for k in range(32):
            want.setdefault((i, k + 1), []).append((deviation, abs(z[k]), values[k] / values.sum()))
    got = queries.whitening(spark, path).collect()
    assert len(got) == 32 * n and {r.n for r in got} == {n}
    for r in got:
        choices = want[r.vec_id, r.component]
        assert any(r.deviation == d and abs(abs(r.whitened) - z) < 1e-9 and abs(r.explained - e) < 1e-12 for d, z, e in choices)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    z = np.array([r.whitened for r in sorted(got, key=lambda r: (r.component, str(r.vec_id), r.whitened))]).reshape(32, n)
    assert np.abs(z.mean(axis=1)).max() < 1e-9
    assert len({(r.vec_id, r.component, r.whitened) for r in got if r.vec_id == 4}) == 32  # one sign for all rows


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect() == []


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [float((-1) ** i * 200_000)]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(table).collect()
    assert len(got) == 400 and {r.deviation for r in got} == {None} and {round(abs(r.whitened), 9) for r in got} == {1.0}


# Clusters


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-(2**24), 2**24, (50, size))
    basis = hadamard_clusters.transform(np.eye(size, dtype=int))
    assert (hadamard_clusters.transform(x) == x @ basis).all()
    assert [int((np.diff(f) != 0).sum()) for f in basis.T] == list(range(size))


@pytest.mark.parametrize("spread", [1, 3, 2**24])
def test_nearest(spread):
    """Few values make many ties, large ones fill 64 bits."""
    rng = np.random.default_rng(spread)
    x, centroids = rng.integers(-spread, spread + 1, (300, 64)), rng.integers(-spread, spread + 1, (16, 64))
    centroids[9], x[:20] = centroids[3], centroids[9]
    best, distance = hadamard_clusters.nearest(x, centroids)
    exact = ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def clusters_by_hand(rows, count=16, rounds=3):
    points = [[int(np.floor(64 * float(np.float32(e)))) for e in v] for _, v in rows]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), [float(np.float32(e)) for e in v], p) for (i, v), p in zip(rows, points, strict=True) if i is not None)
    centroids = [p for _, _, p in named[:count]]
    for step in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), k) for k, c in enumerate(centroids)) for p in points]
        if step < rounds:
            for k in range(len(centroids)):
                own = [p for p, (_, c) in zip(points, best, strict=True) if c == k]
                if own:
                    centroids[k] = [sum(e) // len(own) for e in zip(*own, strict=True)]
    inertia = [sum(d for d, c in best if c == k) for k in range(len(centroids))]
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia), named[c]) for (i, _), (d, c) in zip(rows, best, strict=True)]


def test_clusters_query(spark, given):
    _, _, _, path = given
    rows = [(i, v) for i, v, _ in odd_vectors() if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    got = queries.hadamard_clusters(spark, path).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, clusters_by_hand(rows)))


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.5] * 64), (None, [0.25] * 64), (2, [1.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(repr, map(tuple, hadamard_clusters.cluster(table).collect()))) == sorted(map(repr, clusters_by_hand(rows)))
    assert hadamard_clusters.cluster(table.where("vec_id IS NULL")).collect() == []
