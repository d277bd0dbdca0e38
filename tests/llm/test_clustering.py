"""Clusters by plain arithmetic on odd input; the registered query is compared with SQL beside the others."""

import hashlib

import numpy as np
import pytest

from cellamp.llm import clustering


def plain(rows, clusters, rounds, dimensions, scale=256, seed=2):
    """(id, cluster, distance, inertias, digest) per whole vector, with Python's integers."""
    kept = []
    for k, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v):
            kept.append((k, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]))
    digest = {k: hashlib.sha256(f"{seed}:{k}".encode()).hexdigest() for k, _ in kept}
    ordered = sorted(kept, key=lambda r: (r[0] is None, digest[r[0]], r[1]))
    centroids = [v for _, v in ordered[:clusters]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[0]].append(v)
        centroids = [[sum(x) // len(own) for x in zip(*own, strict=True)] if own else c for own, c in zip(members, centroids, strict=True)]
    found = [(k, *nearest(v)) for k, v in kept]
    own = [sum(d for _, c, d in found if c == n) for n in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((k, c, d, own[c], sum(own), names[c]) for k, c, d in found), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    points = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8)]) for k in range(240)]
    same = [0.5, -0.25, 1.0, 0.0, -1.0, 2.0, 0.125, -0.0625]
    odd = [(300, None), (301, []), (302, same[:7]), (303, [*same, 1.0]), (304, [*same[:7], None]), (305, [*same[:7], float("nan")]), (306, [*same[:7], float("inf")]),
           (None, same), (None, [-x for x in same]), (7, same), (7, same), (8, [100000.0] * 8), (9, [-3.4] * 8)]
    return points + odd + [(400 + k % 3, same) for k in range(90)]


@pytest.mark.parametrize(("chunk", "clusters"), [(16_384, 12), (13, 12), (50, 60), (16_384, 1)])
def test_clusters_of_odd_rows(chunk, clusters, rows, spark):
    frame = spark.createDataFrame([(k, v, "taken", 5) for k, v in rows], "vec_id bigint, embedding array<float>, cluster string, inertia int").repartition(5)
    got = clustering.cluster(frame, clusters=clusters, dimensions=8, chunk=chunk)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, clusters, 5, 8)


def test_few_and_no_vectors(spark):
    few = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-1.0, 0.0])]
    frame = spark.createDataFrame(few, "vec_id int, embedding array<double>")
    assert sorted(map(tuple, clustering.cluster(frame, dimensions=2).collect()), key=str) == plain(few, 40, 5, 2)
    assert clustering.cluster(frame.limit(0), dimensions=2).collect() == []
    assert clustering.cluster(frame.filter("vec_id = 9"), dimensions=2).count() == 0


def test_components_beyond_exact_distances_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id int, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(frame, dimensions=2).collect()


def test_dictionaries_are_lossless_and_as_wide_as_pays():
    rng = np.random.default_rng(2)
    unlike = rng.integers(-(1 << 27), 1 << 27, (3000, 64))
    copies = np.repeat(unlike[:10], 300, axis=0)
    mixed = np.concatenate([copies[:, :32], rng.integers(-9, 9, (3000, 32))], axis=1)
    for values, widths in ((unlike, [1] * 64), (copies, [64]), (mixed, None)):
        widest, entries, codes = clustering.encode(values)
        assert widest == widths or widths is None and widest[0] == 32 and max(widest[1:]) <= 2
        row = {"rows": len(values), "ids": b"", "missing": b"", "widths": widest, "entries": entries, "codes": codes}
        back = np.concatenate([e[c] for _, e, c in clustering.Chunk(row).blocks], axis=1)
        assert np.array_equal(back, values)
