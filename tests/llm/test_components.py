"""Components of large groups in few jobs, whatever a task holds at once."""

import random

import numpy as np


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_random_graphs(spark, monkeypatch):
    from gridloom.llm import components as C

    rng = random.Random(5)
    for chunk in (C.CHUNK_EDGES, 7):
        monkeypatch.setattr(C, "CHUNK_EDGES", chunk)
        edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000, 1001 + rng.randrange(300)) for _ in range(500)]
        edges += [(3000 + i * 7919 % 64, 3000 + (i + 1) * 7919 % 64) for i in range(60)]
        got = C.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
        want = {x: c for x, c in brute(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
        assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_forest():
    from gridloom.llm.components import forest

    node, root = forest(np.array([5, 9, 7, 3, 8]), np.array([7, 2, 3, 3, 8]))
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {5: 3, 7: 3, 9: 2}


def jobs_of(spark, group, f):
    spark.sparkContext.setJobGroup(group, group)
    f()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_components_take_few_jobs(spark):
    from gridloom.llm.components import connected_components

    # Hubs of a large group: each node is linked to some of 20 smaller ones, which are linked by way of it.
    rng = random.Random(8)
    edges = [(100 + i, h) for i in range(3000) for h in rng.sample(range(20), 3)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4).cache()
    frame.count()
    assert jobs_of(spark, "components-of-hubs", lambda: connected_components(frame).count()) <= 16
