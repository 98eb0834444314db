import random

from fraudlake.llm.graph import connected_components


def test_components_of_paths_stars_and_random_links(spark):
    rnd = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)]  # a path
    edges += [(500, k) for k in range(501, 540)]  # a star
    edges += [(rnd.randrange(1000, 1060), rnd.randrange(1000, 1060)) for _ in range(45)]
    edges += [(7, 7), (None, 3), (9, None), (500, 501), (501, 500)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
