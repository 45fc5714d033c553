import random

from gatetally.llm.components import components


def test_components_of_random_links(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 7), (500, 3), (3, 500)]
    links += [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(45)]
    links += [(2000, 2000 + i) for i in range(1, 60)]
    least = {n: n for link in links for n in link}
    for _ in range(100):
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    found = components(spark.createDataFrame(links, "u long, v long"))
    joined = {n for u, v in links if u != v for n in (u, v)}
    assert {r["node"]: r["label"] for r in found.collect()} == {n: least[n] for n in joined}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
