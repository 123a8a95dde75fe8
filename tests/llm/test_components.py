"""Connected components: the result, and that the search ends once every component is a star."""

import random

import pytest

from caudal.llm import components as module


def found(spark, pairs):
    edges = spark.createDataFrame(pairs, "a long, b long")
    return {r["id"]: r["component"] for r in module.components(edges).collect()}


def expected(pairs):
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(above)}


@pytest.mark.parametrize("pairs", [
    [(n, 1) for n in range(2, 9)], [(1, 9), (9, 5), (5, 5), (1, 9), (None, 3), (3, None)],
    [(n + 1, n) for n in range(30)], [(3, 1), (3, 2), (9, 8)], [(2, 2)]], ids=["star", "odd", "path", "two above", "loop"])
def test_components(spark, pairs):
    assert found(spark, pairs) == expected(pairs)


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    assert found(spark, pairs) == expected(pairs)


def test_stars_take_one_round(spark, monkeypatch):
    steps, star = [], module._star

    def counted(edges, large):
        steps.append(large)
        return star(edges, large)

    monkeypatch.setattr(module, "_star", counted)
    assert found(spark, [(2, 1), (3, 1), (9, 7)]) == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7}
    assert steps == [True, False]
