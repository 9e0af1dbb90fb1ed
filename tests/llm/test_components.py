import random

import pytest

from brookhouse.llm.components import components


@pytest.mark.parametrize("edges", [
    [(1, 2), (2, 3), (None, 4), (5, None), (6, 6)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] * 2,
    [tuple(random.Random(i).sample(range(120), 2)) for i in range(80)], [],
])
def test_smallest_node_of_each_component(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    for a, b in real:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in real:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
