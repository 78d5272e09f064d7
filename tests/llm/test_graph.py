"""Components against a plain union of sets, and how many tasks few links take."""

import random

from gleanwell.llm import graph


def test_few_links_take_few_tasks(spark, monkeypatch):
    rnd = random.Random(1)
    links = [(rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(290)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(1900, 2000)] + [(None, 7), (7, 7)]
    least = {}

    def top(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in links:
        if a is not None:
            a, b = top(a), top(b)
            least[max(a, b)] = min(a, b)
    expected = sorted((x, top(x)) for x in least if top(x) != x)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for per_task, files in ((20_000, 2), (40, 12)):
            monkeypatch.setattr(graph, "LINKS", per_task, raising=False)
            found = graph.contracted(spark.createDataFrame(links, "a long, b long"))
            assert sorted(map(tuple, found.collect())) == expected
            assert len(found.inputFiles()) <= files
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
