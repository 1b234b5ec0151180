"""Connected components against a plain version; what a round asks of the driver."""

import random
import re

import pytest

from caprank.llm import components as c
from caprank.llm.common import prepare, written


@pytest.fixture(scope="module")
def s(spark):
    prepare(spark)
    return spark


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def found(spark, links):
    rows = c.components(spark.createDataFrame(links, "a long, b long")).collect()
    out = {r["node"]: r["component"] for r in rows}
    assert len(out) == len(rows)
    return out


def test_components_match_plain_python(s):
    pick = random.Random(5)
    mixed = [(pick.randrange(-200, 200), pick.randrange(-200, 200)) for _ in range(260)]
    mixed += [(i + 1, i) for i in range(1000, 1090)] + [(2000, 2000 + i) for i in range(1, 60)] + [(3000 - i, 3000) for i in range(1, 60)]
    mixed += [(None, 5), (7, None), (None, None), (9999, 9999), mixed[0], mixed[0][::-1]]
    assert found(s, mixed) == plain(mixed)
    assert found(s, []) == {} and found(s, [(None, 1), (4, 4)]) == {}
    assert found(s, [(1, 2), (2, 3)]) == {1: 1, 2: 1, 3: 1} and found(s, [(1, 3), (2, 3)]) == {1: 1, 2: 1, 3: 1}


def test_stars_need_no_round(s, monkeypatch):
    names = []
    monkeypatch.setattr(c, "written", lambda df, name: names.append(name) or written(df, name))
    links = [(1, 5), (7, 1), (1, 7), (20, 21)]
    assert found(s, links) == plain(links) and names == ["links"]
    names.clear()
    links = [(5, 1), (5, 3), (5, 9), (30, 31)]  # one round, and none to see that nothing changes
    assert found(s, links) == plain(links) and names == ["links", "star"]


def test_plan_of_a_round_stays_small(s):
    """The driver's memory is the plans of the rounds: before, a round read its edges
    16 times and shuffled or broadcast them 15 times on paper."""
    edges = written(s.createDataFrame([(5, 1), (9, 5), (9, 8)], "u long, v long"), "edges")
    plan = c._small_star(c._large_star(edges))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) <= 4
    assert len(re.findall("Exchange", plan)) <= 8
