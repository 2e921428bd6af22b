import random
import re

import pytest

from quire.llm import mixing


def brute_targets(sizes):
    """Share by weight, freeze those above, share the rest again."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {n: rng.choice([0, 1, 5, 100, 10_000]) + rng.randrange(50) for n in ["b", "a", "Z", "é", "", None, "c", "d"][:rng.randint(1, 8)]}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source for r in got} == set(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r.source])
    assert sum(r.target for r in got) == pytest.approx(sum(sizes.values()))


def test_copies(make):
    docs = make([(i, "w " * (1 + i % 7), "en", "big" if i % 10 else "small") for i in range(4000)])
    rows = mixing.plan_mix(docs).select("_row.doc_id", "_row.source", "size", "source_size", "target", "copies").collect()
    again = {r.doc_id: r.copies for r in mixing.plan_mix(docs.orderBy("text")).select("_row.doc_id", "copies").collect()}
    taken = {}
    for r in rows:
        assert again[r.doc_id] == r.copies <= 3
        assert abs(r.copies - r.target / r.source_size) < 1
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    for s, t in {(r.source, r.target) for r in rows}:
        assert taken[s] == pytest.approx(t, rel=0.05)
    assert mixing.mix(docs).count() == sum(r.copies for r in rows)


def test_odd(odd, clashing):
    rows = mixing.plan_mix(odd).select("_row.text", "size").collect()
    assert len(rows) == odd.count()
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows)
    assert mixing.mix(clashing).columns == clashing.columns


def test_empty(odd):
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mix(odd.filter("text is null")).count() == 0


def test_joined_without_broadcast(spark, make):
    """Beyond the broadcast bound: the same plan, and a source of equal texts is spread."""
    from quire.operators.joins import CONF_MAX_ROWS
    docs = make([(i if i % 5 else None, "w w", "en", "big" if i % 10 else None) for i in range(600)])
    cols = ["_row.doc_id", "_row.source", "size", "source_size", "target", "copies"]
    want = sorted(map(str, mixing.plan_mix(docs).select(*cols).collect()))
    spark.conf.set(CONF_MAX_ROWS, "0")
    try:
        planned = mixing.plan_mix(docs)
        plan = planned._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, planned.select(*cols).collect()))
    finally:
        spark.conf.unset(CONF_MAX_ROWS)
    assert got == want and "_spread" in plan and "_salt" in plan
