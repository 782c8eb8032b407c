"""The fixed point of pattern trust, at any number of unknown instances."""

import math

import pytest

from extracteval.llm.pii import link_groups, settle

PATTERNS = "kind string, pattern string, base double, size double"
LINKS = "kind string, `group` string, pattern string, n bigint, weight bigint"


def plain(patterns, links, rounds):
    """The two formulas in turns, as they are written."""
    trust = {p: b / s for _, p, b, s in patterns}
    for _ in range(rounds):
        score = {}
        for _, g, p, _, _ in links:
            score[g] = score.get(g, 1.0) * (1 - trust[p])
        trust = {p: (b + sum(n * w * (1 - score[g]) for _, g, q, n, w in links if q == p)) / s for _, p, b, s in patterns}
    return trust


@pytest.mark.parametrize("unknown", [100, 10**6, 10**7, 10**12])
def test_one_pattern_settles_at_its_limit_in_few_rounds(spark, unknown):
    patterns = spark.createDataFrame([("phone", "call", 10.0, 10.0 + unknown + 1)], PATTERNS)
    links = spark.createDataFrame([("phone", "g", "call", 1, unknown)], LINKS)
    trust, score, rounds = settle(links, patterns, 1e-6)
    assert rounds <= 5
    assert trust.first().trust == pytest.approx(10 / 11, abs=1e-6) and score.first().score == pytest.approx(10 / 11, abs=1e-6)


@pytest.mark.parametrize("unknown", [100, 10**7])
def test_shared_patterns_settle_in_a_bounded_number_of_rounds(spark, unknown):
    rows = [("email", "to", 10.0, 10.0 + 2 * unknown + 1), ("email", "write to", 4.0, 4.0 + unknown + 6), ("email", "at", 0.0, unknown + 5.0)]
    tied = [("email", "a", "to", 1, unknown), ("email", "a", "write to", 1, unknown), ("email", "b", "to", 1, unknown), ("email", "c", "at", 1, 3)]
    trust, _, rounds = settle(spark.createDataFrame(tied, LINKS), spark.createDataFrame(rows, PATTERNS), 1e-6)
    assert rounds <= 50
    got = {r.pattern: r.trust for r in trust.collect()}
    # a fixed point of both formulas
    after = {}
    for _, p, base, size in rows:
        gained = 0.0
        for _, g, q, n, w in tied:
            if q == p:
                gained += n * w * (1 - math.prod(1 - got[x] for _, h, x, _, _ in tied if h == g))
        after[p] = (base + gained) / size
    assert all(after[p] == pytest.approx(got[p], abs=2e-6) for p in got)
    if unknown == 100:
        assert got == pytest.approx(plain(rows, tied, 20_000), abs=2e-6)


def test_equal_instances_are_one_weighted_group(spark):
    rows = [("ip", "host", f"i{k}", 1) for k in range(50)] + [("ip", "host", "x", 2), ("ip", "host", "y", 1), ("ip", "at", "y", 1)]
    links, members = link_groups(spark.createDataFrame(rows, "kind string, pattern string, instance string, n bigint"))
    assert sorted((r.pattern, r.n, r.weight) for r in links.collect()) == [("at", 1, 1), ("host", 1, 1), ("host", 1, 50), ("host", 2, 1)]
    assert members.count() == 52
