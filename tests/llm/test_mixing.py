"""Mixtures against a plain one-machine version."""

import math

import pytest

from flightloom.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, n_tokens int, key string"


def docs(spark, n=600):
    rows = []
    for i in range(n):
        source = "Big Source" if i % 3 else ("small" if i % 2 else "mid")
        rows.append((i, f"word{i} is text " * (1 + i % 23), source, 1, "clash"))
    rows += [(10_000, None, "small", 1, ""), (10_001, "", "small", 1, ""), (10_002, "no source", None, 1, ""), (10_003, "not wanted", "other", 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


TARGETS = [("big_source", 0.3, 1), ("SMALL", 0.5, 3), ("mid", 0.1, 2), ("absent", 0.1, 2)]


def brute(sized, plan):
    out = {}
    for s, p in plan.items():
        own = sorted((r for r in sized if r.source == s), key=lambda r: (-r.key, r.doc_id))
        run = 0
        for r in own:
            run += r.n_tokens
            copies = p["epochs"] + (1 if run <= p["rest"] and p["rest"] > 0 else 0)
            if copies:
                out[r.doc_id] = copies
    return out


@pytest.mark.parametrize("per_range", [1, 20, 100_000])
@pytest.mark.parametrize("total", [None, 3000.0])
def test_mixture_equals_brute_force(spark, per_range, total):
    d = docs(spark)
    mixed, report = M.mixture(d, targets(spark, TARGETS), total, rows_per_range=per_range)
    sized = M.sized(d).collect()
    sums = {}
    for r in sized:
        if r.source:
            sums[r.source] = sums.get(r.source, 0) + r.n_tokens
    plan = M.plan_mixture(list(sums.items()), [(s.lower(), a, b) for s, a, b in TARGETS], total)
    assert {r.doc_id: r.copies for r in mixed.collect()} == brute(sized, plan)
    shares = {r.source: r for r in report.collect()}
    assert shares["absent"].status == "no documents" and shares["other"].status == "no target"
    assert math.isclose(sum(r.actual_share or 0 for r in shares.values()), 1.0)
    for s, cap in (("small", 3), ("mid", 2), ("big_source", 1)):
        assert all(r.copies <= cap for r in mixed.where(f"source = '{s}'").collect())
        if total is None:
            assert abs(shares[s].actual_share - shares[s].planned_share) < 0.02


def test_complete_epochs_come_first(spark):
    mixed, _ = M.mixture(docs(spark), targets(spark, [("mid", 0.5, 5), ("small", 0.5, 5)]))
    for s in ("mid", "small"):
        copies = {r.copies for r in mixed.where(f"source = '{s}' AND n_tokens > 0").collect()}
        assert max(copies) - min(copies) <= 1 and min(copies) >= 4


def test_counts_are_those_of_the_tokenizer(spark):
    encoding = M._encoding(M.VOCABULARY)
    texts = ["It's 1,234 words — naïve!", "a" * 5000, "\n\n  x", "日本"]
    d = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r.n_tokens for r in M.sized(d).collect()}
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in enumerate(texts)}
    assert all(encoding.decode(encoding.encode_ordinary(t)) == t for t in texts)


def test_nothing_to_mix(spark):
    mixed, report = M.mixture(docs(spark).limit(0), targets(spark, TARGETS))
    assert mixed.collect() == [] and {r.status for r in report.collect()} == {"no documents"}
    mixed, report = M.mixture(docs(spark), targets(spark, []))
    assert mixed.collect() == [] and {r.status for r in report.collect()} == {"no target"}
