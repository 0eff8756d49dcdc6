import random

import pytest

from cauldra.llm import mixing

DOCS, TARGETS = "doc_id long, source string, tokens long", "source string, target_share double, max_repeats int"


def run(spark, docs, targets, **kw):
    t = spark.createDataFrame(targets, TARGETS)
    sel = mixing.mix(spark.createDataFrame(docs, DOCS), t, **kw)
    return sel.collect(), {r["source"]: r for r in mixing.shares(sel, t).collect()}


@pytest.mark.parametrize("range_rows", [7, 10_000])
def test_shares_and_caps(spark, range_rows):
    r = random.Random(1)
    docs = [(i, "big" if i % 10 else "small", r.randint(1, 40)) for i in range(3000)]
    rows, shares = run(spark, docs, [("big", 0.6, 1), ("small", 0.4, 3)], range_rows=range_rows)
    assert abs(shares["small"]["share"] - 0.4) < 0.005 and shares["small"]["most_repeats"] == 3
    assert max(x["repeats"] for x in rows if x["source"] == "big") == 1
    # The small source is what binds: it is used to its cap.
    assert shares["small"]["tokens"] == 3 * sum(t for _, s, t in docs if s == "small")


def test_running_sums_equal_brute_force(spark):
    docs = [(i, "s", (i * 7) % 11 + 1) for i in range(500)]
    df = spark.createDataFrame(docs, DOCS)
    a = {r["doc_id"]: r["before"] for r in mixing.running_sums(df, 1).collect()}
    b = {r["doc_id"]: r["before"] for r in mixing.running_sums(df, 64).collect()}
    assert a == b
    order, total = sorted(a, key=a.get), 0
    size = {i: n for i, _, n in docs}
    for i in order:
        assert a[i] == total
        total += size[i]


def test_given_total_and_edges(spark):
    docs = [(1, "a", 10), (2, "a", 10), (3, None, 5), (4, "b", 0), (5, "b", None), (6, "other", 9)]
    rows, shares = run(spark, docs, [("a", 0.5, 2), ("b", 0.3, 2), ("none", 0.2, 1)], total=20)
    assert sum(x["tokens"] * x["repeats"] for x in rows) == 10 and {x["source"] for x in rows} == {"a"}
    assert shares["b"]["tokens"] == 0 and shares["none"]["share"] == 0.0 and shares["a"]["share"] == 1.0
    rows, _ = run(spark, docs, [("a", 1.0, 2)], total=1000)
    assert [x["repeats"] for x in rows] == [2, 2]
    rows, shares = run(spark, [], [("a", 1.0, 2)])
    assert rows == [] and shares["a"]["share"] == 0.0
