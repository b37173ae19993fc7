"""Mixing: Pfair windows, exact shares, whole results."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from helpers import SAMPLE, dicts, documents
from metricloom.llm import mixing
from metricloom.llm.storage import read


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 300])
def test_less_than_one_block_from_the_given_weights_after_every_slot(n):
    draw = random.Random(n)
    given = {f"s{i}": round(draw.random() ** 3 + 1e-4, 5) for i in range(n)}
    whole = sum(Fraction(str(w)) for w in given.values())
    shares = mixing.exact_weights(given)
    assert shares == {s: Fraction(str(w)) / whole for s, w in given.items()}
    seen = Counter()
    for t, s in enumerate(mixing.schedule(shares, 20_000), 1):
        seen[s] += 1
        if n <= 40 or t % 97 == 0:
            assert all(abs(seen[x] - w * t) < 1 for x, w in shares.items())


def test_given_weights_are_met_exactly():
    for weights in ({"a": 0.7, "b": 0.2, "c": 0.1}, {"a": 7, "b": 2, "c": 1}):
        shares = mixing.exact_weights(weights)
        assert mixing.period_of(shares) == 10
        assert Counter(mixing.schedule(shares, 20_000)) == {"a": 14_000, "b": 4_000, "c": 2_000}
    thirds = mixing.exact_weights({s: 1 / 3 for s in "abc"})
    assert mixing.period_of(thirds) == 3
    for bad in ({"a": -1, "b": 2}, {"a": 0, "b": 2}, {}):
        with pytest.raises(ValueError):
            mixing.exact_weights(bad)


def test_repeated_and_cut_short_periods(spark):
    docs = documents(spark, [f"t{i}" for i in range(400)], sources=["ab"[i % 4 == 0] for i in range(400)])
    for weights in ({"a": 3, "b": 1}, {"a": "0.70001", "b": "0.29999"}, {"a": 1, "b": 9}):
        rows = dicts(mixing.mix(docs, weights, block_documents=4))
        assert len({r["doc_id"] for r in rows}) == len(rows) == 400
        turns, length = check(rows, 4)
        shares = mixing.exact_weights(weights)
        for s, at in turns.items():
            for t in range(1, length + 1):
                assert abs(sum(x < t for x in at) - shares[s] * t) < 1
        slots = sorted({r["slot"] for r in rows})
        expected = mixing.schedule(shares, slots[-1] + 1)
        assert all(expected[r["slot"]] == r["source"] for r in rows)


def check(rows, block):
    by_source = defaultdict(list)
    slots = defaultdict(set)
    for r in rows:
        by_source[r["source"]].append((r["slot"], r["place"], r["block"]))
        slots[r["slot"]].add(r["source"])
    assert all(len(s) == 1 for s in slots.values())
    for places in by_source.values():
        places.sort()
        assert [b * block + p for _, p, b in places] == list(range(len(places)))
    on = sorted({r["slot"] for r in rows if r["on_target"]})
    assert on == list(range(len(on)))
    return {s: [x for x in on if s in slots[x]] for s in by_source}, len(on)


def test_sample_is_whole_and_on_target(spark):
    docs = read(spark, SAMPLE, "documents")
    rows = dicts(mixing.mix_report(docs))
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    sizes = Counter(r["source"] for r in rows)
    weights = mixing.exact_weights({s: math.ceil(n**0.5) for s, n in sizes.items()})
    turns, length = check(rows, mixing.BLOCK_DOCUMENTS)
    assert length > 10
    for s, at in turns.items():
        for t in range(1, length + 1):
            assert abs(sum(x < t for x in at) - weights[s] * t) < 1


def test_order_does_not_depend_on_partitions_or_buckets(spark):
    docs = read(spark, SAMPLE, "documents")
    def key(r):
        return r["doc_id"]
    one = sorted(dicts(mixing.mix_report(docs)), key=key)
    columns = ("doc_id", "source", "block", "slot", "place", "on_target")
    many = dicts(mixing.mix(docs.repartition(7), rows_per_bucket=20).select(*columns))
    assert sorted(many, key=key) == one


def test_edge_rows(spark):
    docs = documents(spark, ["a", None, "a", "b", ""], [None, None, None, 1, 1], ["x", None, "x", "", "y"])
    rows = dicts(mixing.mix(docs.selectExpr("*", "1 as slot", "2 as _bucket", "3 as `a.b`"), block_documents=2))
    assert len(rows) == 5 and {r["a.b"] for r in rows} == {3} and {r["_bucket"] for r in rows} == {2}
    check([r | {"source": r["source"] or ""} for r in rows], 2)
    assert mixing.mix(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs, {"x": 1})
