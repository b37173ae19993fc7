"""Search against scoring every document for every item."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents
from metricloom.llm import lexical_search as search


def brute(texts, items, best=10):
    terms = [search.terms_of(t) for t in texts]
    counted = [(i, t) for i, t in enumerate(terms) if t]
    n_docs, n_terms = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, t in counted:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = set()
    for item, text in items:
        scores = []
        for i, t in counted:
            m = 10 + 90 * len(t) * n_docs // n_terms
            score = sum(
                search.weight(n_docs, df[q])
                * (1_000_000_000 * t.count(q) // (1000 * t.count(q) + 8 * m))
                for q in set(search.terms_of(text)) & set(t)
            )
            if score > 0:
                scores.append((-score, i))
        out |= {(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:best])}
    return out


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made_up(seed, n_docs):
    """Words by a steep law, many equal texts, some empty, one very long."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "a_b", "X9"]
    odds = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, odds, k=rng.randint(1, 60))) for _ in range(n_docs)]
    texts += texts[:40] + [None, "", " \n", "...", " ".join(rng.choices(words, odds, k=30_000))]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(40)]
    return texts, [*items, (90, None), (91, ""), (92, "unheard of"), (93, "w0 w0 W0"), (None, "w1")]


def tables(spark, texts, items):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return documents(spark, texts), asked


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpora(spark, monkeypatch, seed):
    monkeypatch.setattr(search, "BUCKET", 32)
    texts, items = made_up(seed, 600)
    docs, asked = tables(spark, texts, items)
    expected = brute(texts, [i for i in items if i[0] is not None])
    got = found(search.search(docs.repartition(3), asked, block_terms=150))
    assert got == expected


def test_bounds_rule_out_most(monkeypatch):
    """Without what the two bounds rule out, far fewer documents are scored in whole numbers."""
    import pyarrow as pa

    monkeypatch.setattr(search, "BUCKET", 64)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    lists = [[rng.choice(words) for _ in range(rng.randint(2, 80))] for _ in range(3000)]
    rows = [(0, [(w, 2000 if i else 9000) for i, w in enumerate(words[:6])])]
    block = search.Block(rows, 3000, sum(map(len, lists)), 10)
    scored = []
    keep = search.Block._keep
    monkeypatch.setattr(
        search.Block, "_keep", lambda s, i, x, d: (scored.extend(d), keep(s, i, x, d))[1]
    )
    buckets = []
    inside = search.Block._bucket
    monkeypatch.setattr(
        search.Block, "_bucket", lambda s, *a: (buckets.append(len(a[1])), inside(s, *a))[1]
    )
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(3000)),
            pa.array([len(t) for t in lists]),
            pa.array([sorted(set(t)) for t in lists]),
            pa.array([[t.count(w) for w in sorted(set(t))] for t in lists], pa.list_(pa.int32())),
        ],
        names=["doc_id", "n", "terms", "tfs"],
    )
    block.add(batch)
    holders = sum(any(w in t for w in words[:6]) for t in lists)
    assert len(scored) < holders / 2
    assert sum(buckets) < holders


def test_ties_by_document(spark):
    texts = ["same words here"] * 25 + ["other"]
    docs, items = tables(spark, texts, [(1, "same")])
    got = found(search.search(docs, items))
    assert {(r, d) for _, r, d, _ in got} == {(i + 1, i) for i in range(10)}


def test_nulls_clashes_and_empty_tables(spark):
    docs, items = tables(spark, ["one two", "two"], [(1, "two"), (1, "one")])
    more = docs.withColumn("item_id", F.lit(5)).withColumn("terms", F.lit(6))
    more = more.withColumn("n", F.lit(7))
    asked = items.withColumn("doc_id", F.lit(3)).withColumn("term", F.lit("x"))
    assert found(search.search(more, asked)) == brute(["one two", "two"], [(1, "two one")])
    nameless = documents(spark, ["one", "one two"], [None, 4])
    (row,) = search.search(nameless, items).where("rank = 1").collect()
    assert row.doc_id == 4
    assert search.search(docs.limit(0), items).collect() == []
    assert search.search(docs, items.limit(0)).collect() == []


def test_filter_holds_all_terms(spark):
    terms = [f"term{i}" for i in range(500)] + ["日本", "ü"]
    bits = search.term_filter(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert len(bits) * 8 == search.FILTER_BITS
    import zlib

    places = {zlib.crc32(t.encode()) % search.FILTER_BITS for t in terms}
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == places
