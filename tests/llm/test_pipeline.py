"""The pipeline's stages on their own inputs, and as a whole."""

from collections import Counter

import corpus_pipeline
from helpers import SAMPLE, documents
from metricloom.llm.storage import read, stored
from test_decontaminate import by_hand as leaks_by_hand
from test_jaccard_join import by_hand as components_by_hand
from test_line_frequency import judged_by_hand

NAMES = list(corpus_pipeline.COLUMNS)


def test_each_stage_on_the_sample(spark):
    docs = read(spark, SAMPLE, "documents")
    (_, rules), (_, lines), (_, near), (_, leaks), (_, mixing) = corpus_pipeline.STAGES

    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in judged_by_hand(rows, 10, 75) if r["kept"]}
    docs = stored(rules(spark, docs, SAMPLE), "test")
    assert docs.columns == NAMES and {r["doc_id"] for r in docs.collect()} == kept

    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = stored(lines(spark, docs, SAMPLE), "test")
    after = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.columns == NAMES
    having = Counter()
    for text in set(before.values()):
        having.update({x.strip(" \t\n\x0b\x0c\r").lower() for x in text.split("\n")} - {""})
    for i, text in before.items():
        rest = [x for x in text.split("\n") if having[x.strip(" \t\n\x0b\x0c\r").lower()] < 10]
        gone = [x for x in text.split("\n") if x not in rest]
        left = after.get(i, "").split("\n")
        assert [x for x in left if x in rest or not x.strip()] == (rest if i in after else left)
        assert set(left) - set(rest) <= set(gone) | {""}
    assert set().union(*(t.split("\n") for t in before.values())) - set().union(
        *(t.split("\n") for t in after.values())
    ) <= {x for x in set().union(*(t.split("\n") for t in before.values())) if having[x.strip().lower()] >= 10 or not x.strip()}

    expected = {c for _, _, c in components_by_hand(after)}
    docs = stored(near(spark, docs, SAMPLE), "test")
    assert docs.columns == NAMES and {r["doc_id"] for r in docs.collect()} == expected

    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in read(spark, SAMPLE, "benchmark").collect()]
    leaked = {d for d, _ in leaks_by_hand(texts, items)}
    docs = stored(leaks(spark, docs, SAMPLE), "test")
    assert docs.columns == NAMES and {r["doc_id"] for r in docs.collect()} == expected - leaked

    mixed = mixing(spark, docs, SAMPLE)
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_stages_take_edge_rows(spark):
    docs = documents(spark, [None, "", "a " * 40, "a " * 40], [None, 1, 2, 2], [None, None, "x", "x"])
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, SAMPLE).count() <= 4


def test_run(spark):
    out = corpus_pipeline.run(spark, SAMPLE)
    assert out.columns[: len(NAMES)] == NAMES and 0 < out.count() < 1000
