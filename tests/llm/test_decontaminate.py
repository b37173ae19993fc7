"""Benchmark leaks against edit distances to every place of every text."""

import random
import re

import numpy as np

from helpers import SMALL, dicts, documents
from metricloom.llm import decontaminate as dc
from metricloom.llm.storage import read


def fewest_by_hand(item, text):
    """Fewest word edits from item to any run of text's words."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    piece = np.array([codes.get(w, 0) for w in text])
    row = np.zeros(len(text) + 1, int)
    for i, w in enumerate(item, 1):
        best = np.minimum(row[:-1] + (piece != codes[w]), row[1:] + 1)
        new = np.concatenate(([i], best))
        # Insertions run along the row.
        at = np.arange(len(new))
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def by_hand(texts, items, percent=20):
    found = {}
    split = {i: re.findall(r"\w+", (t or "").lower()) for i, t in items}
    for d, text in texts:
        w = re.findall(r"\w+", (text or "").lower())
        for i, item in split.items():
            if len(item) >= dc.LEAST_WORDS:
                edits = fewest_by_hand(item, w)
                if edits <= len(item) * percent // 100:
                    found[d, i] = edits
    return found


def got(df):
    return {(r["doc_id"], r["item_id"]): r["n_edits"] for r in dicts(df)}


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_sample(spark):
    docs, benchmark = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")
    expected = by_hand(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in benchmark.collect()],
    )
    assert expected and got(dc.find_leaks(docs, benchmark)) == expected
    kept = {r["doc_id"] for r in dc.without_leaks(docs, benchmark).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in expected}


def planted(seed, n_items, per_item):
    draw = random.Random(seed)
    common = [f"c{i}" for i in range(40)]

    def prose(n):
        return [draw.choice(common) if draw.random() < 0.5 else f"w{draw.randrange(3000)}" for _ in range(n)]

    items = [prose(draw.randint(8, 60)) for _ in range(n_items)]
    texts = []
    for item in items:
        for _ in range(per_item):
            w = list(item)
            for _ in range(draw.randint(0, len(item) * 20 // 100)):
                at = draw.randrange(len(w))
                w[at : at + 1] = draw.choice(([], ["new"], [w[at], "new"]))
            texts.append(" ".join(prose(draw.randint(0, 80)) + w + prose(draw.randint(0, 80))))
    return [(i, " ".join(x)) for i, x in enumerate(items)], texts


def test_recall_of_edited_passages(spark):
    items, texts = planted(1, 40, 10)
    texts += [None, "", "c1 c2 c3"]
    found = got(dc.find_leaks(documents(spark, texts), items_table(spark, items)))
    expected = by_hand(list(enumerate(texts)), items)
    assert len(expected) >= 380
    # What is found is right; what is missed is little, and nothing with few edits.
    assert all(found[k] == expected[k] for k in found) and set(found) <= set(expected)
    assert len(found) >= 0.95 * len(expected)
    light = {k for k, e in expected.items() if 100 * e <= 8 * len(items[k[1]][1].split())}
    assert len(light & set(found)) >= 0.99 * len(light)


def test_blocks_of_items_do_not_change_the_result(spark):
    items, texts = planted(2, 12, 3)
    docs, benchmark = documents(spark, texts), items_table(spark, items)
    one = got(dc.find_leaks(docs, benchmark))
    assert set(got(dc.find_leaks(docs, benchmark, block_size=5))) >= {k for k, e in one.items() if e == 0}
    assert dc.without_leaks(docs, benchmark, block_size=5).count() <= 2


def test_edge_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [(1, item), (2, None), (3, ""), (4, "too short"), (None, item + " lambda mu"), (5, item)]
    texts = [item.upper().replace(" ", ",\n"), "x " + item + " " + item, None, "", "alpha beta gamma " * 3000, item[:20], item + " x"]
    docs = documents(spark, texts, [0, None, 2, 3, 4, 5, 0]).selectExpr("*", "1 as item_id")
    rows = dicts(dc.find_leaks(docs, items_table(spark, items)))
    assert sorted({(str(r["doc_id"]), str(r["item_id"])) for r in rows}) == [
        (d, i) for d in ("0", "None") for i in ("1", "5", "None")
    ]
    assert len(rows) == 9
    kept = dc.without_leaks(docs, items_table(spark, items))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5] and kept.columns == docs.columns
    assert dc.find_leaks(docs.limit(0), items_table(spark, items)).collect() == []
    empty = items_table(spark, items).limit(0)
    assert dc.find_leaks(docs, empty).collect() == [] and dc.without_leaks(docs, empty).count() == 7


def test_a_piece_is_left_whole_by_the_edits_allowed():
    draw = random.Random(6)
    for n in range(dc.LEAST_WORDS, 70):
        items = dc.Items([(1, " ".join(f"w{i}" for i in range(n)))])
        for _ in range(10):
            w = list(items.items[0])
            for _ in range(items.edits[0]):
                at = draw.randrange(len(w))
                w[at : at + 1] = draw.choice(([], [0], [w[at], 0], [0, w[at]]))
            assert len(items.windows(np.array([0] * 5 + w + [0] * 5, np.int64))[0])


def test_fewest_edits():
    draw = random.Random(4)
    for _ in range(400):
        item = [draw.randint(1, 4) for _ in range(draw.randint(1, 70))]
        text = [draw.randint(0, 4) for _ in range(draw.randint(0, 90))]
        edits, end = dc.fewest_edits(item, np.array(text, np.int64))
        assert edits == fewest_by_hand(item, text)
        assert 0 <= end <= len(text)


def test_all_passages_with_the_most_edits_are_found():
    draw = random.Random(8)
    for n in (60, 63, 100, 150, 250):
        items = dc.Items([(i, " ".join(f"i{i}w{j}" for j in range(n))) for i in range(3)], exact=True)
        for kinds in (("cut",), ("cut", "swap", "add")):
            for t in [0, 1, 2] * 4:
                w = [[x] for x in items.items[t]]
                for at in draw.sample(range(n), n * 20 // 100):
                    kind = draw.choice(kinds)
                    w[at] = {"cut": [], "swap": [0], "add": [*w[at], 0]}[kind]
                w = [x for xs in w for x in xs]
                codes = np.array([0] * draw.randint(0, 90) + w + [0] * draw.randint(0, 400) + w[:40], np.int64)
                found = items.leaks(codes)
                assert found == {t: dc.fewest_edits(items.items[t], codes)}, (n, kinds)


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "今天天气很好我们一起去公园散步然后回家吃饭"
    items = [(1, "four words are enough"), (2, "five words with one edit"), (3, "yes"), (4, chinese), (5, "...")]
    texts = [
        "so four words, are enough here", "four words were enough", "x five words without one edit x", "five words out one",
        "oh YES", "yesterday", "前" + chinese[:5] + "不" + chinese[6:] + "后", chinese[:9], "",
    ]
    found = got(dc.find_leaks(documents(spark, texts), items_table(spark, items)))
    assert found == {(0, 1): 0, (2, 2): 1, (4, 3): 0, (6, 4): 1}
    assert dc.words_of("Tea 茶, caféสวน") == ["tea", "茶", "café", "ส", "ว", "น"]


def edited(draw, item, kinds):
    """A passage with as many edits as an item may have, all of them of these kinds."""
    w = [[x] for x in item]
    for at in draw.sample(range(len(item)), len(item) * dc.EDIT_PERCENT // 100):
        w[at] = {"cut": [], "swap": [0], "add": [w[at][0], 0]}[draw.choice(kinds)]
    return [x for xs in w for x in xs]


def passages(draw, items, n, kinds, times):
    for _ in range(times):
        w = edited(draw, items.items[0], kinds)
        yield np.array([0] * draw.randint(0, 90) + w + [0] * draw.randint(0, 90), np.int64)


def test_recall_at_the_most_edits_by_length_and_kind():
    draw = random.Random(12)
    for n, times in ((5, 80), (20, 80), (60, 60), (150, 40), (250, 25)):
        text = " ".join(f"w{j}" for j in range(n))
        items, exact = dc.Items([(0, text)]), dc.Items([(0, text)], exact=True)
        for kinds in (("cut",), ("add",), ("swap",), ("cut", "swap", "add")):
            both = [(items.leaks(c), exact.leaks(c)) for c in passages(draw, items, n, kinds, times)]
            assert all(e for _, e in both) and all(f in ({}, e) for f, e in both)
            assert sum(bool(f) for f, _ in both) >= 0.95 * times, (n, kinds)


def test_the_walks_choose_the_candidates():
    draw = random.Random(13)
    n = 100
    items = dc.Items([(0, " ".join(f"w{j}" for j in range(n)))])
    # Passages share one piece of the item only: all have windows, few are verified.
    starts = [i * n // (items.edits[0] + 1) for i in range(items.edits[0] + 1)]
    pieces = [np.array([0] * 120 + items.items[0][at : at + 4] + [0] * 120) for at in starts]
    windows = [items.windows(c) for c in pieces]
    assert all(len(t) for t, _ in windows)
    chosen = [len(items.candidates(c, *w)) for c, w in zip(pieces, windows, strict=True)]
    assert sum(chosen) <= 0.7 * len(pieces)
    # Without repetitions nothing is chosen; a lower recall takes fewer and chooses less.
    whole = [*passages(draw, items, n, ("cut", "swap", "add"), 60)]
    low = dc.Items([(0, " ".join(f"w{j}" for j in range(n)))], recall=0.3)
    assert low.repetitions[0] < items.repetitions[0]
    assert sum(bool(low.leaks(c)) for c in whole) < sum(bool(items.leaks(c)) for c in whole)
    items.sampled_items = []
    assert not any(items.leaks(c) for c in whole)


def test_exact_finds_all_of_the_sample(spark):
    items, texts = planted(5, 20, 4)
    found = got(dc.find_leaks(documents(spark, texts), items_table(spark, items), exact=True))
    assert found == by_hand(list(enumerate(texts)), items)
