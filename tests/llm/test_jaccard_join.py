"""The near-duplicate join against comparing all pairs that share a shingle."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SAMPLE, documents, lower, words
from metricloom.llm import jaccard_join as jj
from metricloom.llm.storage import read


def shingles(text):
    w = words(lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


class Union:
    def __init__(self):
        self.above = {}

    def top(self, x):
        while self.above.setdefault(x, x) != x:
            x = self.above[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)


def by_hand(texts):
    """texts: id -> text. (id, set size, smallest id in the component)."""
    sets = {i: shingles(t) for i, t in texts.items()}
    having, both, union = defaultdict(list), Counter(), Union()
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    for ids in having.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    return sorted((i, len(s), union.top(i)) for i, s in sets.items())


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_sample(spark):
    docs = read(spark, SAMPLE, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    expected = by_hand(texts)
    assert len({c for _, _, c in expected}) < len(texts)
    assert got(jj.near_duplicates(docs)) == expected


def edited(draw, w, edits):
    w = list(w)
    for _ in range(edits):
        w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
    return w


def families(seed, n, sizes, length):
    """Texts edited from texts edited before, so that links at the edge of the limit abound."""
    draw, texts = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for size in sizes:
        family = [[f"w{draw.randrange(5000)}" for _ in range(draw.randint(*length))]]
        for _ in range(size):
            w = edited(draw, draw.choice(family), draw.randint(0, 4))
            if draw.random() < 0.2:
                cut = draw.randrange(len(w))
                w = w[cut:] + w[:cut] if draw.random() < 0.3 else w[: max(3, len(w) - draw.randint(1, 12))]
            family.append(w)
        texts += [" ".join(w) for w in family]
    for _ in range(n):
        w = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(20, 80))]
        at = draw.randrange(len(w))
        texts.append(" ".join(w[:at] + passage + w[at:]))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_at_the_limit(spark, seed):
    texts = families(seed, 60, [1, 2, 5, 40, 90], (8, 90))
    assert got(jj.near_duplicates(documents(spark, texts))) == by_hand(dict(enumerate(texts)))


def test_exact_when_groups_split_families_and_few_keys_find_them(spark, monkeypatch):
    """With tiny blocks and one minimum hash most links are left to the matrix."""
    monkeypatch.setattr(jj, "BLOCK", 3)
    monkeypatch.setattr(jj, "ASKERS", 2)
    monkeypatch.setattr(jj, "MINIMUM_HASHES", 1)
    texts = families(7, 40, [3, 30, 60], (10, 60))
    for share in (1e-3, 0.05):
        docs = documents(spark, texts).repartition(3)
        assert got(jj.near_duplicates(docs, frequent_share=share)) == by_hand(dict(enumerate(texts)))


def test_edge_texts(spark):
    base = " ".join(f"w{i}" for i in range(40))
    texts = [
        None, "", " \n", "one", "ONE", "one two", "one two three four", "One two  three\tfour", base, base.upper(),
        base + " more", base.replace(" ", "\n"), "a a a a a a a a", "a a a a a a", "é É", "É é", "x\x1cy", "x y",
        "  nbsp", " ".join(f"v{i}" for i in range(40_000)), " ".join(f"v{i}" for i in range(40_001)),
    ]
    docs = documents(spark, texts).selectExpr("*", "1 as h", "2 as r", "3 as keys")
    assert got(jj.near_duplicates(docs)) == by_hand(dict(enumerate(texts)))
    assert jj.near_duplicates(docs.limit(0)).collect() == []


def test_null_and_repeated_ids(spark):
    base = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [base, base, base + " x", None, base, "alone"], [None, 7, 5, None, 7, None])
    rows = Counter((r["doc_id"], r["component_id"]) for r in jj.near_duplicates(docs).collect())
    assert rows == Counter({(None, 5): 1, (7, 5): 2, (5, 5): 1, (None, None): 2})


def test_keep_one(spark):
    base = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [base, base + " x", base, "alone", None, "", base], [3, 2, 9, 4, 5, 6, 3])
    kept = jj.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6]
    assert kept.columns == docs.columns


def test_looked_at_tokens_suffice():
    """Linked sets share the bound's number of looked-at tokens under any order."""
    draw = random.Random(5)
    for _ in range(3000):
        a = set(range(draw.randint(1, 60)))
        b = {x for x in a if draw.random() < 0.93} | {100 + i for i in range(draw.randint(0, 6))}
        if b and jj.links(len(a), len(b), len(a & b)):
            rank = {x: draw.random() for x in a | b}
            pa, pb = (set(sorted(s, key=rank.get)[: jj.looked_at(len(s))]) for s in (a, b))
            larger = max(len(a), len(b))
            both = -(-75 * (len(a) + len(b)) // 175)
            assert len(pa & pb) >= both - -(-75 * larger // 100) + 1 + larger // jj.EXTRA


def test_similar_texts_below_the_limit(spark):
    """A family whose members mostly do not link: many ask, few links."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(edited(draw, base, draw.randint(1, 4))) for _ in range(250)]
    assert got(jj.near_duplicates(documents(spark, texts))) == by_hand(dict(enumerate(texts)))


def test_components_by_hand(spark):
    draw = random.Random(6)
    for n, m in ((300, 200), (60, 200), (500, 80)):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(m)]
        edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)]
        union = Union()
        for a, b in edges:
            union.join(a, b)
        labels = {r["node"]: r["label"] for r in jj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for e in edges for x in e if e[0] != e[1]}
        assert labels == {x: union.top(x) for x in nodes}


def test_word_hashes_follow_the_words():
    texts = ["", " ", "a", "A a", "a  b\tc\n", " x y ", "é É", "ab ba", "a" * 5000 + " " + "a" * 5000, "\x1c \x85 \xa0"]
    seen = {}
    for text in texts:
        found = lower(text).encode().split()
        hashes = jj.word_hashes(text).tolist()
        assert len(hashes) == len(found)
        for w, h in zip(found, hashes, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(3000)) + " " + "x" * 500 + "\n tail "
    whole = jj.word_hashes(text)
    for piece in (1, 7, 100):
        monkeypatch.setattr(jj, "PIECE", piece)
        assert np.array_equal(jj.word_hashes(text), whole)


def test_block_overlaps():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 60, 40).astype(np.uint64)) for _ in range(20)]
    block = jj.Block(list(range(20)), sets)
    for s in sets:
        expected = [i for i, x in enumerate(sets) if jj.links(len(x), len(s), len(np.intersect1d(x, s)))]
        assert block.linked(s, 75).tolist() == expected


def linked_sizes(most):
    """(n, m, tokens both have): the fewest shared by sets of n <= m that link."""
    for n in range(1, most):
        for m in range(n, most):
            both = -(-75 * (n + m) // 175)
            if both <= n:
                yield n, m, both


def test_no_link_is_ruled_out_when_own_tokens_come_first(spark):
    rows, groups = [], []
    pairs = list(linked_sizes(90))
    for i, (n, m, both) in enumerate(pairs):
        for h, size in ((2 * i, n), (2 * i + 1, m)):
            own = [(i << 20) + (h % 2 << 10) + j for j in range(size - both)]
            shared = [(i << 20) + (1 << 15) + j for j in range(both)]
            rows += [(t, h, size, False) for t in (own + shared)[: jj.looked_at(size)]]
            groups.append((h, h, 1, h))
    first = spark.createDataFrame(rows, "token long, h long, n long, often boolean")
    units = spark.createDataFrame(groups, "h long, unit long, size long, g long")
    asked = {(r["h"], r["other"]) for r in jj._askers(first, units, 75).collect()}
    assert [p for i, p in enumerate(pairs) if (2 * i, 2 * i + 1) not in asked] == []


def test_shared_looked_at_tokens_of_all_sizes():
    for n, m, both in linked_sizes(500):
        a, b = jj.looked_at(n), jj.looked_at(m)
        in_both = min(max(0, a - (n - both)), max(0, b - (m - both)), both)
        assert in_both >= 1 + m // jj.EXTRA and jj.left_unseen(n) <= jj.left_unseen(m)


def test_bound_is_the_least_of_all_sizes(spark):
    pairs = defaultdict(list)
    for n, m, _ in linked_sizes(130):
        pairs[n].append(m)
        pairs[m].append(n)
    draw, rows = random.Random(2), []
    for n, sizes in pairs.items():
        for _ in range(6):
            low, high = sorted(draw.choices(sizes, k=2))
            needed = min(-(-75 * (n + m) // 175) - jj.left_unseen(max(n, m)) for m in range(low, high + 1))
            rows.append((n, low, high, needed))
    table = spark.createDataFrame(rows, "n long, low long, high long, needed long")
    bound = jj._needed_in_range(F.col("n"), F.col("low"), F.col("high"), 75)
    assert table.where(bound != F.col("needed")).collect() == []
