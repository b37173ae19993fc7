"""Exact n-gram Jaccard self-join of documents with a token-group matrix.

A document's set is its distinct word shingles. Equal sets form a class, and only
classes take part. The join has four steps.

1. Groups. Classes that share a minimum hash are put into groups of bounded size,
   and each is compared exactly with the others of its groups. Of a class's groups
   the best filled is the one it is a member of from here on; a class without
   company is a group alone. Links found so far make components.
2. Matrix. Tokens have one global order, the corpus's frequent ones last. Of a set
   of n tokens only the first p(n) are looked at. The matrix has a row for each
   token and group whose union of such tokens holds it.
3. Bound. Two sets that link share a number of looked-at tokens that follows from
   their sizes. A query class whose tokens a group's union holds less often cannot
   link with a member. A query leaves out its commonest tokens, as many as the bound
   can spare. Of two groups the members of the smaller one ask; a group whose
   members are all in the query's component is not asked.
4. Opening. Groups that pass are opened: the query is compared exactly with each
   member. Links join components.

Every link between members of different groups passes the bound, so none is lost.
Pairs are compared inside a task, against an index of the group; they are never
formed as rows, and of a component's links a spanning forest is enough.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from metricloom.llm.storage import discard, stored

WORDS = 5
PERCENT = 75
MINIMUM_HASHES = 3
BLOCK = 128
# Askers of a group that one task compares with it; more are split, each with the group.
ASKERS = 256
# A token counts as frequent if it is in this share of the classes; at most
# (mean set size / share) tokens can be, about ten thousand per ten words of text.
FREQUENT_SHARE = 1e-3
# Tokens looked at beyond the fewest possible, as a share of the set (one in ten).
EXTRA = 10
# A query does not ask for tokens that more sets than this look at, up to those extra
# ones; what it must share with a group is less by as many.
COMMON = 8
# Parts into which the rows of a frequent token are dealt.
SALTS = 64

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Word hashing: a random number for each byte (upper case as lower) and for each
# place in a word; a word's hash is the sum of their products.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
BYTES[65:91] = BYTES[97:123]
PLACES = _mixed(np.arange(1000, 1000 + 4096, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)
# Of each of a shingle's words.
STEPS = _mixed(np.arange(9000, 9000 + 64, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)
# Longer texts are hashed in pieces that end at white space.
PIECE = 1 << 20
SPACES = re.compile(rb"[\x20\x09-\x0D]")


def _hashed_words(text: bytes) -> np.ndarray:
    """A hash of each word of bytes between white space (space, tab to carriage return)."""
    codes = np.frombuffer(text, np.uint8)
    space = SPACE[codes]
    at = np.arange(len(codes))
    # Where the word of each byte starts.
    start = np.maximum.accumulate(np.where(space, at + 1, 0))
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    place = at - start
    longest = int((ends - starts).max()) if len(starts) else 0
    places = PLACES
    if longest > len(places):
        more = np.arange(1000, 1000 + longest, dtype=np.uint64)
        places = _mixed(more * MULTIPLIER) | np.uint64(1)
    place[space] = 0
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(BYTES[codes] * places[place], out=sums[1:])
    return _mixed(sums[ends] - sums[starts])


def word_hashes(text: str) -> np.ndarray:
    data = text.encode()
    if len(data) <= PIECE:
        return _hashed_words(data)
    parts, at = [], 0
    while at < len(data):
        found = SPACES.search(data, at + PIECE)
        end = found.start() if found else len(data)
        parts.append(_hashed_words(data[at:end]))
        at = end
    return np.concatenate(parts)


def tokens_of(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; a shorter text is one shingle."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return np.empty(0, np.uint64)
    n = min(words, len(hashes))
    rolled = np.full(len(hashes) - n + 1, np.uint64(n))
    for i in range(n):
        rolled += hashes[i : len(hashes) - n + 1 + i] * STEPS[i % len(STEPS)]
    rolled = np.sort(_mixed(rolled))
    return rolled[np.diff(rolled, prepend=~rolled[:1]) != 0]


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit id of the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def left_unseen(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set that are not looked at; never fewer for a larger set.

    At most ceil(percent * n / 100) - 1 - n // EXTRA, which does fall here and there.
    """
    return max(0, -(-(percent * EXTRA - 100) * n // (100 * EXTRA)) - 1)


def looked_at(n: int, percent: int = PERCENT) -> int:
    return n - left_unseen(n, percent)


def links(a: int, b: int, both: int, percent: int = PERCENT) -> bool:
    return 100 * both >= percent * (a + b - both)


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens are in known, which is sorted."""
    if not len(known):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return known[at] == tokens


# --- per-task work -------------------------------------------------------------

# Rows that a task holds as Python and numpy values at once.
ROWS_AT_ONCE = 1024


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _profiles(words: int, percent: int, share: float):
    seeds = [_mixed(np.full(1, np.uint64(j + 1)) * MULTIPLIER)[0] for j in range(MINIMUM_HASHES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            rows: dict[str, list] = {name: [] for name in ("r", "doc_id", "n", "h", "keys")}
            fresh = []
            texts = batch.column(2).to_pylist()
            for r, doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True
            ):
                tokens = tokens_of(text, words)
                h = set_id(tokens) if len(tokens) else None
                rows["r"].append(r)
                rows["doc_id"].append(doc_id)
                rows["n"].append(len(tokens))
                rows["h"].append(h)
                rows["keys"].append(
                    [int(_mixed(tokens ^ s).min().view(np.int64)) for s in seeds]
                    if len(tokens)
                    else []
                )
                if h is not None and h not in seen:
                    seen.add(h)
                    fresh.append(tokens)
            token, count = [], []
            if fresh:
                every = np.sort(np.concatenate(fresh))
                edges = np.flatnonzero(np.diff(every, prepend=~every[:1], append=~every[-1:]))
                counts = np.diff(edges)
                often = counts >= max(2, share * len(fresh))
                token = every[edges[:-1]][often].view(np.int64)
                count = counts[often]
            n, m = len(texts), len(token)
            none = pa.nulls
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(rows["r"], pa.int64()), none(m, pa.int64())]),
                    pa.concat_arrays([pa.array(rows["doc_id"], pa.int64()), none(m, pa.int64())]),
                    pa.concat_arrays([pa.array(rows["n"], pa.int64()), none(m, pa.int64())]),
                    pa.concat_arrays([pa.array(rows["h"], pa.int64()), none(m, pa.int64())]),
                    pa.concat_arrays(
                        [
                            pa.array(rows["keys"], pa.list_(pa.int64())),
                            none(m, pa.list_(pa.int64())),
                        ]
                    ),
                    pa.concat_arrays([none(n, pa.int64()), pa.array(token, pa.int64())]),
                    pa.concat_arrays([none(n, pa.int64()), pa.array(count, pa.int64())]),
                ],
                ["r", "doc_id", "n", "h", "keys", "token", "count"],
            )

    return run


PROFILE_COLUMNS = (
    "r long, doc_id long, n long, h long, keys array<long>, token long, count long"
)


def _first_tokens(words: int, percent: int, frequent: np.ndarray):
    """(token, h, n, often): the looked-at tokens, once per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            parts = []
            for text in batch.column(0).to_pylist():
                tokens = tokens_of(text, words)
                if not len(tokens) or (h := set_id(tokens)) in seen:
                    continue
                seen.add(h)
                often = _among(tokens, frequent)
                order = np.concatenate([tokens[~often], tokens[often]])
                n_rare = len(tokens) - int(often.sum())
                p = looked_at(len(tokens), percent)
                parts.append(
                    (
                        order[:p].view(np.int64),
                        np.full(p, h),
                        np.full(p, len(tokens)),
                        np.arange(p) >= n_rare,
                    )
                )
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)],
                    ["token", "h", "n", "often"],
                )

    return run


class Block:
    """Sets with an index from token to set, for exact overlaps with one more set."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]) -> None:
        self.ids, self.sizes = ids, np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], owner[order]

    def linked(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Places of the sets that link with this one."""
        left = np.searchsorted(self.tokens, tokens, "left")
        right = np.searchsorted(self.tokens, tokens, "right")
        lengths = right - left
        total = int(lengths.sum())
        if not total:
            return np.empty(0, np.int64)
        at = np.repeat(left - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        both = np.bincount(self.owner[at + np.arange(total)], minlength=len(self.ids))
        return np.flatnonzero(100 * both >= percent * (self.sizes + len(tokens) - both))


def _grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, tuple]]:
    """(key, rest) of each row; rows come sorted by key."""
    for batch in _slices(batches):
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns, strict=True):
            yield row[:n_keys], row[n_keys:]


EDGE_COLUMNS = "a long, b long"


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64())}
    )


def _linked_in_blocks(words: int, percent: int):
    """Rows (j, key, block, h, text), sorted: a spanning forest of each block's links."""

    def forest(sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        ids = sorted(sets)
        if len(ids) < 2:
            return []
        block = Block(ids, [sets[h] for h in ids])
        above = list(range(len(ids)))

        def top(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        found = []
        for i, h in enumerate(ids):
            for j in block.linked(sets[h], percent):
                a, b = sorted((top(i), top(int(j))))
                if a != b:
                    above[b] = a
                    found.append((ids[a], ids[b]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for key, (h, text) in _grouped(batches, 3):
            if key != now:
                if out := forest(sets):
                    yield _edges(out)
                now, sets = key, {}
            if h not in sets:
                sets[h] = tokens_of(text, words)
        if out := forest(sets):
            yield _edges(out)

    return run


def _linked_to_groups(words: int, percent: int):
    """Rows (group, part, asks, h, component, text), sorted: links of components by askers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, own, block, done = None, {}, {}, None, set()
        for (group, part, asks), (h, component, text) in _grouped(batches, 3):
            if (group, part) != now:
                now, sets, own, block, done = (group, part), {}, {}, None, set()
            if not asks:
                sets[h], own[h] = tokens_of(text, words), component
                continue
            if not sets:
                continue
            if block is None:
                block = Block(list(sets), list(sets.values()))
            linked = block.linked(tokens_of(text, words), percent)
            met = {own[block.ids[i]] for i in linked.tolist()} - {component}
            if new := [(component, c) for c in sorted(met) if (component, c) not in done]:
                done.update(new)
                yield _edges(new)

    return run


# --- components -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of (a, b) edges is connected with.

    Large-star and small-star steps: every node points to the smallest of its
    neighbourhood, until nothing changes. The neighbours of a node are never
    listed in one place; each step is a minimum per node and a join.
    """
    spark = edges.sparkSession
    now = stored(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)
        ).first()
        if state == before:
            break
        before = state
        if state[0] == 0:
            return spark.createDataFrame([], "node long, label long")
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(
            both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m")),
            "least",
        )
        # Large star: larger neighbours of u go to the least of u's neighbourhood.
        large = now.join(least, F.col("a") == F.col("u")).select(
            F.col("b").alias("x"), F.col("m").alias("y")
        )
        large = stored(large.where("x <> y").distinct(), "large-star")
        # Small star: smaller neighbours of x and x itself go to the least of them.
        lowest = stored(large.groupBy(F.col("x").alias("u")).agg(F.min("y").alias("m")), "lowest")
        small = (
            large.join(lowest, F.col("x") == F.col("u"))
            .select(F.col("y").alias("v"), "m")
            .where("v <> m")
            .unionByName(lowest.select(F.col("u").alias("v"), "m"))
        )
        last = now
        now = stored(
            small.select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b")).distinct(),
            "edges",
        )
        discard(last, least, large, lowest)
    labels = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    labels = stored(
        labels.unionByName(roots).groupBy("node").agg(F.min("label").alias("label")), "labels"
    )
    discard(now)
    return labels


# --- the join -------------------------------------------------------------------


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(r, text) of the rows' keys r."""
    return docs.join(rows.select("r").distinct(), "r", "left_semi").dropDuplicates(["r"])


def _groups(
    docs: DataFrame, classes: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """(h, r, unit, size, g): the group of each class, its size, and its component so far.

    Also (r, text) of the classes that share a minimum hash. They are a share of the
    corpus, so they are picked out by a merge join at every size, once, and written.
    """
    keyed = classes.select("h", "r", F.posexplode("keys").alias("j", "key"))
    shared = stored(
        keyed.groupBy("j", "key").agg(F.count("*").alias("sharing")).where("sharing > 1"),
        "shared-keys",
    )
    block = F.pmod(F.xxhash64("j", "h"), F.ceil(F.col("sharing") / BLOCK))
    placed = stored(
        keyed.join(shared, ["j", "key"]).select("j", "key", block.alias("block"), "h", "r", "sharing"),
        "placed",
    )
    texts = stored(_texts_of(docs.hint("merge"), placed), "shared-texts")
    blocks = (
        texts.join(placed, "r")
        .select("j", "key", "block", "h", "text")
        .repartition("j", "key", "block")
        .sortWithinPartitions("j", "key", "block")
    )
    labels = components(blocks.mapInArrow(_linked_in_blocks(words, percent), EDGE_COLUMNS))
    best = placed.groupBy("h").agg(
        F.max_by(F.struct("j", "key", "block"), F.struct("sharing", "j")).alias("best")
    )
    joined = (
        classes.select("h", "r")
        .join(best, "h", "left")
        .join(labels, F.col("h") == F.col("node"), "left")
        .select(
            "h",
            "r",
            F.when(F.col("best").isNull(), F.col("h"))
            .otherwise(F.xxhash64("best.j", "best.key", "best.block"))
            .alias("unit"),
            F.coalesce("label", "h").alias("g"),
        )
    )
    joined = stored(joined, "members")
    discard(shared, placed, labels)
    sizes = joined.groupBy("unit").agg(F.count("*").alias("size"))
    groups = stored(joined.join(sizes, "unit"), "groups")
    discard(joined)
    return groups, texts


def _needed(n, m, percent: int):
    """Looked-at tokens that linked sets of n and m share at least.

    Of the two sets' last looked-at tokens one comes first in the order; all that they
    share, but for tokens that its set leaves unseen, is looked at in both.
    """
    both = F.ceil(percent * (n + m) / F.lit(100 + percent))
    unseen = F.ceil((percent * EXTRA - 100) * F.greatest(n, m) / F.lit(100 * EXTRA)) - 1
    return both - F.greatest(F.lit(0), unseen)


def _needed_in_range(n, least, most, percent: int):
    """The fewest that a set of n needs for any size from least to most.

    Up to n, what is needed never falls with the size. From there on it goes down by
    ``slope`` a size (or up, if negative), give or take two for rounding.
    """
    slope = percent / 100 - 1 / EXTRA - percent / (100 + percent)
    steps = math.ceil(2 / abs(slope)) + 1 if slope else 0
    low = F.least(F.greatest(least, n), most)
    near = [F.greatest(most - j, low) if slope > 0 else F.least(low + j, most) for j in range(steps)]
    # Where the slope is small, many sizes would have to be tried.
    if not 0 < steps <= 20:
        return F.lit(1)
    return F.least(_needed(n, least, percent), *[_needed(n, m, percent) for m in near])


def _askers(first: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(h, other): class h may link with a member of group other."""
    # Frequent tokens are kept whatever their count, so their rows need not meet.
    salt = F.when(F.col("often"), F.pmod("h", F.lit(SALTS))).otherwise(F.lit(0))
    same = Window.partitionBy("token", "salt")
    sets = F.when(F.col("often"), F.lit(1 << 62)).otherwise(F.col("rows"))
    # Written by itself: the moved tokens, most of them of one class, go before the rest moves.
    shared = stored(
        first.withColumn("salt", salt)
        .withColumn("low", F.min("h").over(same))
        .withColumn("high", F.max("h").over(same))
        .withColumn("rows", F.count("*").over(same))
        .where("often or low <> high")
        .select("token", "h", "n", sets.cast("long").alias("sets")),
        "shared-tokens",
    )
    own = Window.partitionBy("h")
    left_out = (F.col("sets") > COMMON) & (F.col("rank") <= F.floor(F.col("n") / EXTRA))
    rows = stored(
        shared.distinct()
        .join(groups.select("h", "unit", "size", "g"), "h")
        .withColumn("rank", F.row_number().over(own.orderBy(F.desc("sets"), "token")))
        .withColumn("asks", ~left_out)
        .withColumn("spared", F.count_if(left_out).over(own))
        .select("token", "h", "n", "unit", "size", "g", "asks", "spared"),
        "matrix-rows",
    )
    discard(shared)
    matrix = stored(
        rows.groupBy("token", F.col("unit").alias("other"), F.col("size").alias("other_size")).agg(
            F.min("n").alias("least"),
            F.max("n").alias("most"),
            F.min("g").alias("low"),
            F.max("g").alias("high"),
        ),
        "token-groups",
    )
    n = F.col("n")
    smaller = (F.col("size") < F.col("other_size")) | (
        (F.col("size") == F.col("other_size")) & (F.col("unit") < F.col("other"))
    )
    near_in_size = (100 * F.col("most") >= percent * n) & (100 * n >= percent * F.col("least"))
    joined_already = (F.col("low") == F.col("g")) & (F.col("high") == F.col("g"))
    # Sizes of members that may link.
    least = F.greatest(F.col("least"), F.ceil(percent * n / F.lit(100)))
    most = F.least(F.col("most"), F.floor(100 * n / F.lit(percent)))
    askers = (
        rows.where("asks")
        .join(matrix, "token")
        .where(smaller & near_in_size & ~joined_already)
        .groupBy("h", "n", "spared", "other")
        .agg(
            F.count("*").alias("common"), F.min("least").alias("least"), F.max("most").alias("most")
        )
        .where(
            F.col("common") + F.col("spared") >= _needed_in_range(n, least, most, percent)
        )
        .select("h", "other")
    )
    askers = stored(askers, "askers")
    discard(rows, matrix)
    return askers


def _opened(
    docs: DataFrame,
    texts: DataFrame,
    groups: DataFrame,
    askers: DataFrame,
    words: int,
    percent: int,
) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b): components that a link joins, by opening the groups that were not ruled out.

    Also the stored tables that the links are read from.

    ``texts`` has the texts picked out before; only others are looked for in docs.
    """
    parts = stored(
        askers.groupBy(F.col("other").alias("unit")).agg(
            F.ceil(F.count("*") / ASKERS).alias("parts")
        ),
        "open-groups",
    )
    members = groups.join(parts, "unit").select(
        F.col("unit").alias("group"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("asks"),
        "h",
        "g",
        "r",
    )
    asking = (
        askers.join(parts, F.col("other") == F.col("unit"))
        .select("h", "other", F.pmod(F.xxhash64("h"), F.col("parts")).alias("part"))
        .join(groups.select("h", "g", "r"), "h")
        .select(F.col("other").alias("group"), "part", F.lit(True).alias("asks"), "h", "g", "r")
    )
    roles = stored(members.unionByName(asking), "opened")
    missing = stored(
        roles.select("r").distinct().join(texts.select("r"), "r", "left_anti"), "missing"
    )
    read = (
        texts.unionByName(_texts_of(docs, missing))
        .join(roles, "r")
        .select("group", "part", "asks", "h", "g", "text")
        .repartition("group", "part")
        .sortWithinPartitions("group", "part", "asks")
    )
    links = read.mapInArrow(_linked_to_groups(words, percent), EDGE_COLUMNS)
    return links, [parts, roles, missing]


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    frequent_share: float = FREQUENT_SHARE,
) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id and the row's key r.

    Two texts link when percent * |union| <= 100 * |intersection| of their sets;
    component_id is the smallest doc_id reachable by links. A null or empty text
    has no shingles, links with nothing and has its own doc_id as component. Null
    ids do not count as smallest while there is another; repeated rows are rows of
    the same class. r is a hash of id and text, for joining back to docs.
    """
    return near_duplicates_and_tables(docs, words, percent, frequent_share)[0]


def near_duplicates_and_tables(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    frequent_share: float = FREQUENT_SHARE,
) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of near_duplicates, and the stored tables that they are read from."""
    spark = docs.sparkSession
    docs = docs.select(
        F.xxhash64("doc_id", "text").alias("r"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    profiles = stored(
        docs.mapInArrow(_profiles(words, percent, frequent_share), PROFILE_COLUMNS), "profiles"
    )
    rows = profiles.where("r is not null").select("r", "doc_id", "n", "h", "keys")
    classes = stored(
        rows.where("h is not null")
        .groupBy("h")
        .agg(
            F.min("r").alias("r"),
            F.min("doc_id").alias("first_id"),
            F.first("keys").alias("keys"),
        ),
        "classes",
    )
    n_classes = classes.count()
    frequent = (
        profiles.where("token is not null")
        .groupBy("token")
        .agg(F.sum("count").alias("n"))
        .where(F.col("n") >= max(2.0, frequent_share * n_classes))
        .select("token")
    )
    often = np.array([r[0] for r in frequent.collect()], np.int64).view(np.uint64)
    groups, texts = _groups(docs.select("r", "text"), classes, words, percent)
    first = docs.select("text").mapInArrow(
        _first_tokens(words, percent, np.sort(often)), "token long, h long, n long, often boolean"
    )
    askers = _askers(first, groups, percent)
    links, opened = _opened(docs.select("r", "text"), texts, groups, askers, words, percent)
    joined = components(links)
    discard(texts, askers, *opened)
    labels = groups.select("h", "g").join(joined, F.col("g") == F.col("node"), "left").select(
        "h", F.coalesce("label", "g").alias("component")
    )
    placed = stored(classes.select("h", "first_id").join(labels, "h"), "components")
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stored(placed.join(firsts, "component").select("h", "component_id"), "component-ids")
    discard(groups, classes, joined, placed)
    marks = (
        rows.drop("keys")
        .join(ids, "h", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("h").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
            "r",
        )
    )
    return marks, [profiles, ids]


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: the smallest id's, and of its rows the smallest r.

    Rows that are equal in id and text are one document, of which one row stays.
    """
    marks, tables = near_duplicates_and_tables(docs, words, percent)
    marks = marks.select(
        F.col("r").alias("_r"), F.col("doc_id").alias("_id"), "component_id", "n_shingles"
    )
    # Texts without words are no copies of each other; of others the component decides.
    of = F.when(F.col("n_shingles") > 0, F.struct(F.lit(0).alias("kind"), F.col("component_id").alias("c")))
    chosen = (
        marks.groupBy(
            F.coalesce(of, F.struct(F.lit(1).alias("kind"), F.col("_r").alias("c"))).alias("of")
        )
        .agg(F.min_by("_r", F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_r")).alias("_r"))
        .select("_r")
    )
    chosen = stored(chosen, "kept")
    discard(*tables)
    keyed = docs.withColumn("_r", F.xxhash64("doc_id", "text"))
    kept = keyed.join(chosen, "_r", "left_semi")
    return kept.dropDuplicates(["_r"]).drop("_r")
