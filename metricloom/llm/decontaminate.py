"""Benchmark items in documents, with word edits, by CGK embedding and bit sampling.

A CGK walk reads a word sequence with a pointer that stays or moves on by a random
bit of the step and the word read; two sequences with few edits fall into step
again, so edit distance becomes Hamming distance between the words read. Items and
item-sized windows of the documents are walked with the same bits. A repetition
samples one or two steps; an item is a candidate in a text where a window agrees with
it in all sampled words of a repetition, and only candidates are verified: the fewest
word edits that turn the item into a piece of the document. How many repetitions an
item has follows from its length and edits, for a stated recall of passages with as
many edits as are allowed; those with fewer edits agree more often.

An item of n words may have n * edits // 100 edits, k. Cut into k + 1 pieces, one of
them is left whole. So only windows around a place where a piece starts as in the
item are walked; no window with k edits or fewer is passed over by that. With
``exact`` all these windows are verified without a walk, and nothing is missed.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from metricloom.llm.storage import stored

WORD = re.compile(r"\w+")
# Scripts without spaces, of which each character is a word: Thai, Lao, Burmese, Khmer,
# Japanese and Chinese.
SPACELESS = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
WORD_OR_SIGN = re.compile(rf"(?=\w)[{SPACELESS}]|[^\W{SPACELESS}]+")
EDIT_PERCENT = 20
# Words of a piece that are looked up, at most.
RUN = 4
# Items of fewer than five words have no edits allowed: they are found as they are.
LEAST_WORDS = 1
# Passages with the most edits allowed that some repetition agrees on, at least.
RECALL = 0.99
STEPS_PER_WORD = 1.5
# Two steps are sampled where a repetition still agrees this often, else one.
LEAST_CHANCE = 0.125
ITEMS_PER_BLOCK = 20_000
SEED = 11
TABLE = 1 << 20
FACTOR = 0x2545F4914F6CDD1D


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (WORD if text.isascii() else WORD_OR_SIGN).findall(text)


def fewest_edits(item: list[int], piece: np.ndarray) -> tuple[int, int]:
    """(edits, end): the fewest edits from item to any run of words in piece, and its end.

    Bit-parallel: one pass over the piece with the item's columns as bits.
    """
    n = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for at, w in enumerate(piece.tolist()):
        same = masks.get(w, 0)
        across = same | minus
        diagonal = (((same & plus) + plus) ^ plus) | same
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(across | up)), up & across
        if score < best:
            best, end = score, at + 1
    return best, end


def agreement(edits: int, sampled: int) -> float:
    """The chance that a repetition agrees on a passage with so many edits.

    Edits a fifth of the words apart throw walks out of step; the share of steps at
    which the best window reads the item's word was measured on items of 6 to 250
    words (the lowest of 36 passages: 0.6 at 1 edit, 0.4 at 12, 0.25 at 50).
    """
    if not edits:
        return 1.0
    one = 0.6 / (1 + edits / 30)
    return one if sampled == 1 else one * one / 2


class Items:
    """A block of benchmark items: words as numbers, runs, and sampled steps of their walks."""

    def __init__(
        self,
        items: list[tuple[int, str]],
        edit_percent: int = EDIT_PERCENT,
        recall: float = RECALL,
        exact: bool = False,
    ) -> None:
        self.exact = exact
        self.vocabulary: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            found = words_of(text)
            if len(found) >= LEAST_WORDS:
                self.ids.append(item_id)
                self.items.append(
                    [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
                )
        self.edits = [len(i) * edit_percent // 100 for i in self.items]
        # Starts of pieces by their number of words: run -> (item, place in the item).
        self.runs: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
        for t, item in enumerate(self.items):
            pieces = self.edits[t] + 1
            size = max(1, min(RUN, len(item) // pieces))
            runs = self.runs.setdefault(size, defaultdict(list))
            for i in range(pieces):
                at = i * len(item) // pieces
                runs[tuple(item[at : at + size])].append((t, at))
        self.codes, self.tables = {}, {}
        for size, runs in self.runs.items():
            columns = np.array(list(runs), np.int64).T
            coded = self._coded(columns)
            self.codes[size] = np.sort(coded)
            # The low bits as a table: most places are ruled out by one look.
            table = np.zeros(TABLE, bool)
            table[coded & (TABLE - 1)] = True
            self.tables[size] = table
        if not exact:
            self._sample(recall)

    def _sample(self, recall: float) -> None:
        """Each item's repetitions, their sampled steps and the words its walks read there."""
        self.sampled = np.array(
            [2 if agreement(k, 2) >= LEAST_CHANCE else 1 for k in self.edits], np.int64
        )
        self.repetitions = np.array(
            [
                1 if not k else math.ceil(math.log(1 - recall) / math.log1p(-agreement(k, s)))
                for k, s in zip(self.edits, self.sampled.tolist(), strict=True)
            ],
            np.int64,
        )
        lengths = np.array([len(i) for i in self.items], np.int64)
        walked = (STEPS_PER_WORD * lengths).astype(np.int64)
        # An item is followed by so many ends that no walk gets to the next one.
        parts = [
            part
            for item, n in zip(self.items, walked.tolist(), strict=True)
            for part in (np.array(item, np.int64), np.full(n + 1, -1, np.int64))
        ]
        every = np.concatenate(parts) if parts else np.empty(0, np.int64)
        starts = np.cumsum(lengths + walked + 1) - (lengths + walked + 1)
        most = int(self.repetitions.max(initial=0))
        draw = np.random.default_rng(SEED)
        self.factors = draw.integers(1, 1 << 62, (most, 2), np.int64) | 1
        shares = draw.random((most, 2))
        # Per repetition: the items that have it, and by them the steps and the words.
        self.sampled_items, self.steps, self.read = [], [], []
        for r in range(most):
            own = np.flatnonzero(self.repetitions > r)
            steps = (shares[r][None, :] * walked[own][:, None]).astype(np.int64)
            steps[self.sampled[own] == 1, 1] = steps[self.sampled[own] == 1, 0]
            self.sampled_items.append(own)
            self.steps.append(steps)
            self.read.append(self._walk(r, every, starts[own], steps))

    @staticmethod
    def _coded(columns: list[np.ndarray]) -> np.ndarray:
        """A number for each run of words; equal runs have equal numbers."""
        out = np.zeros(len(columns[0]), np.int64)
        with np.errstate(over="ignore"):
            for column in columns:
                out = (out + column) * FACTOR
                out ^= out >> 29
        return out

    def _walk(
        self, repetition: int, codes: np.ndarray, starts: np.ndarray, steps: np.ndarray
    ) -> np.ndarray:
        """Words read at each start's sampled steps; past the end the last code is read."""
        a, b = self.factors[repetition]
        at, out = starts.copy(), np.empty(steps.shape, np.int64)
        last = len(codes) - 1
        with np.errstate(over="ignore"):
            for step in range(int(steps.max()) + 1 if steps.size else 0):
                read = codes[np.minimum(at, last)]
                for s in range(steps.shape[1]):
                    hit = steps[:, s] == step
                    out[hit, s] = read[hit]
                x = (read + 1) * a + np.int64(step) * b
                x = (x ^ (x >> 31)) * a
                at = at + ((x >> 40) & 1)
        return out

    def places(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Per number of words, where a piece may start. 0 stands for words of no item."""
        for size, known in self.codes.items():
            if len(codes) < size:
                continue
            last = len(codes) - size + 1
            columns = [codes[i : last + i] for i in range(size)]
            coded = self._coded(columns)
            at = np.flatnonzero(self.tables[size][coded & (TABLE - 1)])
            near = np.minimum(np.searchsorted(known, coded[at]), len(known) - 1)
            yield size, at[known[near] == coded[at]]

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, start) of the item-sized windows around these places, distinct."""
        items, firsts = [], []
        for size, places in self.places(codes):
            for at in places.tolist():
                for t, j in self.runs[size].get(tuple(codes[at : at + size].tolist()), ()):
                    items.append(t)
                    firsts.append(at - j)
        if not items:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        item, first = np.array(items, np.int64), np.array(firsts, np.int64)
        k = np.array(self.edits, np.int64)[item]
        shift = np.arange(2 * int(k.max()) + 1)[None, :] - k[:, None]
        start = first[:, None] + shift
        valid = (shift <= k[:, None]) & (start >= 0) & (start < len(codes))
        pairs = np.unique((item[:, None] * len(codes) + start)[valid])
        return pairs // len(codes), pairs % len(codes)

    def leaks(self, codes: np.ndarray) -> dict[int, tuple[int, int]]:
        """item -> (edits, end): the fewest edits of each candidate found, and where."""
        items, starts = self.windows(codes)
        found: dict[int, tuple[int, int]] = {}
        candidates = np.unique(items) if self.exact else self.candidates(codes, items, starts)
        lows, highs = np.searchsorted(items, candidates), np.searchsorted(items, candidates, "right")
        for t, low, high in zip(candidates.tolist(), lows, highs, strict=True):
            edits, end = self._nearest(t, starts[low:high], codes)
            if edits <= self.edits[t]:
                found[t] = edits, end
        return found

    def candidates(self, codes: np.ndarray, items: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The items with a window that agrees in all sampled words of a repetition."""
        chosen = np.zeros(len(self.items), bool)
        left = np.arange(len(items))
        for r, own in enumerate(self.sampled_items):
            left = left[(self.repetitions[items[left]] > r) & ~chosen[items[left]]]
            if not len(left):
                break
            row = np.searchsorted(own, items[left])
            read = self._walk(r, codes, starts[left], self.steps[r][row])
            chosen[items[left[(read == self.read[r][row]).all(axis=1)]]] = True
        return np.flatnonzero(chosen)

    def _nearest(self, item: int, starts: np.ndarray, codes: np.ndarray) -> tuple[int, int]:
        """(edits, end) of the item in its windows; those that touch are read as one piece."""
        n = len(self.items[item])
        best, end = n + 1, 0
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
            edits, at = fewest_edits(self.items[item], codes[part[0] : part[-1] + n])
            if edits < best:
                best, end = edits, int(part[0]) + at
        return best, end

    def leaks_in(self, texts: list[str | None]) -> Iterator[tuple[int, dict[int, tuple[int, int]]]]:
        """(place in texts, leaks) for each text with a leak."""
        known = self.vocabulary.get
        lists = [[known(w, 0) for w in words_of(t)] for t in texts]
        lengths = np.array([len(c) for c in lists], np.int64)
        codes = np.fromiter((c for cs in lists for c in cs), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        places = [at for _, at in self.places(codes)]
        if not places:
            return
        # A run across two texts is looked at in vain; the texts are read one by one.
        owners = np.searchsorted(ends, np.concatenate(places), "right")
        for i in np.unique(owners).tolist():
            own = codes[ends[i] - lengths[i] : ends[i]]
            if len(own) and (found := self.leaks(own)):
                yield i, found


def item_blocks(benchmark: DataFrame, size: int = ITEMS_PER_BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, of which the driver holds one at a time."""
    block: list[tuple[int, str]] = []
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


LEAK_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_item_words", pa.int64()),
        ("n_edits", pa.int64()),
        ("end_word", pa.int64()),
    ]
)
LEAK_COLUMNS = "doc_id long, item_id long, n_item_words long, n_edits long, end_word long"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_percent: int = EDIT_PERCENT,
    block_size: int = ITEMS_PER_BLOCK,
    recall: float = RECALL,
    exact: bool = False,
) -> DataFrame:
    """A row per row of docs and item found in it: the columns of LEAK_COLUMNS.

    Words are runs of letters, digits and _, in lower case, and single characters
    of scripts without spaces. Null or empty texts have no leaks and null items are
    not searched, nor those without a word. Null ids and repeated rows are searched like any other; of
    several places the one with fewest edits, then the first, is given. Each find is
    verified; of passages with the most edits allowed a share of ``recall`` is found,
    of those without edits all, and with ``exact`` every one.
    """
    texts = docs.select("doc_id", "text")

    def found(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    (ids[i], items.ids[t], len(items.items[t]), edits, end)
                    for i, leaks in items.leaks_in(batch.column(1).to_pylist())
                    for t, (edits, end) in sorted(leaks.items())
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * len(LEAK_SCHEMA)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, LEAK_SCHEMA.types, strict=True)],
                    schema=LEAK_SCHEMA,
                )

        return run

    parts = [
        stored(texts.mapInArrow(found(Items(block, edit_percent, recall, exact)), LEAK_COLUMNS), "leaks")
        for block in item_blocks(benchmark, block_size)
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], LEAK_COLUMNS)
    return reduce(DataFrame.unionByName, parts)


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_percent: int = EDIT_PERCENT,
    block_size: int = ITEMS_PER_BLOCK,
    recall: float = RECALL,
    exact: bool = False,
) -> DataFrame:
    """docs without the rows in which an item is found; nothing is shuffled."""

    def kept(items: Items, column: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stay = np.ones(batch.num_rows, bool)
                for i, _ in items.leaks_in(batch.column(column).to_pylist()):
                    stay[i] = False
                yield batch.filter(pa.array(stay))

        return run

    for block in item_blocks(benchmark, block_size):
        items = Items(block, edit_percent, recall, exact)
        docs = docs.mapInArrow(kept(items, docs.columns.index("text")), docs.schema)
    return docs
