"""Ranked lexical search: the best documents for each item, by buckets of vector lengths.

A document is a vector of impacts, an item one of term weights; a score is their inner
product. Each weight is shared out evenly between the two sides (its root goes to
either), which changes no product and brings the bounds closer. Documents are taken
longest vector first, in buckets:

- Cauchy-Schwarz: a bucket whose longest vector times the item's length stays below the
  item's tenth best score so far ends the item's search, as all later ones are shorter.
- Coordinate bounds: an item's heaviest terms are looked up until the rest of the item
  cannot reach that score alone. A document found there is kept if what it scored on
  these terms, and the lengths of what is left of both vectors, can still reach it.
- Survivors are scored again in whole numbers, which decide.

The bounds are in doubles with room for rounding, and only what is below the tenth best
score is ruled out, never what equals it: the result is exact.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.columns import LOWER, UPPER
from metricloom.llm.storage import stored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BEST = 10
BUCKET = 2048
# Items searched for together: by their terms, with repeats between items.
TERMS_PER_BLOCK = 200_000
# A fixed 1 MiB of bits tells the tasks which terms some item may have.
FILTER_BITS = 1 << 23
BITS_PER_BITMAP = 1 << 15
# Room for the rounding of doubles in a bound.
ROOM = 1e-9
LOWERED = str.maketrans(UPPER, LOWER)


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWERED))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): an item's distinct terms; rows without one are left out."""
    lowered = F.translate("text", UPPER, LOWER)
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TERM.pattern})"), F.lit(1)))
    return items.select("item_id", found.alias("terms")).where(F.size("terms") > 0)


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bits by checksum of all terms: of one size, however many terms there are."""
    place = (F.crc32(F.col("term").cast("binary")) % FILTER_BITS).alias("place")
    maps = (
        terms.select(place)
        .groupBy((F.col("place") / BITS_PER_BITMAP).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place") % BITS_PER_BITMAP).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    size = BITS_PER_BITMAP // 8
    for row in maps.collect():
        out[row.part * size : (row.part + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


VECTORS = "doc_id long, n long, terms array<string>, tfs array<int>"


def term_vectors(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) per document with a term: of terms that pass the filter."""
    known: dict[str, bool] = {}

    def passes(term: str) -> bool:
        if len(known) > 500_000:
            known.clear()
        at = zlib.crc32(term.encode()) % FILTER_BITS
        found = known[term] = bool(bits[at >> 3] >> (at & 7) & 1)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, sizes, ends, terms, tfs = [], [], [0], [], []
                for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = terms_of(text)
                    if not words:
                        continue
                    ids.append(doc)
                    sizes.append(len(words))
                    for term, tf in Counter(words).items():
                        found = known.get(term)
                        if passes(term) if found is None else found:
                            terms.append(term)
                            tfs.append(tf)
                    ends.append(len(terms))
                cuts = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(cuts, pa.array(terms, pa.string())),
                        pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int32())),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, VECTORS)


class Block:
    """Some items with their terms' weights, and the search for them."""

    def __init__(
        self, rows: list[tuple[int, list[tuple[str, int]]]], n_docs: int, n_terms: int, best: int
    ):
        self.n_docs, self.n_terms, self.best = n_docs, n_terms, best
        weights = {t: w for _, terms in rows for t, w in terms}
        self.terms = list(weights)
        place = {t: i for i, t in enumerate(self.terms)}
        self.weights = np.array([weights[t] for t in self.terms], np.int64)
        self.roots = np.sqrt(self.weights.astype(float))
        self.ids = [i for i, _ in rows]
        # Each item's terms, heaviest first, and the length of what follows each of them.
        self.items, self.rests = [], []
        for _, terms in rows:
            own = np.array([place[t] for t, _ in terms], np.int64)
            own = own[np.argsort(-self.weights[own], kind="stable")]
            squares = self.weights[own].astype(float)
            self.items.append(own)
            self.rests.append(np.sqrt(np.append(np.cumsum(squares[::-1])[::-1], 0.0)))
        self.lengths = np.array([r[0] for r in self.rests])
        # The best scores so far, ascending, and the documents that have them.
        self.scores = np.zeros((len(rows), best), np.int64)
        self.docs = np.zeros((len(rows), best), np.int64)

    def vectors(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """(row, term, impact) of the batch's entries whose term some item of the block has."""
        lists, tfs = batch.column(2), batch.column(3)
        flat, counts = lists.flatten(), tfs.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        term = pc.index_in(flat, value_set=pa.array(self.terms, pa.string()))
        known = term.is_valid().to_numpy(zero_copy_only=False)
        m = np.array(
            [10 + 90 * n * self.n_docs // self.n_terms for n in batch.column(1).to_pylist()],
            np.int64,
        )
        row, tf = row[known], counts[known].astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
        return row, term.drop_null().to_numpy().astype(np.int64), impact

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        row, term, impact = self.vectors(batch)
        scaled = impact * self.roots[term]
        squares = np.bincount(row, scaled * scaled, batch.num_rows)
        # Longest vectors first; rows of the batch are renumbered in that order.
        order = np.argsort(-squares, kind="stable")
        order = order[: np.count_nonzero(squares)]
        rank = np.full(batch.num_rows, -1, np.int64)
        rank[order] = np.arange(len(order))
        row = rank[row]
        kept = row >= 0
        row, term, impact, scaled = row[kept], term[kept], impact[kept], scaled[kept]
        by_bucket = np.lexsort((row, term, row // BUCKET))
        row, term, impact, scaled = (x[by_bucket] for x in (row, term, impact, scaled))
        cuts = np.searchsorted(row // BUCKET, np.arange(len(order) // BUCKET + 2))
        open_ = np.arange(len(self.items))
        for b in range(len(order) // BUCKET + 1):
            low, high = cuts[b], cuts[b + 1]
            if low == high:
                continue
            inside = order[b * BUCKET : (b + 1) * BUCKET]
            longest = math.sqrt(squares[inside[0]])
            open_ = open_[self.lengths[open_] * longest * (1 + ROOM) >= self.scores[open_, 0]]
            if not len(open_):
                return
            self._bucket(
                open_.tolist(),
                ids[inside],
                squares[inside],
                row[low:high] - b * BUCKET,
                term[low:high],
                impact[low:high],
                scaled[low:high],
                longest,
            )

    def _bucket(self, items, ids, squares, row, term, impact, scaled, longest) -> None:
        starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        for i in items:
            terms, rests = self.items[i], self.rests[i]
            least = self.scores[i, 0]
            # The heaviest terms, until the others together cannot reach the tenth score.
            focus = int(np.searchsorted(-rests * longest * (1 + ROOM), -least, "right"))
            focus = min(max(focus, 1), len(terms)) if least else len(terms)
            near = self._gather(terms[:focus], starts)
            if not len(near):
                continue
            done = np.bincount(row[near], scaled[near] * self.roots[term[near]], len(ids))
            seen = np.bincount(row[near], scaled[near] * scaled[near], len(ids))
            left = np.sqrt(np.maximum(squares - seen, 0)) * rests[focus]
            some = (seen > 0) & ((done + left) * (1 + ROOM) + 1 >= least)
            if not some.any():
                continue
            near = self._gather(terms, starts)
            near = near[some[row[near]]]
            products = impact[near] * self.weights[term[near]]
            score = np.zeros(len(ids), np.int64)
            np.add.at(score, row[near], products)
            found = np.flatnonzero(some & (score >= max(least, 1)))
            if len(found):
                self._keep(i, score[found], ids[found])

    @staticmethod
    def _gather(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places of all entries of some terms."""
        low, sizes = starts[terms], starts[terms + 1] - starts[terms]
        ends = np.cumsum(sizes)
        return np.repeat(low - (ends - sizes), sizes) + np.arange(int(ends[-1]))

    def _keep(self, i: int, scores: np.ndarray, docs: np.ndarray) -> None:
        filled = self.scores[i] > 0
        scores = np.concatenate([self.scores[i][filled], scores])
        docs = np.concatenate([self.docs[i][filled], docs])
        order = np.lexsort((docs, -scores))[: self.best][::-1]
        self.scores[i, self.best - len(order) :] = scores[order]
        self.docs[i, self.best - len(order) :] = docs[order]

    def found(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.scores)
        ids = np.array(self.ids, np.int64)[item]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids, self.docs[item, place], self.scores[item, place])],
            names=["item_id", "doc_id", "score"],
        )


def weighed_blocks(
    items: DataFrame, weights: DataFrame, limit: int = TERMS_PER_BLOCK
) -> Iterator[list[tuple[int, list[tuple[str, int]]]]]:
    """Items with their terms' weights, in blocks of bounded size; the driver holds one at a time."""
    weighed = (
        items.select("item_id", F.explode("terms").alias("term"))
        .join(weights.where("w > 0"), "term")
        .groupBy("item_id")
        .agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    )
    block, held = [], 0
    for row in stored(weighed, "items").toLocalIterator():
        block.append((row.item_id, sorted((t.term, t.w) for t in row.terms)))
        held += len(row.terms)
        if held >= limit:
            yield block
            block, held = [], 0
    if block:
        yield block


def search(
    docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = TERMS_PER_BLOCK
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents with a score above 0.

    Null and empty texts have no terms; items and documents without one find nothing
    and are not found. Equal scores are ordered by doc_id, and repeated rows are
    documents of their own. An item_id that comes twice is one item with both texts'
    terms. Items with a null id are left out; documents with one count in N, L and df but
    cannot be named in the result. Of docs only doc_id and text are read, of
    items item_id and text.
    """
    asked = items.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    asked = item_terms(asked).select("item_id", F.explode("terms").alias("term")).distinct()
    asked = stored(asked.groupBy("item_id").agg(F.collect_list("term").alias("terms")), "asked")
    wanted = asked.select(F.explode("terms").alias("term")).distinct()
    vectors = stored(term_vectors(docs, term_filter(wanted)), "vectors")
    totals = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs, totals.terms or 0
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("count") + 1)
    weights = df.select("term", F.floor(1000 * F.log(ratio)).alias("w"))

    def searched(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block.add(batch)
            yield block.found()

        return run

    found = None
    for rows in weighed_blocks(asked, weights, block_terms):
        work = searched(Block(rows, n_docs, n_terms, best))
        part = vectors.where("doc_id is not null").mapInArrow(work, "item_id long, doc_id long, score long")
        part = stored(part, "candidates")
        found = part if found is None else found.unionByName(part)
    if found is None:
        spark = docs.sparkSession
        found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")
