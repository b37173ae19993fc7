"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

The ends of A's and B's tokens are two sorted lists of byte offsets. Where both have an
end, a group of tokens is closed. Merging the lists takes len(A) + len(B) steps; every
PIECE_STEPS steps a binary search along a diagonal finds how many ends of either list
come before, so the merge falls into pieces of equal work that need nothing of one
another, whatever the lengths of the texts. A piece emits the ends that its two parts
have in common; an end whose two sides lie in different pieces is found when the pieces
are stitched, and groups may run over any number of pieces.

Tokens of a group are linked. Counts of linked pairs over the corpus go through chunks
of bounded size: a chunk's distinct pairs are counted once, summed over all chunks, and
sent back to the chunk, so no pair moves once per document.

Where no token of either tokenizer goes on from a word into white space, a text may be
cut before encoding: it is encoded segment by segment, and a worker's process keeps the
ids of segments that come often.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from metricloom.llm import bpe
from metricloom.llm.storage import stored

PIECE_STEPS = 1 << 12
# Texts are aligned together up to so many characters, and counted together up to so many.
SLICE_CHARS, CHUNK_CHARS = 1 << 19, 1 << 24
# A group with more links than this is counted by its distinct ids.
LARGE_GROUP = 1 << 12
PAIRS_PER_ROW = 1 << 13
SPACE_SIGN = "▁"
# White space as A's pattern has it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Segments kept with their ids per process, and the longest that is kept.
KNOWN_SEGMENTS, KNOWN_LENGTH = 1 << 19, 64


class Pair:
    """The two tokenizers: A byte-level BPE from JSON, B sentencepiece pieces."""

    def __init__(self, a: bpe.Vocabulary, b_model: bytes):
        self.a, self.b_model = a, b_model
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_texts = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_texts.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_texts.append(b"")
            else:
                self.b_texts.append(piece.replace(SPACE_SIGN, " ").encode())
        self.b_sizes = np.array([len(t) for t in self.b_texts], np.int64)
        self.width = len(self.b_texts)
        segment = segment_pattern(b_model)
        self.known = _Segments(self, segment) if segment else None

    def __reduce__(self):
        return loaded, (self.a.source, self.b_model)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """A's ids of space + text and B's of text; None where their bytes are not those."""
        if not text:
            return None
        spaced = " " + text
        raw = spaced.encode()
        b = np.array(self.b.encode(text, num_threads=1), np.int64)
        if b"".join(map(self.b_texts.__getitem__, b.tolist())) != raw:
            return None
        a = np.array(self.a.encode(spaced, added=False), np.int64)
        # A has a token for each byte and splits without loss; its sizes are checked.
        if int(self.a.sizes[a].sum()) != len(raw):
            return None
        return a, b

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """As encode, of all texts: A's ids, B's ids, and how many of either a text has."""
        if self.known:
            return self.known.encode_all(texts)
        none = np.empty(0, np.int64)
        both = [self.encode(t) or (none, none) for t in texts]
        return (
            np.concatenate([none, *(a for a, _ in both)]),
            np.concatenate([none, *(b for _, b in both)]),
            np.array([len(a) for a, _ in both], np.int64),
            np.array([len(b) for _, b in both], np.int64),
        )


@lru_cache(maxsize=1)
def loaded(a_source: str, b_model: bytes) -> Pair:
    """Read once by a worker's process: later tasks find it with the segments it knows."""
    return Pair(bpe.Vocabulary(a_source), b_model)


def segment_pattern(b_model: bytes) -> re.Pattern | None:
    """Cuts space + text so that B's ids are those of the segments; None if nothing may be cut.

    A segment is white space and the word after it. So for merges of pieces that change
    no character, if no piece goes on from a word into a space; before other white space
    that a piece goes on into ("\\r" in ";\\r") nothing is cut. No piece may hold the line
    end, see _Segments. A's pattern starts anew at white space after a word.
    """
    model = model_pb2.ModelProto.FromString(b_model)
    train, rules = model.trainer_spec, model.normalizer_spec
    pieces = [p.piece for p in model.pieces]
    into = re.compile(f"[^{WHITE}{SPACE_SIGN}]([{WHITE}{SPACE_SIGN}])")
    joined = {white for piece in pieces for white in into.findall(piece)}
    plain = (
        train.model_type == train.BPE
        and train.byte_fallback
        and not train.treat_whitespace_as_suffix
        and not rules.precompiled_charsmap
        and not rules.remove_extra_whitespaces
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not any(p.type == p.USER_DEFINED for p in model.pieces)
    )
    if not plain or joined & {" ", SPACE_SIGN} or any("\n" in piece for piece in pieces):
        return None
    more = f"(?:[{''.join(sorted(joined))}][{WHITE}]*[^{WHITE}]*)*" if joined else ""
    return re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+")


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., sizes[0] of them, then those of the next, and so on."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


class _Ids:
    """One tokenizer's ids of the known segments, one after the other."""

    def __init__(self):
        self.ids, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def add(self, lists: list[list[int]], token_bytes: np.ndarray) -> np.ndarray:
        """Enters the ids of new segments; how many bytes each has by its tokens."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
        ends = np.cumsum(np.append(0, token_bytes[ids]))
        return np.diff(ends[np.cumsum(np.append(0, sizes))])

    def of(self, segments: np.ndarray) -> np.ndarray:
        starts = np.cumsum(self.sizes) - self.sizes
        return self.ids[places(starts[segments], self.sizes[segments])].astype(np.int64)

    def keep(self, segments: np.ndarray) -> None:
        self.ids, self.sizes = self.of(segments).astype(np.int32), self.sizes[segments]


class _Segments:
    """Numbers of segments with both tokenizers' ids; when full, the less used half goes.

    A segment is put to B behind a line end, which no piece holds: B's sign for the
    start of a text and that of the line end are then the first two ids.
    """

    def __init__(self, own: Pair, segment: re.Pattern):
        self.own, self.segment, self.numbers = own, segment, {}
        # Side by side these are split as they are one by one: a word ends before white space.
        self.regular = re.compile("(?!)" if own.a.suffix else f"[{WHITE}].*[^{WHITE}]", re.DOTALL)
        self.a, self.b = _Ids(), _Ids()
        self.whole, self.used = np.empty(0, bool), np.empty(0, np.int64)

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        lists = [self.segment.findall(" " + t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        kept = self._learn(set(chain.from_iterable(lists)).difference(self.numbers))
        found = np.fromiter(
            map(self.numbers.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum())
        )
        text_of = np.repeat(np.arange(len(texts)), sizes)
        broken = np.bincount(text_of, ~self.whole[found], len(texts)) > 0
        left = ~broken[text_of]
        found, text_of = found[left], text_of[left]
        out = (
            self.a.of(found),
            self.b.of(found),
            np.bincount(text_of, self.a.sizes[found], len(texts)).astype(np.int64),
            np.bincount(text_of, self.b.sizes[found], len(texts)).astype(np.int64),
        )
        self.used += np.bincount(found, minlength=len(self.used))
        self._forget(kept)
        return out

    def _of_a(self, segments: list[str]) -> list[list[int]]:
        """A's ids of each segment; A splits those of white space and a word in one go."""
        own, regular = self.own.a, self.regular.fullmatch
        alone = [not regular(s) for s in segments]
        joint = [s for s, single in zip(segments, alone, strict=True) if not single]
        words = own.split("".join(joint))
        lists = list(map(own.words.__getitem__, words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        tokens = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        last = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, joint), np.int64, len(joint))))
        cuts, ids = tokens[last].tolist(), list(chain.from_iterable(lists))
        each = (ids[low:high] for low, high in zip([0, *cuts], cuts, strict=False))
        return [
            own.encode(s, added=False) if single else next(each)
            for s, single in zip(segments, alone, strict=True)
        ]

    def _learn(self, new: set[str]) -> int:
        """Enters the segments, long ones last; how many are known without the long ones."""
        own, segments = self.own, sorted(new, key=lambda s: len(s) > KNOWN_LENGTH)
        a = self._of_a(segments)
        b = [ids[2:] for ids in own.b.encode(["\n" + s for s in segments], num_threads=1)]
        raws = [s.encode() for s in segments]
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        whole = (self.a.add(a, own.a.sizes) == sizes) & (self.b.add(b, own.b_sizes) == sizes)
        # With the sizes equal, the bytes of all segments are equal if those of each are.
        text_of = own.b_texts.__getitem__
        if b"".join(map(text_of, chain.from_iterable(compress(b, whole)))) != b"".join(
            compress(raws, whole)
        ):
            same = (b"".join(map(text_of, ids)) == raw for ids, raw in zip(b, raws, strict=True))
            whole &= np.fromiter(same, bool, len(raws))
        self.whole = np.append(self.whole, whole)
        self.used = np.append(self.used, np.zeros(len(segments), np.int64))
        self.numbers.update(zip(segments, range(len(self.numbers), len(self.used)), strict=True))
        return len(self.used) - sum(len(s) > KNOWN_LENGTH for s in segments)

    def _forget(self, kept: int) -> None:
        if kept > KNOWN_SEGMENTS:
            order = np.argsort(-self.used[:kept], kind="stable")
            stay = np.sort(order[: KNOWN_SEGMENTS // 2])
        elif kept < len(self.used):
            stay = np.arange(kept)
        else:
            return
        names = list(self.numbers)
        self.numbers = {names[i]: n for n, i in enumerate(stay.tolist())}
        self.a.keep(stay)
        self.b.keep(stay)
        self.whole, self.used = self.whole[stay], self.used[stay] // 2


def pair(a_path: str, b_path: str) -> Pair:
    with open(b_path, "rb") as file:
        return Pair(bpe.vocabulary(a_path), file.read())


def crossings(a: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """How many of a come before each diagonal 0, steps, 2 * steps, ...; equal ends: a first.

    All diagonals are searched at once, each by halving its own range.
    """
    total = len(a) + len(b)
    diagonals = np.minimum(np.arange(0, total + steps, steps), total)
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(diagonals), bool)
        at = middle[open_]
        first[open_] = a[at] <= b[diagonals[open_] - at - 1]
        low = np.where(first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low


def common_in_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends that both have."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    found = np.flatnonzero(b[at] == a)
    return found, at[found]


def closers(
    a: np.ndarray, b: np.ndarray, steps: int = PIECE_STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b, both in order, of the ends that close a group."""
    total = len(a) + len(b)
    low = crossings(a, b, steps)
    other = np.minimum(np.arange(len(low)) * steps, total) - low
    in_a, in_b = [], []
    for k in range(len(low) - 1):
        i, j, m, n = low[k], other[k], low[k + 1], other[k + 1]
        # Stitching: b's side of an end whose other side came last in the piece before.
        if i and j < len(b) and a[i - 1] == b[j]:
            in_a.append(np.array([i - 1]))
            in_b.append(np.array([j]))
        x, y = common_in_piece(a[i:m], b[j:n])
        in_a.append(x + i)
        in_b.append(y + j)
    if not in_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(in_a), np.concatenate(in_b)


class Aligned:
    """Some texts aligned together: their tokens one after the other, cut into groups."""

    def __init__(self, own: Pair, texts: list[str | None], steps: int = PIECE_STEPS):
        self.own, self.texts = own, len(texts)
        self.a, self.b, self.n_a, self.n_b = own.encode_all(texts)
        # Both sides of a text have the same bytes, so ends of texts are common ends.
        last_a, last_b = closers(
            np.cumsum(own.a.sizes[self.a]), np.cumsum(own.b_sizes[self.b]), steps
        )
        self.end_a, self.end_b = last_a + 1, last_b + 1
        self.in_a = np.diff(self.end_a, prepend=0)
        self.in_b = np.diff(self.end_b, prepend=0)
        self.text_of = np.searchsorted(np.cumsum(self.n_a), last_a, "right")
        self.n_groups = np.bincount(self.text_of, minlength=self.texts)
        self.n_links = np.zeros(self.texts, np.int64)
        np.add.at(self.n_links, self.text_of, self.in_a * self.in_b)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times), distinct and in order; pair is A's id * width + B's id."""
        width, own = self.own.width, len(self.own.a.sizes) * self.own.width
        small = self.in_a * self.in_b <= LARGE_GROUP
        in_b = np.where(small, self.in_b, 0)
        repeats = np.repeat(in_b, self.in_a)
        first = np.repeat(self.end_b - self.in_b, self.in_a)
        ends = np.cumsum(repeats)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(first - (ends - repeats), repeats) + np.arange(total)
        text = np.repeat(np.repeat(self.text_of, self.in_a), repeats)
        codes = text * own + np.repeat(self.a, repeats) * width + self.b[at]
        codes, times = np.unique(codes, return_counts=True)
        parts, counts = [codes], [times]
        for g in np.flatnonzero(~small).tolist():
            a, n_a = np.unique(
                self.a[self.end_a[g] - self.in_a[g] : self.end_a[g]], return_counts=True
            )
            b, n_b = np.unique(
                self.b[self.end_b[g] - self.in_b[g] : self.end_b[g]], return_counts=True
            )
            parts.append((self.text_of[g] * own + a[:, None] * width + b).ravel())
            counts.append((n_a[:, None] * n_b).ravel())
        if len(parts) > 1:
            codes, at = np.unique(np.concatenate(parts), return_inverse=True)
            times = np.zeros(len(codes), np.int64)
            np.add.at(times, at, np.concatenate(counts))
        return codes // own, codes % own, times

    def spelled(self, a_signs: np.ndarray, b_signs: np.ndarray) -> list[str]:
        """Each text's groups as a1,a2|b1;a3|b2,b3: signs hold an id with what follows it."""
        group_a = np.repeat(np.arange(len(self.in_a)), self.in_a)
        group_b = np.repeat(np.arange(len(self.in_b)), self.in_b)
        out = np.empty(len(self.a) + len(self.b), object)
        kind = np.zeros(len(self.a), np.int64)
        kind[self.end_a - 1] = 1
        out[np.arange(len(self.a)) + (self.end_b - self.in_b)[group_a]] = a_signs[kind, self.a]
        kind = np.zeros(len(self.b), np.int64)
        kind[self.end_b - 1] = 1
        out[np.arange(len(self.b)) + self.end_a[group_b]] = b_signs[kind, self.b]
        ends = np.cumsum(self.n_a + self.n_b)
        pieces = out.tolist()
        return [
            "".join(pieces[end - n : end])[:-1]
            for end, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist(), strict=True)
        ]


def signs(size: int, after: str, last: str) -> np.ndarray:
    out = np.empty((2, size), object)
    out[0] = [f"{i}{after}" for i in range(size)]
    out[1] = [f"{i}{last}" for i in range(size)]
    return out


def _slices(batch: pa.RecordBatch, chars: int | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of rows with chars characters or little more; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(sizes) - sizes) // (chars or SLICE_CHARS)
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:], strict=False):
        if low < high:
            yield batch.slice(low, high - low)


ALIGNED = "{}, a array<int>, b array<int>, in_a array<int>, in_b array<int>"


def align(docs: DataFrame, own: Pair, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a, b, in_a, in_b): A's and B's ids, and how many of either each group holds.

    A row per row of docs. A text that is null or empty, or that either tokenizer does
    not give back byte by byte, has no tokens and no groups. Keys may be null or
    repeat; no other column is read.
    """
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "a", "b", "in_a", "in_b"]

    def cut(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                found = Aligned(own, part.column(1).to_pylist())
                columns = [
                    cut(found.a, found.n_a),
                    cut(found.b, found.n_b),
                    cut(found.in_a, found.n_groups),
                    cut(found.in_b, found.n_groups),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return rows.mapInArrow(run, ALIGNED.format(f"`{key}` {kind}"))


COUNTED = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("held", pa.binary()),
        ("times", pa.binary()),
        ("pairs", pa.list_(pa.int64())),
        ("holders", pa.list_(pa.int64())),
    ]
)
COUNTED_COLUMNS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, held binary, times binary, pairs array<long>, holders array<long>"
)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in little room: the smallest type that holds them, compressed.

    First the type's size and the length in bytes, as text, then the bytes.
    """
    kind = np.min_scalar_type(int(numbers.max())) if len(numbers) else np.dtype(np.uint8)
    raw = numbers.astype(kind).tobytes()
    return f"{kind.itemsize} {len(raw)} ".encode() + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size, length, rest = data.split(b" ", 2)
    raw = pa.decompress(rest, int(length), "zstd", asbytes=True)
    return np.frombuffer(raw, np.dtype(f"u{int(size)}")).astype(np.int64)


class _Chunk:
    """Texts whose pairs are counted together: rows for them and for their distinct pairs."""

    def __init__(self, number: int):
        self.number, self.rows, self.links = number, [], []
        self.chars = 0

    def add(self, own: Pair, ids: list, texts: list[str | None], names) -> None:
        found = Aligned(own, texts)
        text, pairs, times = found.links()
        cuts = np.searchsorted(text, np.arange(1, len(texts)))
        spelled = found.spelled(*names)
        for i, (held, n) in enumerate(
            zip(np.split(pairs, cuts), np.split(times, cuts), strict=True)
        ):
            digest = hashlib.sha256(spelled[i].encode()).hexdigest() if found.n_a[i] else ""
            counts = (found.n_a[i], found.n_b[i], found.n_groups[i], found.n_links[i])
            self.rows.append((ids[i], *map(int, counts), digest))
            self.links.append((held, packed(n)))
        self.chars += sum(len(t or "") for t in texts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        held = [h for h, _ in self.links]
        pairs, holders = np.unique(np.concatenate(held), return_counts=True)
        columns: list[list] = [[] for _ in COUNTED]
        for row, (own, times) in zip(self.rows, self.links, strict=True):
            places = np.diff(np.searchsorted(pairs, own), prepend=0)
            values = (self.number, *row, packed(places), times, None, None)
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        for at in range(0, len(pairs), PAIRS_PER_ROW):
            part = slice(at, at + PAIRS_PER_ROW)
            values = (self.number, *[None] * 8, pairs[part].tolist(), holders[part].tolist())
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, COUNTED.types, strict=True)], schema=COUNTED
        )


def counted(docs: DataFrame, own: Pair) -> DataFrame:
    """Rows of texts with their pairs' numbers, and rows of each chunk's distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = signs(len(own.a.sizes), ",", "|"), signs(own.width, ",", ";")
        first = TaskContext.get().partitionId() << 32
        chunk = _Chunk(first)
        for batch in batches:
            for part in _slices(batch):
                chunk.add(own, part.column(0).to_pylist(), part.column(1).to_pylist(), names)
                if chunk.chars >= CHUNK_CHARS:
                    yield from chunk.batches()
                    chunk = _Chunk(chunk.number + 1)
        if chunk.rows:
            yield from chunk.batches()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, COUNTED_COLUMNS)


REPORT = pa.schema(
    [COUNTED.field(i) for i in range(1, 7)]
    + [("n_best", pa.int64()), ("count_sum", pa.int64())]
)
REPORT_COLUMNS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_best long, count_sum long"
)


def _weigh(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of a chunk with what their pairs' corpus-wide counts come to."""
    order = np.argsort(pairs["pair"].to_numpy())
    counts = pairs["count"].to_numpy()[order]
    best = pairs["best"].to_numpy(zero_copy_only=False)[order]
    n_best, sums = [], []
    for held, times in zip(texts["held"].to_pylist(), texts["times"].to_pylist(), strict=True):
        at, n = np.cumsum(unpacked(held)), unpacked(times)
        n_best.append(int(n[best[at]].sum()))
        sums.append(int((n * counts[at]).sum()))
    columns = [texts[name] for name in REPORT.names[:6]]
    return pa.Table.from_arrays(
        [*columns, pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())], schema=REPORT
    )


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): documents that hold a pair linked, and whether none of its A id's has more."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = stored(counts.withColumn("a", F.expr(f"pair div {width}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def report(docs: DataFrame, own: Pair) -> DataFrame:
    """Per row of docs: the columns of REPORT_COLUMNS.

    n_links counts linked occurrences. A pair's count is the number of documents that
    hold it linked; n_best are the links whose count no other pair of their A id
    exceeds, count_sum is the sum of counts over the links. Texts without tokens have
    zeros and an empty digest; repeated rows and ids count as documents of their own.
    """
    table = stored(counted(docs, own), "aligned")
    pairs = table.where("pairs is not null").select(
        "chunk", F.explode(F.arrays_zip("pairs", "holders")).alias("p")
    )
    pairs = pairs.select("chunk", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("n"))
    known = pairs.join(pair_counts(pairs, own.width), "pair").select(
        F.col("chunk").alias("of_chunk"), "pair", "count", "best"
    )
    texts = table.where("pairs is null").drop("pairs", "holders")
    return (
        texts.groupBy("chunk")
        .cogroup(known.groupBy("of_chunk"))
        .applyInArrow(_weigh, REPORT_COLUMNS)
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )
