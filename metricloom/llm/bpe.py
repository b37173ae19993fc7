"""Byte-pair encoding by longest matches with backtracking, decoding by an offset table.

A word's tokens are the only chain of tokens that covers it and of which each pair of
neighbours is compatible: merging the two tokens' own bytes by rank gives back the
two. So the encoder takes, from left to right, the longest token that starts where
the last one ends (all matches of a word come from one pass of an Aho-Corasick
automaton), falls back to the token's next shorter prefix where the pair is not
compatible, and takes a token back where no prefix fits. A place that was given up is
never entered again, so the work is linear in the word, whatever its length.

Decoding reads each id's place in one string of all token texts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# How the two known kinds of vocabulary split a text into words.
WORD_END_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Words kept with their tokens per task, and the longest that is kept.
KNOWN_WORDS, KNOWN_LENGTH = 200_000, 64
KNOWN_PAIRS = 500_000
NEVER = 1 << 60


def byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """A BPE vocabulary with its rules of splitting, from the JSON of a public tokenizer.

    Two kinds are read: words with an end sign (NFC, lower case, white space dropped),
    and byte-level without normalisation. Other settings raise ValueError.
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.source = source
        self.suffix = model.get("end_of_word_suffix") or ""
        normalizer = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        plain = not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback")
        )
        if self.suffix:
            known = normalizer == ["NFC", "Replace", "Lowercase"] and spec["decoder"] is None
            pattern = WORD_END_PATTERN
        else:
            known = spec["normalizer"] is None and spec["decoder"]["type"] == "ByteLevel"
            pattern = BYTE_LEVEL_PATTERN
        if model["type"] != "BPE" or not plain or not known:
            raise ValueError("not a BPE vocabulary of a known kind")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must stand as they are")
        self.pattern = regex.compile(pattern)
        # Characters met so far that Python's tables know.
        self.known_signs: set[str] = set()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")"
        )
        self._read_merges(model)
        self._read_names(model["vocab"])
        self.words = _Words(self)
        self.library: Tokenizer | None = None

    def __reduce__(self):
        return Vocabulary, (self.source,)

    def _read_merges(self, model: dict) -> None:
        """Symbols of each token, its parts and rank, and the automaton of whole tokens."""
        byte_of = {sign: b for b, sign in enumerate(byte_signs())}

        def symbols(name: str) -> str:
            last = bool(self.suffix) and name.endswith(self.suffix)
            codes = [byte_of[s] for s in (name[: -len(self.suffix)] if last else name)]
            if last:
                codes[-1] += 256
            return "".join(map(chr, codes))

        vocab = model["vocab"]
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.merges[pair] = rank
            if self.rank.setdefault(whole, rank) == rank:
                self.parts[whole] = pair
        self.fits: dict[int, int] = {}
        texts = {
            id_: symbols(name)
            for name, id_ in vocab.items()
            if id_ in self.parts or len(name.removesuffix(self.suffix) or name) == 1
        }
        # A token that its own bytes do not give is never the outcome of merging.
        texts = {
            id_: text
            for id_, text in texts.items()
            if id_ not in self.parts or self._compatible(*self.parts[id_], self.rank[id_])
        }
        self.by_symbols = {text: id_ for id_, text in texts.items()}
        if any(chr(b) not in self.by_symbols for b in range(512 if self.suffix else 256)):
            raise ValueError("the vocabulary lacks a byte")
        # Per id: symbols, and the longest token that is a proper prefix (-1: none).
        self.size = max(vocab.values()) + 1
        self.length, self.shorter = [0] * self.size, [-1] * self.size
        self.base: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for text, id_ in self.by_symbols.items():
            self.length[id_] = len(text)
            for end in range(len(text) - 1, 0, -1):
                if (prefix := self.by_symbols.get(text[:end])) is not None:
                    self.shorter[id_] = prefix
                    break
            if len(text) == 1:
                self.base[text] = id_
            else:
                self.automaton.add_word(text, id_)
        self.automaton.make_automaton()

    def _read_names(self, vocab: dict[str, int]) -> None:
        """All token texts in one array of bytes, and each id's place in it."""
        byte_of = {sign: b for b, sign in enumerate(byte_signs())}
        names = {id_: name for name, id_ in vocab.items()} | {
            id_: content for content, id_ in self.added.items()
        }
        texts = []
        for id_ in range(max(names) + 1):
            name = names.get(id_)
            if name is None:
                texts.append(b"")
            elif self.suffix:
                texts.append(name.encode() + b" ")
            elif id_ in self.added.values():
                texts.append(name.encode())
            else:
                texts.append(bytes(byte_of[s] for s in name))
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(texts), np.uint8)

    def _compatible(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether no merge of rank below until goes across the border of left and right.

        The right edge of left and the left edge of right are taken apart, what was
        merged last first. Two parts that stood side by side would have been merged if
        their merge comes before the ones that took them up; of equal merges the one
        further left comes first.
        """
        left_until = right_until = until
        rank = self.rank
        while True:
            merge = self.merges.get((left, right))
            if merge is not None and merge < left_until and merge <= right_until:
                return False
            of_left, of_right = rank.get(left, -1), rank.get(right, -1)
            if of_left > of_right:
                left, left_until = self.parts[left][1], of_left
            elif of_right >= 0:
                right, right_until = self.parts[right][0], of_right
            else:
                return True

    def fitting(self, left: int, token: int) -> int:
        """The longest of token and its prefixes that is compatible with left; -1: none.

        Entered in the table of pairs, each prefix's own answer too.
        """
        tried = []
        while token >= 0 and (fit := self.fits.get(left * self.size + token)) is None:
            tried.append(token)
            if self._compatible(left, token):
                fit = token
                break
            token = self.shorter[token]
        else:
            fit = fit if token >= 0 else -1
        if len(self.fits) >= KNOWN_PAIRS:
            self.fits.clear()
        for one in tried:
            self.fits[left * self.size + one] = fit
        return fit

    def chain(self, symbols: str) -> list[int]:
        """The tokens of one word, given as symbols."""
        whole = self.by_symbols.get(symbols)
        if whole is not None:
            return [whole]
        length, shorter, size = self.length, self.shorter, self.size
        longest = list(map(self.base.__getitem__, symbols))
        for end, id_ in self.automaton.iter(symbols):
            longest[end + 1 - length[id_]] = id_
        known, total = self.fits.get, len(symbols)
        closed: set[int] = set()
        tokens: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            if last >= 0:
                fit = known(last * size + token)
                token = self.fitting(last, token) if fit is None else fit
            if token >= 0:
                end = at + length[token]
                if end not in closed:
                    tokens.append(token)
                    if end == total:
                        return tokens
                    at, last, token = end, token, longest[end]
                    continue
                token = shorter[token]
            while token < 0:
                closed.add(at)
                token = tokens.pop()
                at -= length[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]

    def word(self, word: str) -> tuple[int, ...]:
        raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
        return tuple(self.chain(raw[:-1] + chr(ord(raw[-1]) + 256) if self.suffix else raw))

    def split(self, text: str) -> list[str]:
        """The words of a text without added tokens.

        Texts with characters newer than Python's tables are split by the library,
        whose tables may know them.
        """
        if not text.isascii() and (new := set(text) - self.known_signs):
            if any(unicodedata.category(sign) == "Cn" for sign in new):
                return self._split_newer(text)
            self.known_signs |= new
        if self.suffix:
            if not text.isascii():
                # A sigma at the end of a word is not told apart.
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
        return self.pattern.findall(text)

    def _split_newer(self, text: str) -> list[str]:
        if self.library is None:
            self.library = Tokenizer.from_str(self.source)
        if self.library.normalizer:
            text = self.library.normalizer.normalize_str(text)
        byte_of = {sign: b for b, sign in enumerate(byte_signs())}
        return [
            bytes(byte_of[s] for s in word).decode()
            for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)
        ]

    def encode(self, text: str | None, added: bool = True) -> list[int]:
        """The ids of a text; added tokens that stand in it are found first if asked for."""
        if not text:
            return []
        words, parts = self.words, [text]
        if added and self.added and self.added_pattern.search(text):
            parts = self.added_pattern.split(text)
        ids: list[int] = []
        for i, part in enumerate(parts):
            if i % 2:
                ids.append(self.added[part])
            else:
                for word in self.split(part):
                    ids += words[word]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, those out of range left out."""
        ids = ids[(ids >= 0) & (ids < len(self.sizes))]
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(total)
        text = self.letters[places].tobytes()
        return (text[:-1] if self.suffix else text).decode("utf-8", "replace")


class _Words(dict):
    """Words with their tokens; emptied when full, and not kept when long."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.vocabulary.word(word)
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids


def vocabulary(path: str) -> Vocabulary:
    """Read on the driver; it travels to the tasks with their function."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def _lists(lists: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(sizes.sum()))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _chunks(batch: pa.RecordBatch, size: int = 1 << 10) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _mapped(df: DataFrame, key: str, column: str, outputs: list[tuple[str, str]], work) -> DataFrame:
    """key and what work makes of a column's values: a list of Arrow arrays."""
    rows = df.select(F.col(key), F.col(column).alias("_value"))
    schema = rows.schema[key].dataType.simpleString()
    declared = ", ".join([f"`{key}` {schema}", *(f"`{n}` {t}" for n, t in outputs)])
    names = [key, *(n for n, _ in outputs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *work(part.column(1))], names)

    return rows.mapInArrow(run, declared)


def encode(docs: DataFrame, own: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): a row per row of docs, with the ids of its text.

    Null and empty texts have no ids. Keys may be null or repeat; no other column is read.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        return [_lists([own.encode(t) for t in texts.to_pylist()])]

    return _mapped(docs, key, text, [("ids", "array<int>")], work)


def decode(encoded: DataFrame, own: Vocabulary, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): a row per row of encoded. No ids or null give an empty text."""

    def work(lists: pa.Array) -> list[pa.Array]:
        found = [
            own.decode(np.array([i for i in row or () if i is not None], np.int64))
            for row in lists.to_pylist()
        ]
        return [pa.array(found, pa.string())]

    return _mapped(encoded, key, ids, [("text", "string")], work)


def round_trip(
    docs: DataFrame, own: Vocabulary, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids, decoded): both ways in one pass, a row per row of docs."""

    def work(texts: pa.Array) -> list[pa.Array]:
        lists = [own.encode(t) for t in texts.to_pylist()]
        decoded = [own.decode(np.array(ids, np.int64)) for ids in lists]
        return [_lists(lists), pa.array(decoded, pa.string())]

    return _mapped(docs, key, text, [("ids", "array<int>"), ("decoded", "string")], work)


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def report(docs: DataFrame, own: Vocabulary) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs, own).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )
