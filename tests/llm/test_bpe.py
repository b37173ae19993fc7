"""The encoder against the library's, whole texts and hard words."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import SMALL, by, documents
from metricloom.llm import bpe

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PIECES = [
    *("a", "b", "ab", "the", "in", "ing", "  ", "\n", "é", "é", "Σ", "ΟΣ", "ß", "İ", "日本"),
    *("<|endoftext|>", "<|startoftext|>", "'s", "'", "1", "23", "!!", "_", "‍", "😀", "aaaa"),
    *("Ᲊ", "\U000105c0", "\x00", "\x85", " ", "</w>", "zzzz", "Ġ", "▁"),
]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    return bpe.vocabulary(path), Tokenizer.from_file(path)


def same(own, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    found = own.encode(text)
    assert found == expected, repr(text[:80])
    decoded = own.decode(np.array(found, np.int64))
    assert decoded == library.decode(expected, skip_special_tokens=False)


def test_random_texts(both):
    rng = random.Random(5)
    for i in range(3000):
        if i % 3:
            text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
        else:
            ranges = ((32, 126), (97, 102), (0xA0, 0x24F), (0x300, 0x3FF), (0, 0xD7FF))
            text = "".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(0, 30)))
        same(*both, text)


def test_every_token_gives_itself(both):
    own, _ = both
    for id_, (left, right) in own.parts.items():
        if own.length[id_]:
            assert own.fitting(left, right) != right
    for symbols, id_ in own.by_symbols.items():
        assert own.chain(symbols) == [id_]


def test_long_words_take_time_in_proportion(both):
    """The chain visits a bounded number of candidates per letter, however long the word."""
    rng = random.Random(7)
    for letters in ("a", "ab", "abcdefgh", "the in"):
        word = "".join(rng.choice(letters.replace(" ", "")) for _ in range(60_000))
        same(*both, word)


def test_pairs_by_definition():
    """A pair is compatible exactly if merging its bytes by rank gives the pair back."""
    own = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = {i: t for t, i in own.by_symbols.items()}
    some = [i for i, t in texts.items() if len(t) <= 6]

    def merged(symbols):
        tokens = [own.by_symbols[s] for s in symbols]
        while True:
            ranks = [own.merges.get(p, bpe.NEVER) for p in zip(tokens, tokens[1:], strict=False)]
            if not ranks or min(ranks) == bpe.NEVER:
                return tokens
            at = ranks.index(min(ranks))
            whole = own.by_symbols[texts[tokens[at]] + texts[tokens[at + 1]]]
            tokens[at : at + 2] = [whole]

    outcomes = set()
    for _ in range(4000):
        left, right = rng.choice(some), rng.choice(some)
        expected = merged(texts[left] + texts[right]) == [left, right]
        assert (own.fitting(left, right) == right) is expected
        outcomes.add(expected)
    assert outcomes == {True, False}


def test_whole_table(spark):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = by(bpe.report(docs, bpe.vocabulary(path)), "doc_id")
    rows = docs.collect()
    assert len(rows) == len(found) == docs.count()
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[row.doc_id] == {
            "doc_id": row.doc_id,
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
        }


def test_nulls_repeats_and_clashing_columns(spark):
    own = bpe.vocabulary(public_tokenizers.path(FILES[0]))
    docs = documents(spark, [None, "", "Hello  World", "Hello  World", "x"], [1, 2, 3, 3, None])
    docs = docs.withColumn("ids", F.lit("own")).withColumn("_value", F.lit(1))
    docs = docs.withColumn("decoded", F.lit(2))
    rows = sorted(bpe.round_trip(docs, own).collect(), key=lambda r: (r.doc_id or 9, r.ids))
    assert [r.decoded for r in rows] == ["", "", "hello</w> world</w>"] + [
        "hello</w> world</w>",
        "x</w>",
    ]
    encoded = bpe.encode(docs, own)
    assert encoded.columns == ["doc_id", "ids"]
    assert sorted(r.text for r in bpe.decode(encoded, own).collect()) == sorted(
        r.decoded for r in rows
    )
    empty = spark.createDataFrame([(1, None), (2, [999_999, None, -1])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(empty, own).collect()] == ["", ""]
    assert bpe.report(docs.limit(0), own).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with open(public_tokenizers.path(FILES[0])) as file:
        source = file.read()
    with pytest.raises(ValueError, match="known kind"):
        bpe.Vocabulary(source.replace('"NFC"', '"NFD"'))
