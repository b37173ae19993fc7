"""Alignment against reading both token lists end by end."""

import hashlib
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import SMALL, by, documents
from metricloom.llm import token_alignment as alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    return alignment.pair(A, B)


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by the public libraries: lists of (A ids, B ids)."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [c for c in range(256) if c not in signs]
    byte = {chr(c): c for c in signs} | {chr(256 + i): c for i, c in enumerate(others)}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        raw = (" " + text).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        texts_a = [bytes(byte[s] for s in a.id_to_token(i)) for i in ids_a]
        texts_b = [of_b(i) for i in ids_b]
        if b"".join(texts_a) != raw or b"".join(texts_b) != raw:
            return []
        out, i, j, at, bt = [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at == bt and out[-1][0]:
                out.append(([], []))
            if at <= bt and i < len(ids_a):
                out[-1][0].append(ids_a[i])
                at += len(texts_a[i])
                i += 1
            else:
                out[-1][1].append(ids_b[j])
                bt += len(texts_b[j])
                j += 1
        return out

    return groups


def expected_report(rows, groups_of):
    held, docs = Counter(), []
    for doc, text in rows:
        groups = groups_of(text)
        links = Counter((p, q) for a, b in groups for p in a for q in b)
        held.update(links.keys())
        docs.append((doc, groups, links))
    most = defaultdict(int)
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    for doc, groups, links in docs:
        spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        yield {
            "doc_id": doc,
            "n_a": sum(len(a) for a, _ in groups),
            "n_b": sum(len(b) for _, b in groups),
            "n_groups": len(groups),
            "n_links": sum(links.values()),
            "n_best": sum(n for k, n in links.items() if held[k] == most[k[0]]),
            "count_sum": sum(n * held[k] for k, n in links.items()),
            "groups_sha256": hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
        }


HARD = [
    None,
    "",
    "plain words, plain words",
    "the piece sign ▁ is no space here",
    "<|endoftext|> and <s> stand as they are",
    "日本語のテキスト 😀😀 é İ",
    "    spaces   and\ttabs\n\n\nlines   ",
    "=" * 700 + "aaaa" * 300,
    "\x00\x01 control",
    "plain words, plain words",
]


def test_whole_table(spark, own, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(HARD)]
    table = documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(5)
    found = by(alignment.report(table, own), "doc_id")
    assert len(found) == len(rows)
    for row in expected_report(rows, plain):
        assert found[row["doc_id"]] == row


def test_chunks_and_slices_do_not_change_the_result(spark, own, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    whole = by(alignment.report(docs, own), "doc_id")
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 2000)
    monkeypatch.setattr(alignment, "SLICE_CHARS", 500)
    monkeypatch.setattr(alignment, "PAIRS_PER_ROW", 7)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert by(alignment.report(docs.repartition(3), own), "doc_id") == whole


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 64, 10_000])
def test_pieces_and_stitching(steps):
    rng = random.Random(steps)
    for _ in range(60):
        last = rng.randint(1, 90)
        a, b = (
            np.array(sorted({last, *rng.sample(range(1, last + 1), rng.randint(0, last))}))
            for _ in range(2)
        )
        in_a, in_b = alignment.closers(a, b, steps)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[in_a].tolist() == common and b[in_b].tolist() == common


@pytest.mark.parametrize("sizes", [(5000, 5000), (9000, 10), (1, 9000)])
def test_pieces_are_of_equal_work(sizes):
    rng = np.random.default_rng(1)
    a, b = (np.sort(rng.choice(20_000, n, replace=False)) for n in sizes)
    low = alignment.crossings(a, b, 100)
    total = len(a) + len(b)
    other = np.minimum(np.arange(len(low)) * 100, total) - low
    work = np.diff(low) + np.diff(other)
    assert (np.diff(low) >= 0).all() and (np.diff(other) >= 0).all()
    assert (work[:-1] == 100).all() and work.sum() == total
    # All of a piece comes before all of the next; equal ends may straddle the border.
    for i, j in zip(low[1:-1], other[1:-1], strict=True):
        before = max([*a[i - 1 : i], *b[j - 1 : j]] if i and j else [*a[:i][-1:], *b[:j][-1:]])
        after = min([*a[i : i + 1], *b[j : j + 1]])
        assert before <= after


def test_align_gives_the_groups(spark, own, plain):
    docs = documents(spark, HARD, [*range(9), None]).withColumn("in_a", F.lit(1))
    docs = docs.withColumn("_text", F.lit("x")).withColumn("chunk", F.lit(2))
    rows = alignment.align(docs, own).collect()
    assert len(rows) == len(HARD)
    texts = dict(enumerate(HARD)) | {None: HARD[-1]}
    for row in rows:
        a, b, groups = list(row.a), list(row.b), []
        for m, n in zip(row.in_a, row.in_b, strict=True):
            groups.append((a[:m], b[:n]))
            a, b = a[m:], b[n:]
        assert groups == plain(texts[row.doc_id]) and not a and not b
    assert alignment.report(docs, own).count() == len(HARD)
    assert alignment.report(docs.limit(0), own).collect() == []


def test_packed_numbers():
    for numbers in ([], [0], [255, 256], [1 << 40, 3]):
        got = alignment.unpacked(alignment.packed(np.array(numbers, np.int64)))
        assert got.tolist() == numbers


class Counting:
    """A tokenizer that counts the characters it is asked to encode."""

    def __init__(self, encoder):
        self.encoder, self.chars = encoder, 0

    def encode(self, texts, **options):
        self.chars += len(texts) if isinstance(texts, str) else sum(map(len, texts))
        return self.encoder.encode(texts, **options)


def test_common_words_are_encoded_once(monkeypatch):
    own = alignment.pair(A, B)
    monkeypatch.setattr(own, "b", Counting(own.b))
    texts = [f"the word {i} stands\nin the text" for i in range(40)]
    alignment.Aligned(own, texts)
    first, own.b.chars = own.b.chars, 0
    alignment.Aligned(own, [" ".join(texts[i] for i in range(k, 40, 3)) for k in range(3)])
    assert 0 < first < 800 and own.b.chars < 100


def test_later_tasks_of_a_process_find_what_is_known(own):
    sent = pickle.dumps(own)
    first = pickle.loads(sent)
    alignment.Aligned(first, ["a text of some words"])
    later = pickle.loads(sent)
    assert later is first and " words" in later.known.numbers


SIGNS = [
    *" \t\n\r\x0b\x0c\x85\xa0\u1680\u2002\u200a\u200b\u2028\u202f\u205f\u3000\ufeff\x00\x1c\x1f",
    *"ab;){}'1=é́日本😀İ▁\u0378\U0001cc00",
    *["  ", "    ", ";\r\n", "'s", " the", "<s>", "<0x0A>", "<|endoftext|>", "x" * 70, " \r", "\n\n "],
]


@pytest.mark.parametrize("known", [1, 30, 1 << 18])
def test_segments_give_the_ids_of_the_whole(known, own, monkeypatch):
    assert own.known is not None
    monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", known)
    monkeypatch.setattr(alignment, "KNOWN_LENGTH", 6)
    monkeypatch.setattr(own, "known", alignment._Segments(own, own.known.segment))
    rng = random.Random(known)
    words = [s for s in SIGNS if s != "▁"]
    for _ in range(60):
        texts = [
            "".join(rng.choices(SIGNS if k % 4 == 0 else words, k=rng.randint(0, 25)))
            for k in range(20)
        ] + [None, "", " ", "\n", "\r"]
        a, b, n_a, n_b = own.encode_all(texts)
        for text, of_a, of_b in zip(
            texts, np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1]), strict=True
        ):
            whole = own.encode(text) or ([], [])
            assert of_a.tolist() == list(whole[0]) and of_b.tolist() == list(whole[1]), repr(text)
        assert len(own.known.numbers) <= known
        assert all(len(s) <= 6 for s in own.known.numbers)


def test_white_space_is_that_of_the_pattern():
    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert re.findall(f"[{alignment.WHITE}]", signs) == regex.findall(r"\s", signs)


def test_no_cut_where_a_piece_goes_on_into_white_space(own, monkeypatch):
    model = alignment.model_pb2.ModelProto.FromString(own.b_model)
    cut = alignment.segment_pattern(own.b_model).findall
    assert cut(" a;\r\n b c\nd") == [" a;\r\n b", " c", "\nd"]
    for piece in ("a▁b", "x\n"):
        other = alignment.model_pb2.ModelProto.FromString(own.b_model)
        other.pieces[-1].piece = piece
        assert alignment.segment_pattern(other.SerializeToString()) is None
    model.normalizer_spec.remove_extra_whitespaces = True
    assert alignment.segment_pattern(model.SerializeToString()) is None
    # Texts are then encoded whole.
    segments = own.encode_all(HARD)
    monkeypatch.setattr(own, "known", None)
    for x, y in zip(segments, own.encode_all(HARD), strict=True):
        assert x.tolist() == y.tolist()
