"""Licences: base places against plain search, and templates with small changes."""

import random
import re

from helpers import SAMPLE, by, dicts, documents, lower
from metricloom.llm import license_scan as ls
from metricloom.llm.storage import read

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_by_hand(text):
    found = WORD.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in ls.BASE:
        p = phrase.split()
        at = [i for i in range(len(found)) if found[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return {
        "n_words": len(found),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(labels)),
    }


def check(got, texts):
    for i, text in texts.items():
        expected = base_by_hand(text)
        assert {k: got[i][k] for k in expected} == expected, i
        assert set(expected["base_labels"].split(",")) - {""} <= set(got[i]["labels"].split(","))
        assert 0 <= got[i]["score"] <= 1


def test_sample(spark):
    docs = read(spark, SAMPLE, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = by(ls.scan_licenses(docs), "doc_id")
    check(got, texts)
    lines = ("gnu general public license", "all rights reserved", "mit license", "apache license", "cc by-nc")
    for i, text in texts.items():
        assert bool(got[i]["labels"]) == any(x in text.lower() for x in lines), text


def test_templates_with_changes(spark):
    filler = "the of and in that is " * 40
    expected, texts = {}, []
    for label, words, _ in ls.TEMPLATES:
        texts.append(f"{filler}\n// {words.title()}!\n{filler}")
        expected[len(texts) - 1] = label
    long = [(label, words) for label, words, phrases in ls.TEMPLATES if len(words.split()) > 20]
    for label, words in long:
        w = words.split()
        texts.append(" ".join([*w[:-4], "changed", *w[-3:]]) + " end")
        expected[len(texts) - 1] = label
    texts += [filler, "the license of the software is free", "permission is hereby granted " * 20]
    got = by(ls.scan_licenses(documents(spark, texts)), "doc_id")
    check(got, dict(enumerate(texts)))
    for i, label in expected.items():
        assert label in got[i]["labels"].split(","), (label, texts[i][:200])
    for i in range(len(expected), len(texts)):
        assert got[i]["labels"] == "" and got[i]["score"] == 0


def test_edge_texts(spark):
    texts = [
        None, "", " ", "UNDER the Mit-License", "under the mit\nlicense under the mit license", "CC BY-NC", "cc byénc",
        "apache license version 2" * 2, "K license 0a", "license " * 50_000, "under the mit license " * 5000,
    ]
    docs = documents(spark, texts).selectExpr("*", "1 as labels", "'x' as score")
    check(by(ls.scan_licenses(docs), "doc_id"), dict(enumerate(texts)))
    twice = documents(spark, ["mit", "mit"], [None, None])
    assert len(dicts(ls.scan_licenses(twice))) == 2
    assert ls.scan_licenses(docs.limit(0)).collect() == []


def test_frequencies_cover_all_documents(spark):
    texts = ["license"] * 7 + ["mit"] + ["nothing"] * 4
    idf = ls.document_frequencies(documents(spark, texts).repartition(3), ls.Index())
    assert idf["mit"] > idf["license"]


def test_licences_among_commoner_and_rarer_words(spark):
    wording = {label: words for label, words, _ in reversed(ls.TEMPLATES)}
    ordinary = " and then ".join(sorted(ls.Index().places))
    filler = " of the old house by the river" * 200 + " "
    three = ["gpl-3", "bsd", "all-rights-reserved"]
    long = filler.join(["", *(wording[x] for x in three), ordinary])
    # The rarest words of a template are elsewhere; what is left of it stands in full.
    mit = wording["mit"] = ls.TEMPLATES[0][1]
    rare = ["obtaining", "associated", "documentation", "deal", "merge", "publish", "sublicense", "sell"]
    less = " ".join(w for w in mit.split() if w not in rare) + filler + " and ".join(rare)
    texts = [long, less, f"{wording['gpl-3']} all rights reserved"]
    texts += ["All rights reserved. Redistribution of this source code is not permitted", wording["bsd"]] * 30
    got = by(ls.scan_licenses(documents(spark, texts)), "doc_id")
    assert set(three) <= set(got[0]["labels"].split(","))
    assert got[1]["labels"] == "mit" and 0.8 <= got[1]["score"] < 1
    assert got[2]["labels"] == "all-rights-reserved,gpl-3" and got[2]["score"] == 1


def by_every_place(words, index):
    """Labels and scores of all templates at all places of a text."""
    found = {}
    for label, expected, phrases in index.templates:
        for at in range(-len(expected), len(words)):
            part = words[max(0, at) : at + len(expected) + 2 * ls.SLACK]
            if all(ls.places_of(p, part) for p in phrases):
                score = ls._common_words(expected, part) / len(expected)
                if score >= ls.LEAST_SCORE:
                    found[label] = max(score, found.get(label, 0))
    return found


def licensed_texts(seed, n):
    """Prose with licences of which some words are changed, cut or added."""
    draw = random.Random(seed)
    prose = "the of and to in a is that it this software code you may use license any free rights".split()
    texts = []
    for _ in range(n):
        words = [draw.choice(prose) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            text = draw.choice(ls.TEMPLATES)[1].split()
            for _ in range(draw.randint(0, len(text) // 12)):
                at = draw.randrange(len(text))
                text[at : at + 1] = draw.choice(([], ["new"], [text[at], "new"]))
            words += text + [draw.choice(prose) for _ in range(draw.randint(0, 60))]
        texts.append(words)
    return texts


def frequencies(texts):
    index = ls.Index()
    n_of = {w: sum(w in t for t in map(set, texts)) for w in index.places}
    return index, {w: ls.math.log((len(texts) + 1) / (n + 1)) for w, n in n_of.items()}


def test_rare_words_find_what_every_place_gives():
    texts = licensed_texts(1, 250)
    index, idf = frequencies(texts)
    lookup = ls.Lookup(index, idf)
    expected = [by_every_place(t, index) for t in texts]
    got = [ls.matches(t, lookup) for t in texts]
    n = sum(map(len, expected))
    assert n > 300
    missed = [(i, x) for i, e in enumerate(expected) for x in e if x not in got[i]]
    assert len(missed) <= 0.01 * n, missed
    # A candidate's piece is a little longer than the template, so a word more may agree.
    assert all(got[i][x] >= e[x] for i, e in enumerate(expected) for x in e if x in got[i])


def test_frequencies_decide_what_is_looked_at():
    texts = licensed_texts(2, 200)
    index, idf = frequencies(texts)
    ranked, turned = ls.Lookup(index, idf), ls.Lookup(index, {w: -x for w, x in idf.items()})
    places = [[x.candidates(t) for t in texts] for x in (ranked, turned)]
    assert places[0] != places[1]
    looked_at = [sum(len(cells) for found in x for cells in found.values()) for x in places]
    assert looked_at[0] < 0.8 * looked_at[1]


def test_a_template_of_one_word(spark):
    templates = [("own", "proprietary", ("proprietary",)), *ls.TEMPLATES]
    texts = ["this is proprietary", "this is not", "proprietary"]
    got = by(ls.scan_licenses(documents(spark, texts), templates), "doc_id")
    assert [got[i]["labels"] for i in range(3)] == ["own", "", "own"]
