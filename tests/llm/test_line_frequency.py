"""Quality rules against counting by hand."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from helpers import SAMPLE, SPACES, by, dicts, documents, lower, words
from metricloom.llm import line_frequency
from metricloom.llm.storage import read


def base_by_hand(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n = len(found)
    return {
        "n_words": n,
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def normal(line):
    return lower(" ".join(words(line)))


def judged_by_hand(rows, line_documents, depleted_percent):
    """rows: (id, text, host). Words in lines that too many different texts of a host have."""
    having = defaultdict(set)
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            having[host, normal(line)].add(text)
    out = []
    for i, text, host in rows:
        base = base_by_hand(text)
        gone = sum(
            len(words(line))
            for line in (text or "").split("\n")
            if len(having[host, normal(line)]) > line_documents
        )
        kept = not base["base_failed"] and 100 * gone <= depleted_percent * base["n_words"]
        out.append({"doc_id": i, **base, "n_boilerplate_words": gone, "kept": kept})
    return out


def plain(rows):
    return sorted(
        ({k: v for k, v in r.items() if k != "key"} for r in rows), key=lambda r: repr(sorted(r.items(), key=str))
    )


def test_base_counts_on_edge_texts(spark):
    eight = "a b c d e f g h"
    texts = [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        f"{eight} {eight}",
        f"{eight} x {eight} y {eight}",
        "a " * 30,
        "x a b c d e f g h i j a b c d e f g h i j y " * 3,
        "A b\nA b\na b\n\n\n \nA b",
        "#*$%&|<> é𝄞 x y  z",
        " ".join(str(i) for i in range(20_000)) + " 1 2 3 4 5 6 7 8",
        "\x1c sep \x85 next",
    ]
    got = by(line_frequency.judge(documents(spark, texts)), "doc_id")
    for i, text in enumerate(texts):
        expected = base_by_hand(text)
        assert {k: got[i][k] for k in expected} == expected, i


def test_judge_on_the_sample(spark):
    docs = read(spark, SAMPLE, "documents")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    got = plain(dicts(line_frequency.judge(docs)))
    assert got == plain(judged_by_hand(rows, 10, 75))


def test_depleted_documents_go_and_copies_do_not_count_against_themselves(spark):
    draw = random.Random(3)

    def line():
        return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(25))

    menu = "Home  News\tContact " + line()
    rows = [(i, f"{line()}\n{menu.upper()}\n{line()}", "h1") for i in range(20)]
    rows += [(100 + i, f"{menu}\n {menu}\nread on", "h1") for i in range(3)]
    rows += [(200, f"{menu}\nread on", "h2")]
    rows += [(300 + i, rows[0][1], "h1") for i in range(40)]
    rows += [(None, rows[0][1], "h1"), (None, None, None), (5, rows[5][1], "h1")]
    docs = documents(spark, [r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows])
    got = plain(dicts(line_frequency.judge(docs)))
    expected = judged_by_hand([(i, t, h or "") for i, t, h in rows], 10, 75)
    assert got == plain(expected)
    kept = {r["doc_id"]: r["kept"] for r in expected}
    assert not kept[100] and kept[200] and kept[0] and kept[339]


def test_the_limit_is_the_same_in_a_large_host(spark):
    menu = "home news contact about us"
    body = " ".join(f"word{i}" for i in range(30))
    for others in (0, 600):
        rows = [(i, f"{menu}\n{body} {i}", "h") for i in range(11)]
        rows += [(100 + i, f"{body} {i} other", "h") for i in range(others)]
        docs = documents(spark, [r[1] for r in rows], [r[0] for r in rows], ["h"] * len(rows))
        got = by(line_frequency.judge(docs), "doc_id")
        assert {i for i in got if got[i]["n_boilerplate_words"] == 5} == set(range(11))


def test_empty_table_and_extra_columns(spark):
    docs = documents(spark, ["a " * 30]).selectExpr("*", "1 as words", "'x' as key", "2 as copy")
    assert line_frequency.judge(docs).count() == 1
    assert line_frequency.judge(docs.limit(0)).collect() == []


def test_lines_above_the_limits_are_taken_out(spark):
    draw = random.Random(4)

    def line():
        return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(25))

    menu = "Home News\tContact"
    rows = [(i, f"{menu}\n{line()}\n\n {menu.upper()} \n{line()}\n", "h1") for i in range(20)]
    rows += [(30, f"{menu}\n{line()}", "h2"), (31, line(), "h1"), (32, None, "h1"), (33, menu, "h1")]
    rows += [rows[0], (None, rows[1][1], "h1")]
    docs = documents(spark, [r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows])
    clashing = docs.selectExpr("*", "1 as cut", "2 as KEY", "3 as `a.b`")
    assert line_frequency.without_boilerplate(clashing).columns == clashing.columns
    got = line_frequency.without_boilerplate(docs)
    assert got.columns == docs.columns
    expected = [
        (i, "\n".join(x for x in text.split("\n") if h != "h1" or normal(x) != normal(menu)))
        for i, text, h in rows
        if i not in (32, 33)
    ]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(expected, key=str)
    # The pipeline's first stage hands on the same texts.
    staged = corpus_pipeline.quality_rules(spark, docs, SAMPLE).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in staged), key=str) == sorted(expected, key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in staged)
