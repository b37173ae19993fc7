"""Main text of pages: wrappers, and extraction against known articles."""

import html
import random
import re
import time

from helpers import SAMPLE, by, pages
from metricloom.llm import html_wrappers as hw
from metricloom.llm.storage import read


def by_pattern(source):
    """The sample's template: h1 and p in article, never nested."""
    inside = re.search("<article>(.*?)(?:</article>|$)", source, re.S).group(1)
    blocks = [html.unescape(re.sub("<[^>]*>", " ", b)) for b in re.split("</?(?:p|h1)>", inside)]
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def test_sample(spark):
    table = read(spark, SAMPLE, "pages")
    got = by(hw.extract_text(table), "page_id")
    rows = table.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == by_pattern(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


NOISE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style></head><body class="x">
<header><h1>Site</h1></header><nav><ul><li><a href=a>Menu</a><li>More</ul></nav>
<div class="cookie-banner" id=c>We use cookies <button>OK</button></div>
{body}
<aside><p>Side</p></aside><div class="comments"><p>First!</p><p>Nice</p></div>
<form><p>Name <input name=n></p><textarea>t</textarea></form><div id="footer">&copy; us</div>
<script>document.write("<p>no</p>")</script><footer><p>Foot</p></footer></body></html>"""


def article(draw, n):
    return [" ".join("".join(draw.choices("abcdefg", k=6)) for _ in range(30)) for _ in range(n)]


def test_noise_around_and_inside_an_article(spark):
    draw, rows, expected = random.Random(1), [], {}
    for i in range(8):
        text = article(draw, 1 + i % 4)
        inner = "".join(f"<p>{t}\n &nbsp;\t<b>x</b>&lt;&eacute;<br>end" + "</p>" * (k % 2) for k, t in enumerate(text))
        ad = '<div class="ad"><p>Buy</p></div><!-- <p>hidden</p> --><span class="ads">now</span>' * (i % 2)
        rows.append((i, f"http://a.org/{i}", NOISE.format(body=f"<main><article><h1>Title {i}</h1>{ad}{inner}</article></main>")))
        expected[i] = "\n".join([f"Title {i}"] + [f"{t} x<é end" for t in text])
    got = by(hw.extract_text(pages(spark, rows)), "page_id")
    assert {i: got[i]["text"] for i in got} == expected


def test_names_of_articles_and_of_inline_elements(spark):
    body = (
        '<article class="post comments-open"><p>Kept <span class="ad">no <span>no</span> no</span>too</p>'
        '<ol><li><article class="comment-body"><p>Reader</p></article></li></ol></article>'
    )
    page = f'<body class="home sidebar">{body}</body>'
    got = hw.extract_text(pages(spark, [(1, "http://c.org/", page)])).first()
    assert got["text"] == "Kept too"


def test_without_semantic_tags_the_wrapper_finds_the_text(spark):
    draw, rows, expected = random.Random(2), [], {}
    for i in range(10):
        text = article(draw, 2 + i % 5)
        body = "<div class=top>Welcome</div><div class=content>" + "".join(f"<p>{t}</p>" for t in text) + "</div><div class=low><p>All of it</p></div>"
        rows.append((i, "http://b.org/x", NOISE.format(body=body)))
        expected[i] = "\n".join(text)
    got = by(hw.extract_text(pages(spark, rows)), "page_id")
    assert {i: got[i]["text"] for i in got} == expected


def test_edge_pages(spark):
    rows = [
        (1, None, None), (2, "http://a/", ""), (3, "http://a/", "plain words only"), (4, "http://a/", "<p>unclosed <b>bold"),
        (5, "http://a/", "<<>< &amp &#x41; &bogus; <p"), (6, "http://a/", "<script>only()"), (7, "http://a/", "<!-- open <p>x"),
        (None, "http://a/", "<article>x</article>"), (None, "http://a/", "<article>x</article>"),
        (8, "http://a/", "<p>" * 3000 + "deep" + "</div>" * 500), (9, "http://a/", '<p title="a>b">t</p>' + "<a href='" * 2000),
        (10, "http://a/", "<article>" + "<p>w</p>" * 20_000 + "</article>"), (11, "http://a/", "<div>" * 5000 + "x"),
    ]
    got = hw.extract_text(pages(spark, rows).selectExpr("*", "1 as host", "2 as main", "3 as text")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    assert text[1] == text[2] == text[6] == text[7] == ""
    assert text[3] == "plain words only" and text[4] == "unclosed bold" and text[None] == "x"
    assert "A" in text[5] and "&bogus;" in text[5]
    assert text[8] == "deep" and text[9] == "t" and text[10].count("\n") == 19_999 and text[11] == "x"
    assert hw.extract_text(pages(spark, [])).collect() == []


def nodes(stream):
    tree = hw.Tree()
    for t in stream.split():
        if t == "#":
            tree.text("x")
        elif t[0] == "/":
            tree.end()
        else:
            tree.start(t)
    return tree.holding()


def folded(streams):
    out = {}
    for s in streams:
        hw.add(out, s)
    return out


def test_alignment_makes_groups_and_options():
    one = nodes("div p # /p p # /p /div")
    assert hw.expression(one) == "div (p # /p)+ /div"
    streams = [one, nodes("div h1 # /h1 p # /p /div"), nodes("div p # /p ul li # /li li # /li /ul /div")]
    both = folded(streams)
    assert hw.expression(both) == "div (h1 # /h1)? (p # /p)+ (ul (li # /li)+ /ul)? /div"
    assert sum(n[hw.HELD] for n in both.values() if n[hw.STEP] == "#") == 7
    some = folded([nodes("div p # /p p # /p /div"), nodes("div # /div")])
    assert hw.expression(some) == "div (#)? (p # /p)* /div"
    for order in ((2, 0, 1), (1, 2, 0), (2, 1, 0)):
        parts = [folded([streams[i]]) for i in order]
        assert folded([folded(parts[:2]), parts[2]]) == folded([parts[0], folded(parts[1:])]) == both


def test_order_of_pages_does_not_change_the_main_element():
    streams = [nodes(f"nav # /nav article h1 # /h1 {'p # /p ' * n}/article") for n in range(1, 5)]
    for seed in range(5):
        random.Random(seed).shuffle(streams)
        wrapper = folded(streams)
        assert hw.path_of(wrapper, hw.main_element(wrapper)) == "/article"


def varying_pages(draw, n, notice="All texts here are under our house rules and may not be sold on."):
    """Pages of one host with two divs in varying order and a text that all have."""
    rows, expected = [], {}
    for i in range(n):
        text = article(draw, draw.randint(1, 5))
        body = "<div class=y>" + "".join(f"<p>{t}</p>" for t in text) + f"<p>{notice}</p></div>"
        long = f"<div class=x><p>{'Read our terms before you go on. ' * 60}</p></div>"
        parts = [body, long] if draw.random() < 0.5 else [long, body]
        rows.append((i, "http://v.org/p", f"<body><div class=c>{''.join(parts)}</div></body>"))
        expected[i] = "\n".join(text)
    return rows, expected


def test_the_wrapper_finds_what_a_page_alone_does_not(spark):
    rows, expected = varying_pages(random.Random(4), 40)
    for parts in (1, 2, 8):
        table = pages(spark, rows).repartition(parts)
        [found] = hw.infer_wrappers(table).collect()
        assert found["main"] == "/body/div.c/div.y" and len(found["fixed"]) == 2
        assert found["wrapper"] == "body div.c div.x p # /p /div.x div.y (p # /p)+ /div.y /div.c /body" or (
            found["wrapper"] == "body div.c div.y (p # /p)+ /div.y div.x p # /p /div.x /div.c /body"
        )
        got = by(hw.extract_text(table), "page_id")
        assert {i: got[i]["text"] for i in got} == expected
    alone = {i: hw.main_text(source, None) for i, _, source in rows}
    assert all(alone[i] != expected[i] for i in alone)
    # The main element is in each page.
    at = found["main_node"]
    assert all(at in hw.page_of(source).tree.nodes for _, _, source in rows)


def test_copies_of_an_article_are_not_taken_for_the_template(spark):
    text = article(random.Random(5), 4)
    page = "<article>" + "".join(f"<p>{t}</p>" for t in text) + "</article>"
    rows = [(i, "http://w.org/", page + f"<p>{i}</p>") for i in range(12)]
    rows.append((12, "http://w.org/", page.replace(text[0], "changed")))
    got = by(hw.extract_text(pages(spark, rows)), "page_id")
    assert all(got[i]["text"] == "\n".join(text) for i in range(12))
    assert got[12]["text"] == "\n".join(["changed", *text[1:]])


def test_articles_in_forms_and_readers_comments(spark):
    text = " ".join(f"word{i}" for i in range(60))
    fields = "<p>Name <input name=n></p><button>Go</button><select><option>A</option></select>"
    comments = '<div class="user-feedback"><p>Nice</p></div>'
    bodies = [
        f"<form id=f><div><article><p>{text}</p>{comments}</article></div></form>",
        f"<article><p>{text}</p><form>{fields}</form>{comments}</article>",
        f"<main><p>{text}</p></main><form><article><p>{text} too</p></article></form>",
    ]
    rows = [(i, f"http://f{i}.org/", f"<body>{b}</body>") for i, b in enumerate(bodies)]
    rows.append((3, "http://f3.org/", f"<body><form action=x><div><p>{text}</p><button>Go</button></div></form></body>"))
    got = by(hw.extract_text(pages(spark, rows)), "page_id")
    assert [got[i]["text"] for i in range(4)] == [text, text, f"{text} too", text]


def test_long_pages_are_aligned_in_linear_time():
    draw = random.Random(6)
    sources = ["<article>" + "".join(f"<{t}>{i}</{t}>" for i, t in enumerate(draw.choices(["p", "h2", "pre"], k=2000))) + "</article>" for _ in range(2)]
    trees = [hw.page_of(x).tree.holding() for x in sources]
    start = time.perf_counter()
    wrapper = folded(trees)
    assert hw.path_of(wrapper, hw.main_element(wrapper)) == "/article"
    assert time.perf_counter() - start < 0.2


def test_names_of_containers_do_not_drop_the_article(spark):
    text = " ".join(f"word{i}" for i in range(60))
    outer = [
        '<div class="content has-sidebar">{}</div>', '<div id="content" class="site-content no-sidebar">{}</div>',
        '<div class="post with-comments">{}</div>', '<section class="search-engines">{}</section>',
        '<div class="widget"><div class="x">{}</div></div>',
    ]
    side = '<div class="site-footer"><p>Foot</p></div><div id="sidebar-left"><p>Side</p></div><p class="ad-slot">Buy</p>'
    rows, expected = [], {}
    for i, around in enumerate(outer):
        for j, inner in enumerate((f"<p>{text}</p>", f"<article><p>{text}</p></article>")):
            rows.append((10 * i + j, f"http://h{i}{j}.org/", f"<body>{around.format(inner)}{side}</body>"))
            expected[10 * i + j] = text
    teaser = '<div class="related"><article><p>Other</p></article></div>'
    rows.append((100, "http://k.org/", f'<body><article class="post"><p>{text}</p>{teaser}</article></body>'))
    rows.append((101, "http://l.org/", f"<body><main><p>{text}</p></main><article><p>Short</p></article></body>"))
    got = by(hw.extract_text(pages(spark, rows)), "page_id")
    assert {i: got[i]["text"] for i in got} == expected | {100: text, 101: text}
