from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import site_tree as S
from tests.llm.cases import plain, prose

SCHEMA = "page_id long, url string, html string"


def weigh(sources: list) -> tuple[dict, list]:
    """By node of one host (pages shown, importance), and its trunk, in plain Python."""
    whole = {"\n".join(b[0] for b in p.blocks): p for p in map(S.Page, sources)}
    pages, m = list(whole.values()), len(whole)
    line, n, size, linked = {}, defaultdict(int), defaultdict(int), defaultdict(int)
    texts, shapes = defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int))
    for page in pages:
        for node, (at, seen) in page.nodes.items():
            line[node] = at
            n[node] += 1
            for shape in seen:
                shapes[node][shape] += 1
        shown = set()
        for text, node, chars, in_links, _, inside, _ in page.blocks:
            key = node, re.sub("[0-9]+", "#", text.lower())
            if key not in shown:
                texts[node][key[1]] += 1
                size[node] += chars
                linked[node] += 0 if inside else in_links
            shown.add(key)
    base = math.log(m) if m > 1 else None
    unique = {v: 1 - (sum(math.log(c) for c in texts[v].values()) / len(texts[v]) / base if base and texts[v] else 0) for v in n}
    alone = {v: max(0.0, 1 - linked[v] / size[v]) if size[v] else 1.0 for v in n}
    style = {}
    for v in n:
        total = sum(shapes[v].values())
        style[v] = max(0.0, -sum(c / total * math.log(c / total) for c in shapes[v].values()) / base) if base else 0.0
    info = {v: size[v] * unique[v] * alone[v] for v in n}
    mass = {v: sum(i for w, i in info.items() if v in line[w]) for v in n}
    trunk = [v for v in sorted(n, key=lambda v: len(line[v])) if mass[v] > mass[S.ROOT] / 2 and (v == S.ROOT or any(info[w] > 0 and v in line[w][:-1] for w in n))]
    made = {}
    for v in n:
        bulk, share, beside = mass[trunk[-1]] if trunk else 0, 0.0, [w for w in line[v] if w not in trunk]
        unit = trunk[-1] if trunk and trunk[-1] in line[v] else beside[0] if beside else v
        if bulk:
            share = min(1.0, (info[v] if unit in trunk[:-1] else mass[unit]) / bulk)
        made[v] = n[v], unique[v] * alone[v] * ((1 - S.PRESENTATION) * share + S.PRESENTATION * min(1.0, style[unit]))
    return made, trunk


def brute(sources: list, weight: float = S.WEIGHT) -> list[str]:
    """The texts of one host's pages in plain Python."""
    made, trunk = weigh(sources)
    out = []
    for page in map(S.Page, sources):
        clean = [not set(b[4]) - set(trunk) for b in page.blocks]
        article = any(c and b[5] for c, b in zip(clean, page.blocks, strict=True))
        kept = []
        for c, b in zip(clean, page.blocks, strict=True):
            shown, value = made[b[1]]
            w = weight * shown / (shown + S.PRIOR_PAGES)
            if w * value + (1 - w) * (c and (b[5] or not article)) >= S.KEEP:
                kept.append(b[0])
        out.append("\n\n".join(kept))
    return out


def text(source: str) -> str:
    return brute([source])[0]


def test_elements_that_are_no_article_text_go():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p><p>no";</script></head><body>
    <header>site <p>header</p></header><nav><ul><li>menu</ul></nav><div class="cookie-notice">cookies</div><div id=sidebar><p>side</div>
    <article><header><h1>Title &amp; more</h1></header><p>One<br>two&nbsp; three<p title="a>b">Four <b>bold<i>er</i>.</p><!-- <p>no</p> --><pre> a
    b</pre><form>f<input value="x"></form><div class="ad">buy</div><ul><li>x<li>y</ul><section class="comments"><p>reader</p></section></article>
    <aside>more</aside><footer>&copy; f</footer>"""
    assert text(page).split("\n\n") == ["Title & more", "One two three", "Four bolder.", "a b", "x", "y"]


def test_broken_pages():
    assert text("") == text("<p>") == text("<script>never closed <p>x") == ""
    assert S.Page(None).blocks == []
    assert text("plain text") == "plain text"
    assert text("a < b & c &lt;d&gt; &unknown; <") == "a < b & c <d> &unknown; <"
    assert text("<p>a</div></p></x>b<p>c") == "a\n\nb\n\nc"
    assert text("<P CLASS='Story'>a<img alt=\"x>y\">b</P><p hidden>h</p><p style='display: none'>n") == "a b"
    assert text("<p>cut <a href=\"unclosed>x</p><p>y") == text("<p>cut <a href=\"unclosed>x</p><p>y")
    assert len(text("<p>" + "x " * 100_000 + "<div>" * 3000 + "deep")) > 200_000


def site(host: str, n: int) -> list[tuple]:
    return [(i, f"https://{host}/p/{i}", f"<body><div class=x><p>Always the same line</p></div><div class=y><p>{prose(i, 30)}</p><p>{prose(100 + i, 30)}</p></div></body>") for i in range(n)]


def hosts() -> list[tuple]:
    """Three hosts: one with names and an article, one without, one of odd pages; copies among them."""
    rows = []
    for i in range(24):
        menu = "".join(f"<li><a href='/{k}'>{prose(900 + i * 7 + k, 1)}</a></li>" for k in range(5))
        story = "".join(f"<p>{prose(i * 31 + k, 25)}</p>" for k in range(1 + i % 4))
        rows.append((i, f"http://named.org/{i}", f"<body><nav><ul>{menu}</ul></nav><div class=ad>{prose(700 + i, 5)}</div><article><h1>{prose(300 + i, 5)}</h1>{story}<div class=comments><p>{prose(i, 40)}</p></div></article><footer>(c) {i} all rights</footer></body>"))
        rows.append((100 + i, f"http://bare.org/{i}", f"<body><div><ul>{menu}</ul></div><div>{prose(700 + i, 5)}</div><div><h1>{prose(300 + i, 5)}</h1>{story}</div><div>(c) {i} all rights</div></body>"))
        rows.append((200 + i, f"http://bare.org/copy{i}", rows[1][2]))
        rows.append((300 + i, "http://odd.org/", ["<p>x", None, "", "plain", "<div><a>all linked</a></div>", "<div>" * 600 + "deep", "<header>h</header><p>y</p>"][i % 7]))
    return rows


def test_equals_plain_python(spark):
    rows = hosts()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["page_id"]: r["text"] for r in S.extract(df).collect()}
    seen = S.parsed(df)
    nodes, trunks = S.node_importance(seen)
    trunk_of = {r["host"]: r["trunk"] for r in trunks.collect()}
    for host in ("named.org", "bare.org", "odd.org"):
        its = [(i, h) for i, u, h in rows if u.startswith(f"http://{host}/")]
        made, trunk = weigh([h for _, h in its])
        here = {r["node"]: (r["n"], r["importance"]) for r in nodes.where(F.col("host") == host).collect()}
        assert here.keys() == made.keys() and trunk_of[host] == trunk
        for node, (n, value) in made.items():
            assert here[node][0] == n and here[node][1] == pytest.approx(value, abs=1e-9)
        assert [got[i] for i, _ in its] == brute([h for _, h in its])


def test_without_names_the_tree_finds_the_article(spark):
    rows = [r for r in hosts() if 100 <= r[0] < 300]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {i: re.findall(r"<(?:h1|p)>([^<]*)", h) for i, _, h in rows}
    assert {r["page_id"]: r["text"].split("\n\n") for r in S.extract(df).collect()} == want
    assert all("all rights" in r["text"] for r in S.extract(df, weight=0).collect())


def test_names_and_tree_agree(spark):
    rows = [r for r in hosts() if r[0] < 100]
    got = {r["page_id"]: r["text"].split("\n\n") for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: re.findall(r"<(?:h1|p)>([^<]*)", h.split("<div class=comments>")[0]) for i, _, h in rows}


def test_lines_that_all_pages_share_go(spark):
    rows = site("Big.example.org", 20) + [(100 + i, u, h) for i, u, h in site("small.example.org", 2)]
    got = {r["page_id"]: r["text"] for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(20):
        assert got[i] == f"{prose(i, 30)}\n\n{prose(100 + i, 30)}"
    assert got[100].startswith("Always the same line")  # two pages say little against it


def test_a_long_menu_does_not_take_short_articles_along(spark):
    menu = "".join(f"<li>Entry {k}</li>" for k in "abcdefghijklmnopqrst")
    rows = [(i, f"https://menu.org/{i}", f"<html><body><ul>{menu}</ul><div class=story><p>{prose(i, 30)}</p><p>{prose(100 + i, 30)}</p></div></body></html>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"{prose(i, 30)}\n\n{prose(100 + i, 30)}" for i in range(20)}


def test_deep_pages_stay_small():
    page = S.Page("<div>" * 20_000 + "deep")
    assert len(page.nodes) == S.DEPTH + 1 and page.blocks[0][0] == "deep"


def test_a_name_does_not_condemn_an_article():
    assert text("<div class='content-sidebar-wrap'><article><p>Story</p></article><div class=sidebar><p>side</p></div></div>") == "Story"
    assert text("<main class='no-sidebar'><p>Story</p></main>") == "Story"
    assert text("<div class='page has-share'><main><article class='post comments-open'><p>Story</p></article></main></div>") == "Story"
    assert text("<main><article><p>Story</p></article><div id=comments><article class='comment'><p>reader</p></article></div></main>") == "Story"
    assert text("<nav><article><p>menu</p></article></nav><p>Story</p>") == "Story"


def test_an_important_node_overrules_its_name(spark):
    rows = [(i, f"https://wrap.org/{i}", f"<body><div class='page has-share'><p>{prose(i, 30)}</p></div></body>") for i in range(10)]
    got = {r["page_id"]: r["text"] for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: prose(i, 30) for i in range(10)}


def test_copies_of_a_page_count_once(spark):
    rows = site("a.org", 8) + [(1000 + i, f"http://a.org/c{i}", site("a.org", 8)[3][2]) for i in range(200)]
    got = {r["page_id"]: r["text"] for r in S.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1000] == got[3] == f"{prose(3, 30)}\n\n{prose(103, 30)}"


def test_awkward_rows(spark):
    rows = [(1, None, "<p>x"), (2, "no url", None), (None, "http://[bad", "<p>y</p>"), (1, None, "<p>x"), (3, "", "")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA + ", host string, low string")
    want = [(1, None, "x", 1), (1, None, "x", 1), (2, "no url", "", 0), (3, "", "", 0), (None, "http://[bad", "y", 1)]
    assert plain(S.extract(df)) == sorted(want, key=repr)
    assert plain(S.extract(spark.createDataFrame([], SCHEMA))) == []
