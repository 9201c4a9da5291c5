import random
import re
from html import unescape

import pyarrow.parquet as pq

from lodgeflow.llm import html_wrapper, queries

SF = "/root/testdata/sf0.001"


def brute(html):
    """The article of a given page, by its known markup."""
    article = re.search(r"<article>(.*?)</article>", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1|h2|ul|li|div)>", article[1]) if article else []
    texts = [" ".join(unescape(re.sub("<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/pages.parquet").to_pydict()
    want = sorted((i, u, brute(h), len(brute(h))) for i, u, h in zip(t["page_id"], t["url"], t["html"]))
    assert sorted(map(tuple, queries.op9_html(spark, SF).collect())) == want


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id bigint, url string, html string, text string, host string")


def test_template_is_learned_without_an_article_element(spark):
    page = "<body><div class=top>My site</div><div class=box><h2>{t}</h2><p>{a}<p>{b}</div><div>All rights reserved</div></body>"
    rows = [(k, f"http://h.example/{k}", page.format(t=f"Title {k}", a=f"first {k}", b=f"second {k}")) for k in range(6)]
    rows += [(10, "http://one.example/", page.format(t="T", a="x", b="y"))]
    got = {r.page_id: r.text for r in html_wrapper.main_texts(table(spark, rows)).collect()}
    assert got[3] == "Title 3\nfirst 3\nsecond 3"
    assert got[10] == "My site\nT\nx\ny\nAll rights reserved"  # nothing to compare with


def test_copies_keep_their_text(spark):
    page = "<body><article><h1>Same</h1><p>text</article><div>foot</div></body>"
    rows = [(k, "http://h/", page) for k in range(9)] + [(20 + k, "http://h/", page.replace("foot", f"foot {k}")) for k in range(9)]
    got = html_wrapper.main_texts(table(spark, rows)).collect()
    assert {r.text.split("\nfoot")[0] for r in got} == {"Same\ntext"}


def test_edge_pages(spark):
    pages = {
        None: "", "": "", "plain  text &amp; more": "plain text & more", "a < b <3": "a < b <3",
        "<p>one<p>two<br>half<b>bold</b></p>tail": "one\ntwo halfbold\ntail",
        "<article><nav>m</nav><p>x</p><div class='reader-comments'><p>no</p></div><aside>s</aside>y</article>": "x\ny",
        "<script>var a='<p>no</p>'</script><p>yes<!-- <p>no</p> --></p><style>p{}</style>": "yes",
        "<form><p>no</p></form><ul><li>a<li>b</ul></div></p>": "a\nb", "<p>&nbsp;&#233;&lt;p&gt;</p>": "é<p>",
        "<script>never closed <p>x": "", "<div>" * 3000 + "deep" + "</div>" * 3000: "deep",
        "<p>" + "long " * 50_000: ("long " * 50_000).strip(), "<h2>a</h2><p>b</p>" * 300: "\n".join("ab" * 300),
        '<div title="a > b">q</div>': "q", "<header>h</header><footer>f</footer><main>m</main>": "m",
    }
    rows = [(k, None if k % 2 else "no url", h) for k, h in enumerate(pages)] + [(None, None, "<p>z</p>")] * 2
    got = html_wrapper.main_texts(table(spark, rows)).collect()
    texts = dict(enumerate(pages.values()))
    assert len(got) == len(rows)
    for row in got:
        assert row.text == texts.get(row.page_id, "z")
    assert html_wrapper.main_texts(table(spark, rows).limit(0)).collect() == []


def test_matching_is_largest():
    def shape(data):
        return html_wrapper.unpacked(data)

    leaf = lambda s, h=0: [s, h, 0, []]
    a = shape(["r", 1, 0, [leaf("a", 1), leaf("b", 2), ["c", 3, 0, [leaf("d", 4), leaf("e", 5)]]]])
    b = shape(["r", 9, 0, [leaf("b", 8), ["c", 7, 0, [leaf("e", 6)]], leaf("a", 1)]])
    signs = [x.sign for x, y in html_wrapper.aligned(a, b)]
    assert sorted(signs) == ["b", "c", "e", "r"]
    assert html_wrapper.aligned(a, shape(leaf("q"))) == []


def test_siblings_of_one_tag_are_told_apart(spark):
    page = "<body><div>menu</div><div>story {k}</div><div>legal</div></body>"
    rows = [(k, "http://a/", page.format(k=k)) for k in range(6)]
    story = lambda k: [f"<p>story {k} {j}</p>" for j in range(8)]
    for k in range(6):
        parts = story(k)
        parts.insert(k, "<p>Subscribe</p>")
        rows.append((10 + k, "http://b/", "<body>" + "".join(parts) + "</body>"))
    got = {r.page_id: r.text for r in html_wrapper.main_texts(table(spark, rows)).collect()}
    for k in range(6):
        assert got[k] == f"story {k}"
        assert got[10 + k] == "\n".join(f"story {k} {j}" for j in range(8))


def test_long_child_lists_are_aligned_whole(monkeypatch):
    def page(k):
        return "".join(f"<p>{k} {j}</p>" + "<div>ad here</div>" * (j == 150 + k) + "<p>fixed</p>" * (j == 200 - k) for j in range(300 + k))

    trees = [html_wrapper.shaped(html_wrapper.parsed(page(k))) for k in range(2)]
    for cells in (1 << 20, 1000):
        monkeypatch.setattr(html_wrapper, "CELLS", cells)
        pairs = html_wrapper.aligned(*trees)
        same = {a.node.text for a, b in pairs if a.hash == b.hash} - {""}
        assert same == {"ad here", "fixed"}
        assert len(pairs) > 590


def test_template_does_not_hang_on_the_first_page(spark):
    page = "<body><div>menu</div><section><h2>story {k}</h2></section><div>legal</div></body>"
    other = "<body><table><tr><td>shop</td></tr><tr><td>item {k}</td></tr></table><p>imprint</p></body>"
    firsts = [None, "", "<h1>Error</h1>", page.replace("<div>menu</div>", "").format(k="x")]
    rows = [(k, "http://a/", h) for k, h in enumerate(firsts)]
    rows += [(10 + k, "http://a/", page.format(k=k)) for k in range(12)]
    rows += [(30 + k, "http://a/", other.format(k=k)) for k in range(5)]
    got = {r.page_id: r.text for r in html_wrapper.main_texts(table(spark, rows)).collect()}
    assert {got[10 + k] for k in range(12)} == {f"story {k}" for k in range(12)}
    assert [got[30 + k] for k in range(5)] == [f"item {k}" for k in range(5)]
    assert (got[0], got[1], got[2]) == ("", "", "Error")


def texts(spark, pages, host="http://h.example/"):
    rows = [(k, f"{host}{k}", h) for k, h in enumerate(pages)]
    found = html_wrapper.main_texts(table(spark, rows)).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


MENU = "<ul><li><a href=/a>{}</a></li><li><a href=/b>{}</a></li><li><a href=/c>{}</a></li></ul>"


def _site(k):
    menu = MENU.format(*(f"{w} {k}" for w in ("News", "Shop", "Help")))
    return f"<body><div>My site</div>{menu}<div><h2>Title {k}</h2><p>first {k} of a story</p><p>second {k}</p></div><div>Imprint</div></body>"


def test_the_wrapper_decides_without_names_and_articles(spark, monkeypatch):
    """Menus whose labels vary, a fixed head and foot: all found by alignment, and kept with the wrapper switched off."""
    pages = [_site(k) for k in range(6)]
    want = [f"Title {k}\nfirst {k} of a story\nsecond {k}" for k in range(6)]
    assert texts(spark, pages) == want
    off = [html_wrapper.extracted(p.encode(), None, None) for p in pages]
    assert all("News" in t and "My site" in t and "Imprint" in t for t in off)
    monkeypatch.setattr(html_wrapper, "SENT_BYTES", -1)  # pages joined with their wrappers
    assert texts(spark, pages) == want


def test_versions_of_one_story_keep_it(spark):
    """Pages that differ in a date only are no different pages, also beside another page of the site."""
    story = "<body><div><h1>The long story</h1><p>" + "It goes on and on. " * 9 + "</p><p>And ends.</p><div>{}</div></div></body>"
    versions = [story.format(f"2025-01-0{k}") for k in range(1, 5)]
    assert all("It goes on" in t and t.endswith(f"0{k}") for k, t in enumerate(texts(spark, versions), 1))


def test_names_are_whole_words_and_give_way_to_the_tree(spark):
    body = "<h1>Title</h1><p>The text of the story, which is longer than all else on the page.</p>"
    whole = "Title\nThe text of the story, which is longer than all else on the page."
    pages = {
        f'<div class="content has-sidebar">{body}</div>': whole,
        f'<div class="sidebar">{body}</div><p>end</p>': f"{whole}\nend",
        f'<div class="page"><div class="sidebar">by the side</div>{body}</div>': whole,
        f'<div class="sidebar"><article>{body}</article></div>': whole,
        f'<article>{body}<div class="related-work">see also</div><p id="social">on society</p></article>': f"{whole}\nsee also\non society",
        f'<article>{body}<section class="comments-on-the-law">on law</section></article>': f"{whole}\non law",
        f'<article>{body}<div class="reader-comments"><p>no</p></div><div class="share-buttons">no</div></article>': whole,
        f'<div class="ad-slot">' + "buy " * 99 + f"</div><article>{body}</article>": whole,
        f"<form>{body}<button>send</button></form>": whole,
        f"<form>search</form><div>{body}</div>": whole,
        f'<ul class="nav-links"><li>one<li>two</ul>{body}': whole,
    }
    got = texts(spark, pages, "http://x")
    assert got == list(pages.values())


def test_part_of_names():
    yes = ["ad", "top ad", "Sidebar", "sidebar-left", "reader-comments", "article__comments", "cookie-box", "share_buttons"]
    no = ["has-sidebar", "no-comments", "related-work", "comments-on-the-law", "adventure", "shared", "without-ads", "", "-"]
    assert all(map(html_wrapper.named, yes)) and not any(map(html_wrapper.named, no))


def test_lists_of_links_inside_a_story_stay(spark):
    """A list of links is a menu only where nearly all pages have it; links within sentences make none."""
    pages = [_site(k).replace("<p>second", (MENU.format("x", "y", k) if k == 2 else "") + "<p>second") for k in range(12)]
    pages = [p.replace("first", "<a href=/>first</a>") for p in pages]
    got = texts(spark, pages)
    assert got[2] == "Title 2\nfirst 2 of a story\nx\ny\n2\nsecond 2" and got[3] == "Title 3\nfirst 3 of a story\nsecond 3"


def test_the_wrapper_decides_on_the_given_pages(spark):
    """With names and tags taken away, alignment still finds the menus of hosts with enough pages."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    known = {(r.host, r.layout): r for r in html_wrapper.wrappers(rows.selectExpr("page_id", "lower(parse_url(url, 'HOST')) AS host", "html")).collect()}
    removed = 0
    for r in rows.selectExpr("lower(parse_url(url, 'HOST')) AS host", "html").collect():
        root = html_wrapper.parsed(r.html)
        wrapper = known.get((r.host, html_wrapper.layout_of(root)))
        if wrapper:
            taken = html_wrapper._template(root, wrapper.reference, wrapper.template)
            nodes, stack = [], [root]
            while stack:
                node = stack.pop()
                nodes.append(node)
                stack += node.nodes
            removed += any(id(n) in taken and "a" not in n.sign for n in nodes if n.sign == "nav" or n.sign == "ul")
    assert removed >= 100


def test_short_child_lists_need_no_arrays(monkeypatch):
    """Short lists are aligned in plain lists, with the pairs that arrays give, ties included."""
    rng = random.Random(3)

    def page(depth=0):
        parts = (page(depth + 1) if depth < 3 else "" for _ in range(rng.randrange(4)))
        tag = rng.choice(("div", "section"))
        return f"<{tag}>{rng.choice(('x', 'y', 'z', ''))}{''.join(parts)}</{tag}>"

    trees = [html_wrapper.shaped(html_wrapper.parsed("".join(page() for _ in range(4)))) for _ in range(120)]
    both = list(zip(trees[::2], trees[1::2]))
    numbers = lambda: [[(a.number, b.number) for a, b in html_wrapper.aligned(*pair)] for pair in both]
    monkeypatch.setattr(html_wrapper, "FEW_CELLS", 0, raising=False)
    want = numbers()
    monkeypatch.undo()
    monkeypatch.setattr(html_wrapper, "_step", None)
    assert numbers() == want
