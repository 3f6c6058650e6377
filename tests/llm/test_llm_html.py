import html
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

from llm_cases import invented

from flightlake.llm.html_tree import LENGTH_STEP, PATH_CHARS, extract, host_of, low_paths, main_text, parse, style_tree, text_blocks

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="has-menu"><header>Top</header>
<nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>T &#233; &amp;lt;</h1></header><p>a<p>b <b>c<i>d</b> e &lt;x&gt; 3 < 4 <span class="ad">Buy</span>f<br>g
<script>if(a<b){"</p>"}</script><ul><li>one<li>two</ul><form><input value="q">Name<button>Go</button></form>
<!-- <p>hidden</p> --><table><tr><td>c1<td>c2</table><pre>x
  y</pre><section id="comments"><article class="comment"><p>reply</p></article></section></article>
<aside>side</aside><p>outside</p><footer>&copy; z"""


def test_parts_of_a_page():
    assert main_text(parse(PAGE)) == "T é &lt; a b cd e <x> 3 < 4 f g one two c1 c2 x y"
    assert main_text(parse("")) == "" and main_text(parse("plain &amp; text")) == "plain & text"
    assert main_text(parse('<div class="page">x<div class="sidebar">y</div><p>z</div>')) == "x z"
    assert main_text(parse("<script>never closed <p>x")) == ""
    assert host_of("HTTPS://user@Ex.ORG:80/a") == "ex.org" and host_of(None) == "" and host_of("no url") == ""


def test_deep_and_long_pages():
    assert main_text(parse("<div>" * 3000 + "deep" + "</div>" * 3000)) == "deep"
    long = " ".join(f"w{i}" for i in range(200_000))
    assert main_text(parse(f"<article><p>{long}</article>")) == long


def site(n=30):
    rng = random.Random(8)
    for i in range(n):
        body = "".join(f"<p>{invented(rng, 12)}</p>" for _ in range(rng.randint(1, 5)))
        yield (i, f"http://site.example/{i}", f"<body><article><h1>{invented(rng, 4)}</h1>{body}<div class=box>Read more of our stories</div></article>")


def test_what_every_page_repeats_goes(spark):
    rows = list(site()) + [(90, "http://site.example/copy", next(site())[2])] * 25
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)
    tree = {r.path: r for r in style_tree(pages).collect()}
    box, p = tree["/body/article/div.box"], tree["/body/article/p"]
    assert box.pages == len(rows) and abs(box.content) < 1e-9 and p.content > 0.9
    assert [(r.low, r.fixed) for r in low_paths(style_tree(pages)).collect()] == [(["/body/article/div.box"], ["/body/article/h1"])]  # headings stay for their element
    for r in extract(pages).collect():
        source = dict((x[0], x[2]) for x in rows)[r.page_id].split("<div class=box>")[0]
        assert r.text == " ".join(re.sub("<[^>]*>", " ", source).split()) and r.n_chars == len(r.text)


def test_a_page_is_never_emptied(spark):
    pages = spark.createDataFrame([(i, "http://one.example/", "<p>always the same</p>") for i in range(20)], "page_id int, url string, html string")
    assert {r.text for r in extract(pages).collect()} == {"always the same"}


def test_awkward_rows(spark):
    rows = [(None, None, None), (1, None, "<p>a"), (2, "x", None), (3, "http://h/", ""), (3, "http://h/", ""), (4, "http://H/q", "<p>é 🙂</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "'z' AS host", "'y' AS text", "1 AS low", "2 AS path")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract(pages).collect())
    assert got == [(0, "", "", 0), (1, "", "a", 1), (2, "x", "", 0), (3, "http://h/", "", 0), (3, "http://h/", "", 0), (4, "http://H/q", "é 🙂", 3)]
    assert extract(pages.limit(0)).count() == 0


def article(source):
    inside = re.search("<article>(.*?)</article>", source, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub("<(?:/?p|/?h1|/?b|br)>", " ", inside)).split())


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        assert r.text == article(source[r.page_id])


def test_the_tree_alone_clears_the_given_pages(spark):
    """Menus, adverts and footers go for their importance, without a look at elements, names or articles."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    plain = "regexp_replace(regexp_replace(html, '<(nav|footer|article)', '<div class=x$1x'), '</(nav|footer|article)>', '</div>') AS html"
    renamed = pages.selectExpr("page_id", "url", plain)
    assert not renamed.filter("html RLIKE '<(nav|footer|article)'").count()
    for got in extract(pages, names=False).collect(), extract(renamed, names=False).collect():
        assert len(got) == len(source) and all(r.text == article(source[r.page_id]) for r in got)


def brute_tree(rows):
    """The tree's numbers of one host, counted page by page."""
    contents = {}
    for _, _, source in rows:
        page = parse(source)
        key = tuple((b.path, b.text) for b in text_blocks(page))
        contents.setdefault(key, []).append(page)
    copies = {key: len(pages) for key, pages in contents.items()}
    shape, texts, n_pages, with_text = defaultdict(Counter), defaultdict(Counter), Counter(), Counter()
    for key, (page, *_) in contents.items():
        words = Counter()
        for b in page.blocks:
            words[b.path] += len(b.text.split())
        for path, children in page.styles.items():
            shape[path][tuple(children), words[path] // LENGTH_STEP] += 1
            n_pages[path] += copies[key]
        for path, text in {(b.path, b.text) for b in page.blocks}:
            texts[path][text] += 1
        with_text.update({b.path for b in page.blocks})
    out = {}
    for path, seen in shape.items():
        m = sum(seen.values())
        entropy = -sum(n / m * math.log(n / m) for n in seen.values())
        content = None
        if path in texts:
            content = 1 - sum(math.log(n) for n in texts[path].values()) / len(texts[path]) / math.log(m) if m > 1 else 1
        out[path] = [n_pages[path], m, 1 - math.exp(-entropy) if m > 1 else 1, content]
    held = [p.split("/") for p in out if 2 * with_text[p] >= out[""][1]]
    depth = next((i for i, steps in enumerate(zip(*held)) if len(set(steps)) > 1), min(map(len, held)))
    depth -= len(held) == 1
    branch = {p: "/".join(p.split("/")[: depth + 1]) for p in out}
    for p, x in out.items():
        wide = max(out[q][2] for q in out if branch[q] == branch[p])
        x += [branch[p], wide, (1 if x[3] is None else x[3]) * wide if x[1] > 1 else 1]
    return out


def test_entropies_by_brute_force(spark):
    menu = "<ul>{}</ul>"
    rows = []
    for i, url, source in site(24):
        links = menu.format("".join(f"<li>link {i % 5} {k}" for k in range(2 + i % 3)))
        rows.append((i, url, source.replace("<body>", f"<body>{links}<div class=side>side {i % 4}</div>").replace("box>", f"box>{i % 2}")))
    rows += [(50 + i, "http://site.example/copy", rows[3][2]) for i in range(4)] + [(60, "http://site.example/odd", "loose <p>text")]
    want = brute_tree(rows)
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)
    got = {r.path: list(r)[2:] for r in style_tree(pages).collect()}
    assert got.keys() == want.keys()
    for path, numbers in want.items():
        for a, b in zip(got[path], numbers, strict=True):
            assert a == b if a is None or isinstance(a, str) else abs(a - b) < 1e-9, path
    assert {"/body/ul/li", "/body/div.side"} <= {p for p, x in want.items() if x[6] < 0.7}


def test_slots_go_and_stories_of_any_shape_stay(spark):
    """No names and no articles: slots filled with words of their own go, a one-block story and its heading stay."""
    rng = random.Random(5)
    page = "<body><div class=x1><b>{}</b></div><h2>{}</h2><div class=x2>{}</div><div class=x3>{}</div></body>"
    rows, want = [], {}
    for i in range(40):
        title, story = invented(rng, 4), invented(rng, rng.randint(60, 600))
        rows.append((i, f"http://plain.example/{i}", page.format(invented(rng, 3), title, story, invented(rng, 8))))
        want[i] = f"{title} {story}"
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in extract(pages).collect()} == want


def test_memory_follows_depth():
    deep = "<div class=a>" * 20_000 + "<h1>deep</h1>" + "</div>" * 20_000
    tracemalloc.start()
    page = parse(deep)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert main_text(page) == "deep" and peak < 100e6
    assert max(map(len, page.styles)) < 2 * PATH_CHARS and page.blocks[0].path.endswith("/h1")
    assert main_text(parse(f'<p class="{"n" * 100_000}">x</p>')) == "x"


def test_copies_are_one_witness(spark):
    copy = "<body><div>ad {}</div><article><h1>The list</h1><p>All of them:</p><ul><li>one</li><li>two</li></ul></article>"
    rows = list(site()) + [(100 + i, f"http://site.example/copy{i}", copy.format(i)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)
    tree = {r.path: r for r in style_tree(pages).collect()}
    assert (tree["/body/article/ul/li"].pages, tree["/body/article/ul/li"].contents) == (12, 1)
    assert [r.low for r in low_paths(style_tree(pages)).collect()] == [["/body/article/div.box"]]
    texts = [r.text for r in extract(pages).collect() if r.page_id >= 100]
    assert texts == ["The list All of them: one two"] * 12


def test_reused_headings_of_articles_stay(spark):
    page = "<body><article><h2>{}</h2><p>text {}</p><div class=box>Read more</div></article>"
    rows = [(i, f"http://h.example/{i}", page.format(["Method", "Parts"][i % 2], i)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    assert {r.page_id: r.text for r in extract(pages).collect()} == {i: f"{['Method', 'Parts'][i % 2]} text {i}" for i in range(40)}


def test_articles_that_are_not_the_story():
    comments = '<article class="comment"><p>c1</p></article><article id=comment-2><p>c2</p></article>'
    assert main_text(parse(f"<div><p>story</p></div>{comments}")) == "story"
    assert main_text(parse('<div><p>story</p></div><article class="related"><h2>teaser</h2></article>')) == "story"
    assert main_text(parse(f"<p>around</p><article><p>story</p>{comments}<p>end</p></article>")) == "story end"
    assert main_text(parse('<p>around</p><article class="post category-social no-sidebar"><p>story</p></article>')) == "story"
    assert main_text(parse('<main class="search"><p>story</p><article role="complementary">side</article></main>')) == "story"
    assert main_text(parse('<nav>menu</nav><article class="promo"><p>only</p></article>')) == "only"


def test_names_of_states_and_subjects_drop_no_story():
    for open_, close in [('<div class="page no-sidebar"><article>', "</article></div>"), ('<div class="comments-off"><article>', "</article></div>"),
                         ('<div class="post share-enabled">', "</div>"), ('<section class="social-policy">', "</section>"),
                         ('<div class="sidebar"><article>', "</article></div>")]:
        assert main_text(parse(f"<body><nav>menu</nav>{open_}<p>the story</p>{close}<footer>end</footer>")) == "the story"
    for name in ["ad", "site-footer", "main-nav", "cookie-banner", "post-comments", "side-bar", "sidebar-2", "Share_Buttons", "reader-comments box"]:
        assert main_text(parse(f'<p>story</p><div class="{name}">around</div>')) == "story", name
