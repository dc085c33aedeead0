import html
import re

from flowguard.llm.html_extract import extract_group, extract_pages, parse, simple_tree_matching
from tests.llm.util import SF01, read


def of(pages):
    return extract_group(pages)


def test_articles_of_the_given_table(spark):
    """Brute force for this table's one layout: the blocks of the article element."""
    pages = read(spark, "pages", SF01)
    got = {r["page_id"]: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>|<br>", body)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        want = "\n".join(x for x in want if x)
        g = got[r["page_id"]]
        assert g["text"] == want and g["n_chars"] == len(want) and g["url"] == r["url"]


FURNITURE = ("<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>a"
             "<li>b</ul></nav><div class='cookie-notice'>We use cookies</div><div id=wrap>{}</div><div class=sidebar><p>"
             "side</p></div><section id='comments'><p>nice!</p></section><form><p>mail <input></p></form><footer>&copy;"
             "</footer><script>var x='<p>no</p>'</script></body></html>")


def test_furniture_goes_and_text_is_decoded():
    page = FURNITURE.replace("{}", "<article><h1>Ti&amp;tle</h1><p>One <b>two</b>\n three<!-- x --><p>f&uuml;r &lt;b&gt; 4 < 5"
                             "<ul><li>i<li>j</ul><table><tr><td>c<td>d</table><div class='ad'>buy</div></article>")
    assert of([page]) == ["Ti&tle\nOne two three\nfür <b> 4 < 5\ni\nj\nc\nd"]


def test_constant_nodes_are_template():
    """Without an article element the wrapper decides: what all pages share goes."""
    pages = [f"<body><div>Welcome to the site</div><div class=x><h2>head {i}</h2><p>para {i}</p><p>same words</p></div>"
             f"<div class=legal{i}>All rights reserved</div></body>" for i in range(8)]
    assert of(pages) == [f"head {i}\npara {i}\nsame words" for i in range(8)]
    assert of(pages[:3])[0].startswith("Welcome")          # too few to tell
    assert of([pages[0]] * 9) == ["Welcome to the site\nhead 0\npara 0\nsame words\nAll rights reserved"] * 9
    odd = pages[:6] + ["<body><div>Welcome to the site</div><p>plain</p></body>"]
    assert of(odd)[-1] == "plain"


def test_copies_of_an_article_stay():
    pages = [f"<article><h1>Same title</h1><p>Common passage</p><p>text {i}</p></article>" for i in range(9)]
    assert of(pages) == [f"Same title\nCommon passage\ntext {i}" for i in range(9)]


def test_tree_matching_size():
    a = parse("<div><h1>x</h1><ul><li>1</ul><section><p>y</p></section></div>")
    b = parse("<div><h1>z</h1><section><p>w</p></section></div>")
    n, pairs = simple_tree_matching(a, b)
    assert n == len(pairs) == 5         # root, div, h1, section, p
    assert simple_tree_matching(a, a)[0] == 7


def test_broken_pages():
    assert of([""]) == [""] and of(["plain & simple"]) == ["plain & simple"]
    assert of(["<p>a<p>b<br>c</p></div></article>d <!-- open"]) == ["a\nb\nc\nd"]
    assert of(["<p title=\"a>b\">x</p><p title='oops>y</p>"])[0].startswith("x")
    assert of(["<script>never closed <p>x</p>"]) == [""]
    assert of(["<div>" * 300 + "deep" + "</div>" * 300]) == ["deep"]
    assert of(["&#128512;&nbsp;&nbsp;x&#0;"])[0].startswith("😀 x")


def test_edge_rows(spark):
    rows = [(None, None, "<p>a</p>"), (1, "http://H.example/x", None), (2, "http://h.example/y", "<p>b</p>"),
            (2, "http://h.example/y", "<p>b</p>"), (3, "rel/path", "<nav>n</nav>"), (4, "", "x" * 200000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    got = sorted([tuple(r) for r in extract_pages(df, group=2).collect()], key=str)
    want = ["a", "", "b", "b", "", "x" * 200000]
    assert got == sorted([(r[0], r[1], w, len(w)) for r, w in zip(rows, want)], key=str)
    assert extract_pages(df.limit(0)).collect() == []
    hot = spark.createDataFrame([(i, f"http://one.example/{i}", f"<body><div>Menu</div><p>text {i}</p></body>")
                                 for i in range(500)], "page_id long, url string, html string")
    assert {(r["page_id"], r["text"]) for r in extract_pages(hot).collect()} == {(i, f"text {i}") for i in range(500)}


def test_groups_do_not_depend_on_partitions(spark):
    hot = spark.createDataFrame([(i, f"http://one.example/{i}", f"<body><div>Menu</div><p>text {i}</p></body>")
                                 for i in range(500)], "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = {(r["page_id"], r["text"]) for r in extract_pages(hot).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {(i, f"text {i}") for i in range(500)}


def test_many_copies_count_once_and_get_their_text(spark):
    rows = [(i, f"http://one.example/{i}", f"<body><div>Menu</div><p>text {i % 3 if i < 60 else i}</p></body>")
            for i in range(90)] + [(None, None, "<p>same</p>")] * 30
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted([tuple(r) for r in extract_pages(df).collect()], key=str)
    want = [(i, u, f"text {i % 3 if i < 60 else i}") if u else (i, u, "same") for i, u, _ in rows]
    assert got == sorted([(*w, len(w[2])) for w in want], key=str)


def test_constant_blocks_inside_an_article_are_template():
    pages = [f"<article><h1>Title {i}</h1><ul><li>Home<li>About</ul><p>text {i}</p><p>Get our letter</p>"
             f"<table><tr><td>Yes<td>{i}</table><h2>Note</h2><p>Read the rules</p></article>" for i in range(30)]
    assert of(pages) == [f"Title {i}\ntext {i}\nYes\n{i}" for i in range(30)]
    untitled = [f"<main><ul><li>Home<li>About</ul><p>text {i}</p><p>Get our letter</p></main>" for i in range(30)]
    assert of(untitled) == [f"text {i}" for i in range(30)]


def test_near_copies_inside_a_host_stay():
    near = [f"<article><h1>One title</h1><p>Long words</p><h2>Part</h2><p>text</p><p>edit {i}</p></article>" for i in range(40)]
    other = [f"<article><h1>Title {i}</h1><p>word {i}</p><h2>Part {i}</h2><p>a{i}</p><p>b{i}</p></article>" for i in range(8)]
    assert of(near + other)[:40] == [f"One title\nLong words\nPart\ntext\nedit {i}" for i in range(40)]


def test_every_varying_article_stays():
    pages = [f"<body><article><h2>Teaser</h2><p>A constant teaser that is longer than the others</p></article>"
             f"<article><h2>A {i}</h2><p>one {i}</p></article><article><h2>B {i}</h2><p>two {i}</p></article></body>"
             for i in range(9)]
    assert of(pages) == [f"A {i}\none {i}\nB {i}\ntwo {i}" for i in range(9)]


def test_names_do_not_drop_what_holds_the_article():
    for page in ("<body class='has-sidebar fixed-header'><article><p>{}</p></article></body>",
                 "<div id='page-with-sidebar'><article><p>{}</p></article></div>",
                 "<div class='widget'><article class='post comments-open'><p>{}</p></article></div>",
                 "<main class='nav'><p>{}</p></main>",
                 "<form><article><p>{}</p></article></form>",
                 "<div role='main' class='content share-buttons-on'><p>{}</p></div>",
                 "<div class='content share-buttons-on'><p>{}</p></div><div class='sidebar-left'><p>side</p></div>"):
        assert of([page.format("the article itself")]) == ["the article itself"]
        assert of([page.format(f"text {i}") for i in range(9)]) == [f"text {i}" for i in range(9)]
    pages = [f"<div class='post share-on'><p>{i}</p></div><div class='sidebar'><p>a longer comment of page {i}</p></div>"
             "<div class='footer-links'><p>links</p></div>" for i in range(9)]
    assert of(pages) == [f"{i}" for i in range(9)]
    only = [f"<div class='widget'><p>text {i}</p></div><footer>f</footer>" for i in range(9)]
    assert of(only) == [f"text {i}" for i in range(9)]


OTHERS = ["<div id='comments' class='comments-area'><ol class='comment-list'><li><article class='comment-body'><p>C {i}</p></article></ol></div>",
          "<div class='comment-list'><p>nice {i}</p><p>more {i}</p></div>", "<div class='related-posts'><h3>R {i}</h3><p>read {i}</p></div>",
          "<div id='disqus_thread'><p>said {i}</p></div>", "<div class='ad-slot'><p>buy {i}</p></div>",
          "<div class='sidebar-left'><p>side {i}</p></div>", "<div class='cookie-banner-text'><p>cookie {i}</p></div>",
          "<div class='site-footer'><p>foot {i}</p></div>", "<section class='post-comments'><p>last {i}</p></section>"]


def test_what_others_write_goes_though_it_varies():
    """Under ordinary class names, beside the article, without an article element and inside it,
    on many pages and on a single one."""
    for others in OTHERS:
        for page in ("<body><article><h1>T {i}</h1><p>own {i}</p></article>%s</body>",
                     "<body>%s<article><h1>T {i}</h1><p>own {i}</p></article></body>",
                     "<body><div class='wrap'><h1>T {i}</h1><p>own {i}</p></div>%s</body>",
                     "<body><article><h1>T {i}</h1><p>own {i}</p>%s</article></body>",
                     "<body><div class='page-with-sidebar'><article><h1>T {i}</h1><p>own {i}</p></article>%s</div></body>"):
            pages = [(page % others).replace("{i}", str(i)) for i in range(30)]
            assert of(pages) == [f"T {i}\nown {i}" for i in range(30)], pages[0]
            assert of(pages[:1]) == ["T 0\nown 0"], pages[0]
    long = "<body><div class='wrap'><p>short</p></div><div class='comment-list'>" + "<p>a very long comment</p>" * 50 + "</div></body>"
    assert of([long]) == ["short"]
    only = [f"<body><div class='comment-list'><p>all there is {i}</p></div></body>" for i in range(9)]
    assert of(only) == [f"all there is {i}" for i in range(9)]


def test_articles_inside_an_article_are_comments():
    nested = "<article><h1>T</h1><p>own</p><article><p>I disagree</p></article><article><p>So do I</p></article></article>"
    assert of([nested]) == ["T\nown"]
    wrapper = "<article><h1>Day</h1><article><p>one</p></article><article><p>two</p></article></article>"
    assert of([wrapper]) == ["Day\none\ntwo"]
    assert of(["<div class='widget'><article class='post comments-open'><p>x</p></article></div>"]) == ["x"]
    assert of(["<div class='related'><article><p>the only one</p></article></div>"]) == ["the only one"]


def test_pages_of_any_form_take_time_by_their_size():
    import time
    t0 = time.time()
    assert of(["<div>" * 100_000 + "deep" + "</div>" * 100_000]) == ["deep"]
    assert of(["<div>" * 50_000 + "x" + "</section>" * 50_000 + "<p>y"]) == ["x\ny"]
    assert of(["<ul><li>" * 30_000 + "x<p>y</li></ul>" * 30_000])[0].startswith("x\ny")
    assert of(["start <a \"" * 50_000]) and of(['<p>x</p>' + '<a ">"' * 50_000]) and of(["<!--" * 100_000]) == [""]
    assert of(["<script>" + "</script " * 50_000]) == [""] and of(["<p>a</p>" + "<" * 300_000])[0].startswith("a")
    rows = [f"<article><h1>T{p}</h1><table>" + "".join(f"<tr><td>k{i}</td><td><b>v</b> {i + p}</td></tr>" for i in range(3000 + p))
            + "</table></article>" for p in range(6)]
    got = of(rows)
    assert [len(g.split("\n")) for g in got] == [1 + 2 * (3000 + p) for p in range(6)]
    assert time.time() - t0 < 60


def test_text_beyond_the_depth_is_kept_in_order():
    page = "<div>" * 400 + "<h1>a</h1><p>b<p>c" + "</div>" * 400 + "<p>d</p>"
    assert of([page]) == ["a\nb\nc\nd"]


def brute_matching(a, b):
    """Largest top-down mapping that keeps sibling order, by trying every choice."""
    if a.label != b.label:
        return 0

    def lists(x, y):
        if not x or not y:
            return 0
        return max(lists(x[1:], y), lists(x, y[1:]), (brute_matching(x[0], y[0]) or -9) + lists(x[1:], y[1:]))
    return 1 + lists(a.kids(), b.kids())


def test_matching_equals_brute_force_on_random_trees():
    import random
    rnd = random.Random(5)

    def tree(depth):
        tag = rnd.choice(["div", "section", "ul"])
        kids = "".join(tree(depth - 1) for _ in range(rnd.randint(0, 3))) if depth else ""
        return f"<{tag}>{kids}{'<h2>x</h2>' if rnd.random() < 0.5 else ''}</{tag}>"
    for _ in range(200):
        a, b = parse(tree(2)), parse(tree(2))
        n, pairs = simple_tree_matching(a, b)
        assert n == len(pairs) == brute_matching(a, b)
        assert all(x.label == y.label for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == n


def test_long_lists_of_siblings_are_matched_nearby():
    import random
    rnd = random.Random(6)
    kinds = ["<ul><li>a<p>b</ul>", "<section><h2>t</h2><p>c</p></section>", "<div class=k><p>x<h3>d</h3></div>"]
    a, b = (parse("<div>" + "".join(rnd.choice(kinds) for _ in range(400)) + "</div>") for _ in range(2))
    n, pairs = simple_tree_matching(a, b)
    assert n == len(pairs) > 300 and all(x.label == y.label for x, y in pairs)
