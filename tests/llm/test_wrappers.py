"""Main text of pages whose blocks are known."""

from feedfold.llm import wrappers

MENU = '<nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>'
COMMENTS = '<section class="comments"><h3>Comments</h3><p>Reader %d says hello to everyone here</p></section>'


def page(n, blocks):
    inside = "".join(f"<p>{b}</p>" for b in blocks)
    return (
        f"<html><head><title>T{n}</title><script>var x = '<p>no</p>';</script></head><body><header>Site</header>{MENU}"
        f'<article><h1>Title {n}</h1>{inside}</article><aside class="sidebar"><p>Most read this week</p></aside>'
        f"{COMMENTS % n}<footer>All rights reserved</footer></body></html>"
    )


def told(n):
    return [f"Block {n} of&nbsp;the text &amp;   more words follow\n here", f"The <b>second</b> block {n}, with<br>a break &#233;."]


def seen(n):
    return f"Title {n}\n\nBlock {n} of the text & more words follow here\n\nThe second block {n}, with a break é."


def test_pages_of_hosts(spark):
    rows = [(n, f"https://host{n % 2}.org/{n}", page(n, told(n)), "x", 1) for n in range(30)]
    rows += [(100, "https://host0.org/n", None, "x", 1), (101, None, "", "x", 1), (102, "odd", page(7, told(7)), "x", 1), (3, *rows[3][1:])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, text int")
    found = wrappers.extract(frame).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[100] == "" and texts[101] == "" and texts[102] == seen(7)
    assert {n: texts[n] for n in range(30)} == {n: seen(n) for n in range(30)}
    assert wrappers.extract(frame.limit(0)).count() == 0


def test_alignment():
    one = wrappers.wrapper_of(wrappers.parse("<ul><li>a</li><li>b</li></ul><p>x</p>"))
    two = wrappers.wrapper_of(wrappers.parse("<ul><li>a</li></ul><div>y</div><p>z</p>"))
    assert wrappers.expression(wrappers.merged(one, two)) == "<#root>(<ul>(<li>(#TEXT)+) <div>(\"y\")? <p>(#TEXT))"


def test_broken_and_deep_markup(spark):
    rows = [(1, "http://a.b/", "<p>one<p>two<div>three</p></span>"), (2, "http://c.d/", "<" * 5000), (3, "http://e.f/", "<div>" * 3000 + "deep"), (4, "http://g.h/", "<div>" * 400 + "a <b>b</b><div>c</div> d")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in wrappers.extract(frame).collect()}
    assert texts[1] == "one\n\ntwo\n\nthree" and texts[3] == "deep" and texts[4] == "a b\n\nc\n\nd"


def texts_of(spark, htmls):
    rows = [(n, f"https://one.org/{n}", html) for n, html in enumerate(htmls)]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_siblings_of_one_key_keep_apart(spark):
    words = [f"Page {n} tells a long story of its own " * 4 for n in range(8)]
    told = [w.strip() for w in words]
    linked = "<article><h1>H{0}</h1><p>{1}</p><ul><li>item {0}</li></ul><p><a href='/x'>Read on {0}</a></p></article>"
    assert texts_of(spark, [linked.format(n, w) for n, w in enumerate(words)]) == [
        f"H{n}\n\n{t}\n\nitem {n}" for n, t in enumerate(told)
    ]
    constant = "<article><p>Welcome to this site</p><h1>H{0}</h1><p>{1}</p></article>"
    assert texts_of(spark, [constant.format(n, w) for n, w in enumerate(words)]) == [f"H{n}\n\n{t}" for n, t in enumerate(told)]
    bare = "<body><div><a href='/a'>One</a> <a href='/b'>Two</a></div><h1>H{0}</h1><div>{1}</div></body>"
    assert texts_of(spark, [bare.format(n, w) for n, w in enumerate(words)]) == told
    # one page lacks the list: its text meets the place of no link
    other = "<article><h1>H9</h1><p><a href='/x'>Read on 9</a></p><ul><li>item</li></ul><p>{0}</p></article>"
    short = "<article><h1>H8</h1><p>{0}</p></article>"
    assert all(t in x for t, x in zip(told, texts_of(spark, [other.format(w) for w in words[:7]] + [short.format(words[7])]), strict=True))


def test_layouts_of_one_host(spark):
    told = [f"Page {n} tells a long story of its own, and no other page does" for n in range(12)]
    article = "<body><nav>Menu</nav><article><h1>H{0}</h1><p>{1}</p></article></body>"
    prose = "<body><nav>Menu</nav><div class='prose'><h1>H{0}</h1><p>{1}</p></div></body>"
    content = "<body><nav>Menu</nav><div class='content'><h1>H{0}</h1><p>{1}</p></div></body>"
    wanted = [f"H{n}\n\n{t}" for n, t in enumerate(told)]
    for few, many in ((article, prose), (prose, content), (prose, article)):
        assert texts_of(spark, [(few if n < 4 else many).format(n, t) for n, t in enumerate(told)]) == wanted
    plain = "<body><div class='layout no-sidebar'><h1>H{0}</h1><p>{1}</p></div><div class='sidebar'><p>Most read</p></div></body>"
    assert texts_of(spark, [plain.format(n, t) for n, t in enumerate(told)]) == wanted
    # a layout of few pages, and copies of one page: the cut of the host leaves nothing of them
    assert texts_of(spark, [(plain if n < 2 else article).format(n, t) for n, t in enumerate(told)]) == wanted
    assert texts_of(spark, [prose.format(7, told[7])] * 6) == [f"H7\n\n{told[7]}"] * 6
    talk = "<body><div>{1}</div><div class='comments'><p>" + "I think {0} so. " * 30 + "</p></div></body>"
    assert texts_of(spark, [talk.format(n, t) for n, t in enumerate(told)])[3].startswith(told[3])
    assert texts_of(spark, ["<body><nav>Menu only</nav></body>"]) == [""]
