from wordloom.llm import extract as X

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">'
    '<header class="top"><a href="/">Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav><div id="wrap">'
    '<div class="notice">We use cookies</div><div class="post post-{n}"><h1>Title {n}</h1><p><b>First &amp; best &copy;<br>'
    '<p>Second\n  paragraph <a href=x>with link</a> {n}.<ul><li>one<li>two</ul><div class="ad">Buy</div>'
    '<table><tr><td>c1<td>c2</table></div><div class="comments"><p>I, the reader, disagree at great length with all that, '
    'and I say so here, again and again, because I can, and because nobody stops me from saying it.</p></div></div>'
    '<aside>More</aside><form><p>Name</p></form><footer>&copy; me</footer></body></html>')


def test_article_without_what_surrounds_it():
    want = "Title 7\n\nFirst & best ©\n\nSecond paragraph with link 7.\n\none\n\ntwo\n\nc1\n\nc2"
    text, path = X.main_text(PAGE.format(n=7), [])
    assert text == want and path == ">html>body.has-sidebar>div>div.post"


def test_broken_pages():
    for page, want in [
        ("", ""), (None, ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\n\nb"), ('<div class="', ""), ("<b>x</i> y", "x y"),
        ("a < b && c > d", "a < b && c > d"), ("<article><p>x &am", "x &am"), ("<p>x<script>y", "x"), ("<!-- <p>x</p>", ""),
        ("<p>&nbsp; &#65;&lt;i&gt;</p>", "A<i>"), ("<div hidden>x</div><p>y", "y"), ("<p>un<b>broken</b> word", "unbroken word"),
        ("<body>x</div></p></body>", "x"), ("<p>a</p>" * 3, "a\n\na\n\na"), ("<article><header><h1>H</h1></header>t</article>", "H\n\nt"),
    ]:
        assert X.main_text(page, [])[0] == want, page


def test_votes_and_consensus(spark):
    rows = [(i, "https://Host.example/p/%d" % i, PAGE.format(n=i)) for i in range(6)]
    # here the reader's words outweigh the article: the other pages decide
    short = PAGE.format(n=99).replace("comments", "talk").replace("First &amp; best &copy;", "x").replace("Second\n  paragraph", "y")
    rows += [(99, "https://host.example/p/99", short), (100, "http://other.example", "<main><p>z</p></main>"),
             (None, None, None), (101, None, ""), (102, "no url", "<p>alone</p>"), rows_copy := rows[0], rows_copy]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "page_id bigint, url string, html string, host string, paths string").repartition(3)
    got = X.extract(pages).collect()
    assert len(got) == len(rows)
    text = {r.id: r.text for r in got}
    assert text[99].startswith("Title 99\n\nx") and "disagree" not in text[99]
    assert X.main_text(short, [])[0] != text[99]
    assert text[100] == "z" and text[101] == text[None] == "" and text[102] == "alone"
    assert sum(r.id == 0 for r in got) == 3 and text[0] == X.main_text(PAGE.format(n=0), [])[0]
    winners = {r.host: r.paths for r in X.winning_paths(pages).collect()}
    assert winners["host.example"][0] == ">html>body.has-sidebar>div>div.post"


def test_empty_table(spark):
    assert X.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_long_page_takes_linear_time():
    page = "<article>" + "<p>word <i>word</i> &amp; word</p>" * 20_000
    assert len(X.main_text(page, [])[0].split("\n\n")) == 20_000
    assert X.main_text("<div>" * 5000 + "x", [])[0] == "x"


def test_articles_in_several_containers(spark):
    """Unequal parts of one generalised path, an intro beside a body, and parts two levels below an article."""
    one, two = "one " * 250, "two " * 125
    want = f"{one.strip()}\n\n{two.strip()}"
    pages = [
        f"<body><div class=entry><div class=part-1>{one}</div><div class=part-2>{two}</div></div></body>",
        f"<body><div class=entry><div class=intro><p>{one}</div><div class=body><p>{two}</div><div class=ad>Buy</div></div></body>",
        f"<article><div class=x><div class=part-1>{one}</div><div class=y><div class=part-2>{two}</div></div></div></article>",
        f"<div class=a><div class=b><div class=part-1>{one}</div></div><div class=c>{two}</div></div>",
    ]
    for page in pages:
        assert X.main_text(page, [])[0] == want
    path = ">body>div.entry>div.part"
    assert X.main_text(pages[0], [path]) == (want, path)
    rows = [(i, f"http://h{k}.example/{i}", page) for k, page in enumerate(pages) for i in range(3)]
    got = X.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == len(rows) and {r.text for r in got} == {want}


BODY = "".join(f"<p>Paragraph {i} of the article tells at some length what happened on that day.</p>" for i in range(6))
SAID = "\n\n".join(f"Paragraph {i} of the article tells at some length what happened on that day." for i in range(6))


def test_wrappers_that_hold_the_article():
    """Marks of the layout, a form around the page, and an end tag that is missing do not hide the article."""
    talk = "<div class=comments>" + "<p>I disagree with all of it, at great length and with many words.</p>" * 20 + "</div>"
    for page in (
        f"<div class='layout-sidebar-right'><article>{BODY}</article></div>",
        f"<div class='layout-sidebar-right'><div class=text>{BODY}</div></div>",
        f"<body><div class='page legal'><h1>T</h1>{BODY}</div></body>",
        f"<body><div class='share-enabled'><div>{BODY}</div></div></body>",
        f"<body><form id='aspnetForm'><div class=nav><a href=x>Home</a></div><div class=c><h1>T</h1>{BODY}</div></form></body>",
        f"<body><nav><ul><li><a href=x>Home</a></ul><main><h1>T</h1>{BODY}</main></body>",
        f"<body><nav><a href=x>Home</a><article>{BODY}</article></body>",
        f"<body><nav><a href=x>Home</a><div><h1>T</h1>{BODY}</div></body>",
        f"<div class='layout-sidebar-right'><div class=text>{BODY}</div>{talk}</div>",
        f"<div id=sidebar><p>Beside it stands a short text.</p></div><div class=legal><h1>T</h1>{BODY}</div>",
    ):
        text, _ = X.main_text(page, [])
        assert text.removeprefix("T\n\n") == SAID, page


def test_marks_that_hold():
    """Sidebars, notices and talk stay outside, also long ones; so does what is hidden."""
    long = "<p>This stands beside the article and is longer than it, with many words that say nothing.</p>" * 8
    for tag in ("div class=sidebar", "aside", "div class=comments", "div class='comment-list'", "div class=notice", "form class=search",
                "div hidden", "div class='cookie-bar'", "nav", "footer", "div role=complementary", "section id=comments"):
        page = f"<body><div class=post>{BODY}</div><{tag}>{long}</{tag.split()[0]}></body>"
        assert X.main_text(page, [])[0] == SAID, tag
    assert X.main_text(f"<body><div class=comments>{long}</div></body>", [])[0] == ""
    assert X.main_text(f"<article>{BODY}</article><aside><article><p>Another story.</p></article></aside>", [])[0] == SAID


def test_a_second_block_beside_the_winning_path(spark):
    """Other pages of the host vote for one path; this page has more of its article beside it."""
    second = "The article goes on in a second block, which other pages of this host do not have. " * 6
    rows = [(i, f"http://h.example/{i}", f"<body><div class=a><div class=b>{BODY}</div></div></body>") for i in range(5)]
    rows.append((9, "http://h.example/9", f"<body><div class=a><div class=b>{BODY}</div><div class=c><p>{second}</p></div></div></body>"))
    got = {r.id: r.text for r in X.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == SAID and got[9] == f"{SAID}\n\n{second.strip()}"
