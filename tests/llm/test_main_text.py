"""Main text that must not go."""

from scorekeep.llm.html_text import main_text

LONG = "a long sentence of the text " * 12


def test_wrappers_of_the_article_stay():
    for mark in ("class='page has-sidebar'", "class=side-by-side", "id='with-header'", "class='menu-open'", "class=sidebar"):
        assert main_text(f"<body><nav>n</nav><div {mark}><article><h1>T</h1><p>{LONG}<div class=ad>buy</div></article></div></body>") == f"T\n{LONG.strip()}"
        assert main_text(f"<body><div {mark}><p>{LONG}<p>{LONG}</div><div class=ad>buy</div></body>") == "\n".join([LONG.strip()] * 2)
    assert main_text(f"<form id=f><main><p>{LONG}</main></form>") == LONG.strip()
    assert main_text(f"<article>x</article><div class='site-header'>{LONG}</div><div class=cookie-notice>c</div>") == "x"


def test_text_outside_article_cards_stays():
    page = f"<body><div id=text><h1>T</h1><p>{LONG}<p>{LONG}</div><article>card one</article><article>card two</article></body>"
    assert main_text(page) == "\n".join(["T", LONG.strip(), LONG.strip(), "card one", "card two"])


def test_paragraphs_in_divs_of_their_own_stay():
    page = f"<div id=c><div>Heading</div><div><p>{LONG * 3}</p></div><div>Short.</div><div><div>{LONG}</div></div></div><div><p>x<p>y</div>"
    assert main_text(page) == "\n".join(["Heading", (LONG * 3).strip(), "Short.", LONG.strip()])


def test_stray_quotes_end_with_their_tag():
    page = """<body><article><p title=it's>One two three four.</p><div data-x="a"b">Five six seven eight.</div>
 <p class = 'x>y' id="a>b" title="unclosed>Nine ten eleven twelve.</p><p data-a==''>Last words of it.</p></article></body>"""
    assert main_text(page) == "One two three four.\nFive six seven eight.\nNine ten eleven twelve.\nLast words of it."


def test_captions_boxes_and_the_article_header_stay():
    page = f"""<body><header><h1>Site</h1></header><article><header><h1>Title</h1><nav>menu</nav></header><p>{LONG}</p>
 <figure><img src=x><svg><text>drawn</text></svg><figcaption>A caption.</figcaption></figure><fieldset><legend>Box</legend>In the box.</fieldset>
 <form><fieldset>Your name</fieldset></form><header class=share>Share it</header></article><footer>f</footer></body>"""
    assert main_text(page) == f"Title\n{LONG.strip()}\nA caption.\nBox\nIn the box."
    # a header that opens outside the article is the page's, also where it holds one of several
    assert main_text(f"<header>Site</header><main><p>{LONG}</p></main>") == LONG.strip()


def test_nothing_and_repeated_rows(spark):
    from scorekeep.llm.html_text import extract_text
    rows = [(1, "u", f"<p>{LONG}</p>"), (1, "u", f"<p>{LONG}</p>"), (None, None, None), (3, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract_text(pages).collect())
    n = len(LONG.strip())
    assert got == [(0, "", "", 0), (1, "u", LONG.strip(), n), (1, "u", LONG.strip(), n), (3, "v", "", 0)]
    assert extract_text(pages.where("false")).count() == 0
