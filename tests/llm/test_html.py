"""Main text of hand-made pages."""

import pytest

from keyfold.llm import htmltext

PROSE = "This is the story of the man and the sea that was in the town for all of his life, and it is what he had to say about it. "
CASES = {
    "plain text": ["plain text"],
    "<p>a<p>b<div class='ad'>x</div>": ["a", "b"],
    "<title>t</title><nav><ul><li>n</ul></nav><article><h1>A &amp; B</h1><p>One <a href='x'>two</a> th<b>ree</b>.<br>Next&nbsp; line</article><footer>f</footer>": [
        "A & B",
        "One two three. Next line",
    ],
    "<article><p>1 < 2 &lt;b&gt; &#233;</p><form><p>mail</form><aside>s</aside><ul><li>i<li>j</ul><section class='comments'><p>nice</section></article>": [
        "1 < 2 <b> é",
        "i",
        "j",
    ],
    "<body class='has-sidebar'><header><h1>Site</h1></header><div class='cookie-notice'>c</div><main><p>x</main><div id='sidebar'>s</div>": ["x"],
    "<article><header><h1>Head</h1><p>by</p></header><p>x</p></article>": ["Head", "x"],
    "<script>var t='</p><article>';</script><article><style>p{}</style><p>x<!-- <p>y --></p></article>": ["x"],
    "<div hidden>h</div><article><div style='display: none'>d</div><p role='note'>x</p><div role='search'>s</div></article>": ["x"],
    "<nav>n<article>x</article>": ["x"],
    "<ARTICLE><P CLASS='Lead'>X</P></ARTICLE>": ["X"],
    f"<ul><li><a href=1>Home page of the site</a></ul><h2>Title</h2><div>{PROSE * 2}</div><div>short</div><div>{PROSE}</div><ul><li><a>Home of it all</a></ul>": [
        "Title",
        (PROSE * 2).strip(),
        "short",
        PROSE.strip(),
    ],
    "": [],
    "<!--": [],
    "<p></p> \n <br>": [],
    "<a \"" * 2000: None,
    "<div>" * 3000 + "x": ["x"],
}


@pytest.mark.parametrize("page", list(CASES))
def test_blocks(page):
    found = htmltext.main_blocks(page)
    assert CASES[page] is None or found == CASES[page]


def test_table(spark):
    rows = [(i, page, "own") for i, page in enumerate([*CASES, None, *CASES])]
    pages = spark.createDataFrame(rows, "page_id BIGINT, html STRING, text STRING")
    found = htmltext.extract_text(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        wanted = CASES.get(r.html, []) if r.html is not None else []
        if wanted is not None:
            assert (r.text, r.n_chars) == ("\n\n".join(wanted), len("\n\n".join(wanted)))
    assert htmltext.extract_text(pages.limit(0)).count() == 0


def test_given_pages(spark, sf_dir):
    """In the given pages the article is marked."""
    for r in htmltext.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        for part in ("<p>", "</p>", "<h1>", "</h1>"):
            article = article.replace(part, "\0")
        for part, by in (("<b>", ""), ("<br>", " "), ("&amp;", "&")):
            article = article.replace(part, by)
        assert r.text == "\n\n".join(" ".join(b.split()) for b in article.split("\0") if b.split())


LINKS = "".join(f"<li><a href={i}>Another story of the site number {i}</a>" for i in range(4))


def test_article_mark_is_a_prior():
    page = f"<article><h1>Head</h1><p>{PROSE}</p><ul>{LINKS}</ul><p>{PROSE * 2}</p><p>end</p></article><p>box</p><div>{PROSE * 2}</div>"
    assert htmltext.main_blocks(page) == ["Head", PROSE.strip(), (PROSE * 2).strip(), "end", (PROSE * 2).strip()]


def test_teasers_beside_main():
    teaser = "<article><h3><a href=x>Another story</a></h3><p>Read it here.</p></article>"
    page = f"{teaser * 3}<main><h1>Head</h1><p>{PROSE * 2}</p><p>short</p></main>{teaser * 3}"
    assert htmltext.main_blocks(page) == ["Head", (PROSE * 2).strip(), "short"]


KEPT = [
    "<div class='layout with-sidebar'><article><p>x</p></article></div>",
    "<div id='no-ads'><article><p>x</p></article></div>",
    "<article class='post hentry category-social'><p>x</p></article>",
    "<div class='discussion'><article><p>x</p></article></div>",
    "<article><svg width='1' /><p>x</p></article>",
    "<article><math/><p>x</p></article>",
    "<article><svg><p>x</p></article>",
    "<article><svg><title>t</title></svg><p>x</p></article>",
    *[f"<article><{n}><p>x</p></{n}></article>" for n in ("video-player", "select-box", "map-view", "object-card")],
    "<article><p>x</p><div class='ad-box'>a</div><div class='comments-area'>b</div></article>",
]


@pytest.mark.parametrize("page", KEPT)
def test_articles_are_not_lost_by_a_name(page):
    assert htmltext.main_blocks(page) == ["x"]


def test_long_prose_is_not_lost_by_a_class():
    assert htmltext.main_blocks(f"<div class='discussion'><p>{PROSE * 2}</p></div>") == [(PROSE * 2).strip()]
    assert htmltext.main_blocks(f"<article><p>{PROSE}</p></article><div class='comments'><p>{PROSE * 2}</p></div>") == [PROSE.strip()]


OTHER = {
    "it": "Nella vecchia casa vicino al mare viveva un pescatore che ogni mattina usciva con la barca, anche quando pioveva forte e nessuno lo aspettava. ",
    "pl": "Stary rybak mieszkał nad morzem i każdego ranka wypływał łodzią, nawet gdy padało i nikt na niego nie czekał przy brzegu ani w porcie. ",
    "ru": "Старый рыбак жил у моря и каждое утро выходил на лодке, даже когда шёл дождь и никто не ждал его на берегу или в порту до самого вечера. ",
    "zh": "老渔夫住在海边的一座旧房子里，每天早上都划船出海，即使下着大雨，岸上也没有人等他。" * 4,
}


@pytest.mark.parametrize("lang", list(OTHER))
def test_other_languages_without_a_mark(lang):
    text = (OTHER[lang] * 2).strip()
    page = f"<ul>{LINKS}</ul><h1>T</h1><div>{text}</div><div>k</div><div>{text}</div><ul>{LINKS}</ul>"
    assert htmltext.main_blocks(page) == ["T", text, "k", text]


def test_code_between_prose():
    code = "x = compute(alpha, beta); y = x + gamma; print(x, y); z = x * y; print(z); assert z > 0; print(alpha)"
    page = f"<div>{PROSE * 2}</div><pre>{code}</pre><div>{PROSE * 2}</div><ul>{LINKS}</ul><div>{code}</div>"
    assert htmltext.main_blocks(page) == [(PROSE * 2).strip(), code, (PROSE * 2).strip()]


PROSE = "The committee published what it had found in the course of the year, and it was more than anyone had thought it would be."
MORE = "It is for the council to say what is to be done with it, and when, and at whose cost, as the law has it for all of them."


@pytest.mark.parametrize("anchor", ['<a name="top">', '<a id="x"></a>', '<p><a href="/x">Home</p>', '<a href="/x">Home<p></p>'])
def test_anchors_and_links_that_are_never_closed(anchor):
    page = f"<html><body>{anchor}<p>{PROSE}</p><p>{MORE}</p></body></html>"
    assert htmltext.main_blocks(page)[-2:] == [PROSE, MORE]


def test_a_link_around_blocks_is_one():
    teaser = f'<a href="/t"><h3>Another story</h3><p>{MORE}</p></a>' * 2
    page = f"<article><p>{PROSE}</p><p>{MORE} 1</p>{teaser}</article>"
    assert htmltext.main_blocks(page) == [PROSE, MORE + " 1"]


def test_a_form_around_the_page():
    page = f'<body><form action="/"><div><nav>Menu</nav><p>{PROSE}</p><p>{MORE}</p><div class="ads">Buy the {MORE}</div></div></form></body>'
    assert htmltext.main_blocks(page) == [PROSE, MORE]
    page = f"<article><p>{PROSE}</p><form><p>Your name and all that we want to know of you, and of the others at your address.</p></form></article>"
    assert htmltext.main_blocks(page) == [PROSE]


@pytest.mark.parametrize("tag", ['<p class="a"">', "<p data-t=John's>", "<p title='a > b'>", '<p a = "x>y" b>', "<p \"x\">"])
def test_quotes_in_tags(tag):
    assert htmltext.main_blocks(f"<article>{tag}{PROSE}</p></article>") == [PROSE]


def test_tags_with_many_quotes_end():
    page = "<article>" + "<p a=\"x\" " * 3000 + f"<p>{PROSE}</p></article>"
    assert PROSE in htmltext.main_blocks(page)[-1]


def test_one_linked_block_within_the_article_stays():
    linked = f'<p><a href="/r">{PROSE}</a>.</p>'
    page = f"<article><p>{MORE}</p>{linked}<p>{MORE}</p></article>"
    assert htmltext.main_blocks(page) == [MORE, PROSE + ".", MORE]
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(4))
    page = f"<article><p>{MORE}</p><ul>{links}</ul><p>{MORE}</p></article>"
    assert htmltext.main_blocks(page) == [MORE, MORE]


def test_headings_that_point_at_themselves_and_standfirsts():
    page = (
        f'<article><header><h1>Title</h1><p>By a person</p><p>{PROSE}</p></header>'
        f'<h2><a href="#s">Section title</a></h2><p>{MORE}</p></article>'
    )
    assert htmltext.main_blocks(page) == ["Title", PROSE, "Section title", MORE]


def test_inline_parts_that_are_out_leave_their_block_whole():
    page = f"<article><p>Before <button>Click</button> after. {PROSE}</p><p>{MORE} <span hidden>SECRET</span> end.</p></article>"
    assert htmltext.main_blocks(page) == [f"Before after. {PROSE}", f"{MORE} end."]
    page = f"<article><p>{PROSE} <span hidden>SECRET</p><p>{MORE}</p><p>x <button><div>Click</div></button> y</p></article>"
    assert htmltext.main_blocks(page) == [PROSE, MORE, "x", "y"]


def test_comments_by_readers():
    page = f'<article><p>{PROSE}</p><div class="user-comments-thread"><p>{MORE}</p></div></article>'
    assert htmltext.main_blocks(page) == [PROSE]
