from hypothesis import given, settings
from hypothesis import strategies as st

from tiermart.llm.html import extract_text, main_text

LONG = "The house of the family is on the hill and it was for a long time the only one in that place. " * 4
STORY = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><ul><li>one</li><li>two <b>th</b>ree</li></ul>"
WANT = f"Title & more {LONG.strip()} Short. one two three"


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="home">
    <header><p>{LONG}</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><!-- <p>{LONG}</p> --><script>var t="</p><p>x";</script>
    <article>{STORY}<div class="ad">{LONG}</div><form><p>{LONG}</p></form>
    <section id="comments"><p>{LONG}</p></section></article>
    <aside>{LONG}</aside><div role="complementary">{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
    assert main_text(page) == WANT


def test_pages_without_article_use_densities():
    links = "".join(f'<li><a href="/{i}">The page of the day {i}</a></li>' for i in range(9))
    page = f"<body><ul>{links}</ul><h2>News</h2><p>{LONG}</p><p>So it is.</p><p>{LONG}</p><div>Copyright 2020</div></body>"
    assert main_text(page) == f"{LONG.strip()} So it is. {LONG.strip()}"


def test_white_space_and_references():
    assert main_text("<article><p>a&nbsp;\n\t b&lt;p&gt;&#x41;&bogus;<br>c<p>d</article>") == "a b<p>A&bogus; c d"
    assert main_text("<article>a <i>b</i><b>c</b>d<wbr>e < 5 & 6</article>") == "a bcde < 5 & 6"


def test_broken_markup():
    assert main_text("") == ""
    assert main_text("<article><p>x<script>never closed <p>y") == "x"
    assert main_text("<article><p>x<!-- open <p>y") == "x"
    assert main_text('<article><p title="open>x</p><p>y</p></article>') in ("x y", "y")
    assert main_text("<nav><div><p>menu</nav><article><p>text</article>") == "text"
    assert main_text("<article></div></p>text</b></article>") == "text"
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"
    assert main_text("<a " * 20_000) == ""
    assert main_text('<p x="' * 5_000 + "<article>") == ""


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap\"'=! -&;#divscript\n", max_size=80))
def test_any_text_is_handled(text):
    result = main_text(f"<article>{text}")
    assert result == " ".join(result.split())


def test_rows(spark):
    rows = [(1, "u", f"<article>{STORY}</article>", "x"), (2, None, None, "y"), (None, "v", "", "z"), (1, "u", f"<article>{STORY}</article>", "x")]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    want = [(1, "u", WANT, len(WANT)), (2, None, "", 0), (None, "v", "", 0), (1, "u", WANT, len(WANT))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


NEWS = [
    "Shares of the carmaker fell 4% on Tuesday after regulators in Brussels opened an inquiry into battery suppliers, according to two officials.",
    "Heavy rain flooded several villages near Porto overnight, forcing hundreds of residents to leave their homes, emergency services said Monday morning.",
    "Researchers at Oslo University measured glacier thickness using satellite radar, finding annual losses nearly double earlier published estimates.",
]
FINNISH = "Hallitus esitteli tiistaina uuden ohjelman, jonka tavoitteena on parantaa rautatieliikenteen toimivuutta koko maassa ensi vuosikymmenen aikana. " * 2


def test_plain_paragraphs_and_other_languages():
    menu = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(9))
    body = "".join(f"<p>{p}</p>" for p in NEWS)
    assert main_text(f"<body><ul>{menu}</ul>{body}<ul>{menu}</ul></body>") == " ".join(NEWS)
    assert main_text(f"<body><ul>{menu}</ul><p>{LONG}</p><p>{NEWS[0]}</p></body>") == f"{LONG.strip()} {NEWS[0]}"
    assert main_text(f"<body><ul>{menu}</ul><h1>Uutiset</h1><p>{FINNISH}</p><p>{FINNISH}</p><ul>{menu}</ul></body>") == f"Uutiset {FINNISH.strip()} {FINNISH.strip()}"


def test_longest_run_of_short_texts():
    link = '<p><a href="/">All of the news</a></p>'
    assert main_text(f"<body><p>Ad hoc</p>{link}<p>First line</p><p>Second line</p>{link}<p>Last</p></body>") == "First line Second line"


def test_content_lifts_outer_bans():
    for wrapper in ('<form id="aspnetForm">', '<div class="header-layout">', '<div id="page-overlay">'):
        for inner in ("article", "main"):
            assert main_text(f"<body>{wrapper}<p>{LONG}</p><{inner}><p>Text.</p></{inner}></body>") == "Text."
    assert main_text('<body><div class="sidebar"><main><p>Text.</p></main></div></body>') == "Text."
    for wrapper in ('<div id="comments">', '<div class="related-posts">', "<aside>", "<div hidden>"):
        assert main_text(f"<body><article>Text.</article>{wrapper}<article><p>{LONG}</p></article></body>") == "Text."


def test_marks_in_classes():
    for mark in ("post social-science", "post social", "entry-content ad-free", "hidden-gems", "related-work", "story legal"):
        assert main_text(f'<body><div class="{mark}"><p>{LONG}</p></div></body>') == LONG.strip(), mark
    for mark in ("related-posts", "ad-slot", "ad_300x250", "socialLinks", "site-footer", "cookie-x", "comments-area", "post sponsored"):
        for top, text in ((f"<article>{LONG}", "</article>"), (f"<p>{LONG}</p>", "")):
            assert main_text(f'<body>{top}<div class="{mark}"><p>{LONG}</p></div>{text}</body>') == LONG.strip(), mark
    section = f'<section class="related-work"><p>{LONG}</p></section>'
    assert main_text(f"<article><p>Text.</p>{section}</article>") == f"Text. {LONG.strip()}"


def test_formulas_are_text():
    formula = "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math>"
    assert main_text(f"<article><p>So {formula} holds.</p></article>") == "So x=2 holds."


def test_edges_of_a_page():
    body = f"<h1>The title</h1><p>A short start.</p><p>{LONG}</p><p>{LONG}</p><p>The end.</p>"
    want = f"The title A short start. {LONG.strip()} {LONG.strip()} The end."
    menu = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(9))
    assert main_text(f"<body>{body}<div>Home</div><p>Copyright 2020 by us</p></body>") == want
    assert main_text(f"<body><nav>{menu}</nav>{body}<footer>{LONG}</footer><p>Powered by us</p></body>") == want
    assert main_text(f"<body><ul>{menu}</ul><p>So much for that.</p><p>{LONG}</p></body>") == LONG.strip()


def test_paragraphs_with_links_between_good_ones():
    linked = 'See <a href="/x">the long story of the house on the hill and of all its people</a> and the other one.'
    plain = "See the long story of the house on the hill and of all its people and the other one."
    want = f"{LONG.strip()} {plain} {LONG.strip()}"
    assert main_text(f"<body><p>{LONG}</p><p>{linked}</p><p>{LONG}</p></body>") == want
    # not at the end, and not if it is links only
    assert main_text(f"<body><p>{LONG}</p><p>{linked}</p></body>") == LONG.strip()
    only = f'<p><a href="/x">{plain}</a></p>'
    assert main_text(f"<body><p>{LONG}</p>{only}<p>{LONG}</p></body>") == f"{LONG.strip()} {LONG.strip()}"
