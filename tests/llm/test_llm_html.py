from churnlens.llm import html
from churnlens.llm.html import main_text, segments

P = "A sentence of the story that goes on for quite a while. "


def test_article_without_boilerplate():
    page = (
        "<html><head><title>T</title><script>if (a<b) '</p>'</script></head><body><header><h1>Site</h1></header>"
        "<nav><ul><li><a href=x>one</a></li></ul></nav><form><div class='cookie-notice'>We use cookies</div>"
        f"<main><h2>T&eacute;</h2><p>{P}<p class=ad>buy now<p>a  b\n c<div class='share'><div>x</div></div>"
        "<ul><li>one</li><li><a href=x>two</a></li></ul><aside>side</aside><p>end&nbsp;&#x41;<br>B</p></main></form>"
        f"<section id=comments><article class='comment'><p>{P}</p></article></section><footer>f</footer></body>"
    )
    assert main_text(page).split("\n\n") == ["Té", P.strip(), "a b c", "one", "two", "end A B"]


def test_page_without_article_element():
    page = (
        f"<body><div id=menu><a>x</a></div><div><p>{P * 3}</p><p>{P}</p></div>"
        f"<div class=sidebar><p>{P}</p></div><p><a href=1>l1</a></p><p><a>l2</a>"
    )
    assert main_text(page) == f"{(P * 3).strip()}\n\n{P.strip()}"


def test_segments_of_unequal_size():
    """One long paragraph between two adverts does not outweigh the paragraphs around."""
    ad = "<div class=advert><p>Buy now</p></div>"
    page = f"<body><ul><li><a>m</a><li><a>n</a></ul><p>{P}</p>{ad}<p>{P * 40}</p>{ad}<p>{P}</p><div id=acme-footer>{P}</div>"
    assert main_text(page).split("\n\n") == [P.strip(), (P * 40).strip(), P.strip()]


def test_class_names_inside_an_article():
    page = (
        f"<article><p class='notice-period'>{P}</p><p>The market <span class='share'>share</span> fell.</p>"
        "<div class='share-buttons'>x</div><div class='ad-slot-2'>y</div>"
        f"<ul><li><a>a</a><li><a>b</a><li><a>c</a><li><a>d</a></ul><p>End.</p><section class='user-feedback'><p>{P}</p></section></article>"
    )
    assert main_text(page).split("\n\n") == [P.strip(), "The market share fell.", "End."]
    assert main_text("<article><p>End.</p><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul></article>") == "End."
    assert main_text("<article><p>In</p><ul><li><a>a</a><li><a>b</a></ul><p>End.</p></article>") == "In\n\na\n\nb\n\nEnd."


def test_teaser_as_article():
    teaser = "<article><p>Read on</p></article>"
    assert main_text(f"<body>{teaser}<div><p>{P * 9}</p><p>{P}</p></div>") == f"{(P * 9).strip()}\n\n{P.strip()}"
    assert main_text(f"<body><article><p>{P * 3}</p></article><div><p>{P * 9}</p></div>") == (P * 3).strip()


def test_pages_without_article_like_those_with(spark, data_dir):
    """The given pages with the article element renamed: the windows alone find the same text."""
    pages = [r["html"] for r in spark.read.parquet(f"{data_dir}/pages.parquet").collect()]
    plain = [p.replace("<article>", "<div>").replace("</article>", "</div>") for p in pages]
    want, got = [main_text(p) for p in pages], [main_text(p) for p in plain]
    assert sum(a == b for a, b in zip(want, got)) >= 0.98 * len(pages)


def test_surge_and_dive_points():
    assert list(segments([0, 5, 0, 0, 7, 0, 0, 0, 2])) == [(1, 5, 7), (8, 9, 2)]
    assert list(segments([])) == [] and list(segments([0, 0])) == []


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<nav>only a menu</nav>") == ""
    assert main_text("plain &amp; text\n here") == "plain & text here"
    assert main_text("<article>cut off</artic") == "cut off"
    assert main_text('<div "x>abc</div>') == "abc"
    long = "word " * 400_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_frames(spark):
    rows = [(1, "u", "<p>x</p>", "old"), (1, "u", "<p>x</p>", "old"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html.extract(df).select("page_id", "url", "text", "n_chars").collect()), key=str)
    assert got == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert html.extract(df.limit(0)).count() == 0


def test_query_matches_plain_reading(spark, data_dir):
    import html as entities
    import re

    from churnlens.llm import queries

    got = {r["page_id"]: r for r in queries.QUERIES["op1_html_extraction"](spark, data_dir).collect()}
    pages = spark.read.parquet(f"{data_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = page["html"].split("<article>", 1)[1].split("</article>", 1)[0].replace("<br>", " ")
        blocks = [entities.unescape(re.sub(r"<[^>]*>", "", b)).split() for b in re.split(r"</?(?:p|h1|ul|li)>", inner)]
        want = "\n\n".join(" ".join(b) for b in blocks if b)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (want, len(want))
