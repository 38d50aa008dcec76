"""Main text of pages, element by element and rule by rule."""

from loadlens.llm.html_text import Block, classify, extract_text, main_text

PROSE = "This is the text of an article that has been written for the test, and it is long enough. "


def test_everything_but_the_article_goes():
    page = f"""<!doctype html><html lang=en><head><title>T</title><style>p {{}}</style></head><body>
    <header><h1>Site</h1></header><nav><p>{PROSE}</p></nav><div class="cookie-notice">{PROSE}</div>
    <aside>{PROSE}</aside><form><p>{PROSE}</p></form><script>var p = "</p><p>{PROSE}";</script>
    <main><h2>A &lt;head&gt; &amp; line</h2><p>{PROSE}<br>On\n two&nbsp; lines<p>Short.
    <div id="sidebar"><p>{PROSE}</p></div><ul><li>one<li>two</ul><!-- <p>{PROSE}</p> -->
    <section class="comments"><p>{PROSE}</p></section></main>
    <footer>&copy; 2020 {PROSE}</footer></body></html>"""
    want = ["A <head> & line", PROSE + "On two lines", "Short.", "one", "two"]
    assert main_text(page) == "\n".join(want)


def test_open_tags_do_not_swallow_the_page():
    page = f"<body><p class=ad>buy<p>{PROSE}<p><b>Bold {PROSE}<br><p>{PROSE}</div></span></p>{PROSE}"
    prose = PROSE.strip()
    assert main_text(page) == "\n".join([prose, f"Bold {prose}", prose, prose])


def test_pages_without_an_article():
    links = "<ul>" + "<li><a href=/>some link here</a>" * 5 + "</ul>"
    page = f"<body><div>{links}</div><p>See.</p><p>{PROSE}</p><p>So.</p><p>{PROSE}</p>{links}</body>"
    prose = PROSE.strip()
    assert main_text(page) == "\n".join([prose, "So.", prose])  # "See." is as near to the links
    assert main_text("<p>Only this.") == "Only this."
    assert main_text("plain &amp; text") == "plain & text"


def test_short_blocks_inherit():
    def block(text, linked=0):
        return Block(text, linked, 0, False)

    good, bad, short = block(PROSE), block("x" * 90, 90), block("short")
    assert classify([bad, short, bad, good, short, short, short, bad], "en") == [
        False, False, False, True, True, True, False, False,
    ]
    assert classify([short, good, short, bad], "en") == [True, True, True, False]
    assert classify([short, short], "xx") == [True, True]
    assert classify([], "en") == []


def test_other_scripts_and_odd_pages():
    text = "これは記事の本文です。" * 30
    assert main_text(f"<html lang=ja><body><p>{text}</p></body>") == text
    for page in ("", "<", "<p", "</p>", "<!--", "<script>x", "<article>", "&#0; &bogus; &#xD800;"):
        assert isinstance(main_text(page), str)
    deep = "<div>" * 3000 + PROSE + "</div>" * 3000
    assert main_text(deep) == PROSE.strip()


def test_column(spark):
    rows = [(1, None, 1), (2, "", 2), (2, "", 2), (None, f"<p>{PROSE}" * 3000, 3), (4, "<p> </p>", 4)]
    df = spark.createDataFrame(rows, "page_id long, html string, text long")
    found = df.select("page_id", extract_text().alias("t")).collect()
    assert sorted((str(r.page_id), len(r.t)) for r in found) == [
        ("1", 0), ("2", 0), ("2", 0), ("4", 0), ("None", 3000 * len(PROSE) - 1 * 1),
    ]
    assert df.limit(0).select(extract_text()).collect() == []
