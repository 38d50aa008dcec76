"""Pages whose article elements are not, or not all of, the main text."""

from loadlens.llm.html_text import main_text

PROSE = "This is the text of an article that has been written for the test, and it is long enough. "
prose = PROSE.strip()


def test_a_teaser_article_does_not_remove_the_story():
    story = f"<div><p>{PROSE}<p>{PROSE}</div>"
    assert main_text(f"<body>{story}<article>Read on</article>") == f"{prose}\n{prose}\nRead on"
    teaser = f"<article>{PROSE}</article>"  # settled as text, but shorter than what is outside
    assert main_text(f"<body>{story}{teaser}") == "\n".join([prose] * 3)
    assert main_text(f"<body><p>{PROSE}<article><p>{PROSE}<p>{PROSE}</article>") == f"{prose}\n{prose}"


def test_neighbours_decide_inside_articles():
    links = "<p><a href=/>" + "more links here " * 6 + "</a></p>"
    page = f"<article><p>{PROSE}</p><p>Near text</p>{links}<p>Near links</p>{links}</article>"
    assert main_text(page) == f"{prose}\nNear text"


def test_named_articles_are_not_content():
    for name in ("comment", "comment-body", "box related", "promo"):
        page = f"<body><p>{PROSE}</p><article class='{name}'><p>{PROSE * 5}</p></article>"
        assert main_text(page) == prose, name
    for name in ("post has-comments", "category-social", "story"):
        page = f"<body><article class='{name}'><p>{PROSE}</p></article>"
        assert main_text(page) == prose, name


def test_no_article():
    assert main_text(f"<body><div>{PROSE}</div><div>Short</div>") == f"{prose}\nShort"
