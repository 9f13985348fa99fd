"""Main text of pages: names that mislead, other languages, hostile markup; held against a plain version."""

import time

import pytest

from turnweave.llm.html_text import main_text

LONG = "This is the first paragraph of the article, and it has what a reader would want to know about the matter, with all that is in it. "


@pytest.mark.parametrize(
    "piece",
    [
        '<h2 id="discussion">Discussion of results</h2>', '<h1 class="header-title">The title of it all</h1>', '<h2 id="privacy">Privacy in the city</h2>',
        f'<section id="legal-history"><p>{LONG}</p></section>', f'<div id="side-effects"><p>{LONG}</p></div>', f'<section id="privacy"><p>{LONG}</p></section>',
        f'<section id="related-work"><p>{LONG}</p></section>', f'<div class="copyrights-reform"><p>{LONG}</p></div>',
    ],
)
def test_subjects_stay(piece):
    text = main_text(f"<html><body><article><p>{LONG}</p>{piece}<p>{LONG}</p></article></body></html>")
    assert len(text.split("\n")) == 3


@pytest.mark.parametrize(
    "piece",
    [
        '<div class="share-buttons">Share this page now</div>', '<div class="notice notice--warning">We use things here.</div>', '<div id="comments"><p>I was here first!</p></div>', '<div class="side">Aside</div>',
        '<div class="alert-info">Look out for it</div>', '<div class="related-posts"><h3>More</h3>And more of it</div>', '<h3 class="share-title">Share it</h3>', '<section id="comments"><p>Well said</p></section>',
        '<span class="share"><span>x</span> Share this page now</span>', '<div><span class="share"><span>x</span> Share now</div>', "<nav>Home</nav>", '<div class="header-logo">Firm</div>',
    ],
)
def test_surroundings_go(piece):
    text = main_text(f"<html><body><article><p>{LONG}</p>{piece}<p>{LONG}</p></article><p><span></span></p></body></html>")
    assert text == "\n".join([LONG.strip()] * 2)


def test_inline_without_end_stays():
    assert main_text(f'<article><p>{LONG}<span class="ad">{LONG}</p></article>') == f"{LONG}{LONG}".strip()


@pytest.mark.parametrize(
    "sentence",
    ["Первый абзац статьи рассказывает читателю всё, что известно об этом событии, и называет имена. ", "这是文章的第一段,告诉读者关于这件事情的一切,并且说明了事情发生的原因和经过。", "Pierwszy akapit tekstu opowiada czytelnikom historię miasta oraz jego mieszkańców. "],
)
def test_languages_without_stop_words(sentence):
    body = sentence * 5
    menu = "".join(f'<li><a href="/{i}">{sentence[:12]}</a></li>' for i in range(8))
    html = f"<html><body><div><ul>{menu}</ul></div><div><p>{body}</p><p>{body}</p></div><div>\xa9 2020 {sentence}</div></body></html>"
    assert main_text(html) == "\n".join([body.strip()] * 2)


def test_long_attribute():
    value = "x > y " * 2000
    assert main_text(f"<article><p data-x=\"{value}\">{LONG}</p></article>") == LONG.strip()


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 100_000 + "</p>" * 100_000, '<span class="ad">' * 60_000, '<span class="ad">' * 60_000 + "</span>", "<div>" * 50_000 + "<body>" * 50_000, "<a '" * 200_000, "<a '\">" * 150_000,
        "<a x='>" * 100_000 + '"', "<script>" * 100_000, "<!--" * 200_000, "<" * 1_000_000, "<li>" * 200_000, "&amp" * 200_000, '<p class="' + "side-" * 200_000 + '">', '<div class="' + "side-" * 200_000 + '!">', "</div>" * 150_000,
        '<b x="' * 150_000 + "<i y='" * 10,
    ],
)
def test_hostile_pages_take_linear_time(html):
    t = time.process_time()
    main_text(html)
    assert time.process_time() - t < 5


def tree_text(page):
    """A plain version over a tree that is known in advance: (kind, text) blocks."""
    return "\n".join(" ".join(t.split()) for kind, t in page if kind == "main")


def test_against_plain_version():
    import random

    rng = random.Random(5)
    for n in range(40):
        page = [(rng.choice(["main", "menu", "aside", "comment"]), f"{LONG} {i} &amp; more".replace("&amp;", "&")) for i in range(rng.randint(1, 12))]
        wrap = {"main": "<p>{}</p>", "menu": "<nav><ul><li>{}</li></ul></nav>", "aside": "<aside>{}</aside>", "comment": '<div class="comment"><p>{}</p></div>'}
        html = "<html><head><title>x</title></head><body><article>" + "".join(wrap[k].format(t.replace("&", "&amp;").replace(" ", " \n ")) for k, t in page) + "</article></body></html>"
        assert main_text(html) == tree_text(page)
