"""Main text: pages with misleading names, broken markup, deep nesting, and the scores against a plain scorer."""

import random
import time
from html.parser import HTMLParser

import pytest

from spendmart.llm import pages

P = "Long enough text of a paragraph, with commas, and some more words so that it reads like prose, really."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # names that only say what an element has, and forms around whole pages
        (f'<div class="layout has-sidebar"><article><p>{P}</p></article></div>', "#"),
        (f'<body class="no-ads"><div class="no-ads"><p>{P}</p></div>', "#"),
        (f'<form id="aspnetForm"><input name=x><div><h1>T</h1><p>{P}</p><p>{P}</p></div></form>', "T # #"),
        (f'<article><div class="entry-header"><h1>Title</h1></div><p>{P}</p></article>', "Title #"),
        (f'<div class=post><div class="entry-header"><h1>Title</h1></div><p>{P}</p><p>{P}</p></div>', "Title # #"),
        (f'<article><div class="comment-count-wrap"><p>{P}</p></div><p>Second, {P}</p></article>', "# Second, #"),
        # comments, adverts, notices, forms under their many names
        (f'<article><p>{P}</p></article><div class="discussion"><p>Says, {P}</p><p>{P}</p><p>{P}</p></div>', "#"),
        (f'<main><p>{P}</p><ol class="commentlist"><li>Reader says, {P}</li></ol></main>', "#"),
        (f'<article><p>{P} <a class="ad" href=x>Buy now</a> end.</p></article>', "# end."),
        (f'<article><p>{P} <span class="ad">Buy <span>right</span> now</span> end.</p></article>', "# end."),
        (f'<article><h1>T</h1><p>{P}</p></article><section id="comments"><ol><li><article class="comment-body"><p>{P} {P}</p></article></li></ol></section>', "T #"),
        (f'<main><article><p>{P}</p><div id="comments"><article><p>{P}{P}{P}</p></article></div></article></main>', "#"),
        (f'<div class=post><p>{P}</p></div><div class="user-comments"><p>{P}</p><p>{P}</p><p>{P}</p></div>', "#"),
        (f'<div class="cookieBanner"><p>We use cookies, {P}</p></div><article><p>{P}</p></article>', "#"),
        (f'<article><p>{P}</p><form><p>Subscribe to get {P}</p><input><button>Go</button></form><p>End.</p></article>', "# End."),
        (f'<div role="banner"><p>{P}</p></div><div id="content"><p>{P}</p><p>x</p></div>', "# x"),
        (f"<header><h1>Site</h1><p>{P}</p></header><article><header><h1>T</h1></header><p>{P}</p></article>", "T #"),
        # quotes without a pair, tags without one
        (f'<article><p class="x>World</p><p>{P}</p></article>', "World #"),
        (f"<article><p data-n=it's>{P}</p></article>", "#"),
        (f'<article><p title="a > b">{P}</p><p class="x>World <a href="y">link</a></p></article>', "# World link"),
        (f"<nav><ul><li><a href=x>A</a><main><p>{P}</p></main>", "#"),
        (f"<article><section><p>{P}</p><p>{P}</p><p>{P}</p></section><section><p>Short end.</p></section></article>", "# # # Short end."),
        ("</div></p>text", "text"),
        ("<article>a&nbsp;&lt;b&gt;\n\t c</article>", "a <b> c"),
    ],
)
def test_names_and_broken_markup(page, text):
    assert pages.main_text(page).replace(P, "#") == text


@pytest.mark.parametrize(
    ("name", "what"),
    [
        ("ad", pages.NAMED), ("adslot", pages.NAMED), ("sidebar-left", pages.NAMED), ("siteHeader", pages.NAMED), ("related-links", pages.NAMED),
        ("comment-list", pages.OF_COMMENTS), ("disqus_thread", pages.OF_COMMENTS), ("post-comments", pages.OF_COMMENTS),
        ("no-ads", pages.PLAIN), ("address", pages.PLAIN), ("download", pages.PLAIN), ("entry-header", pages.PLAIN), ("", pages.PLAIN),
        ("comment-count-wrap", pages.MENTIONED), ("ad-astra-story", pages.MENTIONED),
    ],
)
def test_what_names_say(name, what):
    assert pages.named(name) == what


def test_deep_nesting_takes_linear_time():
    for n in (50_000,):
        for page, text in (
            ("<div>" * n + f"<p>{P}</p>", P),
            ("<div>" * n + f"<p>{P}</p>" + "</p></b></section>" * n, P),
            (f"<article><p>{P}</p>" + "<section><p>x, y</p></section>" * n, f"{P}" + " x, y" * n),
        ):
            begin = time.perf_counter()
            assert pages.main_text(page) == text
            assert time.perf_counter() - begin < 10


class Plain(HTMLParser):
    """Elements as [tag, children, text, link characters] of a well-formed page."""

    def __init__(self):
        super().__init__()
        self.root = ["#root", [], "", 0]
        self.path, self.link = [self.root], False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = True
        else:
            self.path[-1][1].append([tag, [], "", 0])
            self.path.append(self.path[-1][1][-1])

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        else:
            self.path.pop()

    def handle_data(self, data):
        self.path[-1][2] += data
        self.path[-1][3] += len(data) if self.link else 0


def plain_main_text(page):
    """The rules as they stand, each score from scratch. Text lies in p and h2 only."""
    parser = Plain()
    parser.feed(page)
    every = []

    def walk(e, path):
        every.append((e, path))
        for child in e[1]:
            walk(child, [*path, e])

    walk(parser.root, [])
    leaves = [(e, path) for e, path in every if e[2]]
    if not leaves:
        return ""
    under = lambda e: [x for x, path in leaves if x is e or any(p is e for p in path)]

    def score(e):
        points = pages.BONUS.get(e[0], 0.0)
        for x, path in leaves:
            up = path[::-1]
            for share, holder in zip((1, 2, 6, 9, 12), up):
                if holder is e:
                    points += (1.0 + x[2].count(",") + min(len(x[2]) // 100, 3)) / share
        chars, links = sum(len(x[2]) for x in under(e)), sum(x[3] for x in under(e))
        return points * (1 - links / chars)

    holding = [(e, path) for e, path in every if under(e) and e[0] not in ("p", "h2")]
    best, path = max(holding, key=lambda x: (score(x[0]), len(x[1])))
    line = [*path, best]
    kept = next((e for tag in ("article", "main") for e in reversed(line) if e[0] == tag), best)
    above = next(p for e, p in every if e is kept)
    least, chosen = max(10.0, 0.2 * score(best)), [kept]
    for e in above[-1][1] if above else []:
        if e is kept or not under(e):
            continue
        if kept[0] in ("article", "main"):
            good = e[0] in ("article", "section") and score(e) >= least
        elif e[0] in ("p", "h2"):
            good = (e[0] == "h2" or len(e[2]) >= 80) and e[3] / len(e[2]) <= 0.33
        else:
            good = score(e) >= least
        chosen += [e] if good else []
    return " ".join(x[2] for x, path in leaves if any(c is x or any(c is p for p in path) for c in chosen))


def test_scores_equal_a_plain_scorer():
    rng = random.Random(7)
    words = ["one,", "two", "three,", "four", "five"]

    def make(depth):
        if depth == 0 or rng.random() < 0.35:
            text = " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 120])))
            if rng.random() < 0.25:
                text = f"<a>{text}</a>" if rng.random() < 0.5 else f"{text} <a>more links</a>"
            tag = rng.choice(["p", "p", "p", "h2"])
        else:
            text = "".join(make(depth - 1) for _ in range(rng.randint(1, 4)))
            tag = rng.choice(["div", "div", "section", "blockquote", "ul", "article", "main"])
        return f"<{tag}>{text}</{tag}>"

    for _ in range(300):
        page = "".join(make(rng.randint(0, 5)) for _ in range(rng.randint(1, 3)))
        assert pages.main_text(page) == plain_main_text(page)


def test_pages_through_spark(shipped):
    rows = [(1, None, "u", "x"), (2, "", "u", "x"), (3, f"<p>{P}", None, "x"), (3, f"<p>{P}", None, "x"), (None, "<p>" + "word, " * 400_000, "u", "x")]
    table = shipped.createDataFrame(rows, "page_id bigint, html string, url string, text string")
    read = lambda df: df.select("page_id", pages.main_text_column(df["html"]).alias("made"))
    got = [(r["page_id"], len(r["made"])) for r in read(table).collect()]
    assert got == [(1, 0), (2, 0), (3, len(P)), (3, len(P)), (None, 6 * 400_000 - 1)]
    assert read(table.where("false")).count() == 0
