"""Templates by counting alone, on pages without article elements and class names, against a plain count."""

import collections
import random

from tripstrata.llm import pagetext

WORDS = "river stone light morning paper window garden bread letter evening road winter table music field bird".split()


def site(pages=120):
    """(id, url, html, blocks): each page has blocks of its own, a menu, a footer, a notice on most pages, one of
    twelve adverts, and a note of inline elements that stands in the body by itself."""
    r = random.Random(5)
    adverts = [f"Buy the {r.choice(WORDS)} number {k} today" for k in range(10)] + ["Rare offer one", "Rare offer two"]
    out = []
    for i in range(pages):
        own = [" ".join(r.choice(WORDS) for _ in range(r.randrange(4, 20))) + f" {i} {k}" for k in range(r.randrange(1, 5))]
        advert = adverts[10 + i % 2] if i < 8 else adverts[i % 10]
        blocks = [("div", '<a href="/">Start</a> and <a href="/x">more of it</a>', "Start and more of it")]
        blocks += [("p", own[0], own[0]), ("div", advert, advert)]
        blocks += [("p", "We use <b>small</b> files", "We use small files")] if i % 3 else []
        blocks += [("section", b, b) for b in own[1:]]
        blocks += [("", "<span>Call us</span> <i>any time</i>", "Call us any time"), ("div", "Made by the river &amp; sons", "Made by the river & sons")]
        html = "".join(f"<{tag}>{inner}</{tag}>" if tag else inner for tag, inner, _ in blocks)
        out.append((i, f"https://site.example/{i}", f"<html><body>{html}</body></html>", [text for *_, text in blocks]))
    return out


def test_counting_alone_finds_the_templates(spark):
    pages = site()
    # what recurs on five pages goes, whatever it is made of; the driver's own count
    on_pages = collections.Counter(b for *_, blocks in pages for b in set(blocks))
    want = {i: "\n".join(b for b in blocks if on_pages[b] < pagetext.MIN_PAGES) for i, *_, blocks in pages}
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    for limit in (pagetext.BROADCAST_TEMPLATES, 0):
        got = {r["page_id"]: r["text"] for r in pagetext.main_text(frame.repartition(4), limit=limit).collect()}
        assert got == want
    assert sum("Rare offer" in t for t in want.values()) == 8  # on four pages each: stays
    assert not any("Buy the" in t or "Call us" in t or "small files" in t for t in want.values())


def test_what_articles_share_stays(spark):
    """Inside an article a block must stand on a share of the host's pages: a quoted passage on a few does not go."""
    rows = [(i, f"https://host.example/{i}", f"<article><h1>Head {i}</h1><p>{'Often quoted words' if i < 8 else f'own {i}'}</p><div>Printed on every page</div></article>") for i in range(60)]
    got = {r["page_id"]: r["text"] for r in pagetext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head 3\nOften quoted words" and got[20] == "Head 20\nown 20"
