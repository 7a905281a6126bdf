"""What the two passes decide, learned stop words, hostile nesting, and whole pages against an independent reading."""

import time
from html.parser import HTMLParser

import pytest
from test_html import LONG

from sievework.llm import html_text, queries

FOREIGN = "Joki virtaa vanhan sillan alla aamulla kylmänä ja tuuli puhaltaa hiljaa pohjoisesta kohti kaupunkia, jossa ihmiset heräävät hitaasti uuteen päivään."
LINKS = "<ul><li><a href=a>Next story</a></li><li><a href=b>Previous story</a></li></ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p>{LONG}</p>{LINKS}<p>End.</p></article>", f"{LONG}\n\nEnd."),
        (f"<article><p>{LONG}</p><div><a href=f>Share</a> <a href=t>Tweet</a></div></article>", LONG),
        (f"<article><h2><a href=x>Headline</a></h2><p>{LONG}</p></article>", f"Headline\n\n{LONG}"),
        (f"<article><p>{LONG}</p>{LINKS}<p>Read on:</p>{LINKS}</article>", LONG),
        (f"<article><p>{LONG}</p><p>See <a href=x>the other report</a> too</p></article>", f"{LONG}\n\nSee the other report too"),
        (f"<article><p>{LONG}</p><div class='user-comments'><p>{LONG}</p></div></article>", LONG),
        (f"<article><p>{LONG}</p><div class='gdpr-bar'>{LONG}</div></article>", LONG),
        (f"<article><p>All rights reserved.</p><p>{LONG}</p></article>", f"All rights reserved.\n\n{LONG}"),
        (f"<p>{LONG}</p><p>Copyright 2020 All rights</p>", LONG),
        (f"<body><div><a href=x>Valikko</a></div><p>{FOREIGN}</p><p>Lyhyt.</p></body>", f"{FOREIGN}\n\nLyhyt."),
        (f"<p>{LONG}</p><p>Short after it</p><p>Before links</p><div>{'<a href=x>link</a> ' * 9}</div><p>Terms apply</p>", f"{LONG}\n\nShort after it"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_passes_decide():
    page = f"<nav><p>Menu</p></nav><article><p>{LONG}</p><p>Short.</p>{LINKS}</article><p>{LONG}</p><p>After it</p>"
    assert [(first, second) for _, first, second in html_text.labelled(page)] == [(False, False), (True, True), (None, True), (False, False), (False, False), (True, True), (None, True)]


def test_articles_look_at_their_own_blocks():
    open_, yes, no = None, True, False
    assert html_text.second_pass([no, open_, no], [no, yes, no]) == [False, True, False]
    assert html_text.second_pass([no, open_, no], [yes, yes, yes]) == [False, False, False]
    assert html_text.second_pass([open_, no], [yes, yes], [yes, no]) == [False, False]
    assert html_text.second_pass([open_, no], [yes, yes], [no, no]) == [True, False]
    assert html_text.second_pass([open_, open_], [no, yes]) == [True, True]


@pytest.mark.parametrize(
    "page",
    ["<span>" * 15_000 + "</b>" * 15_000, "<b><div>" + "<span>" * 15_000 + "</b>" * 15_000, "<main>" * 15_000, "<span>" * 15_000 + "<td>x</td>" * 5_000, "<p><i>" * 15_000, "<button>" * 3_000],
)
def test_hostile_nesting(page):
    began = time.time()
    html_text.main_text(page)
    assert time.time() - began < 3


def test_stop_words_of_the_table(spark):
    said = ["zu", "ka", "mi"]
    body = " ".join(f"{said[i % 3]} lauseessa{i} sanoja{i}" for i in range(12))
    rows = [(i, f"<p>{body} {i}</p><script>var ohi = 1</script>") for i in range(40)] + [(99, None), (100, "")]
    df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    learned = html_text.learned_stop_words(df)
    assert set(said) <= learned and "var" not in learned and not any(len(w) > html_text.STOP_LETTERS for w in learned)
    assert {r.text != "" for r in html_text.extract(df).collect() if r.page_id < 99} == {True}
    assert html_text.learned_stop_words(df.limit(0)) == frozenset()


class Plain(HTMLParser):
    """Text of the article's paragraphs, items and headings, by the standard parser."""

    ENDS = {"p", "li", "h1", "h2", "h3", "div", "ul", "article", "blockquote", "td", "tr", "table", "section", "nav", "footer", "aside", "pre"}
    SKIPPED = {"script", "style", "nav", "footer", "aside", "form"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skip, self.parts, self.blocks = 0, [], [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text and self.inside and not self.skip:
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.ENDS:
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        names = dict(attrs).get("class") or ""
        if tag in self.SKIPPED or tag == "div" and names in ("ad", "comments"):
            self.skip.append(tag)
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in self.ENDS:
            self.flush()
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if not (self.skip and self.skip[-1] in ("script", "style")):
            self.parts.append(data)


def test_the_pages_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in queries.table(spark, sf, "pages").collect()}
    for r in queries.op9_block_rules(spark, sf).collect():
        plain = Plain()
        plain.feed(pages[r.page_id] or "")
        plain.close()
        plain.flush()
        assert r.text == "\n\n".join(plain.blocks), r.page_id
        assert r.n_chars == len(r.text)
