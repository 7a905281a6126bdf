import pytest

from sievework.llm import html_text

LONG = "The river runs under the old bridge and it is cold in the morning, with a light wind from the north."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<article><h1>Title</h1><p>One &amp;  two<br>three</p></article>", "Title\n\nOne & two three"),
        ("<nav><a href='/'>Home</a></nav><article><p>Text</p><aside>side</aside><p>More</p></article><footer>&copy; x</footer>", "Text\n\nMore"),
        ("<article><p>Text</p><div class='comments'><p>Reader says this</p></div></article>", "Text"),
        ("<article><p>Text<script>var t=\"</p>\";</script> goes on</p><style>p{}</style></article>", "Text goes on"),
        ("<article><p><b>Open bold<br><p>Next</article><footer>end", "Open bold\n\nNext"),
        ("<article><p>Text<!-- hidden <p> --> on</p><form><input><p>Name</p></form></article>", "Text on"),
        ("<article><p>a &lt;b&gt; c &#233;</p></article>", "a <b> c é"),
        ("<article><header><h1>Head</h1></header><p>Body</p></article>", "Head\n\nBody"),
        (f"<div><a href=x>Menu item number one</a></div><div>{LONG}</div>", LONG),
        (f"<p>Kicker</p><p>{LONG}</p><p>Signed</p>", f"Kicker\n\n{LONG}\n\nSigned"),
        ("<p>Just a short line</p>", ""),
        ("<div class='article-body'><div class='article-header'>Head</div><p>Short</p><div class='relatedPosts'>other</div></div>", "Head\n\nShort"),
        ("<div id='pageHeader'>" + LONG + "</div><div role=main><p>Text</p></div>", "Text"),
        ("<div id='cookie-notice'><p>" + LONG + "</p></div>", ""),
        ("<p>5 < 6 and < 7</p><article>x < y</article>", "5 < 6 and < 7\n\nx < y"),
        ("<article><p title='a > b'>attribute</p><p hidden>unseen</p></article>", "attribute"),
        ("<article><p>cut off in a tag</p><p", "cut off in a tag"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_second_pass():
    open_, yes, no = None, True, False
    assert html_text.second_pass([open_, yes, open_, open_, open_, no, open_]) == [True, True, True, False, False, False, False]
    assert html_text.second_pass([open_, open_]) == [False, False]
    assert html_text.second_pass([]) == []


def test_rows(spark):
    rows = [(1, "u", "<article>" + "<p>word</p>" * 20_000 + "</article>", "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "u", "<p", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(df).collect()
    assert sorted((r.page_id or 0, r.url or "", len(r.text)) for r in found) == [(0, "u", 0), (1, "u", 20_000 * 6 - 2), (2, "", 0), (2, "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0
