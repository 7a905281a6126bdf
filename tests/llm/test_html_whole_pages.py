"""Pages whose markup must not cost their text."""

import pytest
from test_html import LONG

from sievework.llm import html_text

ARTICLE = "<article><p>Text</p></article>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body class='has-sidebar'>{ARTICLE}</body>", "Text"),
        (f"<body class='sidebar'>{ARTICLE}</body>", "Text"),
        (f"<div class='layout with-sidebar'><p>{LONG}</p></div>", LONG),
        ("<article class='post comments-open'><p>Text</p></article>", "Text"),
        ("<main id='content' class='no-nav'><p>Text</p></main>", "Text"),
        (f"<div class='sidebar'><div>{ARTICLE}</div></div><div class='sidebar'><p>{LONG}</p></div>", "Text"),
        (f"<form id='all'><div class='menu'><a href=x>Home</a></div><main>{LONG}</main></form>", LONG),
        ("<html><head><title>T</title><meta charset=utf-8><body><article><p>Text</p></article>", "Text"),
        ("<html><head><title>T</title><script>var a='<div>';</script><article><p>Text</p></article>", "Text"),
        ("<html><head><title>T</title></head><body><article><p>Text</p></article>", "Text"),
        ("<article><p>One</p><button>Go<p>Two</p></article>", "One\n\nTwo"),
        ("<article><p>One</p><button>Go<p>Two</p><button>Stay</button><p>Three</p></article>", "One\n\nTwo\n\nThree"),
        ("<article><p>One</p><select><option>a<option>b<p>Two</p></article>", "One\n\nTwo"),
        ("<article><p>One <svg> two</p><p>Three</p></article>", "One\n\nThree"),
        ("<article><p>One</p><script>var x = '<p>no</p>'", "One"),
        (f"<div class='site-footer'>{LONG}</div><div class='sidebar widget'>{LONG}</div>{ARTICLE}", "Text"),
        ("<main hidden><p>Text</p></main>", ""),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text
