"""Main text that is interrupted, in several regions, or in blocks with telling classes."""

import pytest

from menulake.llm.extract_text import main_text

A, B = "A first paragraph that is long enough to make the sums surge, with a good many words.", "A second paragraph, as long as the first, in the part behind what interrupts the text."
LINKS = "<ul>" + "<li><a href=x>Some link to elsewhere</a></li>" * 5 + "</ul>"
BOX = "<div class=newsletter><p>Our letter</p><p>every week</p><p>for you</p><p>for free</p></div>"


@pytest.mark.parametrize("between", [LINKS, BOX, BOX.replace("newsletter", "advert"), "<form><p>a</p><p>b</p><p>c</p></form>"])
def test_interrupted_text(between):
    assert main_text(f"<body><h1>Title</h1><p>{A}</p><p>{A}</p>{between}<p>{B}</p><footer>{A}</footer></body>") == f"Title\n{A}\n{A}\n{B}"


def test_short_regions_are_kept():
    assert main_text(f"<article><p>{A}</p></article><article><p>Short.</p></article><p>{B}</p>") == f"{A}\nShort."


@pytest.mark.parametrize("begin, end", [("<article class='post has-comments'>", "</article>"), ("<main class='legal-article'>", "</main>"), ("<div class='has-sidebar'>", "</div>"), ("<div class='legal-article'>", "</div>"), ("<section id=sidebar-layout><article>", "</article></section>")])
def test_classes_of_the_text_itself(begin, end):
    assert main_text(f"<body><nav>{A}</nav>{begin}<p>{A}</p><div class=sidebar><p>Links</p></div><p>{B}</p>{end}<p class=copyright>All rights</p></body>") == f"{A}\n{B}"


def test_long_comments_stay_out():
    assert main_text(f"<div><p>{A}</p></div><div id=comments><p>{B}</p><p>{B}</p><p>{B}</p></div>") == A
    assert main_text(f"<article hidden><p>{A}</p></article><p>{B}</p>") == B
