"""Pages written by hand, of many kinds, each with the text that a reader would call its article."""

import pytest

from quaymark.llm import html_main_text

P1 = "The harbour was rebuilt after the storm, and the new wall has stood since then."
P2 = "Ships from the north call twice a week; most of them carry grain, timber and salt."
P3 = "In winter the ferry stops, so the islanders keep stores for up to two months."
P4 = "Nobody remembers who lit the first lamp, but the keeper's log begins in 1871."
THREE = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
TEXT = f"{P1}\n{P2}\n{P3}"
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/shop">Shop</a></li><li><a href="/about">About us</a></li></ul>'
LIST = "".join(f'<a href="/{x}">{x.title()} and more</a> ' for x in ("harbours", "ferries", "islands", "lamps", "winters"))

PAGES = {
    "article with menu and footer": (f"<nav>{MENU}</nav><article><h1>The harbour</h1>{THREE}</article><footer>© 2021 The Harbour Post</footer>", f"The harbour\n{TEXT}"),
    "main": (f"<header><a href='/'>Harbour Post</a></header><main><h1>The harbour</h1>{THREE}</main>", f"The harbour\n{TEXT}"),
    "content div": (f"<div id='menu'>{MENU}</div><div id='content'><h2>The harbour</h2>{THREE}</div><div id='footer'>All rights reserved.</div>", f"The harbour\n{TEXT}"),
    "unnamed link list beside": (f"<div><div>{LIST}</div><article>{THREE}</article></div>", TEXT),
    "unnamed link list after": (f"<div class='post'>{THREE}</div><div>{LIST}</div>", TEXT),
    "unnamed list of items": (f"<div>{MENU}</div><div class='entry'>{THREE}</div>", TEXT),
    "sidebar": (f"<div class='row'><div class='main-column'>{THREE}</div><div class='sidebar'><h3>Popular</h3>{MENU}</div></div>", TEXT),
    "sidebar with prose": (f"<article>{THREE}</article><aside><h3>About the author</h3><p>She has written about the sea for thirty years.</p></aside>", TEXT),
    "cookie notice": (f"<div class='cookie-notice'><p>We use cookies to make this site better for you. By going on you agree.</p><button>Agree</button></div><article>{THREE}</article>", TEXT),
    "overlay": (f"<article>{THREE}</article><div class='modal overlay'><p>Join our list and never miss a story from the coast.</p></div>", TEXT),
    "advert before": (f"<div class='advert'>Buy two lamps, get a third one free, this week only.</div><article>{THREE}</article>", TEXT),
    "advert inside": (f"<article><p>{P1}</p><div class='ad-box'>Lamps at half the price.</div><p>{P2}</p></article>", f"{P1}\n{P2}"),
    "sponsored inside": (f"<main><p>{P1}</p><aside class='sponsored'><p>Stay at the Harbour Inn, rooms from forty a night.</p></aside><p>{P2}</p></main>", f"{P1}\n{P2}"),
    "share bar": (f"<article><h1>Lamps</h1><div class='share'><a href='#'>Tweet</a> <a href='#'>Post</a></div>{THREE}</article>", f"Lamps\n{TEXT}"),
    "newsletter form": (f"<article>{THREE}</article><form class='newsletter'><label>Your address</label><input type='text'><button>Subscribe</button></form>", TEXT),
    "search form": (f"<form action='/search'><input name='q'><button>Search</button></form><article>{THREE}</article>", TEXT),
    "comments": (f"<article>{THREE}</article><div id='comments'><h3>Two comments</h3><div class='comment'><b>ann</b><p>I remember that storm well.</p></div><div class='comment'><b>bo</b><p>So do I, it took our roof.</p></div></div>", TEXT),
    "comments in the article": (f"<article>{THREE}<section class='comments'><article class='comment'><p>Well said.</p></article></section></article>", TEXT),
    "list in the text": (f"<article><p>{P1}</p><ul><li>Grain comes from the east coast.</li><li>Salt comes from the pans.</li></ul></article>", f"{P1}\nGrain comes from the east coast.\nSalt comes from the pans."),
    "numbered list": (f"<main><p>{P2}</p><ol><li>Light the lamp at dusk.</li><li>Write it down in the log.</li></ol></main>", f"{P2}\nLight the lamp at dusk.\nWrite it down in the log."),
    "quotation": (f"<article><p>{P1}</p><blockquote><p>{P4}</p></blockquote><p>{P2}</p></article>", f"{P1}\n{P4}\n{P2}"),
    "table of data": (f"<article><p>{P1}</p><table><tr><td>Grain</td><td>40 tons</td></tr><tr><td>Salt</td><td>12 tons</td></tr></table></article>", f"{P1}\nGrain\n40 tons\nSalt\n12 tons"),
    "headings": (f"<article><h1>Harbour</h1><p>{P1}</p><h2>Ferries</h2><p>{P3}</p></article>", f"Harbour\n{P1}\nFerries\n{P3}"),
    "code": (f"<article><p>{P1}</p><pre>lamp on\nlamp off</pre></article>", f"{P1}\nlamp on lamp off"),
    "links in prose": ('<article><p>The <a href="/w">new wall</a> was built by <a href="/m">masons</a> from the south, and it has stood since.</p></article>', "The new wall was built by masons from the south, and it has stood since."),
    "markup in words": ("<article><p>Sa<b>lt</b> and gr<i>ai</i>n are <em>what</em> the ships <strong>carry</strong> all year.</p></article>", "Salt and grain are what the ships carry all year."),
    "character references": ("<main><p>Fish &amp; chips cost &pound;4 &mdash; or did; caf&eacute;s closed &#8220;for good&#8221; in 1998.</p></main>", "Fish & chips cost £4 — or did; cafés closed “for good” in 1998."),
    "breaks and spaces": ("<article><p>One line<br>and the   next,\n\n with\ttabs&nbsp;and all.</p></article>", "One line and the next, with tabs and all."),
    "unclosed paragraphs": (f"<article><p>{P1}<p>{P2}<p>{P3}</article><footer>Imprint</footer>", TEXT),
    "unclosed items": (f"<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><main>{THREE}</main>", TEXT),
    "layout table": (f"<table><tr><td>{MENU}</td><td>{THREE}</td></tr></table>", TEXT),
    "no wrapper": (f"<h1>The harbour</h1>{THREE}", f"The harbour\n{TEXT}"),
    "paragraph alone": (f"<body><p>{P1}</p></body>", P1),
    "upper case": (f"<BODY><NAV>{MENU}</NAV><ARTICLE><P>{P1}</P><P>{P2}</P></ARTICLE></BODY>", f"{P1}\n{P2}"),
    "deep wrappers": (f"<div><div class='wrap'><div><div class='inner'><div>{THREE}</div></div></div></div></div><footer><p>Printed in the harbour.</p></footer>", TEXT),
    "script and style": (f"<article><script>var p = '<p>no</p>';</script><style>p{{color:red}}</style>{THREE}</article>", TEXT),
    "comment markup": (f"<article><!-- <p>an old draft</p> -->{THREE}</article>", TEXT),
    "breadcrumb": (f"<div class='breadcrumb'><a href='/'>Home</a> &raquo; <a href='/n'>News</a></div><article><h1>Lamps</h1>{THREE}</article>", f"Lamps\n{TEXT}"),
    "pagination": (f"<main>{THREE}<div class='pager'><a href='?1'>1</a> <a href='?2'>2</a> <a href='?3'>Next</a></div></main>", TEXT),
    "related": (f"<article>{THREE}</article><section class='related'><h3>Read on</h3>{LIST}</section>", TEXT),
    "tags": (f"<article>{THREE}<div class='tags'><a href='/t/sea'>sea</a> <a href='/t/lamp'>lamp</a></div></article>", TEXT),
    "other script": ("<nav><a href='/'>Главная</a></nav><article><p>Гавань перестроили после шторма, и новая стена стоит до сих пор.</p></article><footer>© 2020</footer>", "Гавань перестроили после шторма, и новая стена стоит до сих пор."),
    "unclosed noscript": (f"<noscript><p>Switch scripts on.</p></noscript><noscript><article>{THREE}</article>", TEXT),
    "nothing but a menu": (f"<nav>{MENU}</nav><footer>© 2019 Harbour Post</footer>", ""),
    "hidden": (f"<article>{THREE}<div style='display:none'>Loading, please wait.</div></article>", TEXT),
    "figure": (f"<article><p>{P1}</p><figure><img src='a.png'><figcaption>The wall at low tide.</figcaption></figure></article>", f"{P1}\nThe wall at low tide."),
}


def test_most_pages_are_read_as_a_reader_would():
    names = list(PAGES)
    found = html_main_text.trained().extract([PAGES[n][0] for n in names])
    wrong = [n for n, got in zip(names, found, strict=True) if got != PAGES[n][1]]
    assert len(names) >= 45 and len(wrong) <= 5, [(n, found[names.index(n)]) for n in wrong]


@pytest.mark.parametrize("name", ["article with menu and footer", "unnamed link list beside", "unnamed link list after", "advert before", "comments", "nothing but a menu", "character references"])
def test_pages_that_must_not_go_wrong(name):
    source, want = PAGES[name]
    assert html_main_text.trained().extract([source])[0] == want
