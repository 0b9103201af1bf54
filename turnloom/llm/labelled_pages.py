"""Labelled pages for training: layouts filled with invented words.

``data-main`` marks the article, ``data-side`` what is not content although it stands inside
or beside it. ``{h}``, ``{p}``, ``{s}``, ``{l}``, ``{k}`` stand for a heading, a paragraph, a short
paragraph, a list item and a link.
"""

from __future__ import annotations

import random
import re

NAV = "<nav><ul><li>{k}</li><li>{k}</li><li>{k}</li></ul></nav>"
FOOT = "<footer>&copy; site.example &middot; {s}</footer>"
LAYOUTS = (
    f"<html><body>{NAV}<div class=ad>{{s}}</div><article data-main><h1>{{h}}</h1><p><b>{{h}}<br><p>{{s}}</p><p>{{p}}</p><p>{{s}}</p></article>{FOOT}</body></html>",
    f"<html><body>{NAV}<div class=ad>{{p}}</div><article data-main><h1>{{h}}</h1><p>{{s}}</p></article>{FOOT}</body></html>",
    f"<html><body><header><h1>{{h}}</h1>{{s}}</header>{NAV}<main data-main><h1>{{h}}</h1><p>{{p}}</p><h2>{{h}}</h2><p>{{p}}</p></main><aside><h3>{{h}}</h3><p>{{s}}</p></aside>{FOOT}</body></html>",
    "<html><body><div id=header>{k} {k}</div><div class=menu>{k} {k} {k}</div><div id=content data-main><h2>{h}</h2><p>{p}</p><ul><li>{l}</li><li>{l}</li></ul><p>{p}</p></div><div class=sidebar><p>{s}</p><p>{p}</p></div><div id=footer><p>{s}</p></div></body></html>",
    f"<html><body>{NAV}<article data-main><h1>{{h}}</h1><p>{{p}}</p><p>{{s}}</p><section class=comments data-side><h3>{{h}}</h3><p>{{p}}</p><p>{{s}}</p></section></article>{FOOT}</body></html>",
    f"<html><body>{NAV}<article data-main><h1>{{h}}</h1><p>{{p}}</p><div class=share data-side>{{k}} {{k}}</div><p>{{p}}</p></article><div id=comments><div class=comment><p>{{p}}</p></div><div class=comment><p>{{s}}</p></div></div>{FOOT}</body></html>",
    f"<html><body><div class=cookie-notice><p>{{p}}</p><button>{{h}}</button></div>{NAV}<div class=post data-main><h1>{{h}}</h1><div class=post-body><p>{{p}}</p><blockquote>{{p}}</blockquote><p>{{s}}</p></div></div><form><label>{{h}}</label><p>{{s}}</p></form>{FOOT}</body></html>",
    f"<html><body><div class=banner>{{s}}</div>{NAV}<div class=wrap><div class=entry data-main><h1>{{h}}</h1><p>{{p}}</p><aside class=related data-side><h4>{{h}}</h4><ul><li>{{k}}</li><li>{{k}}</li></ul></aside><p>{{p}}</p></div></div><div class=newsletter><p>{{s}}</p></div>{FOOT}</body></html>",
    f"<html><body>{NAV}<section data-main><h1>{{h}}</h1><p>{{p}}</p><pre>{{p}}</pre><table><tr><td>{{s}}</td><td>{{s}}</td></tr></table><p>{{s}}</p></section><div role=complementary><p>{{p}}</p></div>{FOOT}</body></html>",
    f"<html><body>{NAV}<article data-main><header><h1>{{h}}</h1></header><div class=advert data-side><p>{{p}}</p></div><p>{{p}}</p><ol><li>{{l}}</li><li>{{p}}</li></ol><figure><figcaption>{{s}}</figcaption></figure></article><div class=sponsored><p>{{p}}</p></div>{FOOT}</body></html>",
    "<html><body><p data-main>{p}</p><p data-main>{p}</p><p data-main>{s}</p></body></html>",
    "<html><body><div class=notice>{p}</div><div class=article-text data-main><p>{p}</p><p>{p}</p></div><div class=login><form><p>{s}</p><select><option>{h}</option></select></form></div></body></html>",
    "<html><body><div>{k} {k} {k}</div><div data-main><h1>{h}</h1><p>{p}</p><p>{p}</p></div><div>&copy; {s}</div></body></html>",
    "<html><body><div><ul><li>{k}</li><li>{k}</li></ul></div><div><div data-main><h1>{h}</h1><p>{s}</p><p>{p}</p></div><div><h3>{h}</h3>{k}<br>{k}</div></div><div><p>Copyright {s}</p></div></body></html>",
    "<html><body><div>{k} {k}</div><div data-main><h2>{h}</h2><div>{p}</div><div>{p}</div><ul><li>{l}</li><li>{l}</li></ul></div><div>{k} {k} &copy; {s}</div></body></html>",
    f"<html><body>{NAV}<article data-main><h1>{{h}}</h1><p>{{p}}</p><p>{{p}}</p></article><ol class=commentlist><li>{{p}}</li><li><p>{{s}}</p></li></ol>{FOOT}</body></html>",
    f"<html><body><ul id=mainmenu><li>{{k}}</li><li>{{k}}</li></ul><div class=postbody data-main><h1>{{h}}</h1><p>{{p}}</p></div><div id=usercomments><h3>{{h}}</h3><div><p>{{p}}</p></div><div><p>{{p}}</p></div></div><div id=pagefooter><p>{{s}}</p></div></body></html>",
    "<html><body><div data-main><p>{p}</p><p>{p}</p></div></body></html>",
    "<html><body><div><div>{k} {k}</div></div><div data-main><p>{p}</p><p>{s}</p></div><div><div>{s} &copy; {h}</div></div></body></html>",
    "<html><body><ul class=menu><li>{h}</li><li>{h}</li></ul><div id=topbar>{s}</div><div class=story data-main><p>{p}</p><p>{p}</p></div><div class=share>{h}</div><div class=search>{s}</div></body></html>",
    "<html><body><div class=navigation><ul><li>{s}</li><li>{s}</li></ul></div><article data-main><h1>{h}</h1><p>{p}</p><div class=social data-side>{s}</div><p>{p}</p></article><div class=breadcrumb>{h}</div><div class=subscribe><p>{p}</p></div><div class=legal>{p}</div></body></html>",
)


def labelled_pages(copies: int, seed: int = 0) -> list[str]:
    """Each layout ``copies`` times, with other words and lengths."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(
            "".join(rng.choice("aeiou") + rng.choice("bdfgklmnprst") for _ in range(rng.randint(1, 3)))
            for _ in range(rng.randint(low, high))
        )

    fill = {
        "{h}": lambda: words(1, 8).capitalize(),
        "{p}": lambda: words(1, 90).capitalize() + ".",
        "{s}": lambda: words(1, 12).capitalize() + rng.choice(["", ".", "."]),
        "{l}": lambda: words(1, 20),
        "{k}": lambda: f"<a href=/x>{words(1, 2)}</a>",
    }
    pages = []
    for layout in LAYOUTS * copies:
        more = re.sub(r"<p>\{p\}</p>", lambda m: m[0] * rng.randint(1, 4), layout)
        pages.append(re.sub(r"\{[hpslk]\}", lambda m: fill[m[0]](), more))
    return pages
