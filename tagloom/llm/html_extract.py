"""Main text of web pages by boosted trees over the elements of the DOM.

The trees give each element the log odds that its subtree holds text of the article. Decoding
goes over the whole tree: an element can be kept only if its parent is, and among all choices
of that kind the likeliest is taken.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import map_slices, sent
from tagloom.llm.dom import Page, features
from tagloom.llm.trees import Forest, boost

# Pages that the trees are trained on: labelled pages from the layouts below, a fixed number.
TRAINING_PAGES = 500
SEED = 11

# Log odds of one element count for no more than this.
MOST_SURE = 8.0


def decode(page: Page, logits: np.ndarray) -> np.ndarray:
    """The likeliest choice of elements in which the parent of each kept one is kept too.

    From the leaves up: keeping an element gains its log odds and, for each child, what the
    child's subtree gains if that is positive; dropping it drops the subtree.
    """
    n = len(page.tags)
    gain = np.clip(logits, -MOST_SURE, MOST_SURE).tolist()
    parents = page.parents
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[parents[i]] += gain[i]
    kept = np.zeros(n, bool)
    shown = page.shown()
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parents[i]] and gain[i] > 0 and shown[i]
    return kept


def main_text(html: str | None, forest: Forest) -> str:
    page = Page(html)
    return page.text(decode(page, forest.logits(features(page))))


def extract(
    pages: DataFrame,
    forest: Forest | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each whole page.

    Null and empty pages, and pages without an article, have an empty text; repeated rows each
    get their row; a page that ends in the middle is read as far as it goes.
    """
    trees = sent(pages.sparkSession, forest or trained())

    def run(part: dict[str, list]) -> dict[str, list]:
        read = [Page(h) for h in part["html"]]
        rows = [features(p) for p in read]
        logits = trees().logits(np.concatenate(rows))
        cuts = np.cumsum([len(r) for r in rows])[:-1]
        texts = [p.text(decode(p, x)) for p, x in zip(read, np.split(logits, cuts))]
        return {
            "page_id": part["page_id"],
            "url": part["url"],
            "text": texts,
            "n_chars": list(map(len, texts)),
        }

    chosen = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    return map_slices(chosen, run, "page_id long, url string, text string, n_chars long")


def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Forest:
    """Trees trained on ``pages`` labelled pages."""
    rows, marks = [], []
    for html in training_pages(pages, seed):
        page = Page(html)
        rows.append(features(page))
        marks.append(labels(page))
    return boost(np.concatenate(rows), np.concatenate(marks))


def labels(page: Page) -> np.ndarray:
    """1 for the elements of a training page whose subtree holds article text, which is made
    of words with a ``q`` in front; an element without any text goes with its parent."""
    n = len(page.tags)
    article, any_text = np.zeros(n), np.zeros(n)
    for node, text in page.texts:
        if text.strip():
            any_text[node] = 1
            article[node] = max(article[node], float("q" in text))
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        article[p], any_text[p] = max(article[p], article[i]), max(any_text[p], any_text[i])
    for i in range(1, n):
        if not any_text[i]:
            article[i] = article[page.parents[i]]
    return article


def training_pages(pages: int, seed: int) -> list[str]:
    """Made-up pages of many layouts: articles, plain or split into sections, with tables,
    lists, quotes and adverts inside, among the usual menus, headers, sidebars, notices,
    forms, footers and comments, with and without telling tags and class names."""
    rng = random.Random(seed)
    return [_page(rng) for _ in range(pages)]


def _words(rng: random.Random, least: int, most: int, article: bool = False) -> str:
    out = []
    for i in range(rng.randint(least, most)):
        word = "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.choice((2, 3, 4, 5, 7, 9))))
        out.append(("q" if article else "") + word + rng.choice(("", "", "", "", "", ",", ".")))
    return (" ".join(out) + rng.choice((".", "", "!", "?"))).capitalize().replace("Q", "q")


def _named(rng: random.Random, tag: str, names: list[str], plain: float = 0.3) -> str:
    """An opening tag, most often with a telling class or id."""
    if rng.random() < plain:
        return f"<{tag}>"
    name = rng.choice(names)
    if rng.random() < 0.4:
        name += rng.choice(("-wrap", "-box", "_1", " clearfix", "-inner"))
    return f'<{tag} {rng.choice(("class", "class", "id"))}="{name}">'


def _links(rng: random.Random, least: int = 2, most: int = 12) -> str:
    wrap = rng.choice(("<ul>{}</ul>", "<ol>{}</ol>", "{}", "<div>{}</div>"))
    item = "<li>{}</li>" if "l>" in wrap else rng.choice(("{} ", "<span>{}</span>", "<div>{}</div>"))
    links = (
        item.format(f'<a href="/{i}">{_words(rng, 1, 4)}</a>') for i in range(rng.randint(least, most))
    )
    return wrap.format("".join(links))


def _menu(rng: random.Random) -> str:
    if rng.random() < 0.6:
        return f"{_named(rng, 'nav', ['nav', 'menu', 'main-nav'], 0.5)}{_links(rng)}</nav>"
    return f"{_named(rng, 'div', ['nav', 'menu', 'navbar', 'breadcrumbs'], 0.2)}{_links(rng)}</div>"


def _advert(rng: random.Random) -> str:
    tag = rng.choice(("div", "div", "aside", "section", "p"))
    names = ["ad", "ads", "advert", "banner", "sponsored", "promo"]
    inner = _words(rng, 3, 30)
    if rng.random() < 0.3:
        inner = f'<a href="/x">{inner}</a>'
    return f"{_named(rng, tag, names, 0.0)}{inner}</{tag}>"


def _notice(rng: random.Random) -> str:
    names = ["cookie-notice", "consent", "alert", "notice", "gdpr", "modal", "popup"]
    inner = rng.choice(("{}", "<p>{}</p>", "<p>{}</p><button>Ok</button>")).format(_words(rng, 4, 30))
    return f"{_named(rng, rng.choice(('div', 'section', 'aside', 'dialog')), names, 0.0)}{inner}</div>"


def _form(rng: random.Random) -> str:
    fields = "".join(
        f"<label>{_words(rng, 1, 3)}</label><input name=a>" for _ in range(rng.randint(1, 4))
    )
    text = rng.choice(("", f"<p>{_words(rng, 3, 15)}</p>", f"<h3>{_words(rng, 2, 5)}</h3>"))
    names = ["search", "newsletter", "login", "subscribe-form"]
    return f"{_named(rng, 'form', names)}{text}{fields}<button>{_words(rng, 1, 2)}</button></form>"


def _side(rng: random.Random) -> str:
    parts = [
        f"<h3>{_words(rng, 1, 4)}</h3>{_links(rng)}",
        f"<p>{_words(rng, 5, 40)}</p>",
        f"<h4>{_words(rng, 1, 4)}</h4><p>{_words(rng, 5, 30)}</p>",
        _form(rng),
        _advert(rng),
    ]
    inner = "".join(rng.sample(parts, rng.randint(1, 3)))
    if rng.random() < 0.6:
        return f"{_named(rng, 'aside', ['sidebar', 'related', 'widget'], 0.5)}{inner}</aside>"
    return f"{_named(rng, 'div', ['sidebar', 'related', 'widget', 'trending'], 0.0)}{inner}</div>"


def _header(rng: random.Random) -> str:
    inner = "".join(
        rng.sample(
            [f"<h1>{_words(rng, 1, 4)}</h1>", _menu(rng), f"<p>{_words(rng, 2, 10)}</p>", _form(rng)],
            rng.randint(1, 3),
        )
    )
    if rng.random() < 0.6:
        return f"<header>{inner}</header>"
    return f"{_named(rng, 'div', ['header', 'masthead', 'top'], 0.0)}{inner}</div>"


def _footer(rng: random.Random) -> str:
    inner = rng.choice(
        (
            f"&copy; {_words(rng, 2, 25)}",
            f"<p>&copy; {_words(rng, 2, 25)}</p>",
            f"{_links(rng)}<p>{_words(rng, 3, 30)}</p>",
            f"<div>{_words(rng, 3, 30)}</div>{_links(rng)}",
        )
    )
    if rng.random() < 0.7:
        return f"<footer>{inner}</footer>"
    return f"{_named(rng, 'div', ['footer', 'copyright', 'legal'], 0.0)}{inner}</div>"


def _comments(rng: random.Random) -> str:
    one = rng.choice(
        (
            "<div class=comment><b>{}</b><p>{}</p></div>",
            "<li class=comment>{}: {}</li>",
            '<article class="comment"><h4>{}</h4><p>{}</p></article>',
            "<p><b>{}</b> {}</p>",
        )
    )
    inner = "".join(one.format(_words(rng, 1, 2), _words(rng, 3, 60)) for _ in range(rng.randint(1, 6)))
    tag = rng.choice(("div", "section", "ul", "ol"))
    names = ["comments", "comment-list", "discussion", "replies"]
    title = f"<h3>{_words(rng, 1, 3)}</h3>" if rng.random() < 0.5 and tag in ("div", "section") else ""
    return f"{_named(rng, tag, names, 0.0)}{title}{inner}</{tag}>"


def _article(rng: random.Random) -> str:
    def words(least: int, most: int) -> str:
        return _words(rng, least, most, article=True)

    def marked(text: str) -> str:
        if rng.random() < 0.25:
            tag = rng.choice(("b", "i", "em", "strong", "span", 'a href="/z"'))
            return f"<{tag}>{text}" + rng.choice((f"</{tag.split()[0]}>", f"</{tag.split()[0]}> {words(2, 9)}"))
        return text

    parts = []
    if rng.random() < 0.8:
        parts.append(f"<{(h := rng.choice(('h1', 'h1', 'h2')))}>{words(1, 12)}</{h}>")
    short = rng.random() < 0.3
    for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14))):
        least, most = rng.choice(((1, 3), (1, 12), (10, 60), (30, 150)))
        if short:
            least, most = 1, 8
        kind = rng.random()
        if kind < 0.62:
            parts.append(f"<p>{marked(words(least, most))}</p>")
        elif kind < 0.72:
            parts.append(f"<p><b>{words(least, most)}<br>")
        elif kind < 0.78:
            parts.append(f"<h2>{words(1, 8)}</h2>")
        elif kind < 0.83:
            items = "".join(f"<li>{marked(words(1, 20))}</li>" for _ in range(rng.randint(1, 6)))
            parts.append(f"<ul>{items}</ul>")
        elif kind < 0.87:
            parts.append(f"<blockquote><p>{words(4, 40)}</p></blockquote>")
        elif kind < 0.9:
            rows = "".join(
                f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(rng.randint(1, 5))
            )
            parts.append(f"<table>{rows}</table>")
        elif kind < 0.94:
            parts.append(f"<div>{words(least, most)}</div>")
        elif kind < 0.97:
            parts.append(_advert(rng))
        else:
            parts.append(f"<pre>{words(2, 30)}</pre>")
    if rng.random() < 0.2:
        half = len(parts) // 2
        parts = ["<section>", *parts[:half], "</section><section>", *parts[half:], "</section>"]
    inner = "".join(parts)
    if rng.random() < 0.7:
        return f"{_named(rng, 'article', ['post', 'article', 'story', 'entry'], 0.6)}{inner}</article>"
    if rng.random() < 0.5:
        return f"<main>{inner}</main>"
    names = ["content", "post", "article-body", "entry-content", "main", "story"]
    return f"{_named(rng, 'div', names, 0.15)}{inner}</div>"


def _page(rng: random.Random) -> str:
    def some(make, share: float) -> str:
        return make(rng) if rng.random() < share else ""

    before = [some(_header, 0.5), some(_menu, 0.6), some(_notice, 0.25), some(_advert, 0.4), some(_form, 0.15)]
    after = [some(_comments, 0.3), some(_side, 0.4), some(_advert, 0.3), some(_notice, 0.15), some(_form, 0.15)]
    rng.shuffle(before)
    rng.shuffle(after)
    title = _words(rng, 2, 8)
    middle = "".join([*before, some(_side, 0.15), _article(rng), *after])
    if rng.random() < 0.25:
        middle = f"{_named(rng, 'div', ['page', 'wrapper', 'container'], 0.5)}{middle}</div>"
    ending = rng.choice(("</body></html>", "</body></html>", ""))
    return (
        f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title>'
        f"<style>p{{margin:0}}</style><script>track();</script></head><body>{middle}"
        f"{some(_footer, 0.8)}{ending}"
    )
