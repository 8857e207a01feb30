"""Operator 8: main text of web pages from flat text blocks and a decision tree.

A page is cut into flat text blocks at block-level tags.  A block goes where its container says by
its tag, class or id that it is none of the article (menu, footer, comments, ...), or where it stands
outside of the article that the page marks.  Each block left has its word count and link density and
those of the blocks left before and after it; a decision tree, trained on the blocks of the small
labelled pages below, keeps or drops it.  The kept blocks, character references decoded and white
space turned into single spaces, are joined by newlines.

Defined cases: null html is empty and gives an empty text; an unfinished tag or
comment at the end is dropped; an unclosed script ends with the page; repeated
rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z|</?\Z", re.S)
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
           "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
         "track", "wbr"}
_SILENT = {"script", "style", "title", "noscript", "template", "iframe", "textarea", "svg", "select",
           "object", "audio", "video", "canvas"}
_OTHER = {"nav", "aside", "footer", "form", "header", "menu", "dialog", "button", "fieldset"}
_ARTICLE = {"article", "main"}
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SAYS_OTHER = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menus?|header|masthead|footer|foot|sidebars?|side|aside|ads?|adverts?|"
    r"advertisements?|adsense|banners?|promos?|sponsor\w*|cookies?|consent|gdpr|notices?|popups?|"
    r"modal|overlay|shar(?:e|ing)|socials?|related|recommend\w*|comments?|comment-?list|repl(?:y|ies)|"
    r"disqus|respond|subscri\w*|newsletters?|breadcrumbs?|pagination|pager|widgets?|login|signup|search|toc|"
    r"complementary|contentinfo|alert)(?:$|[\s_-])", re.I)
_SAYS_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|entry|story|post|content|body|main)(?:$|[\s_-])", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_article: bool
    in_other: bool
    heading: bool


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in page order."""
    page = page or ""
    out: list[Block] = []
    parts: list[str] = []
    open_tags: list[tuple[str, bool, bool]] = []  # name, says article, says other
    linked = links = 0
    heading = False

    def flush() -> None:
        nonlocal linked, parts
        text = " ".join("".join(parts).split())
        if text:
            article = any(t[1] for t in open_tags)
            out.append(Block(text, len(text.split()), linked, article,
                             any(t[2] for t in open_tags), heading))
        parts, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html_lib.unescape(raw)
            parts.append(text)
            if links:
                linked += len(text.split())

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # a closing tag
            if name == "a":
                links = max(0, links - 1)
            if name in _INLINE:
                continue
            flush()
            heading = False if name in ("h1", "h2", "h3", "h4", "h5", "h6") else heading
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == name:
                    del open_tags[k:]
                    break
            continue
        if name in _SILENT:
            if name not in _INLINE:
                flush()
            if not m[3].endswith("/"):
                close = re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
            continue
        if name == "br":
            parts.append(" ")
        if name == "a":
            links += 1
        if name in _INLINE:
            continue
        flush()
        links = 0
        if name in _VOID or m[3].endswith("/"):
            continue
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = True
        if open_tags and open_tags[-1][0] == "p":  # a block ends an open paragraph
            open_tags.pop()
        if name == "li":  # and an item the item before it in the same list
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] in ("ul", "ol"):
                    break
                if open_tags[k][0] == "li":
                    del open_tags[k:]
                    break
        if name in ("html", "body") or heading and name[0] == "h":
            continue
        said = " ".join(x.strip("\"'") for x in _CLASS.findall(m[3]))
        inside = any(t[1] for t in open_tags)
        article = name in _ARTICLE or name not in ("p", "li") and bool(_SAYS_ARTICLE.search(said))
        other = (name in _OTHER and not (name == "header" and inside)
                 or bool(_SAYS_OTHER.search(said)) and name not in _ARTICLE
                 or bool(_HIDDEN.search(m[3])))
        open_tags.append((name, article, other))
    flush()
    return out


FEATURES = ["marked", "heading", "words", "link", "words_before", "link_before", "words_after", "link_after"]


def features(found: list[Block], marked: bool) -> np.ndarray:
    words = np.array([0, *[b.words for b in found], 0], float)
    link = np.array([0, *[b.linked / b.words for b in found], 0], float)
    heading = np.array([b.heading for b in found], float)
    return np.column_stack([np.full(len(found), float(marked)), heading, words[1:-1], link[1:-1], words[:-2],
                            link[:-2], words[2:], link[2:]])


def undecided(found: list[Block]) -> tuple[list[Block], bool]:
    """The blocks that no container rules out, and whether the page marks its article: a block in a
    container that says it is none goes, and so does one outside of the article of a page that has one."""
    left = [b for b in found if not b.in_other]
    marked = any(b.in_article for b in left)
    return [b for b in left if b.in_article or not marked], marked


# Labelled pages, one block a line: + is main text.  Pages that begin with <article> mark theirs.
LABELLED_PAGES = ["""
- <div><a href=/>Home</a> <a href=/bread>Bread</a> <a href=/cakes>Cakes</a> <a href=/soups>Soups</a></div>
+ <h1>How long should dough rise</h1>
+ <p>A dough has risen enough when a finger pressed into it leaves a mark that fills again only slowly. In a warm kitchen that takes about an hour, in a cold one three or four, and in the fridge a whole night.</p>
+ <p>Do not look at the clock alone.</p>
+ <p>Flour differs from mill to mill, and so does the water it takes up. Write down what you did, so that the next loaf can be better than the last, and change one thing at a time.</p>
+ <h2>Folding</h2>
+ <p>Fold the dough every half hour while it rises. Four folds are enough for a <a href=/loaf>plain loaf</a>, six for one with much water, and after the last one it should keep its shape on the table.</p>
- <div><a href=/p1>Rye bread for beginners</a></div>
- <div><a href=/p2>Ten soups for winter</a></div>
- <div><a href=/p3>Our best cakes</a></div>
- <p>Copyright 2019 The Kitchen Table</p>
""", """
- <p><a href=/login>Log in</a></p>
- <p><a href=/cart>Cart</a> (0)</p>
+ <p>The old harbour was closed to large ships in the spring of that year, after the council had argued about it for a decade. Fishing boats still land here every morning, and the market that sells their catch has grown.</p>
+ <p>Visitors like it.</p>
+ <p>The warehouses became flats and studios, the railway line a path for walkers, and the crane that stood at the end of the pier was painted red and left where it was, as a mark for those who come by sea.</p>
+ <p>Nobody has asked for the ships to come back, says the mayor, who was against the plan at first and voted for it at last.</p>
- <p><a href=/n1>Council votes on new school</a></p>
- <p><a href=/n2>Rain expected</a></p>
- <p>Call us on 555 0100</p>
""", """
- <td><a href=a>News</a></td>
- <td><a href=b>Sport</a></td>
- <td><a href=c>Weather</a></td>
- <td><a href=d>Travel and holidays</a></td>
+ <h1>Two goals in the last minutes decide the final</h1>
+ <p>For most of the evening it looked as if neither side would score, and the crowd had begun to leave when the substitute took the ball on the left, passed two men and shot from twenty metres.</p>
+ <p>It was his first touch of the ball, and he said later that he had closed his eyes.</p>
+ <p>The second goal came from a corner with the goalkeeper far out of his area.</p>
- <td><a href=e>All results</a></td>
- <td><a href=f>Table</a></td>
- <td>Page 1 of 3</td>
""", """
- <li><a href=1>Start</a></li>
- <li><a href=2>Products</a></li>
- <li><a href=3>About the company</a></li>
- <div>Search</div>
- <li><a href=4>Read more about our offers for schools and libraries this summer</a></li>
+ <p>The pump is delivered with a hose of two metres and a filter. Before the first use, rinse the filter under running water, screw the hose to the upper opening and fill the housing with water up to the mark.</p>
+ <p>Never run the pump dry. The seals are cooled by the water that passes them and burn within a minute without it, which is the most common cause of the repairs that we see.</p>
+ <li>Filter, two pieces</li>
+ <li>Hose of two metres</li>
+ <p>Spare parts can be ordered for at least ten years after the last pump of a series has been sold.</p>
- <div><a href=5>Terms</a> <a href=6>Privacy</a> <a href=7>Contact</a></div>
- <div><a href=8>Facebook</a></div>
""", """
+ <p>Short answer: yes, as long as both tables have the same key and neither has changed since the copy was made. The longer answer depends on how the copy was made and on who may write to it meanwhile.</p>
+ <p>If in doubt, compare the counts first and then the sums of a column that is hard to get right by chance.</p>
- <p><a href=q1>How do I compare two tables?</a> <a href=q2>How do I copy a table?</a></p>
- <p><a href=q3>Why is my copy empty?</a></p>
- <p>12 votes</p>
- <p><a href=q4>Ask a question</a></p>
""", """
- <div>Advertisement</div>
- <div><a href=x>Shop now</a></div>
+ <h1>Small gardens</h1>
+ <p>Even a balcony has room for herbs. Basil and parsley want sun, mint does with shade and should be kept in a pot of its own, as its roots fill any bed within two summers.</p>
- <div><a href=y>Pots at half price today only</a></div>
+ <p>Water in the morning, and rather much and seldom than little and often, so that the roots go down to where the soil stays damp. In August a second watering in the evening does no harm.</p>
- <div><a href=z1>Next</a></div>
- <div><a href=z2>Previous</a></div>
- <div>Share</div>
""", """<article>
+ <h1>Minutes of the meeting</h1>
+ <p>Present: nine members.</p>
+ <p>The minutes of the last meeting were read and accepted without changes. The treasurer reported on the accounts, which had been checked by two members and found to be in order.</p>
+ <p>Accepted.</p>
+ <h2>Summer party</h2>
+ <p><a href=h>The hall of last year</a></p>
+ <p>It is free on both days, and its rent is the same as before.</p>
+ <li>Tables</li>
+ <li>Lamps</li>
+ <p>Closed at ten.</p>
""", """<article>
+ <p>Yes.</p>
""", """<article>
+ <p>One</p>
+ <p>Two</p>
""", """<article>
+ <h1>On the road</h1>
+ <p>We left before sunrise, as the road over the pass is closed to cars from nine on, and had it to ourselves for an hour, with snow on both sides and a fox that did not move.</p>
- <p><a href=1>Ten passes for summer</a></p>
- <p><a href=2>Where to sleep</a></p>
- <p><a href=3>Our maps</a></p>
+ <p>Beyond the pass the valley opens, and the first village has a bakery that sells bread still warm.</p>
- <p><a href=4>Next part</a></p>
- <p><a href=5>All parts</a></p>
""", """<article>
+ <p>The library opens at noon on Sundays (<a href=m>map</a>).</p>
+ <p><a href=r>Rules for readers</a></p>
+ <p>Books may be kept for four weeks and once renewed, if no other reader has asked for them in the meantime.</p>
+ <p>Thank you</p>
"""]


def labelled_blocks(pages=LABELLED_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES of the labelled pages' blocks, by the code that reads every page, and their labels."""
    rows, labels = [], []
    for page in pages:
        head, *lines = page.strip("\n").split("\n") if page.startswith("<") else ["", *page.strip("\n").split("\n")]
        found, marked = undecided(blocks(head + "".join(line[2:] for line in lines)))
        if len(found) != len(lines):
            raise ValueError(f"a labelled page has one block a line: {page[:80]}")
        rows.append(features(found, marked))
        labels += [line[0] == "+" for line in lines]
    return np.concatenate(rows), np.array(labels, float)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6):
    """A decision tree by Gini impurity: (feature, threshold, low, high) or a label."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= t
            impurity = sum(m.sum() * labels[m].mean() * (1 - labels[m].mean()) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, t, low)
    if best is None:
        return int(share >= 0.5)
    _, f, t, low = best
    return (f, float(t), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


def classify(tree, row: np.ndarray) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def train(pages=LABELLED_PAGES):
    return grow(*labelled_blocks(pages))


def main_text(page: str | None, tree) -> str:
    found, marked = undecided(blocks(page))
    return "\n".join(b.text for b, r in zip(found, features(found, marked)) if classify(tree, r))


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text: one row per row of ``pages``."""
    tree = tree or train()

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_html in batches:
            yield pd.Series([main_text(h, tree) for h in pages_html], dtype=object)

    return pages.select("page_id", "url", texts(F.col("html").cast("string")).alias("text"))
