"""HTML extraction: pages as flat text blocks, told apart by a decision tree.

A block's features are its words and link density, those of the blocks before and
after it, and what it stands in. The tree is trained on the labelled blocks of a few
small pages below.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|textarea|select|svg|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<shut>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
HINTED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
#: Words of a class, id or role that name something beside the article.
BESIDE = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social "
    "footer header masthead topbar comment comments commentlist reply replies respond disqus discussion newsletter subscribe signup login "
    "search form pagination pager tags copyright legal disclaimer complementary contentinfo".split()
)
#: Those of them that name what readers say, whatever stands in it.
READERS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: What a name begins with that tells the state or the subject of what it stands on, as has-sidebar does.
STATE = frozenset("has no not with without tag category cat".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SPACED = frozenset(("br", "wbr"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav aside footer form button menu dialog".split())
INSIDE = frozenset(("article", "main"))
#: Elements that a new block element of the same kind, or one that holds them, ends.
SELF_ENDING = frozenset("p li dt dd tr td th option".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    outside: bool
    never: bool  # hidden, or what readers say
    hints: tuple[int, ...]  # numbers of the elements around it that are named as something beside the article
    frame: int | None  # number of the outermost article or main element around it
    inside: bool
    page_header: bool
    heading: bool


def _named(rest: str) -> frozenset[str]:
    """What an element's class, id or role names of the things beside the article."""
    found: set[str] = set()
    for value in HINTED.findall(rest):
        for name in value.strip("\"'").lower().split():
            words = re.split(r"[^a-z0-9]+", name)
            if words[0] not in STATE:
                found.update(BESIDE.intersection(words))
    return frozenset(found)


def flat_blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, character references decoded, white space made single."""
    open_tags: list[tuple[str, int, bool, bool]] = []  # element, its number, if it is named as something beside the article, if it can't hold it
    elements = 0
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []

    def end_block() -> None:
        words = "".join(parts).split()
        if words:
            names = [t[0] for t in open_tags]
            frame = next((n for t, n, _, _ in open_tags if t in INSIDE), None)
            inside = frame is not None
            found.append(Block(
                " ".join(words), len(words), min(len(words), len("".join(linked).split())), any(t in OUTSIDE for t in names),
                any(h for *_, h in open_tags), tuple(n for _, n, b, _ in open_tags if b), frame, inside, "header" in names and not inside, any(re.fullmatch("h[1-6]", t) for t in names[-3:]),
            ))
        parts.clear()
        linked.clear()

    for m in TOKEN.finditer(page):
        if text := m["text"]:
            clear = references.unescape(text)
            parts.append(clear)
            if any(t[0] == "a" for t in open_tags):
                linked.append(clear)
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in SPACED:
            parts.append(" ")
            continue
        if name not in INLINE:
            end_block()
        elif name == "a":
            linked.append(" ")
        if m["shut"]:
            for at in range(len(open_tags) - 1, -1, -1):
                if open_tags[at][0] == name:
                    del open_tags[at:]
                    break
                if name in INLINE and open_tags[at][0] not in INLINE:
                    break
        elif name not in VOID and not m["rest"].endswith("/"):
            if name not in INLINE:  # a new block ends inline elements left open, and its own kind
                while open_tags and (open_tags[-1][0] in INLINE or name in SELF_ENDING and open_tags[-1][0] == name):
                    open_tags.pop()
                if name != "p" and open_tags and open_tags[-1][0] == "p":
                    open_tags.pop()
            rest = m["rest"]
            elements += 1
            whole = name in ("html", "body")
            named = frozenset() if whole else _named(rest)
            open_tags.append((name, elements, bool(named), bool(named & READERS) or not whole and bool(HIDDEN.search(rest))))
    end_block()
    return found


def _misnamed(blocks: list[Block]) -> frozenset[int]:
    """Names that don't count: where every article and main element stands in or is something named as beside
    the article, those of the one with most words and of what it stands in, if it has more words than all
    that isn't named so."""
    words: dict[int | None, int] = {}
    for b in blocks:
        if not b.outside and not b.never and (b.frame is not None or not b.hints):
            words[b.frame] = words.get(b.frame, 0) + b.words
            if b.frame is not None and not b.hints:
                return frozenset()
    elsewhere = words.pop(None, 0)
    if not words:
        return frozenset()
    frame = max(words, key=lambda f: (words[f], -f))
    if words[frame] <= elsewhere:
        return frozenset()
    return frozenset(n for b in blocks if b.frame == frame for n in b.hints if n <= frame)


def features(blocks: list[Block]) -> np.ndarray:
    """Per block: words and link density of it, the one before and the one after; if it stands in
    something beside the article, in the article, outside of the page's article, in a heading."""
    own = np.array([(b.words, b.linked / b.words) for b in blocks], dtype=float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    around = np.hstack((own, np.vstack((edge, own[:-1])), np.vstack((own[1:], edge)))) if len(own) else np.zeros((0, 6))
    misnamed = _misnamed(blocks)
    hinted = [b.never or any(n not in misnamed for n in b.hints) for b in blocks]
    article = any(b.inside and not b.outside and not h for b, h in zip(blocks, hinted))
    place = np.array([(b.outside or h or b.page_header, b.inside, article and not b.inside, b.heading) for b, h in zip(blocks, hinted)], dtype=float).reshape(-1, 4)
    return np.hstack((around, place))


#: The labelled table: pages whose blocks of the main text are marked by a star at their start.
LABELLED = (
    '<body><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav><article><h1>*A short walk</h1><p>*The path follows the river for an hour before it climbs to the old mill on the hill.<p>*Yes.<p>*Bring water, a coat and good shoes, because the weather turns fast here.</article><footer>Copyright by us</footer></body>',
    '<body><header><h1>The Daily Page</h1><a href=1>Sign in</a></header><div class=ad>Buy now and save half of the price on all shoes this week only.</div><main><h2>*Rain again</h2><p>*It rained.<p>*More <a href=2>rain is forecast</a> for the rest of the week, said the office on Monday.</main><aside>Most read: ten things that you did not know about rain and wind and snow in the north.</aside></body>',
    '<body><div id=menu><a href=1>One</a> <a href=2>Two</a></div><div><p>*There was no room left on the last boat that evening, so we slept in the hall and waited for the morning.<p>*Nobody spoke for a long while; the lamps went out one by one and the harbour was still.</div><div class=sidebar><p>Subscribe to our letter and get the best of the week in your inbox every Friday morning for free.</div></body>',
    '<body><article><header><h1>*On bread</h1><p>*By the baker</header><p>*Flour, water, salt and time.<p>*<a href=1>Flour</a><section class=comments><h3>Comments</h3><p>I have baked this loaf twice now and it came out well both times, thank you so much for it.<p>Nice!</section></article><div class="cookie-notice">We use cookies to give you the best experience on our site. By staying you agree to them all.</div></body>',
    '<body><div><a href=1>Start</a></div><div><a href=2>Shop for hats</a></div><p>*The committee met on Tuesday and agreed to fund the new bridge, which is to open in the spring of next year.<p>*It will carry trams as well as cars and people on foot, and will cost less than was feared at first.<div><a href=3>Next story</a></div><div>All rights reserved</div></body>',
    '<body><form><p>Enter your name and address below to receive our catalogue by post within the next two weeks.<p>Send</form><article><p>*No.<p>*Not yet.<p>*Perhaps in the spring, when the roads are open and the snow has gone from the pass.</article><nav><a href=1>Older</a> <a href=2>Newer</a></nav></body>',
    '<body><div class=nav>Home News Sport</div><article><div class=advert>Half price holidays in the sun, book with us today before they are gone for good.</div><p>*The team won by two goals in front of a small crowd on a cold night.<p>*End.</article><footer><p>This site is run by a small group of volunteers who give their time for nothing at all.</footer></body>',
    '<body><div><p>Menu</div><h1>*How the clock was mended</h1><p>*For eleven years the clock on the town hall had shown ten past four, and most people had stopped looking at it.<p>*Then a watchmaker moved in across the square, climbed the tower and found a nest behind the wheels.<h2>*A new start</h2><p>*Since that day it has lost less than a minute each month, which is more than can be said of the trains.<div>Share</div></body>',
    '<body><header><p>Welcome to the site of the society for the study of local history and old maps of the county.</header><article><h1>*Maps</h1><ul><li>*One by Speed<li>*<a href=1>One by Morden</a></ul><blockquote>*All maps lie.</blockquote></article><div class="comments"><p>Thank you for this list, I had been looking for the second one for years without any luck.</div></body>',
    '<body><article><h1>*Seeds</h1><p>*Sow them in rows a hand apart, cover them with fine soil, and keep them damp until they come up in about ten days.</article><footer>Contact: the garden club, at the old school, every second Monday.</footer></body>',
    '<body><div>This page was made for screens of any size, and works best with a current browser and a fast line.</div><article><p>*It rained all night and the tents stood in water by the morning, but nobody wanted to be the first to go home.<p>*So we stayed.</article><div>Printed in the north by a small press with two machines and one cat, since the year of the great flood.</div></body>',
    '<body><main><p>*The last tram leaves at one, and after that there is only the long way round by the canal.</main><div>Open from nine to five</div><div>See also the pages of our friends in the south, who do the same with boats and sell the prints by post.</div></body>',
    '<body><nav>Our town Our people Our plans for the coming year and all the forms that you need to take part in them</nav><p>*The council has set aside a field behind the station for new plots, and will hand them out by lot in the autumn.<p>*Those who took part last year and were not lucky have two tickets in the draw, so the odds are fair.<footer>Town hall, market square, open every day but Sunday from eight in the morning until four.</footer></body>',
    '<body><p><a href=1>Log in</a><p><a href=2>Register</a><p>Ok<div role=alert>Please turn on scripts in your browser to see all of the parts of this page as they were made.</div><p>*We left before dawn and drove along the coast until the fuel ran low near the lighthouse at the point.<p>*The keeper sold us enough to reach the next town, and a bag of apples for the road as well.</body>',
    '<body><div id=top><a href=1>Home</a> <a href=2>All</a></div><div class="post"><h1>*Ice</h1><p>*The lake froze over in one night, and by noon half of the village stood on it with skates and brooms.<h2>*Thaw</h2><p>*A week later it was water again, and the boats that lay on the bank all winter went back in.</div><p><a href=3>Next</a></body>',
)
MARK = "*"


@dataclass
class Split:
    feature: int
    at: float
    low: Split | float
    high: Split | float


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> Split | float:
    """A tree that splits where the impurity falls most; a leaf is the share of label 1."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    best, chosen = len(y) * y.mean() * (1 - y.mean()) - 1e-9, None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = t[:-1], t[-1] - t[:-1]
        impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
        impurity[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = np.inf
        k = int(np.argmin(impurity))
        if impurity[k] < best:
            best, chosen = impurity[k], (f, (v[k] + v[k + 1]) / 2)
    if chosen is None:
        return float(y.mean())
    low = x[:, chosen[0]] <= chosen[1]
    return Split(*chosen, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def chances(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    low = x[:, tree.feature] <= tree.at
    out = np.empty(len(x))
    out[low], out[~low] = chances(tree.low, x[low]), chances(tree.high, x[~low])
    return out


def train(pages: tuple = LABELLED) -> Split | float:
    """The tree of the labelled pages."""
    xs, ys = [], []
    for page in pages:
        marked = flat_blocks(page)
        y = [b.text.startswith(MARK) for b in marked]
        for b in marked:
            b.text = b.text.removeprefix(MARK)
        xs.append(features(marked))
        ys.append(np.array(y, dtype=float))
    return grow(np.vstack(xs), np.concatenate(ys))


def main_text(page: str, tree: Split | float) -> str:
    blocks = flat_blocks(page)
    keep = chances(tree, features(blocks)) > 0.5
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extracted(pages: DataFrame, tree: Split | float | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    A null or empty page, and one without main text, has an empty text. Each page is
    read whole, by itself; repeated rows give equal results. Null ids and addresses
    stay null. An empty table gives an empty result.
    """
    tree = train() if tree is None else tree

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch["h"].tolist()]
            yield pd.DataFrame({"page_id": batch["p"].astype("Int64"), "url": batch["u"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(page_id).cast("long").alias("p"), F.col(url).alias("u"), text_or_empty(F.col(html)).alias("h"))
    return rows.mapInPandas(read, "page_id bigint, url string, text string, n_chars bigint")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))


QUERIES = {"op3_main_text": op3_main_text}
