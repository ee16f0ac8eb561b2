"""Main text of web pages by a maximum-scoring subsequence (operator 2).

A page is a row of words and tags. Words score positive and tags negative, with weights that are log-odds of lying in
the main text, learned from labelled pages: tags by their name; words by whether they stand in a link; and words in an
element whose role (its tag, or a whole name in its class, id or role) lies outside the main text in the labelled pages
score negative as well. No list of names is built in: a name counts for what the labelled pages say of it. One linear
scan finds the contiguous region with the highest sum. A region inside an article or main element grows to its edges,
so a last short paragraph behind an advert isn't lost. The text is what the region holds, without the words that score
negative themselves (the advert).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import accumulate
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, texts_of

RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "xmp")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that by the standard tell the role of what they hold; what a role is worth is learned.
ROLE_TAGS = frozenset("head nav header footer aside form fieldset button select datalist dialog menu svg canvas object template figcaption address".split())
#: Where content may begin again after an element that is never closed.
STARTS = frozenset("article main section footer h1 h2 h3 p".split())
#: A closed element with so large a share of a page's words is no boilerplate, whatever its name says.
WHOLE = 0.8
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
#: In a tag: the quote that opens a value, or the end.
_MARK = re.compile(r"""=\s*(["'])|>""")
_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")


def _tag_end(page: str, at: int, known: dict[int, int]) -> int:
    """Where a tag ends whose attributes begin there: a > in a quoted value doesn't end it. -1 if a value is never
    closed. known keeps the answers by the places of the quotes, so all tags of a page take linear time."""
    passed, end = [], -1
    while m := _MARK.search(page, at):
        if m[0] == ">":
            end = m.start()
            break
        if m.start() in known:
            end = known[m.start()]
            break
        passed.append(m.start())
        close = page.find(m[1], m.end())
        if close < 0:
            break
        at = close + 1
    known.update(dict.fromkeys(passed, end))
    return end


def tokens_of(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, rest): kind is open, close or text; rest is the attributes or the text as it stands. Comments,
    declarations and raw elements are left out. Linear in the page's length."""
    out, at, last, known = [], 0, page.rfind(">"), {}
    while at < len(page):
        start = page.find("<", at)
        if start < 0 or start > last:
            out.append(("text", "", page[at:]))
            break
        if start > at:
            out.append(("text", "", page[at:start]))
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
        elif page[start + 1 : start + 2] in ("!", "?"):
            at = page.find(">", start) + 1
        elif m := _TAG.match(page, start):
            end = _tag_end(page, m.end(), known)
            if end < 0:
                end = page.find(">", m.end())
            name, at = m[2].lower(), end + 1
            out.append(("close" if m[1] else "open", name, page[m.end() : end]))
            if name in RAW and not m[1] and not page[end - 1 : end] == "/":
                found = _END[name].search(page, at)
                at = len(page) if not found else found.start()
        else:
            out.append(("text", "", "<"))
            at = start + 1
    return out


def _matches(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """The closing token of each opening one that has one."""
    stacks: dict[str, list[int]] = {}
    found = {}
    for k, (kind, name, _) in enumerate(tokens):
        if kind == "open" and name not in VOID:
            stacks.setdefault(name, []).append(k)
        elif kind == "close" and stacks.get(name):
            found[stacks[name].pop()] = k
    return found


def roles_of(name: str, attributes: str, inside_article: bool) -> list[str]:
    """The roles that an element names: its tag, if that tells one, and each whole name of its class, id and role."""
    own = [f"article {name}" if inside_article else name] if name in ROLE_TAGS else []
    if "=" in attributes and name not in ("html", "body"):
        for m in _NAMES.finditer(attributes):
            own += [f".{n}" for n in next(g for g in m.groups() if g is not None).lower().split()]
    return own


def elements(tokens: list[tuple[str, str, str]], match: dict[int, int]) -> Iterator[tuple[int, int, list[str]]]:
    """(first token, the one behind the last, roles) of each element with roles."""
    after, again = [], len(tokens)
    for kind, name, _ in reversed(tokens):
        after.append(again)
        if kind == "open" and name in STARTS:
            again = len(tokens) - len(after)
    after.reverse()
    article = -1
    for k, (kind, name, rest) in enumerate(tokens):
        if kind == "open" and name not in VOID:
            own = roles_of(name, rest, k < article)
            if name == "article":
                article = max(article, match.get(k, -1))
            if own:
                yield k, match.get(k, after[k]), own  # never closed: it ends where content may begin again


def word_counts(tokens: list[tuple[str, str, str]]) -> list[int]:
    return [len(rest.split()) if kind == "text" else 0 for kind, _, rest in tokens]


def classes_of(tokens: list[tuple[str, str, str]], match: dict[int, int]) -> list[str]:
    """The class of each token: word, link (words in a link) or tag:NAME."""
    out, link = [], -1
    for k, (kind, name, _) in enumerate(tokens):
        if kind == "open" and name == "a":
            link = max(link, match.get(k, -1))
        out.append(f"tag:{name}" if kind != "text" else "link" if k < link else "word")
    return out


def log_odds(inside: Counter, outside: Counter) -> dict[str, float]:
    """Of each kind, with one pseudo-count a kind on both sides."""
    kinds = {*inside, *outside}
    total_in, total_out = sum(inside.values()) + len(kinds), sum(outside.values()) + len(kinds)
    return {c: log((inside[c] + 1) / total_in) - log((outside[c] + 1) / total_out) for c in kinds}


def train_weights(pages: Iterable[tuple[str, str]]) -> dict[str, float]:
    """Weights from labelled pages (html, main text), by class and by role. Text tokens that the main text holds are
    content, and the region goes from the first to the last of them. Words are held positive and tags negative; a role
    is only kept if it speaks clearly against content, and then as strongly as a word speaks for it at most."""
    inside, outside, role_in, role_out = Counter(), Counter(), Counter(), Counter()
    for page, content in pages:
        tokens = tokens_of(page)
        match, sizes, plain = _matches(tokens), word_counts(tokens), " ".join(content.split())
        own = [bool(n) and " ".join(html.unescape(rest).split()) in plain for n, (_, _, rest) in zip(sizes, tokens)]
        places = [k for k, mine in enumerate(own) if mine]
        low, high = (places[0], places[-1]) if places else (1, 0)
        for k, (c, n) in enumerate(zip(classes_of(tokens, match), sizes)):
            (inside if (own[k] if n else low <= k <= high) else outside)[c] += n or 1
        for start, stop, roles in elements(tokens, match):
            for k in range(start, stop):
                for r in roles if sizes[k] else ():
                    (role_in if own[k] else role_out)[f"role:{r}"] += sizes[k]
    weights = {c: max(w, 0.3) if c == "word" else min(max(w, 0.05), 1.0) if c == "link" else min(w, -0.05) for c, w in log_odds(inside, outside).items()}
    weights |= {r: max(w, -weights.get("word", 0.5)) for r, w in log_odds(role_in, role_out).items() if w < -1}
    return {"word": 0.5, "link": 0.1, "tag": -0.3} | weights


def scores_of(tokens: list[tuple[str, str, str]], match: dict[int, int], weights: dict[str, float]) -> list[float]:
    """The score of each token: a tag's weight, or a word's times the words."""
    sizes = word_counts(tokens)
    before = [0, *accumulate(sizes)]
    against, active, out = [], [], []
    for start, stop, roles in elements(tokens, match):
        found = [weights[f"role:{r}"] for r in roles if f"role:{r}" in weights]
        if found and (start not in match or before[stop] - before[start] <= WHOLE * before[-1]):
            against.append((start, stop, min(found)))
    against.reverse()  # in the order of their starts, the next one last
    fallback = weights["tag"]
    for k, (c, n) in enumerate(zip(classes_of(tokens, match), sizes)):
        while against and against[-1][0] <= k:
            _, stop, w = against.pop()
            heappush(active, (w, stop))
        while active and active[0][1] <= k:
            heappop(active)
        out.append(n * (active[0][0] if active else weights[c]) if c in ("word", "link") else weights.get(c, fallback))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, stop) of the largest sum (the first and longest of equals); empty if none is positive."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for k, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, k
        total += s
        if total > best or total == best and best and found[0] == start:
            best, found = total, (start, k + 1)
    return found


def completed(tokens: list[tuple[str, str, str]], match: dict[int, int], start: int, stop: int) -> tuple[int, int]:
    """The innermost article or main element around a region; the region itself if there is none."""
    around = [(k, end) for k, end in match.items() if tokens[k][1] in ("article", "main") and k <= start and stop <= end + 1]
    return max(around, default=(start, stop - 1))[0], max(around, default=(start, stop - 1))[1] + 1


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text: the blocks of the best region, without words that score negative."""
    tokens = tokens_of(page)
    match = _matches(tokens)
    scores = scores_of(tokens, match, weights)
    start, stop = best_region(scores)
    if start < stop:
        start, stop = completed(tokens, match, start, stop)
    blocks, block = [], []
    for (kind, name, rest), score in zip(tokens[start:stop], scores[start:stop]):
        if kind == "text":
            if score >= 0:
                block.append(html.unescape(rest))
        elif name not in INLINE and block:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    return " ".join(t for b in blocks if (t := _SPACE.sub(" ", b).strip()))


#: Names that pages give to blocks beside the main text, and to those that hold it: the vocabulary of the labelled pages.
BESIDE = (
    "ad ads advert advertisement ad-slot ad-container ad-banner adsbygoogle sponsor sponsored promo promotion banner cookie cookies cookie-notice cookie-banner cookie-consent consent gdpr notice "
    "alert sidebar side-bar menu main-menu nav navbar navigation site-nav breadcrumb breadcrumbs share sharing share-buttons social social-links comment comments comment-list comments-area "
    "comment-section reader-comments disqus disqus_thread replies respond related related-posts related-articles recommended recommendations newsletter newsletter-signup subscribe subscription "
    "signup login popup modal overlay footer site-footer page-footer header site-header page-header masthead toolbar pagination pager skip-link skip complementary contentinfo search search-form widget widgets tags "
    "tag-list author-box disclaimer copyright legal"
).split()
HOLDING = "content main-content article article-body post post-content post-body entry entry-content story story-body text page container wrapper body main".split()
_PROSE = [
    "The river had risen over night and the lower fields were under water before anyone in the village noticed it.",
    "By noon the first boats came from the town, and people carried what they could to the hill behind the church.",
    "It took eleven days until the water fell, and longer until the road could be used again.",
    "The council has since asked for a second dam, which engineers say would hold twice as much.",
]
_BESIDE = ["Buy two and get one free", "We store data on your device to improve this site", "Great read, I was there too when it happened", "Copyright and imprint, all rights reserved", "Home", "News of today", "Sign in to see more of this"]


def labelled_pages() -> Iterator[tuple[str, str]]:
    """(html, main text): a page of each of five layouts for each name of a block beside the main text: an article
    between menu and footer, plain blocks, a table, lists without names, and an article with its own header, a list, a
    table, a quotation and a block of that name between its paragraphs."""
    a, b, c, d = _PROSE
    menu = "".join(f'<li><a href="/{k}">{t}</a></li>' for k, t in enumerate(("Home", "News", "Sport", "Weather", "Archive", "Contact")))
    for k, name in enumerate(BESIDE):
        beside, holding = _BESIDE[k % len(_BESIDE)], HOLDING[k % len(HOLDING)]
        block = f'<div class="{name}"><p>{beside}</p></div>' if k % 2 else f'<section id="{name}">{beside} <a href="/more">More</a></section>'
        yield (
            f'<html><head><title>Flood</title></head><body><header><a href="/">Home</a> <p>The daily paper</p></header><nav><ul>{menu}</ul></nav>{block}'
            f"<article><h1>After the flood</h1><p>{a}</p><p>{b}</p><p>{c}</p></article><footer>Copyright and imprint <a href='/i'>Legal</a></footer></body></html>",
            f"After the flood {a} {b} {c}",
        )
        yield (
            f'<body><div class="{holding}"><h2>Dams</h2><p>{d} See <a href="x">the plan</a>.</p><p><b>{a}</b><br>{b}</p></div>{block}'
            f"<form><label>Mail</label><input><button>Send now</button><select><option>Daily</option><option>Weekly</option></select></form><aside><p>Read this next</p></aside></body>",
            f"Dams {d} See the plan . {a} {b}",
        )
        yield (
            f'<table><tr><td><a href="1">Start</a><br><a href="2">Archive</a><br><a href="3">Contact</a></td><td><b>Boats</b><br>{b}<br><br>{c}</td></tr></table><hr>{block}<a href="t">Top</a>',
            f"Boats {b} {c}",
        )
        yield (
            f'<ul><li><a href="1">Home</a><li><a href="2">About</a><li><a href="3">Jobs</a></ul><div><p>{c}<p>{d}<ul><li>{a}<li>{b}</ul></div><ul><li><a href="p">Privacy</a></ul>',
            f"{c} {d} {a} {b}",
        )
        yield (
            f'<main id="{holding}"><article><header><h1>The second dam</h1><p>Written by the editors</p></header><p>{a}</p><ol><li>{b}</li><li>{c}</li></ol>{block}'
            f"<section><h2>Heights</h2><table><tr><th>Year</th><th>Water</th></tr><tr><td>1954</td><td>twelve feet above the bridge</td></tr><tr><td>1988</td><td>nine feet, as <a href='r'>the records</a> say"
            f"</td></tr></table></section><div><blockquote><p>{d}</p></blockquote></div><figure><figcaption>The hill</figcaption></figure><footer>Filed under flooding</footer></article></main><nav><a href='2'>Next page</a></nav>",
            f"The second dam Written by the editors {a} {b} {c} Heights Year Water 1954 twelve feet above the bridge 1988 nine feet, as the records say {d} The hill",
        )


def extract_pages(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each row, without a shuffle. weights: train_weights() of labelled pages of
    one's own. A null or empty page, and one without any content, has the empty text; null ids and addresses stay;
    repeated rows give a row each; other columns go."""
    weights = weights or train_weights(labelled_pages())
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col))

    def run(batches):
        for b in batches:
            yield {id_col: b.column(0), url_col: b.column(1), "text": [extract(p, weights) for p in texts_of(b.column(2))]}

    return map_batches(pages.select(id_col, url_col, html_col), run, f"{kinds}, text string").withColumn("n_chars", F.length("text").cast("long"))
