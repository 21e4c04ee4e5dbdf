"""Main text of web pages: flat text blocks and a decision tree over shallow features.

A page is cut into blocks at block-level tags. A block's features are its words, links and link density, the words and link
density of its neighbours, whether it is a heading, the title or a list item, whether main text follows, and what its enclosing elements
say (article or main; elements or class and id words of menus, notices, adverts, forms, comments and the like). A decision tree (Spark
ML) is trained on the blocks of a small labelled table (``EXAMPLES``; ``PLAIN_EXAMPLES``, whose elements say nothing; ``MARKED_EXAMPLES``,
``TEXT_EXAMPLES`` and ``BOX_EXAMPLES``)
and decides which blocks are main text. Where a page marks no main text, lengths, links and neighbours decide. Scripts, styles and other elements without prose are no blocks at all.

Class, id and role attributes are judged by whole names (``_verdict``): a name counts if its words are all of furniture or of
layout (``cookie-notice``, ``post-tags``), or if it ends in a word of furniture (``acme-sidebar``), but not if it tells a state or a
topic (``comments-open``, ``has-sidebar``, ``tag-cookies``, ``related-work``). What ``html`` and ``body`` are named, and the ids of headings, count for nothing;
inside main text neither do headers nor ids of sections that may be topics; a discussion is one of readers only if comments or a form are in it.

Character references are decoded, white space inside a block becomes one space, blocks are joined by a newline.

Cases: a null or empty page has the text ''; broken markup is read as far as it goes (unclosed elements end with
the page, but of an unclosed element without prose only the tag is left out unless it is raw text; a head without end tag ends where
its elements end; stray end tags are skipped); repeated rows and null urls are kept; an empty table gives no rows; columns beside
those named are ignored.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.llm.common import sliced, table

#: elements whose content is raw text and no prose: an unclosed one runs to the page's end
_RAW = "script|style|textarea|title"
#: other elements whose content is no prose, if they are closed; of an unclosed one only the tag itself is skipped
_SKIPPED = frozenset("noscript template iframe object svg math canvas select datalist audio video map".split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<title(?=[\s>/])[^>]*>[^<]*(?=</svg\s*>)|<({_RAW})(?=[\s>/])[^>]*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>|<[/!?a-zA-Z][^<>]*(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+", re.I)

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_CONTAINERS = frozenset("address article aside body center details dialog div dl fieldset figure footer form header hgroup html main menu nav ol section table tbody td tfoot th thead tr ul".split())
_FURNITURE = frozenset("nav footer aside form menu dialog button fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# words of class, id and role attributes
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login register search sidebar widget widgets related recommended recommendations trending popular nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs pagination pager masthead topbar toolbar header footer foot copyright legal share sharing social tags contentinfo complementary form paywall outbrain taboola rail".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion reviews reactions".split())
_MAIN_WORDS = frozenset("article main content post entry story".split())
# comments only if what is inside is built like comments, and words that say so
_TALK_WORDS = frozenset("discussion reviews reactions".split())
_BUILT_WORDS = frozenset("comment comments commenter commentlist reply replies review reviewer avatar upvote thread".split())
_TALK_PARTS = _BUILT_WORDS | {"board", "forum", "list"}
# words that say nothing beside one of furniture or comments
_LAYOUT_WORDS = frozenset(
    "article articles author bar block blog body bottom box button buttons container content count data entry fixed global group holder icon icons inner item items js left link links list main meta "
    "mobile module nav outer panel post posts primary right row secondary section site sticky stories story text thread title top unit user users wrap wrapper area".split())
# first words of names that tell a state or a topic of the page
_STATE_WORDS = frozenset("no not non has have with without is hide show tag category cat term format type status topic".split())
# furniture if a name ends in them (acme-footer)
_LAST_WORDS = _FURNITURE_WORDS - frozenset("header related recommended trending popular legal alert rail foot complementary sponsored promoted".split())
_LAST_COMMENT_WORDS = frozenset("comment comments commentlist disqus replies".split())
# furniture words that are as well the topic of a section
_TOPIC_WORDS = frozenset("search legal notice alert form register navigation menu copyright popular trending recommendations sharing promotion advertising banner cookie cookies".split())

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "in_main", "furniture", "comments", "heading", "item", "page_has_main", "links", "title", "main_after")


@lru_cache(1 << 16)
def _verdict(name: str) -> str:
    """What one name (of a class, id or role attribute) says: 'furniture', 'ends' (furniture by its last word), 'topic' (furniture, or a topic in
    an id), 'header', 'headline' (the header of a text), 'comments', 'talk' (comments if built so), 'main' or ''."""
    parts = [w for w in _PARTS.findall(name.lower()) if len(w) > 1]
    if not parts or parts[0] in _STATE_WORDS:
        return ""
    have = set(parts)
    rest = have - _FURNITURE_WORDS - _COMMENT_WORDS - _LAYOUT_WORDS
    if "header" in have and (have & _MAIN_WORDS - {"main"}):
        return "headline"
    if have & (_COMMENT_WORDS - _TALK_WORDS) and not rest or parts[-1] in _LAST_COMMENT_WORDS:
        return "comments"
    if have & _TALK_WORDS and not rest - _TALK_PARTS:
        return "comments" if have & _TALK_PARTS else "talk"
    found = have & _FURNITURE_WORDS
    if found and not rest:
        return "header" if found == {"header"} else "topic" if found <= _TOPIC_WORDS else "furniture"
    last = next((w for w in reversed(parts) if w in _FURNITURE_WORDS or w not in _LAYOUT_WORDS), "")
    if last == "header":
        return "header"
    if last in _LAST_WORDS:
        return "ends"
    return "main" if have & _MAIN_WORDS else ""


def _marks(element: str, attributes: str, inner: bool) -> set[str]:
    """The verdicts on an element's names that count; ``inner``: it is inside main text."""
    out: set[str] = set()
    if not attributes or element in ("html", "body"):
        return out
    named = [(m[1].lower(), (m[2] or m[3] or m[4] or "").split()) for m in _NAMED.finditer(attributes)]
    heading = element in _HEADINGS
    anchor = inner and (element not in _CONTAINERS or element == "section" or any(k == "class" and "section" in names for k, names in named))
    for kind, names in named:
        if kind == "id" and heading:
            continue
        for verdict in map(_verdict, names):
            if kind == "id" and anchor and verdict in ("topic", "ends") or verdict == "header" and (inner or heading):
                continue
            out.add("furniture" if verdict in ("topic", "ends", "header") else verdict)
    return out


def _closed(tokens: list[re.Match]) -> dict[int, int]:
    """Per start tag of a ``_SKIPPED`` element the place of its end tag, if it has one."""
    waiting: dict[str, list[int]] = {}
    out = {}
    for i, m in enumerate(tokens):
        name = m[3].lower() if m[3] else None
        if name in _SKIPPED:
            if not m[2]:
                if not m[4].endswith("/"):
                    waiting.setdefault(name, []).append(i)
            elif waiting.get(name):
                out[waiting[name].pop()] = i
    return out


def _built(attributes: str) -> bool:
    """Whether an element's names are those of a reader's comment or review."""
    return any(m[1].lower() == "class" and not _BUILT_WORDS.isdisjoint(_PARTS.findall((m[2] or m[3] or m[4] or "").lower())) for m in _NAMED.finditer(attributes))


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """A page's non-empty blocks and their features."""
    texts, rows = [], []
    # open containers with what holds inside them: in main text, in furniture, in comments, any furniture or comments
    # around, and the outermost talk (a list whose one value says whether it is built like comments)
    outside: tuple[str, bool, bool, bool, bool, list | None] = ("", False, False, False, False, None)
    stack = [outside]
    opened: dict[str, list[int]] = {}  # per element the places of its open ones in the stack
    talks: list[tuple[int, list]] = []  # block, the outermost talk around it
    plain, linked, links, link, heading, title, item, own = [], 0, 0, 0, False, False, False, (False, False)
    has_main = False

    def close():
        nonlocal plain, linked, links
        if plain:
            text = " ".join("".join(plain).split())
            if text:
                _, main, furniture, comments, _, talk = stack[-1]
                n = text.count(" ") + 1
                if talk is not None:
                    talks.append((len(texts), talk))
                texts.append(text)
                rows.append((n, min(1.0, linked / n), 0, 0, 0, 0, main, furniture or own[0], comments or own[1], heading, item, 0, links, title, 0))
        plain, linked, links = [], 0, 0

    def text(raw: str):
        nonlocal linked
        if raw:
            if "&" in raw:
                raw = html.unescape(raw)
            plain.append(raw)
            if link:
                linked += len(raw.split())

    at, over, choice = 0, -1, False  # over: tokens up to this one are inside a skipped element; choice: the text is an option's
    tokens = list(_TOKEN.finditer(page))
    ends = _closed(tokens)
    for i, m in enumerate(tokens):
        if i <= over:
            at = m.end()
            continue
        if m.start() > at and not choice:
            text(page[at:m.start()])
        at = m.end()
        end, name, attributes = m[2], m[3], m[4]
        if name is None:
            if m[1] is not None and m[1].lower() != "title":
                plain.append(" ")
            elif m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        choice = not end and name in ("option", "optgroup")
        if name in _SKIPPED:
            plain.append(" ")
            over = ends.get(i, over) if not end else over
            continue
        if name == "a":
            link = 0 if end else 1
            links += link
            continue
        if name in _INLINE:
            if name in ("br", "img", "wbr"):
                plain.append(" " if name != "wbr" else "")
            continue
        close()
        own = (False, False)
        if name in _CONTAINERS:
            heading = title = item = False
            if end:
                if opened.get(name):
                    first = opened[name][-1]
                    for gone in reversed(stack[first:]):
                        opened[gone[0]].pop()
                    del stack[first:]
            elif not attributes.endswith("/"):
                _, inner, inside, talked, beside, talk = stack[-1]
                marks = _marks(name, attributes, inner)
                if talk is not None and (name in ("form", "article") or "comments" in marks or _built(attributes)):
                    talk[0] = True
                comments = "comments" in marks
                furniture = (name in _FURNITURE or (name == "header" and not inner and "headline" not in marks) or "furniture" in marks
                             or bool(attributes and name not in ("html", "body") and _HIDDEN.search(attributes)))
                main = name in ("article", "main") or bool(marks & {"main", "headline"}) and not (furniture or comments) and name in ("div", "section", "td", "header")
                main = main and not comments
                has_main |= main
                if main and name not in ("article", "main"):
                    main = not beside  # a named box inside a menu stays in the menu
                if main:
                    furniture = False
                if talk is None and "talk" in marks and not comments:
                    talk = [False]
                opened.setdefault(name, []).append(len(stack))
                stack.append((name, inner or main, not main and inside or furniture, talked or comments, beside or furniture or comments, talk))
        else:
            heading, title, item = not end and name in _HEADINGS, not end and name == "h1", not end and name in ("li", "dt", "dd", "option")
            if not end and attributes:
                marks = _marks(name, attributes, stack[-1][1])
                if stack[-1][5] is not None and ("comments" in marks or _built(attributes)):
                    stack[-1][5][0] = True
                own = ("furniture" in marks or name in _FURNITURE or bool(_HIDDEN.search(attributes)), "comments" in marks)
            elif not end and name in _FURNITURE:
                own = (True, False)
    if not choice:
        text(page[at:])
    close()
    table_ = np.array(rows, float).reshape(-1, len(FEATURES))
    table_[1:, 2:4], table_[:-1, 4:6] = table_[:-1, :2], table_[1:, :2]
    table_[:, 11] = has_main
    table_[[i for i, built in talks if built[0]], 8] = 1
    table_[:-1, 14] = (table_[1:, 6] == 1) & (table_[1:, 7] == 0) & (table_[1:, 8] == 0)
    return texts, table_


def _say(n: int) -> str:
    """A sentence of ``n`` words."""
    w = f"{_LONG} {_MORE}".split()
    return " ".join(w[i % len(w)] for i in range(n))


def _bar(n: int, words: int = 1) -> str:
    """A bar of ``n`` links of so many words or up to two more."""
    return " ".join(f"<a href=/{i}>{'-' if i == 0 else ''}{_say(words + i % 3)}</a>" for i in range(n))


# The labelled table: pages cut into blocks, '+' before a block of main text and '-' before any other.
_LONG = "the long winter kept the harbour closed and most of the boats stayed on land until the ice broke in early spring"
_MORE = "people of the town remember the year well because every house had to take in travellers who could not go on"
EXAMPLES = (
    f"<body><header><div>-The Daily Page</div><nav><ul><li><a href=/>-Home</a><li><a href=/n>-News</a><li><a href=/s>-Sport and culture</a></ul></nav></header>"
    f"<article><h1>+Winter at the harbour</h1><p>+{_LONG}.<p>+{_MORE}.<p>+So it ended.<h2>+Spring</h2><p>+{_LONG} <a href=/x>and more</a>.<ul><li>+ice</li><li>+snow</li></ul></article>"
    f"<aside><h3>-Most read</h3><ul><li><a href=/1>-A day in the hills</a><li><a href=/2>-What the sea gives back every year</a></ul></aside>"
    f"<div class=ad>-Buy two coats today and get the third one free of charge.</div><footer>-&copy; The Daily Page, all rights reserved</footer></body>",
    f"<body><div class='ad'>-Our best offer of the week, only for you and only today.</div><article><h1>+A short note</h1><p>+Yes.</p><p>+{_MORE}.</p><blockquote>+{_LONG}</blockquote></article>"
    f"<section id=comments><h2>-Two comments</h2><article><p>-I was there in that winter and I can tell you it was much colder than you write here.</p></article><div class=comment>-Nice read, thank you for this.</div></section>"
    f"<footer><p>-{_LONG}</p></footer></body>",
    f"<body><div id=topbar><a href=/>-Start</a></div><div class=cookie-notice><p>-We use cookies to make this site work and to learn what our readers like most. {_MORE}</p><button>-Accept</button></div>"
    f"<main><div class=content><h2>+How to bake bread</h2><p>+{_LONG}. {_MORE}.</p><table><tr><td>+flour</td><td>+two cups of it</td></tr></table><p>+Done.</p>"
    f"<div class=share><a href=/f>-Share this page</a></div><form><label>-Your address</label><p>-Sign up for our weekly letter and never miss a story again.</p></form></div></main><div class=footer>-Imprint and contact</div></body>",
    f"<body><ul class=menu><li><a href=/a>-Products</a><li><a href=/b>-Prices</a></ul><div><p>+{_LONG}.</p><p>+{_MORE}. {_LONG}.</p><p>+{_LONG}, {_MORE}.</p></div>"
    f"<div><a href=/c>-More about us</a> <a href=/d>Jobs</a></div><div class=sidebar><p>-{_MORE}</p></div></body>",
    f"<body><p><a href=/q>-Back to the list</a></p><h1>+Of old boats</h1><p>+{_MORE}. {_MORE}.</p><p>+{_LONG}.</p><p>+{_LONG} {_LONG}</p><ul><li><a href=/5>-Next story</a><li><a href=/6>-Previous story</a></ul></body>",
    f"<body><nav><p>-{_LONG}</p></nav><article><header><h1>+A title in a head</h1></header><p>+{_LONG}.</p><aside><p>-{_MORE} and you can read it all in our book.</p></aside><p>+{_MORE}.</p><footer>-Filed under boats</footer></article>"
    f"<div class='related widget'><h3>-Read also</h3><p>-{_MORE}</p></div><form><p>-{_LONG}</p></form></body>",
    f"<body><p>-Log in</p><div><p>-Page 3 of 9</p></div><article><p>+One.</p><p>+Two words.</p><p>+<a href=/r>A linked line of main text</a></p></article><p>-{_LONG}</p><p>-{_MORE}</p><p>-All rights reserved</p></body>",
    f"<body><div class='post entry'><p>+{_MORE}</p><p>+Short one.</p></div><div id=respond><p>-{_LONG} {_MORE}</p></div><div><p>-{_MORE} {_LONG}</p></div></body>",
    f"<body class='single comments-open has-sidebar'><header class=site-header><p>-{_MORE}</p></header><article class='post tag-cookies'><header class=entry-header><h1>+Harbour towns</h1></header><div class=entry-content><p>+{_LONG}.</p>"
    f"<section id=related-work><h2 id=search-results>+What was found</h2><p>+{_MORE}.</p></section><section id=discussion><h2 id=discussion-1>+Discussion</h2><p>+{_LONG}.</p></section></div><footer class=entry-footer>-Filed under winter</footer></article>"
    f"<section class=discussion><h3>-What readers say</h3><div class=comment-body><p>-{_MORE}</p></div></section><div class=acme-sidebar><p>-{_LONG}</p></div></body>",
    f"<body class=comments-open><div class=page><h1 class=page-header>+Old roads</h1><p>+{_MORE}.</p><p>+{_LONG}. {_MORE}.</p></div><div id=comments><p>-{_LONG}</p></div></body>",
)


# Pages whose elements say nothing: only lengths, links and neighbours tell main text from the rest.
_LENGTHS = (1, 3, 6, 10, 15, 24, 40, 90)
PLAIN_EXAMPLES = (
    "<p>+Short story.</p><p>+It ends.</p>", "<p>+One line only</p>", "<div>+A note</div><div>+and more of it, in a few words</div><div>+The end</div>",
    # a bar of links, a text of paragraphs of every length, another bar and a line without links below it
    *[f"<div>{_bar(k)}</div><h1>+{_say(4)}</h1><p>+{_say(n)}.</p><p>+{_say(30)}.</p><p>+{_say(n)}</p><div>{_bar(k + 1)}</div><p>-{_say(4)}</p>" for k, n in zip((2, 3, 5, 8, 2, 4, 6, 3), _LENGTHS)],
    # the text ends the page
    *[f"<table><tr><td><a href=/>-{_say(1)}</a><td><a href=/n>-{_say(2)}</a></table><p>+{_say(60)}.</p><p>+{_say(n)}.</p>" for n in _LENGTHS],
    # a label between lists of links, a list of teasers, then the text
    *[f"<ul><li><a href=/a>-{_say(2)}</a><li><a href=/b>-{_say(n)}</a></ul><p>-{_say(3)}</p><ul><li><a href=/c>-{_say(3)}</a></ul>"
      f"<div><h3><a href=/t>-{_say(5)}</a></h3><p>-{_say(5 + n % 8)}</p><p><a href=/t>-{_say(2)}</a></p></div><h2>+{_say(3)}</h2><p>+{_say(45)}</p><p>+{_say(n)}</p><p>+{_say(20)}</p>" for n in _LENGTHS[:6]],
    *[f"<p>+{_say(50)}</p><div><h3><a href=/t>-{_say(4)}</a></h3><p>-{_say(n)}</p><h3><a href=/u>-{_say(6)}</a></h3><p>-{_say(n + 3)}</p><p><a href=/u>-{_say(2)}</a></p></div>" for n in (4, 7, 10, 12)],
    # long paragraphs stand between links as well, and hold some
    *[f"<p><a href=/p>-{_say(3)}</a></p><p>+{_say(n)} <a href=/x>{_say(n // 5)}</a></p><p><a href=/q>-{_say(4)}</a></p><p>+{_say(n + 9)}.</p>" for n in (30, 45, 80)],
)
_PAIRS = tuple((n, m) for i, n in enumerate(_LENGTHS) for m in (_LENGTHS[-1 - i], _LENGTHS[(3 * i + 1) % 8], n))
# Pages with main text marked: bars of links in it, its headline before it, and what stands beside it.
MARKED_EXAMPLES = (
    *[f"<article><h1>+{_say(5)}</h1><div>{_bar(k, w)}</div><p>+{_say(n)}</p><p>+{_say(3)} <a href=/l>{_say(4)}</a> and <a href=/m>{_say(2)}</a> too</p><div>{_bar(k + 1, w)}</div></article><p>-{_say(n)}</p>"
      for w in (1, 2, 3) for k, n in zip((2, 3, 5, 8, 2, 3, 4, 12), _LENGTHS)],
    *[f"<main><p>+{_say(m)}</p><ul><li>+<a href=/r>{_say(n)}</a><li>+<a href=/s>{_say(m)}</a></ul><p>+<a href=/w>{_say(n)}</a></p><p>+{_say(m)}</p><p>+<a href=/y>{_say(n)}</a></p></main>" for n, m in _PAIRS],
    *[f"<article><p>+<a href=/w>{_say(n)}</a> <a href=/v>{_say(n)}</a></p><p>+{_say(n)}</p></article>" for n in (24, 40)],
    *[f"<h1>+{_say(n)}</h1><article><p>+{_say(m)}</p><p>+{_say(n)}</p></article><h1>-{_say(n)}</h1><p>-{_say(m)}</p>" for n, m in _PAIRS if n < 20],
    *[f"<p>-{_say(m)}</p><h1>+{_say(n)}</h1><article><p>+{_say(m)}</p></article><p>-{_say(m)}</p><h1>-{_say(n)}</h1>" for n, m in _PAIRS if n < 20],
    *[f"<p>-{_say(m)}</p><{e}>-{_say(n)}</{e}><main><p>+{_say(m)}</p></main><{e}>-{_say(n)}</{e}><p>-{_say(m)}</p>" for e in ("h2", "h4", "p") for n, m in _PAIRS],
    *[f"<header><h1>-{_say(n)}</h1><p>-{_say(m)}</p></header><article><p>+{_say(m)}</p><p>+{_say(n)}</p></article>" for n, m in _PAIRS],
)
# Texts of any shape without marks or with them: short lines, headings, items, paragraphs with many links.
TEXT_EXAMPLES = tuple(
    f"{start}<{e}>+{_say(n)}</{e}><p>+{_say(m)}</p><ul><li>+{_say(n)}</li><li>+{_say(m)}</li></ul><p>+{_say(3 + n)} {_bar(k).replace('>-', '>')}</p><p>+{_say(8 * k + m)} {_bar(2 * k).replace('>-', '>')}</p><{e}>+{_say(m)}</{e}>{end}"
    for start, end in (("", ""), ("<div>", "</div>"), ("<article>", "</article>")) for e in ("h2", "p") for k in (1, 2, 4, 7) for n, m in _PAIRS if n > 3 * k - 3)
# Boxes of furniture and of comments, with pages of main text marked or not.
BOX_EXAMPLES = tuple(
    f"{before}<p>-{_say(n)}</p><p>-{_say(m)}</p>{behind}{start}<p>+{_say(40)}</p><p>+{_say(m)}</p>{end}{before}<h3>-{_say(2)}</h3><p>-{_say(m)}</p>{behind}"
    for before, behind in (("<div class=sidebar>", "</div>"), ("<nav>", "</nav>"), ("<div id=comments>", "</div>"))
    for start, end in (("<div>", "</div>"), ("<article>", "</article>")) for n, m in _PAIRS[::2])


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in EXAMPLES + PLAIN_EXAMPLES + MARKED_EXAMPLES + TEXT_EXAMPLES + BOX_EXAMPLES:
        texts, features = blocks(page)
        rows.append(features)
        labels += [t[0] == "+" for t in texts]
    return np.concatenate(rows), np.array(labels)


def train(spark: SparkSession, depth: int = 8) -> tuple:
    """A Spark ML decision tree over the labelled blocks, as nested ``(feature, threshold, left, right)`` or a bool."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors
    rows, labels = labelled_blocks()
    data = spark.createDataFrame([(Vectors.dense(r.tolist()), float(y)) for r, y in zip(rows, labels)], ["features", "label"]).coalesce(1)
    fitted = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=1).fit(data)

    def walk(node):
        if node.numDescendants() == 0:
            return node.prediction() == 1.0
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return walk(fitted._java_obj.rootNode())


def decide(tree, rows: np.ndarray) -> np.ndarray:
    """The tree's answer for every row."""
    if isinstance(tree, bool):
        return np.full(len(rows), tree)
    feature, threshold, left, right = tree
    low = rows[:, feature] <= threshold
    out = np.empty(len(rows), bool)
    out[low], out[~low] = decide(left, rows[low]), decide(right, rows[~low])
    return out


def extract(df: DataFrame, id_col: str, url_col: str, html_col: str, tree=None) -> DataFrame:
    """``id, url, text`` of every page; ``tree`` as :func:`train` gives it."""
    tree = train(df.sparkSession) if tree is None else tree
    spec = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for b in sliced(batches, "html"):
            found = [blocks(p) if p else ([], np.zeros((0, len(FEATURES)))) for p in b.column("html").to_pylist()]
            main = decide(tree, np.concatenate([f for _, f in found]))
            texts, at = [], 0
            for parts, _ in found:
                texts.append("\n".join(t for t, keep in zip(parts, main[at:at + len(parts)]) if keep))
                at += len(parts)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    return spec.mapInArrow(run, spec.drop("html").schema.add("text", "string"))


def op2_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
