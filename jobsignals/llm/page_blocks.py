"""Blocks of text of one HTML page, each with the style path of the element that holds it."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

from xxhash import xxh3_64_intdigest

TAG = re.compile(r"""<!--.*?(?:-->|\Z) | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>
                     | <(/?)([a-zA-Z][^\s/>]*)([^>]*)> | <[!?/][^>]*>""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; all of it but a title's is never text of the page.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol
p pre section summary table tbody td tfoot th thead tr ul""".split())
#: Elements that are never part of an article, and those that are one only if nothing else is there.
NEVER = frozenset("""nav footer aside select option input object svg canvas template head map audio
video""".split())
SELDOM = frozenset("button label dialog menu".split())
NEVER_ROLES = frozenset("navigation contentinfo complementary".split())
SELDOM_ROLES = frozenset("banner search form dialog alert".split())
#: Elements that hold a small form, or a whole page.
HINTED_TAGS = frozenset("form fieldset".split())
#: Words of a class or id that hint at what is no article.
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo
promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe signup login share sharing social sidebar widget widgets menu nav navbar navigation
breadcrumb breadcrumbs pagination pager related recommended comment comments commentlist disqus
reply replies respond footer header masthead toolbar search""".split())
NEVER_HINTED = frozenset("html body main".split())
#: What an opening tag closes if it is open with nothing but inline elements above it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    """Text of a block, its node and the node above in the style tree."""

    node: int
    parent: int
    text: str
    noise: int       # 2 inside an element that is never part of an article, 1 seldom
    article: int     # number of the outermost article around it, or 0
    main: bool
    linked: int      # characters inside links
    hint: int        # 2 if a whole class or id says that it is no article, 1 for a part of one


@lru_cache(maxsize=50_000)
def step(parent: int, label: str) -> int:
    """A place in the style tree as a signed 64-bit number: the path so far and one element."""
    h = xxh3_64_intdigest(f"{parent}/{label}")
    return h - (1 << 64) if h >> 63 else h


@lru_cache(maxsize=20_000)
def look(tag: str, raw: str) -> tuple[str, int, int]:
    """The label of an element (tag and classes), its noise and its hint, as in Block."""
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    names = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    words = {w for n in names for w in re.split(r"[-_\d]+", n)}
    role = found.get("role", "").lower()
    noise = (2 if tag in NEVER or role in NEVER_ROLES or "hidden" in found
             or found.get("aria-hidden", "").lower() == "true"
             or "display:none" in found.get("style", "").replace(" ", "").lower()
             else int(tag in SELDOM or role in SELDOM_ROLES))
    hint = (0 if tag in NEVER_HINTED else 2 if tag in HINTED_TAGS or not HINTS.isdisjoint(names)
            else int(bool(words & HINTS)))
    return ".".join([tag, *sorted(set(found.get("class", "").lower().split()))]), noise, hint


def settle_hints(found: list[Block], branches: list[tuple[int, int, int]]) -> None:
    """Turn the blocks' branch numbers into hints that hold.

    A branch (branch above, hint, article) is believed if it has at most half the text of its
    article, or else of the page, and only while all that would go leaves half of that text.
    """
    levels = [0] * len(branches)
    for inner in (False, True):
        scope = [b for b in found if not b.noise and levels[b.hint] < 2 and (b.article or not inner)]
        total, gone, held = Counter(), Counter(), [0] * len(branches)
        for b in scope:
            total[inner and b.article] += len(b.text)
            held[b.hint] += len(b.text)
        for n in range(len(branches) - 1, 0, -1):
            held[branches[n][0]] += held[n]
        new = levels[:]
        for n, (above, hint, article) in enumerate(branches[1:], 1):
            own = hint if bool(article) == inner and 2 * held[n] <= total[article] else 0
            new[n] = max(new[above], levels[n], own)
        for b in scope:
            gone[inner and b.article] += len(b.text) * (new[b.hint] == 2)
        for n, (_, _, article) in enumerate(branches):
            scope_of = inner and article
            if 2 * gone[scope_of] > total[scope_of]:
                new[n] = max(levels[n], min(new[n], 1))
        levels = new
    for b in found:
        b.hint = levels[b.hint]


def blocks(page: str) -> tuple[list[Block], dict[int, set[str]]]:
    """The blocks of a page in order, and for every container its children's labels."""
    out: list[Block] = []
    children: dict[int, list[str]] = {}
    # Open elements: tag, node, node above, noise, article, in main, in a link, hinted branch.
    stack = [("", 0, 0, 0, 0, False, False, 0)]
    branches = [(0, 0, 0)]
    articles = 0
    open_tags: dict[str, int] = {}
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = "".join(text).split()
            if words:
                # The innermost block element holds the text.
                k = len(stack) - 1
                while k and stack[k][0] not in BLOCKS:
                    k -= 1
                top = stack[k]
                out.append(Block(top[1], top[2], " ".join(words),
                                 max(stack[-1][3], top[3]), top[4], top[5], linked,
                                 stack[-1][7]))
            text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        raw = html.unescape(raw) if "&" in raw else raw
        text.append(raw)
        if stack[-1][6]:
            linked += len(raw)

    def close(k: int) -> None:
        """Close open elements from the top down to place k."""
        while len(stack) > k:
            if stack[-1][0] in BLOCKS or stack[-1][3::4] != stack[-2][3::4]:
                flush()
            open_tags[stack[-1][0]] -= 1
            stack.pop()

    def close_open(names: set[str]) -> None:
        k = len(stack) - 1
        while k and stack[k][0] not in names and (
                stack[k][0] not in BLOCKS or stack[k][0] in ("td", "th") and "tr" in names):
            k -= 1
        if k and stack[k][0] in names:
            close(k)

    at = 0
    while m := TAG.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if open_tags.get(tag):
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
            elif tag == "p":
                flush()
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            if open_tags.get("p"):
                close_open({"p"})
            if tag in CLOSES:
                close_open(CLOSES[tag])
            flush()
        if tag in VOID:
            continue
        _, node, above, noise, article, main, link, branch = stack[-1]
        label, bad, hint = look(tag, attributes)
        # A header inside an article is the article's own.
        bad = max(bad, int(tag == "header" and not article))
        if (bad > noise or hint) and tag not in BLOCKS:
            flush()
        if hint:
            branches.append((branch, hint, article))
            branch = len(branches) - 1
        if tag == "article" and not bad and not article:
            article = articles = articles + 1
        if tag in BLOCKS:
            children.setdefault(node, []).append(label)
            node, above = step(node, label), node
        stack.append((tag, node, above, max(noise, bad), article, main or tag == "main",
                      link or tag == "a", branch))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    add(page[at:])
    flush()
    settle_hints(out, branches)
    return out, {k: set(v) for k, v in children.items()}


def main_blocks(page: str, low: frozenset[int]) -> list[Block]:
    """The blocks left without noise and low-importance nodes; of an article if there is one."""
    every = blocks(page)[0]
    found = [b for b in every if not b.noise and b.hint < 2]
    for inside in (lambda b: b.article, lambda b: b.main):
        if some := [b for b in found if inside(b)]:
            found = some
            break
    else:
        # Without anything else, links and seldom elements are the page's text.
        found = ([b for b in found if 2 * b.linked <= len(b.text)] or found
                 or [b for b in every if b.noise < 2])
    # A page that would lose everything is one that its host repeats; it keeps its text.
    return [b for b in found if b.node not in low] or found
