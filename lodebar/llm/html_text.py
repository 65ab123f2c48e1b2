"""A page's blocks of text with the elements around them: a tolerant reader of HTML, for one page at a time."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass

#: What an element is by its meaning. Nothing in NOISE is read. DOUBT is what only a word of a class or id calls noise, FORM
#: is in a form, and REGAINED is an article inside of either.
NEUTRAL, MAIN, NOISE, DOUBT, FORM, REGAINED = range(6)

# Element names of the HTML standard by what they mean here, and words that classes and ids use for parts
# of a page.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " math menclose mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg object canvas audio video".split())
_NOISE_NAMES = frozenset("nav footer aside menu dialog button select optgroup option datalist head map annotation annotation-xml".split()) | _RAW
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies"
    " copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay"
    " pager pagination popup promo promoted promotion recommended related replies reply respond search share sharebar sharing sidebar signup skip"
    " social sponsor sponsored subscribe toolbar topbar widget".split()
)
# Noise even around an article: readers' articles.
_COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
# A name with one of these says what the page has, not what the element is: has-sidebar, comment-open.
_STATE_WORDS = frozenset("closed disabled enabled has no off on open with without".split())
_MAIN_WORDS = frozenset("article articlebody content entry main maincontent post story storybody".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_CLOSES_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_ITEM = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>?|<[a-zA-Z][^>]*\Z""")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"']+)""")
_WORDS = re.compile(r"[A-Za-z]+")


def hashed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little", signed=True)


@dataclass(frozen=True, eq=False)
class Element:
    """An open element: ``path`` stands for it and all around it; ``parent`` is the element around it."""

    name: str
    path: int
    label: int
    block: bool
    inside: bool = False  # of a main element, or one itself
    parent: Element | None = None


ROOT = Element("", 0, NEUTRAL, True)


def _words(value: str) -> list[str]:
    split = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
    return [w.lower() for w in _WORDS.findall(split)]


def _opened(parent: Element, name: str, attributes: str) -> Element:
    found = {m[1].lower() if m[1] else m[5].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip(" /") else {}
    marks = _words(found.get("class", "") + " " + found.get("id", ""))
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    # a heading's id inside an article is made from what it says: related-work, sharing
    own_names = found.get("class", "") if name in _HEADINGS and parent.label in (MAIN, REGAINED) else found.get("class", "") + " " + found.get("id", "")
    named = [set(_words(n)) for n in own_names.split()]
    own = set().union(*(n for n in named if not n & _STATE_WORDS))
    noise_words = _NOISE_WORDS & own
    if name not in _INLINE:
        noise_words -= {"skip"}  # links to the text are skip links; a paragraph may be called skip-first
    whole_page = name == "main" or role == "main"
    main_word = bool(_MAIN_WORDS.intersection(marks))
    main_id = bool(found.get("id")) and set(_words(found["id"])) <= _MAIN_WORDS and found["id"].replace("-", "").replace("_", "").isalpha()
    is_main = name == "article" or whole_page or (name in ("div", "section", "td") and main_word)
    if whole_page or main_id or (name == "article" and main_word) or name in ("html", "body"):
        noise_words = frozenset()
    label = parent.label
    if label == NOISE or name in _NOISE_NAMES or (role in _NOISE_ROLES and role != "form") or hidden or noise_words & _COMMENT_WORDS:
        label = NOISE
    elif label == MAIN and noise_words and noise_words <= {"header"}:
        pass  # an article's own header
    elif noise_words:
        label = NOISE if name in _INLINE else DOUBT
    elif name == "header" and label not in (MAIN, REGAINED):
        label = NOISE
    elif whole_page or (is_main and label in (NEUTRAL, FORM)):
        label = MAIN
    elif name == "article" and label == DOUBT and not parent.inside:
        label = REGAINED
    elif (name == "form" or role == "form") and label != DOUBT:
        label = DOUBT if label in (MAIN, REGAINED) else FORM
    inside = parent.inside or label in (MAIN, REGAINED)
    return Element(name, hashed(parent.path, name, sorted(set(marks))), label, name not in _INLINE, inside, parent)


_seen: dict[tuple[Element, str, str], Element] = {}


def opened(parent: Element, name: str, attributes: str) -> Element:
    key = (parent, name, attributes)
    got = _seen.get(key)
    if got is None:
        if len(_seen) > 50_000:
            _seen.clear()
        got = _seen[key] = _opened(parent, name, attributes)
    return got


@dataclass
class Block:
    element: Element  # the innermost block element around
    text: str
    linked: bool  # all of it is in links


def read(page: str | None) -> tuple[list[Block], dict[int, tuple[int, int]]]:
    """Blocks of text in page order, those in noise left out, and (label, count) of every block element's path.

    The time grows with the page's length, however deep its elements are.
    """
    text = page or ""
    blocks: list[Block] = []
    counts: dict[int, tuple[int, int]] = {}
    stack: list[Element] = [ROOT]
    around: list[Element] = [ROOT]  # the block elements of the stack
    open_names: Counter[str] = Counter()
    held: list[str] = []
    at, end, link, linked = 0, len(text), False, True

    def flush() -> None:
        nonlocal linked
        if held:
            joined = " ".join(html.unescape("".join(held)).split())
            if joined:
                blocks.append(Block(around[-1], joined, linked))
            held.clear()
            linked = True

    def pop_to(k: int) -> None:
        if any(stack[i].block for i in range(k, len(stack))):
            flush()
        while len(stack) > k:
            gone = stack.pop()
            open_names[gone.name] -= 1
            if gone.block:
                around.pop()

    while at < end:
        m = _ITEM.search(text, at)
        stop = m.start() if m else end
        if stop > at and stack[-1].label != NOISE:
            held.append(text[at:stop])
            linked = linked and (link or text[at:stop].isspace())
        if not m:
            break
        at = m.end()
        if m[0] == "<!--":
            close = text.find("-->", at)
            at = close + 3 if close >= 0 else end
            continue
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == "a":
            link = not closing
        if closing:
            if open_names[name] > 0:
                pop_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name))
            continue
        if name in _VOID:
            if name == "br" and stack[-1].label != NOISE:
                held.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in _RAW:
            if not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(text, at)
                at = close.end() if close else end
            continue
        if name not in _INLINE:
            if stack[-1].name == "p":
                pop_to(len(stack) - 1)
            for other in _CLOSES_ITSELF.get(name, ()):
                if stack[-1].name == other:
                    pop_to(len(stack) - 1)
                    break
        element = opened(stack[-1], name, attributes)
        if element.block:
            flush()
            label, n = counts.get(element.path, (element.label, 0))
            counts[element.path] = (label, n + 1)
            around.append(element)
        elif element.label == stack[-1].label:
            continue  # inline elements count only where they are noise
        stack.append(element)
        open_names[name] += 1
    flush()
    return blocks, counts
