"""A web page as a list of text blocks, each with the containers it stands in."""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
CONTAINERS = frozenset("html body div section article main td th center details fieldset figure dd header".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt table thead tbody tfoot tr caption blockquote pre hr address figcaption nav "
    "footer aside form summary dialog menu legend button select option head search".split()
)
#: Opening one of these ends an open one of the same kind within the same container.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("tr", "thead"), "tfoot": ("tr", "tbody"),
}
SCOPE = frozenset("html body div section article main ul ol dl table td th blockquote form nav aside footer header".split())

BOILER_TAGS = frozenset("nav footer aside form dialog menu button select svg object canvas search head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar note".split())
#: Words that mark what is not the article if a class or id has nothing but them and PLAIN_WORDS.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promoted "
    "promotion comment comments commentlist disqus respond replies cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay lightbox newsletter subscribe subscription signup login share sharing "
    "related recommended recommendations pager pagination breadcrumb breadcrumbs copyright hidden paywall footer foot".split()
)
#: Of these, words that no part of an article is named by: one of them is enough.
SURE_WORDS = frozenset(
    "advertisement advertising adsense adslot sponsored disqus gdpr newsletter commentlist comments lightbox breadcrumb "
    "breadcrumbs pagination pager signup paywall subscribe subscription consent".split()
)
#: Words that may as well name a part of the article: it goes only if it is mostly links.
DOUBTFUL_WORDS = BOILER_WORDS | frozenset("social reply disclaimer skip feedback rating ratings poll tooltip".split())
#: Words that say nothing about what is inside.
PLAIN_WORDS = frozenset(
    "a and area article articles bar block blocks body bottom box button buttons buy by center click close col column "
    "container content count counter element entry field footer for form frame group head header heading holder icon icons "
    "image img inline inner item items js label latest layer left link links list lists main media message meta mobile more "
    "network networks of on our out outer page panel policy popular post posts primary read reader readers reply right row "
    "secondary section settings single site slot small story stories sub tag tags text this thread title tool tools top "
    "unit us user users view widget widgets wrap wrapper x your zone".split()
)
LAYOUT_WORDS = frozenset("nav navbar navigation menu sidebar side rail aside widget widgets header masthead topbar toolbar search".split())
CONTENT_WORDS = frozenset("content article post entry story main body text".split())


def words_of(name: str) -> list[str]:
    """Lower-case words of a class or id, also at changes of case."""
    return re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())


def attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")) if value else "")
    return found


def general(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes without what numbers one page: digits and what follows them go."""
    classes = sorted({re.sub(r"[-_]?\d.*", "", c.lower()) for c in attrs.get("class", "").split()} - {""})
    return ".".join([tag, *classes])


def is_boiler(tag: str, attrs: dict[str, str]) -> bool:
    if tag in BOILER_TAGS:
        return True
    if tag in ("html", "body"):
        return False
    if attrs.get("role", "").lower() in BOILER_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    if tag in ("article", "main"):
        return False
    names = [set(words_of(n)) for n in attrs.get("class", "").split() + [attrs.get("id", "")]]
    for words in names:
        # short words are prefixes of a style sheet
        unknown = {w for w in words - BOILER_WORDS - PLAIN_WORDS - LAYOUT_WORDS if len(w) > 3}
        if words & SURE_WORDS or words & BOILER_WORDS and not unknown:
            return True
    words = set().union(*names)
    return bool(words & LAYOUT_WORDS and not words & CONTENT_WORDS)


def is_doubtful(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a word of a class or id may, or may not, mark what is not the article."""
    if tag in ("html", "body", "article", "main"):
        return False
    return bool(set(words_of(attrs.get("class", "") + " " + attrs.get("id", ""))) & DOUBTFUL_WORDS)


@dataclass
class Container:
    part: str  # tag and classes
    above: Container | None
    parent: int  # index, -1 for the root
    tag: str
    content_words: bool
    named: object = None  # running digest of the path
    score: float = 0.0

    def __post_init__(self) -> None:
        self.named = hashlib.blake2b(digest_size=16) if self.above is None else self.above.named.copy()
        if self.above is not None:
            self.named.update(f"/{self.part}".encode())

    @property
    def path(self) -> str:
        """Parts from the root on; spelled out only when asked for, as deep pages would repeat them."""
        parts, at = [], self
        while at.above is not None:
            parts.append(at.part)
            at = at.above
        return "".join(f"/{p}" for p in reversed(parts))

    @property
    def key(self) -> bytes:
        return self.named.digest()


def path_key(path: str) -> bytes:
    """The key of the containers of that path."""
    return hashlib.blake2b(path.encode(), digest_size=16).digest()


@dataclass
class Page:
    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # container, text, characters inside links


@dataclass
class _Open:
    tag: str
    container: int
    boiler: bool
    link: bool
    heading: bool  # inside a heading
    doubtful: int  # number of the outermost doubtful part, -1 for none


def read_page(source: str) -> Page:
    """Blocks in page order, without those of menus, forms, scripts and the like."""
    page = Page([Container("", None, -1, "", False)])
    stack = [_Open("", 0, False, False, False, -1)]
    parts: list[int] = []  # the doubtful part of each block
    doubtful_parts = 0
    text: list[str] = []
    linked = 0

    def end_block() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                page.blocks.append((stack[-1].container, joined, min(linked, len(joined))))
                parts.append(stack[-1].doubtful)
            text.clear()
        linked = 0

    def add(run: str) -> None:
        nonlocal linked
        top = stack[-1]
        if run and not top.boiler:
            text.append(run)
            if top.link:
                linked += len(run.strip())

    def close(at: int) -> None:
        if any(o.tag in BLOCKS for o in stack[at:]):
            end_block()
        del stack[at:]

    at = 0
    while match := TAG.search(source, at):
        add(source[at : match.start()])
        at = match.end()
        closing, tag = match[1], (match[2] or "").lower()
        if not tag:
            continue
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break  # a stray end tag of an inline element leaves blocks open
            else:
                if tag in BLOCKS:
                    end_block()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag in BLOCKS:
            ends = ENDS.get(tag, ()) + (("p",) if tag != "option" else ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in SCOPE and stack[i].tag not in ends:
                    break
            end_block()
        if tag in VOID:
            continue
        top = stack[-1]
        attrs = attributes(match[3]) if match[3] and match[3].strip(" /\n\t") else {}
        boiler = top.boiler or is_boiler(tag, attrs)
        heading = top.heading
        if tag == "header":
            # of a header inside the article only its headings belong to the text
            inside = any(o.tag in ("article", "main") for o in stack)
            boiler, heading = (top.boiler or True), inside and not top.boiler
        elif heading and re.fullmatch("h[1-6]", tag):
            boiler = False
        container = top.container
        if tag in CONTAINERS and tag != "header":
            words = set(words_of(attrs.get("class", "") + " " + attrs.get("id", "")))
            above = page.containers[container]
            page.containers.append(Container(general(tag, attrs), above, container, tag, bool(words & CONTENT_WORDS)))
            container = len(page.containers) - 1
        doubtful = top.doubtful
        if doubtful < 0 and attrs and not boiler and is_doubtful(tag, attrs):
            doubtful, doubtful_parts = doubtful_parts, doubtful_parts + 1
        stack.append(_Open(tag, container, boiler, top.link or tag == "a", heading, doubtful))
        if match[3] and match[3].endswith("/") and tag in ("svg",):
            stack.pop()
    add(source[at:])
    end_block()
    # a doubtful part goes if at least half of it is links
    size, links = [0] * doubtful_parts, [0] * doubtful_parts
    for (_, joined, linked_), part in zip(page.blocks, parts):
        if part >= 0:
            size[part] += len(joined)
            links[part] += linked_
    page.blocks = [b for b, part in zip(page.blocks, parts) if part < 0 or 2 * links[part] < size[part]]
    return page


def score_containers(page: Page) -> int:
    """Score all containers, return the index of the best; -1 without text.

    A block counts its characters outside links for its container, half of them for the one around and a quarter
    for the next. Article and main elements and content-like classes count more; the first of equals wins.
    """
    for container, text, linked in page.blocks:
        worth, at = float(len(text) - linked), container
        for share in (1.0, 0.5, 0.25):
            if at < 0:
                break
            page.containers[at].score += worth * share
            at = page.containers[at].parent
    best, top = -1, 0.0
    for i, c in enumerate(page.containers):
        weight = 3.0 if c.tag == "article" else 2.0 if c.tag == "main" else 1.5 if c.content_words else 1.0
        if c.score * weight > top:
            best, top = i, c.score * weight
    return best


def text_inside(page: Page, chosen: set[int]) -> str:
    """The blocks inside any of the chosen containers, in page order."""
    inside = [False] * len(page.containers)
    for i, c in enumerate(page.containers):
        inside[i] = i in chosen or (c.parent >= 0 and inside[c.parent])
    return " ".join(text for container, text, _ in page.blocks if inside[container])
