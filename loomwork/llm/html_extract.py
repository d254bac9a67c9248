"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a run of scored tokens: words score by where they stand,
tags score negative, and an element that is boilerplate as a whole counts as
one tag. All weights come from labelled pages. One linear scan finds the
contiguous region of the highest sum; its words are the text. Reading, scoring
and scanning are linear in the page, however deep it nests.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
#: An opening tag of the key closes an open element of the value before it.
IMPLIED_END = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("td", "th", "tr"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_SCOPES = frozenset("ul ol dl table select article main section div nav aside footer header form body".split())
_MAIN = frozenset(("article", "main"))
#: Elements whose size and contents say something, as their names say little.
_GENERIC = frozenset("body center div li ol p section span table tbody td tr ul html".split())
#: An element is boilerplate at or below this sum of log odds.
BOILERPLATE = -1.0
#: What a run of tags can cost at most: less than one word of content earns.
TAG_RUN = 0.4
#: Beginnings of a class name that say what an element stands beside.
_BESIDE = ("with", "has", "no", "without")
#: Endings of a class name that may say the state of a layout.
_STATE = ("right", "left", "fixed", "sticky", "open", "closed", "visible", "on", "off")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?P<end>>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|[\s\"'/])(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass
class Page:
    """Elements by number, parents before children; texts and tags in page order."""

    parent: list[int] = field(default_factory=lambda: [-1])
    name: list[str] = field(default_factory=lambda: [""])
    features: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    gold: list[bool] = field(default_factory=lambda: [False])
    #: (element, block, text, words), or (element, -1, tag name, 0)
    events: list[tuple[int, int, str, int]] = field(default_factory=list)

    def totals(self, own: list[int]) -> list[int]:
        """Sums over each element and all it holds."""
        out = own[:]
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def evidence(self) -> Iterator[tuple[str, ...]]:
        """The features of each element: its tag, and for plain ones what they hold."""
        n = len(self.name)
        own, linked, heads = [0] * n, [0] * n, [0] * n
        in_link, inside = [False] * n, [False] * n
        for e in range(1, n):
            above = self.parent[e]
            inside[e] = inside[above] or self.name[above] in _MAIN or "role:main" in self.features[above]
            in_link[e] = in_link[self.parent[e]] or self.name[e] == "a"
            heads[self.parent[e]] += self.name[e] in ("h1", "article", "main")
        for e, block, _, words in self.events:
            if block >= 0:
                own[e] += words
                linked[e] += words * in_link[e]
        held, linked, heads = self.totals(own), self.totals(linked), self.totals(heads)
        every = held[0]
        for e in range(n):
            more: tuple[str, ...] = ()
            if self.name[e] in _GENERIC and held[e]:
                share = held[e] / every
                if not inside[e]:
                    more = ("share:all" if share >= 0.95 else "share:most" if share >= 0.6 else "share:some" if share >= 0.2 else "share:few",)
                if held[e] >= 2 and linked[e] >= 0.6 * held[e]:
                    more += ("links",)
                if heads[e]:
                    more += ("heads",)
            if inside[e]:
                more += ("inside",)
            yield self.features[e] + more


@lru_cache(maxsize=4096)
def _features(name: str, attrs: str) -> tuple[str, ...]:
    out = {name: None}
    if attrs:
        for m in _ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            kind = "role" if m[1].lower() == "role" else "class"
            for word in value.split():
                parts = [p.lower() for p in _PARTS.findall(word)]
                if parts and parts[0] not in _BESIDE:
                    told = kind if len(parts) == 1 else "state" if parts[-1] in _STATE else "part"
                    out |= dict.fromkeys(f"{told}:{p}" for p in parts)
        if _HIDDEN.search(attrs):
            out["hidden"] = None
    if name in _GENERIC and len(out) > 1:
        del out[name]
        out[f"{name} named"] = None
    return tuple(out)


def read_page(page: str) -> Page:
    """Elements, texts and tags of a page.

    Scripts, styles and other raw elements give no text; an unfinished tag or
    comment ends the page. What is open is kept by name too, so that a closing
    tag or an implied end looks nothing up along the stack.
    """
    out = Page()
    stack = [0]
    places: dict[str, list[int]] = {}
    scopes: list[int] = []
    block, at, n = 0, 0, len(page)

    def cut(depth: int) -> None:
        while len(stack) > depth:
            name = out.name[stack.pop()]
            places[name].pop()
            if name in _SCOPES:
                scopes.pop()

    while at < n:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else n
        if stop > at:
            text = page[at:stop]
            out.events.append((stack[-1], block, text, len(text.split())))
        if not found:
            break
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        if not found["end"]:
            break
        name = name.lower()
        out.events.append((stack[-1], -1, name, 0))
        if name in BLOCK:
            block += 1
        elif name in ("br", "wbr"):
            if name == "br":
                out.events.append((stack[-1], block, " ", 0))
            continue
        if found["close"]:
            if places.get(name):
                cut(places[name][-1])
            continue
        if name in VOID:
            continue
        if name in RAW:
            end = _raw_end(name).search(page, at)
            at = end.end() if end else n
            continue
        closes = ("p",) if name in BLOCK and name != "body" else ()
        closes += IMPLIED_END.get(name, ())
        last = max((places[c][-1] for c in closes if places.get(c)), default=0)
        if last and (not scopes or last > scopes[-1]):
            cut(last)
        if not found["attrs"].rstrip().endswith("/") or name in BLOCK:
            places.setdefault(name, []).append(len(stack))
            if name in _SCOPES:
                scopes.append(len(stack))
            e = len(out.name)
            out.parent.append(stack[-1])
            out.name.append(name)
            out.features.append(_features(name, found["attrs"]))
            out.gold.append(out.gold[stack[-1]] or "data-gold" in found["attrs"])
            stack.append(e)
    return out


@lru_cache(maxsize=16)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)


@dataclass(frozen=True)
class Weights:
    """``odds``: log odds by element feature that the element holds content;
    ``words``: score of a word on a page without a main element ("page"), in one ("main"), beside one ("beside");
    ``tags``: score of a tag by name; ``element``: that of a boilerplate element."""

    odds: dict[str, float]
    words: dict[str, float]
    tags: dict[str, float]
    element: float

    def boilerplate(self, page: Page) -> list[bool]:
        """Whether each element is boilerplate, or within one."""
        out = [False] * len(page.name)
        for e, features in enumerate(page.evidence()):
            if e:
                out[e] = out[page.parent[e]] or sum(self.odds.get(f, 0.0) for f in features) <= BOILERPLATE
        return out


def _in_main(page: Page, gone: list[bool]) -> list[bool]:
    out = [False] * len(page.name)
    for e in range(1, len(out)):
        out[e] = not gone[e] and (out[page.parent[e]] or page.name[e] in _MAIN or "role:main" in page.features[e])
    return out


def _contexts(page: Page, gone: list[bool]) -> list[str]:
    """The place of each element's words."""
    main = _in_main(page, gone)
    some = any(block >= 0 and words and main[e] for e, block, _, words in page.events)
    return ["page" if not some else "main" if m else "beside" for m in main]


def train_weights(pages: list[str]) -> Weights:
    """Weights from pages whose content elements carry the attribute data-gold.

    Elements with content stand against the outermost ones without; each feature
    weighs by its smoothed log odds between the two.
    """
    kept, gone, n_kept, n_gone = Counter(), Counter(), 0, 0
    word_kept, word_gone, tag_kept, tag_all = Counter(), Counter(), Counter(), Counter()
    for text in pages:
        page = read_page(text)
        held = [0] * len(page.name)
        good = [0] * len(page.name)
        for e, block, _, words in page.events:
            if block >= 0:
                held[e] += words
                good[e] += words * page.gold[e]
        held, good = page.totals(held), page.totals(good)
        rest = [bool(held[e]) and not good[e] for e in range(len(held))]
        for e, features in enumerate(page.evidence()):
            if not e or not held[e]:
                continue
            if good[e]:
                kept.update(features)
                n_kept += 1
            elif good[page.parent[e]] or page.parent[e] == 0 or not rest[page.parent[e]]:
                gone.update(features)
                n_gone += 1
        places = _contexts(page, rest)
        for e, block, name, words in page.events:
            if block < 0:
                tag_all[name] += 1
                tag_kept[name] += page.gold[e]
            elif not rest[e]:
                (word_kept if page.gold[e] else word_gone)[places[e]] += words
    odds = {f: math.log((kept[f] + 0.5) / (n_kept + 1)) - math.log((gone[f] + 0.5) / (n_gone + 1)) for f in sorted({*kept, *gone})}
    score = lambda c: max(-1.0, min(1.0, math.log((word_kept[c] + 1) / (word_gone[c] + 1)) / 3))
    tags = {t: -0.1 * (1 - tag_kept[t] / (n + 1)) for t, n in sorted(tag_all.items())}
    return Weights(odds, {c: score(c) for c in ("page", "main", "beside")}, tags, -0.1)


def extract_main_text(page: str | None, weights: Weights | None = None) -> str:
    """The article of a page: blocks joined by line feeds, '' if there is none."""
    if not page:
        return ""
    weights = weights or default_weights()
    read = read_page(page)
    gone = weights.boilerplate(read)
    places = _contexts(read, gone)
    best, best_from, best_to, run, begin, tags = 0.0, 0, 0, 0.0, 0, 0.0
    for i, (e, block, name, words) in enumerate(read.events):
        if block < 0 or gone[e]:
            cost = weights.element if gone[e] else weights.tags.get(name, -0.05)
            s, tags = max(cost, -TAG_RUN - tags), max(-TAG_RUN, tags + cost)
        elif words:
            s, tags = words * weights.words[places[e]], 0.0
        else:
            continue
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, best_from, best_to = run, begin, i + 1
    blocks: dict[int, list[str]] = {}
    for e, block, text, _ in read.events[best_from:best_to]:
        if block >= 0 and not gone[e]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html_lib.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


# Words that fill the labelled pages, and the names that sites give to the parts of a page.
_WORDS = "the of and to in a is that for it was on are as with his they be at one have this from or had by hot word but what some we can out other were all there when up use your how said each she which do their time if will way about many then them write would like so these her long make thing see him two has look more day could go come did number sound no most people my over know water than call first who may down side been now find".split()
_NAMES = {
    "menu": "menu nav navigation navbar topnav subnav sidenav mainnav menubar dropdown breadcrumb breadcrumbs pager pagination toolbar topbar skiplink hauptmenu navigacion",
    "header": "header masthead siteheader pageheader logo banner kopfzeile entete cabecera headers",
    "footer": "footer sitefooter pagefooter colophon copyright legal impressum fusszeile pied pie footers imprint",
    "side": "sidebar aside widget widgets rail seitenleiste barre lateral related recommended recommendations teaser tagcloud sidebars similar popular",
    "notice": "notice cookie cookies consent gdpr alert notification announcement disclaimer banner popup modal overlay hinweis avis aviso paywall newsletter subscribe notices cookiebar cookieconsent",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion adbox adslot adsbygoogle werbung anzeige publicite pub publicidad anuncio taboola outbrain",
    "comments": "comments comment commentlist replies reply responses respond disqus usercomments kommentare kommentar commentaires commentaire comentarios comentario",
    "form": "form search login signup contact anmeldung connexion suche recherche buscar register",
    "share": "share sharing social follow tags byline tools teilen partager compartir",
}
_CONTENT = "content article post entry story text body main inhalt contenu contenido article-body post-content entry-content page-content haupttext".split()
_LAYOUT = "page wrapper container layout site outer inner row wrap grid app root canvas".split()
_SIDE_OF_LAYOUT = "sidebar-right sidebar-left header-fixed menu-open nav-open with-sidebar no-sidebar has-header footer-sticky banner-visible ads-off col-8 js light".split()
_TAGS = {"menu": ["nav", "menu"], "header": ["header"], "footer": ["footer"], "side": ["aside"], "form": ["form", "fieldset"], "notice": ["dialog", "noscript"], "advert": ["aside", "iframe", "object"]}
_ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "side": "complementary", "form": "search", "notice": "alert"}


def labelled_pages(seed: int = 3, n: int = 1500) -> list[str]:
    """Pages drawn by seed, their content elements marked data-gold.

    Each draws its wrappers, the parts around and within the article, how a part
    is marked (tag, role, class or id with another word beside it), and sizes
    from a word to more than the article's.
    """
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice(_WORDS) for _ in range(k))
    link = lambda k: f'<a href="/{rng.choice(_WORDS)}">{words(k)}</a>'

    def inside(kind: str) -> str:
        if kind in ("menu", "share"):
            items = [link(rng.randint(1, 3)) for _ in range(rng.randint(2, 9))]
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.6 else " ".join(items)
        if kind == "form":
            return f"<label>{words(2)}</label><input name=q><select><option>{words(1)}</option></select><button>{words(1)}</button>"
        if kind == "comments":
            one = lambda: f"<div class=\"comment\"><b>{words(1)}</b><p>{words(rng.randint(5, 40))}</p></div>"
            return f"<h3>{words(1)}</h3>" + "".join(one() for _ in range(rng.randint(1, 8)))
        if kind == "side":
            return f"<h3>{words(2)}</h3>" + "".join(rng.choice([f"<p>{words(rng.randint(4, 30))}</p>", f"<ul><li>{link(3)}</li><li>{link(4)}</li></ul>"]) for _ in range(rng.randint(1, 4)))
        return rng.choice(["{}", "<p>{}</p>", "<span>{}</span>"]).format(words(rng.randint(2, 40)))

    def part(kind: str) -> str:
        how, name = rng.random(), rng.choice(_NAMES[kind].split())
        if how < 0.35 and kind in _TAGS:
            tag = rng.choice(_TAGS[kind])
            return f"<{tag}>{inside(kind)}</{tag}>"
        if how < 0.45 and kind in _ROLES:
            return f'<div role="{_ROLES[kind]}">{inside(kind)}</div>'
        if how < 0.5:
            return f"<div hidden>{inside('notice')}</div>"
        if how < 0.55 and kind == "menu":
            return f"<ul>{''.join('<li>' + link(1) + '</li>' for _ in range(5))}</ul>"
        spelt = rng.choice(["{}", "{}", "{}", "{}-right", "{}-fixed", "{}-box", "site-{}", "main-{}", "{}-1", "{}_wrap", "js-{}", "{} clearfix", "top-{}", "{}-section"]).format(name)
        tag = rng.choice(["div", "div", "div", "section", "span" if kind == "advert" else "div", "article" if kind == "comments" else "div"])
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{spelt}">{inside(kind)}</{tag}>'

    def paragraph() -> str:
        extra = rng.choice(["", "", f" <b>{words(2)}</b> ", f" {link(2)} ", f" <em>{words(1)}</em> <span>{words(2)}</span> ", f" <code>{words(1)}</code><small>{words(1)}</small> "])
        return f"<p>{words(rng.randint(3, 60))}{extra}{words(rng.randint(1, 30))}</p>"

    def block() -> str:
        kinds = [f"<h2>{words(4)}</h2>", f"<ul><li>{words(5)}</li><li>{words(7)}</li></ul>", f"<ol><li>{link(4)}</li><li>{link(3)}</li></ol>", f"<blockquote>{words(12)}</blockquote>"]
        kinds += [f"<table><tr><th>{words(1)}</th><td>{words(3)}</td></tr></table>", f"<pre>{words(8)}</pre>", f"<figure><figcaption>{words(7)}</figcaption></figure>", f"<div>{words(9)}</div>"]
        kinds += [f"<div><div><section>{paragraph()}</section></div></div>", f"<header><h2>{words(5)}</h2></header>" if rng.random() < 0.1 else f"<dl><dt>{words(1)}</dt><dd>{words(6)}</dd></dl>"]
        return rng.choice(kinds)

    def article() -> str:
        pieces = [f"<h1 data-gold>{words(rng.randint(2, 9))}</h1>"] if rng.random() < 0.7 else []
        for _ in range(rng.randint(1, 8)):
            piece = paragraph() if rng.random() < 0.7 else block()
            pieces.append(re.sub(r"^<(\w+)", r"<\1 data-gold", piece))
            if rng.random() < 0.12:
                pieces.append(part(rng.choice(["advert", "side", "share", "comments", "form", "notice"])))
        body, how = "".join(pieces), rng.random()
        if how < 0.35:
            return f"<{(t := rng.choice(['article', 'main']))}>{body}</{t}>"
        if how < 0.42:
            return f'<div role="main">{body}</div>'
        side = f" {rng.choice(_SIDE_OF_LAYOUT)}" if rng.random() < 0.3 else ""
        return f'<div {rng.choice(["class", "id"])}="{rng.choice(_CONTENT)}{side}">{body}</div>' if how < 0.85 else body

    def page() -> str:
        before = "".join(part(k) for k in rng.sample(["menu", "header", "notice", "advert", "form"], rng.randint(0, 4)))
        after = "".join(part(k) for k in rng.sample(["footer", "side", "comments", "advert", "share", "notice", "menu"], rng.randint(0, 5)))
        inner = before + (article() if rng.random() < 0.93 else "") + after
        for _ in range(rng.randint(0, 2)):
            classes = [rng.choice(_LAYOUT), *rng.sample(_SIDE_OF_LAYOUT, rng.randint(0, 2))]
            inner = f'<div class="{" ".join(classes)}">{inner}</div>'
        state = f' class="{rng.choice(_SIDE_OF_LAYOUT)}"' if rng.random() < 0.3 else ""
        return f"<html><head><title>{words(4)}</title></head><body{state}>{inner}</body></html>"

    return [page() for _ in range(n)]


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    return train_weights(labelled_pages())


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty html, or one without content, has the text ''. Repeated
    rows and null ids are returned as they come; other columns are not read.
    The weights are trained once, by the driver.
    """
    weights = default_weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_main_text(h.as_py(), weights) for h in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
