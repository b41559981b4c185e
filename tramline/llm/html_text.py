"""Main text of web pages by equivalence-class template deduction.

Pages of one host share one or several templates. Tokens are container
elements, named by their path of tags, classes and ids, and text blocks, those
of articles too. Pages of a host with the same main text blocks count once, so
that copies are no support. The occurrence vector of a token (how often it
occurs on which page) and its page set are kept as fingerprints that add up by
exclusive or, with partial aggregation.

1. Tokens of a host with the same vector form an equivalence class. A class is
   valid if it has at least ``MIN_CLASS`` tokens on at least ``MIN_PAGES``
   pages of distinct content, however large the host is: each section or
   language of a host has classes of its own.
2. The containers of valid classes are the templates'. A path holds the paths
   around it, so a class nests in those of the containers around its own.
   What lies between template containers are the slots.
3. A text block is the template's own if the container around it (outside of
   articles: or the page's language) has the same page set: wherever that
   stands, the text stands. Slots whose text is mostly links are menus.
4. Per page, the text of the remaining slots is the result. An article or main
   element only hints at the main one: beside it, a region is main text too if
   its unlinked text is at least ``MIN_REGION`` of the article's. Containers
   that name themselves menu, advert, notice, comment and the like never hold
   main text: a name counts if all its words are known ones (``cookie-notice``,
   not ``has-sidebar`` or ``research-share``), and not on html, body and main.
   A bar by name, by a form or by hiding is lifted from the containers around
   the main text: around the largest article if all articles are barred, and
   from a form that holds half of the page's text, with headings or paragraphs.

A class is at most one page's tokens, a host's templates are its valid classes;
they are written first and then meet the pages by host, without a shuffle of
the pages where they are small. Hosts of fewer than ``MIN_PAGES`` contents have
no template and are judged by names alone.

Blocks are the texts between block-level tags; white space inside a block
(line breaks, no-break spaces and ``<br>`` included) becomes one space.

Defined results: null, empty or tag-only html gives an empty text; null urls
share one empty host; cut pages are read to their end, an open script, style
or comment runs to the end; equal rows get equal texts; an empty table gives an
empty table.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import col, materialize, table
from .shingles import mix
from .url_filter import url_parts

MIN_CLASS = 2
MIN_PAGES = 3
MAX_LINK_SHARE = 0.5
MIN_REGION = 0.25

#: HTML element classes.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript object ol
    optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio canvas svg""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
SELF_CLOSING = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
                "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p article main".split())
#: Elements that never hold main text, and those that rarely do.
NO_TEXT_TAGS = frozenset("""aside audio button canvas dialog footer head iframe menu nav noscript object option
    script select style svg template textarea title video xmp noembed noframes""".split())
FORM_TAGS = frozenset(("form", "fieldset"))
#: Words of names that say what is no main text, and words that go with them.
NO_TEXT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising alert alerts aside banner banners
    breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright disclaimer disqus footer form
    forms gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications overlay
    pagination pager popup promo promos promoted promotion promotions related replies reply respond search share sharing sidebar
    sidebars sidenav signup signin skip social sponsor sponsored sponsors subscribe subscription teaser teasers toolbar topbar
    widget widgets""".split())
FILLER_WORDS = frozenset("""a above all area article articles bar below block body bottom box btn button buttons center col column
    container content cta field fields fixed for global group header heading holder home icons inline inner input item items js
    layout left link links list local main message messages mobile module of on out outer page panel position post posts primary
    region right row section secondary site slot small sticky story strip tertiary text the title to top unit user wrap wrapper
    zone""".split())
#: Of a page, but not of an article (there they hold its title).
HEADER_WORDS = frozenset(("header", "head", "top", "masthead"))
#: How much an element bars its text: not, unless it holds the main text, always.
OPEN, WEAK, SHUT = 0, 1, 2

#: Comments, declarations, tags; attributes with closed quotes, else up to the next bracket.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)(?:((?:"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>])|[^'">])*)>|([^>]*)(?:>|\Z))""", re.S | re.X)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LANG = re.compile(r"""(?:^|\s)lang\s*=\s*["']?([\w-]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text)).view(np.int64))


class _Node:
    """A container. ``path`` names its role, ``bar`` says how it bars its text,
    ``within`` that it is, or is in, an article or main element."""
    __slots__ = ("tag", "path", "role", "parent", "bar", "article", "within", "prose", "_state")

    def __init__(self, tag: str, path: str, parent, bar: int, article: bool):
        self.tag, self.path, self.parent, self.bar, self.article = tag, path, parent, bar, article
        self.within = article or parent is not None and parent.within
        self.prose = False
        self.role = _hash(path)
        self._state = None

    def state(self) -> tuple[bool, bool]:
        """(barred, in an article that is not barred); asked for when the
        whole page is read and bars are lifted."""
        if self._state is None:
            barred, inside = self.parent.state() if self.parent else (False, False)
            barred = barred or self.bar != OPEN
            self._state = barred, not barred and (inside or self.article)
        return self._state

    @property
    def barred(self) -> bool:
        return self.state()[0]

    @property
    def inside(self) -> bool:
        return self.state()[1]

    def upwards(self):
        node = self
        while node is not None:
            yield node
            node = node.parent


def _says_no_text(name: str) -> bool:
    words = [w.lower() for w in _WORDS.findall(name)]
    return any(w in NO_TEXT_WORDS for w in words) and all(w in NO_TEXT_WORDS or w in FILLER_WORDS for w in words)


def _says_header(name: str) -> bool:
    words = [w.lower() for w in _WORDS.findall(name)]
    return any(w in HEADER_WORDS for w in words) and all(w in HEADER_WORDS or w in FILLER_WORDS for w in words)


def _opened(tag: str, attributes: str, parent: _Node) -> _Node:
    names = " ".join(v for m in _NAME.finditer(attributes) for v in [m[2] or m[3] or m[4] or ""]) if attributes else ""
    article = tag in ("article", "main") or "role" in attributes.lower() and "main" in names.lower().split()
    frame = tag in ("html", "body", "main") or article and tag != "article"
    bar = OPEN
    if tag in NO_TEXT_TAGS:
        bar = SHUT
    elif tag in FORM_TAGS or attributes and _HIDDEN.search(attributes) or not frame and any(map(_says_no_text, names.split())):
        bar = WEAK
    elif not parent.within and not article and not frame and (tag == "header" or any(map(_says_header, names.split()))):
        bar = WEAK
    label = tag + "".join("." + n for n in sorted(set(re.sub(r"\d+", "0", names).split())))
    return _Node(tag, f"{parent.path}>{label}", parent, bar, article)


def _lift(blocks: list, nodes: list) -> None:
    """Takes weak bars from what is around the page's main text."""
    held: dict[int, int] = {}
    for text, linked, node, _ in blocks:
        for up in node.upwards():
            if up.bar == SHUT:
                break
        else:
            for up in node.upwards():
                held[id(up)] = held.get(id(up), 0) + len(text) - linked
    weight = lambda n: held.get(id(n), 0)
    articles = [n for n in nodes if n.article and n.bar == OPEN and weight(n)]
    around = lambda n: [u for u in n.upwards() if u is not n and u.bar]
    if articles and all(around(n) for n in articles):
        for up in around(max(articles, key=weight)):
            up.bar = OPEN
    page = weight(nodes[0])
    for n in nodes:
        if n.bar == WEAK and n.tag in FORM_TAGS and n.prose and 2 * weight(n) >= page > 0:
            n.bar = OPEN


def page_blocks(page: str | None):
    """(text, link characters, node, node path from the root) of every block
    in page order, the counts of opened containers by role, and the role of
    the page's language (0: none)."""
    page = page or ""
    root = _Node("", "", None, OPEN, False)
    stack, parts, blocks, roles, nodes = [root], [], [], {}, [root]
    link_depth, link_chars, at, language = 0, 0, 0, 0      # link_depth: containers around the open link, 0: none

    def flush():
        nonlocal link_chars
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((text, min(link_chars, len(text)), stack[-1], [n.role for n in stack[1:]]))
        parts.clear()
        link_chars = 0

    def said(raw):
        nonlocal link_chars
        text = entities.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if link_depth:
            link_chars += len(text.strip())

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            said(page[at:])
            break
        if m.start() > at:
            said(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, attributes = m[2].lower(), m[3] or m[4] or ""
        if tag == "a":                           # a link ends with its end tag, the next anchor or its block
            link_depth = len(stack) if not m[1] and _HREF.search(attributes) else 0
        if tag == "br":
            parts.append(" ")
        if tag in RAW and not m[1]:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if tag in VOID:
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        else:
            closes = SELF_CLOSING.get(tag)
            if closes or stack[-1].tag == "p":
                while len(stack) > 1 and (stack[-1].tag == "p" or closes and stack[-1].tag in closes):
                    stack.pop()
        if len(stack) < link_depth:
            link_depth = 0
        if m[1]:
            continue
        node = _opened(tag, attributes, stack[-1])
        if tag in PROSE:
            for up in stack:
                up.prose = True
        roles[node.role] = roles.get(node.role, 0) + 1
        stack.append(node)
        nodes.append(node)
        if tag == "html" and not language and (m := _LANG.search(attributes)):
            language = _hash(f"lang={m[1].lower()}")
            roles[language] = 1
    flush()
    if any(n.bar == WEAK for n in nodes):
        _lift(blocks, nodes)
    return blocks, roles, language


def _text_token(role: int, text: str) -> int:
    return _hash(f"{role}|{text}")


def main_text(page: str | None, link_slots=frozenset(), template_texts=frozenset(), template=None) -> str:
    """Main text of one page, given its host's template as sets: roles of its
    containers, of its link slots, and the hashes of its own text blocks."""
    blocks, _, _ = page_blocks(page)
    left = [b for b in blocks if not b[2].barred and _slot(b[3], template) not in link_slots
            and _text_token(b[2].role, b[0]) not in template_texts]
    return "\n".join(b[0] for b in _main(left))


def _main(left: list) -> list:
    """Of the blocks that are not the template's, those of the main text: all
    in articles, and those of large regions beside them (the outermost
    containers without an article); all blocks if there is no article."""
    around = {r for _, _, node, path in left if node.inside for r in path}
    if not around:
        return left
    article = sum(len(text) - linked for text, linked, node, _ in left if node.inside)
    beside, regions = {}, []
    for text, linked, node, path in left:
        region = None if node.inside else next((r for r in path if r not in around), 0)
        regions.append(region)
        beside[region] = beside.get(region, 0) + len(text) - linked
    return [b for b, r in zip(left, regions, strict=True) if r is None or beside[r] >= MIN_REGION * article]


def _slot(path: list[int], template) -> int:
    """The innermost template container around a block (0: the page itself)."""
    return next((r for r in reversed(path) if template is None or r in template), 0)


#: A page's tokens: rows of seven numbers. kind 0: a container; kind 1: a text
#: block with its container and, outside of articles, its page's language.
PAGE = ["token", "kind", "parent", "language", "n", "chars", "links"]
TOKENS = ("host string, token long, kind int, parent long, language long, pages long, vector long, page_set long, "
          "chars long, links long")


def _page_tokens(batches):
    """(host, content, tokens) per page; equal contents: equal main text blocks."""
    for pdf in batches:
        out = []
        for host, page in zip(pdf["host"], pdf["html"], strict=True):
            blocks, roles, language = page_blocks(page)
            chars, links, texts, open_ = {}, {}, {}, []
            for text, linked, node, path in blocks:
                for r in path:
                    chars[r] = chars.get(r, 0) + len(text)
                    links[r] = links.get(r, 0) + linked
                if not node.barred:
                    t = _text_token(node.role, text)
                    texts.setdefault(t, [node.role, 0 if node.inside else language, 0])[2] += 1
                    open_.append(text)
            tokens = [(r, 0, 0, 0, n, chars.get(r, 0), links.get(r, 0)) for r, n in roles.items()]
            tokens += [(t, 1, parent, spoken, n, 0, 0) for t, (parent, spoken, n) in texts.items()]
            packed = np.array(sorted(tokens), np.int64).reshape(-1, len(PAGE)).tobytes()
            out.append((host, _hash("\n".join(open_)), packed))
        yield pd.DataFrame(out, columns=["host", "content", "tokens"])


def _counted(batches):
    """Tokens summed up over a batch of pages."""
    names = [c.split()[0] for c in TOKENS.split(", ")]
    for pdf in batches:
        if not len(pdf):
            continue
        pages = [np.frombuffer(t, np.int64).reshape(-1, len(PAGE)) for t in pdf["tokens"]]
        sizes = [len(p) for p in pages]
        token, kind, parent, language, n, chars, links = np.concatenate(pages).T
        code, hosts = pd.factorize(pdf["host"], use_na_sentinel=False)
        host = np.repeat(code, sizes)
        page = np.repeat(mix(pdf["content"].to_numpy(np.int64).view(np.uint64)), sizes)
        vector = mix(page ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.lexsort((token, host))
        if not len(order):
            continue
        host, token = host[order], token[order]
        first = np.flatnonzero(np.r_[True, (host[1:] != host[:-1]) | (token[1:] != token[:-1])])
        own = order[first]
        summed = lambda x: np.add.reduceat(x[order], first)
        mixed = lambda x: np.bitwise_xor.reduceat(x[order], first).view(np.int64)
        values = [hosts[host[first]], token[first], kind[own], parent[own], language[own], summed(np.ones(len(n), np.int64)),
                  mixed(vector), mixed(page), summed(chars), summed(links)]
        yield pd.DataFrame(dict(zip(names, values, strict=True)))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, template, link_slots, texts) per host with valid classes.
    ``pages``: host, html."""
    contents = (pages.mapInPandas(_page_tokens, "host string, content long, tokens binary")
                .groupBy("host", "content").agg(F.min("tokens").alias("tokens")))
    tokens = (contents.mapInPandas(_counted, TOKENS).groupBy("host", "token", "kind")
              .agg(F.min("parent").alias("parent"), F.min("language").alias("language"), F.sum("pages").alias("pages"),
                   F.bit_xor("vector").alias("vector"), F.bit_xor("page_set").alias("page_set"),
                   F.sum("chars").alias("chars"), F.sum("links").alias("links"))
              .where(F.col("pages") >= MIN_PAGES))
    # the classes on one set of pages: at most one page's tokens
    classes = (tokens.groupBy("host", "pages", "page_set")
               .agg(F.collect_list(F.struct("token", "kind", "parent", "language", "vector", "chars", "links")).alias("tokens"))
               .mapInPandas(_valid, "host string, template array<long>, link_slots array<long>, texts array<long>"))
    return materialize(classes.groupBy("host").agg(*[F.flatten(F.collect_list(c)).alias(c)
                                                     for c in ("template", "link_slots", "texts")]), "html-templates")


def _valid(batches):
    """Containers of the valid classes on one set of pages, the link slots
    among them, and the texts that stand wherever the container around them does."""
    for pdf in batches:
        out = []
        for host, tokens in zip(pdf["host"], pdf["tokens"], strict=True):
            size: dict[int, int] = {}
            for t in tokens:
                size[t["vector"]] = size.get(t["vector"], 0) + 1
            here = {t["token"] for t in tokens if t["kind"] == 0}
            template = [t for t in tokens if t["kind"] == 0 and size[t["vector"]] >= MIN_CLASS]
            menus = [t["token"] for t in template if t["links"] > MAX_LINK_SHARE * t["chars"] > 0]
            texts = [t["token"] for t in tokens if t["kind"] == 1 and (t["parent"] in here or t["language"] in here)]
            if template or texts:
                out.append((host, [t["token"] for t in template], menus, texts))
        yield pd.DataFrame(out, columns=["host", "template", "link_slots", "texts"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row."""
    rows = pages.select(col(id_col).alias(id_col), col(url_col).alias(url_col), url_parts(col(url_col))[0].alias("host"),
                        F.coalesce(col(html_col), F.lit("")).alias("html"))
    templates = deduce_templates(rows.select("host", "html"))

    @F.pandas_udf("string")
    def texts(host: pd.Series, html: pd.Series, template: pd.Series, menus: pd.Series, own: pd.Series) -> pd.Series:
        sets, out = {}, []                           # the sets of a host are built once per batch
        for name, page, t, m, o in zip(host, html, template, menus, own, strict=True):
            if name not in sets:
                sets[name] = (frozenset(), frozenset(), None) if t is None else tuple(frozenset(x.tolist()) for x in (m, o, t))
            out.append(main_text(page, *sets[name]))
        return pd.Series(out, dtype=object)

    text = texts("host", "html", "template", "link_slots", "texts")
    return (rows.join(templates, "host", "left").select(id_col, url_col, text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
