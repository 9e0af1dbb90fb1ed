"""Main text of web pages by consensus host paths.

1. Each page is cut into blocks of text. A block's container is its nearest enclosing element that is no paragraph or
   inline element; the path of a container is its chain of tags and classes, with digits generalised. A page chooses
   the smallest container that holds nearly all its text (link text counts against it), or the outermost article or main
   around that.
2. Per host, Spark counts the choices. The path with most wins, and each other that is a template of the host too: at
   least `PAGES` pages and a part of `SHARE` of the host's choose it.
3. Each page is cut again and gives the blocks below all containers with its host's winning paths, with those that stand
   directly in what is around them; html and body count only for pages that choose them. A page without any gives the
   blocks of its own choice.

Menus, headers outside the article, footers, sidebars, notices, adverts, forms, scripts, styles and comments are never
part of a block, by their tags or the names in their class, id or role. A name counts as a whole: it is one of a list of
words, or made of such words and of words for place and shape only (`site-footer`, not `notice-of-motion`).
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.scratch import keep

#: Part of a page's text that a container must hold to be chosen.
NEARLY_ALL = 0.98
#: What makes a path a template besides the first.
PAGES, SHARE = 2, 0.01
#: Hosts whose winning paths are sent to all tasks at most; more are joined by shuffle.
SMALL = 50_000

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<[!?/a-zA-Z][^>]*(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+")
NAMED = re.compile("class|id|role", re.IGNORECASE)

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Blocks of text that do not contain other containers as a rule.
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "dt", "dd", "li", "blockquote", "figcaption", "caption", "td", "th", "tr", "hr", "ul", "ol", "dl", "address", "summary"}
DROPPED_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "head", "fieldset", "input"}
DROPPED_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager",
    "pagination", "popup", "promo", "promoted", "related", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget",
    "alert", "toolbar", "masthead", "complementary", "contentinfo", "search", "replies",
}
#: What a name may hold besides: words for place, shape and number.
OTHER_WORDS = {
    "area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "center", "container", "content", "fixed", "form", "global", "group", "header", "holder",
    "horizontal", "icons", "id", "inner", "item", "items", "js", "large", "left", "link", "links", "list", "main", "message", "mobile", "outer", "overlay", "page",
    "panel", "post", "posts", "primary", "right", "row", "secondary", "section", "signup", "site", "slot", "small", "sticky", "stories", "top", "unit", "vertical",
    "wrap", "wrapper", "zone",
}
#: Elements that a start tag ends if their end tag is left out, and elements beyond which it does not look for them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"td", "th", "tr"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}), "thead": ({"caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
}
#: Elements whose items end with them; an end tag of an item does not look beyond.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "p": {"td", "th", "table", "li", "dd", "div", "section", "article"}}


class Page:
    """Blocks of a page: (path of the container, text, characters in links)."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, int]] = []
        self.text: list[str] = []
        self.in_links = 0
        path, links, at, end = "", 0, 0, len(html)
        stack: list[tuple[str, str, bool]] = []  # tag, path below it, whether its text is dropped
        dropped = article = False
        while at < end:
            found = TOKEN.search(html, at)
            start = found.start() if found else end
            if start > at and not dropped:
                self._add(html[at:start], links)
            if not found:
                break
            at, tag = found.end(), found[2]
            if not tag:  # a comment, a declaration or an unended tag
                continue
            tag = tag.lower()
            if found[1]:
                if tag == "a":
                    links = 0
                if tag in INLINE:
                    continue
                self._end(path)
                depth = _open(stack, {tag}, SCOPES.get(tag, ()))
                if depth is not None:
                    path, dropped = stack[depth][1], stack[depth][2]
                    del stack[depth:]
                    article = any(x[0] in ("article", "main") for x in stack)
            elif tag in RAW:
                close = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
            elif tag in INLINE:
                if tag == "br" and not dropped:
                    self.text.append(" ")
                links = 1 if tag == "a" else links
            else:
                self._end(path)
                while stack and stack[-1][0] == "p":  # nothing but inline elements stands in a paragraph
                    _, path, dropped = stack.pop()
                ended = _open(stack, *ENDS[tag]) if tag in ENDS else None
                while ended is not None:
                    path, dropped = stack[ended][1], stack[ended][2]
                    del stack[ended:]
                    ended = _open(stack, *ENDS[tag])
                if tag in VOID:
                    continue
                stack.append((tag, path, dropped))
                if tag in LEAF:
                    dropped = dropped or _marked(found[3])
                    continue
                dropped = dropped or tag in DROPPED_TAGS or (tag == "header" and not article) or (tag not in ("html", "body", "article", "main") and _marked(found[3]))
                article = article or tag in ("article", "main")
                path = f"{path}/{_step(tag, found[3])}"
        self._end(path)

    def _add(self, text: str, links: int) -> None:
        self.text.append(text)
        self.in_links += len(text) if links else 0

    def _end(self, path: str) -> None:
        if self.text:
            text = " ".join(entities.unescape("".join(self.text)).split())
            if text:
                self.blocks.append((path, text, self.in_links))
            self.text, self.in_links = [], 0

    def choice(self) -> tuple[str, bool]:
        """The path of the page's main container, and whether the page has text outside links that speaks for it."""
        held = [(path.split("/")[1:], max(0, len(text) - 2 * linked)) for path, text, linked in self.blocks]
        speaks = any(score for _, score in held)
        if not speaks:
            held = [(steps, len(text)) for (steps, _), (_, text, _) in zip(held, self.blocks, strict=True)]
        least = NEARLY_ALL * sum(score for _, score in held)
        chosen: list[str] = []
        while held:
            scores: dict[str, float] = defaultdict(float)
            for steps, score in held:
                if len(steps) > len(chosen):
                    scores[steps[len(chosen)]] += score
            step = max(sorted(scores), key=scores.get, default=None)
            if step is None or scores[step] < least:
                break
            held = [(steps, score) for steps, score in held if len(steps) > len(chosen) and steps[len(chosen)] == step]
            chosen.append(step)
        for depth, step in enumerate(chosen):
            if step.partition(".")[0] in ("article", "main"):
                del chosen[depth + 1 :]
                break
        return "".join(f"/{step}" for step in chosen), speaks

    def below(self, paths: list[str]) -> list[str]:
        """The blocks below the containers with these paths, and those directly in what is around such a container."""
        taken, around = [False] * len(self.blocks), set()
        for path in paths:
            inside = [own == path or own.startswith(path + "/") for own, _, _ in self.blocks]
            if any(inside):
                taken = [x or y for x, y in zip(taken, inside, strict=True)]
                around |= {own for own, _, _ in self.blocks if path.startswith(own + "/") and not _root(own)}
        return [text for (own, text, _), take in zip(self.blocks, taken, strict=True) if take or own in around]


def _open(stack: list[tuple[str, str, bool]], tags: set[str], scope: set[str]) -> int | None:
    """Depth of the innermost open element with one of the tags, if none of `scope` is open inside it."""
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] in tags:
            return depth
        if stack[depth][0] in scope:
            return None
    return None


def _root(path: str) -> bool:
    return all(step.partition(".")[0] in ("html", "body") for step in path.split("/")[1:])


def _attribute(attributes: str, *names: str) -> list[str]:
    """Values of the attributes with these whole names."""
    return ["".join(found[1:]) for found in ATTRIBUTE.findall(attributes) if found[0].lower() in names]


def _marked(attributes: str) -> bool:
    if not attributes or not NAMED.search(attributes):
        return False
    return any(_boilerplate(name) for value in _attribute(attributes, "class", "id", "role") for name in value.split())


def _boilerplate(name: str) -> bool:
    words = set(WORD.findall(re.sub("(?<=[a-z])(?=[A-Z])", "-", name).lower()))
    return not DROPPED_WORDS.isdisjoint(words) and words <= DROPPED_WORDS | OTHER_WORDS


def _step(tag: str, attributes: str) -> str:
    values = _attribute(attributes, "class") if attributes and NAMED.search(attributes) else []
    names = sorted(set(re.sub(r"\d+", "#", values[0]).lower().replace("/", "_").split())) if values else []
    return ".".join([tag, *names])


def host_of(url):
    """After the first :// up to /, ? or #, with A-Z lower-cased; NULL or no :// give an empty one."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html).

    A NULL or empty html, or one without blocks, has an empty text. Equal rows vote as often as they occur.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string, vote long").groupBy("host", "path").agg(F.sum("vote").alias("vote"))
    host = Window.partitionBy("host")
    placed = votes.withColumn("place", F.row_number().over(host.orderBy(F.desc("vote"), "path"))).withColumn("all", F.sum("vote").over(host))
    won = placed.where((F.col("place") == 1) | ((F.col("vote") >= PAGES) & (F.col("vote") >= SHARE * F.col("all"))))
    paths = keep(won.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths")))  # 1 / SHARE of a host at most
    if paths.count() <= SMALL:
        paths = F.broadcast(paths)
    schema = rows.select("page_id", "url").schema.simpleString()[len("struct<") : -1]
    fields = ", ".join(x.replace(":", " ", 1) for x in schema.split(","))
    return rows.join(paths, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(_texts, f"{fields}, text string, n_chars long")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], int] = defaultdict(int)
    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            path, speaks = Page(html.as_py() or "").choice()
            if speaks:
                held[host, path] += 1
        if len(held) > 50_000:  # summed again after the shuffle
            yield _counted(held)
            held = defaultdict(int)
    yield _counted(held)


def _counted(held: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(list(held.values()), pa.int64())],
                                      ["host", "path", "vote"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, texts = batch.slice(at, 500), []
            for html, paths in zip(part.column(2), part.column(3), strict=True):
                page = Page(html.as_py() or "")
                own, _ = page.choice()
                found = page.below([path for path in paths.as_py() or () if path == own or not _root(path)]) or page.below([own])
                texts.append("\n".join(found))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])


def op9_pages(spark, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
