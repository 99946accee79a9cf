"""A tolerant HTML tree on the standard library, and the progressive reduction of pages.

Sizes are measured on this module's own serialisation, so they are consistent within a run; they are not
another library's.  Reduction runs page by page in Arrow batches: the tree is the one thing here that array
functions cannot express.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.text import url_host

#: Sizes in characters, strategies and content containers by host.
TARGET_SIZE, MIN_SIZE = 30_000, 6_000
STRATEGIES = {
    "barnesbullets.com": "main_content",
    "www.nosler.com": "main_content",
    "bergerbullets.com": "main_content",
    "www.swiftbullets.com": "main_content",
    "cuttingedgebullets.com": "main_content",
    "lehighdefense.com": "main_content",
    "www.norma-ammunition.com": "jsonld_only",
}
CONTAINERS = {"cuttingedgebullets.com": (None, "main"), "lehighdefense.com": ("main", "maincontent")}
#: What marks tracking scripts, data scripts, attributes to keep, and class words of page furniture.
TRACKING = re.compile(
    r"google.analytics|googletagmanager|gtag\s*\(|fbq\s*\(|facebook\.net|rdt\s*\(|redditstatic|dataLayer\.push|hotjar|hj\s*\(|_satellite|_tealium"
    r"|adsbygoogle|googlesyndication|doubleclick\.net|amplitude\.getInstance|mixpanel\.track|segment\.com|analytics\.js|tiktok\.com/i18n"
    r"|pinterest.*pinit|klaviyo|optimizely|snaptr\s*\(|snap\.licdn",
    re.IGNORECASE,
)
DATA_IDS = ("__next_data__", "__nuxt_data__", "__gatsby_data__", "__remix_data__")
KEPT_ATTRIBUTES = {"href", "alt", "title", "type", "content", "name", "value", "property", "rel"}
WIDGET_WORDS = ("social", "cookie", "popup", "modal", "newsletter", "subscribe", "advertisement")
SIDEBAR_WORDS = ("sidebar", "related", "recommend")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style"}
JSON_KEY = re.compile(r'"[a-zA-Z_]\w*"\s*:')


class Node:
    """An element (name, attributes, children), or a text, comment or declaration (kind, value)."""

    __slots__ = ("attributes", "children", "kind", "name", "parent", "value")

    def __init__(self, kind: str, name: str = "", value: str = "", attributes: dict | None = None) -> None:
        self.kind, self.name, self.value, self.attributes = kind, name, value, attributes or {}
        self.children: list[Node] = []
        self.parent: Node | None = None

    def add(self, node: "Node") -> None:
        node.parent = self
        self.children.append(node)

    def walk(self) -> Iterator["Node"]:
        todo = list(reversed(self.children))
        while todo:
            node = todo.pop()
            yield node
            todo += reversed(node.children)

    def elements(self) -> list["Node"]:
        return [n for n in self.walk() if n.kind == "element"]

    def remove(self) -> None:
        if self.parent:
            self.parent.children.remove(self)
            self.parent = None

    def replace(self, *nodes: "Node") -> None:
        parent = self.parent
        at = parent.children.index(self)
        parent.children[at : at + 1] = nodes
        for n in nodes:
            n.parent = parent
        self.parent = None

    def text(self) -> str:
        return "".join(n.value for n in self.walk() if n.kind == "text")

    def html(self) -> str:
        out: list[str] = []
        todo: list = [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.kind == "text":
                out.append(n.value if n.parent is not None and n.parent.name in RAW else escape(n.value, quote=False))
            elif n.kind == "comment":
                out.append(f"<!--{n.value}-->")
            elif n.kind == "declaration":
                out.append(f"<!{n.value}>")
            else:
                if n.name:
                    out.append("<" + n.name + "".join(f' {k}="{escape(v or "")}"' for k, v in n.attributes.items()) + ">")
                    if n.name not in VOID:
                        todo.append(f"</{n.name}>")
                todo += reversed(n.children)
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("element")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("p", "li", "tr", "td", "th", "option") and self.open[-1].name == tag:
            self.open.pop()
        node = Node("element", tag, attributes=dict(attrs))
        self.open[-1].add(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].add(Node("element", tag, attributes=dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].add(Node("text", value=data))

    def handle_comment(self, data: str) -> None:
        self.open[-1].add(Node("comment", value=data))

    def handle_decl(self, decl: str) -> None:
        self.open[-1].add(Node("declaration", value=decl))


def tree(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _drop(root: Node, told: Callable[[Node], bool]) -> None:
    for n in root.elements():
        if n.name not in ("body", "html") and n.parent is not None and told(n):
            n.remove()


def _class_word(n: Node, words: tuple[str, ...]) -> bool:
    """Whether a class has one of the words as a whole hyphen-separated part."""
    return any(part in words for c in (n.attributes.get("class") or "").lower().split() for part in c.split("-"))


def _compact(text: str) -> str:
    try:
        return json.dumps(json.loads(text), separators=(",", ":"))
    except ValueError:
        return text


def _is_jsonld(n: Node) -> bool:
    return n.name == "script" and (n.attributes.get("type") or "").lower() == "application/ld+json"


def _scripts(root: Node) -> None:
    for n in root.elements():
        if n.name != "script":
            continue
        text = n.text()
        data = _is_jsonld(n) or len(JSON_KEY.findall(text[:2000])) >= 3 or (n.attributes.get("id") or "").lower() in DATA_IDS
        if n.attributes.get("src") or not data and (TRACKING.search(text[:3000]) or len(text) < 500):
            n.remove()
        else:
            body = _compact(text.strip()) if _is_jsonld(n) else text.strip()
            n.replace(Node("text", value="\n"), Node("comment", value=f" DATA: {body} "), Node("text", value="\n"))


def _comments(root: Node) -> None:
    for n in list(root.walk()):
        if n.kind == "comment" and not n.value.strip().startswith("DATA:"):
            n.remove()


def _images(root: Node) -> None:
    for n in root.elements():
        if n.name == "img":
            alt = n.attributes.get("alt")
            n.replace(*[Node("text", value=f"[image: {alt}]")] * bool(alt))


def _attributes(root: Node, keep: set[str]) -> None:
    for n in root.elements():
        n.attributes = {k: v for k, v in n.attributes.items() if k in keep}


def _empty(root: Node) -> None:
    changed = True
    while changed:
        changed = False
        for n in reversed(root.elements()):
            if n.parent is not None and n.name not in ("br", "hr") and not n.text().strip():
                n.remove()
                changed = True


def _unwrap(root: Node) -> None:
    for n in reversed(root.elements()):
        if n.name in ("div", "span"):
            n.replace(*n.children)


#: The steps in order; each is followed by a look at the size.
STEPS: list[tuple[str, Callable[[Node], None]]] = [
    ("remove_styles", lambda r: _drop(r, lambda n: n.name == "style" or n.name == "link" and "stylesheet" in (n.attributes.get("rel") or "").split())),
    ("smart_remove_scripts", _scripts),
    ("remove_noscript", lambda r: _drop(r, lambda n: n.name == "noscript")),
    ("remove_comments", _comments),
    ("remove_nav_chrome", lambda r: _drop(r, lambda n: n.name in ("nav", "header", "footer") or n.attributes.get("role") in ("navigation", "banner", "contentinfo"))),
    ("remove_widgets", lambda r: _drop(r, lambda n: n.name == "iframe" or bool({"social-share", "share-buttons"} & set((n.attributes.get("class") or "").split())) or _class_word(n, WIDGET_WORDS))),
    ("replace_images", _images),
    ("remove_svgs", lambda r: _drop(r, lambda n: n.name == "svg")),
    ("strip_attrs", lambda r: _attributes(r, KEPT_ATTRIBUTES)),
    ("remove_sidebars", lambda r: _drop(r, lambda n: n.name == "aside" or _class_word(n, SIDEBAR_WORDS))),
    ("remove_forms", lambda r: _drop(r, lambda n: n.name == "form")),
    ("flatten_empty", _empty),
    ("strip_all_attrs", lambda r: _attributes(r, set())),
    ("unwrap_containers", _unwrap),
]


def _collapsed(html: str) -> str:
    return re.sub(r"[ \t]+", " ", re.sub(r"\n\s*\n+", "\n", html)).strip()


def _finished(root: Node, original: int, steps: list[dict], target: int, strategy: str) -> tuple[str, dict]:
    html = _collapsed(root.html())
    size = len(html)
    return html, {"original_size": original, "reduced_size": size, "reduction_ratio": round(size / original, 3) if original else 0.0, "steps_applied": len(steps), "steps": steps, "under_target": size <= target, "strategy_used": strategy}


def _generic(html: str, target: int, strategy: str) -> tuple[str, dict]:
    root, steps = tree(html), []
    size = len(root.html())
    for name, apply in STEPS:
        apply(root)
        after = len(root.html())
        steps.append({"step": name, "before": size, "after": after, "removed": size - after})
        size = after
        if size <= target:
            break
    return _finished(root, len(html), steps, target, strategy)


def reduce_html(html: str, host: str | None = None, target: int = TARGET_SIZE, least: int = MIN_SIZE) -> tuple[str, dict]:
    """The page reduced by its host's strategy, and what was done to it."""
    strategy = STRATEGIES.get(host or "", "generic")
    if strategy == "generic":
        return _generic(html, target, "generic")
    root = tree(html)
    data = [f"<!-- DATA: {_compact(n.text().strip())} -->" for n in root.elements() if _is_jsonld(n)]
    if strategy == "main_content":
        name, own_id = CONTAINERS.get(host, ("main", None))
        box = next((n for n in root.elements() if (name is None or n.name == name) and (own_id is None or n.attributes.get("id") == own_id)), None)
        page = "" if box is None else "<html><body>\n" + "\n".join(data) + f"\n{box.html()}\n</body></html>"
        return _generic(page, target, "main_content") if len(page) >= least else _generic(html, target, "main_content_fallback")
    if not data:
        return _generic(html, target, "jsonld_only_fallback")
    title = next((n.text().strip() for n in root.elements() if n.name == "title"), "")
    metas = []
    for n in root.elements():
        name, prop, content = ((n.attributes.get(k) or "") for k in ("name", "property", "content"))
        if n.name == "meta" and content and (name.lower() == "description" or prop.lower().startswith("og:")):
            metas.append(f"<p>{name.lower() or prop.lower()}: {content}</p>")
    page = f"<html><head><title>{title}</title></head>\n<body>\n" + "\n".join(metas) + "\n" + "\n".join(data) + "\n</body></html>"
    return _finished(tree(page), len(html), [], target, "jsonld_only")


REDUCED = (
    "reduced_html string, original_size int, reduced_size int, reduction_ratio double, steps_applied int, "
    "steps array<struct<step:string,before:int,after:int,removed:int>>, under_target boolean, strategy_used string"
)


def reduced_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", target: int = TARGET_SIZE, least: int = MIN_SIZE) -> DataFrame:
    """pages' keys with the reduced page and its figures; a null page is an empty one."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [reduce_html(h or "", s, target, least) for h, s in zip(b["html"], b["host"], strict=True)]
            yield pd.DataFrame([{"key": k, "reduced_html": h, **m} for k, (h, m) in zip(b["key"], out, strict=True)], columns=["key", "reduced_html", "original_size", "reduced_size", "reduction_ratio", "steps_applied", "steps", "under_target", "strategy_used"])

    kind = dict(pages.dtypes)[key]
    rows = pages.select(F.col(key).alias("key"), url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    return rows.mapInPandas(work, f"key {kind}, {REDUCED}").withColumnRenamed("key", key)


def step_summary(reduced: DataFrame) -> DataFrame:
    """By strategy and step: pages, and characters removed."""
    each = reduced.select("strategy_used", F.explode("steps").alias("s"))
    return each.groupBy("strategy_used", F.col("s.step").alias("step")).agg(F.count("*").alias("pages"), F.sum("s.removed").alias("removed"))
