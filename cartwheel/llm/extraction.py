"""Main text of HTML pages by wrapper induction.

The pages of a host are aligned by simple tree matching: runs of siblings with
one signature (tag, class, id) count as one node, and the children of matched
nodes are aligned in order so that most nodes match. The merged tree is the
host's wrapper. A node whose text stays the same on all pages is template; the
others are slots, and the slot that holds the article is the main one: the
largest article or main, else the smallest node outside which all text is
template or boilerplate. Wrappers
merge like sums: each task merges its pages, and at most FAN partial wrappers
meet in a task until one is left per host, so a host with a third of all pages
is spread over all tasks and every page counts.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are dropped by element or by a whole token of their class, id or role, scripts
and styles always, and inside the main slot what the wrapper shows to be
template. By a name, or as a form, no element goes that holds an article or, on
most pages, most of what varies (reader comments: all).

Defined results: null or empty html gives an empty text; a null url belongs to
the host ''; equal pages get equal texts; a host with too few pages, or with
nothing that varies, is cut by elements and names alone; other columns are
ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise, of_columns
from cartwheel.llm.dom import RAW, Node, blocks, parse

#: Partial wrappers of a host that are merged in one task.
FAN = 256
HELD_HOSTS = 2_000
#: Pages of a host that must agree before a node inside the article is template.
SAME_PAGES = 5
DEPTH = 40
#: Longer child lists are kept as one run per signature; a wrapper's list keeps this many times four, the commonest.
SIBLINGS = 48
BROADCAST_HOSTS = 50_000
BOILERPLATE = frozenset("nav header footer aside form button input select dialog menu".split())
#: Dropped whatever they hold; a form may be wrapped around a page.
ALWAYS = BOILERPLATE - {"form"}
COMMENTS = frozenset("comment comments replies disqus".split())
HEADINGS = frozenset("header masthead".split())
#: Tokens of class, id or role; one with hyphens counts if all its parts do, or as listed.
NAMES = COMMENTS | HEADINGS | frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsors sponsored promo promos promotion cookie cookies "
    "consent notice notices gdpr popup modal menu nav navbar navigation breadcrumb breadcrumbs sidebar footer newsletter subscribe signup "
    "login complementary contentinfo site-header site-footer site-nav site-navigation main-nav main-menu main-navigation nav-bar top-nav "
    "top-menu side-bar cookie-bar cookie-message ad-slot ad-unit ad-box ad-container ad-wrapper".split())
COMMENT_LISTS = frozenset("comment-list comment-section comments-list comments-section comments-area disqus_thread".split())
ARTICLE = ("article", "main")
WHOLE = frozenset(("#root", "html", "body", *ARTICLE))


@lru_cache(100_000)
def named(names: str) -> frozenset:
    """The boilerplate words among the tokens of ``names``."""
    found: set[str] = set()
    for token in (t.strip("-_") for t in names.split()):
        parts = {p for p in token.replace("_", "-").split("-") if p}
        if token in COMMENT_LISTS:
            found.add("comments")
        elif token in NAMES:
            found.add(token)
        elif parts and parts <= NAMES:
            found |= parts
    return frozenset(found)


def label(node: Node | list) -> tuple[str, str]:
    """Tag and names of a node of a page or of a wrapper."""
    if isinstance(node, Node):
        return node.tag, node.names
    tag, _, names = node[0].partition(".")
    return tag, names


def holds_article(node: Node | list) -> bool:
    todo = [node]
    while todo:
        n = todo.pop()
        for kid in n.children() if isinstance(n, Node) else n[4]:
            tag, names = label(kid)
            if tag in ARTICLE and not named(names) & COMMENTS:
                return True
            todo.append(kid)
    return False


def is_suspect(node: Node | list) -> bool:
    """Whether a name, or being a form, speaks for boilerplate."""
    tag, names = label(node)
    return tag not in WHOLE and (tag == "form" or bool(names and named(names)))


def is_boilerplate(node: Node | list, parent: Node | list | None = None) -> bool:
    tag, names = label(node)
    above = label(parent)[0] if parent is not None else ""
    if tag in WHOLE:  # an article right in an article may be a reader's comment
        return tag == above == "article" and bool(named(names) & COMMENTS)
    if tag == "header" and above in ARTICLE:
        return False  # the article's own heading
    if tag in ALWAYS:
        return True
    if not is_suspect(node) or (above in ARTICLE and tag != "form" and named(names) <= HEADINGS):
        return False
    return not holds_article(node)


# A wrapper node is [signature, pages, text or None where it varies, varying characters, children, is a run].


def own_text(nodes: list[Node]) -> str:
    out = []
    for n in nodes:
        out += [p.strip() for p in n.parts if isinstance(p, str)]
    return " ".join(x for x in out if x)


def skeleton(nodes: list[Node], depth: int = 0) -> list:
    """The wrapper of one page below ``nodes``, equal siblings in a run."""
    text = own_text(nodes) if depth < DEPTH else " ".join(b for n in nodes for b in blocks(n, lambda child, parent: False))
    mark = f"{len(text)}:{hash_of(text)}"
    kids: list[list[Node]] = []
    if depth < DEPTH:
        for child in (c for n in nodes for c in n.children() if c.tag not in RAW and c.tag != "br"):
            if kids and kids[-1][0].signature == child.signature:
                kids[-1].append(child)
            else:
                kids.append([child])
    if len(kids) > SIBLINGS:
        by: dict[str, list[Node]] = {}
        for k in kids:
            by.setdefault(k[0].signature, []).extend(k)
        kids = list(by.values())
    return [nodes[0].signature, 1, mark, len(text), [skeleton(k, depth + 1) for k in kids], len(nodes) > 1]


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def matching(a: list, b: list) -> int:
    """Size of the largest top-down matching of two trees that keeps order."""
    if a[0] != b[0]:
        return 0
    return 1 + aligned(a[4], b[4])[-1][-1]


def aligned(a: list, b: list) -> list[list[int]]:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + (matching(x, y) if x[0] == y[0] else 0))
    return table


def merge(a: list, b: list) -> list:
    """Wrapper of the pages of both; their signatures are the same."""
    x, y = a[4], b[4]
    if [n[0] for n in x] == [n[0] for n in y]:  # aligned as they stand
        kids = [merge(p, q) for p, q in zip(x, y)]
    else:
        table, i, j, kids = aligned(x, y), len(x), len(y), []
        while i or j:
            if i and j and x[i - 1][0] == y[j - 1][0] and table[i][j] == table[i - 1][j - 1] + matching(x[i - 1], y[j - 1]):
                i, j = i - 1, j - 1
                kids.append(merge(x[i], y[j]))
            elif i and table[i][j] == table[i - 1][j]:
                i -= 1
                kids.append(x[i])
            else:
                j -= 1
                kids.append(y[j])
        kids.reverse()
    if len(kids) > 4 * SIBLINGS:  # nodes of few pages are neither template nor main slot
        least = sorted((k[1] for k in kids), reverse=True)[4 * SIBLINGS - 1]
        held = [k for k in kids if k[1] >= least][:4 * SIBLINGS]
        lost = sum(map(all_text, kids)) - sum(map(all_text, held))  # stays as text of the parent that varies
        return [a[0], a[1] + b[1], None, a[3] + b[3] + lost, held, a[5] or b[5]]
    return [a[0], a[1] + b[1], a[2] if a[2] == b[2] else None, a[3] + b[3], kids, a[5] or b[5]]


def all_text(node: list) -> int:
    return node[3] + sum(map(all_text, node[4]))


def is_constant(kid: list, parent: list) -> bool:
    """Whether the own text of ``kid`` is the same on most pages of ``parent``."""
    return kid[2] is not None and not kid[5] and kid[1] >= SAME_PAGES and 2 * kid[1] > parent[1]


def remaining(kid: list, parent: list, kept: set[int]) -> int:
    """Characters in ``kid`` that are neither boilerplate nor template;
    ``kept`` are the ids of nodes that are no boilerplate."""
    if is_boilerplate(kid, parent) and id(kid) not in kept:
        return 0
    return (0 if is_constant(kid, parent) else kid[3]) + sum(remaining(k, kid, kept) for k in kid[4])


def rule_of(wrapper: list) -> dict:
    """{"slot": path of the main slot, "template": paths of constant nodes,
    "keep": paths of nodes that are no boilerplate whatever their name}. A path is the signatures from the root."""
    def volume(node: list) -> int:
        return node[3] * (node[2] is None or node[5] or node[1] < SAME_PAGES) + sum(volume(k) for k in node[4])

    def is_comments(node: list) -> bool:
        return bool(named(label(node)[1]) & COMMENTS)

    def varying(node: list, comments: bool) -> int:
        own = node[3] * (node[2] is None or node[5] or node[1] < SAME_PAGES)
        return own + sum(varying(k, comments) for k in node[4] if label(k)[0] not in ALWAYS and (comments or not is_comments(k)))

    best: tuple[tuple, list[str], list] = ((False, 0, 0), [], wrapper)

    def walk(node: list, path: list[str], parent: list | None, clean: bool) -> None:
        nonlocal best
        tag = label(node)[0]
        if is_boilerplate(node, parent):
            return
        clean = clean and not is_suspect(node)  # rather an article outside of what looks like a sidebar
        size = volume(node)
        here = 2 if tag == "article" else 1 if tag == "main" else 0
        if size and here and (clean, here, size) > best[0]:
            best = ((clean, here, size), path, node)
        for kid in node[4]:
            walk(kid, [*path, kid[0]], node, clean)

    walk(wrapper, [], None, True)
    slot, node = best[1], best[2]
    kept: set[int] = set()
    keep: list[list[str]] = []
    total, plain = varying(node, True), varying(node, False)

    def evidence(n: list, path: list[str]) -> None:
        for kid in n[4]:
            here = [*path, kid[0]]
            if is_boilerplate(kid, n):
                enough = varying(kid, True) == total if is_comments(kid) else 2 * varying(kid, False) > plain
                if label(kid)[0] in ALWAYS or not is_suspect(kid) or kid[1] < SAME_PAGES or 2 * kid[1] <= wrapper[1] or not enough:
                    continue
                kept.add(id(kid))
                keep.append(here)
            evidence(kid, here)
    if total:
        evidence(node, slot)
    if not slot:  # no article: descend while nothing is left out but template and boilerplate
        while True:
            live = [k for k in node[4] if remaining(k, node, kept)]
            own = node[3] and (node is wrapper or not is_constant(node, parent))
            if own or len(live) != 1 or live[0][5]:
                break
            parent, node = node, live[0]
            slot = [*slot, node[0]]
    template: list[list[str]] = []

    def constant(n: list, path: list[str]) -> None:
        for kid in n[4]:
            here = [*path, kid[0]]
            # siblings of one signature share the path
            if kid[3] and not any(remaining(k, n, kept) for k in n[4] if k[0] == kid[0]):
                template.append(here)
            else:
                constant(kid, here)
    if volume(node):
        constant(node, slot)
    return {"slot": slot, "template": template, "keep": keep}


def extract(text: str | None, rule: dict) -> str:
    """Main text of one page under its host's rule."""
    root = parse(text or "")
    template, keep = {tuple(p) for p in rule["template"]}, {tuple(p) for p in rule["keep"]}
    paths: dict[int, tuple] = {id(root): ()}
    found: list[Node] = []
    slot = tuple(rule["slot"])

    def search(node: Node, depth: int) -> None:
        for child in node.children():
            if depth < len(slot) and child.signature == slot[depth]:
                if depth + 1 == len(slot):
                    found.append(child)
                else:
                    search(child, depth + 1)
    if slot:
        search(root, 0)
    elif template or keep:
        found = [root]
    if not found:  # a page unlike the others of its host
        found = first_of(root, "article") or first_of(root, "main") or [root]
        template, keep = set(), set()
    for node in found:
        paths[id(node)] = slot

    def drop(child: Node, parent: Node) -> bool:
        path = (*paths.get(id(parent), ()), child.signature)
        if path not in keep and is_boilerplate(child, parent):
            return True
        paths[id(child)] = path
        return path in template
    return "\n".join(b for node in found for b in blocks(node, drop))


def first_of(root: Node, tag: str) -> list[Node]:
    """The outermost elements of ``tag`` that are not in boilerplate; those in
    what only looks like it if there are no others."""
    for skipped in (lambda n: is_boilerplate(n) or is_suspect(n), is_boilerplate):
        out, todo = [], [root]
        while todo:
            for child in reversed(todo.pop().children()):
                todo.append(child)
            while todo and (todo[-1].tag == tag or skipped(todo[-1])):
                node = todo.pop()
                if not skipped(node):
                    out.append(node)
        if out:
            return out
    return []


def page_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): partial wrappers of each task's pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
                                             names=["host", "wrapper"])
            held.clear()
            return got
        for batch in batches:
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html")):
                page = skeleton([parse(text.as_py() or "")])
                held[host] = merge(held[host], page) if host in held else page
                if len(held) >= HELD_HOSTS:
                    yield out()
        yield out()

    return pages.select("host", "html").mapInArrow(run, "host string, wrapper string")


def merged_wrappers(partial: DataFrame) -> DataFrame:
    """One wrapper per host."""
    def together(group: pd.DataFrame) -> pd.DataFrame:
        trees = [json.loads(w) for w in sorted(group["wrapper"])]
        whole = trees[0]
        for tree in trees[1:]:
            whole = merge(whole, tree)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    while True:
        partial = materialise(partial)
        counts = partial.groupBy("host").agg(F.ceil(F.count("*") / FAN).alias("groups"), F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return partial
        dealt = partial.join(counts.drop("n"), "host").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.col("groups")))
        partial = dealt.groupBy("host", "salt").applyInPandas(together, "host string, wrapper string")


def with_host(pages: DataFrame) -> DataFrame:
    p = of_columns(pages, "page_id", "url", "html")
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return p.withColumn("host", F.lower(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    p = with_host(pages)
    wrappers = materialise(merged_wrappers(page_wrappers(p)))
    rules = wrappers.select(F.col("host").alias("of"), "wrapper")
    n = rules.count()

    def compiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps(rule_of(json.loads(w))) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("of"), pa.array(made, pa.string())], names=["of", "rule"])
    rules = materialise(rules.mapInArrow(compiled, "of string, rule string"))
    both = p.join(F.broadcast(rules) if n <= BROADCAST_HOSTS else rules, p["host"] == rules["of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for text, rule in zip(batch.column("html"), batch.column("rule").to_pylist()):
                if len(known) > HELD_HOSTS:
                    known.clear()
                parsed = known[rule] if rule in known else known.setdefault(rule, json.loads(rule))
                texts.append(extract(text.as_py(), parsed))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    kinds = dict(p.dtypes)
    return both.select("page_id", "url", "html", "rule").mapInArrow(
        run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
