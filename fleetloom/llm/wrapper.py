"""Main text of pages by wrapper induction.

Every page is read into a tree of containers and a list of text blocks. Per host the commonest
tree is the pattern; the other trees of the host are aligned with it by simple tree matching.
Over the different pages of the host (copies count once), a container whose text is nearly always
the same is template, one whose text varies is content; where nothing varies, nothing is template.
The wrapper is the path from the root to the smallest container that holds most
of the varying text; a page's main text are the blocks in it, without templates inside it and
without containers that by their element or name surround an article (menus, adverts, forms,
comments, …). A name that only holds such a word counts unless the container encloses the article.

Pages are counted per (host, tree) before anything is shuffled, so a host that holds a third of
all pages is a few rows when trees are aligned; pages meet their wrapper in a join whose wrapper
side has one row per tree.

Defined results: a null or empty page, or one without text, has an empty text. A page without url
belongs to the host ''. Equal rows, null ids and repeated ids are separate pages. A page whose
tree has no counterpart of the wrapper is judged by its own tree. Only the named key columns and
the results are returned.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.llm.common import written
from fleetloom.llm.dom import Node, is_article, parse, read, tree_match

# A container is template if at least so many different pages have it, and this share of them
# with the same text.
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, 0.9
# The wrapper descends into a child that holds this share of the text that varies; an article or
# main element needs less.
DESCEND_SHARE, ARTICLE_SHARE = 0.8, 0.5

_PARSED = "host string, tree string, blocks array<struct<node int, text string>>, " \
          "nodes array<struct<node int, size long, print long>>"


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url).hostname or "") if url else ""
    except ValueError:
        return ""


def parsed(pages: DataFrame, keys: Sequence[str], html: str = "html", url: str = "url") -> DataFrame:
    """One row per page: host, container tree, blocks, and size and print of each container's own text."""
    schema = T.StructType([*[pages.schema[k] for k in keys], *T.StructType.fromDDL(_PARSED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string())]))
        node = pa.list_(pa.struct([("node", pa.int32()), ("size", pa.int64()), ("print", pa.int64())]))
        for batch in batches:
            hosts, trees, blocks, nodes = [], [], [], []
            for page, address in zip(batch.column("_html").to_pylist(), batch.column("_url").to_pylist()):
                tree, found = read(page or "")
                own: dict[int, list[str]] = defaultdict(list)
                for k, text in found:
                    own[k].append(text)
                hosts.append(host_of(address))
                trees.append(tree)
                blocks.append([{"node": k, "text": t} for k, t in found])
                nodes.append([
                    {"node": k, "size": sum(map(len, v)), "print": zlib.crc32("\n".join(v).encode("utf-8", "replace"))}
                    for k, v in own.items()
                ])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"_k{i}") for i in range(len(keys))], pa.array(hosts, pa.string()),
                 pa.array(trees, pa.string()), pa.array(blocks, block), pa.array(nodes, node)],
                names=schema.names,
            )

    source = pages.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(f"`{html}`").alias("_html"), F.col(f"`{url}`").alias("_url"),
    )
    return source.mapInArrow(run, schema)


def _root(tree: Node, size: dict[int, int], varies: dict[int, bool]) -> int:
    """The number of the smallest container that holds most of the text, varying text if there is any."""
    if not any(size.get(k, 0) for k, v in varies.items() if v):
        varies = dict.fromkeys(size, True)

    def mass(node: Node) -> int:
        if node.around:
            return 0
        own = size.get(node.id, 0) if varies.get(node.id) else 0
        return own + sum(map(mass, node.children))

    node = tree
    while not is_article(node) or not mass(node):
        inside = max(node.children, key=mass, default=None)
        if inside is None or not mass(inside):
            break
        if mass(inside) < (ARTICLE_SHARE if is_article(inside) else DESCEND_SHARE) * mass(node):
            break
        node = inside
    return node.id


def _below(tree: Node, root: int) -> list[int]:
    """Numbers of the container ``root`` and of those in it that do not surround an article."""
    found: list[int] = []

    def walk(node: Node, inside: bool) -> None:
        inside = inside or node.id == root
        if inside and not node.around:
            found.append(node.id)
        if not (inside and node.around):
            for c in node.children:
                walk(c, inside)

    walk(tree, False)
    return found


def _aligned(trees: DataFrame) -> DataFrame:
    """(host, tree, pattern, nodes) → the counterpart in the pattern for each container."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for host, tree, pattern in zip(frame["host"], frame["tree"], frame["pattern"]):
                for own, slot in tree_match(parse(tree), parse(pattern))[1]:
                    out.append((host, tree, pattern, own, slot))
            yield pd.DataFrame(out, columns=["host", "tree", "pattern", "node", "slot"])

    return trees.mapInPandas(run, "host string, tree string, pattern string, node int, slot int")


def _chosen(slots: DataFrame) -> DataFrame:
    """(host, pattern, slots) → the content container of the pattern and its templates."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for host, pattern, slots in zip(frame["host"], frame["pattern"], frame["slots"]):
                varies = {
                    s["slot"]: s["pages"] < TEMPLATE_PAGES or s["commonest"] < TEMPLATE_SHARE * s["pages"] for s in slots
                }
                root = _root(parse(pattern), {s["slot"]: s["size"] for s in slots}, varies)
                templates = [k for k, v in varies.items() if not v and k != root] if any(varies.values()) else []
                out.append((host, root, templates))
            yield pd.DataFrame(out, columns=["host", "root", "templates"])

    return slots.mapInPandas(run, "host string, root int, templates array<int>")


def wrappers(pages: DataFrame) -> DataFrame:
    """For each (host, tree) the numbers of the containers whose blocks are main text."""
    # Copies of a page tell nothing about its host.
    pages = pages.select("host", "tree", "nodes", F.xxhash64("host", "tree").alias("t"), F.xxhash64("blocks").alias("page"))
    different = written(pages.dropDuplicates(["t", "page"]))
    trees = written(different.groupBy("t").agg(
        F.min("host").alias("host"), F.min("tree").alias("tree"), F.count(F.lit(1)).alias("pages")))
    prints = written(
        different.select("t", F.explode("nodes").alias("n")).groupBy("t", "n.node", "n.print")
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("n.size").alias("size"))
    )
    pattern = trees.groupBy("host").agg(F.max_by("tree", F.struct("pages", "tree")).alias("pattern"))
    aligned = written(_aligned(trees.join(pattern, "host").select("host", "tree", "pattern")))
    named = aligned.withColumn("t", F.xxhash64("host", "tree"))
    slots = (
        named.select("t", "node", "host", "pattern", "slot").join(prints, ["t", "node"])
        .groupBy("host", "pattern", "slot", "print").agg(F.sum("pages").alias("pages"), F.sum("size").alias("size"))
        .groupBy("host", "pattern", "slot").agg(
            F.sum("pages").alias("pages"), F.sum("size").alias("size"), F.max("pages").alias("commonest"))
    )
    # As many entries per host as its pattern has containers.
    per_host = slots.groupBy("host", "pattern").agg(
        F.collect_list(F.struct("slot", "pages", "size", "commonest")).alias("slots")
    )
    chosen = _chosen(per_host)
    sizes = prints.groupBy("t", "node").agg(F.sum("size").alias("size"))
    own = sizes.groupBy("t").agg(F.collect_list(F.struct("node", "size")).alias("own")).join(trees, "t").drop("t", "pages")
    pairs = aligned.groupBy("host", "tree").agg(F.collect_list(F.struct("node", "slot")).alias("pairs"))
    joined = own.join(pairs, ["host", "tree"], "left").join(chosen, "host", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                tree = parse(r.tree)
                pairs = [] if r.pairs is None else r.pairs
                root = next((p["node"] for p in pairs if p["slot"] == r.root), None)
                if root is None:
                    size = {n["node"]: n["size"] for n in r.own}
                    root = _root(tree, size, dict.fromkeys(size, True))
                templates = set() if r.templates is None else set(r.templates)
                without = {p["node"] for p in pairs if p["slot"] in templates}
                out.append((r.host, r.tree, [k for k in _below(tree, root) if k not in without or k == root]))
            yield pd.DataFrame(out, columns=["host", "tree", "content"])

    return joined.select("host", "tree", "own", "pairs", "root", "templates").mapInPandas(
        run, "host string, tree string, content array<int>"
    )


def main_text(pages: DataFrame, keys: Sequence[str], html: str = "html", url: str = "url") -> DataFrame:
    """The key columns, ``text`` (blocks joined by one space) and ``n_chars``."""
    read_pages = written(parsed(pages, keys, html, url))
    content = written(wrappers(read_pages))
    text = F.array_join(F.transform(
        F.filter("blocks", lambda b: F.array_contains("content", b["node"])), lambda b: b["text"]
    ), " ")
    return (
        read_pages.select(*keys, "host", "tree", "blocks").join(content, ["host", "tree"], "left")
        .select(*keys, F.coalesce(text, F.lit("")).alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
