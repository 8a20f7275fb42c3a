"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of blocks: stretches of text between block-level tags. Each block has
its word count, link density and enclosing kind of region, and the counts and densities of its
neighbours. A small decision tree, trained at start-up on the labelled table below, says which
blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare

BLOCK_TAGS = set("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = set("script style noscript template svg iframe object head title textarea select option button input canvas audio video math".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a tag's name, class, id or role that mark what it holds as apart from the main text.
APART = re.compile(r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|banner|footer|sidebar|side|aside|widget|related|recommended|ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|search|form|share|social|comments?|disqus|replies|reply|complementary|contentinfo)(?:$|[\s_-])", re.I)
APART_TAGS = set("nav header footer aside form menu dialog fieldset".split())
MAIN_TAGS = {"article", "main"}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WHITE = re.compile(r"\s+")

#: Labelled blocks: words, link density, words before, density before, words after, density after,
#: region (0 none, 1 article or main, 2 apart), then 1 for main text.
LABELLED = """
6 1.0 0 0.0 8 0.9 2 0 | 1 1.0 1 1.0 1 1.0 2 0 | 12 0.0 6 1.0 8 0.0 2 0 | 8 0.0 12 0.0 120 0.0 1 1 | 120 0.0 8 0.0 60 0.0 1 1
1 0.0 60 0.0 44 0.0 1 1 | 60 0.05 120 0.0 1 0.0 1 1 | 2 0.0 1 0.0 9 0.0 1 1 | 9 0.0 80 0.0 0 0.0 2 0 | 14 0.1 70 0.0 0 0.0 2 0
3 1.0 3 1.0 3 1.0 0 0 | 4 0.9 60 0.0 5 1.0 0 0 | 5 1.0 4 0.9 0 0.0 0 0 | 45 0.02 30 0.0 50 0.0 0 1 | 30 0.0 8 0.0 45 0.0 0 1
22 0.0 45 0.0 30 0.1 0 1 | 8 0.0 3 1.0 30 0.0 0 1 | 40 0.0 30 0.0 20 0.0 2 0 | 70 0.0 10 0.0 12 0.0 2 0 | 25 0.8 20 0.7 20 0.9 0 0
18 0.6 4 1.0 5 1.0 0 0 | 3 0.0 2 1.0 2 1.0 0 0 | 2 0.0 1 1.0 0 0.0 0 0 | 5 0.2 60 0.0 70 0.0 1 1 | 3 1.0 90 0.0 80 0.0 1 1
10 0.9 20 0.0 20 0.0 1 1 | 250 0.0 0 0.0 0 0.0 0 1 | 15 0.0 0 0.0 0 0.0 0 1 | 1 0.0 0 0.0 200 0.0 1 1 | 4 0.0 40 0.0 3 0.0 1 1
7 0.0 2 1.0 3 1.0 2 0 | 100 0.0 5 0.0 5 0.0 2 0 | 2 0.5 5 1.0 4 1.0 0 0 | 12 0.0 40 0.0 35 0.0 0 1 | 6 0.0 0 0.0 0 0.0 1 1
1 0.0 1 0.0 1 0.0 1 1 | 6 0.0 6 1.0 60 0.0 0 1 | 9 0.0 50 0.0 2 1.0 0 1 | 11 1.0 9 0.0 0 0.0 1 1 | 35 0.3 30 0.2 40 0.1 0 1
"""


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows = np.array([[float(x) for x in cell.split()] for line in LABELLED.strip().splitlines() for cell in line.split("|")])
    return rows[:, :-1], rows[:, -1].astype(int)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> tuple:
    """Binary decision tree by Gini impurity: (feature, limit, low, high) or (None, answer)."""
    if depth == 0 or y.min() == y.max():
        return (None, int(2 * y.sum() >= len(y)))
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= limit
            score = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (low, ~low))
            if best is None or score < best[0] - 1e-12:
                best = (score, k, float(limit))
    if best is None:
        return (None, int(2 * y.sum() >= len(y)))
    _, k, limit = best
    low = x[:, k] <= limit
    return (k, limit, train_tree(x[low], y[low], depth - 1), train_tree(x[~low], y[~low], depth - 1))


def classify(tree: tuple, row: tuple) -> int:
    while tree[0] is not None:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[1]


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, linked words, region) of each block in page order."""
    out: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int]] = []  # open tags with the region they make: 0 none, 1 main, 2 apart
    apart = main = link = 0
    pieces: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if pieces:
            text = WHITE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                words = text.count(" ") + 1
                out.append((text, words, min(words, linked), 2 if apart else 1 if main else 0))
            pieces.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        raw = page[at : found.start() if found else end]
        if raw:
            pieces.append(raw)
            if link:
                linked += len(raw.split())
        if not found:
            break
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        closing = found.group(1) == "/"
        if name in DROPPED and not closing:
            if name not in VOID and not found.group(3).endswith("/"):
                gone = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if gone:
                    at = gone.end()
                elif name in ("script", "style"):
                    at = end
            continue
        if name in BLOCK_TAGS:
            close()
        if name in VOID:
            continue
        if not closing:
            if name == "a":
                link += 1
                continue
            kind = 0
            if name in APART_TAGS and not (name == "header" and main and not apart):
                kind = 2
            elif name in MAIN_TAGS:
                kind = 1
            if kind == 0 and name in BLOCK_TAGS and name not in ("body", "html") and found.group(3):
                marks = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(found.group(3)))
                if marks and APART.search(marks):
                    kind = 2
            if name in BLOCK_TAGS or kind:
                stack.append((name, kind))
                apart += kind == 2
                main += kind == 1
        elif name == "a":
            link = max(0, link - 1)
        elif any(n == name for n, _ in stack):
            while stack:
                n, kind = stack.pop()
                apart -= kind == 2
                main -= kind == 1
                if n == name:
                    break
    close()
    return out


def main_text(page: str, tree: tuple) -> str:
    found = blocks(page)
    words = [0, *(b[1] for b in found), 0]
    density = [0.0, *(b[2] / b[1] for b in found), 0.0]
    return "\n".join(
        b[0] for k, b in enumerate(found, 1)
        if classify(tree, (words[k], density[k], words[k - 1], density[k - 1], words[k + 1], density[k + 1], b[3]))
    )


def _extract(tree: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x or "", tree) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``. A null html is empty; a page without
    main text has the empty text. Repeated rows give repeated results; other columns are not read."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(train_tree(*labelled_table())), "page_id long, url string, text string, n_chars long")
