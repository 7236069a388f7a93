"""Pages of HTML and prose: table grids, text blocks, payloads, numbers."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.scalars import clean_space, plain_number, scaled_number
from factloom.sources.delimited import LINE_BREAK

# --- fixed values -----------------------------------------------------------
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li")
NUMBER_MENTION = (
    r"(?iU)(?<![\w.])[£$€]?-?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
    r"(?:\s*(?:thousand|million|billion)|bn)?(?![\w.])"
)
# ----------------------------------------------------------------------------

PIECES = (
    "kind string, sheet bigint, row bigint, col bigint, tag string, text string"
)


# A page is a stream of events, one letter each: T t top-level table, R r row of
# it, C c cell, B line break, A-H a-h the block tags outside tables, x anything
# else.  What the page holds is then found by patterns over the letters.
_TABLE = re.compile("T[^t]*t")
_ROW = re.compile("R[^Rr]*r")
_CELL = re.compile("C[^Cc]*c")
_INSIDE_TABLE = re.compile("T[^t]*(?:t|$)")
_OPEN = dict(zip(BLOCK_TAGS, "ADEFGHIJ"))
_BLOCK = re.compile(
    "|".join(f"{mark}[^{mark.lower()}]*(?:{mark.lower()}|$)" for mark in _OPEN.values())
)
_MARKED = {mark: tag for tag, mark in _OPEN.items()}


class _Events(HTMLParser):
    """The letters of a page, with the text and the column span of each."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.letters, self.texts, self.spans, self.nested = [], [], [], 0
        self.feed(html)
        self.close()

    def note(self, letter: str, text: str = "", span: int = 1) -> None:
        self.letters.append(letter)
        self.texts.append(text)
        self.spans.append(span)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.nested += 1
        inside = self.nested > 0
        if tag in ("td", "th") and inside:
            wide = (dict(attrs).get("colspan") or "").strip()
            self.note("C", span=max(1, int(wide)) if wide.isdigit() else 1)
        elif tag == "br":
            self.note("B", " ")
        elif self.nested == 1 and tag in ("table", "tr"):
            self.note("T" if tag == "table" else "R")
        elif not inside and tag in _OPEN:
            self.note(_OPEN[tag])

    def handle_endtag(self, tag):
        if tag == "table" and self.nested:
            self.nested -= 1
            self.note("x" if self.nested else "t")
        elif self.nested:
            self.note({"tr": "r", "td": "c", "th": "c"}.get(tag, "x"))
        elif tag in _OPEN:
            self.note(_OPEN[tag].lower())

    def handle_data(self, data):
        self.note("x", data)


def _plain(parts: Sequence[str]) -> str:
    return " ".join("".join(parts).split())


def _pieces(html: str) -> Iterator[tuple]:
    """(kind, sheet, row, col, tag, text) of one page."""
    events = _Events(html)
    letters, texts = "".join(events.letters), events.texts
    for sheet, table in enumerate(_TABLE.finditer(letters), 1):
        grid = []
        for row in _ROW.finditer(letters, *table.span()):
            cells = [m.span() for m in _CELL.finditer(letters, *row.span())]
            grid.append([_plain(texts[a:b]) for a, b in cells for _ in range(events.spans[a])])
        filled = [(r, c) for r, line in enumerate(grid, 1) for c, t in enumerate(line, 1) if t]
        height, width = (max(x, default=0) for x in (zip(*filled) if filled else ((), ())))
        for r, line in enumerate(grid[:height], 1):
            padded = (line + [""] * width)[:width]
            for c, text in enumerate(padded, 1):
                yield "cell", sheet, r, c, None, text or None
    outside = [i for a, b in _gaps(letters) for i in range(a, b)]
    flow = "".join(letters[i] for i in outside)
    index = 0
    for block in _BLOCK.finditer(flow):
        mark = block[0][0]
        text = _plain([texts[i] for i in outside[block.start() : block.end()]])
        if text and block[0][-1] == mark.lower():
            index += 1
            yield "block", None, index, None, _MARKED[mark], text


def _gaps(letters: str) -> Iterator[tuple[int, int]]:
    """Stretches of events outside tables."""
    at = 0
    for table in _INSIDE_TABLE.finditer(letters):
        yield at, table.start()
        at = table.end()
    yield at, len(letters)


def page_pieces(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Cells of top-level tables and text blocks of every page.

    HTML has no column expression, so each Arrow batch of pages goes through
    the standard parser; pages are independent and nothing is shuffled.
    ``kind`` is ``cell`` (sheet, row, col) or ``block`` (row is its index).
    """
    names = [page_id, "kind", "sheet", "row", "col", "tag", "text"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = (
                (key, *piece)
                for key, body in zip(batch[page_id], batch[html])
                for piece in _pieces(body or "")
            )
            while rows := list(islice(found, 100_000)):
                out = pd.DataFrame(rows, columns=names)
                numbers = ["sheet", "row", "col"]
                out[numbers] = out[numbers].astype("Int64")
                yield out

    schema = f"{page_id} {dict(pages.dtypes)[page_id]}, {PIECES}"
    return pages.select(page_id, html).mapInPandas(parse, schema)


def page_cells(pieces: DataFrame) -> DataFrame:
    """Table cells with their number where the text is one."""
    return (
        pieces.filter("kind = 'cell'")
        .drop("kind", "tag")
        .withColumn("num", plain_number(F.col("text")))
    )


def page_blocks(pieces: DataFrame) -> DataFrame:
    return (
        pieces.filter("kind = 'block'")
        .drop("kind", "sheet", "col")
        .withColumnRenamed("row", "element_index")
    )


def number_mentions(rows: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """One row per number in a text, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit(NUMBER_MENTION), F.lit(0))
    return rows.select(*keep, F.posexplode(found).alias("_pos", "number_text")).select(
        *keep,
        (F.col("_pos") + 1).alias("mention"),
        "number_text",
        scaled_number(F.col("number_text")).alias("value"),
    )


def context_lines(
    docs: DataFrame, keep: Sequence[str], text: str, reach: int = 2
) -> DataFrame:
    """Non-blank lines with the ``reach`` lines before and after them.

    The lines of a document are one array, so the frame is a slice of it and
    needs no shuffle or sort.
    """
    numbered = F.filter(
        F.transform(
            F.split(text, LINE_BREAK),
            lambda line, i: F.struct(
                (i + 1).cast("bigint").alias("line_number"),
                clean_space(line).alias("line"),
            ),
        ),
        lambda item: item["line"] != "",
    )
    lines = docs.select(*keep, numbered.alias("_lines"))

    def with_context(item: Column, i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0)) + 1
        near = F.slice("_lines", first, i + reach + 2 - first)
        context = F.array_join(F.transform(near, lambda n: n["line"]), " ")
        return F.struct(item["line_number"], item["line"], context.alias("context"))

    return lines.select(*keep, F.inline(F.transform("_lines", with_context)))


def payload(pages: DataFrame, keep: Sequence[str], html: str, pattern: str) -> DataFrame:
    """Embedded payload text by pattern; null with an issue where missing."""
    found = F.regexp_extract(html, pattern, 1)
    return pages.select(
        *keep,
        F.when(found != "", found).alias("payload"),
        F.when(found == "", "missing_payload").alias("issue"),
    )
