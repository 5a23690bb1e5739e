"""Rows of an HTML table inside landed pages (S6), with built-in regexes.

A page is one string column; the table is found by its ``id``, rows by
``<tr>``, cells by ``<td>``/``<th>``. The first row is the header; each later
row becomes a map header → cell text, from which named columns are taken.
A table inside a cell is part of the cell's text; a cell with a ``rowspan``
stands in the rows below it too.
Everything is per row of the pages table, so pages are spread over tasks
and no page passes through the driver.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainrisk.sources.sinks import rebalanced

# --- fixed values (must equal the reference's page layout) -------------------
RAIN_TABLE_ID = "tbMonPluvio"
# -----------------------------------------------------------------------------

# Named character references, built from the standard library's HTML 4 table
# (252 names); ``&amp;`` is decoded last so that "&amp;lt;" becomes "&lt;".
_NAMED = {k: chr(v) for k, v in name2codepoint.items() if k != "amp"}
_NAME_RE = r"&([A-Za-z][A-Za-z0-9]{1,31});"
_NUMERIC_RE = r"&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"

_ROW_RE = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
_CELL_RE = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"
_CELL_TAG_RE = r"(?is)<t[dh]\b([^>]*)>.*?</t[dh]\s*>"
_SPAN_RE = r"(?i)\b{}\s*=\s*[\"']?\s*([0-9]{{1,6}})"
# HTML's limits of a span
_MOST = {"colspan": 1000, "rowspan": 65534}


def _table_start(table_id: str) -> str:
    return r"(?is)<table(?:\s[^>]*)?\sid\s*=\s*[\"']?" + re.escape(table_id) + r"[\"']?(?:\s[^>]*)?>"


def _paired_body(html: Column, table_id: str) -> Column:
    """What lies between the tags of a table with others inside, empty if it
    has no end tag: the text is cut before each table tag, and the pieces are
    folded with the depth they lie at; of the inner tables the text without
    its markup stays."""
    pieces = F.split(F.regexp_extract(html, _table_start(table_id) + "(.*)", 1), r"(?i)(?=</?table\b)")

    def step(acc: Column, piece: Column) -> Column:
        change = F.when(piece.rlike(r"(?i)^</table\b"), -1).when(piece.rlike(r"(?i)^<table\b"), 1).otherwise(0)
        depth = F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(0)
        part = F.when(depth > 1, F.regexp_replace(piece, "<[^>]*>", "")).otherwise(piece)
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.array_append(acc["kept"], part)).otherwise(acc["kept"]).alias("kept"))

    return F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.array().cast("array<string>").alias("kept")), step,
                       lambda acc: F.when(acc["depth"] == 0, F.array_join(acc["kept"], "")).otherwise(""))


# white space stripped from cell ends (a decoded &nbsp; included)
_WS = " \t\n\r\f\u000b\u00a0"


def _codepoint_char(ref: Column) -> Column:
    """'233' or 'xE9' → the character (decoded from its UTF-32 bytes)."""
    hexdigits = F.when(F.lower(F.substring(ref, 1, 1)) == "x", F.substring(ref, 2, 8)) \
        .otherwise(F.conv(ref, 10, 16))
    return F.decode(F.unhex(F.lpad(hexdigits, 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Numeric and HTML 4 named character references decoded, as an HTML
    parser does. Only the references present in the text are folded over
    (``aggregate`` on the extracted names), so the name table is consulted
    once per reference found, never for text without any."""
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(_NUMERIC_RE), 1))
    t = F.aggregate(refs, c, lambda acc, r: F.replace(
        acc, F.concat(F.lit("&#"), r, F.lit(";")), _codepoint_char(r)))
    table = F.create_map(*[x for k, v in sorted(_NAMED.items()) for x in (F.lit(k), F.lit(v))])
    names = F.array_distinct(F.regexp_extract_all(t, F.lit(_NAME_RE), 1))
    t = F.aggregate(names, t, lambda acc, nm: F.replace(
        acc, F.concat(F.lit("&"), nm, F.lit(";")),
        F.coalesce(F.try_element_at(table, nm), F.concat(F.lit("&"), nm, F.lit(";")))))
    return F.replace(t, F.lit("&amp;"), F.lit("&"))


def cell_text(c: Column, decode: bool = True) -> Column:
    """Markup inside a cell removed, character references decoded (unless
    ``decode`` is off), ends trimmed."""
    t = F.when(F.instr(c, "<") > 0, F.regexp_replace(c, r"<[^>]*>", "")).otherwise(c)
    if decode:
        t = F.when(F.instr(t, "&") > 0, decode_entities(t)).otherwise(t)
    return F.btrim(t, F.lit(_WS))


def _clean_cells(raw_cells: Column, row_html: Column) -> Column:
    # the choice is made per row, outside the per-cell loop: rows without any
    # '&' (nearly all) take the loop without the reference decoding
    # (one-argument lambdas: Spark reads a second parameter as the index)
    return F.when(F.instr(row_html, "&") > 0, F.transform(raw_cells, lambda c: cell_text(c))) \
        .otherwise(F.transform(raw_cells, lambda c: cell_text(c, decode=False)))


def _span(attributes: Column, kind: str) -> Column:
    n = F.regexp_extract(attributes, _SPAN_RE.format(kind), 1).try_cast("int")
    return F.least(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)), F.lit(_MOST[kind]))


def _raw_cells(row_html: Column) -> Column:
    """Cells of a row; one with a ``colspan`` fills so many places."""
    plain = F.regexp_extract_all(row_html, F.lit(_CELL_RE), 1)
    spans = F.transform(F.regexp_extract_all(row_html, F.lit(_CELL_TAG_RE), 1), lambda t: _span(t, "colspan"))
    spread = F.flatten(F.zip_with(plain, spans, lambda c, n: F.array_repeat(c, n)))
    return F.when(row_html.rlike(r"(?i)\bcolspan\b"), spread).otherwise(plain)


_LINE = "array<struct<cell:string,below:int>>"


def _place(cell: Column, below: Column) -> Column:
    return F.struct(cell.alias("cell"), below.cast("int").alias("below"))


def _line(row_html: Column, above: Column) -> Column:
    """The row's places, each with the number of rows it still reaches down:
    cells go to the first place that no cell of ``above`` reaches into."""
    cells = F.zip_with(F.regexp_extract_all(row_html, F.lit(_CELL_RE), 1), F.regexp_extract_all(row_html, F.lit(_CELL_TAG_RE), 1),
                       lambda c, t: F.struct(c.alias("cell"), _span(t, "colspan").alias("wide"), (_span(t, "rowspan") - 1).alias("below")))

    def taken(i: Column) -> Column:
        return F.coalesce(F.get(above, i)["below"], F.lit(0)) > 0

    def put(line: Column, c: Column) -> Column:
        n = F.size(line)
        free = F.get(F.filter(F.sequence(n, F.greatest(n, F.size(above))), lambda i: ~taken(i)), 0)
        carried = F.transform(F.slice(above, n + 1, free - n), lambda x: _place(x["cell"], x["below"] - 1))
        return F.concat(line, carried, F.array_repeat(_place(c["cell"], c["below"]), c["wide"])).cast(_LINE)

    reach = F.array_max(F.filter(F.sequence(F.lit(1), F.size(above)), lambda i: taken(i - 1)))

    def rest(line: Column) -> Column:
        tail = F.slice(above, F.size(line) + 1, F.greatest(F.coalesce(reach, F.lit(0)) - F.size(line), F.lit(0)))
        return F.concat(line, F.transform(tail, lambda x: _place(
            F.when(x["below"] > 0, x["cell"]), F.greatest(x["below"] - 1, F.lit(0))))).cast(_LINE)

    return F.aggregate(cells, F.array().cast(_LINE), put, rest)


def _without_rowspan(rows: Column) -> Column:
    """Rows of a table with ``rowspan``, written anew with each cell in every
    place it fills, row by row with the places of the row above as state. A
    cell that is spread over places that one from above reaches into takes
    them; a place that no cell fills is empty; a span ends with the last row."""
    empty = F.array().cast(_LINE)
    lines = F.aggregate(rows, F.array().cast(f"array<{_LINE}>"), lambda acc, row: F.array_append(
        acc, _line(row, F.coalesce(F.get(acc, F.size(acc) - 1), empty))))
    return F.transform(lines, lambda line: F.array_join(F.transform(
        line, lambda x: F.concat(F.lit("<td>"), F.coalesce(x["cell"], F.lit("")), F.lit("</td>"))), ""))


def table_rows(pages: DataFrame, html_col: str = "html", table_id: str = RAIN_TABLE_ID,
               columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One output row per data row of the table; ``columns`` taken by header name.

    The header is parsed once per page and each wanted column's position is
    looked up there; data rows then only index their cleaned cells. A row
    shorter than the header is kept, its missing cells NULL; a spanned cell
    stands in every column and row it spans. Columns missing
    from a page's header come out NULL. Each step is a select of its own, so
    that no regex is repeated per column or by a filter (rows are cleaned within
    their page, before they are exploded); pages are dealt out by bytes first.
    """
    keep = keep or [c for c in pages.columns if c != html_col]
    cols = columns or []
    pages = rebalanced(pages.select(*keep, html_col))
    flat = F.regexp_extract(html_col, _table_start(table_id) + r"(.*?)</table\s*>", 1)
    staged = pages.select(*keep, html_col, flat.alias("_flat"))
    staged = staged.select(*keep, F.when(F.lower("_flat").contains("<table"), _paired_body(F.col(html_col), table_id))
                           .otherwise(F.col("_flat")).alias("_table"))
    rows = F.regexp_extract_all("_table", F.lit(_ROW_RE), 1)
    staged = staged.select(*keep, F.when(F.lower("_table").contains("rowspan"), _without_rowspan(rows)).otherwise(rows).alias("_rows"))
    staged = staged.select(*keep, F.transform("_rows", lambda row: _clean_cells(_raw_cells(row), row)).alias("_cleaned"))
    positions = F.array(*[F.array_position(F.get("_cleaned", 0), F.lit(c)).cast("int") for c in cols]) \
        if cols else F.array().cast("array<int>")
    staged = staged.select(*keep, "_cleaned", positions.alias("_pos"))
    # the wanted cells are picked by one loop: a column's own lookup, 34 times,
    # makes a method that is too long for the JVM to compile
    picked = F.transform("_cleaned", lambda cells: F.when(F.size(cells) > 0, F.transform(
        F.col("_pos"), lambda p: F.when(p > 0, F.get(cells, p - 1)))))
    # filters on what a generator gives stay behind it, and the outer form has
    # none inferred: either would repeat the page's regexes, one before the rebalance
    body = staged.select(*keep, F.posexplode_outer(picked).alias("_row_no", "_cells")) \
        .where((F.col("_row_no") > 0) & F.col("_cells").isNotNull())
    return body.select(*keep, F.col("_row_no").alias("row_no"),
                       *[F.get("_cells", i).alias(c) for i, c in enumerate(cols)])
