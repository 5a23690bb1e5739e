"""HTML table rows vs a brute-force parse with Python's html.parser."""

from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rainrisk.sources.html_table import table_rows


class _Tables(HTMLParser):
    """Cell texts of the table with the given id (entities decoded by the parser)."""

    def __init__(self, table_id):
        super().__init__(convert_charrefs=True)
        self.table_id, self.depth, self.rows, self.cell = table_id, 0, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.depth or dict(attrs).get("id") == self.table_id:
                self.depth += 1
        elif self.depth and tag == "tr":
            self.rows.append([])
        elif self.depth and tag in ("td", "th"):
            self.cell, self.span = [], int(dict(attrs).get("colspan") or 1)

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth and tag in ("td", "th") and self.cell is not None:
            self.rows[-1] += ["".join(self.cell).strip()] * self.span
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


class _Spans(HTMLParser):
    """Rows of a table by the grid rule: spans fill places of rows below; a
    table inside a cell is text of the cell."""

    def __init__(self, table_id):
        super().__init__(convert_charrefs=True)
        self.table_id, self.depth, self.rows, self.cell = table_id, 0, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "table" and (self.depth or dict(attrs).get("id") == self.table_id):
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            a = dict(attrs)
            self.cell = [[], int(a.get("colspan") or 1), int(a.get("rowspan") or 1)]

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th") and self.cell:
            self.rows[-1].append(("".join(self.cell[0]).strip(), *self.cell[1:]))
            self.cell = None

    def handle_data(self, data):
        if self.cell and self.depth:
            self.cell[0].append(data)


def brute_spans(html, table_id, columns):
    p = _Spans(table_id)
    p.feed(html)
    places = {}
    for y, row in enumerate(p.rows):
        x = 0
        for t, wide, down in row:
            while (y, x) in places:
                x += 1
            for i in range(wide):
                for j in range(down):
                    if y + j < len(p.rows):
                        places[y + j, x + i] = t
            x += wide
    header = [places.get((0, x)) for x in range(50)]
    out = []
    for y in range(1, len(p.rows)):
        last = max((x for x in range(50) if (y, x) in places), default=-1)  # places before it that no cell fills are empty
        if last >= 0:
            at = [header.index(c) if c in header else 99 for c in columns]
            out.append((y, *[places.get((y, x), "") if x <= last else None for x in at]))
    return out


def brute(html, table_id, columns):
    p = _Tables(table_id)
    p.feed(html)
    if not p.rows:
        return []
    header, out = p.rows[0], []
    for i, row in enumerate(p.rows[1:], 1):
        m = dict(zip(header, row))
        out.append((i, *[m.get(c) for c in columns]))
    return out


text = st.text(alphabet="abcSão 12,.-", max_size=6)
piece = st.sampled_from(["&ccedil;", "&atilde;", "&#233;", "&#xE9;", "&amp;", "&lt;", "&nbsp;",
                         "<b>", "</b>", " ", "\t"])
cell = st.lists(text | piece, max_size=4).map("".join).filter(lambda s: "<b>" not in s or "</b>" in s)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(cell, min_size=3, max_size=3), min_size=1, max_size=5))
def test_table_rows_match_html_parser(spark, body):
    columns = ["Código", "Posto", "01"]
    head = "<tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>"
    rows = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in body)
    html = (f"<html><table id='x'><tr><td>n</td></tr></table>"
            f"<table id=\"tbMonPluvio\">{head}{rows}<tr><td colspan=3>t</td></tr></table></html>")
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = sorted(tuple(r)[1:] for r in table_rows(pages, columns=columns).collect())
    want = sorted(brute(html, "tbMonPluvio", columns))
    assert got == want


inner = st.sampled_from(["", "", "&ccedil;", "<table><tr><td>i</td><td rowspan=2>j</td></tr></table>",
                         "<TABLE id='y'><tr><td><table><tr><th>k</th></tr></table></td></tr></TABLE>"])
# spans of both kinds never overlap here: what HTML calls an error is the fold's own choice
spanned = st.tuples(text, inner, st.sampled_from(["", "", " rowspan=2", " RowSpan='3'", ' rowspan="9"'])) \
    .map(lambda c: f"<td{c[2]}>{c[0]}{c[1]}</td>")


tables = st.tuples(st.lists(st.tuples(st.lists(spanned, min_size=0, max_size=4), st.booleans()), min_size=1, max_size=5), st.booleans())


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(tables, min_size=12, max_size=24))
def test_row_spans_and_nested_tables(spark, drawn):
    columns = ["A", "B", "C", "D"]
    pages = []
    for body, wide in drawn:
        head = "<tr><th rowspan=2>A</th><th>B</th>" + ("<th colspan=2>C</th><th>D</th>" if wide else "<th>C</th><th>D</th>") + "</tr>"
        rows = "".join("<tr>" + ("<td colspan=2>w</td>" if w and not i else "") + "".join(r) + "</tr>" for i, (r, w) in enumerate(body))
        pages.append(f"<table><tr><td><table id=tbMonPluvio border=1>{head}{rows}</table></td></tr></table>"
                     "<table id='z'><tr><td>n</td></tr></table>")
    more = [(-1, None), (-2, "<table id=tbMonPluvio><tr><td>A<table></table>")]
    df = spark.createDataFrame(list(enumerate(pages)) + more, "page_id int, html string")
    got = sorted(tuple(r) for r in table_rows(df, columns=columns).collect())
    assert got == sorted((i, *r) for i, html in enumerate(pages) for r in brute_spans(html, "tbMonPluvio", columns))
