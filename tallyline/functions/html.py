"""Table-row and title extraction from stored HTML pages.

Regex work runs as built-in `regexp_extract_all` / higher-order array
functions inside the JVM, one page per row; the rows of a page never leave
its task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the stored pages' markup.
ROW_RE = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL_RE = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"
TAG_RE = r"<[^>]+>"
TITLE_RE = r"(?s)<title>(.*?)</title>"


def table_rows(html: Column, limit: int = 10) -> Column:
    """First `limit` <tr> bodies of the page."""
    return F.slice(F.regexp_extract_all(html, F.lit(ROW_RE), 1), 1, limit)


def row_cells(row: Column) -> Column:
    """Cells (<td>/<th>) of one row, tags stripped and trimmed."""
    return F.transform(F.regexp_extract_all(row, F.lit(CELL_RE), 1),
                       lambda c: F.trim(F.regexp_replace(c, TAG_RE, "")))


def opening_value(html: Column, marker: str = "Open", limit: int = 10, min_cells: int = 5,
                  value_pos: int = 3) -> Column:
    """I9 `fn_regex_html_rows`: among the first `limit` rows, those with at
    least `min_cells` cells one of which equals `marker`; the `value_pos`-th
    cell is the value: 'pick' (any case) -> 0.0, else its negation;
    unparsable -> try the next qualifying row; none -> NULL."""
    cells = F.transform(table_rows(html, limit), row_cells)
    ok = F.filter(cells, lambda cs: (F.size(cs) >= min_cells) & F.array_contains(cs, marker))

    def val(cs: Column) -> Column:
        v = F.try_element_at(cs, F.lit(value_pos))
        return F.when(F.lower(v).contains("pick"), F.lit(0.0)).otherwise(-(v.try_cast("double")))

    vals = F.filter(F.transform(ok, val), lambda x: x.isNotNull())
    return F.try_element_at(vals, F.lit(1))


def page_title(html: Column) -> Column:
    """I10 `fn_regex_title`: text of <title> ('' when absent)."""
    return F.regexp_extract(html, TITLE_RE, 1)


def is_redirect(html: Column, marker: str) -> Column:
    """Redirect detection by a marker text in the title."""
    return page_title(html).contains(marker)
