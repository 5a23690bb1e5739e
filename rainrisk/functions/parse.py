"""Lenient text → number/date parsing (F8–F11, F19) as built-in expressions.

Spark runs with ANSI casts, so every conversion here is a ``try_*`` form
behind a pattern check; bad input becomes NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's loader) ------------------------
# Portuguese month abbreviations, January to December.
PT_MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun",
             "jul", "ago", "set", "out", "nov", "dez"]
# Cell texts that mean "no reading".
MISSING_TOKENS = ["-", "", "nan", "None"]
# -----------------------------------------------------------------------------

# White space as Python's str.strip() removes it (the reference strips cells
# in Python): ASCII controls 0x09-0x0D and 0x1C-0x1F, the blank, NEL, NBSP and
# the Unicode space separators.
_WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# A plain decimal number (group 1) between optional white space, as a strict
# numeric parser accepts it; anything else extracts as '' and casts to NULL.
_NUMBER_RE = (r"^" + _WS + r"*([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
              + _WS + r"*$")
# Infinity as the numeric parser spells it (any letter case, optional sign).
_INF_RE = r"^" + _WS + r"*([+-]?)(?i:inf|infinity)" + _WS + r"*$"
# An integer (group 1) between optional white space.
_INT_RE = r"^" + _WS + r"*([+-]?[0-9]+)" + _WS + r"*$"
# Number written with '.' thousands and ',' decimal separators (group 1).
_PT_NUMBER_RE = (r"^" + _WS + r"*([+-]?(?:[0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+)(?:,[0-9]+)?)"
                 + _WS + r"*$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c: Column, pattern: str) -> Column:
    # one regex evaluation; a non-match gives '' which try_cast turns to NULL by
    # an exception, so empty text (most cells of a page) does not come that far
    t = c.cast("string")
    return F.when(t != "", F.regexp_extract(t, pattern, 1))


def strict_double(c) -> Column:
    """Text → double only if the whole text is a number; else NULL.

    The pattern check comes first because Spark's cast alone is lenient
    (it reads '5d' as 5.0). Infinity in any letter case is accepted, NaN
    text is missing (NULL), as in the reference's numeric parser.
    """
    t = _col(c).cast("string")
    inf_sign = F.regexp_extract(t, _INF_RE, 1)
    inf = F.when(t.rlike(_INF_RE), F.when(inf_sign == "-", F.lit(float("-inf")))
                 .otherwise(F.lit(float("inf"))))
    return F.coalesce(_extract(t, _NUMBER_RE).try_cast("double"), inf)


def parse_decimal_comma(c) -> Column:
    """Rain cell → mm.

    Trim; '-', '', 'nan', 'None' are missing; a decimal comma becomes a dot;
    anything that is then not a plain number (e.g. '1.234,5') is NULL. The
    missing-value tokens are not numbers, so the number check covers them.
    """
    return strict_double(F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")))


def parse_html_number(c) -> Column:
    """Table cell with ',' decimals and '.' thousands → double, else NULL."""
    t = _extract(_col(c), _PT_NUMBER_RE)
    plain = F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def lenient_int(c) -> Column:
    """Integer text (sign and surrounding white space allowed) → bigint."""
    return _extract(_col(c), _INT_RE).try_cast("bigint")


def pt_month_start(month_year) -> Column:
    """``'jan/2025'`` → DATE 2025-01-01; NULL when month or year is unusable."""
    month = pt_month_number(month_year)
    year = pt_year(month_year)
    ok = year.between(1, 9999) & month.isNotNull()
    return F.when(ok, F.make_date(year.cast("int"), month, F.lit(1)))


def day_of_month_start(first, day_number) -> Column:
    """The ``day_number``-th day of the month starting at ``first``; NULL when
    the month has no such day (31 April, 29 February of a common year)."""
    d = _col(day_number)
    date = F.date_add(_col(first), (d - 1).cast("int"))
    return F.when(d.between(1, 31), F.when(F.month(date) == F.month(_col(first)), date))


def pt_month_year_date(month_year, day) -> Column:
    """``'jan/2025'`` + day ``'07'`` → DATE; impossible dates are NULL.

    Built as the first of the month plus (day - 1) days, valid only when that
    stays in the month: no date text is formatted or parsed per row.
    """
    month = pt_month_number(month_year)
    year = pt_year(month_year)
    dd = lenient_int(day)
    ok = year.between(1, 9999) & month.isNotNull() & dd.between(1, 31)
    first = F.make_date(year.cast("int"), month, F.lit(1))
    date = F.date_add(first, (dd - 1).cast("int"))
    return F.when(ok, F.when(F.month(date) == month, date))


def year_in_text(c, pattern: str = r"/(\d{4})") -> Column:
    """First 4-digit year after a slash, as bigint; NULL when absent."""
    y = F.regexp_extract(_col(c).cast("string"), pattern, 1)
    return F.when(y != "", y.cast("bigint"))


def year_in_file_name(path_col) -> Column:
    """Year expected from a raw file name ``<Region>_<yyyy>.parquet``."""
    return year_in_text(path_col, r"_(\d{4})\.parquet$")


def pt_month_number(month_year) -> Column:
    """Month number of ``'jan/2025'`` (any letter case); NULL if unknown."""
    parts = F.split(_col(month_year).cast("string"), "/")
    month_map = F.create_map(*[x for i, m in enumerate(PT_MONTHS)
                               for x in (F.lit(m), F.lit(i + 1))])
    return F.try_element_at(month_map, F.lower(F.try_element_at(parts, F.lit(1))))


def pt_year(month_year) -> Column:
    """Year of ``'jan/2025'``; NULL if it is not an integer."""
    parts = F.split(_col(month_year).cast("string"), "/")
    return lenient_int(F.try_element_at(parts, F.lit(2)))
