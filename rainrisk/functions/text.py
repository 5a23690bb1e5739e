"""Name normalisation (F1, F2) and LIKE helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's cleaner) -----------------------
# Accented capitals folded to plain letters, in the cleaner's order; Ñ is kept.
ACCENTED_CAPITALS = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN_CAPITALS = "AAAAAEEEEIIIIOOOOOUUUUC"
# -----------------------------------------------------------------------------

# The SQL engine the reference runs on upper-cases the sharp s to the capital
# sharp s (U+1E9E); the JVM expands it to "SS". Map it first so both agree.
_SHARP_S, _CAPITAL_SHARP_S = "ß", "ẞ"

# Escape character for LIKE patterns built from data. It never occurs in a
# cleaned name, so `_` and `%` inside names keep their wildcard meaning
# (as in the reference) while a literal backslash stays a literal.
LIKE_ESCAPE = "~"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c) -> Column:
    """``UPPER(TRIM(x))`` with the reference engine's case mapping."""
    return F.upper(F.trim(F.translate(_col(c), _SHARP_S, _CAPITAL_SHARP_S)))


def clean_string(c) -> Column:
    """Trim, upper-case and strip the accents of 23 capitals (F1)."""
    return F.translate(upper_trim(c), ACCENTED_CAPITALS, PLAIN_CAPITALS)


def like_literal(c) -> Column:
    """Escape only the escape character itself, keeping `_`/`%` as wildcards."""
    return F.replace(_col(c), F.lit(LIKE_ESCAPE), F.lit(LIKE_ESCAPE + LIKE_ESCAPE))
