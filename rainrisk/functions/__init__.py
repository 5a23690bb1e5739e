"""Scalar Column builders; every one stays a JVM expression (no Python UDF)."""

from rainrisk.functions.domain import (
    MESOREGIONS,
    alert_band,
    alert_level_label,
    climate_period,
    weekday_name,
)
from rainrisk.functions.parse import (
    parse_decimal_comma,
    parse_html_number,
    pt_month_year_date,
    strict_double,
    year_in_text,
)
from rainrisk.functions.text import clean_string, like_literal, upper_trim

__all__ = [
    "MESOREGIONS", "alert_band", "alert_level_label", "climate_period", "weekday_name",
    "parse_decimal_comma", "parse_html_number", "pt_month_year_date", "strict_double",
    "year_in_text", "clean_string", "like_literal", "upper_trim",
]
