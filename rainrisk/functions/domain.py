"""Business rules of the rain-alert domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -------------------------
# Alert bands on daily mm (NULL counts as 0): below 20, from 20 below 50,
# from 50 up to and including 100, above 100.
BAND_NORMAL = "Normal"
BAND_POTENTIAL = "Perigo Potencial"
BAND_DANGER = "Perigo"
BAND_GREAT = "Grande Perigo"
BAND_LIMITS = (20, 50, 100)

# Climate season by mesoregion: the first two regions are wet from January to
# April, the other three from April to August.
SEASON_WET, SEASON_DRY, SEASON_UNKNOWN = "Chuvoso", "Seco", "Desconhecido"
WET_MONTHS_A = ((2601, 2602), (1, 4))
WET_MONTHS_B = ((2603, 2604, 2605), (4, 8))

# Weekday names, Sunday first.
WEEKDAYS_PT = ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
               "Quinta-feira", "Sexta-feira", "Sábado"]

# Risk-grid labels per alert band, and the label for anything else.
ALERT_LABELS = {
    "Normal": "Normal 🟢",
    "Perigo Potencial": "Atenção 🟡",
    "Perigo": "Alerta 🟠",
    "Grande Perigo": "Perigo 🔴",
}
ALERT_LABEL_UNKNOWN = "Desconhecido ⚪"

# Mesoregions: code and name.
MESOREGIONS = [
    (2605, "Metropolitana_Recife"),
    (2604, "Mata_Pernambucana"),
    (2603, "Agreste_Pernambucano"),
    (2602, "Sao_Francisco_Pernambucano"),
    (2601, "Sertao_Pernambucano"),
]
FIRST_HISTORY_YEAR = 1961
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alert_band(precip) -> Column:
    """Mm → alert band; 100 itself is still the third band."""
    p = F.coalesce(_col(precip), F.lit(0.0))
    lo, mid, hi = BAND_LIMITS
    return (F.when(p < lo, BAND_NORMAL)
            .when((p >= lo) & (p < mid), BAND_POTENTIAL)
            .when((p >= mid) & (p <= hi), BAND_DANGER)
            .otherwise(BAND_GREAT))


def climate_period(region, date) -> Column:
    """R2: wet / dry season by mesoregion and month; unknown region otherwise."""
    m = F.month(_col(date))
    (regions_a, (a0, a1)), (regions_b, (b0, b1)) = WET_MONTHS_A, WET_MONTHS_B
    r = _col(region)
    return (F.when(r.isin(*regions_a),
                   F.when(m.between(a0, a1), SEASON_WET).otherwise(SEASON_DRY))
            .when(r.isin(*regions_b),
                  F.when(m.between(b0, b1), SEASON_WET).otherwise(SEASON_DRY))
            .otherwise(SEASON_UNKNOWN))


def weekday_name(date) -> Column:
    """Portuguese weekday; Spark's dayofweek is 1 on Sunday."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS_PT])
    return F.element_at(names, F.dayofweek(_col(date)))


def alert_level_label(band) -> Column:
    """Alert band → risk-grid label."""
    labels = F.create_map(*[x for k, v in ALERT_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(labels, _col(band)), F.lit(ALERT_LABEL_UNKNOWN))


def mesoregion_frame(spark):
    """The mesoregion dimension as a tiny literal frame."""
    return spark.createDataFrame(MESOREGIONS, "mesorregiao_id int, mesorregiao_nome string")
