"""Station → municipality matching.

The reference runs a cascade: exact name, then ``name LIKE mun || '%'`` on
the stations left over, then ``name LIKE '%' || mun || '%'`` on the rest,
then "no match"; a station code leaves the cascade at the first tier where
any spelling of it matches, and one row per code is kept.

Every prefix match is also a contains match and every exact match is also a
prefix match, so the cascade equals: find all *contains* pairs once, give each
pair the best tier it satisfies, and keep per code the pair with the lowest
tier (ties: longest cleaned municipality name, then name, then IBGE code).
That is one candidate join and one aggregation instead of three joins and
three anti joins that each rescan the station set.

Candidate join without a cross product: a pattern ``%P%`` can only match a
name that contains each of P's literal runs (the stretches without a `_`/`%`
wildcard) whole. Municipalities emit one run as the key: the one that the
fewest municipalities share (the longest of these), empty for wildcard-only
names. Stations emit their distinct substrings of the key lengths the
dimension uses (found by a scalar subquery of the same plan); an equi-join on
the key yields a complete candidate set, which ``LIKE`` then checks exactly.
For a name without wildcards the key is the whole name, so every candidate is
a match; work is linear in the stations' substrings of those lengths, and no
key is shared by every station unless a wildcard-only name exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainrisk.functions.text import LIKE_ESCAPE, clean_string, like_literal
from rainrisk.operators.joins import checked_broadcast

# --- fixed values (must equal the reference's tier names) --------------------
TIER_EXACT = "Exato"
TIER_PREFIX = "Comeca_Com"
TIER_CONTAINS = "Contem"
TIER_NONE = "Sem_Match"
# -----------------------------------------------------------------------------

TIER_NAMES = {1: TIER_EXACT, 2: TIER_PREFIX, 3: TIER_CONTAINS}


def distinct_stations(bronze: DataFrame, null_codes: bool = False) -> DataFrame:
    """A2: distinct (code, name) with the cleaned name.

    Codes that are NULL are left out unless ``null_codes``: they cannot join
    any reading (the join to the fact is an equi-join) and the bronze
    not-null check rejects them.
    """
    rows = bronze.select("codigo_posto", "nome_posto")
    if not null_codes:
        rows = rows.where(F.col("codigo_posto").isNotNull())
    return (rows.distinct()
            .withColumn("nome_posto_limpo", clean_string("nome_posto")))


def municipality_keys(municipalities: DataFrame) -> DataFrame:
    return municipalities.select(
        "codigo_ibge", "municipio", "latitude", "longitude",
        clean_string("municipio").alias("municipio_limpo"))


def _station_grams(stations: DataFrame, lengths) -> DataFrame:
    """Each station's distinct substrings of the given lengths (0 = the empty
    key that wildcard-only patterns use); ``lengths`` is an array column."""
    name = F.col("nome_posto_limpo")
    stations = stations.withColumn("_lengths", lengths)
    fits = F.filter(F.col("_lengths"), lambda q: q <= F.length(name))

    def of_length(q):
        starts = F.sequence(F.lit(1), F.when(q > 0, F.length(name) - q + 1).otherwise(F.lit(1)))
        return F.transform(starts, lambda i: F.substring(name, i, q))

    keys = F.array_distinct(F.flatten(F.transform(fits, of_length)))
    return stations.select("codigo_posto", "nome_posto_limpo", F.explode(keys).alias("_key"))


def _runs() -> F.Column:
    """The literal runs of a municipality's name: its stretches without wildcards."""
    return F.array_distinct(F.regexp_extract_all(F.col("municipio_limpo"), F.lit("([^%_]+)"), F.lit(1)))


def _municipality_gram(mun_keys: DataFrame) -> DataFrame:
    """``_key``: the literal run of the name that the fewest municipalities share."""
    one = mun_keys.select("municipio_limpo", F.explode(_runs()).alias("_run")).distinct()
    shared = one.groupBy(F.col("_run").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    best = (one.join(shared, F.col("_run") == F.col("_r")).groupBy(F.col("municipio_limpo").alias("_m"))
            .agg(F.min(F.struct("_n", (-F.length("_run")).alias("_l"), "_run")).alias("_b")))
    return (mun_keys.join(best, F.col("municipio_limpo") == F.col("_m"), "left")
            .withColumn("_key", F.when(F.col("municipio_limpo").isNotNull(), F.coalesce("_b._run", F.lit(""))))
            .drop("_m", "_b"))


def _like(value, pattern):
    """``value LIKE pattern ESCAPE '~'`` with a pattern built from data."""
    return F.like(value, pattern, F.lit(LIKE_ESCAPE))


def candidate_pairs(stations: DataFrame, municipalities: DataFrame) -> DataFrame:
    """All (station spelling, municipality) pairs with ``name LIKE %mun%``,
    tagged with the best tier each satisfies (1 exact, 2 prefix, 3 contains).
    """
    # one key row per municipality: broadcast when the dimension is small,
    # so the exploded station n-grams are probed in place, never shuffled
    keys = municipality_keys(municipalities)
    mk = checked_broadcast(_municipality_gram(keys), bound=municipalities)
    # lengths of all runs (names without wildcards have one: the key): a scalar
    # subquery of one aggregate, evaluated with the query
    sizes = F.transform(_runs(), lambda r: F.length(r))
    used = keys.where("municipio_limpo is not null").agg(F.collect_set(F.when(F.size(sizes) > 0, sizes).otherwise(F.array(F.lit(0)))))
    lengths = F.array_distinct(F.flatten(F.coalesce(used.scalar(), F.array().cast("array<array<int>>"))))
    cand = _station_grams(stations, lengths).join(mk, "_key")
    name = F.col("nome_posto_limpo")
    pat = like_literal(F.col("municipio_limpo"))
    contains = _like(name, F.concat(F.lit("%"), pat, F.lit("%")))
    prefix = _like(name, F.concat(pat, F.lit("%")))
    tier = (F.when(name == F.col("municipio_limpo"), 1)
            .when(prefix, 2).otherwise(3))
    return (cand.where(contains)
            .select("codigo_posto", "nome_posto_limpo", "codigo_ibge", "municipio",
                    "municipio_limpo", "latitude", "longitude", tier.alias("tier")))


def _null_code_limit(pairs: DataFrame) -> tuple[DataFrame, F.Column, F.Column]:
    """SQL's ``NOT IN`` with a NULL code: (kept pairs, whether stations without
    a match are listed, whether any code matched at all).

    A NULL code reaches a tier only while no tier before it matched anything;
    once it has matched, nothing is left for the later tiers.
    """
    null = F.col("codigo_posto").isNull()
    first = pairs.agg(F.min(F.when(~null, F.col("tier"))).alias("known"),
                      F.min(F.when(null, F.col("tier"))).alias("null"))
    limit = first.select(F.when(F.col("null") <= F.coalesce("known", F.lit(9)), F.col("null"))).scalar()
    known = first.select(F.col("known")).scalar()
    kept = pairs.where((F.col("tier") <= F.coalesce(limit, F.lit(9)))
                       & (~null | F.coalesce(F.col("tier") == limit, F.lit(False))))
    return kept, limit.isNull(), known.isNull()


def station_municipality_map(bronze: DataFrame, municipalities: DataFrame,
                             null_codes: bool = False) -> DataFrame:
    """One row per station code: municipio_inferido, latitude, longitude, tipo_match.

    Candidate pairs and a "no match" row per station (tier 4) go through one
    aggregation by code; the struct minimum picks the lowest tier, then the
    D2 tie-break, and combines map-side.

    With ``null_codes`` a NULL station code takes part the way SQL's ``NOT
    IN`` treats it (it can empty all later tiers); by default it is left out.
    """
    stations = distinct_stations(bronze, null_codes)
    pairs = candidate_pairs(stations, municipalities).select(
        "codigo_posto", "tier", (-F.length("municipio_limpo")).alias("neg_len"),
        "municipio", "codigo_ibge", "latitude", "longitude")
    if null_codes:
        pairs, listed, unmatched = _null_code_limit(pairs)
        stations = stations.where(listed & (F.col("codigo_posto").isNotNull() | unmatched))
    none = stations.select(
        "codigo_posto", F.lit(4).alias("tier"), F.lit(None).cast("int").alias("neg_len"),
        F.lit(None).cast("string").alias("municipio"),
        F.lit(None).cast("int").alias("codigo_ibge"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"))
    best = (pairs.unionByName(none).groupBy("codigo_posto")
            .agg(F.min(F.struct("tier", "neg_len", "municipio", "codigo_ibge",
                                "latitude", "longitude")).alias("b")))
    names = F.create_map(*[x for k, v in TIER_NAMES.items() for x in (F.lit(k), F.lit(v))])
    tier_name = F.coalesce(F.try_element_at(names, F.col("b.tier")), F.lit(TIER_NONE))
    return best.select(
        "codigo_posto",
        F.col("b.municipio").alias("municipio_inferido"),
        F.col("b.latitude").alias("latitude"),
        F.col("b.longitude").alias("longitude"),
        tier_name.alias("tipo_match"))


def tier_matches(bronze: DataFrame, municipalities: DataFrame, tier: int) -> DataFrame:
    """Rows one cascade tier emits (before the one-row-per-code step):
    every pair of that tier for codes whose best tier it is."""
    pairs = candidate_pairs(distinct_stations(bronze), municipalities)
    of_code = Window.partitionBy("codigo_posto")  # pairs of one code: its spellings times the names they hold
    return (pairs.withColumn("_best", F.min("tier").over(of_code))
            .where((F.col("tier") == tier) & (F.col("_best") == tier))
            .select("codigo_posto", F.col("municipio").alias("municipio_inferido"),
                    "latitude", "longitude", F.lit(TIER_NAMES[tier]).alias("tipo_match")))


def unmatched_stations(bronze: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Stations left after the three tiers (anti join by code)."""
    stations = distinct_stations(bronze)
    pairs = candidate_pairs(stations, municipalities).select("codigo_posto").distinct()
    return stations.join(pairs, "codigo_posto", "left_anti").select("codigo_posto", "nome_posto")
