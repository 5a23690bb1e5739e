"""DuckDB SQL oracles, one per registered query.

Each text runs on DuckDB with the driver's tables registered as views. The
binding CTEs (``v_municipio`` …) come first; everything after them is written
from the rules, by other means than the Spark plans: matching is one join with
a rule number, bands and seasons are lookups, dry spells come from an as-of
join with the last rain, moving means from a join on row numbers, "latest"
from ``arg_max``. Integer results are cast to BIGINT, as Spark returns them.
"""

from __future__ import annotations

from rainrisk.functions.text import ACCENTED_CAPITALS, PLAIN_CAPITALS
from rainrisk.sources.bindings import with_bindings


def clean_sql(expr: str) -> str:
    return f"translate(upper(trim({expr})), '{ACCENTED_CAPITALS}', '{PLAIN_CAPITALS}')"


# Every (name, municipality) pair that matches at all carries the number of
# the strictest rule it meets; a station keeps the pairs of its best number.
MAPPING_CTES = f"""
k_mun AS (SELECT *, {clean_sql('municipio')} AS mk FROM v_municipio),
k_name AS (SELECT codigo_posto, nome_posto, {clean_sql('nome_posto')} AS pk FROM v_leitura GROUP BY ALL),
k_pair AS (
  SELECT n.codigo_posto, m.codigo_ibge, m.municipio, m.latitude, m.longitude, length(m.mk) AS size,
         3 - CAST(n.pk LIKE m.mk || '%' AS INTEGER) - CAST(n.pk = m.mk AS INTEGER) AS rule
  FROM k_name n JOIN k_mun m ON n.pk LIKE '%' || m.mk || '%'),
k_kept AS (SELECT * FROM k_pair p SEMI JOIN (SELECT codigo_posto, min(rule) AS rule FROM k_pair GROUP BY ALL) b
           USING (codigo_posto, rule)),
k_label(rule, tipo_match) AS (VALUES (1, 'Exato'), (2, 'Comeca_Com'), (3, 'Contem')),
k_pick AS (
  SELECT codigo_posto, arg_min({{'m': municipio, 'la': latitude, 'lo': longitude, 'r': rule}},
                               (-size, municipio, codigo_ibge)) AS p
  FROM k_kept GROUP BY codigo_posto),
k_map AS (
  SELECT s.codigo_posto, p.m AS municipio_inferido, p.la AS latitude, p.lo AS longitude,
         coalesce(tipo_match, 'Sem_Match') AS tipo_match
  FROM (SELECT DISTINCT codigo_posto FROM k_name) s
  LEFT JOIN k_pick USING (codigo_posto) LEFT JOIN k_label ON k_label.rule = p.r)"""

# --- fixed values (labels and limits of the domain) -------------------------------
WEEKDAY_SQL = ("['Domingo', 'Segunda-feira', 'Terça-feira', 'Quarta-feira', 'Quinta-feira', "
               "'Sexta-feira', 'Sábado'][1 + dayofweek(data)]")
WET_CTE = """
k_wet(regiao, de, ate) AS (VALUES (2601, 1, 4), (2602, 1, 4), (2603, 4, 8), (2604, 4, 8), (2605, 4, 8))"""
# ------------------------------------------------------------------------------------

# season: the wet months of the row's region (``k_wet`` joined), else dry
SEASON_SQL = ("CASE WHEN de IS NULL THEN 'Desconhecido' "
              "ELSE ['Seco', 'Chuvoso'][1 + CAST(month(data) BETWEEN de AND ate AS INTEGER)] END")


def band_sql(rain: str, labels: str) -> str:
    """The label at the number of limits that the rain has passed."""
    x = f"coalesce({rain}, 0)"
    return f"{labels}[1 + CAST({x} >= 20 AS INTEGER) + CAST({x} >= 50 AS INTEGER) + CAST({x} > 100 AS INTEGER)]"


BAND_SQL = band_sql("precipitacao", "['Normal', 'Perigo Potencial', 'Perigo', 'Grande Perigo']")
LEVEL_SQL = band_sql("rain", "['Normal 🟢', 'Atenção 🟡', 'Alerta 🟠', 'Perigo 🔴']")

# readings numbered per station; the rainy ones numbered again; each reading
# joined with the last rainy one up to its day
SPELL_CTES = """
k_seq AS (SELECT *, row_number() OVER (PARTITION BY codigo_posto ORDER BY data) AS n FROM v_leitura),
k_rain AS (
  SELECT codigo_posto AS rp, data AS rd, n AS rn, row_number() OVER (PARTITION BY codigo_posto ORDER BY n) AS k
  FROM k_seq WHERE precipitacao > 0),
k_spell AS (
  SELECT s.*, coalesce(k, 0) AS island_id,
         CASE WHEN coalesce(precipitacao, 0) = 0 THEN n - coalesce(rn, 1) + 1 ELSE 0 END AS dias_secos_consecutivos
  FROM k_seq s ASOF LEFT JOIN k_rain r ON s.codigo_posto = r.rp AND s.data >= r.rd)"""

# the mean of a reading and the six before it, by row number
MEAN_CTES = """
k_mean AS (
  SELECT a.codigo_posto AS mp, a.n AS mn, avg(b.precipitacao) AS mm_7d
  FROM k_seq a, range(7) t(back) JOIN k_seq b ON b.codigo_posto = a.codigo_posto AND b.n = a.n - t.back
  GROUP BY ALL)"""

SILVER_CTES = f"""{MAPPING_CTES},{SPELL_CTES},{MEAN_CTES},{WET_CTE},
k_silver AS (
  SELECT s.codigo_posto, nome_posto, data,
         CAST(year(data) AS BIGINT) AS ano, CAST(month(data) AS BIGINT) AS mes,
         CAST(day(data) AS BIGINT) AS dia, {WEEKDAY_SQL} AS dia_semana,
         precipitacao, mesorregiao_id, {SEASON_SQL} AS periodo_clima,
         municipio_inferido, latitude, longitude, tipo_match,
         {BAND_SQL} AS alerta_chuva,
         CAST(dias_secos_consecutivos AS BIGINT) AS dias_secos_consecutivos, mm_7d
  FROM k_spell s JOIN k_mean ON s.codigo_posto = mp AND n = mn
  LEFT JOIN k_map USING (codigo_posto) LEFT JOIN k_wet ON regiao = mesorregiao_id)"""

# the wettest reading of a municipality's last day decides its level
GOLD_CTES = SILVER_CTES + f""",
k_day AS (
  SELECT municipio_inferido AS municipio, data, coalesce(max(precipitacao), 0) AS rain
  FROM k_silver WHERE municipio_inferido IS NOT NULL GROUP BY ALL),
k_last AS (SELECT municipio, max(data) AS atualizacao, arg_max(rain, data) AS rain FROM k_day GROUP BY municipio),
k_gold AS (
  SELECT CAST(list_position((SELECT list(municipio ORDER BY municipio) FROM k_last), municipio) AS BIGINT) AS id,
         municipio, {LEVEL_SQL} AS nivel_alerta, atualizacao
  FROM k_last)"""


def _w(ctes: str, body: str, *bindings: str) -> str:
    return with_bindings(f"WITH {ctes.strip()}\n{body}", *bindings)


ORACLES: dict[str, str] = {}

ORACLES["station_municipality_map"] = _w(MAPPING_CTES, "SELECT * FROM k_map", "v_municipio", "v_leitura")

for _rule, _key in enumerate(("match_exact", "match_prefix", "match_contains"), 1):
    ORACLES[_key] = _w(
        MAPPING_CTES,
        "SELECT codigo_posto, municipio AS municipio_inferido, latitude, longitude, tipo_match "
        f"FROM k_kept JOIN k_label USING (rule) WHERE rule = {_rule}", "v_municipio", "v_leitura")

ORACLES["match_remaining"] = _w(
    MAPPING_CTES, "SELECT codigo_posto, nome_posto FROM k_name ANTI JOIN k_pair USING (codigo_posto)",
    "v_municipio", "v_leitura")

ORACLES["silver_rainfall"] = _w(SILVER_CTES, "SELECT * FROM k_silver", "v_municipio", "v_leitura")

ORACLES["silver_rainfall_split"] = ORACLES["silver_rainfall"]

ORACLES["silver_rainfall_latest_year"] = _w(
    SILVER_CTES, "SELECT * FROM k_silver WHERE ano = (SELECT max(year(data)) FROM v_leitura)",
    "v_municipio", "v_leitura")

ORACLES["gold_grid_risk"] = _w(GOLD_CTES, "SELECT * FROM k_gold", "v_municipio", "v_leitura")

ORACLES["alerts"] = _w(
    GOLD_CTES,
    "SELECT id, municipio, nivel_alerta, CAST(atualizacao AS VARCHAR) AS atualizacao "
    "FROM k_gold ORDER BY id", "v_municipio", "v_leitura")

ORACLES["latest_per_municipality"] = _w(
    MAPPING_CTES,
    "SELECT municipio_inferido AS municipio, codigo_posto, data, precipitacao "
    "FROM v_leitura JOIN k_map USING (codigo_posto) WHERE municipio_inferido IS NOT NULL "
    "QUALIFY data = max(data) OVER (PARTITION BY municipio_inferido)", "v_municipio", "v_leitura")

ORACLES["alert_level"] = with_bindings(
    f"SELECT codigo_posto, data, precipitacao, {BAND_SQL} AS alerta_chuva FROM v_leitura",
    "v_leitura")
ORACLES["climate_period"] = _w(
    WET_CTE, f"SELECT codigo_posto, data, mesorregiao_id, {SEASON_SQL} AS periodo_clima "
    "FROM v_leitura LEFT JOIN k_wet ON regiao = mesorregiao_id", "v_leitura")
ORACLES["weekday_name"] = with_bindings(
    f"SELECT codigo_posto, data, {WEEKDAY_SQL} AS dia_semana FROM v_leitura", "v_leitura")
ORACLES["rain_islands"] = _w(
    SPELL_CTES, "SELECT codigo_posto, data, precipitacao, CAST(island_id AS BIGINT) AS island_id FROM k_spell", "v_leitura")
ORACLES["dry_spell"] = _w(
    SPELL_CTES, "SELECT codigo_posto, data, precipitacao, "
    "CAST(dias_secos_consecutivos AS BIGINT) AS dias_secos_consecutivos FROM k_spell", "v_leitura")
ORACLES["moving_mean_7"] = _w(
    SPELL_CTES + "," + MEAN_CTES, "SELECT codigo_posto, data, precipitacao, mm_7d "
    "FROM k_seq JOIN k_mean ON codigo_posto = mp AND n = mn", "v_leitura")


# ---- bronze --------------------------------------------------------------------
LONG_CTES = """
o_months AS (
  SELECT DISTINCT codigo_posto, nome_posto, mesorregiao_id,
         year(data) AS y, month(data) AS m FROM v_leitura),
o_days AS (
  SELECT codigo_posto, nome_posto, mesorregiao_id, make_date(y, m, d) AS data
  FROM o_months, range(1, 32) t(d)
  WHERE d <= day(last_day(make_date(y, m, 1)))),
o_long AS (
  SELECT o.codigo_posto, o.nome_posto, o.data, l.precipitacao, o.mesorregiao_id
  FROM o_days o LEFT JOIN v_leitura l
    ON l.codigo_posto = o.codigo_posto AND l.data = o.data)"""

ORACLES["bronze_daily_long"] = _w(LONG_CTES, "SELECT * FROM o_long", "v_leitura")
ORACLES["bronze_year_guard"] = _w(
    LONG_CTES, "SELECT * FROM o_long WHERE codigo_posto % 7 <> 3", "v_leitura")
ORACLES["bronze_replace_year"] = _w(LONG_CTES.replace("o_long AS (", "o_long AS MATERIALIZED (") + """,
o_again AS (
  SELECT * FROM o_long WHERE codigo_posto % 2 = 0
    AND year(data) = (SELECT min(year(data)) FROM v_leitura)),
o_replaced AS (SELECT DISTINCT year(data) AS y, coalesce(mesorregiao_id, -1) AS r FROM o_again)""", """
SELECT l.* FROM o_long l ANTI JOIN o_replaced p ON year(l.data) = p.y AND coalesce(l.mesorregiao_id, -1) = p.r
UNION ALL
SELECT * FROM o_again""", "v_leitura")

ORACLES["raw_files_load"] = _w(
    LONG_CTES, "SELECT * FROM o_long WHERE mesorregiao_id IS NOT NULL "
    "AND (mesorregiao_id + year(data)) % 9 NOT IN (4, 5, 7)", "v_leitura")

ORACLES["dq_raw_files"] = with_bindings("""
WITH o_unit AS (
  SELECT mesorregiao_id AS r, year(data) AS y, (mesorregiao_id + year(data)) % 9 AS kind,
         count(DISTINCT (codigo_posto, month(data))) AS n
  FROM v_leitura WHERE mesorregiao_id IS NOT NULL GROUP BY ALL)
SELECT r || CASE kind WHEN 5 THEN '-' WHEN 3 THEN '[1] 100%_' ELSE '_' END || y || '.parquet' AS arquivo,
       CASE kind WHEN 4 THEN 'missing_columns' WHEN 5 THEN 'no_year_in_name' WHEN 6 THEN 'inconsistent'
                 WHEN 7 THEN 'damaged' WHEN 8 THEN 'no_valid_values' ELSE 'ok' END AS status,
       CASE kind WHEN 4 THEN NULL WHEN 7 THEN 0 ELSE n END AS n_rows,
       CASE WHEN kind IN (4, 7, 8) THEN NULL ELSE CAST(y + CAST(kind = 6 AS INTEGER) AS BIGINT) END AS year_min,
       CASE WHEN kind IN (4, 7, 8) THEN NULL ELSE CAST(y + CAST(kind = 6 AS INTEGER) AS BIGINT) END AS year_max
FROM o_unit
UNION ALL
SELECT 'copia' || r || '_' || y || '.parquet', 'superseded', n, y, y FROM o_unit WHERE kind = 0
UNION ALL
SELECT 'lixo_2000.parquet', 'unreadable_or_empty', NULL, NULL, NULL""", "v_leitura")

ORACLES["silver_after_reload"] = _w(
    SILVER_CTES, "SELECT * REPLACE (CASE WHEN codigo_posto % 4 = 0 AND ano < (SELECT max(year(data)) FROM v_leitura) "
    "THEN 'Sem nome' ELSE nome_posto END AS nome_posto) FROM k_silver", "v_municipio", "v_leitura")

ORACLES["table_rebuild_view"] = with_bindings("""
SELECT CAST(year(data) AS BIGINT) AS ano, count(*) AS n_rows, count(DISTINCT codigo_posto) AS n_stations,
       sum(precipitacao) AS chuva, max(data) AS ultima
FROM v_leitura GROUP BY year(data)""", "v_leitura")

ORACLES["sql_clean_name"] = with_bindings(
    f"SELECT codigo_posto, {clean_sql('nome_posto')} AS limpo, upper(trim(nome_posto)) AS maiusculo FROM v_posto",
    "v_posto")

ORACLES["feed_ingest_days"] = with_bindings(
    "SELECT '2025' AS ano, '03' AS mes, '07' AS dia, count(*) AS n_rows FROM v_feed", "v_feed")

# ---- feed ------------------------------------------------------------------------
ORACLES["json_flatten"] = with_bindings("""
SELECT data_hora, nome_estacao AS estacao_nome, codigo_gmmc, chuva,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       cidade, nome_estacao, CAST(NULL AS VARCHAR) AS tipo, CAST(NULL AS VARCHAR) AS uf,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS dc_k
FROM v_feed""", "v_feed")

LATEST_STATION_SQL = """
SELECT codigo_gmmc, upper(trim(r.cidade)) AS municipio_nome, r.nome_estacao, r.data_hora, r.chuva
FROM (SELECT codigo_gmmc, arg_max({'cidade': cidade, 'nome_estacao': nome_estacao, 'data_hora': data_hora,
                                   'chuva': chuva}, (data_hora, nome_estacao)) AS r
      FROM v_feed WHERE cidade IS NOT NULL GROUP BY codigo_gmmc)"""
ORACLES["silver_station_latest"] = with_bindings(LATEST_STATION_SQL, "v_feed")
ORACLES["feed_stream_latest"] = with_bindings(LATEST_STATION_SQL, "v_feed")

ORACLES["feed_rejects"] = with_bindings("""
WITH o_feed AS (SELECT codigo_gmmc, CAST(substr(codigo_gmmc, 2) AS BIGINT) % 17 AS k FROM v_feed)
SELECT codigo_gmmc, CASE k WHEN 3 THEN 'data_hora' WHEN 5 THEN 'sem_data_hora' WHEN 7 THEN 'dados_completos'
                           WHEN 9 THEN 'json' ELSE 'ok' END AS motivo,
       CASE WHEN k = 9 THEN 1 ELSE count(*) END AS n
FROM o_feed GROUP BY codigo_gmmc, k
UNION ALL SELECT NULL, 'json', 1""", "v_feed")

ORACLES["silver_stations"] = with_bindings(f"""
WITH o_latest AS ({LATEST_STATION_SQL.strip()})
SELECT e.codigo_gmmc AS estacao_codigo, e.nome_estacao, e.municipio_nome, m.codigo_ibge,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
FROM o_latest e LEFT JOIN v_municipio m ON e.municipio_nome = upper(trim(m.municipio))""",
    "v_feed", "v_municipio")

ORACLES["raw_partition_roundtrip"] = with_bindings("""
SELECT CAST(year(data_hora) AS BIGINT) AS ano, CAST(month(data_hora) AS BIGINT) AS mes,
       CAST(day(data_hora) AS BIGINT) AS dia, COUNT(*) AS n_rows,
       COUNT(DISTINCT codigo_gmmc) AS n_stations,
       MIN(data_hora) AS first_reading, MAX(data_hora) AS last_reading
FROM v_feed GROUP BY 1, 2, 3""", "v_feed")


# ---- re-aimed sources ----------------------------------------------------------------
ORACLES["html_table_rows"] = with_bindings("""
WITH o_months AS (
  SELECT DISTINCT codigo_posto, nome_posto, year(data) AS y, month(data) AS m FROM v_leitura)
SELECT o.codigo_posto, trim(o.nome_posto) AS nome_posto, CAST(o.y AS BIGINT) AS ano,
       CAST(o.m AS BIGINT) AS mes, CAST(t.d AS BIGINT) AS dia, l.precipitacao AS chuva
FROM o_months o CROSS JOIN range(1, 32) t(d)
LEFT JOIN v_leitura l
  ON l.codigo_posto = o.codigo_posto AND year(l.data) = o.y AND month(l.data) = o.m
 AND day(l.data) = t.d""", "v_leitura")

ORACLES["backfill_plan"] = with_bindings("""
WITH o_regions(mesorregiao_id, mesorregiao_nome) AS (
  VALUES (2605, 'Metropolitana_Recife'), (2604, 'Mata_Pernambucana'),
         (2603, 'Agreste_Pernambucano'), (2602, 'Sao_Francisco_Pernambucano'),
         (2601, 'Sertao_Pernambucano')),
o_years AS (SELECT CAST(range AS INTEGER) AS ano FROM range(1961, 2027)),
o_landed AS (
  SELECT DISTINCT mesorregiao_id, CAST(year(data) AS INTEGER) AS ano
  FROM v_leitura WHERE mesorregiao_id IS NOT NULL AND year(data) < 2026)
SELECT CAST(r.mesorregiao_id AS INTEGER) AS mesorregiao_id, r.mesorregiao_nome, y.ano,
       make_date(y.ano, 1, 1) AS data_inicio,
       CASE WHEN y.ano = 2026 THEN DATE '2026-06-30' ELSE make_date(y.ano, 12, 31) END AS data_fim
FROM o_regions r, o_years y
WHERE NOT EXISTS (SELECT 1 FROM o_landed l
                  WHERE l.mesorregiao_id = r.mesorregiao_id AND l.ano = y.ano)""", "v_leitura")

ORACLES["clean_string"] = f"SELECT doc_id, {clean_sql('text')} AS texto_limpo FROM documents"

ORACLES["gazetteer_lookup"] = with_bindings(f"""
WITH o_gaz AS (
  SELECT replace(n_name, 'NATION', 'Natión') AS nome,
         CAST(-8.0 - n_nationkey / 100.0 AS DOUBLE) AS latitude,
         CAST(-35.0 - n_regionkey / 10.0 AS DOUBLE) AS longitude, 1 AS rnk
  FROM nation WHERE n_nationkey % 6 <> 5
  UNION ALL
  SELECT n_name, CAST(-8.0 - n_nationkey / 100.0 AS DOUBLE) - 1.0,
         CAST(-35.0 - n_regionkey / 10.0 AS DOUBLE), 2
  FROM nation WHERE n_nationkey % 6 <> 5),
o_best AS (
  SELECT * FROM (SELECT {clean_sql('nome')} AS k, latitude, longitude,
                        ROW_NUMBER() OVER (PARTITION BY {clean_sql('nome')}
                                           ORDER BY rnk, latitude, longitude) AS rn
                 FROM o_gaz) WHERE rn = 1)
SELECT m.codigo_ibge, m.municipio, b.latitude, b.longitude
FROM v_municipio m JOIN o_best b ON {clean_sql('m.municipio')} = b.k""", "v_municipio")

ORACLES["dimension_write"] = ORACLES["gazetteer_lookup"]

# ---- data quality ----------------------------------------------------------------------
ORACLES["dq_not_null"] = _w(SILVER_CTES, """
SELECT 'bronze.monitoramento_pluviometrico' AS table_name, 'not_null' AS check_name,
       c AS column_name, CAST(n AS BIGINT) AS failing_rows
FROM (SELECT 'codigo_posto' AS c, count(*) FILTER (WHERE codigo_posto IS NULL) AS n FROM v_leitura
      UNION ALL SELECT 'data', count(*) FILTER (WHERE data IS NULL) FROM v_leitura)
UNION ALL
SELECT 'silver.monitoramento_pluviometrico', 'not_null', c, CAST(n AS BIGINT)
FROM (SELECT 'codigo_posto' AS c, count(*) FILTER (WHERE codigo_posto IS NULL) AS n FROM k_silver
      UNION ALL SELECT 'data', count(*) FILTER (WHERE data IS NULL) FROM k_silver
      UNION ALL SELECT 'ano', count(*) FILTER (WHERE ano IS NULL) FROM k_silver
      UNION ALL SELECT 'mes', count(*) FILTER (WHERE mes IS NULL) FROM k_silver
      UNION ALL SELECT 'dia', count(*) FILTER (WHERE dia IS NULL) FROM k_silver
      UNION ALL SELECT 'periodo_clima', count(*) FILTER (WHERE periodo_clima IS NULL) FROM k_silver
      UNION ALL SELECT 'alerta_chuva', count(*) FILTER (WHERE alerta_chuva IS NULL) FROM k_silver)
""", "v_municipio", "v_leitura")

ORACLES["dq_unique"] = _w(SILVER_CTES, """
SELECT 'bronze.monitoramento_pluviometrico' AS table_name, 'unique_combination' AS check_name,
       'codigo_posto,data' AS column_name,
       CAST((SELECT count(*) FROM (SELECT codigo_posto, data FROM v_leitura
             GROUP BY 1, 2 HAVING count(*) > 1)) AS BIGINT) AS failing_rows
UNION ALL
SELECT 'silver.monitoramento_pluviometrico', 'unique_combination', 'codigo_posto,data',
       CAST((SELECT count(*) FROM (SELECT codigo_posto, data FROM k_silver
             GROUP BY 1, 2 HAVING count(*) > 1)) AS BIGINT)""", "v_municipio", "v_leitura")

ORACLES["dq_accepted"] = _w(SILVER_CTES, """
SELECT 'bronze.monitoramento_pluviometrico' AS table_name, 'accepted_values' AS check_name,
       'mesorregiao_id' AS column_name,
       CAST(count(*) FILTER (WHERE mesorregiao_id NOT IN (2601, 2602, 2603, 2604, 2605))
            AS BIGINT) AS failing_rows
FROM v_leitura
UNION ALL
SELECT 'silver.monitoramento_pluviometrico', 'accepted_values', 'periodo_clima',
       CAST(count(*) FILTER (WHERE periodo_clima NOT IN ('Chuvoso', 'Seco', 'Desconhecido'))
            AS BIGINT)
FROM k_silver
UNION ALL
SELECT 'silver.monitoramento_pluviometrico', 'accepted_values', 'alerta_chuva',
       CAST(count(*) FILTER (WHERE alerta_chuva NOT IN
            ('Normal', 'Perigo Potencial', 'Perigo', 'Grande Perigo')) AS BIGINT)
FROM k_silver""", "v_municipio", "v_leitura")

ORACLES["dq_file_integrity"] = with_bindings("""
WITH o_wide AS (
  SELECT DISTINCT codigo_posto, mesorregiao_id, year(data) AS y, month(data) AS m
  FROM v_leitura),
o_tag AS (SELECT *, CASE WHEN codigo_posto % 7 = 3 THEN y + 1 ELSE y END AS tag FROM o_wide)
SELECT mesorregiao_id, CAST(tag AS INTEGER) AS ano_ref, CAST(tag AS BIGINT) AS expected_year,
       count(*) AS n_rows, CAST(min(y) AS BIGINT) AS year_min, CAST(max(y) AS BIGINT) AS year_max,
       CASE WHEN count(y) = 0 THEN 'no_valid_values'
            WHEN min(y) <> max(y) OR min(y) <> tag THEN 'inconsistent'
            ELSE 'ok' END AS status
FROM o_tag GROUP BY mesorregiao_id, tag""", "v_leitura")

_UNITS_SQL = ORACLES["dq_file_integrity"]
ORACLES["raw_csv_integrity"] = _UNITS_SQL
ORACLES["dq_file_summary"] = f"""
SELECT status, count(*) AS n_units FROM ({_UNITS_SQL}) GROUP BY status"""
