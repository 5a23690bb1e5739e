"""The 15-minute station feed.

The source publishes a JSON array of readings; each carries the nested JSON
*string* ``Dados_completos``. Parsing is built-in: ``from_json`` to a struct,
``dc_`` prefix for its fields, rename to the standard names, lenient numbers,
strict timestamps: a bad timestamp fails a batch read; the landing stream
puts such readings, and files that are no JSON, in a side folder and goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainrisk.functions.parse import strict_double

# --- fixed values (must equal the reference's feed layout) -------------------
TOP_FIELDS = ["Data-hora", "Estação", "Codigo_gmmc", "Dados_completos"]
NESTED_FIELDS = ["chuva", "latitude", "longitude", "cidade", "nome", "tipo", "uf"]
NESTED_PREFIX = "dc_"
RENAMES = {
    "Data-hora": "data_hora",
    "Estação": "estacao_nome",
    "Codigo_gmmc": "codigo_gmmc",
    "dc_chuva": "chuva",
    "dc_latitude": "latitude",
    "dc_longitude": "longitude",
    "dc_cidade": "cidade",
    "dc_nome": "nome_estacao",
    "dc_tipo": "tipo",
    "dc_uf": "uf",
}
NUMERIC = ["chuva", "latitude", "longitude"]
TEXT = ["estacao_nome", "codigo_gmmc", "cidade", "nome_estacao", "tipo", "uf"]
FEED_COLUMNS = ["data_hora", "estacao_nome", "codigo_gmmc", "chuva", "latitude",
                "longitude", "cidade", "nome_estacao", "tipo", "uf", "ingestao_ts"]
# -----------------------------------------------------------------------------

PAYLOAD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in TOP_FIELDS])

# a file that is no JSON, or no array of readings, arrives as one row with its text here
CORRUPT = "_corrompido"
PAYLOAD_OR_CORRUPT = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])

LANDED_SCHEMA = T.StructType([
    T.StructField("data_hora", T.TimestampNTZType()),
    *[T.StructField(c, T.DoubleType() if c in NUMERIC else T.StringType())
      for c in FEED_COLUMNS[1:-1]],
    T.StructField("ingestao_ts", T.TimestampType()),
    T.StructField("ano", T.StringType()),
    T.StructField("mes", T.StringType()),
    T.StructField("dia", T.StringType()),
    T.StructField("lote", T.LongType()),
])
REJECT_SCHEMA = "motivo string, arquivo string, registro string, ingestao_ts timestamp, lote long"


def read_payload(spark: SparkSession, path: str, json_array: bool = True) -> DataFrame:
    """Landed payload files → one row per reading.

    ``json_array=True`` reads files that hold one JSON array each (the API
    response); ``False`` reads JSON lines.
    """
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", json_array).json(path)


def flatten_nested(df: DataFrame, column: str = "Dados_completos",
                   fields: list[str] | None = None, prefix: str = NESTED_PREFIX) -> DataFrame:
    """F12 + P6: parse a JSON-string column and lift its fields as ``dc_*``."""
    fields = list(fields or NESTED_FIELDS)
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    parsed = F.from_json(F.col(column), schema)
    return df.select(*[c for c in df.columns if c != column],
                     *[parsed.getField(f).alias(prefix + f) for f in fields])


def bad_timestamp() -> Column:
    """Payload rows whose timestamp text is no timestamp."""
    raw = F.col("Data-hora")
    return raw.isNotNull() & raw.try_cast("timestamp_ntz").isNull()


def reject_reason() -> Column:
    """Why a row of a payload read with ``PAYLOAD_OR_CORRUPT`` cannot land
    (NULL: it can): no JSON, no timestamp or no valid one, or a nested text
    that is no JSON object."""
    nested = F.trim(F.col("Dados_completos"))
    no_object = nested.isNull() | ~nested.startswith("{") | F.get_json_object(nested, "$").isNull()
    return (F.when(F.col(CORRUPT).isNotNull(), "json").when(F.col("Data-hora").isNull(), "sem_data_hora")
            .when(bad_timestamp(), "data_hora").when(no_object, "dados_completos"))


def typed_feed(payload: DataFrame, ingest_ts: Column | None = None,
               extra_nested: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Payload rows → the landed feed schema.

    Numbers that do not parse become NULL; a timestamp that does not parse
    fails the job (ANSI), which aborts the batch like the reference; with
    ``strict=False`` such rows are left out (see ``bad_timestamp``). Missing
    text stays NULL rather than becoming the text 'None' (D6).
    """
    if not strict:
        payload = payload.where(~bad_timestamp())
    fields = NESTED_FIELDS + list(extra_nested or [])
    flat = flatten_nested(payload, fields=fields)
    flat = flat.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in flat.columns})
    ts = ingest_ts if ingest_ts is not None else F.current_timestamp()
    cols = {
        "data_hora": F.to_timestamp_ntz(F.col("data_hora")) if strict else F.col("data_hora").try_cast("timestamp_ntz"),
        **{c: strict_double(F.col(c)) for c in NUMERIC},
        **{c: F.col(c).cast("string") for c in TEXT},
        "ingestao_ts": ts,
    }
    extra = [F.col(NESTED_PREFIX + f) for f in (extra_nested or [])]
    return flat.select(*[cols[c].alias(c) for c in FEED_COLUMNS], *extra)


def with_ingest_partitions(feed: DataFrame) -> DataFrame:
    """S8 keys: ingestion date as ``ano`` / zero-padded ``mes`` / ``dia``."""
    ts = F.col("ingestao_ts")
    return feed.withColumns({
        "ano": F.year(ts).cast("string"),
        "mes": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "dia": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
    })


def write_array_files(payload: DataFrame, path: str, rows_per_file: int = 5000) -> None:
    """Payload rows as files that hold one JSON array each (the API's form):
    rows are dealt to arrays of about ``rows_per_file`` by a hash."""
    n = F.ceil(F.count(F.lit(1)) / rows_per_file)
    files = payload.agg(F.greatest(n, F.lit(1))).scalar()
    one = payload.select(F.to_json(F.struct(*TOP_FIELDS)).alias("j"), F.pmod(F.xxhash64(*TOP_FIELDS), files).alias("file"))
    arrays = one.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value"))
    arrays.repartition("file").write.mode("overwrite").partitionBy("file").text(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """S3: hive-partitioned landed feed; partition keys stay text ('05'), ``lote``
    is the micro-batch that landed the row."""
    return spark.read.schema(LANDED_SCHEMA).option("basePath", path).parquet(path)


def payload_from_feed(feed: DataFrame) -> DataFrame:
    """Build API payload rows from feed-shaped rows (used to land test input).

    The nested string carries the reading, the city and the station name,
    merged with whatever the row's own ``props`` JSON holds.
    """
    own = F.create_map(F.lit("chuva"), F.col("chuva").cast("string"),
                       F.lit("cidade"), F.col("cidade"),
                       F.lit("nome"), F.col("nome_estacao"))
    nested = F.to_json(F.map_concat(F.from_json(F.col("props"), "map<string,string>"), own))
    return feed.select(
        F.date_format(F.col("data_hora"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Data-hora"),
        F.col("nome_estacao").alias("Estação"),
        F.col("codigo_gmmc").alias("Codigo_gmmc"),
        nested.alias("Dados_completos"))
