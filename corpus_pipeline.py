"""Corpus pipeline: documents through the operators of ``rainrisk.llm``.

Each stage takes (spark, docs, sf_dir), docs with the columns of documents
(more may follow and are carried), and is written as Parquet and read again
for the next one:

1. ``quality``: documents scored below the classifier's threshold go. A text
   without words is scored like any other; without labels nothing goes.
2. ``near_duplicates``: of documents linked by five-word shingles at a
   similarity of 0.8 or more, the one with the smallest doc_id stays; texts
   without words are linked with nothing and stay; of rows with the same doc_id
   and text one stays, rows that repeat a doc_id with other texts are documents
   of their own; rows with a null doc_id stay.
3. ``repeated_passages``: bytes covered by a string of PASSAGE bytes (a passage
   of 51 words of five bytes with their blanks) that also starts elsewhere are cut out (cut characters are dropped); no row goes;
   ``n_chars``, where present, follows the text.
4. ``mix``: op10's entropy target and repetition limit, with a budget that
   reads every document at least once; documents of smaller sources are
   repeated, none more than MAX_REPETITION times on average of its source.
   Rows with a null doc_id are read once.
5. ``encode``: ids and the decoded bytes of every row, as digests.

An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.llm import byte_bpe, mixing, ngram_join, quality, suffix_dedup
from rainrisk.llm.common import materialise, quoted, ship, table

MAX_REPETITION = mixing.MAX_REPETITION
PASSAGE = 255


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    net = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    out = "_score"
    while out in {c.lower() for c in docs.columns}:
        out = "_" + out
    return quality.score(docs, net, out=out).where(F.col(out) >= quality.THRESHOLD).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    n, stays = "_n", "_stays"
    while {n, stays} & {c.lower() for c in docs.columns}:
        n, stays = "_" + n, "_" + stays
    own = docs.withColumn(n, F.xxhash64("doc_id", "text"))  # a row's identity: doc_id and text
    known = own.where("doc_id is not null").dropDuplicates([n])  # one of equal rows, before any shuffle
    groups = ngram_join.jaccard_components(known.select(F.col(n).alias("doc_id"), "text"), n=5, num=4, den=5)
    of = known.select(F.col(n).alias("k"), F.col("doc_id").alias("d")).distinct()
    stay = groups.select("doc_id", "component_id").distinct().join(of, F.col("doc_id") == F.col("k")) \
        .groupBy("component_id").agg(F.min(F.struct("d", "k")).alias("s")).select(F.col("s.k").alias(stays))
    kept = known.join(stay, F.col(n) == F.col(stays), "left_semi")
    return kept.drop(n).unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = suffix_dedup.remove_repeats(docs, PASSAGE)
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    text = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", ""))
    cols = [text.alias("text") if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"row.{quoted([c])[0]}") for c in docs.columns]
    return cut.select(*cols)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dealt = mixing.mix_sources(docs, entropy=mixing.ENTROPY, max_repetition=MAX_REPETITION, budget="cover")
    copies = dealt.groupBy(F.col("doc_id").alias("m"), F.col("source").alias("s"), F.col("n_tokens").alias("t")) \
        .agg(F.max("copies").alias("k")).where("m is not null and k > 1")
    n_tokens = F.regexp_count(F.coalesce("d.text", F.lit("")), F.lit(mixing.WORDS)).cast("long")
    same = (F.col("d.doc_id") == F.col("c.m")) & F.col("d.source").eqNullSafe(F.col("c.s")) & (n_tokens == F.col("c.t"))
    rows = docs.alias("d").join(copies.alias("c"), same, "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce(F.col("c.k"), F.lit(1)).cast("long"))
    return rows.select(F.struct("d.*").alias("row"), F.explode(times).alias("copy")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    ship(spark)
    return byte_bpe.digests(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

#: The classifier is trained, so SQL can't express the first stage; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
