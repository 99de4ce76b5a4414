"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_columns, stage

#: A mean is cut into equal parts of this size at most, each drawn on its own: a sum of Poisson draws is a Poisson draw.
PART = 8.0
#: Terms of the distribution of one part; the rest of its tail is below 1e-16.
TERMS = 48
#: Columns that the mixture adds.
ADDED = ["copy", "rate", "shuffle_key"]
#: Rows of the table of rates up to which it is broadcast.
BROADCAST_SOURCES = 50_000
#: Rows of a source that one salt of the join takes.
SALT_ROWS = 1_000_000
#: Bytes of text of one partition of the mixture, at most; there are as many partitions as a shuffle has, at least.
PARTITION_BYTES = 128 << 20


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by '/'. Equal for equal parts on any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, rate, size): the mean number of copies of a source's documents, and their bytes.

    A source's size is its UTF-8 bytes. weights (source, weight) are the targets; without them a source's target is its
    size to the power `temperature`. The rates keep the total size: sum of rate * size is the size of all documents.
    Sources without a weight, and of size 0, have rate 0; a null source is a source of its own.
    """
    size = stage(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0))).alias("size")), "mixing-sizes")
    if weights is None:
        target = size.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        w = weights.groupBy(F.col("source").alias("w_source")).agg(F.sum("weight").cast("double").alias("weight"))
        target = size.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    sums = target.agg(F.sum("size").cast("double").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight")).first()
    all_size, all_weight = float(sums["all_size"] or 0.0), float(sums["all_weight"] or 0.0)
    if not all_size or not all_weight:
        return target.select("source", F.lit(0.0).alias("rate"), "size")
    rate = F.lit(all_size) * F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)) / F.lit(all_weight) / F.col("size").cast("double")
    return target.select("source", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"), "size")


def poisson_table(rate: Column) -> Column:
    """The distribution function of one part of the mean, as an array of TERMS values."""
    part = rate / F.greatest(F.ceil(rate / PART), F.lit(1)).cast("double")
    first = F.exp(-part)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        F.struct(first.alias("term"), first.alias("total"), F.array(first).alias("cdf")),
        lambda a, k: F.struct((a["term"] * part / k).alias("term"), (a["total"] + a["term"] * part / k).alias("total"), F.concat(a["cdf"], F.array(a["total"] + a["term"] * part / k)).alias("cdf")),
        lambda a: a["cdf"],
    )


def replicate(docs: DataFrame, table: DataFrame, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Every row of docs as often as its Poisson draw says, with `copy` (from 1), `rate` and `shuffle_key`.

    The draw inverts the distribution at a hash of seed and id, so a document is drawn alike in every run; repeated rows
    of an id are drawn alike too, and a null id counts as the empty text. Clashing columns of docs get the suffix _input.
    """
    docs = own_columns(docs, ADDED)
    cdf = table.select(F.col("source").alias("_source"), F.col("rate"), F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int").alias("_parts"), poisson_table(F.col("rate")).alias("_cdf"))
    on = F.col(source_col).eqNullSafe(F.col("_source"))
    if table.count() <= BROADCAST_SOURCES:
        rows = docs.join(F.broadcast(cdf), on)
    else:  # salted: the source with most rows meets a copy of its rate for each SALT_ROWS of them
        largest = docs.groupBy(source_col).count().agg(F.max("count")).first()[0] or 0
        salts = max(1, -(-largest // SALT_ROWS))
        salt = F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")
        spread = cdf.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = docs.withColumn("_mine", salt).join(spread, on & (F.col("_mine") == F.col("_salt"))).drop("_mine", "_salt")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")),
        F.lit(0),
        lambda n, k: n + F.size(F.filter("_cdf", lambda c: c <= unit(F.lit(seed), name, k.cast("string")))),
    )
    rows = rows.withColumn("_n", F.when(F.col("rate") > 0, drawn).otherwise(0)).where("_n > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    key = F.md5(F.concat_ws("/", F.lit(seed), F.lit("order"), name, F.col("copy").cast("string")))
    return rows.withColumn("shuffle_key", key).drop("_source", "_parts", "_cdf", "_n")


def mix(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, seed: str = "mix") -> DataFrame:
    """docs mixed to the target weights, in global random order: that of shuffle_key, over partitions and within each.

    The key is a hash, so its leading bits say the partition and all are about even, whatever the sources, without a
    sample. An empty table gives an empty result.
    """
    table = rates(docs, weights, temperature)
    size = table.agg(F.sum(F.col("rate") * F.col("size"))).first()[0] or 0.0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size) // PARTITION_BYTES + 1)
    part = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") * n / float(1 << 32)).cast("int")
    return replicate(docs, table, seed).repartitionById(n, part).sortWithinPartitions("shuffle_key")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mix over all documents: every copy with its whole text."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "copy", "source", F.round("rate", 9).alias("rate"), "shuffle_key", "lang", "n_chars", "text")


OP4_SQL = """
WITH size AS (
  SELECT source, CAST(sum(coalesce(strlen(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
), total AS (
  SELECT sum(size) AS all_size, sum(CASE WHEN size > 0 THEN sqrt(size) END) AS all_weight FROM size
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN all_size * sqrt(size) / all_weight / size ELSE 0 END AS rate FROM size, total
), parts AS (
  SELECT *, CAST(greatest(ceil(rate / 8), 1) AS BIGINT) AS parts FROM rates
), terms AS (
  SELECT source, k, exp(-(rate / parts)) * CASE WHEN k = 0 THEN 1 ELSE list_product(list_transform(range(1, k + 1), lambda i: rate / parts / i)) END AS term
  FROM parts, range(48) AS r(k)
), cdf AS (
  SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
), tables AS (
  SELECT source, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source
), draws AS (
  SELECT d.doc_id, d.source, d.lang, d.n_chars, d.text, p.rate,
         list_sum(list_transform(range(1, p.parts + 1), lambda k: len(list_filter(t.cdf,
           lambda c: c <= CAST(CAST('0x' || substr(md5('mix/' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '/' || CAST(k AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0)))) AS n
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
  WHERE p.rate > 0
), copies AS (
  SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM draws WHERE n > 0
)
SELECT doc_id, CAST(copy AS INTEGER) AS copy, source, round(rate, 9) AS rate,
       md5('mix/order/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || CAST(copy AS VARCHAR)) AS shuffle_key, lang, n_chars, text
FROM copies
"""


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mixture, with the columns of docs, clashing ones too; a document drawn n times is n rows.

    Null texts count as empty, repeated rows and null ids are drawn as replicate says. An empty table gives an empty result.
    """
    renamed = dict(zip(docs.columns, own_columns(docs, ADDED).columns, strict=True))
    return mix(docs).select([F.col(new).alias(old) for old, new in renamed.items()])
