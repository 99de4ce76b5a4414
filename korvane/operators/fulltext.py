"""Ranked full-text search over weighted fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fold

#: Weights of the classes of fields.
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}


def tokens(c: Column) -> Column:
    return F.filter(F.split(fold(c), " "), lambda w: w != "")


def search(docs: DataFrame, fields: list[tuple[str, str]], query: str, k: int, key: str) -> DataFrame:
    """The k best rows for the words of a query: (key, score, n_words).

    A word in a field of a class counts the class's weight times 1 + ln(how often). Rows need one of the words at least;
    those with more of them come first, then the score, then the smaller key.
    """
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(query,)], "q string").select(F.array_distinct(tokens(F.col("q"))).alias("q")).first()["q"]
    rows = None
    for name, kind in fields:
        part = docs.select(key, F.explode(F.filter(tokens(F.col(name)), lambda w: w.isin(wanted))).alias("word"), F.lit(WEIGHTS[kind]).alias("weight"), F.lit(name).alias("field"))
        rows = part if rows is None else rows.unionByName(part)
    hits = rows.groupBy(key, "field", "word").agg((F.max("weight") * (1 + F.ln(F.count("*")))).alias("s"))
    found = hits.groupBy(key).agg(F.sum("s").alias("score"), F.countDistinct("word").alias("n_words"))
    return found.orderBy(F.desc("n_words"), F.desc(F.round("score", 9)), key).limit(k)


# Stored index: postings by word, so that a query reads its own words' buckets and not all documents.

#: Endings of French words and what takes their place, the first that fits and leaves three letters at least.
ENDINGS = [("issements", ""), ("issement", ""), ("ements", ""), ("ement", ""), ("ations", ""), ("ation", ""), ("ateurs", ""), ("ateur", ""), ("eaux", "eau"), ("aux", "al"), ("euses", "eu"), ("euse", "eu"), ("eux", "eu"), ("ives", "if"), ("ive", "if"), ("ees", ""), ("ee", ""), ("es", ""), ("er", ""), ("ez", ""), ("e", ""), ("s", ""), ("x", "")]


def stem(word: Column) -> Column:
    """A light stem of a folded word: plurals, feminines and common suffixes go. Figures and words of up to three letters stay."""
    out = None
    for ending, instead in ENDINGS:
        fits = word.endswith(ending) & (F.length(word) - len(ending) >= 3) & ~word.rlike("[0-9]")
        cut = F.concat(F.left(word, F.length(word) - len(ending)), F.lit(instead))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(word)


def stems(c: Column, stemmed: bool) -> Column:
    return F.transform(tokens(c), stem) if stemmed else tokens(c)


def bucket_of(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def build_index(docs: DataFrame, fields: list[tuple[str, str]], key: str, path: str, buckets: int = 64, stemmed: bool = False) -> None:
    """Write the postings of docs to path: (word, key, field, s: the field's part of the score, n_docs: documents with the word), a folder for each bucket of words.

    A word in a field of a class counts the class's weight times 1 + ln(how often). Words are stems where `stemmed`. Fields
    are exploded once, here; searches read postings. Frequencies are counted by word, so a word of nearly all documents
    costs its postings and one row a partition more.
    """
    rows = None
    for name, kind in fields:
        part = docs.select(F.col(key).alias("key"), F.explode(stems(F.col(name), stemmed)).alias("word"), F.lit(WEIGHTS[kind]).alias("weight"), F.lit(name).alias("field"))
        rows = part if rows is None else rows.unionByName(part)
    postings = rows.groupBy("word", "key", "field").agg((F.max("weight") * (1 + F.ln(F.count("*")))).alias("s"))
    held = postings.groupBy("word").agg(F.countDistinct("key").alias("n_docs"))
    out = postings.join(held, "word").withColumn("bucket", bucket_of(F.col("word"), buckets))
    out.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(8))).sortWithinPartitions("bucket", "word", "key").write.mode("overwrite").partitionBy("bucket").parquet(path)


def postings(spark: SparkSession, path: str, wanted: list[str], buckets: int) -> DataFrame:
    """The postings of some words: only their buckets' folders are listed by the scan, and within them row groups by word."""
    numbers = [r["b"] for r in spark.createDataFrame([(w,) for w in wanted], "w string").select(bucket_of(F.col("w"), buckets).alias("b")).distinct().collect()]
    return spark.read.parquet(path).where(F.col("bucket").isin(numbers) & F.col("word").isin(wanted))


def search_index(spark: SparkSession, path: str, query: str, k: int, buckets: int = 64, stemmed: bool = False) -> DataFrame:
    """search() from a built index: the k best (key, score, n_words). An empty query finds nothing."""
    asked = spark.createDataFrame([(query,)], "q string").select(F.array_distinct(stems(F.col("q"), stemmed)).alias("q")).first()["q"]
    found = postings(spark, path, asked, buckets).groupBy("key").agg(F.sum("s").alias("score"), F.countDistinct("word").alias("n_words"))
    return found.orderBy(F.desc("n_words"), F.desc(F.round("score", 9)), "key").limit(k)
