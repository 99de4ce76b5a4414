"""Line dedup: lines that many documents share stay in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_columns, stage
from .licenses import lowered

#: White space that is stripped from a line's ends: the bytes 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text as an array; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def digest(text: Column) -> Column:
    """16 bytes."""
    return F.unhex(F.md5(text))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text_key, pos, key): the lines whose key has at least min_chars code points, as digests of their keys."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("id"), digest(text).alias("text_key"), F.posexplode(lines_of(text)).alias("pos", "line"))
    return lines.where(F.length(stripped(F.col("line"))) >= min_chars).select("id", "text_key", "pos", digest(lowered(stripped(F.col("line")))).alias("key"))


def shared_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """(key, last): keys that at least min_docs documents hold, and the document that keeps them.

    A document counts once for a key, and is told by its id, or by its text where it has none. Both groupings combine before they shuffle, so a key that
    a third of all documents hold costs one row a partition in the second.
    """
    document = F.struct(F.col("id"), F.when(F.col("id").isNull(), F.col("text_key")).alias("text"))
    held = keys.groupBy("key", document.alias("document")).agg(F.lit(1).alias("one"))
    return held.groupBy("key").agg(F.count("*").alias("n"), F.max("document").alias("last")).where(F.col("n") >= min_docs).select("key", "last")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the kept lines as text, and n_lines and n_dropped (long) behind their columns.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of at least min_chars code
    points that at least min_docs documents hold loses all its lines but those of the document of the largest id. All
    other lines stay as they are, in their order.

    Null and empty texts are one empty line; a null text comes back empty. Rows of one id are one document, and keep or
    lose a line together. A row without an id is told by its text, and comes before all ids; where no holder has an id,
    the text of the largest digest keeps the line. Repeated rows stay. Columns of docs named n_lines or n_dropped get the
    suffix _input. An empty table gives an empty result.

    Keys are 16-byte digests, staged with their places: texts are shuffled once, to the numbers of their dropped lines. A
    hot key is one row of the small side of a join, whose other side adaptive execution splits.
    """
    docs = own_columns(docs, ["n_lines", "n_dropped"])
    names = docs.columns
    keys = stage(line_keys(docs, id_col, text_col, min_chars), "lines-keys")
    shared = stage(shared_lines(keys, min_docs), "lines-shared")
    keeps = F.col("id").eqNullSafe(F.col("last.id")) & (F.col("id").isNotNull() | (F.col("text_key") == F.col("last.text")))
    dropped = keys.join(shared, "key").where(~keeps).groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_text_key")).agg(F.collect_set("pos").alias("_drop"))
    marked = docs.withColumns({"_own": digest(F.coalesce(F.col(text_col), F.lit(""))), "_lines": lines_of(F.col(text_col))})
    marked = marked.drop(text_col).join(dropped.hint("merge"), F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_text_key")), "left")
    n = F.size("_lines")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("_drop")), lambda k: F.get(F.col("_lines"), k))
    text = F.array_join(F.coalesce(kept, F.col("_lines")), "\n")
    n_dropped = F.coalesce(F.size("_drop"), F.lit(0)).cast("long")
    return marked.select(*[text.alias(c) if c == text_col else F.col(c) for c in names], n.cast("long").alias("n_lines"), F.when(F.col("_drop").isNull(), 0).otherwise(n_dropped).alias("n_dropped"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dedup_lines over all documents: keys of 20 code points in 3 documents."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id != s.last AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
