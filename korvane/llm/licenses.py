"""Licence scans with ordered signature rules, in DataFrame functions only."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_rules import RULES

#: Phrases that are always found where their words stand consecutively: phrase, label.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: How sure a detection of each tier is.
SURE = {1: 0.99, 2: 0.9, 3: 0.7, 4: 0.3}
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rules() -> list[tuple[int, str, str, str]]:
    """(tier, label, keyword, pattern) in order."""
    return [(int(t), label, word, pattern) for t, label, word, pattern in (x.split(" ", 3) for x in RULES.splitlines())]


def padded(words: str) -> str:
    """Words, or a pattern over words, as they stand in a line of words() text: a space on each side of each word."""
    return " " + words.replace(" ", "  ") + " "


def always(pattern: str) -> set[str]:
    """The words that every match of a pattern holds: those outside its groups."""
    return set(re.sub(r"\(\?:[^()]*\)(?:\?|\{[^}]*\})?", " ", pattern).split())


def gate() -> str:
    """One pattern that finds something in each text in which a rule or a base phrase can match.

    It looks for the rules' keywords, but for `license` where a pattern always holds that, as few texts do.
    """
    words: set[str] = set()
    for pattern, word in [(p, w) for _, _, w, p in rules()] + [(p, p.split()[0]) for p, _ in BASE]:
        held = always(pattern)
        words.add("licen[cs]e" if held & {"license", "licence", "licen[cs]e"} else word)
    return rf"(?i)(?<![0-9A-Za-z\x{{80}}-\x{{10FFFF}}])(?:{'|'.join(sorted(words))})(?![0-9A-Za-z\x{{80}}-\x{{10FFFF}}])"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; lower() does just that to ASCII and is much faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_of(text: Column) -> Column:
    """All words of a text in lower case, a space on each side of each."""
    words = F.regexp_replace(F.regexp_replace(lowered(text), GAP, "  "), r"^ +| +$", "")
    return F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), r"^ +$", "")


def words_in(part: Column) -> Column:
    return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("long")


def base_of(line: Column) -> Column:
    """An entry for each base phrase: label, places, first and last word."""
    entries = []
    for phrase, label in BASE:
        parts = F.split(line, padded(phrase), -1)
        n = F.size(parts) - 1
        first = words_in(F.element_at(parts, 1))
        last = words_in(line) - words_in(F.element_at(parts, -1)) - len(phrase.split())
        entries.append(F.when(F.contains(line, F.lit(padded(phrase))), F.struct(F.lit(label).alias("label"), n.cast("long").alias("n"), first.alias("first"), last.alias("last"))))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def once(value: Column, then) -> Column:
    """then(value), an array, with value computed once however often then uses it."""
    return F.flatten(F.transform(F.array(value), then))


#: Marks put around a match; lines of words hold no such characters.
OPEN, CLOSE = "\u0001", "\u0002"


def places(line: Column, rule: Column) -> Column:
    """(start, less, tier, rank, label) of each match of a rule: its first word, counted from 0, and less the word behind it.

    The matches are marked and the line cut into words, so that the k-th pair of marks has 2 k marks before it.
    """
    words = F.split(F.btrim(F.regexp_replace(line, rule["pattern"], F.lit(f" {OPEN} $0 {CLOSE} "))), " +")
    at = lambda ws, mark: F.filter(F.transform(ws, lambda w, i: F.when(w == mark, i)), lambda i: i.isNotNull())
    ends = lambda ws: F.array(F.struct(at(ws, OPEN).alias("open"), at(ws, CLOSE).alias("close")))
    one = lambda m, i, k: F.struct((i - 2 * k).alias("start"), (2 * k + 1 - F.get(m["close"], k)).alias("less"), rule["tier"].alias("tier"), rule["rank"].alias("rank"), rule["label"].alias("label"))
    return once(words, lambda ws: F.flatten(F.transform(ends(ws), lambda m: F.transform(m["open"], lambda i, k: one(m, i, k)))))


def outside(every: Column) -> Column:
    """Of detections in order of start, longest first, then tier and rank, those that lie in none before of their own or a better tier.

    How far the ones before reach, by tier, is found in blocks: within a block, and up to each block. A block holds the
    cube root of their number, so the work grows with its power 4/3 and no array is built up item by item.
    """
    tiers = sorted(SURE)
    none = F.struct(*[F.lit(-1).alias(f"e{t}") for t in tiers])
    add = lambda a, d: F.struct(*[F.when(d["tier"] == t, F.greatest(a[f"e{t}"], -d["less"])).otherwise(a[f"e{t}"]).alias(f"e{t}") for t in tiers])
    both = lambda a, b: F.struct(*[F.greatest(a[f"e{t}"], b[f"e{t}"]).alias(f"e{t}") for t in tiers])
    size = lambda x: F.greatest(F.lit(8), F.ceil(F.cbrt(F.size(x)))).cast("int")
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / size(x)).cast("int") - 1), lambda b: F.slice(x, b * size(x) + 1, size(x)))
    reach = lambda blocks: F.transform(blocks, lambda b: F.aggregate(b, none, add))

    def free(d: Column, before: Column) -> Column:
        own = F.greatest(before["e1"], *[F.when(d["tier"] >= t, before[f"e{t}"]).otherwise(-1) for t in tiers[1:]])
        return F.struct(d["start"].alias("start"), (-d["less"]).alias("end"), d["tier"].alias("tier"), d["rank"].alias("rank"), d["label"].alias("label"), (own < -d["less"]).alias("free"))

    def judged(blocks: Column) -> Column:
        upto = lambda most: F.transform(most, lambda m, b: F.aggregate(F.slice(most, F.lit(1), b), none, both))
        of = lambda start, block: F.transform(block, lambda d, i: free(d, F.aggregate(F.slice(block, F.lit(1), i), start, add)))
        return once(reach(blocks), lambda most: once(upto(most), lambda starts: F.flatten(F.transform(blocks, lambda block, b: of(F.get(starts, b), block)))))

    some = once(every, lambda x: F.when(F.size(x) > 0, once(cut(x), judged)).otherwise(F.array().cast("array<struct<start:int,end:int,tier:int,rank:int,label:string,free:boolean>>")))
    kept = F.filter(some, lambda d: d["free"])
    return F.transform(kept, lambda d: F.struct(*[d[c].alias(c) for c in ("start", "end", "tier", "rank", "label")]))


def detections(line: Column) -> Column:
    """What the rules find and what is left after suppression: (start, end, tier, rank, label), by place.

    Only rules whose keyword the line holds are tried. A detection goes if it lies within another of the same or a better
    tier; of two on one interval the better tier stays, then the earlier rule.
    """
    table = F.array(*[F.struct(F.lit(t).alias("tier"), F.lit(k).alias("rank"), F.lit(label).alias("label"), F.lit(f" {word} ").alias("word"), F.lit(padded(p)).alias("pattern")) for k, (t, label, word, p) in enumerate(rules())])
    held = F.filter(table, lambda r: F.contains(line, r["word"]) & F.regexp_like(line, r["pattern"]))
    return outside(F.array_sort(F.flatten(F.transform(held, lambda r: places(line, r)))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, base, found) for each row of docs: base of base_of(), and found of detections(), hints only where nothing better is left.

    Null and empty texts have no words and nothing found. Texts are read whole. Repeated rows and null ids keep their
    rows; other columns are not read. An empty table gives an empty result. start and end count the text's words from 0, end exclusive.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(text.rlike(gate()), line_of(text)).alias("line"))
    base = F.when(F.col("line").isNotNull(), base_of(F.col("line")))
    found = F.when(F.col("line").isNotNull(), detections(F.col("line")))
    rows = rows.select("id", "n_words", base.alias("base"), found.alias("found"))
    best = F.array_min(F.transform("found", lambda d: d["tier"]))
    return rows.select("id", "n_words", "base", F.when(best == 4, F.col("found")).otherwise(F.filter("found", lambda d: d["tier"] < 4)).alias("found"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scan over all documents, as the contract's columns."""
    rows = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    none = F.array().cast("array<string>")
    base = F.coalesce(F.transform("base", lambda e: e["label"]), none)
    found = F.coalesce(F.transform("found", lambda e: e["label"]), none)
    sure = F.coalesce(F.array_max(F.transform("found", lambda e: F.element_at(F.create_map(*[F.lit(x) for kv in SURE.items() for x in kv]), e["tier"]))), F.lit(0.0))
    n = F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, e: a + e["n"]), F.lit(0))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n.alias("n_base"),
        F.array_min(F.transform("base", lambda e: e["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda e: e["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, found))), ",").alias("labels"),
        F.greatest(sure, F.when(n > 0, SURE[2]).otherwise(0.0)).alias("score"),
    )
