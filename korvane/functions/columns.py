"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters with marks and what they become; two letters for the ligatures.
ACCENTS = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
#: Words by which published grids say that there is nothing.
ABSENT = ("", "-", "--", "n/a", "na", "non", "no", "none", "s.o.", "null", "nan")
SQUARE_METRES_PER_SQUARE_FOOT = 0.09290304


def once(value: Column, use) -> Column:
    """use(value), where value is worked out once however often use names it, in lambdas too."""
    return F.get(F.transform(F.array(value), use), 0)


def worked_out(df: DataFrame, **values: Column) -> DataFrame:
    """df with columns that are worked out once a row. A filter on a plain column is pushed below it and carries its whole expression along, once for each use; it does not pass this generator."""
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def number(c: Column) -> Column:
    """Text as a double; null where it is none. NaN counts as null."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(x), x)


def truth(c: Column) -> Column:
    """A boolean without nulls: null is false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def present(c: Column) -> Column:
    """Whether a text says something: not null, blank, or a word for absence."""
    return F.coalesce(~F.lower(F.trim(c)).isin(*ABSENT), F.lit(False))


def fold(c: Column) -> Column:
    """Lower case without accents, runs of other characters as one space."""
    plain = F.lower(F.translate(F.replace(F.replace(c, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae")), ACCENTS, PLAIN))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def slug(c: Column) -> Column:
    return F.replace(fold(c), F.lit(" "), F.lit("_"))


def normalise_text(c: Column) -> Column:
    """Without soft hyphens and NULs, with words that a line break parted joined, and with single spaces and newlines."""
    x = F.regexp_replace(c, "[­\u0000]", "")
    x = F.regexp_replace(x, r"([A-Za-z])-\n([a-z])", "$1$2")
    x = F.regexp_replace(x, r"[ \t]+", " ")
    x = F.regexp_replace(x, r" ?\n ?", "\n")
    return F.trim(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def key_text(c: Column) -> Column:
    """A key with all white space taken out; null where nothing is left."""
    x = F.regexp_replace(c, r"\s+", "")
    return F.when(x != "", x)


def code_text(c: Column, width: int = 4) -> Column:
    """Digits of a code, padded on the left with zeros; null where it holds none."""
    x = F.regexp_replace(F.regexp_replace(c.cast("string"), r"\.0+$", ""), "[^0-9]", "")
    return F.when(x != "", F.lpad(x, width, "0"))


def pair(c: Column) -> Column:
    """'2 to 5', '2-5', '2 / 5' or '3' as struct(low, high); null where it is none."""
    low = F.regexp_extract(c, r"^\s*(\d+(?:[.,]\d+)?)", 1)
    high = F.regexp_extract(c, r"^\s*\d+(?:[.,]\d+)?\s*(?:-|/|to|à)\s*(\d+(?:[.,]\d+)?)\s*$", 1)
    number_of = lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(low != "", F.struct(number_of(low).alias("low"), F.coalesce(number_of(high), number_of(low)).alias("high")))


def published(c: Column) -> Column:
    """A published figure as struct(value, state): '**' is suppressed, '--' has no units, blanks are absent."""
    x = F.trim(c)
    state = F.when(x == "**", "suppressed").when(x == "--", "no_units").when(F.coalesce(x == "", F.lit(True)), "absent").otherwise("measured")
    return F.struct(F.when(state == "measured", F.regexp_replace(x, "[ ,$%]", "").try_cast("double")).alias("value"), state.alias("state"))


def address(c: Column) -> Column:
    """'unit-civic suffix street, municipality, postal code' as a struct; empty parts are null."""
    pattern = r"^\s*(?:(\d+|[A-Za-z])\s*-\s*)?(\d+)\s*([A-Za-z]\b)?\s+([^,]+?)\s*(?:,\s*([^,]+?)\s*)?(?:,\s*([A-Za-z]\d[A-Za-z]\s?\d[A-Za-z]\d)\s*)?$"
    part = lambda k: F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))
    return F.struct(part(1).alias("unit"), part(2).cast("int").alias("civic"), part(3).alias("suffix"), part(4).alias("street"), part(5).alias("municipality"), F.upper(F.replace(part(6), F.lit(" "), F.lit(""))).alias("postal_code"))


def digest_text(c: Column, digits: int = 12) -> Column:
    """A value as text that the same content always gives; doubles at so many significant digits."""
    return F.format_string(f"%.{digits - 1}e", c.cast("double"))
