"""Text: chunks, fields, links and tables."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_TOKENS, OVERLAP_TOKENS = 512, 64


def words(text: str) -> int:
    return len(text.split())


def chunk(text: str | None, most: int = CHUNK_TOKENS, overlap: int = OVERLAP_TOKENS, measure=words) -> list[str]:
    """Paragraphs packed greedily into chunks of at most `most` tokens.

    A chunk starts with the last whole paragraphs of the one before, as many as fit `overlap` tokens; the oldest of them go
    until the next paragraph fits too. A paragraph that is too long by itself is cut at words, where as many are taken as
    measure, which counts the tokens of a text, allows.
    """
    units: list[str] = []
    for paragraph in (p.strip() for p in (text or "").split("\n\n")):
        if not paragraph:
            continue
        if measure(paragraph) <= most:
            units.append(paragraph)
            continue
        rest, at = paragraph.split(), 0
        while at < len(rest):
            n = 1
            if measure is words:
                n = most
            else:  # the most words that fit, by doubling and then halving
                fits = lambda k, at=at: measure(" ".join(rest[at : at + k])) <= most
                while at + n < len(rest) and fits(2 * n):
                    n *= 2
                step = n
                while step := step // 2:
                    n += step if fits(n + step) else 0
            units.append(" ".join(rest[at : at + n]))
            at += n
    chunks, now, size = [], [], 0
    for u in units:
        n = measure(u)
        if now and size + n > most:
            chunks.append("\n\n".join(x for x, _ in now))
            first, held = len(now), 0
            while first and held + now[first - 1][1] <= overlap:
                first, held = first - 1, held + now[first - 1][1]
            while first < len(now) and held + n > most:
                first, held = first + 1, held - now[first][1]
            now, size = now[first:], held
        now.append((u, n))
        size += n
    return [*chunks, "\n\n".join(x for x, _ in now)] if now else chunks


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = CHUNK_TOKENS, overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """(doc_id, chunk_index, chunk_id, num_tokens, text): chunks of whole texts; none for a null or blank one."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: chunk(t, most, overlap))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(cut(F.col(text_col))).alias("chunk_index", "text"))
    return rows.select("doc_id", "chunk_index", F.format_string("%s:%04d", F.col("doc_id").cast("string"), "chunk_index").alias("chunk_id"), F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")).alias("num_tokens"), "text")


def chunk_spans(docs: DataFrame, chunks: DataFrame, most_words: int = 6) -> DataFrame:
    """(doc_id, chunk_index, start, end): where each chunk of chunks (doc_id, chunk_index, text) stands in the whole text of docs (doc_id, text).

    The first and the last words of a chunk are looked for from where the chunk before began, as chunks overlap; white
    space may differ. start and end are null where they are not found.
    """

    def locate(text: str, piece: str, at: int) -> tuple[int | None, int | None]:
        own = piece.split()
        look = lambda ws, start: re.compile(r"\s+".join(map(re.escape, ws))).search(text, start) if ws else None
        head = look(own[:most_words], at)
        tail = look(own[-most_words:], max(head.start(), head.start() + len("".join(own)) - len("".join(own[-most_words:]))) if head else at)
        return (head.start(), tail.end()) if head and tail else (None, None)

    @F.pandas_udf("array<struct<chunk_index:int,start:int,end:int>>")
    def spans(texts: pd.Series, pieces: pd.Series) -> pd.Series:
        out = []
        for text, rows in zip(texts, pieces, strict=True):
            at, found = 0, []
            for r in rows:
                start, end = locate(text or "", r["text"] or "", at)
                at = start if start is not None else at
                found.append({"chunk_index": r["chunk_index"], "start": start, "end": end})
            out.append(found)
        return pd.Series(out)

    lists = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))).alias("pieces"))
    return docs.select("doc_id", "text").join(lists, "doc_id").select("doc_id", F.explode(spans("text", "pieces")).alias("s")).select("doc_id", "s.*")


def chunks_over(spans: DataFrame, marks: DataFrame) -> DataFrame:
    """(mark, doc_id, chunk_index): the chunks that a stretch of text, marks (mark, doc_id, mark_start, mark_end), shares characters with."""
    pairs = spans.join(marks, "doc_id").where((F.col("start") < F.col("mark_end")) & (F.col("end") > F.col("mark_start")))
    return pairs.select("mark", "doc_id", "chunk_index")


#: Fixed patterns of fields in running text.
FIELDS = {
    "emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phones": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "long_numbers": r"\b[0-9]{13,19}\b",
    "versions": r"[Vv]ersion [0-9]+(?:\.[0-9]+)?",
}


def fields(text: Column) -> list[Column]:
    """All matches of each of FIELDS, each once and in the order of the text."""
    return [F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(name) for name, p in FIELDS.items()]


def links(html: Column) -> Column:
    """Targets of the links of a page, each once and in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"<a href=\"([^\"#]+)\""), F.lit(1)))


def canonical_url(url: Column, drop_query: bool = False, one_scheme: bool = False, drop_www: bool = False) -> Column:
    """Scheme and host in lower case, no fragment, no slash at the end.

    On demand without the query, with https for http, and without a leading www.
    """
    bare = F.regexp_replace(url, r"[?#].*$" if drop_query else r"#.*$", "")
    if one_scheme:
        bare = F.regexp_replace(bare, r"(?i)^http://", "https://")
    if drop_www:
        bare = F.regexp_replace(bare, r"(?i)^([a-z][a-z0-9+.-]*://)www\.", "$1")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)?", 1))
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    return F.regexp_replace(F.concat(head, rest), r"/+$", "")


class Tables(HTMLParser):
    """Cells of the tables of a page: tables[t][row] is a list of texts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def close_cell(self) -> None:
        if self.cell is not None and self.tables and self.tables[-1]:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
        self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.close_cell()
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.close_cell()
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.close_cell()
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_cells(html: str | None) -> list[tuple[int, int, int, str]]:
    parser = Tables()
    parser.feed(html or "")
    parser.close_cell()
    return [(t, r, c, x) for t, rows in enumerate(parser.tables) for r, row in enumerate(rows) for c, x in enumerate(row)]


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, table, row, col, text): every cell of every table of each page."""

    @F.pandas_udf("array<struct<table:int,row:int,col:int,text:string>>")
    def cells(html: pd.Series) -> pd.Series:
        return html.map(lambda h: [{"table": t, "row": r, "col": c, "text": x} for t, r, c, x in table_cells(h)])

    return pages.select(F.col(id_col).alias("page_id"), F.explode(cells(F.col(html_col))).alias("_c")).select("page_id", "_c.*")


def pipe_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, col, text): cells of tables that plain text prints with ' | ' between them; other lines are passed over."""
    rows = docs.select(F.col(id_col), F.posexplode(F.filter(F.split(text_col, "\\r?\\n"), lambda x: F.contains(x, F.lit(" | ")))).alias("row", "_l"))
    cells = rows.select(id_col, "row", F.posexplode(F.split("_l", r"\|")).alias("col", "text"))
    return cells.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))


def link_kind(url: Column, kinds: list[tuple[str, str]]) -> Column:
    """The first kind whose pattern a link meets; null where it meets none. kinds: (kind, pattern over the whole address)."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(kinds):
        out = F.when(url.rlike(pattern), kind).otherwise(out)
    return out


def first_mentions(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mention, place): each different match of a pattern in a text, and which match (from 0) it first is."""
    found = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))).alias("place", "mention"))
    return found.groupBy("doc_id", "mention").agg(F.min("place").alias("place"))
