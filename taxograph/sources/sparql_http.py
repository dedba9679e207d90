"""A batch source for SPARQL endpoints: SELECT results as string columns.

    spark.dataSource.register(SparqlSource)
    spark.read.format("sparql").option("endpoint", url).option("query", text).load()

The variables after SELECT are the columns; an unbound one is null. Results come as CSV or JSON and are
streamed block by block, row by row; an answer shorter than it should be is an error. `parts` pages the
query with LIMIT and OFFSET into as many tasks of `page_rows` rows, `pages` names the pages to fetch; the
query should then have an ORDER BY. With `marks`, rows carry their page and number and each page ends with
a row that says how it ended, in place of a failed task: `landing.land` builds on it.
"""

from __future__ import annotations

import codecs
import csv
import http.client
import json
import re
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TIMEOUT = 1000
BLOCK = 1 << 16


def variables(query: str) -> list[str]:
    """The names a SELECT projects."""
    head = re.search(r"(?is)\bselect\b(.*?)(?:\bwhere\b|\{)", query)
    return re.findall(r"[?$](\w+)", head[1]) if head else []


def text_blocks(answer) -> Iterator[str]:
    """The text of an answer in blocks; raises EOFError if it ends before the length it announced."""
    decoder, size, announced = codecs.getincrementaldecoder("utf-8")(), 0, answer.headers.get("Content-Length")
    while block := answer.read(BLOCK):
        size += len(block)
        yield decoder.decode(block)
    if announced is not None and size < int(announced):
        raise EOFError(f"{size} of {announced} bytes came")
    yield decoder.decode(b"", final=True)


def lines_of(blocks: Iterable[str]) -> Iterator[str]:
    """Lines with their ends, whatever the blocks; only a line feed ends one, the csv module does the rest."""
    rest = ""
    for block in blocks:
        *whole, rest = (rest + block).split("\n")
        yield from (line + "\n" for line in whole)
    if rest:
        yield rest


def bindings_rows(blocks: Iterable[str], names: list[str]) -> Iterator[tuple]:
    """The rows of a JSON result, one binding at a time; a missing variable is null. Raises EOFError if the list does not end."""
    source, decode, text, at = iter(blocks), json.JSONDecoder().raw_decode, "", 0
    while (start := re.search(r'"bindings"\s*:\s*\[', text)) is None:
        if (block := next(source, None)) is None:
            raise EOFError("no bindings came")
        text += block
    at = start.end()
    while True:
        at = re.compile(r"[\s,]*").match(text, at).end()
        if text[at : at + 1] == "]":
            for _ in source:  # to the announced length
                pass
            return
        try:
            row, at = decode(text, at)
        except json.JSONDecodeError:
            if (block := next(source, None)) is None:
                raise EOFError("the bindings broke off") from None
            text, at = text[at:] + block, 0
            continue
        yield tuple(row.get(n, {}).get("value") for n in names)


def csv_rows(lines: Iterable[str], names: list[str]) -> Iterator[tuple]:
    """The rows of a CSV result in the order of names; empty is null."""
    for row in csv.DictReader(lines):
        yield tuple(row.get(n) or None for n in names)


#: Columns of an answer with marks: the page, the row's number in it, and how the page ended.
MARKS = [T.StructField("fetch_page", T.IntegerType()), T.StructField("fetch_seq", T.LongType()), T.StructField("fetch_mark", T.StringType())]


def marked(options: dict) -> bool:
    return options.get("marks", "false").lower() == "true"


class Page(InputPartition):
    def __init__(self, number: int | None):
        self.number = number


class SparqlReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.options, self.names = dict(options), names

    def partitions(self) -> list[Page]:
        parts, pages = int(self.options.get("parts", 1)), self.options.get("pages")
        if pages is None and parts == 1:
            return [Page(None)]
        return [Page(k) for k in (range(parts) if pages is None else map(int, pages.split(",")))]

    def rows(self, page: int | None, names: list[str]) -> Iterator[tuple]:
        query = self.options["query"]
        if page is not None:
            size = int(self.options["page_rows"])
            query += f"\nLIMIT {size} OFFSET {page * size}"
        url = self.options["endpoint"] + "?" + urllib.parse.urlencode({"query": query})
        kind = self.options.get("accept", "text/csv")
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": kind}), timeout=TIMEOUT) as answer:
            blocks = text_blocks(answer)
            yield from bindings_rows(blocks, names) if "json" in kind else csv_rows(lines_of(blocks), names)

    def read(self, partition: Page) -> Iterator[tuple]:
        if not marked(self.options):
            yield from self.rows(partition.number, self.names)
            return
        names, seq = self.names[len(MARKS) :], 0
        try:
            for row in self.rows(partition.number, names):
                yield (partition.number, seq, None, *row)
                seq += 1
            mark = "ended"
        except (OSError, EOFError, ValueError, csv.Error, http.client.HTTPException) as e:
            mark = f"{type(e).__name__}: {e}"
        yield (partition.number, seq, mark, *[None] * len(names))


class SparqlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sparql"

    def schema(self) -> T.StructType:
        marks = MARKS if marked(self.options) else []
        return T.StructType([*marks, *[T.StructField(n, T.StringType()) for n in variables(self.options["query"])]])

    def reader(self, schema: T.StructType) -> SparqlReader:
        return SparqlReader(self.options, schema.fieldNames())


def mapping_query() -> str:
    """Taxa with a name and their optional external identifiers."""
    from taxograph import vocab as V

    optional = "\n".join(f"  OPTIONAL {{ ?WdID wdt:{p} ?{c} . }}" for c, p in zip(V.ID_COLUMNS, V.ID_PROPERTIES, strict=True))
    return f"PREFIX wdt: <http://www.wikidata.org/prop/direct/>\nPREFIX wd: <{V.WD}>\nSELECT ?WdID {' '.join('?' + c for c in V.ID_COLUMNS)} ?WdName WHERE {{\n  ?WdID wdt:P31 wd:Q16521 ; wdt:P225 ?WdName .\n{optional}\n}}"


def lineage_query() -> str:
    """Taxa with every ancestor's name and rank."""
    from taxograph import vocab as V

    return f"PREFIX wdt: <http://www.wikidata.org/prop/direct/>\nPREFIX wd: <{V.WD}>\nSELECT ?WdID ?WdName ?hTax ?hTaxName ?hTaxRank WHERE {{\n  ?WdID wdt:P31 wd:Q16521 ; wdt:P225 ?WdName ; wdt:P171* ?hTax .\n  ?hTax wdt:P225 ?hTaxName ; wdt:P105 ?hTaxRank .\n}}"
