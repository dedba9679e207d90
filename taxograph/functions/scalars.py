"""Scalar functions as Column expressions; everything stays inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxograph import vocab as V

#: Strings that a scan treats as null.
NA_STRINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def na(c: Column) -> Column:
    """Null for the textual null values."""
    return F.when(~c.isin(*NA_STRINGS, "\\N"), c)


def valid(c: Column) -> Column:
    """True where a value says something: no null, no empty or placeholder text."""
    return c.isNotNull() & ~c.isin("", "\\N", "no:match") & ~c.startswith("ĜLOBI:")


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode white space included."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def encode_iri(c: Column) -> Column:
    """Percent-encoded; only A-Z a-z 0-9 _ . - ~ stay."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def normalise_term(c: Column) -> Column:
    """Lower case, stripped, one plural s off unless the term holds mono or auto."""
    t = strip(F.lower(c))
    return F.when(t.contains("mono") | t.contains("auto"), t).otherwise(F.regexp_replace(t, r"s\z", ""))


def normalise_id(c: Column) -> Column:
    """Prefixed form of an identifier given as URL or URN."""
    for pattern, to in V.ID_RULES:
        c = F.regexp_replace(c, pattern, to)
    return c


def short_entity(c: Column, to: str = "Wikidata:") -> Column:
    """Entity IRIs with the prefix, quotes taken out."""
    return F.replace(F.replace(c, F.lit(V.WD), F.lit(to)), F.lit('"'), F.lit(""))


def ranks_of(names: Column, ranks: Column) -> Column:
    """A struct of the seven ranks from two pipe-separated paths.

    Pairs are matched by place, a missing partner counts as empty, the last of equal ranks wins and
    ranks that are not there are empty; null if a path is null.
    """
    cut = lambda c: F.transform(F.split(c, r"\|", -1), strip)
    pairs = F.arrays_zip(cut(ranks).alias("rank"), cut(names).alias("name"))

    def of(rank):
        own = F.filter(pairs, lambda p: F.coalesce(p["rank"], F.lit("")) == rank)
        return F.coalesce(F.try_element_at(own, F.lit(-1))["name"], F.lit("")).alias(rank)

    return F.when(names.isNotNull() & ranks.isNotNull(), F.struct(*map(of, V.RANKS)))


NUMERIC = r"\A-?[0-9]+(\.[0-9]+)?(E[+-][0-9]+)?\z"


def is_numeric_literal(c: Column) -> Column:
    """Whether a value gets the type double: digits, a fraction, an exponent with E and a sign."""
    return c.rlike(NUMERIC)


def to_number(c: Column) -> Column:
    """A double, or null for what is no plain decimal number."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z|(?i)\A[+-]?(inf|infinity)\z"), text.try_cast("double"))


def lookup(table: dict[str, str], key: Column) -> Column:
    """The value of a small fixed map, null where it has no such key."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(pairs, key)


def expand_curie(c: Column) -> Column:
    """The IRI of a compact identifier with a known prefix, or of an http IRI; else null."""
    base = lookup(V.CURIES, F.substring_index(c, ":", 1))
    known = c.contains(":") & base.isNotNull()
    return F.when(known, F.concat(base, F.regexp_replace(c, r"\A[^:]*:", ""))).when(c.startswith("http"), c)


def unit_iri(unit: Column, name: Column, qudt_unit: Column, qudt_name: Column, emi_unit: Column, emi_name: Column) -> Column:
    """The unit of a value: by its unit text, else by a valid unit name in both maps, else by the text in the second map.

    qudt_*: local names the first map gives for text and name; emi_*: IRIs of the second map.
    """
    first = F.concat(F.lit(V.QUDT_UNIT), qudt_unit)
    by_name = F.coalesce(F.concat(F.lit(V.QUDT_UNIT), qudt_name), emi_name)
    return F.when(valid(unit), F.when(qudt_unit.isNotNull(), first).when(valid(name), by_name).otherwise(emi_unit))


def tokenise(c: Column) -> Column:
    """The sub-terms of a free text: conjunctions and delimiters cut, brackets and marks blanked. Empty tokens stay."""
    t = strip(F.lower(c))
    t = F.regexp_replace(t, r"(?U)\b(and|y)\b", ",")
    t = F.regexp_replace(t, r"(?U)\bor\b", "")
    t = F.regexp_replace(t, r"[,;/|&]+", ",")
    t = F.regexp_replace(t, r"[\[\]()?#:`]+", " ")
    t = F.regexp_replace(t, r"(?U)\s\s", " ")
    return F.split(t, r"[+.,]+", -1)


COUNTED = r"(?U)(\d+)\s*([\w-]+)|([\w-]+)\s*(\d+)"


def counted_words(token: Column) -> Column:
    """array<struct<count,word>> of a sub-term: numbers beside words, or the whole token once."""
    found = F.regexp_extract_all(token, F.lit(COUNTED), F.lit(0))

    def part(m):
        number = F.coalesce(F.nullif(F.regexp_extract(m, COUNTED, 1), F.lit("")), F.regexp_extract(m, COUNTED, 4))
        word = F.coalesce(F.nullif(F.regexp_extract(m, COUNTED, 2), F.lit("")), F.regexp_extract(m, COUNTED, 3))
        return F.struct(number.cast("bigint").alias("count"), word.alias("word"))

    return F.when(F.size(found) > 0, F.transform(found, part)).otherwise(F.array(F.struct(F.lit(1).cast("bigint").alias("count"), token.alias("word"))))


AFFIXES = r"(?i)adult[as]?|tortere|juvenil[e]?|maybe|\(?torete[s]?\)?"


def without_affixes(c: Column) -> Column:
    return F.regexp_replace(c, AFFIXES, "")


def split_terms(c: Column) -> Column:
    """Terms between slashes and commas, stripped."""
    return F.transform(F.split(F.replace(c, F.lit("/"), F.lit(",")), ",", -1), strip)


def clean_label(c: Column) -> Column:
    """A query result's label: no <...>, ^^ or quotes, white space collapsed."""
    out = F.regexp_replace(c.cast("string"), r"<[^>]*>", "")
    out = F.regexp_replace(out, r"\^\^|[\"']", "")
    return strip(F.regexp_replace(out, r"(?U)\s+", " "))


def without_datatype(c: Column) -> Column:
    """A typed literal's value."""
    return F.regexp_replace(F.substring_index(c, "^^<http://", 1), r'\A"+|"+\z', "")


def holds_any(c: Column, names: tuple[str, ...]) -> Column:
    """Whether a text holds one of the names in any case; null holds none."""
    return F.coalesce(c.rlike("(?i)" + "|".join(rf"\Q{n}\E" for n in names)), F.lit(False))


def three_bins(c: Column, sd: Column, labels: tuple[str, str, str] = ("Conservative", "Intermediate", "Acquisitive")) -> Column:
    """Bins cut at -sd and sd, closed on the right."""
    return F.when(c <= -sd, labels[0]).when(c <= sd, labels[1]).when(c.isNotNull(), labels[2])


def display_name(c: Column, most: int = 30) -> Column:
    """The last part of a path, underscores as spaces, cut to a length."""
    return F.substring(F.replace(F.substring_index(c, "/", -1), F.lit("_"), F.lit(" ")), 1, most)


def link_curies(c: Column, prefixes: dict[str, str] | None = None) -> Column:
    """Markup in which every prefix:name of a known prefix is a link."""
    for p, base in (prefixes or V.PREFIXES).items():
        if p:
            c = F.regexp_replace(c, rf"(?<![\w:/#]){re.escape(p)}:([A-Za-z_][\w-]*)", f'<a href="{base}$1">{p}:$1</a>')
    return c


def clean_column_name(name: str) -> str:
    """A header's name without byte order mark, question mark and surrounding white space."""
    return name.replace("\ufeff", "").replace("?", "").strip()
