"""Free-text terms: tokens, lookups in entity maps, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.functions import scalars as S
from taxograph.operators.tables import last_wins


def entity_map(maps: DataFrame, compat: bool = False) -> DataFrame:
    """(key, name, iri) of a term mapping (input, match, uri, row_id), last row wins per column.

    Rows without a URI still give the name, whose IRI is made from it. Keys are normalised like the
    terms that look them up; compat leaves them as written.
    """
    key = F.col("input") if compat else S.normalise_term(F.col("input"))
    rows = maps.withColumn("key", key)
    names = last_wins(rows.filter("match is not null"), "key", ["match"])
    iris = last_wins(rows.filter("uri is not null and uri <> ''"), "key", ["uri"])
    own = F.concat(F.lit(V.EMI_BOX), S.encode_iri(F.col("match")))
    return names.join(iris, "key", "left").select("key", F.col("match").alias("name"), F.coalesce("uri", own).alias("iri"), F.col("uri").isNotNull().alias("has_uri"))


def lookup_terms(df: DataFrame, term: str, entities: DataFrame) -> DataFrame:
    """df with entity_iri and entity_name: the term as it is, else without affixes; null if neither is known."""
    raw = df.withColumn("__t", S.normalise_term(F.col(term)))
    raw = raw.withColumn("__c", S.normalise_term(S.without_affixes(F.col("__t"))))
    known = lambda k: entities.select(F.col("key").alias(k), F.struct("name", "iri").alias(f"{k}_e"))
    out = raw.join(known("__t"), "__t", "left").join(known("__c"), "__c", "left")
    won = F.coalesce("__t_e", "__c_e")
    return out.withColumn("entity_iri", won["iri"]).withColumn("entity_name", won["name"]).drop("__t", "__c", "__t_e", "__c_e")


def exploded_terms(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys..., term, count): a row per counted word of each sub-term of a free text."""
    tokens = df.filter(S.valid(F.col(text))).select(*keys, F.explode(S.tokenise(F.col(text))).alias("__token"))
    words = tokens.select(*keys, F.explode(S.counted_words(F.col("__token"))).alias("__w"))
    return words.select(*keys, S.normalise_term(F.col("__w.word")).alias("term"), F.col("__w.count").alias("count"))


#: A map of so many terms is sent to all tasks, so that what is counted stays where it is.
FEW_TERMS = 10_000


def count_terms(df: DataFrame, text: str, keys: list[str], terms: DataFrame, unknown: str = V.UNKNOWN_SEX) -> DataFrame:
    """(keys..., iri, n): summed counts of each mapped term; terms without a mapping count as `unknown`.

    terms: (key, value). The IRI of a key called unknown replaces the default. Zero sums are left out.
    """
    words = exploded_terms(df, text, keys).withColumn("__c", S.normalise_term(S.without_affixes(F.col("term"))))
    table = terms.select(S.normalise_term(F.col("key")).alias("key"), "value").groupBy("key").agg(F.max("value").alias("value"))
    table = F.broadcast(table) if terms.limit(FEW_TERMS + 1).count() <= FEW_TERMS else table
    named = table.filter("key = 'unknown'").agg(F.max("value").alias("unknown"))
    table_of = lambda key, value: table.select(F.col("key").alias(key), F.col("value").alias(value))
    out = words.join(table_of("term", "__a"), "term", "left")
    out = out.join(table_of("__c", "__b"), "__c", "left")
    out = out.join(F.broadcast(named))  # one row
    iri = F.coalesce("__a", "__b", "unknown", F.lit(unknown))
    return out.groupBy(*keys, iri.alias("iri")).agg(F.sum("count").alias("n")).filter("n <> 0")
