"""Scalar functions on hand-made cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.functions import scalars as S


def over(spark, f, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r[0] for r in df.select(f(F.col("c")).alias("x")).collect()]


def test_valid(spark):
    assert over(spark, S.valid, "\\N", "no:match", "", None, "ĜLOBI:x", "a") == [False, False, False, False, False, True]


def test_encode_iri(spark):
    from urllib.parse import quote

    values = ["a b/é*~-_.", "x'y(z)!", "100%+", "日本", ""]
    assert over(spark, S.encode_iri, *values) == [quote(v, safe="") for v in values]


def test_normalise_term(spark):
    twice = lambda c: S.normalise_term(S.normalise_term(c))
    assert over(spark, S.normalise_term, "Leaves ", "Automatas", "s") == ["leave", "automatas", ""]
    assert over(spark, twice, "glass") == ["gla"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("https://www.gbif.org/species/5", "GBIF:5"), ("tsn:9", "ITIS:9"), ("gbif: +7", "GBIF:7"), ("gbif:8", "GBIF:8"), ("xtsn:9", "xtsn:9"),
        ("https://www.wikidata.org/wiki/Q5", "Wikidata:Q5"), ("urn:lsid:marinespecies.org:taxname:1", "WORMS:1"), ("http://www.wikidata.org/entity/Q1", "http://www.wikidata.org/entity/Q1"),
        ("https://www.itis.gov/servlet/SingleRpt/SingleRpt?search_topic=TSN&search_value=3", "ITIS:3"), ("http://www.boldsystems.org/index.php/Public_BarcodeCluster?clusteruri=BOLD:AAA", "BOLD:AAA"),
    ],
)
def test_normalise_id(spark, raw, want):
    assert over(spark, S.normalise_id, raw) == [want]


def test_ranks(spark):
    df = spark.createDataFrame([("kingdom | phylum", "Plantae | Tracheophyta"), ("a|kingdom|kingdom", "x|y|z"), ("kingdom|phylum", "P"), ("kingdom", "P|extra"), (None, "x")], "r string, n string")
    rows = [r[0] for r in df.select(S.ranks_of(F.col("n"), F.col("r"))).collect()]
    assert rows[0].asDict() == {"kingdom": "Plantae", "phylum": "Tracheophyta"} | dict.fromkeys(V.RANKS[2:], "")
    assert rows[1].kingdom == "z" and rows[2].kingdom == "P" and rows[2].phylum == "" and rows[3].kingdom == "P" and rows[4] is None


def test_numeric_literal(spark):
    assert over(spark, S.is_numeric_literal, "1.5E+3", "1.5e3", "-2", ".5", "1\n", "1d") == [True, False, True, False, False, False]
    assert over(spark, S.to_number, "1d", " 2 ", "1e3", ".5", "x", None, "-inf") == [None, 2.0, 1000.0, 0.5, None, None, float("-inf")]


def test_curies(spark):
    assert over(spark, S.expand_curie, "UBERON:0000955", "FBdv:1", "fbdv:1", "http://x/1", "PO:2:3", "x") == [V.OBO + "UBERON_0000955", V.OBO + "FBdv_1", None, "http://x/1", V.OBO + "PO_2:3", None]


def test_tokens(spark):
    assert over(spark, S.tokenise, "2 males and Females; (x)", "male,", "?") == [["2 males ", " females", " x "], ["male", ""], [" "]]
    words = over(spark, S.counted_words, "female12", "12", "3 workers", "male")
    assert [[tuple(w) for w in ws] for ws in words] == [[(2, "female1")], [(1, "2")], [(3, "workers")], [(1, "male")]]


def test_labels(spark):
    assert over(spark, S.clean_label, '<http://x> "a  b"^^<http://y>', None) == ["a b", None]
    assert over(spark, S.without_datatype, '"1.5"^^<http://www.w3.org/2001/XMLSchema#double>') == ["1.5"]
    assert over(spark, lambda c: S.holds_any(c, V.FUNGAL_GENERA), "the PUCCINIA x", "oak", None) == [True, False, False]


def test_three_bins(spark):
    df = spark.createDataFrame([(-1.0,), (-1.01,), (1.0,), (1.1,), (None,)], "c double")
    assert [r[0] for r in df.select(S.three_bins(F.col("c"), F.lit(1.0))).collect()] == ["Conservative", "Conservative", "Intermediate", "Acquisitive", None]


def test_inverse_table_is_consistent():
    assert len(V.INVERSE) == 24
    sosa = {k: v for k, v in V.INVERSE.items() if k.startswith(V.SOSA)}
    assert all(sosa[v] == k for k, v in sosa.items())
    assert not any(v in V.INVERSE for k, v in V.INVERSE.items() if k.startswith(V.DCTERMS))
