"""Lineages, resolution, terms and tables on hand-made cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators import lineage, resolve, tables

LINEAGE = ", ".join(f"{c} string" for c in ("WdID", "WdName", *V.RANKS)) + ", row_id long"


def lineages(spark, *rows):
    """rows: (id, name, dict of ranks)."""
    made = [(V.WD + i, n, *[r.get(k) for k in V.RANKS], k) for k, (i, n, r) in enumerate(rows)]
    return spark.createDataFrame(made, LINEAGE)


def mapping(spark, *rows):
    made = [(V.WD + i, *[ids.get(c) for c in V.ID_COLUMNS], n, k) for k, (i, ids, n) in enumerate(rows)]
    return spark.createDataFrame(made, ", ".join(f"{c} string" for c in ("WdID", *V.ID_COLUMNS, "WdName")) + ", row_id long")


def records(spark, *taxa):
    """One record per taxon (id, name, path names, path ranks), with an empty other side."""
    made = [(*t, None, None, None, None) for t in taxa]
    return spark.createDataFrame(made, ", ".join(f"{s}Taxon{p} string" for s in ("source", "target") for p in ("Id", "Name", "PathNames", "PathRankNames")))


def test_align_is_one_row_per_taxon(spark):
    k, p, c = list(V.RANK_ENTITIES)[:3]
    rows = [("i", "n", "x", "Late", k, 5), ("i", "n", "x", "Early", k, 1), ("i", "n", "x", None, p, 0), ("i", "n", "x", "P", p, 9), ("j", None, "x", "P", p, 9), ("i", "n", "x", "Z", "other", 0)]
    long = spark.createDataFrame(rows, "WdID string, WdName string, hTax string, hTaxName string, hTaxRank string, row_id long")
    got = lineage.align(lineage.rank_filter(long)).collect()
    assert len(got) == 1 and got[0].kingdom == "Early" and got[0].phylum == "P" and got[0]["class"] is None
    assert lineage.rank_filter(long.withColumn("hTaxRank", F.lit(c))).count() == 6


def test_id_map_last_wins_and_drops_nulls(spark):
    m = mapping(spark, ("Q1", {"gbif": "5", "eol": "7"}, "First"), ("Q2", {"gbif": "5"}, 'Sec"ond'))
    got = {r.key: (r.name, r.wd) for r in resolve.id_map(m).collect()}
    assert got == {"Wikidata:Q1": ("First", "Wikidata:Q1"), "Wikidata:Q2": ("Second", "Wikidata:Q2"), "EOL:7": ("First", "Wikidata:Q1"), "GBIF:5": ("Second", "Wikidata:Q2")}
    compat = {r.key: r.wd for r in resolve.id_map(m, compat=True).collect()}
    assert compat["Wikidata:Q1"] is None and compat["EOL:7"] == "Wikidata:Q1"


@pytest.fixture(scope="module")
def cascade(spark):
    aligned = lineages(
        spark,
        ("Q10", "Shared", {"order": "O1", "phylum": "P1", "kingdom": "K1"}), ("Q11", "Shared", {"order": "O2", "phylum": "P2", "kingdom": "K2"}),
        ("Q20", "Alone", {"family": "F"}), ("Q30", "Twin", {"family": "A"}), ("Q31", "Twin", {"family": "A"}),
    )
    rows = records(
        spark,
        ("https://www.gbif.org/species/5", "first", None, None), ("GBIF:5", "Other", None, None), ("Wikidata:Q1", "First", None, None), ("X:1", "Shared", "k1|p2|o2", "kingdom|phylum|order"),
        (None, "Alone", None, None), (" ", "Nowhere", None, None), ("X:2", "Twin", "A", "family"), ("X:3", None, None, None), ("X:4", "Shared", None, None),
    )
    out = resolve.match_taxa(rows, mapping(spark, ("Q1", {"gbif": "5"}, "First")), aligned, lineage.ambiguous_names(aligned))
    return {(r.TaxonId, r.TaxonName): r for r in out.collect()}


def test_cascade(cascade):
    got = {k: (r.Mapped_ID_WD, r.Match_Status) for k, r in cascade.items()}
    assert got["GBIF:5", "first"] == ("Wikidata:Q1", "NAME-MATCH-YES")
    assert got["GBIF:5", "Other"] == ("Wikidata:Q1", "NAME-MATCH-NO")
    assert got["Wikidata:Q1", "First"] == ("Wikidata:Q1", "NAME-MATCH-YES")
    assert got["X:1", "Shared"] == ("Wikidata:Q11", "ID-MATCHED-BY-NAME-DUPL-duplicate")
    assert cascade["X:1", "Shared"].order == "O2" and cascade["X:1", "Shared"].kingdom == "K2"
    assert got[None, "Alone"] == ("Wikidata:Q20", "ID-MATCHED-BY-NAME-direct") and cascade[None, "Alone"].family == "F"
    assert got[" ", "Nowhere"] == (None, "ID-NOT-PRESENT")
    assert got["X:2", "Twin"] == ("Wikidata:Q30", "ID-MATCHED-BY-NAME-DUPL-duplicate")
    assert got["X:3", None] == (None, "ID-NOT-FOUND")
    assert got["X:4", "Shared"][0] == "Wikidata:Q10"


def test_resolution_uses_id_then_name(spark, cascade):
    known = spark.createDataFrame([("GBIF:5", "A", "Wikidata:Q1", "Mapped A", 0), ("X", "B", "Wikidata:Q2", "Mapped B", 1), ("Y", "C", "", "none", 2)], "TaxonId string, TaxonName string, Mapped_ID_WD string, Mapped_Value string, row_id long")
    df = spark.createDataFrame([("gbif:5", "whatever", "zz", "B"), ("gbif:5", None, "Y", "C")], "sourceTaxonId string, sourceTaxonName string, targetTaxonId string, targetTaxonName string")
    got = {(r.source_wd, r.source_name, r.target_wd, r.target_name) for r in resolve.resolve_sides(df, *resolve.resolution_maps(known)).collect()}
    assert got == {("Q1", "whatever", "Q2", "B"), ("Q1", "Mapped A", None, "C")}


def test_species(spark):
    aligned = lineages(spark, ("Q1", "a", {"kingdom": "Plantae"}), ("Q2", "a", {}), ("Q3", "b", {"kingdom": ""}), ("Q4", "c", {"kingdom": "Fungi"}))
    names = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",), (None,)], "TRY_AccSpeciesName string")
    got = {r.TRY_AccSpeciesName: (r.WdID, r.Match_Status, r.kingdom) for r in resolve.match_species(names, aligned).collect()}
    direct = "ID-MATCHED-BY-NAME-direct"
    assert got == {"a": ("Q1", direct, "Plantae"), "b": ("Q3", direct, "None"), "c": (None, direct, "None"), "d": (None, "NAME-NOT-MATCHED", None), None: (None, "NAME-NOT-MATCHED", None)}


def test_tables(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 5), ("", 3, 1), (None, 4, 2)], "k string, v int, row_id long")
    assert [tuple(r) for r in tables.last_wins(df, "k", ["v"]).collect()] == [("a", 2)]
    assert {tuple(r) for r in tables.first_seen(df, "k", ["v"]).collect()} == {("a", 1), ("", 3)}
    assert tables.duplicate_groups(df, "k").count() == 2
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    both = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", None), (None, None)], "x string, y string")
    assert tables.in_either(both, ["x", "y"], keys, "k").count() == 2
    assert tables.with_columns_in_order(df, ["z", "v"]).columns == ["z", "v"]


def test_rows_of_one_name_and_ranks_meet_its_lineages_once(spark, monkeypatch):
    ranks = lambda k: [f"f{k % 2}", None, "o", "p", "k"]
    cols = ", ".join(f"`{r}` string" for r in resolve.COMPARED)
    repeats = spark.createDataFrame([(f"Q{k}", "x", *ranks(k)[:4], f"k{k}", k) for k in range(20)], f"WdID string, WdName string, {cols}, row_id long")
    rows = spark.createDataFrame([(k, "x", *ranks(k)) for k in range(500)], f"k long, name string, {cols}")
    made, join = [], type(spark.range(0)).join

    def counted(self, *args):
        out = join(self, *args)
        made.append(out.count())
        return out

    monkeypatch.setattr(type(spark.range(0)), "join", counted)
    got = {r.k: r.wd for r in resolve.best_lineage(rows, repeats, "name", "k").collect()}
    assert got == {k: f"Q{k % 2}" for k in range(500)} and made == [2 * 20, 500]


def joins_of(df):
    """The joins of the plan that ran, the last one first."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Join" in line]


def test_rows_of_small_files_are_not_broadcast(spark, tmp_path):
    ranks = [F.lit(None).cast("string").alias(r) for r in resolve.COMPARED]
    name = F.concat(F.lit("n"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).otherwise(F.col("id")))
    spark.range(100_000).select(F.col("id").cast("string").alias("WdID"), name.alias("WdName"), *ranks, F.col("id").alias("row_id")).coalesce(1).write.parquet(f"{tmp_path}/lineages")
    aligned = spark.read.parquet(f"{tmp_path}/lineages")
    repeats = lineage.ambiguous_names(aligned)
    assert all("BuildLeft" not in j for j in joins_of(repeats))
    assert repeats.columns == aligned.columns and repeats.count() == 50_000
    best = resolve.best_lineage(aligned, repeats, "WdName", "row_id")
    assert "BuildLeft" not in joins_of(best)[0]
    assert {(r.row_id, r.wd) for r in best.collect()} == {(k, str(k % 50)) for k in range(0, 100_000, 2)}
