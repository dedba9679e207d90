"""Records to triples and back by graph queries."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators import graph, lineage, resolve, sparql, terms, triples
from taxograph.sources import readers, sinks

SEXES = [("male", V.OBO + "PATO_0000384"), ("female", V.OBO + "PATO_0000383"), ("unknown", V.OBO + "PATO_x")]


@pytest.fixture(scope="module")
def sexes(spark):
    return spark.createDataFrame(SEXES, "key string, value string")


def record(spark, **values):
    names = ["row_id", "source_wd", "source_name", "target_wd", "target_name", *readers.RECORD_COLUMNS]
    return spark.createDataFrame([tuple(values.get(n, 0 if n == "row_id" else None) for n in names)], ", ".join(f"{n} {'bigint' if n == 'row_id' else 'string'}" for n in names))


@pytest.fixture(scope="module")
def one_interaction(spark, sexes):
    r = record(
        spark, source_wd="Q1", source_name="Apis mellifera", target_wd="Q2", target_name="Trifolium repens", interactionTypeName="pollinates", interactionTypeId=V.OBO + "RO_0002455",
        localityName="Bern", sourceBodyPartName="brain", sourceBodyPartId="UBERON:0000955", sourceSexName="1 female",
    )
    return triples.interaction_triples(r, sexes).cache()


def test_interaction_record(one_interaction):
    rows = {(r.s, r.p, r.o, r.o_kind, r.o_dtype) for r in one_interaction.collect()}
    assert len(rows) == one_interaction.count() == 24
    rec, sample = V.EMI_BOX + "inRec0", V.EMI_BOX + "SAMPLE-Q1-inRec0"
    assert (rec, V.EMI + "isClassifiedWith", V.OBO + "RO_0002455", "iri", None) in rows
    assert (V.OBO + "UBERON_0000955", V.RDFS + "label", "brain", "literal", V.XSD + "string") in rows
    assert (V.EMI_BOX + "ORGANISM-Apis%20mellifera", V.SOSA + "hasSample", sample, "iri", None) in rows
    node = next(r[2] for r in rows if r[1] == V.EMI + "hasSex")
    assert (node, V.QUDT_INTERACTIONS + "numericValue", "1", "literal", V.XSD + "integer") in rows


def test_interaction_queries(one_interaction):
    assert graph.record_count(one_interaction).first()[0] == 1
    assert graph.distinct_taxa(one_interaction).first()[0] == 2
    assert triples.counters(one_interaction).first().asDict() == {"records": 1, "triples": 24}


def test_self_interaction_and_unresolved_are_out(spark):
    df = record(spark, source_wd="Q1", target_wd="Q1").union(record(spark, source_wd="Q1")).union(record(spark, source_wd="Q1", target_wd="Q2"))
    assert resolve.kept_records(df).count() == 1


TRAIT = {
    "row_id": 0, "AccSpeciesName": "Acer rubrum", "AccSpeciesID": "42", "ObservationID": "7", "ObsDataID": "99", "Dataset": "D 1", "DatasetID": "5", "Reference": "Ref A", "TraitName": "SLA",
    "TraitID": "3115", "DataName": "SLA dry", "DataID": "6582", "OrigValueStr": "12.5", "OrigUnitStr": "m2/g", "UnitName": None,
}


def trait_graph(spark, samples=None, **changes):
    row = TRAIT | changes
    records = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} {'bigint' if n == 'row_id' else 'string'}" for n in row))
    species = spark.createDataFrame([("Acer rubrum", "Q9")], "TRY_AccSpeciesName string, WdID string")
    qudt = spark.createDataFrame([("m2/g", "M2-PER-GM")], "key string, value string")
    emi = spark.createDataFrame([("d/y", V.EMI_UNIT + "DAYS-PER-YEAR")], "key string, value string")
    return triples.trait_triples(records, species, qudt, emi, samples)


def test_trait_record(spark):
    rows = {(r.s, r.p, r.o, r.o_dtype) for r in trait_graph(spark).collect()}
    assert len(rows) == 21
    result = V.EMI_BOX + "RESULT-99"
    assert (result, V.RDF + "value", "12.5", V.XSD + "double") in rows
    assert (V.EMI + "Trait", V.DCTERMS + "identifier", "TRYdb-3115", V.XSD + "string") in rows
    assert (result, V.QUDT_TRAITS + "hasUnit", V.QUDT_UNIT + "M2-PER-GM", None) in rows
    assert (V.EMI_BOX + "DATASET-D%201", V.DCTERMS + "hasPart", V.EMI_BOX + "SAMPLE-Acer%20rubrum-7", None) in rows
    counts = graph.type_counts(trait_graph(spark)).first()
    assert tuple(counts) == (1, 1, 0)


def test_trait_variants(spark):
    no_set = {r.p for r in trait_graph(spark, Dataset=None).collect()}
    assert V.SOSA + "hasResult" not in no_set and V.RDF + "value" not in no_set
    other = {(r.p, r.o) for r in trait_graph(spark, TraitName=None, OrigUnitStr="d/y").collect()}
    assert (V.RDF + "type", V.EMI + "NonTrait") in other and (V.QUDT_TRAITS + "hasUnit", V.EMI_UNIT + "DAYS-PER-YEAR") in other
    named = {r.p for r in trait_graph(spark, OrigUnitStr="d/y", UnitName="zz").collect()}
    assert V.QUDT_TRAITS + "hasUnit" not in named
    assert trait_graph(spark, samples=spark.createDataFrame([("Q1",)], "wd_taxon_id string")).count() == 0
    assert triples.trait_rejects(spark.createDataFrame([(None, "1"), ("a", "1")], "AccSpeciesName string, ObservationID string")).count() == 1


def test_inverse_is_single_pass_and_for_iris(spark):
    t = spark.createDataFrame([("s", V.SOSA + "isSampleOf", "o", "iri", None, "x", 0), ("s", V.SOSA + "isSampleOf", "text", "literal", None, "x", 0)], "s string, p string, o string, o_kind string, o_dtype string, src string, row_id bigint")
    assert [(r.s, r.p, r.o) for r in triples.inverse(t).collect()] == [("o", V.SOSA + "hasSample", "s")]
    whole = triples.with_inverse(t)
    assert triples.with_inverse(whole).count() == whole.count() == 3


def test_sex_counts(spark, sexes):
    df = spark.createDataFrame([(1, "2 males, female"), (2, "male,"), (3, "adult males"), (4, None), (5, "3 bees")], "k int, t string")
    got = {(r.k, r.iri): r.n for r in terms.count_terms(df, "t", ["k"], sexes).collect()}
    male, female, unknown = (v for _, v in SEXES)
    assert got == {(1, male): 2, (1, female): 1, (2, male): 1, (2, unknown): 1, (3, male): 1, (5, unknown): 3}


def test_term_entities(spark):
    maps = spark.createDataFrame([("Leaves", "leaf", "http://l", 0), ("root", "root", None, 1), ("leave", "leaf2", "http://l2", 2)], "input string, match string, uri string, row_id bigint")
    df = spark.createDataFrame([("s1", "leaf and leaves, roots", 0)], "s string, t string, row_id bigint")
    got = triples.term_entities(df, "t", "s", "link", "kind", terms.entity_map(maps))
    assert {(r.p, r.o) for r in got.filter("s = 's1'").collect()} == {("link", "http://l2"), ("link", V.EMI_BOX + "root")}


def test_patterns(spark):
    rows = [("a", "p", "b"), ("b", "p", "c"), ("c", "p", "a"), ("a", "q", "x"), ("b", "q", "x"), ("b", "q", "y"), ("d", "r", "d")]
    t = spark.createDataFrame([(*r, "iri", None) for r in rows], "s string, p string, o string, o_kind string, o_dtype string")
    assert graph.bgp(t, [("?x", "p", "?y"), ("?y", "q", "?z")]).count() == 3
    assert graph.bgp(t, [("?x", "r", "?x")]).collect()[0].x == "d"
    left = graph.bgp(t, [("?x", "p", "?y")])
    assert {tuple(r) for r in graph.optional(left, graph.bgp(t, [("?y", "q", "?z")])).select("x", "z").collect()} == {("a", "x"), ("a", "y"), ("b", None), ("c", "x")}
    path = graph.bgp(t, [("a", "p*", "?y")])
    assert {r.y for r in path.collect()} == {"a", "b", "c"}
    assert {r.y for r in graph.bgp(t, [("d", "p*", "?y")]).collect()} == {"d"}
    q = 'PREFIX : <> SELECT DISTINCT ?x ?z WHERE { ?x <p> ?y . OPTIONAL { ?x <q> ?z . BIND(?z AS ?w) } FILTER(?x != "c") } ORDER BY ?x DESC(?z) LIMIT 2'
    assert [tuple(r) for r in sparql.sparql(t, q).collect()] == [("a", "x"), ("b", "y")]
    assert sparql.sparql(t, "SELECT (COUNT(*) AS ?n) WHERE { ?x <p>* ?y . ?y <q> ?z }").first().n == 9
    with pytest.raises(ValueError):
        sparql.sparql(t, "SELECT ?x WHERE { ?x nope:p ?y }")


def test_closure_of_a_diamond_and_a_chain(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")] + [(f"n{k}", f"n{k + 1}") for k in range(20)]
    got = lineage.ancestor_closure(spark.createDataFrame(edges, "child string, parent string"))
    assert got.filter("node = 'a'").count() == 4 and got.filter("node = 'n0'").count() == 21


def test_turtle(spark, one_interaction, tmp_path):
    sinks.write_turtle(one_interaction, str(tmp_path / "ttl"))
    text = "".join(gzip.open(p, "rt").read() for p in sorted(Path(tmp_path / "ttl").rglob("part-*.gz")))
    assert text.count("@prefix") == len(V.PREFIXES) and ":inRec0 a emi:Interaction" in text
    assert '"1"^^xsd:integer' in text and ":SAMPLE-Q1-inRec0" in text
    tricky = spark.createDataFrame([("http://x/a b", "http://p", 'q"\n\\', "literal", V.XSD + "string")], "s string, p string, o string, o_kind string, o_dtype string")
    assert '"q\\"\\n\\\\"' in sinks.turtle_lines(tricky).first()[0]
    prefixes = {r.prefix: r.namespace for r in readers.turtle_prefixes(spark, str(tmp_path / "ttl" / "0-prefixes")).collect()}
    assert prefixes == V.PREFIXES


def test_triples_by_predicate(spark, one_interaction, tmp_path):
    path = str(tmp_path / "triples")
    sinks.write_triples(one_interaction, path)
    back = sinks.read_triples(spark, path)
    assert back.count() == 24 and graph.record_count(back).first()[0] == 1
    plan = back.filter(F.col("p") == V.RDFS + "label")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_records_are_dealt_before_they_are_multiplied(spark, monkeypatch):
    monkeypatch.setattr(triples, "RECORDS_PER_TASK", 10)
    few = spark.range(95).withColumnRenamed("id", "row_id").coalesce(1)
    assert triples.dealt(few, few).rdd.getNumPartitions() == 10 and triples.dealt(few, few).count() == 95
    assert triples.dealt(few.limit(3), few.limit(3)).rdd.getNumPartitions() == 4


def several(spark, **values):
    """Records of which two share a number."""
    of = lambda **x: record(spark, **({"source_wd": "Q1", "source_name": "Apis", "target_wd": "Q2", "target_name": "Rosa", "sourceSexName": "2 males, x"} | x | values))
    return of(row_id=1, interactionTypeName="eats").union(of(row_id=1, interactionTypeName="visits")).union(of(row_id=2, interactionTypeName="eats")).union(of(row_id=3, target_wd="Q3"))


def test_records_triples_are_not_shuffled(spark, sexes):
    """Triples that hold a record's number are made distinct where the record was dealt to."""
    g = triples.interaction_graph(several(spark), sexes)
    assert len(g.own) == 2
    for own in g.own:
        plan = own.distinct()._jdf.queryExecution().executedPlan().toString()
        dealt_by = [x.split("\n")[0] for x in plan.split("Exchange hashpartitioning(")[1:]]
        assert [x.split("#")[0] for x in dealt_by if "REPARTITION" in x] == ["row_id"]
        assert all(x.startswith("key#") for x in dealt_by if "REPARTITION" not in x)  # the map of sexes
    everything = triples.as_set(g.own[0].unionByName(g.own[1]).unionByName(g.shared).drop(*triples.NEWS), "interactions")
    got = g.as_set()
    assert sorted(map(str, got.collect())) == sorted(map(str, everything.collect()))
    assert got.count() == got.select("s", "p", "o", "o_kind", "o_dtype").distinct().count()


def test_data_that_name_a_sample_keep_the_set(spark, sexes):
    """A type whose IRI and label are those of a sample: its label is stated twice, in all one triple."""
    sample = f"{V.EMI_BOX}SAMPLE-Q1-inRec2"
    g = triples.interaction_graph(several(spark, interactionTypeId=sample, interactionTypeName="Apis"), sexes)
    got = g.as_set().select("s", "p", "o", "o_kind", "o_dtype")
    assert g.own == [] and got.count() == got.distinct().count()
    assert got.filter((F.col("s") == sample) & (F.col("p") == V.RDFS + "label")).count() == 1


def test_lines_of_records_are_not_shuffled(spark, sexes):
    """Ends are spelled once a record; equal lines of a record are made one where it was dealt to."""
    r = several(spark, sourceBodyPartId="http://x/a b", localityName='a "b"')
    lines = sinks.spelled_lines(triples.interaction_graph(r, sexes, spelled=sinks.spelled))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(row_id" in plan and plan.count("Exchange hashpartitioning(value") == 1
    assert sorted(x.value for x in lines.collect()) == sorted(x.value for x in sinks.turtle_lines(triples.interaction_triples(r, sexes)).collect())
