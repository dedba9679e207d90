"""The store of numbers, stars, compatible solutions and reachability against plain code."""

from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from taxograph.operators import graph, lineage, sparql, stars, store, triples
from taxograph.sources import readers

SCHEMA = "s string, p string, o string, o_kind string, o_dtype string"
XSD = "http://www.w3.org/2001/XMLSchema#"


def facts(rng, n=120):
    rows = []
    for _ in range(n):
        kind = rng.choice(["iri", "iri", "literal", "bnode"])
        o = {"iri": f"n{rng.randrange(12)}", "literal": rng.choice(["1", "2", "n3", "x y"]), "bnode": f"_:b{rng.randrange(3)}"}[kind]
        rows.append((f"n{rng.randrange(12)}", rng.choice("pqr"), o, kind, rng.choice([None, XSD + "string", XSD + "integer"]) if kind == "literal" else None))
    return rows


def plain_pattern(rows, one):
    """Solutions of one pattern over a set of triples; terms are (kind, value, dtype)."""
    out = []
    for s, p, o, kind, dtype in set(rows):
        ends, solution = (("bnode" if s.startswith("_:") else "iri", s, None), ("iri", p, None), (kind, o, dtype)), {}
        for end, term in zip(ends, one, strict=True):
            if term.startswith("?"):
                if solution.setdefault(term[1:], end) != end:
                    break
            elif end[1] != term:
                break
        else:
            out.append(solution)
    return out


def plain_join(a, b):
    return [x | y for x, y in product(a, b) if all(x[k] == y[k] for k in x.keys() & y.keys())]


@pytest.mark.parametrize("bits", [64, 4])
def test_store_solves_patterns(spark, tmp_path, bits):
    """With 4 bits many terms share a hash."""
    rng = random.Random(3)
    rows = facts(rng)
    held = store.write_store(spark.createDataFrame(rows + rows[:20], SCHEMA), str(tmp_path / "store"), bits)
    terms = {("bnode" if s.startswith("_:") else "iri", s, None) for s, *_ in rows} | {("iri", p, None) for _, p, *_ in rows} | {(k, o, d) for *_, o, k, d in rows}
    got = held.terms.collect()
    assert {(r.kind, r.value, r.dtype) for r in got} == terms and len({r.id for r in got}) == len(got) == len(terms)
    assert (held._read("others").count() > 0) == (bits < 64)
    assert {r["name"]: r["triples"] for r in held.predicates.collect()} == {p: sum(x[1] == p for x in set(rows)) for p in "pqr"}
    name = {r.id: (r.kind, r.value, r.dtype) for r in got}
    for patterns in ([("?x", "p", "?y")], [("?x", "p", "?y"), ("?y", "q", "?z")], [("?x", "q", "?x")], [("?x", "p", "1")], [("?x", "p", "n3"), ("?x", "?w", "?y")], [("n1", "?a", "?b")], [("?x", "p", "no such")], [("?x", "none", "?y")], [("?x", "r", "?y"), ("?x", "p", "?z"), ("?z", "q", "?w")]):
        expected = plain_pattern(rows, patterns[0])
        for one in patterns[1:]:
            expected = plain_join(expected, plain_pattern(rows, one))
        found = graph.bgp(held, patterns).collect()
        assert sorted(str(sorted((c, name[r[c]]) for c in r.asDict())) for r in found) == sorted(str(sorted(e.items())) for e in expected), patterns


def test_patterns_are_joined_by_their_counts(spark, tmp_path):
    rows = [(f"s{k}", "many", f"o{k % 7}", "iri", None) for k in range(300)] + [("s1", "few", "o1", "iri", None)]
    held = store.write_store(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "store"))
    counts = held.counts(["many", "few"])
    assert counts["many"][0] == 300 and counts["few"][0] == 1
    assert held.cost(("?x", "few", "?y"), counts) < held.cost(("?x", "many", "o1"), counts) < held.cost(("?x", "many", "?y"), counts)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sources(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    yield df
    yield store.write_store(df, str(tmp_path / "store"))
    yield stars.write_stars(df, str(tmp_path / "stars"))


def iris(rows):
    return [(*r, "iri", None) for r in rows]


OPTIONALS = [
    ("SELECT ?s ?v WHERE { ?s <t> ?x OPTIONAL { ?s <q> ?v } OPTIONAL { ?s <r> ?v } }", [("a", "1"), ("b", "2"), ("c", None), ("d", "3")]),
    ('SELECT ?s ?v WHERE { ?s <t> ?o OPTIONAL { ?s <q> ?v . FILTER(?o = "1") } }', [("a", "1"), ("b", None), ("c", None), ("d", None)]),
    ('SELECT ?s ?v WHERE { ?s <t> ?o OPTIONAL { ?s <q> ?v FILTER(?o != ?v) } }', [("a", None), ("b", None), ("c", None), ("d", "3")]),
    ("SELECT ?s ?v ?w WHERE { ?s <t> ?o OPTIONAL { ?s <q> ?v } OPTIONAL { ?k <of> ?v ; <is> ?w } }", [("a", "1", "k1"), ("b", "1", "k1"), ("b", "3", "k3"), ("c", "1", "k1"), ("c", "3", "k3"), ("d", "3", "k3")]),
    ("SELECT ?s ?v WHERE { { ?s <q> ?v } UNION { ?s <r> ?w } ?s <r> ?v }", [("b", "2"), ("d", "4")]),
    ("SELECT ?s ?v WHERE { ?s <t> ?o OPTIONAL { ?s <q> ?v } ?s <r> ?v }", [("b", "2")]),
    ("SELECT ?v WHERE { OPTIONAL { ?s <none> ?v } }", [(None,)]),
    ("SELECT ?s ?v WHERE { ?s <t> ?o OPTIONAL { ?s <q> ?v FILTER(?o > 1) FILTER(?v < ?o) } }", [("a", None), ("b", None), ("c", None), ("d", "3")]),
    ("SELECT ?s ?y WHERE { ?s <t> ?o BIND(?o AS ?y) FILTER(?y > 1) }", [("b", "2"), ("c", "9"), ("d", "4")]),
]
OPTIONAL_ROWS = iris([("a", "t", "1"), ("b", "t", "2"), ("c", "t", "9"), ("d", "t", "4"), ("a", "q", "1"), ("d", "q", "3"), ("b", "r", "2"), ("d", "r", "4"), ("k", "of", "1"), ("k", "is", "k1"), ("m", "of", "3"), ("m", "is", "k3")])


@pytest.mark.parametrize("query,expected", OPTIONALS)
def test_optional_takes_compatible_solutions(spark, tmp_path, query, expected):
    for source in sources(spark, OPTIONAL_ROWS, tmp_path):
        assert rows_of(sparql.sparql(source, query)) == sorted(expected, key=repr), type(source)


def test_compatible_without_a_sure_variable(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (3, "z")], "k int, v string")
    right = spark.createDataFrame([("a", 10), (None, 20), ("b", 30)], "v string, n int")
    pairs = [(1, "a", 10), (1, "a", 20), (2, "a", 10), (2, None, 20), (2, "b", 30), (3, "z", 20), (3, "z", 20)]
    assert rows_of(graph.compatible(left, right, {"v"})) == sorted(pairs, key=repr)
    above = lambda value: value("n") > 15
    kept = [x for x in pairs if x[2] > 15]
    assert rows_of(graph.compatible(left, right, {"v"}, "left", above)) == sorted(kept, key=repr)
    none = lambda value: value("n") > 25
    assert rows_of(graph.compatible(left, right, {"v"}, "left", none)) == sorted([(1, "a", None), (2, "b", 30), (3, "z", None), (3, "z", None)], key=repr)


def test_stars_and_subjects_too_large_for_a_record(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"s{k % 9}", rng.choice("pqrt"), f"v{rng.randrange(4)}", "iri", None) for k in range(90)] + [("hub", p, f"v{k}", "iri", None) for k in range(30) for p in "pq"]
    df = spark.createDataFrame(rows, SCHEMA).distinct()
    held = stars.write_stars(df, str(tmp_path / "stars"), most=40)
    assert held.large is not None and held.spark.read.parquet(f"{held.path}/stars").filter("s = 'hub'").count() == 0
    for query in ("SELECT ?s ?a ?b ?c WHERE { ?s <p> ?a . OPTIONAL { ?s <q> ?b } OPTIONAL { ?s <r> ?c } }", "SELECT ?s ?b WHERE { ?s <p> <v1> . OPTIONAL { ?s <t> ?b } ?s <q> ?d . ?x <r> ?d }", "SELECT ?s ?a WHERE { ?s <p> ?a ; <q> ?a }"):
        assert rows_of(sparql.sparql(held, query)) == rows_of(sparql.sparql(df, query))
    plan = sparql.sparql(stars.write_stars(df.filter("s <> 'hub'"), str(tmp_path / "small")), "SELECT ?s ?a ?b WHERE { ?s <p> ?a . OPTIONAL { ?s <q> ?b } }")._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_reachable_follows_new_pairs_from_its_starts(spark):
    chain, cycle, report = [(f"n{k}", f"n{k + 1}") for k in range(30)], [("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("c1", "d"), ("c0", "c0")], []
    edges = spark.createDataFrame(chain + cycle, "child string, parent string")
    starts = lambda *x: spark.createDataFrame([(v,) for v in x], "node string")
    got = {tuple(r) for r in lineage.reachable(edges, starts("n27", "c1", None, "alone", "n27"), report).collect()}
    assert got == {("n27", "n27"), ("n27", "n28"), ("n27", "n29"), ("n27", "n30"), ("alone", "alone"), *(("c1", x) for x in ("c0", "c1", "c2", "d"))}
    assert report == [3, 3, 2, 1, 0]
    whole = {tuple(r) for r in lineage.reachable(edges, edges.select(F.col("child").alias("node"))).collect()}
    closed = lineage.ancestor_closure(edges).filter(F.col("node") != "d").filter(F.col("node") != "n30")
    assert whole == {tuple(r) for r in closed.collect()}
    assert lineage.reachable(edges, starts("n1").limit(0)).count() == 0


def test_paths_start_from_what_is_bound(spark, tmp_path):
    rows = iris([(f"n{k}", "up", f"n{k + 1}") for k in range(12)] + [("n9", "is", "x"), ("n4", "up", "n0")])
    for source in sources(spark, rows, tmp_path):
        assert rows_of(sparql.sparql(source, "SELECT ?a ?b WHERE { ?a <up>* ?b . ?a <is> <x> }")) == [("n9", f"n{k}") for k in (10, 11, 12)] + [("n9", "n9")]
        assert len(rows_of(sparql.sparql(source, "SELECT ?b WHERE { <n4> <up>* ?b }"))) == 13


def test_store_reads_small_splits(spark, tmp_path, monkeypatch):
    """What tasks hold while they make terms distinct follows from small splits; the setting is put back."""
    key, seen = "spark.sql.files.maxPartitionBytes", []
    before, make = spark.conf.get(key), store._encoded
    monkeypatch.setattr(store, "_encoded", lambda s, *rest: seen.append(s.conf.get(key)) or make(s, *rest))
    rows = [(f"s{k}", f"p{k % 3}", f"o{k % 5}", "iri", None) for k in range(30)]
    held = store.write_store(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "s"))
    assert seen == ["16m"] and spark.conf.get(key) == before
    assert {(r.name, r.triples) for r in held.predicates.collect()} == {(f"p{k}", 10) for k in range(3)}


def test_no_single_task_reads_the_dictionary(spark, tmp_path, monkeypatch):
    """Small tables of the store are gathered by a shuffle; a coalesce would run the join with the dictionary in one task."""
    monkeypatch.setattr(type(spark.range(0)), "coalesce", lambda *_: pytest.fail("coalesced"))
    rows = [(f"s{k}", f"p{k % 3}", str(k), "literal", XSD + "string") for k in range(30)]
    assert store.write_store(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "s")).predicates.count() == 3


def test_closure_of_a_tree_gives_each_pair_once(spark, monkeypatch):
    """Rounds of a chain make no pair twice: what is joined in all is what is new."""
    made, join = [], type(spark.range(0)).join

    def counted(self, *args):
        out = join(self, *args)
        made.append(out.count())
        return out

    monkeypatch.setattr(type(spark.range(0)), "join", counted)
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(16)], "child string, parent string")
    assert lineage.ancestor_closure(edges).count() == 17 * 18 // 2
    # pairs of 2..16 steps, each once, and those of exactly 2, 4, 8 and 16
    assert sum(made) == sum(17 - n for n in range(2, 17)) + sum(17 - n for n in (2, 4, 8, 16))


def test_store_of_a_graph_in_parts(spark, tmp_path):
    """Terms that records introduce alone are written as they come, yet each is once in the dictionary; no text stays but there."""
    columns = ["source_wd", "source_name", "target_wd", "target_name", *readers.RECORD_COLUMNS]
    record = lambda k, **x: (k, *(({"source_wd": "Q1", "source_name": "A", "target_wd": "Q2", "target_name": "B", "interactionTypeName": "eats", "sourceSexName": "male"} | x).get(c) for c in columns))
    # two records of one number, one with itself, one whose type is the name of a record
    rows = [record(1), record(1, interactionTypeName="visits"), record(2, target_wd="Q1"), record(3, interactionTypeName="inRec1"), record(4)]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} string" for c in columns))
    made = triples.interaction_graph(df, spark.createDataFrame([("male", "obo:male")], "key string, value string"))
    assert len(made.own) == 2
    held, plain = store.write_store(made, str(tmp_path / "a")), store.write_store(made.as_set(), str(tmp_path / "b"))
    name = [{r.id: (r.kind, r.value, r.dtype) for r in x.terms.collect()} for x in (held, plain)]
    assert held.terms.count() == len(name[0]) and sorted(map(str, name[0].values())) == sorted(map(str, name[1].values()))
    assert held._read("repeated").count() > 0
    texts = [sorted(str([n[c] for c in r]) for r in x.triples.collect()) for x, n in zip((held, plain), name, strict=True)]
    assert texts[0] == texts[1] and len(set(texts[0])) == len(texts[0])
    assert not (tmp_path / "a" / "statements").exists() and not (tmp_path / "b" / "statements").exists()


def test_names_of_groups_do_not_shuffle_the_dictionary(spark, tmp_path):
    held = store.write_store(spark.createDataFrame(iris([(f"s{k}", "is", f"o{k % 3}") for k in range(30)]), SCHEMA), str(tmp_path / "s"))
    found = sparql.sparql(held, "SELECT ?t (COUNT(?r) AS ?n) WHERE { ?r <is> ?t } GROUP BY ?t ORDER BY ?t")
    assert [tuple(r) for r in found.collect()] == [(f"o{k}", 10) for k in range(3)]
    assert "LeftSemi, BuildRight" in found._jdf.queryExecution().toString()
