"""Readers, sinks, the SPARQL source, streaming and the command line on small files."""

from __future__ import annotations

import gzip
import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators import semantic, triples
from taxograph.plans import pipelines, source_queries
from taxograph.sources import diagrams, landing, readers, sinks, sparql_http
from taxograph.streaming import incremental


def put(path, text, encoding="utf-8"):
    raw = text.encode(encoding)
    path.write_bytes(gzip.compress(raw) if path.suffix == ".gz" else raw)
    return str(path)


def test_delimited_nulls_order_and_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv.gz", '﻿a?, b ,c\n1,NA,"x, ""y"""\n2,\\N,None\n')
    rows = readers.delimited(spark, path).orderBy("row_id").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", None, 'x, "y"'), ("2", None, None)]
    with pytest.raises(ValueError, match="zz"):
        readers.delimited(spark, path, columns=("a", "zz"))
    latin = put(tmp_path / "l.tsv", 'n\tv\nÉ "q\t1\n', "iso-8859-1")
    assert readers.delimited(spark, latin, "\t", encoding="ISO-8859-1", quoting=False).first().n == 'É "q'


def test_dictionaries(spark, tmp_path):
    path = put(tmp_path / "u.csv", "origUnit,mapUnit\nm,M\nm,M2\n\"a, b\",AB\n")
    assert {(r.key, r.value) for r in readers.dictionary(spark, path, "origUnit", "mapUnit").collect()} == {("m", "M2"), ("a, b", "AB")}
    assert readers.dictionary(spark, str(tmp_path / "none.csv"), "a", "b").count() == 0
    sex = put(tmp_path / "s.tsv", "input\toutput\nMale\tobo:1\n")
    assert readers.sex_map(spark, sex).first().key == "male"
    one, two = put(tmp_path / "1.csv", "Input Term,Best Match,URI\nleaf,Leaf,http://1\n"), put(tmp_path / "2.csv", "InputTerm,BestMatch,URI\nleaf,Leaf2,http://2\n")
    maps = readers.term_maps(spark, one, two)
    assert [r.match for r in maps.orderBy("row_id").collect()] == ["Leaf", "Leaf2"]


def test_sniffing_query_results_and_terms(spark, tmp_path):
    assert readers.sniffed(spark, put(tmp_path / "p.txt", "a|b\n1|2\n")).columns == ["a", "b", "row_id"]
    with pytest.raises(ValueError):
        readers.sniffed(spark, put(tmp_path / "q.txt", "a\n1\n"))
    got = readers.query_result(spark, put(tmp_path / "r.tsv", '?x\t?y\n"a  b"^^<http://s>\t<http://z>\n')).first()
    assert (got.x, got.y) == ("a b", None)
    assert [r.line for r in readers.term_lines(spark, put(tmp_path / "t.txt", "a, b\n\n  \nc/d\n")).collect()] == ["a, b", "c/d"]


def test_ontology_terms(spark, tmp_path):
    text = """<rdf:RDF xmlns:rdf="r" xmlns:rdfs="s" xmlns:owl="o" xmlns:oboInOwl="i"><owl:Class rdf:about="http://x/1"><rdfs:label>leaf</rdfs:label>
    <oboInOwl:hasExactSynonym>foliage leaf</oboInOwl:hasExactSynonym><oboInOwl:hasBroadSynonym>blade</oboInOwl:hasBroadSynonym></owl:Class><owl:Class rdf:about="http://x/2"/></rdf:RDF>"""
    got = {tuple(r) for r in readers.ontology_terms(spark, put(tmp_path / "o.owl", text)).collect()}
    assert got == {("leaf", "http://x/1", "leaf"), ("foliage leaf", "http://x/1", "leaf"), ("blade", "http://x/1", "leaf")}


def test_matching(spark, tmp_path):
    ontology = spark.createDataFrame([("leaf", "u1", "leaf"), ("stem", "u2", "stem"), ("leaf", "u3", "leaf")], "label string, uri string, main_label string")
    lines = spark.createDataFrame([("leaf/ stem",)], "line string")
    got = {r.term: (r.uri, round(r.score, 4)) for r in semantic.match_terms(lines, ontology.coalesce(1)).collect()}
    assert got == {"leaf": ("u1", 1.0), "stem": ("u2", 1.0)}
    sinks.write_matches(semantic.match_terms(lines, ontology), str(tmp_path / "m"))
    back = readers.delimited(spark, str(tmp_path / "m"))
    assert back.columns[:2] == ["Input Term", "Matched Term"] and back.first()["Similarity Score"] == "1.0000"


def test_matching_in_parts(spark, monkeypatch):
    v = spark.createDataFrame([(k, [float(k % 5), 1.0, float(k % 3)]) for k in range(40)], "k long, vector array<double>")
    labels = v.select(F.col("k").alias("best"), F.col("k").alias("label_id"), "vector")
    whole = {tuple(r) for r in semantic.best_matches(v, labels, ["k"], ["best"], decimals=9).collect()}
    for name, n in (("BLOCK_LABELS", 3), ("PIVOTS", 5), ("PACK", 2)):
        monkeypatch.setattr(semantic, name, n)
    assert {tuple(r) for r in semantic.best_matches(v, labels, ["k"], ["best"], decimals=9).collect()} == whole


def test_matching_in_groups_of_blocks(spark, monkeypatch):
    """A task holds one group of blocks, terms are sent once a group, and Arrow batches of wide rows are small."""
    v = spark.createDataFrame([(k, [float(k % 7), 1.0, float(k % 5)]) for k in range(60)], "k long, vector array<double>")
    labels = v.select(F.col("k").alias("best"), F.col("k").alias("label_id"), "vector")
    run = lambda: {tuple(r) for r in semantic.best_matches(v, labels, ["k"], ["best"], exclude_equal=("k", "best"), decimals=9).collect()}
    whole, kept = run(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, n in (("BLOCK_LABELS", 4), ("GROUP_BYTES", 3 * 8 * 10), ("PACK", 3), ("PACK_ROWS", 2), ("VECTOR_ROWS", 7)):
        monkeypatch.setattr(semantic, name, n)
    blocks = semantic.label_blocks(labels, "vector", "label_id")
    groups = blocks.groups()
    assert len(groups) > 2 and sorted(x for g in groups for x in g) == [(b, p) for b, n in enumerate(blocks.parts) for p in range(n)]
    assert run() == whole and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == kept


def test_equal_terms_are_embedded_once(spark, tmp_path):
    counted = tmp_path / "texts"

    def embedder(texts):
        with open(counted, "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        return semantic.HashedTrigrams()(texts)

    ontology = spark.createDataFrame([("leaf", "u1", "leaf"), ("stem", "u2", "stem")], "label string, uri string, main_label string")
    lines = spark.createDataFrame([("leaf/ stem",)] * 200, "line string")
    assert semantic.match_terms(lines, ontology, embedder).groupBy("term", "uri").count().count() == 2
    assert semantic.match_terms(lines, ontology, embedder).count() == 400
    assert len(counted.read_text().split()) == 8


def test_blocks_of_labels_are_skipped(spark):
    """Clustered vectors: the same answers as a full product, most blocks never met."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    make = lambda n: [(k, (centres[k % 30] + rng.normal(scale=0.02, size=16)).tolist()) for k in range(n)]
    labels, terms = make(600) + [(700, [0.0] * 16), (701, None), (702, [])], make(90) + [(91, [0.0] * 16), (92, None)]
    frame = lambda rows, name: spark.createDataFrame([(k, f"n{k % 7}", v) for k, v in rows], f"{name} long, name string, vector array<double>")
    for barred in (None, ("name", "tag")):
        report, lf = {}, frame(labels, "label_id").withColumnRenamed("name", "tag")
        got = {r.k: (r.label_id, r.tag, r.score) for r in semantic.best_matches(frame(terms, "k"), lf, ["k"], ["label_id", "tag"], exclude_equal=barred, decimals=6, report=report).collect()}
        unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-300)
        held = [(k, unit(v)) for k, v in labels if v]
        for k, v in terms:
            if v:
                best = max((round(float(unit(v) @ u), 6), -i) for i, u in held if barred is None or i % 7 != k % 7)
                assert (got[k][0], got[k][1]) == (-best[1], f"n{-best[1] % 7}") and abs(got[k][2] - best[0]) < 2e-6
        assert len(got) == 91 and report["met"] < report["pairs"] / 3, report
    assert semantic.best_matches(frame(terms, "k"), frame(labels, "label_id").withColumnRenamed("name", "tag").limit(0), ["k"], ["tag"]).count() == 0


class Endpoint(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        query = parse_qs(urlparse(self.path).query)["query"][0]
        names = sparql_http.variables(query)
        self.send_response(200)
        self.end_headers()
        if "json" in self.headers["Accept"]:
            body = json.dumps({"results": {"bindings": [{names[0]: {"value": "1"}}]}})
        else:
            offset = query.rpartition("OFFSET ")[2] if "OFFSET" in query else "0"
            body = ",".join(names) + "\r\n" + (offset + "," * (len(names) - 1) + "\r\n" if "ORDER BY" not in query or offset == "0" or "?cut" in query else "")
        self.wfile.write(body.encode())

    def log_message(self, *args):
        pass


def test_sparql_source(spark):
    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(sparql_http.SparqlSource)
    load = lambda **o: spark.read.format("sparql").options(endpoint=f"http://127.0.0.1:{server.server_port}/", query="SELECT ?a ?b WHERE { ?a <p> ?b }", **o).load()
    assert [tuple(r) for r in load().collect()] == [("0", None)]
    assert [tuple(r) for r in load(accept="application/sparql-results+json").collect()] == [("1", None)]
    assert sorted(r.a for r in load(parts="3", page_rows="10").collect()) == ["0", "10", "20"]
    server.shutdown()
    assert len(sparql_http.variables(sparql_http.mapping_query())) == 17 and "wdt:P171*" in sparql_http.lineage_query()


class Breaking(BaseHTTPRequestHandler):
    """Forty rows in pages; some answers break off, some fail."""

    asked: list[int] = []
    broken: dict[int, int] = {}

    def do_GET(self):  # noqa: N802
        query = parse_qs(urlparse(self.path).query)["query"][0]
        size, offset = (int(query.rpartition(w)[2].split()[0]) for w in ("LIMIT ", "OFFSET "))
        page, rows = offset // size, range(40)[offset : offset + size]
        self.asked.append(page)
        left = self.broken[page] = self.broken.get(page, 0) - 1
        if left >= 0 and page == 1:
            self.send_error(500)
            return
        if "json" in self.headers["Accept"]:
            found = [{"a": {"value": str(k)}, "b": {"value": f'"], é{k}'}} if k % 2 else {"a": {"value": str(k)}} for k in rows]
            body = json.dumps({"head": {"vars": ["a", "b"]}, "results": {"bindings": found}}, ensure_ascii=False).encode()
        else:
            body = ("a,b\r\n" + "".join(f'{k},"x ""y"",\r\né{k}"\r\n' if k % 2 else f"{k},\r\n" for k in rows)).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body[: len(body) // 2] if left >= 0 else body)

    def log_message(self, *args):
        pass


@pytest.mark.parametrize("accept", ["text/csv", "application/sparql-results+json"])
def test_landing_fetches_broken_pages_again_alone(spark, tmp_path, accept):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Breaking)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url, query, to = f"http://127.0.0.1:{server.server_port}/", "SELECT ?a ?b WHERE { ?a <p> ?b } ORDER BY ?a", str(tmp_path / "landed")
    land = lambda: landing.land(spark, url, query, to, page_rows=6, wave=4, attempts=2, accept=accept)
    Breaking.asked.clear()
    Breaking.broken = {0: 1, 1: 1, 3: 9}
    with pytest.raises(RuntimeError, match="3.*Error"):
        land()
    asked = Counter(Breaking.asked)
    assert asked[0] == asked[1] == asked[3] == 2 and asked[2] == 1
    Breaking.asked.clear()
    Breaking.broken = {}
    text = (lambda k: f'"], é{k}') if "json" in accept else (lambda k: f'x "y",\r\né{k}')
    assert sorted(map(tuple, land().select("row_id", "a", "b").collect())) == [(k, str(k), text(k) if k % 2 else None) for k in range(40)]
    assert not {0, 1, 2} & set(Breaking.asked) and 3 in Breaking.asked
    Breaking.asked.clear()
    assert land().count() == 40 and not Breaking.asked
    Breaking.broken = {0: 9}
    with pytest.raises(Exception, match="bytes came|broke off"):
        spark.read.format("sparql").options(endpoint=url, query=query, page_rows="6", pages="0", accept=accept).load().collect()
    server.shutdown()
    with pytest.raises(ValueError, match="row_id"):
        landing.landed(spark, "SELECT ?row_id WHERE { ?row_id ?p ?o }", to, 6)


def test_fetch_stage_by_pages(spark, tmp_path):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    for _ in range(2):  # the second call finds its pages landed
        paths = pipelines.fetch(spark, f"http://127.0.0.1:{server.server_port}/", str(tmp_path / "f"), page_rows=2)
        assert [r.WdID for r in readers.mapping_table(spark, paths["mapping"]).collect()] == ["0"]
        assert [r.WdID for r in readers.lineage_long(spark, paths["lineage_long"]).collect()] == ["0"]
        if _ == 0:
            with pytest.raises(RuntimeError, match="short"):
                landing.land(spark, f"http://127.0.0.1:{server.server_port}/", "SELECT ?cut WHERE { ?cut ?p ?o } ORDER BY ?cut", str(tmp_path / "cut"), page_rows=2, wave=3)
            server.shutdown()
            server.server_close()


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_bindings_come_whole_from_any_blocks(size):
    found = [{"a": {"value": '}], "bindings": ['}}, {}, {"b": {"value": "\\u00e9 é"}}]
    text = json.dumps({"head": {"vars": ["bindings", "b"]}, "results": {"distinct": False, "bindings": found}})
    cut = lambda t: [t[k : k + size] for k in range(0, len(t), size)]
    assert list(sparql_http.bindings_rows(cut(text), ["a", "b"])) == [('}], "bindings": [', None), (None, None), (None, "\\u00e9 é")]
    assert list(sparql_http.bindings_rows(cut('{"results": {"bindings": []}}'), ["a"])) == []
    for k in (5, text.index("[{") + 10, len(text) - 4):
        with pytest.raises(EOFError):
            list(sparql_http.bindings_rows(cut(text[:k]), ["a"]))
    assert list(sparql_http.lines_of(cut("a\r\n b\n\nc"))) == ["a\r\n", " b\n", "\n", "c"]


def test_diagrams_keep_all_but_linked_labels(spark, tmp_path):
    known = {"emi": "http://e/"}
    cases = {
        None: None, "": "", "emi:A": "emi:A", "<b></b>": "<b></b>", "<b>http://emi:A</b>": "<b>http://emi:A</b>", "<b>no:A</b>": "<b>no:A</b>", "<b>emi:A</i>": "<b>emi:A</i>",
        "<b> emi : A </b>": '<b><a href="http://e/A">emi : A</a></b>', "<DIV x='1'>emi:A:B</div>t": "<DIV x='1'><a href=\"http://e/A:B\">emi:A:B</a></DIV>t",
        "<b>emi:A</b>,<i> emi:B(c)\n</i>": '<b><a href="http://e/A">emi:A</a></b>,<i><a href="http://e/B">emi:B(c)</a></i>',
        "<span>emi:<u>A</u></span>": '<span><a href="http://e/A">emi:<u>A</u></a></span>', '<b>emi:A</b><a href="x">y</a>': '<b>emi:A</b><a href="x">y</a>', "<b>emi:A$1\\2</b>": '<b><a href="http://e/A$1\\2">emi:A$1\\2</a></b>',
    }
    rows = spark.createDataFrame([(v,) for v in cases], "v string").coalesce(1)
    assert [r[0] for r in rows.select(diagrams.link_wrapped(F.col("v"), known)).collect()] == list(cases.values())
    whole = """<?xml version="1.0"?>\n<mxfile><!-- &lt;b&gt;emi:A --><root><mxCell id="0"/>\n<mxCell style="a value='&lt;b&gt;emi:A&lt;/b&gt;'" value='&lt;b&gt;emi:A&#10;&lt;/b&gt; &quot;é&quot; &amp;amp;'  id="1"><g/></mxCell><mxCellX value="&lt;b&gt;emi:A&lt;/b&gt;"/></root></mxfile>\n"""
    folder = tmp_path / "d"
    folder.mkdir()
    put(folder / "one.drawio.xml", whole)
    put(folder / "two.xml", "")
    got = {r.name: r.document for r in diagrams.link_cells(diagrams.read_documents(spark, str(folder)), known).collect()}
    old, new = "'&lt;b&gt;emi:A&#10;&lt;/b&gt; &quot;é&quot; &amp;amp;'", '"&lt;b&gt;&lt;a href=&quot;http://e/A&quot;&gt;emi:A&lt;/a&gt;&lt;/b&gt; &quot;é&quot; &amp;amp;"'
    assert got["one.drawio"] == whole.replace(old, new) and got.get("two", "") == ""
    held = spark.createDataFrame([(n, whole) for n in ("007", "a=b/c é")], "name string, document string").coalesce(1)
    diagrams.write_documents(held, str(tmp_path / "written"))
    assert sorted(map(tuple, diagrams.read_documents(spark, str(tmp_path / "written")).collect())) == [(n, whole + "\n") for n in ("007", "a=b/c é")]


@pytest.fixture
def files(tmp_path):
    """Sources of a small world: two taxa, one interaction, one trait."""
    ids = lambda **k: ",".join(k.get(c, "") for c in V.ID_COLUMNS)
    mapping = "WdID," + ",".join(V.ID_COLUMNS) + f",WdName\n{V.WD}Q1,{ids(gbif='5')},Apis mellifera\n{V.WD}Q2,{ids(gbif='6')},Trifolium repens\n"
    ranks = list(V.RANK_ENTITIES)
    long = "WdID,WdName,hTax,hTaxName,hTaxRank\n" + "".join(f"{V.WD}{i},{n},x,{k},{ranks[0]}\n" for i, n, k in (("Q1", "Apis mellifera", "Animalia"), ("Q2", "Trifolium repens", "Plantae")))
    head = [*readers.TAXON_COLUMNS, *readers.RECORD_COLUMNS]
    row = {"sourceTaxonId": "GBIF:5", "sourceTaxonName": "Apis mellifera", "targetTaxonId": "X:9", "targetTaxonName": "Trifolium repens", "interactionTypeName": "pollinates", "interactionTypeId": "http://t", "sourceSexName": "2 females", "sourceBodyPartName": "Heads"}
    interactions = "\t".join(head) + "\n" + "\t".join(row.get(c, "\\N") for c in head) + "\n"
    trait = dict(zip(readers.TRAIT_COLUMNS, ["Trifolium repens", "42", "7", "99", "D 1", "5", "Ref", "SLA", "3115", "SLA dry", "6582", "12.5", "m2/g", ""], strict=True))
    traits = "\t".join(trait) + "\n" + "\t".join(trait.values()) + "\n"
    return {
        "mapping": put(tmp_path / "mapping.csv.gz", mapping), "long": put(tmp_path / "long.csv.gz", long), "interactions": put(tmp_path / "i.tsv.gz", interactions),
        "traits": put(tmp_path / "t.tsv.gz", traits, "iso-8859-1"), "species": put(tmp_path / "s.csv", "TRY_SpeciesName,TRY_AccSpeciesName\nx,Trifolium repens\n"),
        "sexes": put(tmp_path / "sex.tsv", "input\toutput\nfemale\thttp://f\n"), "terms": put(tmp_path / "terms.csv", "InputTerm,BestMatch,URI\nhead,head,http://head\n"),
        "qudt": put(tmp_path / "q.csv", "origUnit,mapUnit\nm2/g,M2-PER-GM\n"), "emi": put(tmp_path / "e.csv", "origUnit,mapUnit\nd/y,http://d\n"),
    }


def test_from_files_to_graphs(spark, files, tmp_path):
    at = lambda n: str(tmp_path / "out" / n)
    pipelines.shape(spark, files["long"], at("lineage"), at("repeats"))
    config = tmp_path / "run.ini"
    config.write_text(f"[match-interactions]\nrecords={files['interactions']}\nmapping={files['mapping']}\naligned={at('lineage')}\nrepeats={at('repeats')}\nout=nowhere\n[match-traits]\nspecies={files['species']}\naligned={at('lineage')}\nout={at('species')}\n")
    pipelines.main(["match-interactions", "match-traits", "--config", str(config), "--set", f"match-interactions.out={at('taxa')}"])
    status = {r.TaxonName: r.Match_Status for r in readers.delimited(spark, at("taxa")).collect()}
    assert status == {"Apis mellifera": "NAME-MATCH-YES", "Trifolium repens": "ID-MATCHED-BY-NAME-direct"}
    pipelines.main(["interaction-graph", *sum((["--set", f"interaction-graph.{k}={v}"] for k, v in {"records": files["interactions"], "matched": at("taxa"), "sexes": files["sexes"], "term_files": files["terms"], "out": at("g")}.items()), [])])
    graph = sinks.read_triples(spark, at("g") + "/triples")
    assert graph.filter(F.col("o") == V.EMI + "Interaction").count() == 1
    assert graph.filter((F.col("p") == V.EMI + "hasAnatomicalEntity") & (F.col("o") == "http://head")).count() == 1
    pipelines.trait_graph(spark, files["traits"], at("species"), files["qudt"], files["emi"], at("t"))
    assert sinks.read_triples(spark, at("t") + "/triples").count() == 21
    with pytest.raises(SystemExit):
        pipelines.main(["trait-graph"])


def test_streamed_graph_equals_batch(spark, tmp_path):
    schema = "s string, o string, row_id long"
    land, out = str(tmp_path / "land"), str(tmp_path / "stream")
    build = lambda df: triples.emitted(df, [triples.iri(F.col("s"), "p", F.col("o"))], "x")
    for part in ([("a", "b", 0), ("c", "d", 1)], [("a", "b", 2)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(land)
        incremental.stream_triples(incremental.records_stream(spark, land, schema), build, out, str(tmp_path / "cp")).awaitTermination()
    incremental.compacted(spark, out, str(tmp_path / "set"))
    assert {(r.s, r.o) for r in sinks.read_triples(spark, str(tmp_path / "set")).collect()} == {("a", "b"), ("c", "d")}


def test_delimited_text_comes_back_as_it_was(spark, tmp_path):
    rows = [("  a ", 'b "c", d'), ('"', "tab\there"), ("x", None)]
    df = spark.createDataFrame(rows, "one string, two string")
    for sep in (",", ";"):
        sinks.write_delimited(df, str(tmp_path / "t"), sep)
        back = readers.delimited(spark, str(tmp_path / "t"), sep, row_id=False)
        assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))


def test_quoted_line_ends(spark, tmp_path):
    path = put(tmp_path / "lines.csv", 'k,v\n1,"a\nb"\n2,c\n')
    assert {tuple(r) for r in readers.delimited(spark, path, row_id=False, multiline=True).collect()} == {("1", "a\nb"), ("2", "c")}


def test_dictionary_without_its_column_is_empty(spark, tmp_path):
    path = put(tmp_path / "dict.csv", "a,b\n1,2\n")
    assert readers.dictionary(spark, path, "a", "c").count() == 0


def test_row_numbers_have_no_gaps_however_files_are_cut(spark, tmp_path):
    (tmp_path / "files").mkdir()
    for name, n in (("b.csv", 400), ("a.csv", 3), ("c.csv", 0), ("d.csv", 900)):
        put(tmp_path / "files" / name, "k,v\n" + "".join(f"{name}{k},{'x' * (k % 50)}\n" for k in range(n)))
    expected = [f"{name}{k}" for name, n in (("a.csv", 3), ("b.csv", 400), ("d.csv", 900)) for k in range(n)]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("1000", "5000", before):
            spark.conf.set(key, size)
            got = readers.delimited(spark, str(tmp_path / "files")).collect()
            assert sorted((r.row_id, r.k) for r in got) == list(enumerate(expected))
    finally:
        spark.conf.set(key, before)


def test_streamed_firsts_outlive_restarts(spark, tmp_path):
    schema = "s string, o string, name string, row_id long"
    land, landed, out, checkpoint = (str(tmp_path / n) for n in ("land", "batches", "first", "cp"))
    build = lambda df: triples.as_set(triples.emitted(df, [triples.iri(F.col("s"), "p", F.col("o"))], "x").unionByName(triples.typed_once(df.select(F.col("o").alias("iri"), F.col("name").alias("label"), "row_id"), "kind", "x")), "x")
    for part in ([("a", "b", "second", 5), ("c", "b", "first", 2)], [("a", "b", "later", 0), ("d", "e", None, 7)], [("d", "e", "named", 8), ("d", "e", "too late", 9)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(land)
        incremental.stream_triples(incremental.records_stream(spark, land, schema), build, landed, checkpoint + "/records").awaitTermination()
        for running in incremental.stream_first(spark, landed, out, checkpoint):
            running.awaitTermination()
    got = sorted((r.s, r.p, r.o) for r in incremental.read_first(spark, out).collect())
    assert got == sorted([("a", "p", "b"), ("c", "p", "b"), ("d", "p", "e"), ("b", V.RDF + "type", "kind"), ("e", V.RDF + "type", "kind"), ("b", V.RDFS + "label", "first"), ("e", V.RDFS + "label", "named")])


class Joining:
    """The local file system with a concat that appends to its first argument, as distributed ones do."""

    def __init__(self, real):
        self.real = real

    def __getattr__(self, name):
        return getattr(self.real, name)

    def hasPathCapability(self, *args):  # noqa: N802
        return True

    def concat(self, head, more):
        with open(urlparse(head.toString()).path, "ab") as out:
            for part in more:
                out.write(Path(urlparse(part.toString()).path).read_bytes())


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("joins", [True, False])
def test_one_turtle_document(spark, tmp_path, packed, joins, monkeypatch):
    if joins:
        fs, make = sinks._fs(spark, f"file://{tmp_path}")
        monkeypatch.setattr(sinks, "_fs", lambda *_: (Joining(fs), make))
    rows = [(f"{V.EMI}s{k}", V.RDFS + "label", f'a "{k}"\n', "literal", None) for k in range(50)]
    frame = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_dtype string").repartition(7)
    for given in (frame, frame.limit(0), frame):  # the last one overwrites
        out = sinks.write_turtle_document(given, f"file://{tmp_path}/ttl", packed)
        (only,) = [f for f in (tmp_path / "ttl").iterdir() if not f.name.endswith(".crc")]
        assert out.endswith(only.name)
        text = (gzip.decompress(only.read_bytes()) if packed else only.read_bytes()).decode()
        head, _, body = text.partition("\n\n")
        assert sorted(head.split("\n")) == sorted(f"@prefix {n}: <{b}> ." for n, b in V.PREFIXES.items())
        assert sorted(body.splitlines()) == sorted(f'emi:s{k} rdfs:label "a \\"{k}\\"\\n" .' for k in range(50 if given is frame else 0))


def test_document_is_passed_on_without_a_sort(spark, tmp_path, monkeypatch):
    """Without a file system that joins files one task copies the lines, and holds no more than a batch."""
    monkeypatch.setattr(type(spark.range(0)), "sortWithinPartitions", lambda *_: pytest.fail("sorted"))
    table = spark.createDataFrame([(f"http://x/{k}", V.RDF + "type", "http://x/t", "iri", None) for k in range(50)], "s string, p string, o string, o_kind string, o_dtype string")
    with gzip.open(Path(sinks.write_turtle_document(table, str(tmp_path / "d"))), "rt") as f:
        lines = f.read().splitlines()
    assert lines[: len(V.PREFIXES) + 1] == [*(f"@prefix {n}: <{b}> ." for n, b in V.PREFIXES.items()), ""] and len(lines) == len(V.PREFIXES) + 51


def test_landed_rows_keep_their_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id * 7919 % 1000 AS row_id").coalesce(1)
    sinks.write_delimited(source_queries.in_order(rows, 100).selectExpr("row_id AS n"), str(tmp_path / "rows"), gzip=True)
    assert len(list((tmp_path / "rows").glob("part-*"))) > 4
    assert all(int(r.n) == r.row_id for r in readers.delimited(spark, str(tmp_path / "rows")).collect())
