"""Sources, sinks and what reads them, over the driver's tables: each query lands a table in a file
format in the shared folder and reads it back through the library; with the SQL of the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.functions import scalars as S
from taxograph.operators import analytics, graph, lineage, resolve, sparql, stars, stats, tables, terms, triples
from taxograph.plans import pipelines
from taxograph.plans import queries as Q
from taxograph.plans.queries import query, rounded, table
from taxograph.plans.session import shared_dir
from taxograph.sources import diagrams, readers, sinks, sparql_http
from taxograph.streaming import incremental


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str, **options) -> str:
    """The path of df as delimited text."""
    path = place(df.sparkSession, name)
    sinks.write_delimited(df, path, **options)
    return path


def landed_lines(df: DataFrame, name: str) -> str:
    """The path of a one-column df as lines of text."""
    path = place(df.sparkSession, name)
    df.write.text(path)
    return path


def in_order(df: DataFrame, each: int = 100_000) -> DataFrame:
    """df in the order of row_id, dealt to all partitions: text is written, and gzip read, by a task a file."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // each))
    return df.repartitionByRange(n, "row_id").sortWithinPartitions("row_id")


# --- delimited text -----------------------------------------------------------------------------


@query("csv_file", "SELECT c_custkey::VARCHAR AS c_custkey, '  ' || c_name || ' \"x\", y' AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment FROM customer")
def csv_file(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.expr("'  ' || c_name || ' \"x\", y'").alias("name"), F.expr("CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'N/A' ELSE '' END").alias("segment"))
    return readers.delimited(spark, landed(rows, "customers"), row_id=False)


@query("csv_line_ends", "SELECT doc_id::VARCHAR AS doc_id, text || chr(10) || '\"end\"' AS text FROM documents WHERE text IS NOT NULL")
def csv_line_ends(spark, sf):
    rows = table(spark, sf, "documents").filter("text is not null").select("doc_id", F.expr("text || '\\n\"end\"'").alias("text"))
    return readers.delimited(spark, landed(rows, "texts"), keep_na=True, row_id=False, multiline=True)


@query("mapping_file", f"SELECT '{V.WD}Q' || p_partkey AS entity, p_size::VARCHAR AS eol, p_partkey::VARCHAR AS gbif, CASE WHEN p_partkey % 3 = 0 THEN p_brand || '\"' END AS ncbi, CAST(NULL AS VARCHAR) AS eppo, p_name AS name FROM part")
def mapping_file(spark, sf):
    path = landed(in_order(Q.part_mapping(spark, sf)).drop("row_id"), "mapping", gzip=True)
    return readers.mapping_table(spark, path).select(F.col("WdID").alias("entity"), "eol", "gbif", "ncbi", "eppo", F.col("WdName").alias("name"))


def _rank(c: str) -> str:
    """One of three rank entities by a number."""
    return f"'{V.WD}' || CASE {c} % 3 WHEN 0 THEN 'Q36732' WHEN 1 THEN 'Q38348' ELSE 'Q37517' END"


@query("lineage_files", """
WITH steps AS (SELECT c_nationkey AS id, c_custkey % 3 AS k, max(c_mktsegment) AS name FROM customer GROUP BY ALL),
lineages AS (SELECT id, 'name ' || (id % 7) AS name, max(name) FILTER (k = 0) AS kingdom, max(name) FILTER (k = 1) AS phylum, max(name) FILTER (k = 2) AS class FROM steps GROUP BY id)
SELECT id::VARCHAR AS id, name, kingdom, phylum, class, count(*) OVER (PARTITION BY name) > 1 AS repeated FROM lineages""")
def lineage_files(spark, sf):
    steps = table(spark, sf, "customer").groupBy("c_nationkey", F.expr(_rank("c_custkey")).alias("hTaxRank")).agg(F.max("c_mktsegment").alias("hTaxName"))
    long = steps.select(F.col("c_nationkey").alias("WdID"), F.expr("'name ' || (c_nationkey % 7)").alias("WdName"), F.lit("x").alias("hTax"), "hTaxName", "hTaxRank")
    aligned, repeats = place(spark, "lineage"), place(spark, "repeats")
    pipelines.shape(spark, landed(long, "long", gzip=True), aligned, repeats)
    several = readers.lineage_aligned(spark, repeats).select("WdID", F.lit(True).alias("r"))
    out = readers.lineage_aligned(spark, aligned).join(several, "WdID", "left")
    return out.select(F.col("WdID").alias("id"), F.col("WdName").alias("name"), "kingdom", "phylum", "class", F.coalesce("r", F.lit(False)).alias("repeated"))


def records_file(spark, sf) -> str:
    """The order records as tab-separated text, with paths of names and ranks."""
    paths = [F.lit(v).alias(f"{side}TaxonPath{c}") for side in ("source", "target") for c, v in (("Names", "Animalia | Chordata"), ("RankNames", "kingdom | phylum"))]
    return landed(in_order(Q.order_records(spark, sf)).select("*", *paths).select(*readers.TAXON_COLUMNS, *readers.RECORD_COLUMNS), "records", sep="\t", gzip=True)


@query("records_tsv", f"SELECT sourceTaxonId, targetTaxonName, 'Animalia | Chordata' AS sourceTaxonPathNames, interactionTypeName, nullif(localityName, '') AS localityName, referenceDoi, decimalLatitude, sourceBodyPartId, sourceSexName, targetSexName FROM ({Q.RECORDS_SQL})")
def records_tsv(spark, sf):
    return readers.interactions(spark, records_file(spark, sf), spread=8).select("sourceTaxonId", "targetTaxonName", "sourceTaxonPathNames", "interactionTypeName", "localityName", "referenceDoi", "decimalLatitude", "sourceBodyPartId", "sourceSexName", "targetSexName")


@query("taxa_of_sides", f"WITH r AS ({Q.RECORDS_SQL}) SELECT sourceTaxonId AS id, sourceTaxonName AS name, 'Animalia' AS kingdom, 'Chordata' AS phylum FROM r UNION SELECT targetTaxonId, targetTaxonName, 'Animalia', 'Chordata' FROM r")
def taxa_of_sides(spark, sf):
    return resolve.taxa(readers.interactions(spark, records_file(spark, sf), taxa_only=True)).select(F.col("TaxonId").alias("id"), F.col("TaxonName").alias("name"), "kingdom", "phylum")


@query("traits_tsv", f"SELECT AccSpeciesName, ObservationID, Dataset, Reference, TraitName, nullif(OrigValueStr, '') AS OrigValueStr, OrigUnitStr, UnitName FROM ({Q.TRAITS.format(string='VARCHAR')})")
def traits_tsv(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("taxograph_part")
    rows = spark.sql(Q.TRAITS.format(string="STRING").replace("FROM part", "FROM taxograph_part part")).drop("row_id")
    return readers.traits(spark, landed(rows, "traits", sep="\t"), spread=4).select("AccSpeciesName", "ObservationID", "Dataset", "Reference", "TraitName", "OrigValueStr", "OrigUnitStr", "UnitName")


@query("species_file", "SELECT p_name AS species, p_brand AS accepted FROM part")
def species_file(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("no"), F.col("p_name").alias("TRY_SpeciesName"), F.col("p_brand").alias("TRY_AccSpeciesName"))
    return readers.species_list(spark, landed(rows, "species")).select(F.col("TRY_SpeciesName").alias("species"), F.col("TRY_AccSpeciesName").alias("accepted"))


@query("dictionary_file", "SELECT n_regionkey::VARCHAR AS key, arg_max(n_name, n_nationkey) AS value, 0::BIGINT AS unnamed FROM nation GROUP BY n_regionkey")
def dictionary_file(spark, sf):
    rows = table(spark, sf, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.col("n_regionkey").alias("from"), F.col("n_name").alias("to"))
    path = landed(rows, "dictionary", one_file=True)
    unnamed = readers.dictionary(spark, path, "from", "other").agg(F.count(F.lit(1)).alias("unnamed"))
    return readers.dictionary(spark, path, "from", "to").join(unnamed)  # one row


@query("sex_file", "SELECT lower(n_name) AS key, 'obo:' || n_nationkey AS value FROM nation")
def sex_file(spark, sf):
    rows = table(spark, sf, "nation").select(F.col("n_name").alias("input"), F.concat(F.lit("obo:"), "n_nationkey").alias("output"))
    return readers.sex_map(spark, landed(rows, "sexes", sep="\t"))


@query("term_map_files", f"""
WITH maps AS (SELECT 0 AS file, r_name AS input, 'region ' || r_name AS match, 'http://r/' || r_regionkey AS uri FROM region
  UNION ALL SELECT 1, CASE WHEN n_nationkey < 5 THEN r_name ELSE n_name END, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'http://n/' || n_nationkey END FROM nation LEFT JOIN region ON r_regionkey = n_nationkey),
keys AS (SELECT *, CASE WHEN contains(lower(input), 'mono') OR contains(lower(input), 'auto') THEN lower(input) ELSE regexp_replace(lower(input), 's$', '') END AS key FROM maps)
SELECT key, arg_max(match, file) AS name, coalesce(arg_max(uri, file) FILTER (uri IS NOT NULL), '{V.EMI_BOX}' || url_encode(arg_max(match, file))) AS iri FROM keys GROUP BY key""")
def term_map_files(spark, sf):
    regions = table(spark, sf, "region")
    first = regions.select(F.col("r_name").alias("InputTerm"), F.concat(F.lit("region "), "r_name").alias("BestMatch"), F.concat(F.lit("http://r/"), "r_regionkey").alias("URI"))
    rows = table(spark, sf, "nation").join(regions, F.col("r_regionkey") == F.col("n_nationkey"), "left")
    second = rows.select(F.coalesce("r_name", "n_name").alias("Input Term"), F.col("n_name").alias("Primary Label"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("http://n/"), "n_nationkey")).alias("URI"))
    return terms.entity_map(readers.term_maps(spark, landed(first, "terms"), landed(second, "terms"))).select("key", "name", "iri")


@query("separator_file", "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def separator_file(spark, sf):
    return readers.sniffed(spark, landed(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "suppliers", sep=";")).select("s_suppkey", "s_name")


@query("result_file", "SELECT 'http://x/' || p_partkey AS part, p_name || ' ' || p_brand AS label FROM part")
def result_file(spark, sf):
    cells = F.expr("'\"' || p_name || '\"^^<http://www.w3.org/2001/XMLSchema#string>  ' || p_brand")
    lines = table(spark, sf, "part").select(F.concat(F.lit("http://x/"), "p_partkey", F.lit("\t"), cells).alias("value"))
    head = spark.createDataFrame([("?part\t?label",)], "value string")
    return readers.query_result(spark, landed_lines(head.unionByName(lines).coalesce(1), "result")).select("part", "label")


@query("match_file", "SELECT c_name AS term, c_mktsegment AS label, 'http://c/' || c_custkey AS uri, printf('%.4f', (c_custkey % 1000) / 1000.0) AS similarity FROM customer")
def match_file(spark, sf):
    c = table(spark, sf, "customer")
    matches = c.select(F.col("c_name").alias("term"), F.col("c_mktsegment").alias("label"), F.col("c_mktsegment").alias("main_label"), F.concat(F.lit("http://c/"), "c_custkey").alias("uri"), ((F.col("c_custkey") % 1000) / 1000.0).cast("double").alias("score"))
    path = place(spark, "matches")
    sinks.write_matches(matches, path)
    return readers.delimited(spark, path, row_id=False).select(F.col("Input Term").alias("term"), F.col("Matched Term").alias("label"), F.col("URI").alias("uri"), F.col("Similarity Score").alias("similarity"))


@query("summary_file", "SELECT event_type, count(*)::VARCHAR AS n_records, count(DISTINCT user_id)::VARCHAR AS n_values FROM events GROUP BY event_type")
def summary_file(spark, sf):
    return readers.delimited(spark, landed(analytics.summary(table(spark, sf, "events"), "event_type", "user_id"), "summary", sep="\t"), "\t", row_id=False)


@query("matched_taxa_file", f"""
WITH {Q.ID_MAP}, r AS ({Q.RECORDS_SQL}),
taxa AS (SELECT sourceTaxonId AS id, sourceTaxonName AS name FROM r UNION SELECT targetTaxonId, targetTaxonName FROM r)
SELECT id, name, CASE WHEN p.wd IS NOT NULL THEN 'Wikidata:' || p.wd END AS wd, CASE WHEN p.wd IS NOT NULL THEN 'ID-MATCHED-BY-NAME-direct' ELSE 'ID-NOT-FOUND' END AS status
FROM taxa LEFT JOIN (SELECT n_name AS n, 'Q' || n_nationkey AS wd FROM nation) p ON n = name""")
def matched_taxa_file(spark, sf):
    mapping = landed(in_order(Q.part_mapping(spark, sf)).drop("row_id"), "mapping", gzip=True)
    names = table(spark, sf, "nation").select(F.concat(F.lit(V.WD + "Q"), "n_nationkey").alias("WdID"), F.col("n_name").alias("WdName"), *[F.lit(None).cast("string").alias(r) for r in V.RANKS])
    aligned, repeats, out = landed(names, "aligned"), landed(names.limit(0), "repeats"), place(spark, "matched")
    pipelines.match_interactions(spark, records_file(spark, sf), mapping, aligned, repeats, out)
    return readers.delimited(spark, out).select(F.col("TaxonId").alias("id"), F.col("TaxonName").alias("name"), F.col("Mapped_ID_WD").alias("wd"), F.col("Match_Status").alias("status"))


# --- lines, XML and Turtle ----------------------------------------------------------------------


@query("split_term_lines", "SELECT trim(unnest(string_split(replace(p_type || ' / ' || p_brand || ', ' || p_partkey, '/', ','), ','))) AS term FROM part")
def split_term_lines(spark, sf):
    lines = table(spark, sf, "part").select(F.explode(F.array(F.expr("'  ' || p_type || ' / ' || p_brand || ', ' || p_partkey"), F.lit(""), F.lit("  "))).alias("value"))
    return readers.term_lines(spark, landed_lines(lines, "lines")).select(F.explode(S.split_terms(F.col("line"))).alias("term"))


#: Classes in a document.
PARTS_EACH = 50_000


@query("ontology_file", "SELECT unnest([p_name, p_type, p_brand] || CASE WHEN p_partkey % 2 = 0 THEN ['size ' || p_size] ELSE [] END) AS label, 'http://o/' || p_partkey AS uri, p_name AS main_label FROM part")
def ontology_file(spark, sf):
    lines = table(spark, sf, "part").select(F.expr(f"p_partkey div {PARTS_EACH}").alias("document"), F.expr("""
        '<owl:Class rdf:about="http://o/' || p_partkey || '"><rdfs:label>' || p_name || '</rdfs:label><oboInOwl:hasExactSynonym>' || p_type || '</oboInOwl:hasExactSynonym><oboInOwl:hasExactSynonym>' || p_brand || '</oboInOwl:hasExactSynonym>'
        || CASE WHEN p_partkey % 2 = 0 THEN '<oboInOwl:hasRelatedSynonym>size ' || p_size || '</oboInOwl:hasRelatedSynonym>' ELSE '' END || '</owl:Class>'""").alias("value"))
    names = " ".join(f'xmlns:{n}="http://{n}#"' for n in ("rdf", "rdfs", "owl", "oboInOwl"))
    # documents of PARTS_EACH classes, a file each: one file would be written by one task
    ends = lines.select("document").distinct().select("document", F.explode(F.expr(f"array(struct(0 AS at, '<rdf:RDF {names}>' AS value), struct(2 AS at, '</rdf:RDF>' AS value))")).alias("e"))
    whole = lines.select("document", F.lit(1).alias("at"), "value").union(ends.select("document", "e.at", "e.value"))
    path = place(spark, "ontology")
    whole.repartition("document").sortWithinPartitions("document", "at").select("document", "value").write.partitionBy("document").text(path)
    return readers.ontology_terms(spark, path)


PREFIX_ROWS = ", ".join(f"('{n}', '{b}')" for n, b in V.PREFIXES.items())


@query("turtle_prefixes", f"SELECT * FROM (VALUES {PREFIX_ROWS}) AS p(prefix, namespace)")
def turtle_prefixes(spark, sf):
    path = place(spark, "turtle")
    sinks.write_turtle(Q.part_triples(spark, sf), path)
    return readers.turtle_prefixes(spark, f"{path}/0-prefixes")


@query("turtle_file", Q.ORACLE["turtle_lines"].replace(Q.RECORD_TRIPLES, Q.TRAIT_TRIPLES))
def turtle_file(spark, sf):
    path = place(spark, "turtle")
    sinks.write_turtle(Q.part_triples(spark, sf), path)
    return spark.read.text(f"{path}/1-statements")


@query("turtle_document", f"""
SELECT value, 'document.ttl.gz' AS file, false AS head FROM ({Q.ORACLE["turtle_lines"].replace(Q.RECORD_TRIPLES, Q.TRAIT_TRIPLES)}) AS statements
UNION ALL SELECT '@prefix ' || prefix || ': <' || namespace || '> .', 'document.ttl.gz', true FROM (VALUES {PREFIX_ROWS}) AS p(prefix, namespace) UNION ALL SELECT '', 'document.ttl.gz', true""")
def turtle_document(spark, sf):
    """The lines of the document; what is declared first is its head, as one gzip file is one task."""
    lines = spark.read.text(sinks.write_turtle_document(Q.part_triples(spark, sf), place(spark, "document")))
    return lines.select("value", F.col("_metadata.file_name").alias("file"), (F.monotonically_increasing_id() <= len(V.PREFIXES)).alias("head"))


@query("prefix_pairs", f"SELECT * FROM (VALUES {PREFIX_ROWS}) AS p(prefix, namespace)")
def prefix_pairs(spark, sf):
    path = place(spark, "turtle")
    sinks.write_turtle(Q.part_triples(spark, sf), path)
    declared = readers.turtle_prefixes(spark, f"{path}/0-prefixes").withColumn("row_id", F.monotonically_increasing_id())
    node, sh = F.concat(F.lit("_:"), F.sha2("prefix", 256)), "http://www.w3.org/ns/shacl#"
    stated = triples.emitted(declared, [triples.literal(node, sh + "prefix", F.col("prefix")), triples.literal(node, sh + "namespace", F.col("namespace"))], "prefixes")
    return graph.bgp(stated, [("?x", sh + "prefix", "?prefix"), ("?x", sh + "namespace", "?namespace")]).select("prefix", "namespace")


@query("streamed_triples", f"""
SELECT 'http://c/' || c_custkey AS s, '{V.RDF}type' AS p, 'http://segment/' || c_mktsegment AS o FROM customer
UNION SELECT 'http://segment/' || c_mktsegment, '{V.RDFS}label', c_mktsegment FROM customer""")
def streamed_triples(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_custkey").alias("row_id"))
    source, out, done, checkpoint = (place(spark, n) for n in ("landing", "batches", "compacted", "offsets"))
    rows.repartition(4).write.parquet(source)
    segment = F.concat(F.lit("http://segment/"), "c_mktsegment")
    build = lambda df: triples.emitted(df, [triples.iri(F.concat(F.lit("http://c/"), "c_custkey"), V.RDF + "type", segment), triples.literal(segment, V.RDFS + "label", F.col("c_mktsegment"))], "stream")
    stream = incremental.stream_triples(incremental.records_stream(spark, source, rows.schema.simpleString()[7:-1].replace(":", " "), 1), build, out, checkpoint)
    stream.awaitTermination()
    incremental.compacted(spark, out, done)
    return sinks.read_triples(spark, done).select("s", "p", "o")


@query("streamed_first", f"""
SELECT 'http://c/' || c_custkey AS s, '{V.RDF}type' AS p, 'http://segment/' || c_mktsegment AS o FROM customer WHERE c_mktsegment IS NOT NULL
UNION SELECT 'http://segment/' || c_mktsegment, '{V.RDFS}label', arg_min(c_name, c_custkey) FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
UNION SELECT 'http://segment/' || c_mktsegment, '{V.RDF}type', 'http://segment' FROM customer WHERE c_mktsegment IS NOT NULL""")
def streamed_first(spark, sf):
    """Customers in three landings, each followed by a new start of both streams."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", F.col("c_custkey").alias("row_id"))
    source, landed, out, checkpoint = (place(spark, n) for n in ("landing", "batches", "first", "offsets"))
    segment = F.concat(F.lit("http://segment/"), "c_mktsegment")

    def build(df):
        linked = triples.emitted(df, [triples.iri(F.concat(F.lit("http://c/"), "c_custkey"), V.RDF + "type", segment)], "stream")
        return triples.as_set(linked.unionByName(triples.typed_once(df.select(segment.alias("iri"), F.col("c_name").alias("label"), "row_id"), "http://segment", "stream")), "stream")

    schema, most = rows.schema.simpleString()[7:-1].replace(":", " "), rows.agg(F.max("c_custkey")).first()[0] or 0
    for k in range(3):
        rows.filter(f"c_custkey * 3 div {most + 1} = {k}").write.mode("append").parquet(source)
        incremental.stream_triples(incremental.records_stream(spark, source, schema), build, landed, f"{checkpoint}/records").awaitTermination()
        for running in incremental.stream_first(spark, landed, out, checkpoint):
            running.awaitTermination()
    return incremental.read_first(spark, out).select("s", "p", "o")


@query("row_numbers", "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_id, p_partkey::VARCHAR AS p_partkey, p_name FROM part")
def row_numbers(spark, sf):
    """Parts in seven files, ordered by key over the files' names."""
    path = place(spark, "numbered")
    sinks.write_delimited(table(spark, sf, "part").select("p_partkey", "p_name").repartitionByRange(7, "p_partkey").sortWithinPartitions("p_partkey"), path, gzip=True)
    return readers.delimited(spark, path).select("row_id", "p_partkey", "p_name")


# --- entities and fetched queries ---------------------------------------------------------------


def _sex_entities(spark) -> DataFrame:
    rows = [("males", "male organism", "http://x/m", 0), ("female", "female organism", None, 1)]
    return terms.entity_map(spark.createDataFrame(rows, "input string, match string, uri string, row_id int"))


@query("term_entities", f"""
WITH {Q.COUNTED},
maps(key, name, iri) AS (VALUES ('male', 'male organism', 'http://x/m'), ('female', 'female organism', '{V.EMI_BOX}female%20organism')),
found AS (SELECT p_partkey, maps.* FROM (SELECT *, regexp_replace(trim(regexp_replace(term, '(?i)adult[as]?|tortere|juvenil[e]?|maybe', '', 'g')), 's$', '') AS bare FROM terms) JOIN maps ON key = term OR key = bare)
SELECT 'http://part/' || p_partkey AS s, '{V.EMI}hasSex' AS p, iri AS o, 'iri' AS o_kind FROM found
UNION SELECT iri, '{V.RDF}type', '{V.EMI}BiologicalSex', 'iri' FROM found UNION SELECT iri, '{V.RDFS}label', name, 'literal' FROM found""")
def term_entities(spark, sf):
    rows = table(spark, sf, "part").select(F.concat(F.lit("http://part/"), "p_partkey").alias("part"), F.expr(Q.FREE).alias("t"), F.col("p_partkey").alias("row_id"))
    return triples.term_entities(rows, "t", "part", V.EMI + "hasSex", V.EMI + "BiologicalSex", _sex_entities(spark)).select("s", "p", "o", "o_kind")


@query("entity_links", f"""
WITH {Q.RECORD_TRIPLES}
SELECT sample AS s, iri AS o FROM body
UNION SELECT source_sample, 'http://segments/' || sourceBodyPartName FROM kept WHERE sourceBodyPartName IS NOT NULL AND (sourceBodyPartId IS NULL OR sourceBodyPartId NOT LIKE 'UBERON:%')""")
def entity_links(spark, sf):
    segments = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("input")).distinct()
    entities = terms.entity_map(segments.select("input", F.col("input").alias("match"), F.concat(F.lit("http://segments/"), "input").alias("uri"), F.lit(0).alias("row_id")))
    made = triples.interaction_triples(resolve.kept_records(Q.order_records(spark, sf)), Q.sex_terms(spark), entities)
    return made.filter(F.col("p") == V.EMI + "hasAnatomicalEntity").select("s", "o")


WDT = "http://www.wikidata.org/prop/direct/"


@query("mapping_by_sparql", f"SELECT '{V.WD}Q' || p_partkey AS \"WdID\", p_name AS \"WdName\", p_size::VARCHAR AS eol, p_partkey::VARCHAR AS gbif, CASE WHEN p_partkey % 3 = 0 THEN p_brand || '\"' END AS ncbi, CAST(NULL AS VARCHAR) AS eppo FROM part")
def mapping_by_sparql(spark, sf):
    m, taxon = Q.part_mapping(spark, sf), F.col("WdID")
    columns = [triples.literal(taxon, WDT + p, F.col(c)) for c, p in zip(V.ID_COLUMNS, V.ID_PROPERTIES, strict=True)]
    stated = triples.emitted(m, [triples.iri(taxon, WDT + "P31", V.WD + "Q16521"), triples.literal(taxon, WDT + "P225", F.col("WdName")), *columns], "mapping")
    return sparql.sparql(stars.write_stars(stated.select("s", "p", "o", "o_kind"), place(spark, "stars")), sparql_http.mapping_query()).select("WdID", "WdName", "eol", "gbif", "ncbi", "eppo")


@query("lineage_by_sparql", f"""
WITH RECURSIVE up AS (SELECT p_partkey AS node, p_partkey AS ancestor FROM part UNION SELECT node, ancestor // 2 FROM up WHERE ancestor // 2 >= (SELECT min(p_partkey) FROM part) AND ancestor // 2 > 0)
SELECT '{V.WD}Q' || node AS "WdID", n.p_name AS "WdName", '{V.WD}Q' || ancestor AS "hTax", a.p_name AS "hTaxName", 'http://size/' || a.p_size AS "hTaxRank"
FROM up JOIN part n ON n.p_partkey = node JOIN part a ON a.p_partkey = ancestor""")
def lineage_by_sparql(spark, sf):
    entity = lambda c: F.concat(F.lit(V.WD + "Q"), c)
    parts = table(spark, sf, "part").withColumn("row_id", F.col("p_partkey")).withColumn("up", F.expr("p_partkey div 2"))
    known = table(spark, sf, "part").select(F.col("p_partkey").alias("up"), F.lit(True).alias("has_up"))
    rows = parts.join(known, "up", "left")
    me = entity(F.col("p_partkey"))
    made = [triples.iri(me, WDT + "P31", V.WD + "Q16521"), triples.literal(me, WDT + "P225", F.col("p_name")), triples.iri(me, WDT + "P105", F.concat(F.lit("http://size/"), "p_size")), triples.iri(me, WDT + "P171", F.when(F.col("has_up") & (F.col("up") > 0), entity(F.col("up"))))]
    return sparql.sparql(Q.stored(spark, triples.emitted(triples.dealt(rows, parts), made, "lineage")), sparql_http.lineage_query())


# --- names, networks and statistics -------------------------------------------------------------


@query("display_names", "SELECT page_id, substr(replace(list_extract(string_split(url, '/'), -1), '_', ' '), 1, 30) AS label FROM pages")
def display_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.display_name(F.col("url")).alias("label"))


@query("curie_links", f"SELECT p_partkey, '<b>' || p_name || '</b> <a href=\"{V.EMI}Part_' || p_partkey || '\">emi:Part_' || p_partkey || '</a>, http://x/emi:y <a href=\"{V.SOSA}Sample\">sosa:Sample</a> none:Z' AS markup FROM part")
def curie_links(spark, sf):
    text = F.expr("'<b>' || p_name || '</b> emi:Part_' || p_partkey || ', http://x/emi:y sosa:Sample none:Z'")
    return table(spark, sf, "part").select("p_partkey", S.link_curies(text).alias("markup"))


#: Labels by key: an entity, one with inner markup, a linked one, none that is known.
LABELS = """CASE p_partkey % 4 WHEN 0 THEN '<b>emi:Part_' || p_partkey || ' (optional)</b>' WHEN 1 THEN p_name || ' & <font color="#1"><i>sosa:Sample (emi:Y)</i></font> "' WHEN 2 THEN '<a href="x">emi:A</a> <b>emi:B</b>' ELSE 'emi:Bare <div>none:' || p_partkey || '</div>' END"""


@query("diagram_links", f"""
SELECT 'c' || p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN '<b><a href="{V.EMI}Part_' || p_partkey || '">emi:Part_' || p_partkey || ' (optional)</a></b>'
WHEN 1 THEN p_name || ' & <font color="#1"><a href="{V.SOSA}Sample"><i>sosa:Sample (emi:Y)</i></a></font> "' WHEN 2 THEN '<a href="x">emi:A</a> <b>emi:B</b>' ELSE 'emi:Bare <div>none:' || p_partkey || '</div>' END AS value,
CASE WHEN p_partkey % 3 = 0 THEN 'value=''no''' END AS style FROM part
UNION ALL SELECT DISTINCT 'root' || p_partkey // 40, NULL, NULL FROM part""")
def diagram_links(spark, sf):
    """Parts as the cells of diagrams of forty, written, linked, written again and read as cells."""
    rows = table(spark, sf, "part").select("p_partkey", F.expr("p_partkey div 40").alias("diagram"), F.expr(LABELS).alias("label"))
    style = F.when(F.col("p_partkey") % 3 == 0, " style=\"value='no'\"").otherwise("")
    cell = F.concat(F.lit('<mxCell id="c'), "p_partkey", F.lit('"'), style, F.lit(' value="'), diagrams.escaped(F.col("label")), F.lit('" vertex="1">\n<mxGeometry as="geometry"/></mxCell>'))
    cells = rows.select("diagram", F.struct("p_partkey", cell.alias("text")).alias("cell")).groupBy("diagram").agg(F.sort_array(F.collect_list("cell"))["text"].alias("texts"))
    document = F.concat(F.lit('<mxfile><diagram><mxGraphModel><root><mxCell id="root'), "diagram", F.lit('"/>'), F.array_join("texts", "\n"), F.lit("</root></mxGraphModel></diagram></mxfile>"))
    drawn, linked = place(spark, "drawn"), place(spark, "linked")
    diagrams.write_documents(cells.select(F.col("diagram").cast("string").alias("name"), document.alias("document")), drawn)
    diagrams.write_documents(diagrams.link_cells(diagrams.read_documents(spark, drawn)), linked)
    return diagrams.read_cells(spark, linked).select("id", "value", "style")


@query("columns_in_order", "SELECT n_name AS name, CAST(NULL AS VARCHAR) AS rank, n_regionkey AS region FROM nation")
def columns_in_order(spark, sf):
    rows = table(spark, sf, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"), "n_nationkey")
    return tables.with_columns_in_order(rows, ["name", "rank", "region"])


TOP = f"{Q.THREE}, top AS (SELECT species, count(DISTINCT t) AS score FROM named GROUP BY species ORDER BY score DESC, species LIMIT 20)"


@query("top_species", f"WITH {TOP} SELECT species, score FROM top")
def top_species(spark, sf):
    return analytics.top_species(*Q.three_tables(spark, sf), 20)


@query("top_network", f"""
WITH {TOP}, kinds AS (
  SELECT x, y, 1 AS r, 'trait' AS kind FROM a WHERE x IN (SELECT species FROM top) UNION ALL SELECT x, y, 2, 'metabolite' FROM b WHERE x IN (SELECT species FROM top)
  UNION ALL SELECT x, y, 3, 'interaction' FROM c WHERE x IN (SELECT species FROM top) AND y IN (SELECT species FROM top))
SELECT least(x, y) AS a, greatest(x, y) AS b, arg_max(kind, r) AS edge_type FROM kinds GROUP BY ALL""")
def top_network(spark, sf):
    three = Q.three_tables(spark, sf)
    return analytics.network_of(analytics.top_species(*three, 20), *three)


PER = "per AS (SELECT l_suppkey, avg(l_quantity) AS a, avg(l_discount) AS b FROM lineitem GROUP BY l_suppkey)"
#: Of two standardised columns the components are their sum and difference over the root of two.
SCALED = f"""{PER}, scaled AS (SELECT l_suppkey, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS a, (b - avg(b) OVER ()) / stddev_pop(b) OVER () AS b FROM per),
signs AS (SELECT corr(a, b) AS r, sign(corr(a, b)) AS g FROM per), scores AS (SELECT l_suppkey, (a + g * b) / sqrt(2) AS pc1, (a - g * b) / sqrt(2) AS pc2 FROM scaled, signs)"""


def per_supplier(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("a"), F.avg("l_discount").alias("b"))


@query("standardised", f"WITH {SCALED} SELECT l_suppkey, round(a, 6) AS a, round(b, 6) AS b FROM scaled")
def standardised(spark, sf):
    out = stats.standardised(per_supplier(spark, sf), ["a", "b"]).select("l_suppkey", vector_to_array("scaled").alias("v"))
    return out.select("l_suppkey", *[F.round(F.col("v")[k], 6).alias(c) for k, c in enumerate("ab")])


@query("pca_of_two", f"WITH {SCALED} SELECT l_suppkey, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2 FROM scores")
def pca_of_two(spark, sf):
    return stats.pca(per_supplier(spark, sf), ["a", "b"], 2, "a")[0].select("l_suppkey", rounded("pc1"), rounded("pc2"))


@query("pca_components", f"""
WITH {SCALED} SELECT 1 AS component, round((1 + abs(r)) / 2, 6) AS ratio, round(1 / sqrt(2), 6) AS a, round(g / sqrt(2), 6) AS b FROM signs
UNION ALL SELECT 2, round((1 - abs(r)) / 2, 6), round(1 / sqrt(2), 6), round(-g / sqrt(2), 6) FROM signs""")
def pca_components(spark, sf):
    _, ratios, loads = stats.pca(per_supplier(spark, sf), ["a", "b"], 2, "a")
    return spark.createDataFrame([(k + 1, round(ratios[k], 6), round(loads[0][k], 6), round(loads[1][k], 6)) for k in range(2)], "component int, ratio double, a double, b double")


@query("strategy_of_two", f"WITH {SCALED}, s AS (SELECT stddev_samp(pc1) AS sd FROM scores) SELECT l_suppkey, round(pc1, 6) AS score, CASE WHEN pc1 <= -sd THEN 'Conservative' WHEN pc1 <= sd THEN 'Intermediate' ELSE 'Acquisitive' END AS strategy FROM scores, s")
def strategy_of_two(spark, sf):
    return stats.strategies(per_supplier(spark, sf), ["a", "b"], "a").select("l_suppkey", F.round("LES_score", 6).alias("score"), "strategy")


#: With five regions the t distribution has three degrees of freedom, whose distribution function is closed.
@query("correlation_p", """
WITH per AS (SELECT n_regionkey, avg(c_acctbal) AS a, count(*) AS b FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_regionkey),
ranks AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS a, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS b FROM per),
r AS (SELECT corr(a, b) AS r, count(*) AS n FROM ranks), t AS (SELECT r, n, abs(r) * sqrt(3 / (1 - r * r)) / sqrt(3) AS u FROM r)
SELECT round(r, 6) AS r, n, round(1 - 2 / pi() * (u / (1 + u * u) + atan(u)), 6) AS p FROM t""")
def correlation_p(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    per = rows.groupBy("n_regionkey").agg(F.avg("c_acctbal").alias("a"), F.count(F.lit(1)).alias("b"))
    found = stats.spearman(per, "a", "b").first()
    return spark.createDataFrame([(round(found["r"], 6), found["n"], round(stats.correlation_p(spark, found["r"], found["n"]), 6))], "r double, n long, p double")
