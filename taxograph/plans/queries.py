"""The operators over the driver's tables, each with the SQL that gives the same rows.

Orders stand for interaction records (a customer and the nation that customer is in, typed by
priority), parts for trait records, a part's key halved for its parent in a tree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.functions import scalars as S
from taxograph.operators import analytics, graph, lineage, resolve, semantic, sparql, stars, stats, store, tables, terms, triples
from taxograph.plans.session import shared_dir
from taxograph.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(name: str, places: int = 6):
    return F.round(name, places).alias(name)


# --- filters and predicates ---------------------------------------------------------------------

PRIORITIES = {"1-URGENT": "kingdom", "2-HIGH": "phylum", "3-MEDIUM": "class"}


@query("rank_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def rank_filter(spark, sf):
    return lineage.rank_filter(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), PRIORITIES, "o_orderpriority")


MARKED = "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN '\\N' WHEN 2 THEN 'no:match' WHEN 3 THEN NULL WHEN 4 THEN 'ĜLOBI:' || source ELSE source END"


@query("valid_filter", f"SELECT doc_id, {MARKED} AS mark FROM documents WHERE doc_id % 7 > 4")
def valid_filter(spark, sf):
    marked = MARKED.replace("'\\N'", "'\\\\N'")
    return table(spark, sf, "documents").select("doc_id", F.expr(marked).alias("mark")).filter(S.valid(F.col("mark")))


@query("semi_either", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 6) OR l_suppkey IN (SELECT p_partkey FROM part WHERE p_size < 6) GROUP BY l_orderkey")
def semi_either(spark, sf):
    small = table(spark, sf, "part").filter("p_size < 6").select("p_partkey")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return tables.in_either(rows, ["l_partkey", "l_suppkey"], small, "p_partkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("taxonomy_or_filter", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN ('Brand#11', 'Brand#23') OR p_size IN (1, 7)")
def taxonomy_or_filter(spark, sf):
    return tables.any_in(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), {"p_brand": ["Brand#11", "Brand#23"], "p_size": [1, 7]})


@query("in_any_case_filter", "SELECT c_custkey, c_name FROM customer WHERE NOT regexp_matches(c_name, '(?i)(001|9#7|CUSTOMER#00002)')")
def in_any_case_filter(spark, sf):
    return analytics.without_fungi(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", ("001", "9#7", "customer#00002"))


LABELS = "'<http://x/' || p_partkey || '> \"' || p_name || '\"^^<http://www.w3.org/2001/XMLSchema#string>  ' || p_brand"


@query("clean_labels", f"""
SELECT p_partkey, trim(regexp_replace(replace(replace(replace(regexp_replace({LABELS}, '<[^>]*>', '', 'g'), '^^', ''), '"', ''), '''', ''), '\\s+', ' ', 'g')) AS label,
       trim('"' || p_name || '"', '"') AS value
FROM part""")
def clean_labels(spark, sf):
    typed = F.expr("'\"' || p_name || '\"^^<http://www.w3.org/2001/XMLSchema#string>'")
    return table(spark, sf, "part").select("p_partkey", S.clean_label(F.expr(LABELS)).alias("label"), S.without_datatype(typed).alias("value"))


# --- lineages and names -------------------------------------------------------------------------


@query("pivot_first", """
SELECT o_custkey AS id, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS kingdom,
       arg_min(o_orderstatus, o_orderkey) FILTER (o_orderpriority = '2-HIGH') AS phylum, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderpriority = '3-MEDIUM') AS class
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY o_custkey""")
def pivot_first(spark, sf):
    long = table(spark, sf, "orders").select(F.col("o_custkey").alias("WdID"), F.lit("x").alias("WdName"), F.col("o_orderstatus").alias("hTaxName"), F.col("o_orderpriority").alias("hTaxRank"), F.col("o_orderkey").alias("row_id"))
    return lineage.align(lineage.rank_filter(long, PRIORITIES), PRIORITIES).withColumnRenamed("WdID", "id").drop("WdName")


@query("duplicate_groups", "SELECT doc_id, n_chars FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents WHERE text IS NOT NULL) WHERE n > 1")
def duplicate_groups(spark, sf):
    return tables.duplicate_groups(table(spark, sf, "documents").select("doc_id", "n_chars", "text"), "text", ["doc_id"]).select("doc_id", "n_chars")


def part_mapping(spark, sf) -> DataFrame:
    """A mapping table out of parts: three identifier columns filled, the others empty."""
    p = table(spark, sf, "part")
    filled = {"eol": F.col("p_size").cast("string"), "gbif": F.col("p_partkey").cast("string"), "ncbi": F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_brand"), F.lit('"')))}
    columns = [filled.get(c, F.lit(None).cast("string")).alias(c) for c in V.ID_COLUMNS]
    return p.select(F.concat(F.lit(V.WD + "Q"), F.col("p_partkey")).alias("WdID"), *columns, F.col("p_name").alias("WdName"), F.col("p_partkey").alias("row_id"))


ID_MAP = f"""
ids AS (
  SELECT key, arg_max(name, (col, p_partkey)) AS name, arg_max(wd, (col, p_partkey)) AS wd FROM (
    SELECT 'Wikidata:Q' || p_partkey AS key, p_name AS name, 'Wikidata:Q' || p_partkey AS wd, 0 AS col, p_partkey FROM part
    UNION ALL SELECT 'EOL:' || p_size, p_name, 'Wikidata:Q' || p_partkey, 1, p_partkey FROM part
    UNION ALL SELECT 'GBIF:' || p_partkey, p_name, 'Wikidata:Q' || p_partkey, 2, p_partkey FROM part
    UNION ALL SELECT 'NCBI:' || p_brand, p_name, 'Wikidata:Q' || p_partkey, 3, p_partkey FROM part WHERE p_partkey % 3 = 0)
  GROUP BY key)"""


@query("melt_last_wins", f"WITH {ID_MAP} SELECT key, name, wd FROM ids")
def melt_last_wins(spark, sf):
    return resolve.id_map(part_mapping(spark, sf))


TAXON_IDS = "CASE l_linenumber % 5 WHEN 0 THEN 'https://www.gbif.org/species/' || l_partkey WHEN 1 THEN 'EOL:' || (l_quantity::INT) WHEN 2 THEN ' ' WHEN 3 THEN NULL ELSE 'ITIS:' || l_suppkey END"


def line_taxa(spark, sf) -> DataFrame:
    ids = TAXON_IDS.replace("l_quantity::INT", "cast(l_quantity AS INT)")
    rows = table(spark, sf, "lineitem").select(F.expr(ids).alias("TaxonId"), F.concat(F.lit("part "), F.col("l_partkey")).alias("TaxonName")).distinct()
    return rows.withColumn("TaxonId", S.normalise_id(F.col("TaxonId")))


@query("id_lookup_status", f"""
WITH {ID_MAP},
taxa AS (SELECT DISTINCT replace({TAXON_IDS}, 'https://www.gbif.org/species/', 'GBIF:') AS taxon_id, 'part ' || l_partkey AS taxon_name FROM lineitem)
SELECT taxon_id, taxon_name, name AS mapped_value, wd AS mapped_id_wd, CASE WHEN name IS NOT NULL THEN trim(taxon_id) END AS mapped_id,
       CASE WHEN coalesce(trim(taxon_id), '') = '' THEN 'ID-NOT-PRESENT' WHEN name IS NULL THEN 'ID-NOT-FOUND' WHEN lower(name) = lower(taxon_name) THEN 'NAME-MATCH-YES' ELSE 'NAME-MATCH-NO' END AS match_status
FROM taxa LEFT JOIN ids ON key = trim(taxon_id)""")
def id_lookup_status(spark, sf):
    out = resolve.by_id(line_taxa(spark, sf), resolve.id_map(part_mapping(spark, sf)))
    return out.select(F.col("TaxonId").alias("taxon_id"), F.col("TaxonName").alias("taxon_name"), F.col("Mapped_Value").alias("mapped_value"), F.col("Mapped_ID_WD").alias("mapped_id_wd"), F.col("Mapped_ID").alias("mapped_id"), F.col("Match_Status").alias("match_status"))


def part_lineages(spark, sf) -> DataFrame:
    """Lineages out of parts: a brand and a size as the name of some, so that names repeat."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", "p_brand", F.col("p_size") % 5)).otherwise(F.col("p_partkey").cast("string"))
    word = lambda k: F.element_at(F.split("p_type", " "), k)
    ranks = {"family": word(1), "class": F.col("p_brand"), "order": F.concat(F.lit("o"), F.col("p_size") % 4), "phylum": F.concat(F.lit("P"), F.col("p_size") % 3), "kingdom": F.when(F.col("p_size") % 2 == 0, "Plantae")}
    return table(spark, sf, "part").select(F.concat(F.lit(V.WD + "Q"), F.col("p_partkey")).alias("WdID"), name.alias("WdName"), *[c.alias(r) for r, c in ranks.items()], F.col("p_partkey").alias("row_id"))


LINEAGES = """
lineages AS (
  SELECT 'Q' || p_partkey AS wd, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' ' || (p_size % 5) ELSE p_partkey::VARCHAR END AS name,
         split_part(p_type, ' ', 1) AS family, p_brand AS class, 'o' || (p_size % 4) AS "order", 'P' || (p_size % 3) AS phylum, CASE WHEN p_size % 2 = 0 THEN 'Plantae' END AS kingdom, p_partkey AS row_id
  FROM part),
repeats AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM lineages) WHERE n > 1),
keys AS (SELECT name, family, class, "order", phylum, coalesce(kingdom, '') AS kingdom, arg_min(wd, row_id) AS wd, min(row_id) AS row_id FROM repeats GROUP BY ALL)"""


def supplier_taxa(spark, sf) -> DataFrame:
    """Taxa to be found by name: names, with ranks to compare."""
    s = table(spark, sf, "supplier")
    name = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey").cast("string")).otherwise(F.concat(F.lit("Brand#"), F.col("s_suppkey") % 5 + 1, F.col("s_nationkey") % 5 + 1, F.lit(" "), F.col("s_suppkey") % 7))
    ranks = {"family": F.when(F.col("s_suppkey") % 2 == 0, "standard"), "class": F.lit(None).cast("string"), "order": F.concat(F.lit("O"), F.col("s_suppkey") % 4), "phylum": F.concat(F.lit("p"), F.col("s_nationkey") % 3), "kingdom": F.lit("PLANTAE")}
    known = F.col("s_suppkey") % 11 == 0
    rows = s.select(F.col("s_suppkey").alias("__row"), name.alias("TaxonName"), *[c.alias(r) for r, c in ranks.items()], F.when(known, F.lit("Wikidata:Q0")).alias("Mapped_ID_WD"), F.when(known, F.lit("NAME-MATCH-YES")).otherwise("ID-NOT-FOUND").alias("Match_Status"))
    return rows


@query("name_cascade", f"""
WITH {LINEAGES},
taxa AS (
  SELECT s_suppkey AS row_no, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR ELSE 'Brand#' || (s_suppkey % 5 + 1) || (s_nationkey % 5 + 1) || ' ' || (s_suppkey % 7) END AS taxon,
         CASE WHEN s_suppkey % 2 = 0 THEN 'standard' ELSE '' END AS family, '' AS class, 'O' || (s_suppkey % 4) AS "order", 'p' || (s_nationkey % 3) AS phylum, 'PLANTAE' AS kingdom, s_suppkey % 11 = 0 AS known
  FROM supplier),
scored AS (
  SELECT row_no, keys.wd, row_number() OVER (PARTITION BY row_no ORDER BY
         CASE WHEN keys.family = taxa.family AND keys.class = taxa.class AND keys."order" = taxa."order" AND keys.phylum = taxa.phylum AND keys.kingdom = taxa.kingdom THEN 0 ELSE 1 END,
         -((keys.family <> '' AND lower(keys.family) = lower(taxa.family))::INT + (keys.class <> '' AND lower(keys.class) = lower(taxa.class))::INT + (keys."order" <> '' AND lower(keys."order") = lower(taxa."order"))::INT
           + (keys.phylum <> '' AND lower(keys.phylum) = lower(taxa.phylum))::INT + (keys.kingdom <> '' AND lower(keys.kingdom) = lower(taxa.kingdom))::INT), keys.row_id) AS place
  FROM taxa JOIN keys ON keys.name = taxa.taxon WHERE NOT known)
SELECT taxa.row_no, taxon, CASE WHEN known THEN 'Wikidata:Q0' WHEN scored.wd IS NOT NULL THEN 'Wikidata:' || scored.wd ELSE 'Wikidata:' || one.wd END AS wd,
       CASE WHEN known THEN 'NAME-MATCH-YES' WHEN scored.wd IS NOT NULL THEN 'ID-MATCHED-BY-NAME-DUPL-duplicate' WHEN one.wd IS NOT NULL THEN 'ID-MATCHED-BY-NAME-direct' ELSE 'ID-NOT-FOUND' END AS status
FROM taxa LEFT JOIN scored ON scored.row_no = taxa.row_no AND place = 1
LEFT JOIN (SELECT * FROM lineages WHERE name NOT IN (SELECT name FROM repeats)) one ON one.name = taxon""")
def name_cascade(spark, sf):
    aligned = part_lineages(spark, sf)
    out = resolve.by_name(supplier_taxa(spark, sf), aligned, lineage.ambiguous_names(aligned))
    return out.select(F.col("__row").alias("row_no"), F.col("TaxonName").alias("taxon"), F.col("Mapped_ID_WD").alias("wd"), F.col("Match_Status").alias("status"))


@query("scored_best_match", f"""
WITH {LINEAGES},
taxa AS (SELECT p_partkey, p_brand || ' ' || (p_size % 5) AS taxon, upper(split_part(p_type, ' ', 1)) AS family, '' AS class, '' AS "order", 'P' || (p_partkey % 3) AS phylum, '' AS kingdom FROM part),
scored AS (
  SELECT p_partkey, keys.*, row_number() OVER (PARTITION BY p_partkey ORDER BY -((lower(keys.family) = lower(taxa.family))::INT + (lower(keys.phylum) = lower(taxa.phylum))::INT), keys.row_id) AS place
  FROM taxa JOIN keys ON keys.name = taxa.taxon)
SELECT p_partkey, 'Wikidata:' || wd AS wd, family, class, "order", phylum, kingdom FROM scored WHERE place = 1""")
def scored_best_match(spark, sf):
    aligned = part_lineages(spark, sf).withColumn("WdID", S.short_entity(F.col("WdID")))
    empty = F.lit(None).cast("string")
    rows = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_brand", F.col("p_size") % 5).alias("taxon"), F.upper(F.element_at(F.split("p_type", " "), 1)).alias("family"), empty.alias("class"), empty.alias("order"), F.concat(F.lit("P"), F.col("p_partkey") % 3).alias("phylum"), empty.alias("kingdom"))
    return resolve.best_lineage(rows, lineage.ambiguous_names(aligned), "taxon", "p_partkey")


@query("species_match", f"""
WITH {LINEAGES},
known AS (SELECT name, arg_max(wd, row_id) FILTER (kingdom = 'Plantae') AS a, arg_max(wd, row_id) FILTER (kingdom IS NULL) AS b FROM lineages GROUP BY name),
species AS (SELECT DISTINCT p_brand || ' ' || (p_size % 7) AS species FROM part)
SELECT species, coalesce(a, b) AS wd, CASE WHEN name IS NULL THEN 'NAME-NOT-MATCHED' ELSE 'ID-MATCHED-BY-NAME-direct' END AS status, CASE WHEN a IS NOT NULL THEN 'Plantae' WHEN name IS NOT NULL THEN 'None' END AS kingdom
FROM species LEFT JOIN known ON species = name""")
def species_match(spark, sf):
    species = table(spark, sf, "part").select(F.concat_ws(" ", "p_brand", F.col("p_size") % 7).alias("TRY_AccSpeciesName"))
    out = resolve.match_species(species, part_lineages(spark, sf))
    return out.select(F.col("TRY_AccSpeciesName").alias("species"), F.col("WdID").alias("wd"), F.col("Match_Status").alias("status"), "kingdom")


# --- records ------------------------------------------------------------------------------------

#: A record per order; types come with an IRI for some, and with a name only for others.
RECORDS = """
SELECT o_orderkey AS row_id, 'C' || o_custkey AS sourceTaxonId, c_name AS sourceTaxonName, 'N' || c_nationkey AS targetTaxonId, n_name AS targetTaxonName,
       'C' || o_custkey AS source_wd, c_name AS source_name, CASE WHEN o_orderkey % 13 = 0 THEN 'C' || o_custkey ELSE 'N' || c_nationkey END AS target_wd, n_name AS target_name,
       o_orderpriority AS interactionTypeName, CASE WHEN o_orderpriority <> '5-LOW' THEN 'http://types/' || substr(o_orderpriority, 1, 1) ELSE 'no:match' END AS interactionTypeId,
       CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment ELSE '' END AS localityName, CASE WHEN o_orderkey % 4 = 0 THEN 'doi ' || o_orderstatus END AS referenceDoi, CAST(NULL AS {string}) AS sourceDOI,
       CASE WHEN o_orderkey % 5 = 0 THEN '1.5' END AS decimalLatitude, CASE WHEN o_orderkey % 5 = 0 THEN '-2' END AS decimalLongitude,
       CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment END AS sourceBodyPartName, CASE WHEN o_orderkey % 4 = 0 THEN 'UBERON:' || c_nationkey WHEN o_orderkey % 4 = 2 THEN 'HTTP' END AS sourceBodyPartId,
       n_name AS targetBodyPartName, 'http://parts/' || c_nationkey AS targetBodyPartId,
       CAST(NULL AS {string}) AS sourceLifeStageName, CAST(NULL AS {string}) AS sourceLifeStageId, CAST(NULL AS {string}) AS targetLifeStageName, CAST(NULL AS {string}) AS targetLifeStageId,
       CASE o_orderkey % 6 WHEN 0 THEN '2 males, female' WHEN 1 THEN 'male?' WHEN 2 THEN 'adult female and 3 workers' WHEN 3 THEN 'male,' END AS sourceSexName, CAST(NULL AS {string}) AS targetSexName
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
RECORDS_SQL = RECORDS.format(string="VARCHAR")


def order_records(spark, sf) -> DataFrame:
    text = RECORDS.format(string="STRING")
    for name in ("orders", "customer", "nation"):
        table(spark, sf, name).createOrReplaceTempView(f"taxograph_{name}")
        text = text.replace(f"FROM {name} ", f"FROM taxograph_{name} {name} ").replace(f"JOIN {name} ", f"JOIN taxograph_{name} {name} ")
    return spark.sql(text)


SEXES = [("male", "obo:male"), ("female", "obo:female"), ("unknown", "obo:unknown")]


def sex_terms(spark) -> DataFrame:
    return spark.createDataFrame(SEXES, "key string, value string")


def order_triples(spark, sf) -> DataFrame:
    return order_graph(spark, sf).as_set()


def order_graph(spark, sf, spelled=list) -> triples.Graph:
    """The same graph in parts, triples stated as often as they are emitted."""
    return triples.interaction_graph(resolve.kept_records(order_records(spark, sf)), sex_terms(spark), spelled=spelled)


def loaded(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The triple table as it is queried: written once, a folder per predicate."""
    path = f"{shared_dir(spark)}/triples-{uuid.uuid4().hex}"
    sinks.write_triples(df, path)
    return sinks.read_triples(spark, path)


def stored(spark: SparkSession, df: DataFrame | triples.Graph) -> store.Store:
    """The triples as a store of numbers."""
    return store.write_store(df, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")


@query("id_then_name", """
WITH ids AS (SELECT CASE WHEN s_acctbal < 5000 THEN 'S' ELSE 'X' END || s_suppkey AS key, 'Q' || s_suppkey AS wd, s_name AS name FROM supplier),
names AS (SELECT p_brand AS key, 'B' || max(p_partkey) AS wd FROM part GROUP BY p_brand),
rows AS (SELECT DISTINCT l_suppkey, l_partkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_suppkey, l_partkey, coalesce(ids.wd, CASE WHEN l_suppkey % 3 = 0 THEN names.wd END) AS source_wd, names.wd AS target_wd
FROM rows LEFT JOIN ids ON ids.key = 'S' || l_suppkey LEFT JOIN names ON names.key = p_brand
WHERE coalesce(ids.wd, CASE WHEN l_suppkey % 3 = 0 THEN names.wd END) <> names.wd""")
def id_then_name(spark, sf):
    ids = table(spark, sf, "supplier").select(F.concat(F.when(F.col("s_acctbal") < 5000, "S").otherwise("X"), F.col("s_suppkey")).alias("key"), F.concat(F.lit("Q"), F.col("s_suppkey")).alias("wd"), F.col("s_name").alias("name"))
    names = table(spark, sf, "part").groupBy(F.col("p_brand").alias("key")).agg(F.concat(F.lit("B"), F.max("p_partkey")).alias("wd"), F.max("p_name").alias("name"))
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey")).select("l_suppkey", "l_partkey", "p_brand").distinct()
    records = rows.select("l_suppkey", "l_partkey", F.concat(F.lit("S"), F.col("l_suppkey")).alias("sourceTaxonId"), F.when(F.col("l_suppkey") % 3 == 0, F.col("p_brand")).alias("sourceTaxonName"), F.lit(None).cast("string").alias("targetTaxonId"), F.col("p_brand").alias("targetTaxonName"))
    return resolve.kept_records(resolve.resolve_sides(records, ids, names)).select("l_suppkey", "l_partkey", "source_wd", "target_wd")


#: Customers in debt answer to another name, so that some orders find no one.
DEBTORS = "CASE WHEN c_acctbal < 0 THEN 'X' ELSE 'C' END || c_custkey"


@query("species_left_join", f"SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN (SELECT {DEBTORS} AS name, c_mktsegment FROM customer) ON name = 'C' || o_custkey")
def species_left_join(spark, sf):
    known = table(spark, sf, "customer").select(F.expr(DEBTORS).alias("TRY_AccSpeciesName"), F.col("c_mktsegment").alias("WdID"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey")).alias("AccSpeciesName"))
    return triples.with_species(rows, known).select("o_orderkey", F.col("WdID").alias("c_mktsegment"))


@query("semi_filter", f"SELECT o_orderkey, c_mktsegment FROM orders JOIN (SELECT {DEBTORS} AS name, c_mktsegment FROM customer) ON name = 'C' || o_custkey WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 9900)")
def semi_filter(spark, sf):
    known = table(spark, sf, "customer").select(F.expr(DEBTORS).alias("TRY_AccSpeciesName"), F.col("c_mktsegment").alias("WdID"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey")).alias("AccSpeciesName"))
    samples = table(spark, sf, "customer").filter("c_acctbal > 9900").select(F.col("c_mktsegment").alias("wd_taxon_id"))
    return triples.with_species(rows, known, samples).select("o_orderkey", F.col("WdID").alias("c_mktsegment"))


# --- scalar functions ---------------------------------------------------------------------------

RAW_IDS = "CASE page_id % 6 WHEN 0 THEN 'https://www.wikidata.org/wiki/Q' || page_id WHEN 1 THEN 'urn:lsid:irmng.org:taxname:' || page_id WHEN 2 THEN 'tsn:' || page_id WHEN 3 THEN 'gbif: +' || page_id WHEN 4 THEN 'https://www.inaturalist.org/taxa/' || page_id ELSE url END"


@query("id_normalise", f"""
SELECT page_id, replace(regexp_replace(regexp_replace(replace(replace(replace({RAW_IDS}, 'https://www.wikidata.org/wiki/', 'Wikidata:'), 'urn:lsid:irmng.org:taxname', 'IRMNG'), 'https://www.inaturalist.org/taxa/', 'INAT_TAXON:'), '^tsn', 'ITIS'), 'gbif: \\+', 'GBIF:', 'g'), 'gbif:', 'GBIF:') AS id,
       replace('http://www.wikidata.org/entity/Q' || page_id, 'http://www.wikidata.org/entity/', 'Wikidata:') AS entity
FROM pages""")
def id_normalise(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.normalise_id(F.expr(RAW_IDS)).alias("id"), S.short_entity(F.concat(F.lit(V.WD + "Q"), F.col("page_id"))).alias("entity"))


@query("rank_zip", """
WITH paths AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'kingdom | phylum|family' WHEN 1 THEN 'kingdom|phylum' WHEN 2 THEN 'kingdom | x | kingdom' END AS ranks, r_name || ' | ' || n_name || '|' || n_nationkey AS names FROM nation JOIN region ON r_regionkey = n_regionkey)
SELECT n_nationkey, CASE WHEN ranks IS NULL THEN NULL WHEN n_nationkey % 4 = 2 THEN trim(split_part(names, '|', 3)) ELSE trim(split_part(names, '|', 1)) END AS kingdom,
       CASE WHEN ranks IS NULL THEN NULL WHEN n_nationkey % 4 = 2 THEN '' ELSE trim(split_part(names, '|', 2)) END AS phylum,
       CASE WHEN ranks IS NULL THEN NULL WHEN n_nationkey % 4 = 0 THEN trim(split_part(names, '|', 3)) ELSE '' END AS family
FROM paths""")
def rank_zip(spark, sf):
    ranks = F.expr("CASE n_nationkey % 4 WHEN 0 THEN 'kingdom | phylum|family' WHEN 1 THEN 'kingdom|phylum' WHEN 2 THEN 'kingdom | x | kingdom' END")
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    out = rows.select("n_nationkey", S.ranks_of(F.expr("r_name || ' | ' || n_name || '|' || n_nationkey"), ranks).alias("r"))
    return out.select("n_nationkey", "r.kingdom", "r.phylum", "r.family")


@query("iri_encode", f"SELECT page_id, '{V.EMI_BOX}PAGE-' || url_encode(url) AS iri FROM pages")
def iri_encode(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.concat(F.lit(V.EMI_BOX + "PAGE-"), S.encode_iri(F.col("url"))).alias("iri"))


NUMBERS = "CASE event_id % 6 WHEN 0 THEN '12' WHEN 1 THEN '-1.5E+3' WHEN 2 THEN '1.5e3' WHEN 3 THEN '.5' WHEN 4 THEN event_type ELSE ' 7.25 ' END"


@query("numeric_literal", f"SELECT event_id, regexp_full_match({NUMBERS}, '-?[0-9]+(\\.[0-9]+)?(E[+-][0-9]+)?') AS is_number, TRY_CAST(trim({NUMBERS}) AS DOUBLE) AS number FROM events")
def numeric_literal(spark, sf):
    return table(spark, sf, "events").select("event_id", S.is_numeric_literal(F.expr(NUMBERS)).alias("is_number"), S.to_number(F.expr(NUMBERS)).alias("number"))


FREE = "CASE p_partkey % 5 WHEN 0 THEN p_name || ' and 2 females' WHEN 1 THEN '3 Males; ' || p_brand || ',' WHEN 2 THEN 'adult male or female (?)' WHEN 3 THEN p_type || ' y monos/autos' ELSE '?' END"
TOKENS = f"""
tokens AS (
  SELECT p_partkey, unnest(string_split_regex(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(lower({FREE})), '\\b(and|y)\\b', ',', 'g'), '\\bor\\b', '', 'g'), '[,;/|&]+', ',', 'g'), '[\\[\\]()?#:`]+', ' ', 'g'), '\\s\\s', ' ', 'g'), '[+.,]+')) AS token FROM part)"""
COUNTED = f"""{TOKENS},
matched AS (SELECT p_partkey, token, regexp_extract_all(token, '(\\d+)\\s*([\\w-]+)|([\\w-]+)\\s*(\\d+)', 0) AS found FROM tokens),
words AS (
  SELECT p_partkey, CASE WHEN regexp_matches(m, '^\\d+\\s*[\\w-]') THEN regexp_extract(m, '^(\\d+)\\s*([\\w-]+)', 1) ELSE regexp_extract(m, '([\\w-]+)\\s*(\\d+)$', 2) END::BIGINT AS n,
         CASE WHEN regexp_matches(m, '^\\d+\\s*[\\w-]') THEN regexp_extract(m, '^(\\d+)\\s*([\\w-]+)', 2) ELSE regexp_extract(m, '([\\w-]+)\\s*(\\d+)$', 1) END AS word
  FROM (SELECT p_partkey, unnest(found) AS m FROM matched)
  UNION ALL SELECT p_partkey, 1, token FROM matched WHERE len(found) = 0),
terms AS (SELECT p_partkey, n, CASE WHEN contains(w, 'mono') OR contains(w, 'auto') THEN w ELSE regexp_replace(w, 's$', '') END AS term FROM (SELECT *, trim(lower(word)) AS w FROM words))"""


@query("term_tokenise", f"WITH {TOKENS} SELECT p_partkey, token FROM tokens")
def term_tokenise(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.explode(S.tokenise(F.expr(FREE))).alias("token"))


@query("count_words", f"WITH {COUNTED} SELECT p_partkey, term, n FROM terms")
def count_words(spark, sf):
    return terms.exploded_terms(table(spark, sf, "part").withColumn("t", F.expr(FREE)), "t", ["p_partkey"]).select("p_partkey", "term", F.col("count").alias("n"))


@query("count_terms", f"""
WITH {COUNTED},
sexes(key, iri) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in SEXES)})
SELECT p_partkey, coalesce(a.iri, b.iri, 'obo:unknown') AS iri, sum(n)::BIGINT AS n
FROM (SELECT *, regexp_replace(trim(regexp_replace(term, '(?i)adult[as]?|tortere|juvenil[e]?|maybe', '', 'g')), 's$', '') AS bare FROM terms) LEFT JOIN sexes a ON a.key = term LEFT JOIN sexes b ON b.key = bare
GROUP BY ALL HAVING sum(n) <> 0""")
def count_terms(spark, sf):
    return terms.count_terms(table(spark, sf, "part").withColumn("t", F.expr(FREE)), "t", ["p_partkey"], sex_terms(spark))


@query("term_lookup", """
WITH maps AS (SELECT lower(r_name) AS key, r_name AS name, CASE WHEN r_regionkey % 2 = 0 THEN 'http://regions/' || r_regionkey ELSE 'https://w3id.org/emi/abox#' || url_encode(r_name) END AS iri FROM region)
SELECT c_custkey, maps.iri AS entity_iri, maps.name AS entity_name
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(r_name) WHEN 1 THEN lower(r_name) ELSE 'nowhere' END AS term FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey) LEFT JOIN maps ON key = term""")
def term_lookup(spark, sf):
    maps = table(spark, sf, "region").select(F.col("r_name").alias("input"), F.col("r_name").alias("match"), F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("http://regions/"), F.col("r_regionkey"))).alias("uri"), F.col("r_regionkey").alias("row_id"))
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    term = F.when(F.col("c_custkey") % 3 == 0, F.col("r_name")).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" Adult "), F.col("r_name"), F.lit("s "))).otherwise("nowhere")
    return terms.lookup_terms(rows.select("c_custkey", term.alias("t")), "t", terms.entity_map(maps)).select("c_custkey", "entity_iri", "entity_name")


@query("curie_expand", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'http://purl.obolibrary.org/obo/UBERON_' || p_partkey WHEN 1 THEN 'http://purl.obolibrary.org/obo/FBdv_' || p_brand WHEN 2 THEN 'http://x/' || p_partkey END AS iri FROM part""")
def curie_expand(spark, sf):
    own = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'UBERON:' || p_partkey WHEN 1 THEN 'FBdv:' || p_brand WHEN 2 THEN 'http://x/' || p_partkey ELSE 'fbdv:' || p_partkey END")
    return table(spark, sf, "part").select("p_partkey", S.expand_curie(own).alias("iri"))


UNITS = ("m2/g", "mg", "d/y", "zz")


@query("unit_cascade", """
WITH qudt(key, value) AS (VALUES ('m2/g', 'M2-PER-GM'), ('mg', 'MilliGM')), emi(key, value) AS (VALUES ('d/y', 'https://u#d'), ('zz', 'https://u#z')),
rows AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'm2/g' WHEN 1 THEN 'd/y' WHEN 2 THEN '' WHEN 3 THEN 'zz' ELSE 'other' END AS unit, CASE p_size % 4 WHEN 0 THEN 'mg' WHEN 1 THEN 'd/y' WHEN 2 THEN '\\N' END AS name FROM part)
SELECT p_partkey, CASE WHEN unit = '' THEN NULL WHEN q1.value IS NOT NULL THEN 'http://qudt.org/vocab/unit/' || q1.value
                       WHEN name IS NOT NULL AND name <> '\\N' THEN coalesce('http://qudt.org/vocab/unit/' || q2.value, e2.value) ELSE e1.value END AS unit_iri
FROM rows LEFT JOIN qudt q1 ON q1.key = unit LEFT JOIN qudt q2 ON q2.key = name LEFT JOIN emi e1 ON e1.key = unit LEFT JOIN emi e2 ON e2.key = name""")
def unit_cascade(spark, sf):
    qudt, emi = {"m2/g": "M2-PER-GM", "mg": "MilliGM"}, {"d/y": "https://u#d", "zz": "https://u#z"}
    unit = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'm2/g' WHEN 1 THEN 'd/y' WHEN 2 THEN '' WHEN 3 THEN 'zz' ELSE 'other' END")
    name = F.expr("CASE p_size % 4 WHEN 0 THEN 'mg' WHEN 1 THEN 'd/y' WHEN 2 THEN '\\\\N' END")
    return table(spark, sf, "part").select("p_partkey", S.unit_iri(unit, name, S.lookup(qudt, unit), S.lookup(qudt, name), S.lookup(emi, unit), S.lookup(emi, name)).alias("unit_iri"))


# --- triples and graph queries ------------------------------------------------------------------

_T = lambda s, p, o, kind="iri", dtype="NULL": f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, {dtype} AS o_dtype FROM kept"
_STR = f"'{V.XSD}string'"


def _record_triples_sql() -> str:
    """The graph of the order records in SQL, sexes included, before inverses."""
    lit = lambda s, p, o, where: _T(s, p, o, "literal", _STR) + f" WHERE {where}"
    parts = [
        _T("rec", V.RDF + "type", f"'{V.EMI}Interaction'"),
        _T("rec", V.EMI + "isClassifiedWith", "type_iri"),
        lit("rec", V.PROV + "atLocation", "localityName", "localityName <> ''"),
        lit("rec", V.DCTERMS + "bibliographicCitation", "referenceDoi", "referenceDoi IS NOT NULL"),
        lit("rec", V.WGS84 + "lat", "decimalLatitude", "decimalLatitude IS NOT NULL"),
        lit("rec", V.WGS84 + "long", "decimalLongitude", "decimalLongitude IS NOT NULL"),
        f"SELECT DISTINCT type_iri, '{V.RDF}type', '{V.EMI}InteractionType', 'iri', NULL FROM kept",
        f"SELECT type_iri, '{V.RDFS}label', arg_min(interactionTypeName, row_id), 'literal', {_STR} FROM kept WHERE interactionTypeId LIKE 'http%' GROUP BY type_iri",
    ]
    for side, link in (("source", "hasSource"), ("target", "hasTarget")):
        sample = f"{side}_sample"
        parts += [
            _T("rec", V.EMI + link, sample),
            _T(sample, V.RDF + "type", f"'{V.SOSA}Sample'"),
            lit(sample, V.RDFS + "label", f"{side}_name", "true"),
            _T(sample, V.SOSA + "isSampleOf", f"'{V.EMI_BOX}ORGANISM-' || url_encode({side}_name)"),
            _T(sample, V.EMI + "inTaxon", f"'{V.WD}' || {side}_wd"),
        ]
    parts += [
        f"SELECT sample, '{V.EMI}hasAnatomicalEntity', iri, 'iri', NULL FROM body",
        f"SELECT DISTINCT iri, '{V.RDF}type', '{V.EMI}AnatomicalEntity', 'iri', NULL FROM body",
        f"SELECT iri, '{V.RDFS}label', arg_min(label, row_id), 'literal', {_STR} FROM body GROUP BY iri",
        f"SELECT sample, '{V.EMI}hasSex', node, 'bnode', NULL FROM sexes",
        f"SELECT node, '{V.QUDT_INTERACTIONS}quantityKind', iri, 'iri', NULL FROM sexes",
        f"SELECT node, '{V.QUDT_INTERACTIONS}numericValue', n::VARCHAR, 'literal', '{V.XSD}integer' FROM sexes",
        f"SELECT DISTINCT iri, '{V.RDF}type', '{V.EMI}BiologicalSex', 'iri', NULL FROM sexes",
    ]
    return f"""
records AS ({RECORDS_SQL}),
kept AS (
  SELECT *, '{V.EMI_BOX}inRec' || row_id AS rec, '{V.EMI_BOX}SAMPLE-' || source_wd || '-inRec' || row_id AS source_sample, '{V.EMI_BOX}SAMPLE-' || target_wd || '-inRec' || row_id AS target_sample,
         CASE WHEN interactionTypeId LIKE 'http%' THEN interactionTypeId ELSE '{V.EMI_BOX}' || url_encode(interactionTypeName) END AS type_iri
  FROM records WHERE source_wd <> target_wd),
body AS (
  SELECT source_sample AS sample, row_id, '{V.OBO}UBERON_' || substr(sourceBodyPartId, 8) AS iri, sourceBodyPartName AS label FROM kept WHERE sourceBodyPartId LIKE 'UBERON:%'
  UNION ALL SELECT target_sample, row_id, targetBodyPartId, targetBodyPartName FROM kept),
counts(k, iri, n) AS (VALUES (0, 'obo:male', 2), (0, 'obo:female', 1), (1, 'obo:male', 1), (2, 'obo:female', 1), (2, 'obo:unknown', 3), (3, 'obo:male', 1), (3, 'obo:unknown', 1)),
sexes AS (SELECT source_sample AS sample, row_id, counts.iri, n, '_:b' || substr(sha256(source_sample || chr(10) || counts.iri), 1, 32) AS node FROM kept JOIN counts ON k = row_id % 6),
stated AS ({' UNION ALL '.join(parts)}),
inverses(p, q) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in V.INVERSE.items())}),
triples AS (SELECT * FROM stated UNION SELECT o, q, s, 'iri', NULL FROM stated JOIN inverses USING (p) WHERE o_kind = 'iri')"""


RECORD_TRIPLES = _record_triples_sql()


@query("emit_triples", f"WITH {RECORD_TRIPLES} SELECT s, p, o, o_kind, o_dtype FROM triples")
def emit_triples(spark, sf):
    return order_triples(spark, sf).select("s", "p", "o", "o_kind", "o_dtype")


@query("graph_counters", f"WITH {RECORD_TRIPLES} SELECT count(*) FILTER (p = '{V.RDF}type' AND o = '{V.EMI}Interaction') AS records, count(*) AS triples FROM triples")
def graph_counters(spark, sf):
    return triples.counters(order_triples(spark, sf))


@query("inverse_triples", f"WITH {RECORD_TRIPLES} SELECT o AS s, q AS p, s AS o FROM (SELECT DISTINCT * FROM stated) JOIN inverses USING (p) WHERE o_kind = 'iri'")
def inverse_triples(spark, sf):
    stated = order_triples(spark, sf).filter(~F.col("p").isin(V.SOSA + "hasSample"))
    return triples.inverse(stated).select("s", "p", "o")


@query("bgp_record_count", f"""
WITH {RECORD_TRIPLES}, labelled AS (SELECT s, count(*) AS n FROM triples WHERE p = '{V.RDFS}label' GROUP BY s)
SELECT sum(l.n)::BIGINT AS n_records FROM triples c JOIN labelled l ON l.s = c.o WHERE c.p = '{V.EMI}isClassifiedWith'""")
def bgp_record_count(spark, sf):
    return graph.record_count(stored(spark, order_graph(spark, sf)))


TAXA_SQL = f"""
WITH {RECORD_TRIPLES}
SELECT count(DISTINCT t.o) AS n_taxa FROM triples c JOIN triples l ON l.s = c.o AND l.p = '{V.RDFS}label' JOIN triples h ON h.s = c.s AND h.p IN ('{V.EMI}hasSource', '{V.EMI}hasTarget')
JOIN triples t ON t.s = h.o AND t.p = '{V.EMI}inTaxon' WHERE c.p = '{V.EMI}isClassifiedWith'"""


@query("bgp_distinct_taxa", TAXA_SQL)
def bgp_distinct_taxa(spark, sf):
    return graph.distinct_taxa(stored(spark, order_graph(spark, sf)))


@query("sparql_union", TAXA_SQL)
def sparql_union(spark, sf):
    return sparql.sparql(stored(spark, order_graph(spark, sf)), """
        PREFIX emi: <https://w3id.org/emi#>
        PREFIX rdfs: <http://www.w3.org/2000/01/rdf-schema#>
        SELECT (COUNT(DISTINCT ?wdx) AS ?n_taxa) WHERE {
          ?intxn emi:hasSource ?source ; emi:hasTarget ?target ; emi:isClassifiedWith ?type .
          ?type rdfs:label ?label .
          { ?source emi:inTaxon ?wdx } UNION { ?target emi:inTaxon ?wdx }
        }""")


@query("sparql_group", f"WITH {RECORD_TRIPLES} SELECT o AS type, count(*) AS n FROM triples WHERE p = '{V.EMI}isClassifiedWith' GROUP BY o ORDER BY n DESC, o LIMIT 3")
def sparql_group(spark, sf):
    return sparql.sparql(stored(spark, order_graph(spark, sf)), "SELECT ?type (COUNT(?r) AS ?n) WHERE { ?r a emi:Interaction ; emi:isClassifiedWith ?type } GROUP BY ?type ORDER BY DESC(?n) ?type LIMIT 3")


#: A trait record per part.
TRAITS = """
SELECT p_partkey AS row_id, CASE WHEN p_partkey % 17 <> 0 THEN p_brand END AS AccSpeciesName, '7' || p_size AS AccSpeciesID, CAST(p_partkey AS {string}) AS ObservationID, 'd' || p_partkey AS ObsDataID,
       CASE WHEN p_partkey % 5 <> 0 THEN 'set ' || (p_size % 3) END AS Dataset, CAST(p_size % 3 AS {string}) AS DatasetID, CASE WHEN p_size % 3 <> 1 THEN 'ref' END AS Reference,
       CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS TraitName, CAST(p_size AS {string}) AS TraitID, p_name AS DataName, 'x y' AS DataID,
       CASE p_partkey % 4 WHEN 0 THEN '12.5' WHEN 1 THEN '1e3' WHEN 2 THEN p_brand ELSE '' END AS OrigValueStr, CASE p_partkey % 3 WHEN 0 THEN ' m2/g' WHEN 1 THEN 'd/y' END AS OrigUnitStr, CAST(NULL AS {string}) AS UnitName
FROM part"""


def part_triples(spark, sf) -> DataFrame:
    table(spark, sf, "part").createOrReplaceTempView("taxograph_part")
    records = spark.sql(TRAITS.format(string="STRING").replace("FROM part", "FROM taxograph_part part"))
    species = table(spark, sf, "part").filter("p_size < 40").groupBy(F.col("p_brand").alias("TRY_AccSpeciesName")).agg(F.concat(F.lit("Q"), F.min("p_partkey")).alias("WdID"))
    qudt = spark.createDataFrame([(" m2/g", "M2-PER-GM")], "key string, value string")
    emi = spark.createDataFrame([("d/y", "https://u#d")], "key string, value string")
    return triples.trait_triples(records, species, qudt, emi)


def _trait_triples_sql() -> str:
    lit = lambda s, p, o, where: _T(s, p, o, "literal", _STR) + f" WHERE {where}"
    when = lambda sql, where: f"{sql} WHERE {where}"
    has = "Dataset IS NOT NULL"
    parts = [
        _T("sample", V.RDF + "type", f"'{V.SOSA}Sample'"), lit("sample", V.RDFS + "label", "AccSpeciesName", "true"),
        _T("sample", V.SOSA + "isSampleOf", "organism"), _T("sample", V.SOSA + "isFeatureOfInterestOf", "observation"),
        when(_T("sample", V.DCTERMS + "isPartOf", "set_iri"), has), lit("set_iri", V.DCTERMS + "bibliographicCitation", "Reference", f"{has} AND Reference IS NOT NULL"),
        lit("set_iri", V.DCTERMS + "identifier", "'TRYdb-' || DatasetID", has), when(_T("observation", V.SOSA + "hasResult", "result"), has),
        when(_T("result", V.RDF + "type", f"'{V.EMI}Trait'"), f"{has} AND TraitName IS NOT NULL"), lit(f"'{V.EMI}Trait'", V.DCTERMS + "identifier", "'TRYdb-' || TraitID", f"{has} AND TraitName IS NOT NULL"),
        when(_T("result", V.RDF + "type", f"'{V.EMI}NonTrait'"), f"{has} AND TraitName IS NULL"),
        when(_T("result", V.RDF + "value", "OrigValueStr", "literal", f"CASE WHEN TraitName IS NOT NULL AND OrigValueStr = '12.5' THEN '{V.XSD}double' ELSE {_STR} END"), f"{has} AND OrigValueStr <> ''"),
        lit("result", V.RDFS + "label", "DataName", has), lit("result", V.DCTERMS + "identifier", "'TRYdb-x%20y'", has),
        when(_T("result", V.QUDT_TRAITS + "hasUnit", f"CASE row_id % 3 WHEN 0 THEN '{V.QUDT_UNIT}M2-PER-GM' ELSE 'https://u#d' END"), f"{has} AND OrigUnitStr IS NOT NULL"),
        lit("result", V.RDFS + "comment", "trim(OrigUnitStr)", f"{has} AND OrigUnitStr IS NOT NULL"),
        when(_T("organism", V.EMI + "inTaxon", f"'{V.WD}' || wd"), "wd IS NOT NULL"), lit("organism", V.DCTERMS + "identifier", "'TRYdb-' || AccSpeciesID", "true"),
    ]
    return f"""
records AS ({TRAITS.format(string='VARCHAR')}),
kept AS (
  SELECT records.*, wd, '{V.EMI_BOX}SAMPLE-' || url_encode(AccSpeciesName) || '-' || ObservationID AS sample, '{V.EMI_BOX}ORGANISM-' || url_encode(AccSpeciesName) AS organism,
         '{V.EMI_BOX}OBSERVATION-' || ObservationID AS observation, '{V.EMI_BOX}DATASET-' || url_encode(Dataset) AS set_iri, '{V.EMI_BOX}RESULT-' || ObsDataID AS result
  FROM records LEFT JOIN (SELECT p_brand, 'Q' || min(p_partkey) AS wd FROM part WHERE p_size < 40 GROUP BY p_brand) ON p_brand = AccSpeciesName WHERE AccSpeciesName IS NOT NULL),
stated AS ({' UNION ALL '.join(parts)}),
inverses(p, q) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in V.INVERSE.items())}),
triples AS (SELECT * FROM stated UNION SELECT o, q, s, 'iri', NULL FROM stated JOIN inverses USING (p) WHERE o_kind = 'iri')"""


TRAIT_TRIPLES = _trait_triples_sql()


@query("trait_triples", f"WITH {TRAIT_TRIPLES} SELECT s, p, o, o_kind, o_dtype FROM triples")
def trait_triples(spark, sf):
    return part_triples(spark, sf).select("s", "p", "o", "o_kind", "o_dtype")


TYPE_COUNTS = f"""
WITH {TRAIT_TRIPLES},
base AS (SELECT t.s AS organism, r.o AS data FROM triples t JOIN triples m ON m.o = t.s AND m.p = '{V.SOSA}isSampleOf' JOIN triples f ON f.s = m.s AND f.p = '{V.SOSA}isFeatureOfInterestOf'
  JOIN triples r ON r.s = f.o AND r.p = '{V.SOSA}hasResult' JOIN triples l ON l.s = r.o AND l.p = '{V.RDFS}label' JOIN triples v ON v.s = r.o AND v.p = '{V.RDF}value' WHERE t.p = '{V.EMI}inTaxon'),
kinds AS (SELECT s, o FROM triples WHERE p = '{V.RDF}type')
SELECT count(DISTINCT organism) AS n_species, count(DISTINCT a.s) AS n_traits, count(DISTINCT b.s) AS n_other
FROM base LEFT JOIN kinds a ON a.s = data AND a.o = '{V.EMI}Trait' LEFT JOIN kinds b ON b.s = data AND b.o = '{V.EMI}NonTrait'"""


@query("optional_type_counts", TYPE_COUNTS)
def optional_type_counts(spark, sf):
    return graph.type_counts(stored(spark, part_triples(spark, sf)))


@query("sparql_optional", TYPE_COUNTS)
def sparql_optional(spark, sf):
    return sparql.sparql(stored(spark, part_triples(spark, sf)), """
        SELECT (COUNT(DISTINCT ?name) AS ?n_species) (COUNT(DISTINCT ?trait) AS ?n_traits) (COUNT(DISTINCT ?other) AS ?n_other) WHERE {
          ?name emi:inTaxon ?wdx .
          ?obs sosa:isSampleOf ?name ; sosa:isFeatureOfInterestOf ?id .
          ?id sosa:hasResult ?data .
          ?data rdfs:label ?label ; rdf:value ?value .
          OPTIONAL { ?data rdf:type emi:Trait . BIND(?data AS ?trait) }
          OPTIONAL { ?data rdf:type emi:NonTrait . BIND(?data AS ?other) }
        }""")


#: Customers with a name by market segment, by nation or both, as literals of two predicates; some have neither.
NAMED_TWICE = """
SELECT 'http://c/' || c_custkey AS s, 'http://p/in' AS p, 'http://n/' || c_nationkey AS o, 'iri' AS o_kind, CAST(NULL AS {string}) AS o_dtype FROM customer
UNION ALL SELECT 'http://c/' || c_custkey, 'http://p/first', c_mktsegment, 'literal', 'http://s' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'http://c/' || c_custkey, 'http://p/second', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END, 'literal', 'http://s' FROM customer WHERE c_custkey % 4 < 3
UNION ALL SELECT 'http://n/' || n_nationkey, 'http://p/label', CASE WHEN n_nationkey % 5 = 0 THEN 'BUILDING' ELSE n_name END, 'literal', 'http://s' FROM nation"""


def named_twice(spark, sf) -> DataFrame:
    for name in ("customer", "nation"):
        table(spark, sf, name).createOrReplaceTempView(f"taxograph_{name}")
    return spark.sql(NAMED_TWICE.format(string="STRING").replace("FROM customer", "FROM taxograph_customer").replace("FROM nation", "FROM taxograph_nation"))


SHARED_OPTIONAL = """SELECT ?c ?v WHERE { ?c <http://p/in> ?n . OPTIONAL { ?c <http://p/first> ?v } OPTIONAL { ?c <http://p/second> ?v } }"""
SHARED_OPTIONAL_SQL = f"""
WITH t AS ({NAMED_TWICE.format(string='VARCHAR')}), c AS (SELECT s FROM t WHERE p = 'http://p/in'), a AS (SELECT s, o FROM t WHERE p = 'http://p/first'), b AS (SELECT s, o FROM t WHERE p = 'http://p/second')
SELECT c.s AS c, coalesce(a.o, b.o) AS v FROM c LEFT JOIN a ON a.s = c.s LEFT JOIN b ON b.s = c.s AND (a.o IS NULL OR a.o = b.o)"""


@query("sparql_shared_optional", SHARED_OPTIONAL_SQL)
def sparql_shared_optional(spark, sf):
    return sparql.sparql(loaded(spark, named_twice(spark, sf)), SHARED_OPTIONAL)


@query("store_shared_optional", SHARED_OPTIONAL_SQL)
def store_shared_optional(spark, sf):
    return sparql.sparql(stored(spark, named_twice(spark, sf)), SHARED_OPTIONAL)


@query("sparql_filtered_optional", f"""
WITH t AS ({NAMED_TWICE.format(string='VARCHAR')})
SELECT i.s AS c, l.o AS label, f.o AS v FROM t i JOIN t l ON l.s = i.o AND l.p = 'http://p/label' LEFT JOIN t f ON f.s = i.s AND f.p = 'http://p/first' AND l.o = 'BUILDING' AND f.o <> l.o WHERE i.p = 'http://p/in'""")
def sparql_filtered_optional(spark, sf):
    return sparql.sparql(stored(spark, named_twice(spark, sf)), """
        SELECT ?c ?label ?v WHERE { ?c <http://p/in> ?n . ?n <http://p/label> ?label . OPTIONAL { ?c <http://p/first> ?v FILTER(?label = "BUILDING") FILTER(?v != ?label) } }""")


@query("store_predicates", f"WITH {RECORD_TRIPLES} SELECT p AS name, count(DISTINCT s || chr(10) || o_kind || chr(10) || o || coalesce(o_dtype, '')) AS triples FROM triples GROUP BY p")
def store_predicates(spark, sf):
    return stored(spark, order_graph(spark, sf)).predicates.select("name", "triples")


@query("ancestor_closure", """
WITH RECURSIVE up AS (SELECT p_partkey AS node, p_partkey AS ancestor FROM part UNION SELECT node, ancestor // 2 FROM up WHERE ancestor // 2 >= (SELECT min(p_partkey) FROM part) AND ancestor // 2 > 0)
SELECT node, ancestor FROM up""")
def ancestor_closure(spark, sf):
    parts = table(spark, sf, "part")
    edges = parts.select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent")).filter("parent > 0")
    edges = edges.join(parts.select(F.col("p_partkey").alias("parent")), "parent", "left_semi")
    closed = lineage.ancestor_closure(edges)
    alone = parts.select(F.col("p_partkey").alias("node")).join(closed.select("node").distinct(), "node", "left_anti")
    return closed.unionByName(alone.select("node", F.col("node").alias("ancestor")))


def _iri_sql(c: str) -> str:
    """An IRI as a Turtle term: by the longest prefix that leaves a plain local part."""
    cases = [f"WHEN starts_with({c}, '{b}') AND regexp_full_match(substr({c}, {len(b) + 1}), '[A-Za-z_][A-Za-z0-9_-]*') THEN '{n}:' || substr({c}, {len(b) + 1})" for n, b in sorted(V.PREFIXES.items(), key=lambda x: -len(x[1]))]
    return f"CASE {' '.join(cases)} ELSE '<' || regexp_replace({c}, '[\\x00-\\x20<>\"{{}}|^`\\\\]', '_', 'g') || '>' END"


_TEXT_SQL = "replace(replace(replace(replace(replace(o, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"


@query("turtle_lines", f"""
WITH {RECORD_TRIPLES}
SELECT DISTINCT (CASE WHEN starts_with(s, '_:') THEN s ELSE {_iri_sql('s')} END) || ' ' || (CASE WHEN p = '{V.RDF}type' THEN 'a' ELSE {_iri_sql('p')} END) || ' ' ||
       (CASE o_kind WHEN 'literal' THEN chr(34) || {_TEXT_SQL} || chr(34) || (CASE WHEN o_dtype IS NOT NULL AND o_dtype <> '{V.XSD}string' THEN '^^' || {_iri_sql('o_dtype')} ELSE '' END) WHEN 'bnode' THEN o ELSE {_iri_sql('o')} END) || ' .' AS value
FROM triples""")
def turtle_lines(spark, sf):
    return sinks.spelled_lines(order_graph(spark, sf, sinks.spelled))


# --- analytics ----------------------------------------------------------------------------------


@query("topk_values", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 3")
def topk_values(spark, sf):
    return analytics.value_counts(table(spark, sf, "orders"), "o_orderpriority", 3)


@query("nunique_by_group", "SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type")
def nunique_by_group(spark, sf):
    return analytics.distinct_per_group(table(spark, sf, "events"), "event_type", "user_id")


@query("group_summary", "SELECT event_type, count(*) AS n_records, count(DISTINCT user_id) AS n_values FROM events GROUP BY event_type")
def group_summary(spark, sf):
    return analytics.summary(table(spark, sf, "events"), "event_type", "user_id")


CROSSTAB = """
WITH brands AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5), sizes AS (SELECT p_size, row_number() OVER (ORDER BY count(*) DESC, p_size) AS place FROM part GROUP BY p_size)
SELECT p_brand, {cells} FROM part JOIN sizes USING (p_size) WHERE p_brand IN (SELECT p_brand FROM brands) GROUP BY p_brand"""


def _crosstab(spark, sf, presence):
    out = analytics.crosstab_top(table(spark, sf, "part"), "p_brand", "p_size", 5, 4, presence)
    return out.toDF("p_brand", *[f"c{k}" for k in range(1, len(out.columns))])


@query("crosstab_topk", CROSSTAB.format(cells=", ".join(f"count(*) FILTER (place = {k}) AS c{k}" for k in range(1, 5))))
def crosstab_topk(spark, sf):
    return _crosstab(spark, sf, False)


@query("presence_matrix", CROSSTAB.format(cells=", ".join(f"(count(*) FILTER (place = {k}) > 0)::INT AS c{k}" for k in range(1, 5))))
def presence_matrix(spark, sf):
    return _crosstab(spark, sf, True)


@query("pair_flow", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY ALL")
def pair_flow(spark, sf):
    return analytics.pair_flow(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("sankey_links", """
WITH names AS (SELECT DISTINCT 0 AS stage, o_orderpriority AS name FROM orders UNION SELECT DISTINCT 1, o_orderstatus FROM orders UNION SELECT DISTINCT 2, substr(o_orderpriority, 1, 1) FROM orders),
nodes AS (SELECT *, row_number() OVER (ORDER BY stage, name) - 1 AS i FROM names)
SELECT a.i AS source, b.i AS target, count(*) AS value FROM orders JOIN nodes a ON a.stage = 0 AND a.name = o_orderpriority JOIN nodes b ON b.stage = 1 AND b.name = o_orderstatus GROUP BY ALL
UNION ALL SELECT a.i, b.i, count(*) FROM orders JOIN nodes a ON a.stage = 1 AND a.name = o_orderstatus JOIN nodes b ON b.stage = 2 AND b.name = substr(o_orderpriority, 1, 1) GROUP BY ALL""")
def sankey_links(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("c"))
    links = analytics.sankey(rows, ["o_orderpriority", "o_orderstatus", "c"])[1]
    return links.select(F.col("source").cast("long").alias("source"), F.col("target").cast("long").alias("target"), "value")


@query("degree_stats", """
WITH e AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem), ends AS (SELECT a AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT b, 1, 0 FROM e)
SELECT node, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, count(*) AS degree FROM ends GROUP BY node""")
def degree_stats(spark, sf):
    return analytics.degrees(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


@query("edge_weights", "SELECT l_suppkey, l_partkey, count(*) AS weight FROM lineitem GROUP BY ALL")
def edge_weights(spark, sf):
    return analytics.edge_weights(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


def three_tables(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    name = lambda c: F.concat(F.lit("k"), F.col(c) % 50)
    a = table(spark, sf, "supplier").select(name("s_suppkey").alias("sourceName"), F.concat(F.lit("t"), F.col("s_nationkey")).alias("tryDataLab"))
    b = table(spark, sf, "customer").select(F.concat(F.lit("k"), F.col("c_nationkey") + 20).alias("sourceName"), F.concat(F.lit("m"), F.col("c_nationkey")).alias("wd_chem"))
    c = table(spark, sf, "orders").select(F.concat(F.lit("k"), F.col("o_orderkey") % 40 + 5).alias("sourceName"), F.concat(F.lit("k"), F.col("o_custkey") % 60).alias("targetName"))
    return a, b, c


THREE = """
a AS (SELECT 'k' || (s_suppkey % 50) AS x, 't' || s_nationkey AS y FROM supplier), b AS (SELECT 'k' || (c_nationkey + 20) AS x, 'm' || c_nationkey AS y FROM customer),
c AS (SELECT 'k' || (o_orderkey % 40 + 5) AS x, 'k' || (o_custkey % 60) AS y FROM orders),
named AS (SELECT x AS species, 1 AS t FROM a UNION SELECT x, 2 FROM b UNION SELECT x, 3 FROM c UNION SELECT y, 3 FROM c)"""


@query("species_in_all", f"WITH {THREE} SELECT species FROM named GROUP BY species HAVING count(DISTINCT t) = 3")
def species_in_all(spark, sf):
    return analytics.species_sets(*three_tables(spark, sf), common=True)


@query("species_in_any", f"WITH {THREE} SELECT DISTINCT species FROM named")
def species_in_any(spark, sf):
    return analytics.species_sets(*three_tables(spark, sf), common=False)


@query("completeness", f"WITH {THREE} SELECT species, count(DISTINCT t) AS score FROM named GROUP BY species")
def completeness(spark, sf):
    return analytics.completeness(*three_tables(spark, sf))


NETWORK = f"""{THREE},
kinds AS (SELECT x, y, 1 AS r, 'trait' AS kind FROM a UNION ALL SELECT x, y, 2, 'metabolite' FROM b UNION ALL SELECT x, y, 3, 'interaction' FROM c),
edges AS (SELECT least(x, y) AS a, greatest(x, y) AS b, arg_max(kind, r) AS edge_type FROM kinds GROUP BY ALL)"""


@query("network_edges", f"WITH {NETWORK} SELECT a, b, edge_type FROM edges")
def network_edges(spark, sf):
    return analytics.network(*three_tables(spark, sf))


@query("network_summary", f"""WITH {NETWORK}
SELECT (SELECT count(*) FROM (SELECT a FROM edges UNION SELECT b FROM edges UNION SELECT species FROM named)) AS n_nodes, (SELECT count(DISTINCT species) FROM named) AS n_species, count(*) AS n_edges,
       count(*) FILTER (edge_type = 'trait') AS n_trait, count(*) FILTER (edge_type = 'metabolite') AS n_metabolite, count(*) FILTER (edge_type = 'interaction') AS n_interaction FROM edges""")
def network_summary(spark, sf):
    three = three_tables(spark, sf)
    return analytics.network_summary(analytics.network(*three), analytics.species_sets(*three, common=False))


@query("connected_species", f"WITH {THREE} SELECT y AS tryDataLab, count(DISTINCT x) AS n FROM a GROUP BY y")
def connected_species(spark, sf):
    return analytics.connected_species(three_tables(spark, sf)[0], "tryDataLab")


# --- statistics ---------------------------------------------------------------------------------


@query("trait_matrix", """
SELECT l_suppkey, round(avg(l_quantity) FILTER (l_returnflag = 'A'), 6) AS A, round(avg(l_quantity) FILTER (l_returnflag = 'N'), 6) AS N, round(avg(l_quantity) FILTER (l_returnflag = 'R'), 6) AS R
FROM lineitem GROUP BY l_suppkey HAVING count(*) FILTER (l_returnflag = 'A') > 0 AND count(*) FILTER (l_returnflag = 'N') > 0 AND count(*) FILTER (l_returnflag = 'R') > 0""")
def trait_matrix(spark, sf):
    out = stats.trait_matrix(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", "l_quantity", ["A", "N", "R"])
    return out.select("l_suppkey", *map(rounded, ("A", "N", "R")))


@query("recode_traits", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'SLA' WHEN 1 THEN 'LDMC' WHEN 2 THEN 'Leaf_N' END AS trait_std FROM events WHERE event_id % 4 < 3")
def recode_traits(spark, sf):
    raw = F.expr("CASE event_id % 4 WHEN 0 THEN 'SLA: petiole  included' WHEN 1 THEN 'Leaf dry matter content' WHEN 2 THEN 'Nmass' ELSE event_type END")
    return stats.recoded_traits(table(spark, sf, "events").select("event_id", raw.alias("t")), "t").select("event_id", "trait_std")


@query("median_value", "SELECT median(l_extendedprice) AS median FROM lineitem")
def median_value(spark, sf):
    return stats.median_of(table(spark, sf, "lineitem"), "l_extendedprice")


@query("histogram", """
WITH span AS (SELECT min(l_extendedprice) AS low, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS width FROM lineitem),
counts AS (SELECT least(floor((l_extendedprice - low) / width), 29)::INT AS bin, count(*) AS n FROM lineitem, span GROUP BY 1)
SELECT i::INT AS bin, coalesce(n, 0) AS n FROM range(30) r(i) LEFT JOIN counts ON bin = i""")
def histogram(spark, sf):
    return stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30).select("bin", "n")


@query("mean_sd", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd, count(l_quantity) AS n FROM lineitem GROUP BY l_returnflag")
def mean_sd(spark, sf):
    return stats.mean_sd(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity").select("l_returnflag", rounded("mean"), rounded("sd"), "n")


@query("pearson", """
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem""")
def pearson(spark, sf):
    return stats.pearson(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).select("a", "b", rounded("r"))


@query("spearman", """
WITH ranked AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT round(corr(a, b), 6) AS r, count(*) AS n FROM ranked""")
def spearman(spark, sf):
    return stats.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(rounded("r"), "n")


@query("cosine_top1", """
WITH scored AS (SELECT q.vec_id, c.vec_id AS best, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id)
SELECT vec_id, arg_max(best, (score, -best)) AS best, max(score) AS score FROM scored GROUP BY vec_id""")
def cosine_top1(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    labels = v.select(F.col("vec_id").alias("best"), F.col("vec_id").alias("label_id"), "vector")
    return semantic.best_matches(v, labels, ["vec_id"], ["best"], exclude_equal=("vec_id", "best"), decimals=6)


@query("sd_bins", """
WITH s AS (SELECT stddev_samp(c_acctbal) AS sd FROM customer)
SELECT c_custkey, CASE WHEN c_acctbal <= -sd THEN 'Conservative' WHEN c_acctbal <= sd THEN 'Intermediate' ELSE 'Acquisitive' END AS strategy FROM customer, s""")
def sd_bins(spark, sf):
    c = table(spark, sf, "customer")
    sd = c.agg(F.stddev_samp("c_acctbal")).first()[0]
    return c.select("c_custkey", S.three_bins(F.col("c_acctbal"), F.lit(sd)).alias("strategy"))


@query("running_share", "SELECT o_orderpriority, sum(n) OVER (ORDER BY o_orderpriority)::BIGINT AS upto FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)")
def running_share(spark, sf):
    counts = analytics.value_counts(table(spark, sf, "orders"), "o_orderpriority")
    return tables.running_sum(counts, "n", "o_orderpriority", "upto").select("o_orderpriority", "upto")


@query("diversity_by_strategy", """
WITH d AS (SELECT user_id AS k, count(DISTINCT event_type || (event_id % 7)) AS n FROM events GROUP BY 1), s AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'low' ELSE 'high' END AS strategy FROM customer)
SELECT strategy, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS sd, count(*) AS n FROM d JOIN s USING (k) GROUP BY strategy""")
def diversity_by_strategy(spark, sf):
    metabolites = table(spark, sf, "events").select(F.col("user_id").alias("source_wdx"), F.expr("event_type || (event_id % 7)").alias("structure_inchikey"))
    c = table(spark, sf, "customer")
    ids = c.select(F.col("c_custkey").alias("source_wdx"), F.col("c_name").alias("sourceName"))
    scored = c.select(F.col("c_name").alias("sourceName"), F.when(F.col("c_acctbal") < 0, "low").otherwise("high").alias("strategy"))
    return stats.diversity_by_strategy(metabolites, ids, scored)[1].select("strategy", rounded("mean"), rounded("sd"), "n")


MATRIX = ["l_quantity", "l_extendedprice", "l_discount"]


@query("pca_scores")
def pca_scores(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*[F.avg(c).alias(c) for c in MATRIX])
    return stats.pca(per, MATRIX, 2)[0]


@query("strategy_classes")
def strategy_classes(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*[F.avg(c).alias(c) for c in MATRIX])
    return stats.strategies(per, MATRIX, "l_quantity").select("l_suppkey", "LES_score", "strategy")


@query("match_terms")
def match_terms(spark, sf):
    lines = table(spark, sf, "part").select(F.concat_ws("/", "p_type", "p_brand").alias("line"))
    ontology = table(spark, sf, "part").select(F.col("p_type").alias("label"), F.concat(F.lit("http://t/"), F.regexp_replace("p_type", " ", "_")).alias("uri"), F.col("p_type").alias("main_label")).distinct()
    return semantic.match_terms(lines, ontology)
