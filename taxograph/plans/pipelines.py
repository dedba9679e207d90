"""The stages from source files to graphs, and their command line.

Stages hand on tables, not files; each writes its result where the configuration says. Arguments
override the configuration file.
"""

from __future__ import annotations

import argparse
import configparser
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph.operators import lineage, resolve, semantic, terms, triples
from taxograph.sources import landing, readers, sinks, sparql_http

LOG = logging.getLogger("taxograph")


def fetch(spark: SparkSession, endpoint: str, out: str, page_rows: int | None = None) -> dict[str, str]:
    """Fetch the mapping and the lineages, align the lineages and find ambiguous names; the paths written.

    With page_rows the answers land in ordered pages under `out`, and a repeated call fetches only the missing ones.
    """
    spark.dataSource.register(sparql_http.SparqlSource)

    def load(q: str, name: str) -> DataFrame:
        if page_rows is None:
            return spark.read.format("sparql").option("endpoint", endpoint).option("query", q).load()
        ordered = f"{q}\nORDER BY {' '.join('?' + v for v in sparql_http.variables(q))}"
        return landing.land(spark, endpoint, ordered, f"{out}/landed/{name}", int(page_rows)).drop("row_id")

    paths = {k: f"{out}/{k}" for k in ("mapping", "lineage_long", "lineage", "repeats")}
    sinks.write_delimited(load(sparql_http.mapping_query(), "mapping"), paths["mapping"], gzip=True)
    sinks.write_delimited(load(sparql_http.lineage_query(), "lineage"), paths["lineage_long"], gzip=True)
    shape(spark, paths["lineage_long"], paths["lineage"], paths["repeats"])
    return paths


def shape(spark: SparkSession, long_path: str, aligned_path: str, repeats_path: str) -> None:
    """Long lineages to one row per taxon, and the taxa that share a name."""
    aligned = lineage.align(lineage.rank_filter(readers.lineage_long(spark, long_path)))
    sinks.write_delimited(aligned, aligned_path, gzip=True)
    sinks.write_delimited(lineage.ambiguous_names(readers.lineage_aligned(spark, aligned_path).drop("row_id")), repeats_path)


def match_interactions(spark: SparkSession, records: str, mapping: str, aligned: str, repeats: str, out: str, spread: int = 0, compat: bool = False) -> None:
    """Resolve the taxa of interaction records."""
    rows = readers.interactions(spark, records, taxa_only=True, spread=spread)
    found = resolve.match_taxa(rows, readers.mapping_table(spark, mapping), readers.lineage_aligned(spark, aligned), readers.lineage_aligned(spark, repeats), compat)
    sinks.write_delimited(found, out, gzip=True)


def match_trait_species(spark: SparkSession, species: str, aligned: str, out: str) -> None:
    sinks.write_delimited(resolve.match_species(readers.species_list(spark, species), readers.lineage_aligned(spark, aligned)), out, "\t", gzip=True)


def match_ontology(spark: SparkSession, lines: str, ontologies: list[str], out: str, embedder: semantic.Embedder | None = None) -> None:
    sinks.write_matches(semantic.match_terms(readers.term_lines(spark, lines), readers.ontology_terms(spark, *ontologies), embedder), out)


def _written(graph: DataFrame, out: str) -> None:
    spark = graph.sparkSession
    sinks.write_triples(graph, f"{out}/triples")
    table = sinks.read_triples(spark, f"{out}/triples")
    sinks.write_turtle(table, f"{out}/turtle")
    LOG.info("%s: %s", out, triples.counters(table).first().asDict())


def interaction_graph(spark: SparkSession, records: str, matched: str, sexes: str, term_files: list[str], out: str, spread: int = 0) -> None:
    """Triples of interaction records: a Parquet table by predicate and Turtle."""
    known = readers.delimited(spark, matched, columns=("TaxonId", "TaxonName", "Mapped_ID_WD", "Mapped_Value"))
    rows = resolve.kept_records(resolve.resolve_sides(readers.interactions(spark, records, spread=spread), *resolve.resolution_maps(known)))
    entities = terms.entity_map(readers.term_maps(spark, *term_files)) if term_files else None
    _written(triples.interaction_triples(rows, readers.sex_map(spark, sexes), entities), out)


def trait_graph(spark: SparkSession, records: str, matched: str, qudt: str, emi: str, out: str, samples: str | None = None, spread: int = 0) -> None:
    """Triples of trait records; records without keys go to a rejects table."""
    rows = readers.traits(spark, records, spread=spread)
    species = readers.delimited(spark, matched, "\t", ("TRY_AccSpeciesName", "WdID"))
    units = [readers.dictionary(spark, p, "origUnit", "mapUnit") for p in (qudt, emi)]
    only = readers.delimited(spark, samples, "\t", ("wd_taxon_id",)) if samples else None
    sinks.write_delimited(triples.trait_rejects(rows).drop("row_id"), f"{out}/rejects", "\t")
    _written(triples.trait_triples(rows, species.filter(F.col("TRY_AccSpeciesName").isNotNull()), *units, only), out)


STAGES = {
    "fetch": (fetch, ("endpoint", "out")),
    "match-interactions": (match_interactions, ("records", "mapping", "aligned", "repeats", "out")),
    "match-traits": (match_trait_species, ("species", "aligned", "out")),
    "match-ontology": (match_ontology, ("lines", "ontologies", "out")),
    "interaction-graph": (interaction_graph, ("records", "matched", "sexes", "term_files", "out")),
    "trait-graph": (trait_graph, ("records", "matched", "qudt", "emi", "out")),
}
LISTS = ("ontologies", "term_files")


def main(args: list[str] | None = None) -> None:
    """python -m taxograph STAGE... [--config FILE] [--set STAGE.NAME=VALUE]: the stages in the given order."""
    parser = argparse.ArgumentParser(prog="taxograph", description=main.__doc__)
    parser.add_argument("stages", nargs="+", choices=[*STAGES])
    parser.add_argument("--config", help="an ini file with a section per stage")
    parser.add_argument("--set", action="append", default=[], metavar="STAGE.NAME=VALUE")
    given = parser.parse_args(args)
    config = configparser.ConfigParser()
    if given.config and not config.read(given.config):
        parser.error(f"cannot read {given.config}")
    for item in given.set:
        name, _, value = item.partition("=")
        stage, _, key = name.partition(".")
        if stage not in config:
            config.add_section(stage)
        config[stage][key] = value
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = SparkSession.builder.appName("taxograph").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for stage in given.stages:
        run, names = STAGES[stage]
        section = config[stage] if stage in config else {}
        if missing := [n for n in names if n not in section and n not in LISTS]:
            parser.error(f"{stage} needs {', '.join(missing)}")
        run(spark, **{n: section.get(n, "").split() if n in LISTS else section[n] for n in names})
