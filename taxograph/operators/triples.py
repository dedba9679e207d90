"""Records to triples: interaction graph, trait graph, inverse predicates, set semantics.

A triple is (s, p, o, o_kind, o_dtype, src, row_id): full IRIs; o_kind is iri, literal or bnode.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from taxograph import vocab as V
from taxograph.functions import scalars as S
from taxograph.operators import terms as T
from taxograph.operators.tables import first_seen

COLUMNS = ("s", "p", "o", "o_kind", "o_dtype", "src", "row_id")
NEWS = ("s_new", "o_new")
STRING, INTEGER, DOUBLE = (V.XSD + t for t in ("string", "integer", "double"))


@dataclass(frozen=True)
class Statement:
    """What a record states: two columns and a predicate; a record without one of the ends states nothing."""

    s: Column
    p: str
    o: Column
    kind: str
    dtype: Column | str | None = None
    #: How it introduces its ends to a dictionary of terms: NOT, if another statement does; ALONE, if no other does.
    s_new: int = 2
    o_new: int = 2


NOT, ALONE, AMONG_OTHERS = 0, 1, 2


def iri(s: Column, p: str, o: Column | str) -> Statement:
    return Statement(s, p, F.lit(o) if isinstance(o, str) else o, "iri")


def literal(s: Column, p: str, o: Column, dtype: Column | str = STRING) -> Statement:
    return Statement(s, p, o, "literal", dtype)


def bnode(s: Column, p: str, o: Column) -> Statement:
    return Statement(s, p, o, "bnode")


def inverses(statements: list[Statement], table: dict[str, str] = V.INVERSE) -> list[Statement]:
    """The inverse of each statement with an IRI object whose predicate has one."""
    return [Statement(x.o, table[x.p], x.s, "iri", None, NOT, NOT) for x in statements if x.kind == "iri" and x.p in table]


def emitted(df: DataFrame, statements: list[Statement], src: str, news: bool = False) -> DataFrame:
    """A row per triple that has both ends; one pass over df. news: with s_new and o_new of the statements.

    Every column is computed once a record, before the rows are multiplied by a constant table of slots;
    then a slot only picks its two columns. One expression that makes all triples would be too large a
    method for the JVM to compile.
    """
    ends: dict[int, tuple[str, Column]] = {}
    for x in statements:
        for c in (x.s, x.o, x.dtype):
            if isinstance(c, Column):
                ends.setdefault(id(c), (f"__v{len(ends)}", c))
    base = df.select("row_id", *[c.cast("string").alias(n) for n, c in ends.values()])
    slots = [F.struct(F.lit(k).alias("slot"), F.lit(x.p).alias("p"), F.lit(x.kind).alias("o_kind"), F.lit(x.dtype if isinstance(x.dtype, str) else None).cast("string").alias("fixed"), F.lit(x.s_new).alias("s_new"), F.lit(x.o_new).alias("o_new")) for k, x in enumerate(statements)]
    rows = base.withColumn("t", F.explode(F.array(*slots)))

    def picked(of, otherwise: Column) -> Column:
        used: dict[str, list[int]] = {}
        for k, x in enumerate(statements):
            if isinstance(of(x), Column):
                used.setdefault(ends[id(of(x))][0], []).append(k)
        out = None
        for name, which in used.items():
            here = F.col("t.slot").isin(which)
            out = F.when(here, F.col(name)) if out is None else out.when(here, F.col(name))
        return otherwise if out is None else out.otherwise(otherwise)

    none = F.lit(None).cast("string")
    rows = rows.select(picked(lambda x: x.s, none).alias("s"), F.col("t.p").alias("p"), picked(lambda x: x.o, none).alias("o"), F.col("t.o_kind").alias("o_kind"), picked(lambda x: x.dtype, F.col("t.fixed")).alias("o_dtype"), F.lit(src).alias("src"), "row_id", "t.s_new", "t.o_new")
    return rows.filter("s is not null and o is not null").select(*COLUMNS, *(NEWS if news else ()))


def invalid_to_null(c: Column) -> Column:
    return F.when(S.valid(c), c)


def box(*parts: Column | str) -> Column:
    """An IRI in the graph's own namespace; null if a part is."""
    return F.concat(F.lit(V.EMI_BOX), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _inverse_of(t: Column, table: dict[str, str]) -> Column:
    """The inverse of a triple struct, null where it has none."""
    back = S.lookup(table, t["p"])
    whole = F.struct(t["o"].alias("s"), back.alias("p"), t["s"].alias("o"), t["o_kind"].alias("o_kind"), t["o_dtype"].alias("o_dtype"))
    return F.when((t["o_kind"] == "iri") & back.isNotNull(), whole)


def inverse(triples: DataFrame, table: dict[str, str] = V.INVERSE) -> DataFrame:
    """The inverse of each triple with an IRI object whose predicate has one; single pass, not repeated."""
    rows = triples.select(_inverse_of(F.struct("s", "p", "o", "o_kind", "o_dtype"), table).alias("t"), "src", "row_id")
    return rows.filter("t is not null").select("t.*", "src", "row_id").select(*COLUMNS)


def as_set(triples: DataFrame, src: str | None = None) -> DataFrame:
    """Each triple once, with the least row_id; of several sources the least name.

    Give src where all triples come from it: the keys then are the triple and the buffer is a number,
    which is one hash aggregate with partial results before the exchange. Names as buffers need a sort.
    """
    keys = triples.groupBy("s", "p", "o", "o_kind", "o_dtype")
    if src is None:
        once = keys.agg(F.min("src").alias("src"), F.min("row_id").alias("row_id"))
    else:
        once = keys.agg(F.min("row_id").alias("row_id")).withColumn("src", F.lit(src))
    return once.select(*COLUMNS)


def with_inverse(triples: DataFrame, table: dict[str, str] = V.INVERSE, src: str | None = None) -> DataFrame:
    """A set of triples and their inverses, the input read once; src as for as_set."""
    own = F.struct("s", "p", "o", "o_kind", "o_dtype")
    both = triples.select(F.explode(F.array_compact(F.array(own, _inverse_of(own, table)))).alias("t"), "src", "row_id")
    return as_set(both.select("t.*", "src", "row_id"), src)


def labelled_once(entities: DataFrame, src: str) -> DataFrame:
    """The label of each (iri, label, row_id) that was seen first; one with a null label has none."""
    # equal labels of an entity are one row before any order matters
    few = entities.groupBy("iri", "label").agg(F.min("row_id").alias("row_id"))
    first = first_seen(few, "iri", ["label", "row_id"])
    return emitted(first, [literal(F.col("iri"), V.RDFS + "label", F.col("label"))], src)


def typed_once(entities: DataFrame, rdf_type: str, src: str) -> DataFrame:
    """Type and label of each (iri, label, row_id), once, with the label seen first."""
    types = entities.groupBy("iri").agg(F.min("row_id").alias("row_id")).filter("iri is not null")
    return emitted(types, [iri(F.col("iri"), V.RDF + "type", rdf_type)], src).unionByName(labelled_once(entities, src))


def numbered(records: DataFrame, batch: int | None = None) -> DataFrame:
    """records with rec, the number in their IRIs. batch: numbers with gaps, as runs in such batches make them."""
    own = F.col("row_id")
    return records.withColumn("rec", own if batch is None else own + F.floor(own / batch) * batch)


#: Records that a task turns into triples, of which a record makes dozens.
RECORDS_PER_TASK = 20_000


def dealt(rows: DataFrame, records: DataFrame, count: int | None = None) -> DataFrame:
    """rows, one a record, dealt to tasks of about RECORDS_PER_TASK and to all partitions at least; count: of the records, if it is known.

    Records are small in files, so that few tasks read many of them; each task holds the triples of its
    records while it makes them distinct.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n if rows.isStreaming else max(n, -(-(records.count() if count is None else count) // RECORDS_PER_TASK)), "row_id")


@dataclass(frozen=True)
class Graph:
    """Statements in tables that share no triple, repeated as they were emitted, with s_new and o_new.

    own: dealt to tasks by row_id; records of different row_ids have no triple of these in common, so each task makes its
    own distinct and no triple is shuffled. shared: the few that many records state.
    """

    own: list[DataFrame]
    shared: DataFrame
    src: str

    def as_set(self) -> DataFrame:
        """Each triple once, with the least row_id."""
        keys = [c for c in COLUMNS if c != "src"]
        own = [x.select(*keys).distinct().withColumn("src", F.lit(self.src)).select(*COLUMNS) for x in self.own]
        return reduce(DataFrame.unionByName, [*own, as_set(self.shared, self.src)])

    def statements(self) -> DataFrame:
        """Each triple once, with how it introduces its ends: (s, p, o, o_kind, o_dtype, s_new, o_new)."""
        keys, news = ["s", "p", "o", "o_kind", "o_dtype"], [F.max(c).alias(c) for c in NEWS]
        parts = [x.groupBy("row_id", *keys).agg(*news) for x in self.own] + [self.shared.groupBy(*keys).agg(*news)]
        return reduce(DataFrame.union, [x.select(*keys, *NEWS) for x in parts])


def interaction_triples(records: DataFrame, sexes: DataFrame, entities: DataFrame | None = None, batch: int | None = None, src: str = "interactions") -> DataFrame:
    """The graph of resolved records (source_wd, source_name, target_wd, target_name and the record columns), as a set.

    sexes: (key, value) map of sex terms. entities: (key, name, iri) map for body parts and life
    stages whose identifier is no IRI.
    """
    return interaction_graph(records, sexes, entities, batch, src).as_set()


def interaction_graph(records: DataFrame, sexes: DataFrame, entities: DataFrame | None = None, batch: int | None = None, src: str = "interactions", spelled: Callable[[list[Statement]], list[Statement]] = list) -> Graph:
    """The same graph in parts; spelled may write the statements' ends in another way, still a column a record."""
    rows = numbered(records, batch)
    # a sample's IRI holds its record's number, so only records of one row_id state its triples; not so without a
    # sample, or where the data may name a sample, whose label then is stated apart
    named = lambda *columns: reduce(lambda x, y: x | y, [F.coalesce(F.contains(F.col(c), F.lit("SAMPLE-")), F.lit(False)) for c in columns])
    slots = [(side, part) for part in PARTS for side in SIDES]
    odd = F.col("row_id").isNull() | F.col("source_wd").isNull() | F.col("target_wd").isNull() | named("interactionTypeId", "interactionTypeName", *(f"{a}{b}Id" for a, b in slots))
    seen = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd")).first()
    in_parts = not seen["odd"] and records.schema["row_id"].dataType in (T_.IntegerType(), T_.LongType()) and (entities is None or not entities.filter(named("iri")).head(1))
    # joined entities are dealt after their joins
    rows = _with_ends(dealt(rows, records, seen["n"]), None) if entities is None else dealt(_with_ends(rows, entities), records, seen["n"])
    r = F.col("__rec")
    value = lambda name: invalid_to_null(F.col(name))
    made = [
        replace(iri(r, V.RDF + "type", V.EMI + "Interaction"), s_new=ALONE),
        iri(r, V.EMI + "isClassifiedWith", F.col("__type_iri")),
        literal(r, V.PROV + "atLocation", value("localityName")),
        literal(r, V.DCTERMS + "bibliographicCitation", value("referenceDoi")),
        literal(r, V.DCTERMS + "bibliographicCitation", value("sourceDOI")),
        literal(r, V.WGS84 + "lat", value("decimalLatitude")),
        literal(r, V.WGS84 + "long", value("decimalLongitude")),
    ]
    for side, link in zip(SIDES, ("hasSource", "hasTarget"), strict=True):
        sample, name, wd = F.col(f"__{side}"), value(f"{side}_name"), value(f"{side}_wd")
        named = F.when(name.isNotNull(), sample)
        made += [
            replace(iri(r, V.EMI + link, sample), o_new=ALONE),
            iri(named, V.RDF + "type", V.SOSA + "Sample"),
            literal(named, V.RDFS + "label", name),
            iri(named, V.SOSA + "isSampleOf", box("ORGANISM-", S.encode_iri(name))),
            iri(sample, V.EMI + "inTaxon", F.concat(F.lit(V.WD), wd)),
        ]
    made += [iri(F.col(f"__{side}"), V.EMI + PARTS[part][0], F.col(f"__{side}{part}_iri")) for side, part in slots]
    made = [x if x.s_new == ALONE else replace(x, s_new=NOT) for x in made]
    # classes and first labels: what many records state
    kinds = {"type": "InteractionType"} | {f"{a}{b}": PARTS[b][1] for a, b in slots}
    found = [F.struct(F.col(f"__{n}_iri").alias("iri"), F.col(f"__{n}_label").alias("label"), F.lit(V.EMI + k).alias("kind")) for n, k in kinds.items()]
    found = rows.select(F.explode(F.array(*found)).alias("e"), "row_id").select("e.*", "row_id").filter("iri is not null")
    # equal ones are one row before any order matters
    few = found.groupBy("iri", "label", "kind").agg(F.min("row_id").alias("row_id"))
    first = first_seen(few, "iri", ["label", "row_id"])
    counted = _counted_sexes(rows, sexes)
    n, of = F.col("node"), F.col("iri")
    sexed = [
        replace(bnode(F.col("sample"), V.EMI + "hasSex", n), s_new=NOT, o_new=NOT),
        replace(iri(n, V.QUDT_INTERACTIONS + "quantityKind", of), s_new=ALONE),
        replace(literal(n, V.QUDT_INTERACTIONS + "numericValue", F.col("n"), INTEGER), s_new=NOT),
    ]
    emit = lambda df, statements: emitted(df, spelled(statements), src, news=True)
    # what labels and sexes state has no inverse
    own = [emit(rows, made + inverses(made)), emit(counted, sexed)]
    shared = [
        emit(few, [iri(F.col("iri"), V.RDF + "type", F.col("kind"))]),
        emit(first, [literal(F.col("iri"), V.RDFS + "label", F.col("label"))]),
        emit(counted, [iri(of, V.RDF + "type", V.EMI + "BiologicalSex")]),
    ]
    if not in_parts:
        own, shared = [], own + shared
    return Graph(own, reduce(DataFrame.unionByName, shared), src)


def _with_ends(rows: DataFrame, entities: DataFrame | None) -> DataFrame:
    """Numbered records with the IRIs of record, samples, type and entities, and the labels of the last two."""
    rows = rows.withColumn("__rec", box(F.concat(F.lit("inRec"), F.col("rec").cast("string"))))
    for side in SIDES:
        rows = rows.withColumn(f"__{side}", box("SAMPLE-", S.encode_iri(F.col(f"{side}_wd")), "-inRec", F.col("rec").cast("string")))
    value = lambda name: invalid_to_null(F.col(name))
    type_id, type_name = value("interactionTypeId"), value("interactionTypeName")
    by_id, by_name = F.when(type_name.isNotNull(), type_id), F.when(type_id.isNull(), box(S.encode_iri(type_name)))
    rows = rows.withColumn("__type_iri", F.coalesce(by_id, by_name)).withColumn("__type_label", F.when(by_id.isNotNull(), type_name))
    for part in PARTS:
        for side in SIDES:
            rows = _entity(rows, f"{side}{part}", entities)
    return rows


SIDES = ("source", "target")
#: Parts of a record that become entities: their link and their class.
PARTS = {"BodyPart": ("hasAnatomicalEntity", "AnatomicalEntity"), "LifeStage": ("hasDevelopmentalStage", "DevelopmentalStage")}


def _entity(rows: DataFrame, slot: str, entities: DataFrame | None) -> DataFrame:
    """rows with the IRI and label of a slot: by compact identifier or IRI, else by looking the name up."""
    name, own = invalid_to_null(F.col(f"{slot}Name")), S.expand_curie(invalid_to_null(F.col(f"{slot}Id")))
    if entities is None:
        return rows.withColumn(f"__{slot}_iri", own).withColumn(f"__{slot}_label", name)
    found = T.lookup_terms(rows.withColumn("__name", name), "__name", entities)
    found = found.withColumn(f"__{slot}_label", F.when(own.isNotNull(), F.col("__name")).otherwise(F.col("entity_name")))
    return found.withColumn(f"__{slot}_iri", F.coalesce(own, "entity_iri")).drop("__name", "entity_iri", "entity_name")


def _counted_sexes(rows: DataFrame, sexes: DataFrame) -> DataFrame:
    """(sample, row_id, iri, n, node): counts per sex, with a blank node whose name follows from sample and sex."""
    sides = F.array(*[F.struct(F.col(f"__{side}").alias("sample"), F.col(f"{side}SexName").alias("sex")) for side in SIDES])
    own = rows.select(F.explode(sides).alias("e"), "row_id").select("e.sample", "e.sex", "row_id")
    counted = T.count_terms(own, "sex", ["sample", "row_id"], sexes)
    return counted.withColumn("node", F.concat(F.lit("_:b"), F.substring(F.sha2(F.concat_ws("\n", "sample", "iri"), 256), 1, 32)))


def term_entities(df: DataFrame, text: str, subject: str, link: str, kind: str, entities: DataFrame, src: str = "terms") -> DataFrame:
    """Links from a subject to every entity that a free text names, with types and labels."""
    words = T.exploded_terms(df, text, [subject, "row_id"])
    found = T.lookup_terms(words, "term", entities).filter("entity_iri is not null").select(subject, "row_id", F.col("entity_iri").alias("iri"), F.col("entity_name").alias("label"))
    return as_set(emitted(found, [iri(F.col(subject), link, F.col("iri"))], src).unionByName(typed_once(found, kind, src)))


def trait_rejects(records: DataFrame) -> DataFrame:
    """Trait records without the keys their IRIs need."""
    return records.filter(~_usable())


def _usable() -> Column:
    return F.col("AccSpeciesName").isNotNull() & F.col("ObservationID").isNotNull()


def with_species(records: DataFrame, species: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """records left-joined with the taxon of their species; with samples, only those of taxa in it."""
    rows = records.join(species.select(F.col("TRY_AccSpeciesName").alias("AccSpeciesName"), "WdID"), "AccSpeciesName", "left")
    if samples is None:
        return rows
    return rows.join(samples.select(F.col("wd_taxon_id").alias("WdID")).distinct(), "WdID", "left_semi")


def trait_triples(records: DataFrame, species: DataFrame, qudt: DataFrame, emi: DataFrame, samples: DataFrame | None = None, prefix: str = "TRYdb-", src: str = "traits") -> DataFrame:
    """The graph of trait records.

    species: (TRY_AccSpeciesName, WdID). qudt, emi: (key, value) unit maps. samples: (wd_taxon_id);
    if given, only records of these taxa.
    """
    rows = with_species(records.filter(_usable()), species, samples)
    for n, (key, table) in enumerate((("OrigUnitStr", qudt), ("UnitName", qudt), ("OrigUnitStr", emi), ("UnitName", emi))):
        rows = rows.join(table.select(F.col("key").alias(key), F.col("value").alias(f"__u{n}")), key, "left")
    rows = dealt(rows, records)  # joined by species, of which there may be few
    value = lambda name: invalid_to_null(F.col(name))
    coded = lambda name: F.concat(F.lit(prefix), S.encode_iri(value(name)))
    name, has = F.col("AccSpeciesName"), S.valid(F.col("Dataset"))
    sample = box("SAMPLE-", S.encode_iri(name), "-", F.col("ObservationID"))
    organism, observation = box("ORGANISM-", S.encode_iri(name)), box("OBSERVATION-", S.encode_iri(F.col("ObservationID")))
    dataset = box("DATASET-", S.encode_iri(value("Dataset")))
    result = F.when(has, box("RESULT-", F.col("ObsDataID")))
    is_trait = S.valid(F.col("TraitName"))
    trait, other = F.when(is_trait, result), F.when(~is_trait, result)
    dtype = F.when(is_trait & S.is_numeric_literal(F.col("OrigValueStr")), DOUBLE).otherwise(STRING)
    made = [
        iri(sample, V.RDF + "type", V.SOSA + "Sample"),
        literal(sample, V.RDFS + "label", name),
        iri(sample, V.SOSA + "isSampleOf", organism),
        iri(sample, V.SOSA + "isFeatureOfInterestOf", observation),
        iri(sample, V.DCTERMS + "isPartOf", dataset),
        literal(dataset, V.DCTERMS + "bibliographicCitation", F.col("Reference")),
        literal(dataset, V.DCTERMS + "identifier", coded("DatasetID")),
        iri(observation, V.SOSA + "hasResult", result),
        iri(trait, V.RDF + "type", V.EMI + "Trait"),
        literal(F.when(trait.isNotNull(), F.lit(V.EMI + "Trait")), V.DCTERMS + "identifier", coded("TraitID")),
        iri(other, V.RDF + "type", V.EMI + "NonTrait"),
        literal(result, V.RDF + "value", value("OrigValueStr"), dtype),
        literal(result, V.RDFS + "label", value("DataName")),
        literal(result, V.DCTERMS + "identifier", coded("DataID")),
        iri(result, V.QUDT_TRAITS + "hasUnit", S.unit_iri(F.col("OrigUnitStr"), F.col("UnitName"), F.col("__u0"), F.col("__u1"), F.col("__u2"), F.col("__u3"))),
        literal(result, V.RDFS + "comment", S.strip(value("OrigUnitStr"))),
        iri(organism, V.EMI + "inTaxon", F.concat(F.lit(V.WD), S.encode_iri(F.col("WdID")))),
        literal(organism, V.DCTERMS + "identifier", F.concat(F.lit(prefix), S.encode_iri(F.col("AccSpeciesID")))),
    ]
    return as_set(emitted(rows, made + inverses(made), src), src)


def counters(triples: DataFrame, record_type: str = V.EMI + "Interaction") -> DataFrame:
    """(records, triples): how many records of a type and how many triples a graph has."""
    record = (F.col("p") == V.RDF + "type") & (F.col("o") == record_type)
    return triples.agg(F.count(F.when(record, 1)).alias("records"), F.count(F.lit(1)).alias("triples"))
