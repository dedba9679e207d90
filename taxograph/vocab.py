"""Namespaces, ranks, identifier prefixes and predicate tables."""

from __future__ import annotations

# Namespaces of the graph's vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCTERMS = "http://purl.org/dc/terms/"
EMI = "https://w3id.org/emi#"
EMI_BOX = "https://w3id.org/emi/abox#"
EMI_UNIT = "https://w3id.org/emi/unit#"
SOSA = "http://www.w3.org/ns/sosa/"
WD = "http://www.wikidata.org/entity/"
PROV = "http://www.w3.org/ns/prov#"
WGS84 = "http://www.w3.org/2003/01/geo/wgs84_pos#"
QUDT_UNIT = "http://qudt.org/vocab/unit/"
#: The schema namespace differs between the interaction and the trait graph.
QUDT_INTERACTIONS = "http://qudt.org/schema/qudt/"
QUDT_TRAITS = "https://qudt.org/schema/qudt/"
OBO = "http://purl.obolibrary.org/obo/"

PREFIXES = {
    "": EMI_BOX, "rdf": RDF, "rdfs": RDFS, "xsd": XSD, "dcterms": DCTERMS, "emi": EMI, "emiUnit": EMI_UNIT,
    "sosa": SOSA, "wd": WD, "prov": PROV, "wgs84": WGS84, "qudtUnit": QUDT_UNIT, "obo": OBO,
}

# Taxonomic ranks and the entities that name them.
RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
RANK_ENTITIES = {
    WD + "Q36732": "kingdom",
    WD + "Q38348": "phylum",
    WD + "Q37517": "class",
    WD + "Q36602": "order",
    WD + "Q35409": "family",
    WD + "Q34740": "genus",
    WD + "Q7432": "species",
}

# The external identifier columns of a mapping table, in order, and the prefix of each.
ID_COLUMNS = ("eol", "gbif", "ncbi", "ott", "itis", "irmng", "col", "nbn", "worms", "bold", "plazi", "apni", "msw3", "iNat", "eppo")
ID_PREFIXES = ("EOL:", "GBIF:", "NCBI:", "OTT:", "ITIS:", "IRMNG:", "COL:", "NBN:", "WORMS:", "BOLD:", "PLAZI:", "APNI:", "msw3:", "INAT_TAXON:", "EPPO:")
#: Properties of the identifier columns, for the fetch query.
ID_PROPERTIES = ("P830", "P846", "P685", "P9157", "P815", "P5055", "P10585", "P3240", "P850", "P3606", "P1992", "P5984", "P959", "P3151", "P3031")

# How identifiers in URL or URN form become prefixed ones, in this order.
ID_RULES = (
    (r"\Qhttps://www.wikidata.org/wiki/\E", "Wikidata:"),
    (r"\Qhttps://www.wikidata.org/entity/\E", "Wikidata:"),
    (r"\Qurn:lsid:marinespecies.org:taxname\E", "WORMS"),
    (r"\Qurn:lsid:irmng.org:taxname\E", "IRMNG"),
    (r"\Qhttp://www.boldsystems.org/index.php/Public_BarcodeCluster?clusteruri=BOLD\E", "BOLD"),
    (r"\Qhttps://www.itis.gov/servlet/SingleRpt/SingleRpt?search_topic=TSN&search_value=\E", "ITIS:"),
    (r"\Qhttps://www.inaturalist.org/taxa/\E", "INAT_TAXON:"),
    (r"\Qhttps://www.gbif.org/species/\E", "GBIF:"),
    (r"\Qhttps://species.nbnatlas.org/species/\E", "NBN:"),
    (r"\Qhttps://gd.eppo.int/taxon/\E", "EPPO:"),
    (r"^tsn", "ITIS"),
    (r"GBIF: \+", "GBIF:"),
    (r"gbif: \+", "GBIF:"),
    (r"gbif:", "GBIF:"),
)

# Compact identifiers of ontology terms.
CURIES = {
    "AEO": OBO + "AEO_",
    "CHEBI": OBO + "CHEBI_",
    "CLYH": OBO + "CLYH_",
    "ENVO": OBO + "ENVO_",
    "FAO": OBO + "FAO_",
    "FBdv": OBO + "FBdv_",
    "HAO": OBO + "HAO_",
    "NCIT": OBO + "NCIT_",
    "OMIT": OBO + "OMIT_",
    "PATO": OBO + "PATO_",
    "PORO": OBO + "PORO_",
    "RO": OBO + "RO_",
    "UBERON": OBO + "UBERON_",
    "PO": OBO + "PO_",
    "QUDT": QUDT_INTERACTIONS,
}

# Inverse predicates; those of dcterms hold one way only, those of sosa both ways.
INVERSE = {
    DCTERMS + "isPartOf": DCTERMS + "hasPart",
    DCTERMS + "hasFormat": DCTERMS + "isFormatOf",
    DCTERMS + "hasVersion": DCTERMS + "isVersionOf",
    DCTERMS + "references": DCTERMS + "isReferencedBy",
    DCTERMS + "replaces": DCTERMS + "isReplacedBy",
    DCTERMS + "requires": DCTERMS + "isRequiredBy",
    SOSA + "isActedOnBy": SOSA + "actsOnProperty",
    SOSA + "actsOnProperty": SOSA + "isActedOnBy",
    SOSA + "isFeatureOfInterestOf": SOSA + "hasFeatureOfInterest",
    SOSA + "hasFeatureOfInterest": SOSA + "isFeatureOfInterestOf",
    SOSA + "isResultOf": SOSA + "hasResult",
    SOSA + "hasResult": SOSA + "isResultOf",
    SOSA + "isSampleOf": SOSA + "hasSample",
    SOSA + "hasSample": SOSA + "isSampleOf",
    SOSA + "isHostedBy": SOSA + "hosts",
    SOSA + "hosts": SOSA + "isHostedBy",
    SOSA + "observes": SOSA + "isObservedBy",
    SOSA + "isObservedBy": SOSA + "observes",
    SOSA + "madeByActuator": SOSA + "madeActuation",
    SOSA + "madeActuation": SOSA + "madeByActuator",
    SOSA + "madeSampling": SOSA + "madeBySampler",
    SOSA + "madeBySampler": SOSA + "madeSampling",
    SOSA + "madeObservation": SOSA + "madeBySensor",
    SOSA + "madeBySensor": SOSA + "madeObservation",
}

#: The class that an unknown biological sex counts under, if a map names none.
UNKNOWN_SEX = EMI_BOX + "unknown"

# Trait names and the code that each is recoded to.
TRAIT_CODES = {
    "Specific leaf area": "SLA",
    "Leaf dry matter content": "LDMC",
    "Leaf nitrogen content per dry mass (Nmass)": "Leaf_N",
    "Leaf phosphorus content per dry mass (Pmass)": "Leaf_P",
    "Leaf nitrogen content": "Leaf_N",
    "Leaf phosphorus content": "Leaf_P",
    "SLA: undefined if petiole in- or excluded": "SLA",
    "SLA: petiole excluded": "SLA",
    "SLA: petiole included": "SLA",
    "SLA: undefined if petiole in- or excluded (1)": "SLA",
    "SLA: petiole  excluded": "SLA",
    "SLA: petiole  included": "SLA",
    "SLA": "SLA",
    "LDMC": "LDMC",
    "Leaf N": "Leaf_N",
    "Leaf P": "Leaf_P",
    "Nmass": "Leaf_N",
    "Pmass": "Leaf_P",
}

# Fungal genera; a species name is fungal if it holds one of them in any case.
FUNGAL_GENERA = (
    "Puccinia", "Fusarium", "Claviceps", "Alternaria", "Bipolaris", "Cochliobolus", "Cladosporium", "Eudarluca", "Sclerotinia", "Trichothecium",
    "Rhizoctonia", "Ustilaginoidea", "Colletotrichum", "Thanatephorus", "Leptosphaeria", "Peronospora", "Periconia", "Tuberculina", "Corticium", "Nectria",
    "Phoma", "Trichoderma", "Pithomyces", "Nigrospora", "Anthracocystis", "Ustilago", "Tranzschelia", "Dibotryon", "Armillaria", "Cryptococcus",
    "Eutypella", "Erysiphe", "Albugo", "Podosphaera", "Cicinobolus", "Sphaerellopsis", "Exserohilum", "Leptosphaerulina", "Myrothecium", "Neonectria",
)
