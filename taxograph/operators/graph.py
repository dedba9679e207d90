"""Graph patterns over a triple table or a store of numbers, as joins.

A pattern is (subject, predicate, object); a term that starts with ? is a variable, anything else a
constant: an IRI, or for objects also a literal's text. Solutions are rows with a column per
variable, as a bag: a pattern that matches twice gives two rows. Over a store the columns hold ids and
patterns are joined in the order of the stored counts; over a table they are joined as written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators.lineage import reachable
from taxograph.operators.stars import Stars
from taxograph.operators.store import Store

Source = DataFrame | Store | Stars

Pattern = tuple[str, str, str]


def is_variable(term: str) -> bool:
    return term.startswith("?")


def is_path(one: Pattern) -> bool:
    return one[1].endswith("*") and not is_variable(one[1])


def pattern(triples: Source, one: Pattern, starts: DataFrame | None = None) -> DataFrame:
    """Solutions of one pattern: constants become pushed-down filters, a repeated variable an equality.

    A predicate that ends in * is the reflexive and transitive path over it; starts: (node) the only
    subjects of the path that matter.
    """
    if isinstance(triples, Store):
        return triples.pattern(one, starts)
    triples = triples.triples if isinstance(triples, Stars) else triples
    s, p, o = one
    if is_path(one):
        edges = triples.filter((F.col("p") == p[:-1]) & (F.col("o_kind") != "literal")).select("s", "o")
        if starts is None:
            starts = triples.select(F.col("s").alias("node")).union(triples.filter("o_kind <> 'literal'").select("o"))
            starts = starts if is_variable(s) else starts.filter(F.col("node") == s)
        rows = reachable(edges, starts).toDF("s", "o").withColumn("p", F.lit(p))
    else:
        rows = triples.select("s", "p", "o")
    names: dict[str, str] = {}
    for column, term in (("s", s), ("p", p), ("o", o)):
        if not is_variable(term):
            if not (column == "p" and term.endswith("*")):
                rows = rows.filter(F.col(column) == term)
        elif term[1:] in names:
            rows = rows.filter(F.col(column) == F.col(names[term[1:]]))
        else:
            names[term[1:]] = column
    return rows.select(*[F.col(c).alias(v) for v, c in names.items()])


def joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Solutions that agree in their common variables, all bound; without any, every pair."""
    common = [c for c in left.columns if c in right.columns]
    if common:
        return left.join(right, common, how)
    return left.join(right, F.lit(True), how)


def compatible(left: DataFrame, right: DataFrame, loose: set[str], how: str = "inner", condition: Callable[[Callable[[str], Column]], Column] | None = None) -> DataFrame:
    """Pairs of compatible solutions; how "left" keeps solutions of left that have no pair.

    loose: variables that either side may leave unbound (null). An unbound one agrees with anything and
    takes the other side's value. Rows meet by equality of the variables that are bound on both sides:
    of the sure ones where there are any, else apart for each set of loose ones that is bound. condition:
    of the pair, given a variable's value in it, as a FILTER inside an OPTIONAL.
    """
    common = [c for c in left.columns if c in right.columns]
    unsure = [c for c in common if c in loose]
    sure = [c for c in common if c not in loose]
    if not unsure and condition is None:
        return joined(left, right, how)
    right = right.select(*[F.col(c).alias(f"__{c}") for c in right.columns])

    def value(v: str) -> Column:
        if v not in common:
            return F.col(v) if v in left.columns else F.col(f"__{v}") if f"__{v}" in right.columns else F.lit(None)
        return F.coalesce(v, f"__{v}") if v in unsure else F.col(v)

    def met(a: DataFrame, b: DataFrame, keys: list[str], kind: str) -> DataFrame:
        on = [F.col(c) == F.col(f"__{c}") for c in keys]
        on += [F.coalesce(F.col(c) == F.col(f"__{c}"), F.lit(True)) for c in unsure if c not in keys]
        on += [F.coalesce(condition(value), F.lit(False))] if condition else []
        both = a.join(b, reduce(lambda x, y: x & y, on), kind)
        return both.select(*[value(c).alias(c) for c in left.columns], *[F.col(c).alias(c[2:]) for c in right.columns if c[2:] not in common])

    if sure or not unsure:
        return met(left, right, sure, how)
    bound = [set(x) for x in chain.from_iterable(combinations(unsure, n) for n in range(len(unsure) + 1))]
    with_just = lambda df, some, mark: df.filter(reduce(lambda x, y: x & y, [F.col(mark + c).isNotNull() if c in some else F.col(mark + c).isNull() for c in unsure]))
    pairs = reduce(DataFrame.union, [met(with_just(left, x, ""), with_just(right, y, "__"), sorted(x & y), "inner") for x in bound for y in bound])
    if how == "inner":
        return pairs
    # a solution of left either pairs up or not, and so do all equal ones
    found = reduce(DataFrame.union, [_paired(with_just(left, x, ""), with_just(right, y, "__"), sorted(x & y), condition, value) for x in bound for y in bound])
    found = found.distinct().select(*[F.col(c).alias(f"__{c}") for c in left.columns])
    alone = left.join(found, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in left.columns]), "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def _paired(left: DataFrame, right: DataFrame, keys: list[str], condition, value) -> DataFrame:
    """The solutions of left that a pair has."""
    on = [F.col(c) == F.col(f"__{c}") for c in keys] + ([F.coalesce(condition(value), F.lit(False))] if condition else [])
    return left.join(right, reduce(lambda x, y: x & y, on) if on else F.lit(True), "left_semi")


def bgp(triples: Source, patterns: list[Pattern], before: DataFrame | None = None) -> DataFrame:
    """Solutions of all patterns together, and of what came before if its variables are bound.

    Each pattern is joined as soon as it shares a variable with those before, over a store the cheapest
    first. Paths come after the patterns that bind their subject, and follow only what these found.
    """
    counts = triples.counts([p for _, p, _ in patterns]) if isinstance(triples, Store) else None
    rest, out = list(patterns), before
    while rest:
        names = set() if out is None else set(out.columns)
        near = [k for k, x in enumerate(rest) if out is not None and names & {t[1:] for t in x if is_variable(t)}] or [*range(len(rest))]
        near = [k for k in near if not is_path(rest[k])] or near
        k = near[0] if counts is None else min(near, key=lambda k: (triples.cost(rest[k], counts), k))
        one = rest.pop(k)
        starts = out.select(F.col(one[0][1:]).alias("node")) if is_path(one) and one[0][1:] in names else None
        found = pattern(triples, one, starts)
        out = found if out is None else joined(out, found)
    return out


def optional(left: DataFrame, right: DataFrame) -> DataFrame:
    """left with the solutions of right where there are any; common variables are bound on both sides."""
    return joined(left, right, "left")


def union(*branches: DataFrame) -> DataFrame:
    """All solutions of the branches, variables a branch lacks unbound."""
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


_INTERACTION: list[Pattern] = [
    ("?intxn", V.EMI + "hasSource", "?source"),
    ("?intxn", V.EMI + "hasTarget", "?target"),
    ("?intxn", V.EMI + "isClassifiedWith", "?type"),
    ("?type", V.RDFS + "label", "?typeLabel"),
    ("?source", V.EMI + "inTaxon", "?sourceTaxon"),
    ("?source", V.RDFS + "label", "?sourceName"),
    ("?target", V.EMI + "inTaxon", "?targetTaxon"),
    ("?target", V.RDFS + "label", "?targetName"),
]


def interactions(triples: Source) -> DataFrame:
    """The labelled interactions between labelled, classified samples."""
    return bgp(triples, _INTERACTION)


def record_count(triples: Source) -> DataFrame:
    """(n_records): labelled interactions, a row per combination of labels."""
    return interactions(triples).agg(F.count(F.lit(1)).alias("n_records"))


def distinct_taxa(triples: Source) -> DataFrame:
    """(n_taxa): taxa on either side of a labelled interaction."""
    both = F.explode(F.array("sourceTaxon", "targetTaxon")).alias("taxon")
    return interactions(triples).select(both).agg(F.count_distinct("taxon").alias("n_taxa"))


def type_counts(triples: Source) -> DataFrame:
    """(n_species, n_traits, n_other): distinct organisms, trait results and other results of observations."""
    base = bgp(triples, [
        ("?organism", V.EMI + "inTaxon", "?taxon"), ("?sample", V.SOSA + "isSampleOf", "?organism"), ("?sample", V.SOSA + "isFeatureOfInterestOf", "?observation"),
        ("?observation", V.SOSA + "hasResult", "?data"), ("?data", V.RDFS + "label", "?label"), ("?data", V.RDF + "value", "?value"),
    ])
    out = base
    for name, kind in (("trait", "Trait"), ("other", "NonTrait")):
        out = optional(out, pattern(triples, ("?data", V.RDF + "type", V.EMI + kind)).select("data", F.col("data").alias(name)))
    return out.agg(F.count_distinct("organism").alias("n_species"), F.count_distinct("trait").alias("n_traits"), F.count_distinct("other").alias("n_other"))
