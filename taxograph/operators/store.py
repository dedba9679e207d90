"""A triple store of numbers: a dictionary of terms, triples of ids by predicate, counts per predicate.

A term's id is a hash of its kind, text and data type with the lowest bit cleared, so that encoding
is a projection without a join. The dictionary holds each term once; where terms share a hash, all
but one of them get odd ids of their own, and only then triples are joined with those few terms.
Joins of patterns compare 8-byte numbers; texts are looked up for what a query returns.

Layout of a folder: hashed (id, kind, value, dtype), the terms with their hashes; repeated, the ids found twice there, and
where there are any, terms, each once with its own id; triples (s, o) in a folder per predicate id,
predicates (p, name, triples, subjects, objects), others (the terms with odd ids) and dtypes. statements (as given) is there while they are encoded.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph.operators.lineage import reachable
from taxograph.operators.triples import ALONE, AMONG_OTHERS, NEWS, Graph
from taxograph.plans.session import split_bytes
from taxograph.sources.sinks import removed

#: Literals of at most so many data types are found by hash, else by a scan of the dictionary.
DTYPES = 1000
#: The ids of so many groups are sent to all tasks.
GROUPS = 100_000
#: What a task reads of statements and terms, which it holds while it makes them distinct.
SPLIT_MB = 16


def term_hash(kind: Column, value: Column, dtype: Column, bits: int = 64) -> Column:
    """An even number; bits below 64 are for tests of equal hashes."""
    h = F.xxhash64(kind, value, F.coalesce(dtype, F.lit("")))
    return F.shiftleft(F.shiftright(h, 64 - bits + 1), 1)


def subject_kind(s: Column) -> Column:
    return F.when(s.startswith("_:"), "bnode").otherwise("iri")


def _term(kind: Column, value: Column, dtype: Column, bits: int) -> Column:
    return F.struct(term_hash(kind, value, dtype, bits).alias("id"), kind.alias("kind"), value.alias("value"), dtype.alias("dtype"))


def _ends(bits: int) -> tuple[Column, Column, Column]:
    none = F.lit(None).cast("string")
    return _term(subject_kind(F.col("s")), F.col("s"), none, bits), _term(F.lit("iri"), F.col("p"), none, bits), _term(F.col("o_kind"), F.col("o"), F.col("o_dtype"), bits)


def write_store(triples: DataFrame | Graph, path: str, bits: int = 64) -> Store:
    """Encode triples (s, p, o, o_kind, o_dtype), which need not be a set, and write them to a folder.

    They are stored as texts first, since the dictionary and the ids each need a pass over them. A graph in parts is a
    set before that and says which statement introduces a term, so that neither its triples nor the terms of a
    single record are shuffled.
    """
    spark = (triples.shared if isinstance(triples, Graph) else triples).sparkSession
    given = triples.statements() if isinstance(triples, Graph) else triples.select("s", "p", "o", "o_kind", "o_dtype")
    _put(given, f"{path}/statements")
    with split_bytes(spark, SPLIT_MB):
        held = _encoded(spark, path, bits)
    removed(spark, f"{path}/statements")
    return held


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _encoded(spark: SparkSession, path: str, bits: int) -> Store:
    """The store of the statements in a folder."""
    triples = spark.read.parquet(f"{path}/statements")
    a_set = set(NEWS) <= set(triples.columns)
    s, p, o = _ends(bits)
    some = lambda end, column, how: (triples.filter(F.col(column) == how) if a_set else triples).select(end.alias("t")).select("t.*")
    # predicates made distinct on their own first: they are few
    names = triples.select("p").distinct().select(p.alias("t")).select("t.*")
    terms = names.union(some(s, "s_new", AMONG_OTHERS)).union(some(o, "o_new", AMONG_OTHERS)).distinct()
    if a_set:
        terms = terms.union(some(s, "s_new", ALONE)).union(some(o, "o_new", ALONE))
    _put(terms, f"{path}/hashed")
    terms = spark.read.parquet(f"{path}/hashed")
    # ids found twice: of terms with one hash, or of a term that two statements introduce
    _put(terms.groupBy("id").count().filter("count > 1").select("id"), f"{path}/repeated")
    repeated = spark.read.parquet(f"{path}/repeated")
    twice = terms.join(repeated, "id", "left_semi").distinct() if repeated.head(1) else terms.limit(0)
    # of terms with one hash the least keeps it; the others are few and numbered by one task
    order = W.partitionBy("id").orderBy("kind", "value", F.col("dtype").asc_nulls_first())
    later = twice.withColumn("k", F.row_number().over(order)).filter("k > 1")
    everywhere = W.orderBy("kind", "value", F.col("dtype").asc_nulls_first())
    _put(later.select((2 * F.row_number().over(everywhere) + 1).cast("long").alias("own"), "id", "kind", "value", "dtype"), f"{path}/others")
    others = spark.read.parquet(f"{path}/others")
    odd = bool(others.head(1))
    if repeated.head(1):
        whole = terms.join(repeated, "id", "left_anti").union(twice)
        _put(_renumbered(whole, others) if odd else whole, f"{path}/terms")

    rows = triples.select(s.alias("s"), p.alias("p"), o.alias("o"))
    for c in ("s", "p", "o"):
        if odd:
            kept = [x for x in ("s", "p", "o") if x != c]
            rows = _renumbered(rows.select(*kept, f"{c}.*"), others, kept).select(*kept, F.struct("id", "kind", "value", "dtype").alias(c))
    rows = rows.select(F.col("s.id").alias("s"), F.col("p.id").alias("p"), F.col("o.id").alias("o"))
    # a set of triples is a set of ids, and each task writes what it reads; others go to tasks by their predicates
    rows = rows if a_set else rows.distinct().hint("rebalance", "p")
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("p").parquet(f"{path}/triples")

    held = Store(spark, path, bits)
    ids = spark.read.parquet(f"{path}/triples")
    counts = ids.groupBy("p").agg(F.count(F.lit(1)).alias("triples"), F.approx_count_distinct("s").alias("subjects"), F.approx_count_distinct("o").alias("objects"))
    names = held.terms.filter("kind = 'iri'").select(F.col("id").alias("p"), F.col("value").alias("name"))
    # a row a predicate, of which there are few; shuffled, since coalesce would make one task read the dictionary
    names.join(F.broadcast(counts), "p").select("p", "triples", "subjects", "objects", "name").repartition(1).write.mode("overwrite").parquet(f"{path}/predicates")
    held.terms.filter("kind = 'literal'").select("dtype").distinct().repartition(1).write.mode("overwrite").parquet(f"{path}/dtypes")
    return held


def _renumbered(rows: DataFrame, others: DataFrame, kept: list[str] = ()) -> DataFrame:
    """rows (id, kind, value, dtype, kept) with the own ids of terms that share a hash."""
    few = others.select(*[F.col(c).alias(f"__{c}") for c in ("own", "id", "kind", "value", "dtype")])
    same = (F.col("id") == F.col("__id")) & (F.col("kind") == F.col("__kind")) & (F.col("value") == F.col("__value")) & F.col("dtype").eqNullSafe(F.col("__dtype"))
    return rows.join(few, same, "left").select(*kept, F.coalesce("__own", "id").alias("id"), "kind", "value", "dtype")


@dataclass
class Store:
    """A written store; patterns over it are solved on ids."""

    spark: SparkSession
    path: str
    bits: int = 64

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @cached_property
    def terms(self) -> DataFrame:
        return self._read("terms" if self._read("repeated").head(1) else "hashed")

    @cached_property
    def triples(self) -> DataFrame:
        return self._read("triples").select(F.col("s"), F.col("p").cast("long").alias("p"), F.col("o"))

    @cached_property
    def predicates(self) -> DataFrame:
        return self._read("predicates")

    @cached_property
    def _odd(self) -> bool:
        return bool(self._read("others").head(1))

    @cached_property
    def _dtypes(self) -> list[str | None] | None:
        found = [r["dtype"] for r in self._read("dtypes").limit(DTYPES + 1).collect()]
        return found if len(found) <= DTYPES else None

    def ids_of(self, text: str, predicate: bool = False) -> list[int]:
        """The ids of the terms with a text, whatever their kind: hashes, and the few own ids."""
        if self._dtypes is None and not predicate:
            return [r["id"] for r in self.terms.filter(F.col("value") == text).select("id").collect()]
        none = F.lit(None).cast("string")
        kinds = [("iri", none)] if predicate else [("iri", none), ("bnode", none), *(("literal", F.lit(d).cast("string")) for d in self._dtypes)]
        hashes = self.spark.range(1).select(*[term_hash(F.lit(k), F.lit(text), d, self.bits).alias(f"h{n}") for n, (k, d) in enumerate(kinds)]).first()
        if not self._odd:
            return list(dict.fromkeys(hashes))
        held = self._read("others").filter(F.col("value") == text).select("own", "id", "kind", "dtype").collect()
        kept = self.terms.filter((F.col("value") == text) & F.col("id").isin(list(hashes))).select("id", "kind").collect()
        return [r["own"] for r in held if not predicate or r["kind"] == "iri"] + [r["id"] for r in kept if not predicate or r["kind"] == "iri"]

    def counts(self, predicates: list[str]) -> dict[str, tuple[int, int, int]]:
        """(triples, subjects, objects) of some predicates, as stored."""
        rows = self.predicates.filter(F.col("name").isin(predicates)).collect()
        return {r["name"]: (r["triples"], r["subjects"], r["objects"]) for r in rows}

    def pattern(self, one: tuple[str, str, str], starts: DataFrame | None = None) -> DataFrame:
        """Solutions of one pattern, ids by variable; starts: (node) the only subjects of a path that matter."""
        s, p, o = one
        if p.endswith("*") and not p.startswith("?"):
            edges = self.triples.filter(F.col("p").isin(self.ids_of(p[:-1], predicate=True))).select("s", "o")
            if starts is None:
                starts = self.triples.select(F.col("s").alias("node")).union(self.triples.select("o"))
                starts = starts.filter(F.col("node").isin(self.ids_of(s))) if not s.startswith("?") else starts
            rows = reachable(edges, starts).toDF("s", "o").withColumn("p", F.lit(0))
        else:
            rows = self.triples if p.startswith("?") else self.triples.filter(F.col("p").isin(self.ids_of(p, predicate=True)))
        names: dict[str, str] = {}
        for column, term in (("s", s), ("p", p), ("o", o)):
            if not term.startswith("?"):
                if column != "p":
                    rows = rows.filter(F.col(column).isin(self.ids_of(term)))
            elif term[1:] in names:
                rows = rows.filter(F.col(column) == F.col(names[term[1:]]))
            else:
                names[term[1:]] = column
        return rows.select(*[F.col(c).alias(v) for v, c in names.items()])

    def cost(self, one: tuple[str, str, str], counts: dict[str, tuple[int, int, int]]) -> float:
        """About how many solutions a pattern has, from the stored counts; paths come last."""
        s, p, o = one
        if p.startswith("?") or p.endswith("*"):
            return float("inf")
        n, subjects, objects = counts.get(p, (0, 1, 1))
        return n / (1 if s.startswith("?") else max(subjects, 1)) / (1 if o.startswith("?") else max(objects, 1))

    def decoded(self, df: DataFrame, variables: list[str], grouped: bool = False) -> DataFrame:
        """df with the texts of some variables in place of their ids; an unbound one stays null.

        grouped: df has a row a group, and is written before; the ids of few groups are sent to the dictionary,
        which else is shuffled.
        """
        terms = self.terms
        if grouped and variables:
            _put(df, out := f"{self.path}/answers-{uuid.uuid4().hex}")
            df = self.spark.read.parquet(out)
            if df.count() <= GROUPS:
                wanted = df.select(F.explode(F.array(*variables)).alias("id")).distinct()
                terms = terms.join(F.broadcast(wanted), "id", "left_semi")
        for v in variables:
            texts = terms.select(F.col("id").alias(f"__{v}"), F.col("value").alias("__value"))
            rest = [c for c in df.columns if c != v]
            df = df.join(texts, df[v] == texts[f"__{v}"], "left").select(*rest, F.col("__value").alias(v))
        return df
