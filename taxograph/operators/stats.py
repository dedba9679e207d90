"""Trait matrices, correlation, principal components, strategy classes."""

from __future__ import annotations

import math

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph import vocab as V
from taxograph.functions import scalars as S

#: Quantile cells that ranks are summed up in.
CELLS = 256


def trait_matrix(df: DataFrame, species: str, trait: str, value: str, traits: list[str], complete: bool = True) -> DataFrame:
    """(species, a column per trait): means; with complete only species that have all of them."""
    number = S.to_number(F.col(value))
    rows = df.filter(F.col(species).isNotNull()).select(species, trait, number.alias("__x"))
    out = rows.groupBy(species).agg(*[F.avg(F.when(F.col(trait) == t, F.col("__x"))).alias(t) for t in traits])
    return out.na.drop() if complete else out


def recoded_traits(df: DataFrame, trait: str, codes: dict[str, str] = V.TRAIT_CODES) -> DataFrame:
    """df with trait_std, the code of its trait; other traits are out."""
    return df.withColumn("trait_std", S.lookup(codes, F.col(trait))).filter("trait_std is not null")


def mean_sd(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, mean, sd, n) with the sample deviation."""
    return df.groupBy(group).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"))


#: A round cuts the values that are left into so many bins; as few values as FEW are sorted at once.
BINS, FEW = 4096, 10_000


def kth_values(df: DataFrame, value: str, ranks: list[int]) -> list[float]:
    """The values at some ranks (from 0) in ascending order; NaN comes last. Null values are left out before.

    Each round counts the values between two bounds by bin and goes on in the bin that holds the rank,
    between the least and the greatest value in it, so that equal values end it at once. The driver sees
    BINS rows a round or FEW values, a task no more than its share of the rows.
    """
    v = F.col(value)
    rows = df.select(v.cast("double").alias("v")).filter("v is not null")
    low_end, high_end = F.lit(float("-inf")), F.lit(float("inf"))
    ends = rows.agg(F.count_if(F.col("v") == low_end), F.count_if(~F.col("v").isin(float("-inf"), float("inf")) & ~F.isnan("v")), F.count_if(F.col("v") == high_end)).first()
    finite = rows.filter((F.col("v") > low_end) & (F.col("v") < high_end))
    return [_kth(finite, k, *ends) for k in ranks]


def _kth(finite: DataFrame, k: int, below: int, n: int, above: int) -> float:
    if not below <= k < below + n:
        return float("-inf") if k < below else float("inf") if k < below + n + above else float("nan")
    k -= below
    low, high = finite.agg(F.min("v"), F.max("v")).first()
    while low < high:
        inside = finite.filter((F.col("v") >= low) & (F.col("v") <= high))
        if n <= FEW:
            return sorted(r[0] for r in inside.collect())[k]
        width = high / BINS - low / BINS
        at = F.least(F.floor((F.col("v") / width) - low / width), F.lit(BINS - 1)) if width > 0 else F.when(F.col("v") > low, 1).otherwise(0)
        bins = sorted(inside.groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
        for one in bins:
            if k < one["n"]:
                break
            k -= one["n"]
        if (one["low"], one["high"]) == (low, high):  # too close for bins: take the least value off
            least = inside.filter(F.col("v") == low).count()
            if k < least:
                return low
            k, n = k - least, n - least
            low = inside.filter(F.col("v") > low).agg(F.min("v")).first()[0]
        else:
            low, high, n = one["low"], one["high"], one["n"]
    return low


def median_of(df: DataFrame, value: str) -> DataFrame:
    """(median): exact, the mean of both middle values of an even number; null without values."""
    n = df.select(F.count(value)).first()[0]
    middle = sorted({(n - 1) // 2, n // 2}) if n else []
    found = kth_values(df, value, middle)
    return df.sparkSession.createDataFrame([(sum(found) / len(found) if found else None,)], "median double")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, low, high, n): equal bins from the least to the greatest value, the last one closed; empty bins too."""
    span = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = span.first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    width = (high - low) / bins or 1.0
    at = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(value).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) of every pair of columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def average_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """df with the average rank of each value.

    Ranks follow from the counts of distinct values, summed up per quantile cell and then inside each
    cell, so that no task sorts all values.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__c"))
    # the bucket is a function of the value alone: its quantile cell
    quantiles = F.percentile_approx(F.col(value).cast("double"), [k / CELLS for k in range(1, CELLS)])
    cells = counts.agg(quantiles.alias("q")).first()["q"] or []
    cuts = sorted(set(cells))
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(value).cast("double"))) if cuts else F.lit(0)
    placed = counts.withColumn("__bucket", at)
    sums = placed.groupBy("__bucket").agg(F.sum("__c").alias("__s"))
    before = sums.select("__bucket", (F.sum("__s").over(W.orderBy("__bucket")) - F.col("__s")).alias("__before"))
    inside = F.sum("__c").over(W.partitionBy("__bucket").orderBy(value)) - F.col("__c")
    ranked = placed.withColumn("__inside", inside).join(before, "__bucket").select(value, (F.col("__before") + F.col("__inside") + (F.col("__c") + 1) / 2).alias(out))
    return df.join(ranked, value)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """(r, n): rank correlation with average ranks for ties, over rows that have both."""
    rows = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    ranked = average_ranks(average_ranks(rows, a, "__ra"), b, "__rb")
    return ranked.agg(F.corr("__ra", "__rb").alias("r"), F.count(F.lit(1)).alias("n"))


def correlation_p(spark: SparkSession, r: float, n: int) -> float:
    """The two-sided p-value of a correlation, from the t distribution with n - 2 degrees of freedom."""
    if n <= 2 or r is None:
        return math.nan
    if abs(r) >= 1:
        return 0.0
    t = abs(r) * math.sqrt((n - 2) / (1 - r * r))
    return 2 * spark._jvm.org.apache.commons.math3.distribution.TDistribution(float(n - 2)).cumulativeProbability(-t)


def correlation_matrix(df: DataFrame, columns: list[str], method: str = "pearson") -> list[list[float]]:
    """The full matrix; columns are few, rows may be many."""
    rows = VectorAssembler(inputCols=columns, outputCol="__v", handleInvalid="skip").transform(df)
    return Correlation.corr(rows.select("__v"), "__v", method).first()[0].toArray().tolist()


def standardised(df: DataFrame, columns: list[str], out: str = "scaled", sample: bool = False) -> DataFrame:
    """df with the vector of columns at mean 0 and deviation 1, of the population unless sample."""
    rows = VectorAssembler(inputCols=columns, outputCol="__v").transform(df)
    scaled = StandardScaler(inputCol="__v", outputCol=out, withMean=True, withStd=True).fit(rows).transform(rows).drop("__v")
    if sample:
        return scaled
    n = df.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    from pyspark.ml.functions import array_to_vector

    return scaled.withColumn(out, array_to_vector(F.transform(vector_to_array(out), lambda x: x * factor)))


def pca(df: DataFrame, columns: list[str], k: int, anchor: str | None = None) -> tuple[DataFrame, list[float], list[list[float]]]:
    """(df with pc1..pck, explained variance ratios, loadings by column).

    Signs are fixed: the anchor's loading (else the largest) is positive in every component.
    """
    rows = standardised(df, columns)
    model = PCA(k=k, inputCol="scaled", outputCol="__pc").fit(rows)
    loads = model.pc.toArray()
    sign = []
    for j in range(k):
        own = loads[columns.index(anchor), j] if anchor else max(loads[:, j], key=abs)
        sign.append(-1.0 if own < 0 else 1.0)
    scores = vector_to_array("__pc")
    out = model.transform(rows).select(*df.columns, *[(scores[j] * sign[j]).alias(f"pc{j + 1}") for j in range(k)])
    return out, model.explainedVariance.toArray().tolist(), (loads * sign).tolist()


def strategies(matrix: DataFrame, columns: list[str], anchor: str = "SLA") -> DataFrame:
    """matrix with LES_score, the first component, and strategy: below, within or above one deviation."""
    scored, _, _ = pca(matrix, columns, 1, anchor)
    scored = scored.withColumnRenamed("pc1", "LES_score")
    sd = scored.agg(F.stddev_samp("LES_score")).first()[0]
    return scored.withColumn("strategy", S.three_bins(F.col("LES_score"), F.lit(sd)))


def diversity_by_strategy(metabolites: DataFrame, ids: DataFrame, scored: DataFrame, species_id: str = "source_wdx", item: str = "structure_inchikey", name: str = "sourceName") -> tuple[DataFrame, DataFrame]:
    """(per species, per strategy): distinct metabolites of scored species; mean, deviation and n by strategy.

    ids: (species_id, name) of species that passed the trait filter.
    """
    counts = metabolites.groupBy(species_id).agg(F.count_distinct(item).alias("n_metabolites"))
    per = counts.join(ids.select(species_id, name).distinct(), species_id).join(scored, name)
    return per, mean_sd(per, "strategy", "n_metabolites")

