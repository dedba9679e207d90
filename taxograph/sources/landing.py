"""Results of an endpoint landed page by page: what broke off is fetched again alone.

Each page is a task that streams its answer; Spark writes the rows, so any file system serves and
nothing passes through the driver. The last row of a page is its mark: `ended`, or what broke it. The
marks are the manifest: a page counts only with its `ended` row, and a run that died is taken up
where its last wave was committed.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxograph.sources import sparql_http

HELD = ["fetch_page", "fetch_seq", "fetch_mark"]


def _schema(query: str) -> T.StructType:
    names = sparql_http.variables(query)
    if clash := sorted({"fetch_run", "row_id", *HELD} & set(names)):
        raise ValueError(f"the query has variables of the landing's own names: {clash}")
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _stored(spark: SparkSession, query: str, to: str) -> DataFrame:
    own = T.StructType.fromDDL("fetch_page int, fetch_seq long, fetch_mark string")
    return spark.read.schema(T.StructType([*own.fields, *_schema(query).fields, T.StructField("fetch_run", T.StringType())])).parquet(to)


def manifest(spark: SparkSession, query: str, to: str) -> DataFrame:
    """(fetch_run, fetch_page, rows, fetch_mark) of every page tried; reads the marks alone."""
    return _stored(spark, query, to).filter("fetch_mark is not null").select("fetch_run", "fetch_page", F.col("fetch_seq").alias("rows"), "fetch_mark")


def landed(spark: SparkSession, query: str, to: str, page_rows: int) -> DataFrame:
    """The rows of all pages that ended, with a row_id in the order of the query; repeated landings of a page count once."""
    whole = manifest(spark, query, to).filter("fetch_mark = 'ended'").groupBy("fetch_page").agg(F.min("fetch_run").alias("fetch_run"))
    rows = _stored(spark, query, to).filter("fetch_mark is null").join(whole, ["fetch_page", "fetch_run"], "left_semi")
    return rows.withColumn("row_id", F.col("fetch_page").cast("long") * page_rows + F.col("fetch_seq")).drop("fetch_run", *HELD)


def land(spark: SparkSession, endpoint: str, query: str, to: str, page_rows: int = 1_000_000, wave: int = 64, attempts: int = 3, accept: str = "text/csv") -> DataFrame:
    """Fetches the query in pages of page_rows into the folder `to`, and returns what landed.

    The query should have an ORDER BY, or its pages may overlap. Pages are asked for in waves until one is short.
    Landed pages are not asked for again, in this run or a later one; a page that breaks `attempts` times
    in one run raises, and leaves the others landed; rows beyond a short page raise too. The driver keeps a number a page.
    """
    spark.dataSource.register(sparql_http.SparqlSource)
    spark.createDataFrame([], "fetch_page int, fetch_seq long, fetch_mark string").write.mode("overwrite").parquet(f"{to}/fetch_run=r")
    tried: Counter[int] = Counter()
    while True:
        tried_pages = manifest(spark, query, to).select("fetch_page", "rows", "fetch_mark").collect()
        ended = {r.fetch_page: r.rows for r in tried_pages if r.fetch_mark == "ended"}
        last = min((p for p, n in ended.items() if n < page_rows), default=None)
        if beyond := sorted(p for p, n in ended.items() if last is not None and p > last and n):
            raise RuntimeError(f"page {last} was short, but {len(beyond)} later pages hold rows: the endpoint cuts answers below page_rows, or its data changed")
        until = last if last is not None else max(ended, default=-1) + 1 + wave
        todo = [p for p in range(until) if p not in ended][:wave]
        if not todo:
            return landed(spark, query, to, page_rows)
        tried.update(todo)
        if worn := [p for p in todo if tried[p] > attempts]:
            why = {r.fetch_page: r.fetch_mark for r in tried_pages if r.fetch_page in worn and r.fetch_mark != "ended"}
            raise RuntimeError(f"pages that broke off {attempts} times: {why}")
        options = {"endpoint": endpoint, "query": query, "accept": accept, "page_rows": page_rows, "pages": ",".join(map(str, todo)), "marks": "true"}
        spark.read.format("sparql").options(**options).load().write.parquet(f"{to}/fetch_run=r{uuid.uuid4().hex}")
