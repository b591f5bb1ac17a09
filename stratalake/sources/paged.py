"""Paged service reads: waves of pages, one Spark task per page, up to the first short page."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stratalake.session import scratch

#: Answers worth another try.
RETRY_STATUS = (429, 500, 502, 503, 504)


class Page(InputPartition):
    def __init__(self, number: int):
        self.value = number


def _fetch(url: str, timeout: float, attempts: int) -> list:
    for attempt in range(attempts + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as response:
                payload = json.load(response)
            break
        except urllib.error.HTTPError as error:
            if error.code not in RETRY_STATUS or attempt == attempts:
                raise
        except urllib.error.URLError as error:
            # A page file that is not there is a page past the end.
            if url.startswith("file:") and isinstance(error.reason, FileNotFoundError):
                return []
            if attempt == attempts:
                raise
        time.sleep(2**attempt)
    if not isinstance(payload, list):
        raise ValueError(f"payload of {url} is not a JSON list")
    return payload


class PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        # Option names arrive in lower case; parameter names are written "filter.<name>".
        self.url = options["url"]
        self.per_page = int(options.get("per_page", 50))
        if "max_pages" not in options:
            raise ValueError("max_pages must be given: pages beyond it are not read")
        self.first_page = int(options.get("first_page", 1))
        self.max_pages = int(options["max_pages"])
        self.timeout = float(options.get("timeout", 30))
        self.attempts = int(options.get("retry_attempts", 3))
        self.required = [f for f in options.get("required_fields", "").split(",") if f]
        self.filters = {
            k[len("filter.") :]: v for k, v in dict(options).items() if k.startswith("filter.")
        }

    def partitions(self):
        return [Page(number) for number in range(self.first_page, self.max_pages + 1)]

    def page_url(self, page: int) -> str:
        if "{page}" in self.url:
            return self.url.format(page=page, per_page=self.per_page)
        query = urllib.parse.urlencode({**self.filters, "per_page": self.per_page, "page": page})
        return f"{self.url}?{query}"

    def read(self, partition):
        rows = _fetch(self.page_url(partition.value), self.timeout, self.attempts)
        if rows and not set(self.required) <= set(rows[0]):
            raise ValueError("payload lacks required fields")
        for position, row in enumerate(rows):
            yield partition.value, position, json.dumps(row, ensure_ascii=False)


class PagedSource(DataSource):
    """``spark.read.format("paged_json")``: columns page, position and the record as JSON text."""

    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return "page int, position int, record string"

    def reader(self, schema):
        return PagedReader(self.options)


def read_pages(spark: SparkSession, url: str, per_page: int, max_pages: int, wave: int | None = None, **options: object) -> DataFrame:
    """All records up to the first short page. ``url`` may hold ``{page}``; ``None`` options are left out.

    Pages are fetched in waves of ``wave`` (as many as tasks run at once, unless given); the pull ends with the wave
    that holds a short page, so at most one wave is asked for beyond it. Waves are stored, so every page is fetched
    once and the cut judges the very rows it returns.
    """
    spark.dataSource.register(PagedSource)
    schema = "page int, position int, record string"
    step = spark.sparkContext.defaultParallelism if wave is None else wave
    if step < 1:
        raise ValueError(f"a wave needs a page: {step}")
    given = {key: str(value) for key, value in options.items() if value is not None}
    root = scratch(spark, "pages")
    paths: list[str] = []
    for first in range(1, max_pages + 1, step):
        last = min(first + step - 1, max_pages)
        paths.append(f"{root}/from-{first}")
        reader = spark.read.format("paged_json").options(**given).option("url", url).option("per_page", per_page)
        reader.option("first_page", first).option("max_pages", last).load().write.parquet(paths[-1])
        counts = spark.read.schema(schema).parquet(paths[-1]).groupBy("page").count()
        if counts.where(F.col("count") >= per_page).count() <= last - first:
            break
    if not paths:
        return spark.createDataFrame([], schema)
    return cut_pages(spark.read.schema(schema).parquet(*paths), per_page, max_pages)


def cut_pages(df: DataFrame, per_page: int, max_pages: int | None = None, page: str = "page") -> DataFrame:
    """Rows of the leading full pages and of the first short one.

    A page ends the pull when it holds fewer than ``per_page`` rows or when the page
    after it is missing. Only page counts are joined; the cut itself is one value.
    """
    counts = df.groupBy(page).agg(F.count(F.lit(1)).alias("n"))
    if max_pages is not None:
        counts = counts.where(F.col(page) <= max_pages)
    # Each page also announces its successor; a page nobody fills is the gap.
    marks = counts.select(
        F.explode(
            F.array(
                F.struct(F.col(page).alias("p"), F.col("n").alias("n")),
                F.struct((F.col(page) + 1).alias("p"), F.lit(0).cast("long").alias("n")),
            )
        ).alias("m")
    ).select("m.p", "m.n")
    first = df.sparkSession.range(1).select(F.lit(1).alias("p"), F.lit(0).cast("long").alias("n"))
    filled = marks.unionByName(first).groupBy("p").agg(F.max("n").alias("n"))
    cut = filled.where(F.col("n") < per_page).agg(F.min("p").alias("_cut"))
    limit = F.col(page) <= F.col("_cut")
    if max_pages is not None:
        limit = limit & (F.col(page) <= max_pages)
    # One row, so the broadcast has a fixed size.
    return df.join(F.broadcast(cut), limit & (F.col(page) >= 1)).drop("_cut")
