"""A data source over a paged search service; how a page is fetched comes from outside."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.scalars import json_text, mime_suffix, strip_html
from ..operators.ranking import capped


class Query(InputPartition):
    def __init__(self, label: str, text: str) -> None:
        self.label, self.text = label, text


class SearchReader(DataSourceReader):
    """One task for each query; pages follow until the limit or the last one."""

    def __init__(self, options: dict[str, str], fetch: Callable) -> None:
        self.queries = json.loads(options["queries"])
        self.limit, self.fetch = int(options.get("limit", "5")), fetch

    def partitions(self) -> list[InputPartition]:
        return [Query(label, text) for label, texts in self.queries.items() for text in texts]

    def read(self, partition: Query) -> Iterator[tuple]:
        token, n = None, 0
        while n < self.limit:
            hits, token = self.fetch(partition.text, token)
            for hit in hits[: self.limit - n]:
                yield partition.label, partition.text, n, json.dumps(hit)
                n += 1
            if token is None or not hits:
                return


def source_over(fetch: Callable) -> type[DataSource]:
    """A source with options queries (JSON: label to texts) and limit for each query; fetch takes a text and a page token and gives hits and the next token."""

    class SearchSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_search"

        def schema(self) -> str:
            return "label string, query string, position int, info string"

        def reader(self, schema) -> SearchReader:
            return SearchReader(self.options, fetch)

    return SearchSource


def search(spark: SparkSession, queries: dict[str, list[str]], fetch: Callable, per_query: int = 5, per_label: int = 10) -> DataFrame:
    """Hits by label: what each query finds, at most per_query of it, and per_label over all."""
    spark.dataSource.register(source_over(fetch))
    found = spark.read.format("paged_search").options(queries=json.dumps(queries), limit=str(per_query)).load()
    return capped(found, ["label"], [F.col("query"), F.col("position")], per_label)


def sidecars(hits: DataFrame) -> DataFrame:
    """The licence record of each hit (info: JSON as image services give it); missing and empty fields read Unknown."""
    info = F.col("info")
    meta = lambda field: strip_html(json_text(info, f"$.extmetadata.{field}.value"))
    return hits.select(
        json_text(info, "$.title").alias("title"), F.lit("search").alias("source"), json_text(info, "$.descriptionurl").alias("source_url"),
        json_text(info, "$.thumburl", "").alias("_thumb"), json_text(info, "$.url").alias("_url"), meta("LicenseShortName").alias("license_short"), meta("UsageTerms").alias("license_long"),
        meta("LicenseUrl").alias("license_url"), meta("Artist").alias("artist"), meta("Credit").alias("credit"), meta("DateTime").alias("datetime"), mime_suffix(json_text(info, "$.mime")).alias("suffix"),
    ).withColumn("thumb_url", F.coalesce(F.nullif("_thumb", F.lit("")), "_url")).drop("_thumb", "_url")
