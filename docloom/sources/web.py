"""Pages from the web as a batch data source: one partition for each group of URLs.

A page that cannot be fetched gives a row with null html and the error, so one failure stops nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SAFE = "/:?#[]@!$&'()*+,;=~%"
TIMEOUT = 30


def fetch_html(url: str, timeout: float = TIMEOUT, opener=urlopen) -> str:  # noqa: ANN001
    """The text of a page; bytes that are no UTF-8 are left out."""
    request = Request(quote(url, safe=SAFE), headers={"User-Agent": "Mozilla/5.0"})
    with opener(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8", errors="ignore")


class UrlPartition(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.size = int(options.get("urls_per_partition", "16"))
        self.timeout = float(options.get("timeout", TIMEOUT))

    def partitions(self) -> list[UrlPartition]:
        return [UrlPartition(self.urls[k : k + self.size]) for k in range(0, len(self.urls), self.size)] or [UrlPartition([])]

    def read(self, partition: UrlPartition):  # noqa: ANN201
        for url in partition.urls:
            try:
                yield url, fetch_html(url, self.timeout), None
            except Exception as error:  # noqa: BLE001  reported as a row
                yield url, None, str(error)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docloom_pages"

    def schema(self) -> str:
        return "url string, html string, error string"

    def reader(self, schema) -> PageReader:  # noqa: ANN001
        return PageReader(self.options)


def read_pages(spark: SparkSession, urls: list[str] | DataFrame, per_partition: int = 16) -> DataFrame:
    """(url, html, error) of pages. A list travels as an option of the source; a table (url) of any size is fetched where it lies."""
    if isinstance(urls, DataFrame):
        return fetch_table(urls)
    spark.dataSource.register(PageSource)
    return spark.read.format("docloom_pages").option("urls", "\n".join(urls)).option("urls_per_partition", per_partition).load()


def fetch_table(urls: DataFrame, timeout: float = TIMEOUT) -> DataFrame:
    """(url, html, error) for each url of a table; failures are rows."""

    def fetched(url: str) -> tuple[str, str | None, str | None]:
        try:
            return url, fetch_html(url, timeout), None
        except Exception as error:  # noqa: BLE001  reported as a row
            return url, None, str(error)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                if url:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in fetched(url)], names=["url", "html", "error"])

    return urls.select("url").mapInArrow(run, "url string, html string, error string")
