"""SQL access to the detectors: find_pii(text) as a table function, luhn and iban as functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from . import detect


class FindPii:
    """A row for each finding in a text, overlaps resolved."""

    def eval(self, text: str):
        if text is not None:
            yield from detect.resolve(detect.analyze(text))


def register(spark: SparkSession) -> None:
    spark.udtf.register("find_pii", udtf(FindPii, returnType="entity string, start int, end int, score double"))
