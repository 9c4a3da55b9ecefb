"""A table of looked-up categories that grows with every look-up.

Keyed by domain. A domain that nothing was found for is stored with a null category, so it
is not asked for again. The table is versioned: an update writes the next version whole and
readers change over once that is committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake import storage
from linklake.operators.enrich import unknown_domains

ENTRY = "domain string, category string"


def cached_categories(spark: SparkSession, folder: str) -> DataFrame:
    """``domain, category`` of all domains ever asked for; empty before the first time."""
    known = storage.versions(spark, folder)
    return storage.read_version(spark, folder, known[-1], ENTRY) if known else spark.createDataFrame([], ENTRY)


def store_answers(asked: DataFrame, answers: DataFrame, folder: str) -> None:
    """Put the answers for the asked domains in place of their entries, if they have any.

    Of several answers for a domain the least category stands; a domain without an answer gets a null.
    Answers for domains that were not asked for are passed over.
    """
    spark = asked.sparkSession
    known = storage.versions(spark, folder)
    best = answers.groupBy("domain").agg(F.min("category").alias("category"))
    entries = asked.select("domain").where("domain is not null").distinct().join(best, "domain", "left")
    entries = storage.written(entries.select("domain", "category"), "answers")
    kept = cached_categories(spark, folder).join(entries.select("domain"), "domain", "left_anti")
    storage.write_version(kept.unionByName(entries), folder, known[-1] + 1 if known else 0)


def look_up(domains: DataFrame, folder: str, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Categories of the domains: from the table, and for the rest from ``ask``, which takes
    a table of ``domain`` and gives ``domain, category`` where it found something.

    ``ask`` sees each domain once, over all runs. Answers are stored before they are used.
    """
    spark = domains.sparkSession
    # Stored before the null test, which would be pushed below the grouping the domains come from.
    wanted = storage.written(domains.select("domain").distinct(), "wanted").where("domain is not null")
    asked = storage.written(unknown_domains(wanted, cached_categories(spark, folder)), "asked")
    if asked.limit(1).count():
        store_answers(asked, ask(asked), folder)
    return wanted.join(cached_categories(spark, folder), "domain")
