"""Landed pages of a portal in the order of their links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.operators.joins import lookup
from citylake.operators.schema import named
from citylake.session import materialise


def in_link_order(pages: DataFrame, link: str, following: str) -> DataFrame:
    """``pages`` with ``page_no``, from 0 at a page that no other leads to, and ``chain``, the link of that page.

    Pages may have landed in any order. Each round doubles the stretch that a page knows of the way behind it, so a
    chain of n pages takes about log2(n) joins. Pages in a ring have no first one: null. Pages of one link (landed
    twice) get the same number. Of several pages that lead to one page, the least link counts.
    """
    own, after = named(link).alias("page"), named(following).alias("after")
    known = pages.select(own).where("page IS NOT NULL").distinct()
    # What leads to a page; missing pages do not lead anywhere.
    before = pages.select(own, after).where("page IS NOT NULL AND after IS NOT NULL").groupBy(F.col("after").alias("_after")).agg(F.min("page").alias("back"))
    jump = lookup(known, before, {"_after": F.col("page")}, "left").drop("_after")
    jump = materialise(jump.withColumn("steps", F.when(F.col("back").isNull(), 0).otherwise(1).cast("bigint")).withColumn("root", F.when(F.col("back").isNull(), F.col("page"))), "pages")
    rounds = max(1, known.count()).bit_length()
    for _ in range(rounds):
        if jump.where("root IS NULL").isEmpty():
            break
        far = jump.select(F.col("page").alias("_page"), F.col("back").alias("_back"), F.col("steps").alias("_steps"), F.col("root").alias("_root"))
        met = lookup(jump, far, {"_page": F.coalesce("back", "page")}, "left")
        more = F.col("root").isNull()
        jump = materialise(met.select(
            "page", F.when(more, F.col("_back")).otherwise(F.col("back")).alias("back"),
            F.when(more, F.col("steps") + F.col("_steps")).otherwise(F.col("steps")).alias("steps"),
            F.coalesce("root", "_root").alias("root"),
        ), "pages")
    places = jump.select(F.col("page").alias("_page"), F.when(F.col("root").isNotNull(), F.col("steps")).alias("page_no"), F.col("root").alias("chain"))
    return lookup(pages, places, {"_page": named(link)}, "left").drop("_page")


def missing_pages(pages: DataFrame, link: str, following: str) -> DataFrame:
    """Links that a landed page leads to and that have not landed: (``page``, ``linked_from``)."""
    landed = pages.select(named(link).alias("_page")).distinct()
    wanted = pages.select(named(following).alias("page"), named(link).alias("linked_from")).where("page IS NOT NULL").distinct()
    return wanted.join(landed, F.col("page") == F.col("_page"), "left_anti")
