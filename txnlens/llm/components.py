"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every end of ``links`` (a, b): the smallest id that can
    be reached. Each round takes the smallest label among the neighbours and
    then the label of that label, so long chains halve; labels are written
    every round. Neighbours are aggregated before they are moved."""
    ends = links.select("a", "b").where("a <> b")
    e = stored(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    lab = stored(e.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("comp")), "cc")
    while True:
        near = e.join(lab.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("least"))
        new = lab.join(near, "id").select("id", "comp", F.least("comp", "least").alias("next"))
        of = lab.select(F.col("id").alias("next"), F.col("comp").alias("beyond"))
        new = stored(new.join(of, "next").select("id", F.col("comp").alias("was"), F.least("next", "beyond").alias("comp")), "cc")
        changed = new.where("was <> comp").limit(1).count()
        lab = new.select("id", "comp")
        if not changed:
            return lab
