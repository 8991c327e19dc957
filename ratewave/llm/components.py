"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import materialize


def _edges(rows: DataFrame) -> DataFrame:
    """(a, b) with a < b, each once."""
    rows = rows.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return materialize(rows.distinct(), "component_links")


def components(links: DataFrame) -> DataFrame:
    """rep, comp for every end of the links (a, b): comp is the smallest end reachable.

    In each round every vertex with a smaller neighbour hangs on the smallest one, the
    chains are shortened by pointer doubling to their roots, and the links are drawn anew
    between roots.  At least half of the vertices that still have links go in a round, so
    rounds are few and the links' joins shrink.  Tables are written to the shared folder,
    which cuts lineage; a hub's links are partly aggregated before they move.
    """
    edges = _edges(links)
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).distinct()
    labels = ends.select("rep", F.col("rep").alias("comp"))
    while not edges.isEmpty():
        hung = materialize(edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root")), "component_roots")
        while True:
            up = hung.select(F.col("v").alias("root"), F.col("root").alias("next"))
            further = hung.join(up, "root", "left")
            if further.where("next IS NOT NULL").isEmpty():
                break
            hung = materialize(further.select("v", F.coalesce("next", "root").alias("root")), "component_roots")
        as_ = lambda name, to: hung.select(F.col("v").alias(name), F.col("root").alias(to))
        labels = labels.join(as_("comp", "root"), "comp", "left").select("rep", F.coalesce("root", "comp").alias("comp"))
        labels = materialize(labels, "component_labels")
        drawn = edges.join(as_("a", "ra"), "a", "left").join(as_("b", "rb"), "b", "left")
        edges = _edges(drawn.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    return labels
