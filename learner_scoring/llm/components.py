"""Connected components of links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import BROADCAST_ROWS, cut

#: Rows of links for which a round has a task more, and the tasks it may always have.
TASK_ROWS, LEAST_TASKS = 1 << 15, 8


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp) for every id in ``links``: comp is the smallest id it can reach.

    Each round gives an id, and the root it points at, the smallest root among
    its neighbours, then halves the way to the root. Rounds grow with the
    logarithm of the longest chain; a hub's links are combined per task.

    Every round writes files per task and shuffle, so its tasks go by the counted
    links, and a table of few roots is sent to them instead of shuffled.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = cut(pairs.union(pairs.select("v", "u")).distinct())
    tasks = max(LEAST_TASKS, edges.count() // TASK_ROWS)
    edges = edges.coalesce(tasks)
    roots = edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("comp"))
    roots = cut(roots.coalesce(tasks))
    few = roots.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # the ids are the same in every round

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    while True:
        of_v = roots.select(F.col("id").alias("v"), F.col("comp").alias("vc"))
        of_u = roots.select(F.col("id").alias("u"), F.col("comp").alias("uc"))
        near = edges.join(sent(of_v), "v").groupBy("u").agg(F.min("vc").alias("low")).join(sent(of_u), "u")
        hooked = near.select(F.col("u").alias("id"), F.least("low", "uc").alias("c")).union(near.select("uc", F.least("low", "uc")))
        hooked = hooked.groupBy("id").agg(F.min("c").alias("c"))
        jump = hooked.select(F.col("id").alias("c"), F.col("c").alias("cc"))
        new = hooked.join(sent(jump), "c").select("id", F.least("c", "cc").alias("comp"))
        old = roots.select("id", F.col("comp").alias("before"))
        both = cut(new.join(sent(old), "id").coalesce(tasks))
        roots = both.select("id", "comp")
        if both.filter("comp <> before").isEmpty():
            return roots
