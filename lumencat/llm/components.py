"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are a minimum per node (pre-aggregated before its shuffle) and a
join back, so no node's neighbours are ever gathered; a hot node is a skewed
join, which adaptive execution splits. Each round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

ROUNDS = 50
#: Parts of a class' nodes when they get its name, and of a hot node's rows when they get their class.
SALTS = 32
#: A node is hot if more than one of so many rows have it: no more than these can be.
HOT_SHARE = 1000


def _toward_minimum(pairs: DataFrame) -> DataFrame:
    """For each (u, v): v with the least of u and all that stand beside u."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of edges; root is the least node that it reaches.

    Null ends and self-links are ignored; an edge may repeat and may be given
    either way round; no edges: no rows.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    state = edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct()
    state, seen = checkpointed(state), None
    for _ in range(ROUNDS):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small = _toward_minimum(large)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        state = checkpointed(moved.where(F.col("u") != F.col("v")).distinct())
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def class_ids(rows: DataFrame, key: str, roots: DataFrame) -> DataFrame:
    """rows (with doc_id) and component_id in place of key: the smallest doc_id of all rows whose keys have one root.

    A key without a root is a class of its own, a row with a null key as well.
    """
    rest = [c for c in rows.columns if c != key]
    distinct = checkpointed(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    linked = distinct.join(roots.select(F.col("node").alias(key), "root"), key)
    # a class of very many keys is named in SALTS parts
    names = linked.groupBy("root").agg(F.min("least").alias("name")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = linked.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(names, ["root", "salt"]).select(key, "name", F.lit(True).alias("linked"))
    classes = distinct.join(named, key, "left").select(key, "n", F.when(F.col("linked"), F.col("name")).otherwise(F.col("least")).alias("component_id"))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(distinct.where(F.col("n") * HOT_SHARE > total).select(key, F.lit(SALTS).alias("parts")))  # HOT_SHARE rows at most
    parted = rows.where(F.col(key).isNotNull()).join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.coalesce("parts", F.lit(1))).cast("int"))
    classes = classes.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    found = parted.join(classes.select(key, "salt", "component_id"), [key, "salt"]).select(*rest, "component_id")
    return found.unionByName(rows.where(F.col(key).isNull()).select(*rest, F.col("doc_id").alias("component_id")))
