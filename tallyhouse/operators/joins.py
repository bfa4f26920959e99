"""Joins that stay balanced when one key holds a large share of the rows.

Spark's adaptive execution splits a hot partition of either side of an inner join
and of the left side of a left, semi or anti join. Most operators here are put
together from those joins, and every semi or anti join looks its keys up in a
distinct (so pre-aggregated) key list. The full join cuts hot keys itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def semi_join(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``."""
    known = keys.select(F.col(right_key).alias("_known")).filter("_known is not null").distinct()
    return df.join(known, df[left_key] == known["_known"], "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys`` (NULL keys are kept)."""
    known = keys.select(F.col(right_key).alias("_known")).filter("_known is not null").distinct()
    return df.join(known, df[left_key] == known["_known"], "left_anti")


def either_key_left_join(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    alternate_key: str,
    child_ref: str,
    prefix: str = "child_",
) -> DataFrame:
    """``parents`` LEFT JOIN ``children`` ON ref = parent_key OR ref = alternate_key.

    An OR condition would be a nested loop over both tables. Instead each parent
    is listed once per distinct key it answers to, which makes the match an inner
    equi-join whose hot keys can be split on either side, and the parents that
    matched by neither key are added back.

    ``parent_key`` must be unique and not NULL. Columns of ``children`` get ``prefix``.
    """
    answers_to = parents.withColumn(
        "_ref", F.explode(F.array_distinct(F.array_compact(F.array(parent_key, alternate_key))))
    )
    renamed = children.select([F.col(c).alias(prefix + c) for c in children.columns])
    families = answers_to.join(renamed, F.col("_ref") == F.col(prefix + child_ref)).drop("_ref")

    # A parent without alternate key is looked up by its own key again: NULLs, which are
    # common here, would all meet in one partition.
    childless = anti_join(parents, children, parent_key, child_ref)
    childless = anti_join(
        childless.withColumn("_other", F.coalesce(alternate_key, parent_key)), children, "_other", child_ref
    ).drop("_other")
    return families.unionByName(childless, allowMissingColumns=True)


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], slice_rows: int = 1024) -> DataFrame:
    """Full outer equi-join that coalesces the keys; NULL keys match nothing.

    Columns other than ``keys`` must have different names on the two sides. A full outer join
    can't be split when a key is hot. Here both sides are one table, whose rows are counted per key
    and side. A key's rows are cut into slices of about ``slice_rows`` by a hash of the row; every
    slice of one side meets every slice of the other in a group of its own, which lists its pairs,
    or the rows of one side if the other has none. So a hot key becomes many small groups. Rows
    that repeat each other in all columns share a slice.
    """
    keys = list(keys)
    rest = [[c for c in side.columns if c not in keys] for side in (left, right)]
    whole = [F.struct(F.lit(True).alias("_is"), *names) for names in rest]
    both = left.select(*keys, whole[0].alias("_l")).unionByName(right.select(*keys, whole[1].alias("_r")), allowMissingColumns=True)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    one, none = F.lit(1), F.lit(0)
    entries = left.select(*keys, one.alias("l"), none.alias("r")).unionByName(right.select(*keys, none.alias("l"), one.alias("r")))
    sizes = entries.filter(known).groupBy(*keys).agg(F.sum("l").alias("_n_l"), F.sum("r").alias("_n_r"))
    sized = both.filter(known).join(sizes, keys)

    slices = {s: F.ceil(F.col(f"_n_{s}") / slice_rows).cast("int") for s in "lr"}
    own = {s: F.pmod(F.xxhash64(f"_{s}"), slices[s]).cast("int") for s in "lr"}
    met = {s: F.when(slices[s] > 0, F.sequence(none, slices[s] - 1)).otherwise(F.array(F.lit(-1))) for s in "lr"}
    cell = lambda i, j: F.struct(i.alias("_i"), j.alias("_j"))
    cells = F.when(
        F.col("_l").isNotNull(), F.transform(met["r"], lambda j: cell(own["l"], j))
    ).otherwise(F.transform(met["l"], lambda i: cell(i, own["r"])))
    dealt = sized.select(*keys, "_l", "_r", F.explode(cells).alias("_cell")).select(*keys, "_l", "_r", "_cell.*")
    # the rows stand by key already, which would do for the grouping and keep a hot key in one task
    listed = dealt.repartition(*keys, "_i", "_j").groupBy(*keys, "_i", "_j").agg(F.collect_list("_l").alias("_ls"), F.collect_list("_r").alias("_rs"))
    pairs = listed.select(*keys, F.explode_outer("_ls").alias("_l"), "_rs").select(*keys, "_l", F.explode_outer("_rs").alias("_r"))
    out = pairs.unionByName(both.filter(~known))
    return out.select(*keys, *(f"_l.{c}" for c in rest[0]), *(f"_r.{c}" for c in rest[1]))
