"""Joins that Spark has no single operator for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, x: str, target: str, tolerance: str, width: float) -> DataFrame:
    """Rows with abs(left.x - right.target) <= left.tolerance, as an equi-join on cells of a width.

    The left row visits every cell that its band touches, so that any tolerance is exact; a plain range condition would
    plan a nested loop over all pairs.
    """
    cell = lambda c: F.floor(c / F.lit(width)).cast("long")
    a = left.withColumn("__cell", F.explode(F.sequence(cell(F.col(x) - F.col(tolerance)), cell(F.col(x) + F.col(tolerance)))))
    b = right.withColumn("__cell", cell(F.col(target)))
    return a.join(b, "__cell").where(F.abs(F.col(x) - F.col(target)) <= F.col(tolerance)).drop("__cell")


def tiered_match(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str, left_id: str, right_id: str) -> DataFrame:
    """For each left row of a shared key: the right row whose name holds, or is held by, its own (the longest wins).

    Tier A: one right row matches; A_ambiguous: several; B: no name matches but the key has one right row; C: several.
    Rows of a key and name count once, and a name that holds another has it as a substring: both ways are equi-joins on the
    substrings (of lengths that the other side has), so that no pair of rows is ever a row.
    """
    longest = lambda name: F.min(F.struct((-F.length(name)).alias("n"), F.col("id"))).alias("best")
    a = left.select(F.col(key), F.col(left_id), F.col(left_name).alias("__a"))
    # per key and name its rows and least id, per key all rows: a null name is a row that matches nothing
    b = right.select(F.col(key), F.col(right_id).alias("id"), F.col(right_name).alias("__b")).groupBy(key, "__b").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("id"))
    every = b.groupBy(key).agg(F.sum("rows").alias("candidates"), F.min("id").alias("any"))
    names, others = a.where("__a != ''").select(key, "__a").distinct(), b.where("__b != ''")

    def substrings(df: DataFrame, name: str, other: DataFrame, other_name: str, least: int) -> DataFrame:
        """df's rows for each distinct substring `__s` that is at least so many characters shorter and as long as some name of the other."""
        n, lengths = F.col("__n"), other.agg(F.collect_set(F.length(other_name)).alias("__lengths"))
        sized = df.crossJoin(F.broadcast(lengths)).withColumn("__n", F.explode(F.filter("__lengths", lambda x: x <= F.length(name) - least)))
        starts = F.sequence(F.lit(1), F.length(name) - n + 1)
        return sized.withColumn("__s", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(name), i, n))))).drop("__lengths", "__n")

    held = substrings(names, "__a", others, "__b", 0).join(others.withColumnRenamed("__b", "__s"), [key, "__s"])
    held = held.groupBy(key, "__a").agg(F.sum("rows").alias("hits"), longest("__s"))
    holds = substrings(others, "__b", names, "__a", 1).groupBy(key, "__s").agg(F.sum("rows").alias("hits"), longest("__b"))
    holds = holds.withColumnRenamed("__s", "__a").join(names, [key, "__a"], "left_semi")
    found = held.unionByName(holds).groupBy(key, "__a").agg(F.sum("hits").alias("hits"), F.min("best").alias("best"))
    both = a.join(every, key).join(found, [key, "__a"], "left")
    out = both.groupBy(left_id).agg(F.min("best").alias("best"), F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"), F.sum("candidates").alias("candidates"), F.min("any").alias("any"))
    tier = F.when(F.col("hits") == 1, "A").when(F.col("hits") > 1, "A_ambiguous").when(F.col("candidates") == 1, "B").otherwise("C")
    return out.select(left_id, F.when(tier != "C", F.coalesce("best.id", "any")).alias(right_id), tier.alias("match_tier"), F.col("candidates").alias("n_candidates"))


def claim_in_order(left: DataFrame, right: DataFrame, order: str, left_id: str, right_id: str, scope: list[str] | None = None) -> DataFrame:
    """Left rows with the right row of the same order value, each right row claimed once; unmatched left rows stay."""
    keys = [*(scope or []), order]
    number = lambda df, k: df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(k)))
    return number(left, left_id).join(number(right, right_id).select(*keys, "__n", right_id), [*keys, "__n"], "left").drop("__n")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the columns of new written over it where the key meets, and new's other rows added.

    Only new's columns change; a null in new overwrites; columns that new lacks keep old values, or null in added rows.
    """
    there = F.col("n.__new").isNotNull()
    both = old.alias("o").join(new.withColumn("__new", F.lit(True)).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    columns = [F.coalesce(f"o.{key}", f"n.{key}").alias(key)]
    columns += [F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}") for c in old.columns if c != key]
    return both.select(*columns)


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def guarded_update(rows: DataFrame, values: DataFrame, key: str, column: str, guard: Column) -> DataFrame:
    """rows with `column` from values(key, new_value) where the key meets and the guard holds. Whether the values are broadcast
    is left to their size (spark.sql.autoBroadcastJoinThreshold)."""
    return rows.join(values, key, "left").withColumn(column, F.when(F.col("new_value").isNotNull() & guard, F.col("new_value")).otherwise(F.col(column))).drop("new_value")
