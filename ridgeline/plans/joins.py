"""Joins, set operations, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import text
from ridgeline.operators import joins
from ridgeline.plans.registry import query, table


@query("SELECT o_orderkey, c_name, l_linenumber, l_quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey WHERE l_discount <= 0.02")
def j1_inner_chain(spark, sf_dir):
    c, o, i = (table(spark, sf_dir, x) for x in ("customer", "orders", "lineitem"))
    return i.where("l_discount <= 0.02D").join(o, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name", "l_linenumber", "l_quantity")


@query("""SELECT c_custkey, o_orderkey, l_linenumber FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 50000) o ON c_custkey = o_custkey
LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity < 5) l ON o_orderkey = l_orderkey""")
def j2_left_chain(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice < 50000")
    i = table(spark, sf_dir, "lineitem").where("l_quantity < 5")
    return table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").join(i, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("c_custkey", "o_orderkey", "l_linenumber")


@query("""SELECT l_orderkey, c_name, p_name, s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) s ON l_suppkey = s_suppkey WHERE l_quantity > 45""")
def j3_inner_and_left(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    rows = table(spark, sf_dir, "lineitem").where("l_quantity > 45").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "c_name", "p_name", "s_name")


@query("SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) = 0")
def j4_left_context(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").where("coalesce(toxic, 0) = 0").select("doc_id", "lang", "quality")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 200000)")
def j5_semi(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
    return table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j6_anti(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT o_orderkey, (SELECT c_name FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) AS name FROM orders")
def j9_scalar_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return table(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"), "left").select("o_orderkey", F.col("c_name").alias("name"))


@query("""WITH a AS (SELECT p_partkey, p_brand, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS n FROM part),
b AS (SELECT p_partkey AS row_id, p_brand, regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g') AS n FROM part),
m AS (SELECT a.p_partkey, row_id, b.n AS bn, a.n <> '' AND b.n <> '' AND (contains(a.n, b.n) OR contains(b.n, a.n)) AS hit FROM a JOIN b USING (p_brand)),
g AS (SELECT p_partkey, count(*) AS n_candidates, count(*) FILTER (WHERE hit) AS hits, min(row_id) AS r, (list(row_id ORDER BY length(bn) DESC, row_id) FILTER (WHERE hit))[1] AS best FROM m GROUP BY p_partkey)
SELECT p_partkey, CASE WHEN hits > 0 THEN best WHEN n_candidates = 1 THEN r END AS row_id, CASE WHEN hits = 1 THEN 'A' WHEN hits > 1 THEN 'A_ambiguous' WHEN n_candidates = 1 THEN 'B' ELSE 'C' END AS match_tier, n_candidates FROM g""")
def j12_tiered_match(spark, sf_dir):
    """Every name against every type of the same brand."""
    part = table(spark, sf_dir, "part")
    a = part.select("p_partkey", "p_brand", text.name_key(F.col("p_name")).alias("a"))
    b = part.select(F.col("p_partkey").alias("row_id"), "p_brand", text.name_key(F.col("p_type")).alias("b"))
    return joins.tiered_match(a, b, "p_brand", "a", "b", "p_partkey", "row_id")


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus AS k, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders WHERE o_orderkey % 2 = 0),
b AS (SELECT o_orderkey AS other, o_custkey, o_orderstatus AS k, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_custkey, k, o_orderkey, other FROM a LEFT JOIN b USING (o_custkey, k, n)""")
def j13_claim_once(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "k")
    a = o.where("o_orderkey % 2 = 0").select("o_custkey", "k", "o_orderkey")
    b = o.where("o_orderkey % 2 = 1").select("o_custkey", "k", F.col("o_orderkey").alias("other"))
    return joins.claim_in_order(a, b, "k", "o_orderkey", "other", ["o_custkey"]).select("o_custkey", "k", "o_orderkey", "other")


@query("""SELECT 'orders' AS level, count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def j14_orphans(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer").where("c_acctbal > 0"), table(spark, sf_dir, "orders")
    a = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.lit("orders").alias("level"), F.count(F.lit(1)).alias("orphans"))
    b = table(spark, sf_dir, "lineitem").join(o.where("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.lit("lineitem").alias("level"), F.count(F.lit(1)).alias("orphans"))
    return a.unionByName(b)


# --- set operations

@query("SELECT 'customer' AS what, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def u1_labelled_counts(spark, sf_dir):
    from functools import reduce

    parts = [table(spark, sf_dir, t).agg(F.lit(t).alias("what"), F.count(F.lit(1)).alias("n")) for t in ("customer", "orders", "lineitem")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("WITH v(k, w) AS (VALUES ('A', 1), ('N', 2), ('R', 3)) SELECT l_orderkey, w FROM lineitem JOIN v ON l_returnflag = k ")
def u2_values_relation(spark, sf_dir):
    v = spark.createDataFrame([("A", 1), ("N", 2), ("R", 3)], "k string, w int")
    return table(spark, sf_dir, "lineitem").join(F.broadcast(v), F.col("l_returnflag") == F.col("k")).select("l_orderkey", "w")


@query("""SELECT o_custkey, min(cohort) AS cohort FROM (SELECT o_custkey, 1 AS cohort FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_custkey, 2 FROM orders WHERE o_totalprice > 250000 UNION ALL SELECT o_custkey, 3 FROM orders) GROUP BY o_custkey""")
def u3_ordered_cohorts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    one = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_totalprice") > 250000, 2).otherwise(3)
    return o.groupBy("o_custkey").agg(F.min(one).alias("cohort"))


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u4_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").subtract(o.where("o_orderstatus = 'P'").select("o_custkey"))


@query("SELECT count(*) AS drift FROM part WHERE regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') IS DISTINCT FROM lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g'))")
def u5_definition_drift(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a, b = p.select("p_partkey", text.name_key(F.col("p_name")).alias("k")), p.select("p_partkey", F.lower(F.regexp_replace("p_name", "[^A-Za-z0-9]", "")).alias("k"))
    return a.exceptAll(b).unionByName(b.exceptAll(a)).agg(F.count_distinct("p_partkey").alias("drift"))


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u6_intersection(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").intersect(o.where("o_orderstatus = 'P'").select("o_custkey"))
