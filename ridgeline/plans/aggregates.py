"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.functions import text
from ridgeline.functions import vocabulary as V
from ridgeline.operators import groups
from ridgeline.plans.registry import query, table


@query("""SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT o_orderkey) FILTER (WHERE l_returnflag = 'A') AS n_clean, count(DISTINCT l_partkey) FILTER (WHERE l_discount > 0.05) AS n_flagged
FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey""")
def a1_distinct_counts(spark, sf_dir):
    """Reduced to one row for each order and for each part of a customer before they are counted."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    rows = o.join(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_discount"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    orders = rows.groupBy("o_custkey", "o_orderkey").agg(F.bool_or(F.col("l_returnflag") == "A").alias("clean"))
    orders = orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.count_if("clean").alias("n_clean"))
    parts = rows.groupBy("o_custkey", "l_partkey").agg(F.bool_or(F.col("l_discount") > 0.05).alias("flagged"))
    parts = parts.groupBy("o_custkey").agg(F.count("l_partkey").alias("n_parts"), F.count_if(F.col("flagged") & F.col("l_partkey").isNotNull()).alias("n_flagged"))
    counts = orders.join(parts, "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    both = table(spark, sf_dir, "customer").select("c_custkey").join(counts, "c_custkey", "left")
    return both.select("c_custkey", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_orders", "n_parts", "n_clean", "n_flagged")))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'A') AS clean, count(*) FILTER (WHERE l_returnflag = 'N') AS verified, count(*) FILTER (WHERE l_returnflag = 'R') AS flagged, count(DISTINCT l_orderkey) AS orders FROM lineitem")
def a2_corpus_stats(spark, sf_dir):
    f = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("total"), F.count_if(f == "A").alias("clean"), F.count_if(f == "N").alias("verified"), F.count_if(f == "R").alias("flagged"), F.count_distinct("l_orderkey").alias("orders"))


@query("SELECT p_type, count(*) AS n FROM part WHERE nullif(p_size, 5) IS NOT NULL GROUP BY p_type ORDER BY n DESC, p_type")
def a3_tallies(spark, sf_dir):
    return table(spark, sf_dir, "part").where("nullif(p_size, 5) is not null").groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_type")


@query("SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS derived, sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS other FROM lineitem GROUP BY l_orderkey")
def a4_conditional_sums(spark, sf_dir):
    r = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_if(r).alias("derived"), F.count_if(~r).alias("other"))


@query("""SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS roles, array_to_string(list_sort(list(DISTINCT lower(o_orderpriority))), ',') AS states, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o
FROM orders GROUP BY o_custkey""")
def a6_facet_sets(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("roles"),
        F.array_join(F.array_sort(F.collect_set(F.lower("o_orderpriority"))), ",").alias("states"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_o"),
    )


@query("""WITH g AS (SELECT l_orderkey, bool_or(l_discount > 0.08) AS quarantined, string_agg(DISTINCT CASE WHEN l_discount > 0.08 THEN l_returnflag END, ';' ORDER BY CASE WHEN l_discount > 0.08 THEN l_returnflag END) AS reasons FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, l_quantity, quarantined, coalesce(reasons, '') AS reasons FROM lineitem JOIN g USING (l_orderkey)""")
def a7_figure_quarantine(spark, sf_dir):
    w = Window.partitionBy("l_orderkey")
    flag = F.col("l_discount") > 0.08
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.bool_or(flag).over(w).alias("quarantined"), F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("l_returnflag"))).over(w)), ";").alias("reasons"))


_NAMES = "SELECT p_brand, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN '<i>' || p_name || '</i>' ELSE replace(p_name, ' ', '-') END AS label FROM part"
_NOT_SPECIFIC = "length(g.key) < 3 OR g.key IN (" + ", ".join(f"'{w}'" for w in V.GENERIC) + ")" + "".join(f" OR regexp_matches(g.key, '{p}')" for p in text.key_patterns().values())
_KEY = "regexp_replace(lower(regexp_replace(label, '</?[a-zA-Z][^>]{0,40}>', '', 'g')), '[^a-z0-9@/]', '', 'g')"


@query(f"""WITH n AS (SELECT p_brand, trim(regexp_replace(label, '\\s+', ' ', 'g')) AS label, {_KEY} AS key FROM ({_NAMES})),
v AS (SELECT key, label, count(*) AS n FROM n GROUP BY key, label), d AS (SELECT key, label, row_number() OVER (PARTITION BY key ORDER BY n DESC, length(label), label) AS r FROM v),
g AS (SELECT key, count(*) AS curve_count, count(DISTINCT p_brand) AS paper_count, count(DISTINCT label) AS n_variants FROM n GROUP BY key)
SELECT g.key, d.label AS display_name, curve_count, paper_count, n_variants, CASE WHEN n_variants = 1 THEN 'label_identical' ELSE 'label_normalised' END AS match_basis, paper_count >= 2 AND NOT ({_NOT_SPECIFIC}) AS publishable FROM g JOIN d ON g.key = d.key AND r = 1""")
def a8_label_groups(spark, sf_dir):
    n = F.col("p_partkey") % 4
    label = F.when(n == 0, F.col("p_name")).when(n == 1, F.upper("p_name")).when(n == 2, F.concat(F.lit("<i>"), "p_name", F.lit("</i>"))).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    return groups.label_groups(table(spark, sf_dir, "part").select("p_brand", label.alias("label")), "label", "p_brand").select("key", "display_name", "curve_count", "paper_count", "n_variants", "match_basis", "publishable")


@query("SELECT quality AS verdict, length(text) < 300 AS flagged, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def a9_confusion(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").groupBy(F.col("quality").alias("verdict"), (F.length("text") < 300).alias("flagged")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS known, count(*) FILTER (WHERE length(text) < 300) AS caught FROM labels LEFT JOIN documents USING (doc_id) WHERE quality = 0")
def a10_recall(spark, sf_dir):
    return table(spark, sf_dir, "labels").where("quality = 0").join(table(spark, sf_dir, "documents"), "doc_id", "left").agg(F.count(F.lit(1)).alias("known"), F.count_if(F.length("text") < 300).alias("caught"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority = '1-URGENT', o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def a11_representative(spark, sf_dir):
    best = F.min(F.struct((F.col("o_orderpriority") == "1-URGENT").alias("t"), (-F.col("o_totalprice")).alias("c"), F.col("o_orderkey").alias("id")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("b")).select("o_custkey", F.col("b.id").alias("o_orderkey"))


@query("SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 12")
def a12_vocabulary(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_name").limit(12)


@query("""WITH v AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) AS k FROM part GROUP BY p_type)
SELECT p_partkey, CAST(coalesce(k = 1, false) AS INT) AS is_1, CAST(coalesce(k = 2, false) AS INT) AS is_2, CASE WHEN p_size BETWEEN 5 AND 40 THEN p_size END AS size_ok FROM part LEFT JOIN v USING (p_type)""")
def a13_one_hot(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    top = [r.p_type for r in part.groupBy("p_type").count().orderBy(F.desc("count"), "p_type").limit(2).collect()] + [None, None]
    return part.select("p_partkey", F.coalesce((F.col("p_type") == F.lit(top[0])).cast("int"), F.lit(0)).alias("is_1"), F.coalesce((F.col("p_type") == F.lit(top[1])).cast("int"), F.lit(0)).alias("is_2"), F.when(F.col("p_size").between(5, 40), F.col("p_size")).alias("size_ok"))


_USES = "CASE p_partkey % 7 WHEN 0 THEN 'Photocatalysis; CO2 capture' WHEN 1 THEN 'dye removal, Sensing' WHEN 2 THEN 'H2 storage' WHEN 3 THEN 'Fuel cell;; battery' WHEN 4 THEN 'drug delivery, OER' WHEN 5 THEN 'unknown' END"


@query(f"""WITH t AS (SELECT p_partkey, trim(lower(x)) AS x FROM part, unnest(string_split_regex({_USES}, '[;,]')) AS u(x)),
c AS (SELECT p_partkey, CASE """ + " ".join("WHEN " + " OR ".join(f"contains(x, '{m}')" for m in marks) + f" THEN '{k}'" for k, marks in V.APPLICATIONS) + """ END AS c FROM t WHERE x <> '')
SELECT p_partkey, array_to_string(list_sort(list(DISTINCT c)), '+') AS classes FROM c WHERE c IS NOT NULL GROUP BY p_partkey""")
def a15_multi_label(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", text.applications(F.expr(_USES)).alias("c"))
    return rows.where(F.size("c") > 0).select("p_partkey", F.array_join("c", "+").alias("classes"))


@query("SELECT p_type, count(*) AS n, count(*) FILTER (WHERE p_size < 10) AS hits FROM part GROUP BY p_type HAVING n >= 15")
def a16_beta_binomial_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_size") < 10).alias("hits")).where("n >= 15")


_SHARES = "SELECT o_custkey AS g, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS hits FROM orders GROUP BY o_custkey HAVING n >= 15"


def _shares(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("g")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("hits")).where("n >= 15")


@query(f"""WITH c AS (SELECT n, hits, count(*) AS k FROM ({_SHARES}) GROUP BY n, hits), x AS (SELECT 0.3::DOUBLE + 59.7::DOUBLE / 119 * i AS v FROM range(120) r(i)),
ll AS (SELECT a.v AS a, b.v AS b, sum(k * (lgamma(a.v + hits) + lgamma(b.v + n - hits) - lgamma(a.v + b.v + n) - lgamma(a.v) - lgamma(b.v) + lgamma(a.v + b.v))) AS ll FROM x a, x b, c GROUP BY a.v, b.v)
SELECT round(arg_max(a, ll), 9) AS a, round(arg_max(b, ll), 9) AS b, (SELECT CAST(sum(hits * k) AS DOUBLE) / sum(n * k) FROM c) AS pooled FROM ll""")
def a16_beta_binomial_prior(spark, sf_dir):
    counted = _shares(spark, sf_dir).groupBy("n", "hits").agg(F.count(F.lit(1)).alias("groups"))
    a, b, pooled = groups.beta_prior(counted)
    return spark.createDataFrame([(round(a, 9), round(b, 9), pooled)], "a double, b double, pooled double")


@query()
def a16_beta_binomial(spark, sf_dir):
    return groups.beta_binomial(_shares(spark, sf_dir), "g")


@query("""WITH g AS (SELECT p_type, count(*) AS n, avg(p_retailprice) AS m, greatest(0.5, stddev_samp(p_retailprice) / sqrt(count(*))) AS se FROM part GROUP BY p_type HAVING count(*) >= 3),
f AS (SELECT sum(1 / se / se) AS w, sum(m / se / se) / sum(1 / se / se) AS mu, sum(1 / se / se / se / se) AS w2, count(*) AS k FROM g),
q AS (SELECT sum((m - mu) * (m - mu) / se / se) AS q FROM g, f), t AS (SELECT greatest(0.0, (q - (k - 1)) / (w - w2 / w)) AS tau2 FROM q, f),
r AS (SELECT sum(m / (se * se + tau2)) / sum(1 / (se * se + tau2)) AS mu FROM g, t)
SELECT p_type, n, round(CASE WHEN tau2 > 0 THEN (m / (se * se) + mu / tau2) / (1 / (se * se) + 1 / tau2) ELSE mu END, 4) AS shrunk FROM g, t, r""")
def a17_random_effects(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("m"), F.greatest(F.lit(0.5), F.stddev_samp("p_retailprice") / F.sqrt(F.count(F.lit(1)))).alias("se")).where("n >= 3")
    return groups.random_effects(rows, "m", "se").select("p_type", "n", F.round("shrunk", 4).alias("shrunk"))


_FIRST = "SELECT o_custkey, min(o_totalprice) / 1000 AS mine, min(o_totalprice) FILTER (WHERE o_orderstatus <> 'P') / 1000 AS theirs FROM orders GROUP BY o_custkey"


@query(f"SELECT count(*) AS n, avg(CASE WHEN abs(mine - theirs) <= 0.3 THEN 1.0 ELSE 0.0 END) AS within, median(abs(mine - theirs)) AS middle FROM ({_FIRST}) WHERE theirs IS NOT NULL")
def a19_cross_validation(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.min("o_totalprice") / 1000).alias("mine"), (F.min(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))) / 1000).alias("theirs")).where("theirs is not null")
    d = F.abs(F.col("mine") - F.col("theirs"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(d <= 0.3, 1.0).otherwise(0.0)).alias("within"), F.median(d).alias("middle"))


@query("SELECT event_type, median(value) AS p50, quantile_cont(value, 0.9) AS p90, count(*) FILTER (WHERE value > 100) AS high FROM events GROUP BY event_type")
def a20_audit_summary(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.median("value").alias("p50"), F.percentile("value", 0.9).alias("p90"), F.count_if(F.col("value") > 100).alias("high"))


@query("SELECT conv_id, (list(nullif(role, 'user') ORDER BY turn) FILTER (WHERE nullif(role, 'user') IS NOT NULL))[1] AS first_role, (list(CASE WHEN length(text) > 200 THEN turn END ORDER BY turn) FILTER (WHERE length(text) > 200))[1] AS first_long FROM conversations GROUP BY conv_id")
def a21_first_non_null(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("role", F.when(F.col("role") != "user", F.col("turn"))).alias("r"), F.min(F.when(F.col("role") != "user", F.col("turn"))).alias("has"), F.min(F.when(F.length("text") > 200, F.col("turn"))).alias("first_long")).select("conv_id", F.when(F.col("has").isNotNull(), F.col("r")).alias("first_role"), "first_long")


@query("SELECT c_custkey, count(o_orderkey) AS jobs, coalesce(sum(CAST(o_totalprice * 100 AS BIGINT)), 0)::BIGINT AS bytes FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c_custkey = o_custkey GROUP BY c_custkey")
def a22_quota(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    rows = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy("c_custkey").agg(F.count("o_orderkey").alias("jobs"), F.coalesce(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")), F.lit(0)).alias("bytes"))


@query("SELECT o_orderkey, count(l_orderkey) AS found, count(l_orderkey) = max(o_custkey % 7) AS complete FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def a23_manifest_complete(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.groupBy("o_orderkey").agg(F.count("l_orderkey").alias("found"), (F.count("l_orderkey") == F.max(F.col("o_custkey") % 7)).alias("complete"))


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS accepted, count(*) FILTER (WHERE o_orderstatus = 'O') AS rejected, count(*) FILTER (WHERE o_orderstatus = 'P') AS review FROM orders")
def a24_run_counters(spark, sf_dir):
    s = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").agg(F.count_if(s == "F").alias("accepted"), F.count_if(s == "O").alias("rejected"), F.count_if(s == "P").alias("review"))


@query("SELECT user_id, min(value) AS lo, max(value) AS hi, arg_max(event_id, (value, -event_id)) AS strongest FROM events GROUP BY user_id")
def a25_extents(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("strongest"))


@query("SELECT coalesce(nullif(o_orderstatus, 'P'), 'not_computed') AS status, count(*) AS n FROM orders GROUP BY 1 HAVING n > 0")
def a26_capability_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.coalesce(F.expr("nullif(o_orderstatus, 'P')"), F.lit("not_computed")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_name, count(DISTINCT p_brand) AS papers FROM part GROUP BY p_name HAVING papers > 1")
def a27_shared_labels(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_name").agg(F.count_distinct("p_brand").alias("papers")).where("papers > 1")


