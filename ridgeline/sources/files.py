"""Readers and writers of curve collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas of a figure's report and of the released tables.
REPORT = "figure_id string, status string, calibration struct<status: string, agreement_deg: double, fit: struct<slope: double, intercept: double, rmse_deg: double, n_points: int>>, series array<struct<series_id: string, label: string, status: string, x: array<double>, y: array<double>>>"
POINTS = "series_id string, two_theta_deg double, relative_intensity double"


def reports(spark: SparkSession, folder: str, name: str = "result.json", kept: tuple[str, ...] = ("accepted", "partial")) -> DataFrame:
    """Reports of a folder tree by file name, of the statuses that are kept; unreadable files give no row."""
    rows = spark.read.schema(REPORT).options(recursiveFileLookup=True, pathGlobFilter=name, multiLine=True, mode="DROPMALFORMED").json(folder)
    return rows.where(F.col("status").isin(*kept))


def number(text: Column) -> Column:
    """A cell as a number: empty, unreadable and non-finite give null."""
    x = F.trim(text).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def csv_table(spark: SparkSession, path: str, names: dict[str, list[str]] | None = None) -> DataFrame:
    """A CSV table as strings: quotes, doubled quotes, line breaks in cells, gzip by suffix, a byte order mark, columns by
    name with alternatives (`names`: wanted to possible)."""
    rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    if not names:
        return rows
    pick = lambda options: reduce(lambda a, b: F.coalesce(a, b), [F.col(f"`{o}`") for o in options if o in rows.columns] or [F.lit(None).cast("string")])
    return rows.select(*[pick([w, *o]).alias(w) for w, o in names.items()])


def curve_points(rows: DataFrame, series: str = "series_id", x: str = "two_theta_deg", y: str = "relative_intensity", least: int = 2) -> DataFrame:
    """Points of series with at least `least` readable ones; unreadable rows go."""
    from pyspark.sql import Window

    good = rows.select(F.col(series).alias("series_id"), number(F.col(x)).alias("two_theta_deg"), number(F.col(y)).alias("relative_intensity")).dropna()
    return good.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("series_id"))).where(F.col("n") >= least).drop("n")


def evolve(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with missing columns added as nulls of a type; doing it again changes nothing."""
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in rows.columns})


def write_figures(points: DataFrame, folder: str, figure: str = "figure_id") -> None:
    """One gzipped CSV folder for each figure, in order of series and angle; equal input gives equal rows in equal order."""
    points.repartition(figure).sortWithinPartitions(figure, "series_id", "two_theta_deg").write.mode("overwrite").partitionBy(figure).option("compression", "gzip").option("header", True).csv(folder)


def content_hash(points: DataFrame, figure: str = "figure_id") -> DataFrame:
    """(figure, hash) over its rows whatever their order: unchanged figures need not be written again. The hash holds the sums
    of two independent row hashes and the count, so that repeated rows add up, and nulls differ from any text."""
    cells = [x for c in sorted(points.columns) for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    row = lambda salt: F.sum(F.xxhash64(F.lit(salt), *cells).cast("decimal(20,0)")).cast("string")
    sums = points.groupBy(figure).agg(row(1).alias("a"), row(2).alias("b"), F.count(F.lit(1)).alias("n"))
    return sums.select(figure, F.concat_ws(":", "n", F.left(F.sha2(F.concat_ws(":", "a", "b"), 256), F.lit(32))).alias("hash"))


def write_series(points: DataFrame, folder: str, series: str = "series_id") -> None:
    """One CSV folder for each series, in order of angle."""
    points.repartition(series).sortWithinPartitions(series, "two_theta_deg").write.mode("overwrite").partitionBy(series).option("header", True).csv(folder)


def write_accepted(curves: DataFrame, folder: str, accepted: Column, order: list[str]) -> None:
    """The master table of accepted curves, as CSV in global order."""
    curves.where(accepted).orderBy(*order).write.mode("overwrite").options(header=True, quoteAll=True, escape='"').csv(folder)


def run_summary(figures: DataFrame, folder: str, status: str = "status") -> DataFrame:
    """Writes a run's counts by status as one JSON row, and gives them."""
    s = F.col(status)
    out = figures.agg(F.count(F.lit(1)).alias("figures"), *(F.count_if(s == k).alias(k) for k in ("accepted", "partial", "rejected", "needs_review")))
    out.write.mode("overwrite").json(folder)
    return out


#: Addresses that one sitemap file may hold (fixed by the protocol).
SITEMAP_ROWS = 50_000


def sitemap(papers: DataFrame, site: str, paper: str = "paper_id") -> DataFrame:
    """(loc, priority, changefreq): the front page, the manual, and a page for each paper."""
    spark = papers.sparkSession
    fixed = spark.createDataFrame([(f"{site}/", "1.0", "daily"), (f"{site}/docs/api", "0.5", "monthly")], "loc string, priority string, changefreq string")
    ids = F.replace(F.url_encode(F.col(paper).cast("string")), F.lit("+"), F.lit("%20"))
    return fixed.unionByName(papers.where(F.col(paper).isNotNull()).select(F.concat(F.lit(f"{site}/paper/"), ids).alias("loc"), F.lit("0.8").alias("priority"), F.lit("monthly").alias("changefreq")))


def write_sitemap(entries: DataFrame, folder: str, site: str) -> None:
    """Sitemap files of at most SITEMAP_ROWS addresses each, and the robots file."""
    from pyspark.sql import Window

    spark = entries.sparkSession
    line = F.format_string("  <url><loc>%s</loc><changefreq>%s</changefreq><priority>%s</priority></url>", "loc", "changefreq", "priority")
    ranged = entries.select("loc", line.alias("value")).repartitionByRange("loc")
    own = ranged.withColumn("part", F.spark_partition_id())
    numbered = own.withColumn("file", F.floor((F.row_number().over(Window.partitionBy("part").orderBy("loc")) - 1) / SITEMAP_ROWS))
    body = numbered.groupBy("part", "file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("loc", "value"))), lambda r: r["value"]), "\n").alias("body"))
    head, tail = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n', "\n</urlset>"
    body.select("part", "file", F.concat(F.lit(head), "body", F.lit(tail)).alias("value")).write.mode("overwrite").partitionBy("part", "file").text(f"{folder}/sitemap")
    lines = ["User-agent: *", "Allow: /", "Disallow: /auth/", f"Sitemap: {site}/sitemap.xml"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/robots")


def stamped(rows: DataFrame, name: str = "generated_at", at: Column | None = None) -> DataFrame:
    """rows with the time of the run as ISO text in UTC; one time for all rows of a query."""
    now = F.current_timestamp() if at is None else at
    return rows.withColumn(name, F.date_format(F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def export(curves: DataFrame, points: DataFrame, papers: DataFrame, folder: str) -> DataFrame:
    """Writes the three released tables and a one-row manifest with their tallies; gives the manifest."""
    for name, rows in (("curves", curves), ("points", points), ("papers", papers)):
        rows.write.mode("overwrite").option("compression", "gzip").option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/{name}")
    manifest = curves.agg(F.count(F.lit(1)).alias("curves")).crossJoin(points.agg(F.count(F.lit(1)).alias("points"))).crossJoin(papers.agg(F.count(F.lit(1)).alias("papers")))
    manifest.write.mode("overwrite").json(f"{folder}/manifest")
    return manifest


def cache_key(*parts: Column) -> Column:
    """Content address of a request: SHA-256 over its parts, joined by NUL."""
    return F.sha2(F.concat_ws("\u0000", *parts).cast("binary"), 256)
