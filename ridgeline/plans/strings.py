"""String, date and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import dates, json, text
from ridgeline.functions import vocabulary as V
from ridgeline.operators import mining
from ridgeline.plans.registry import query, table

_LABELS = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '<i>' || p_name || '</i>' WHEN 1 THEN upper(p_name) || '₂' WHEN 2 THEN 'α-' || p_name WHEN 3 THEN p_name || ' &amp; co@x/y' ELSE CAST(p_size AS VARCHAR) END AS label FROM part"


def _nested(x: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_DIGITS = f"translate(lower(regexp_replace({_nested('label', V.ENTITIES)}, '</?[a-zA-Z][^>]{{0,40}}>', '', 'g')), '{V.SCRIPTS[0]}', '{V.SCRIPTS[1]}')"
_KEY = f"regexp_replace({_nested(_DIGITS, V.GREEK)}, '[^a-z0-9@/]', '', 'g')"


def _labels(spark, sf_dir):
    n = F.col("p_partkey") % 5
    label = F.when(n == 0, F.concat(F.lit("<i>"), "p_name", F.lit("</i>"))).when(n == 1, F.concat(F.upper("p_name"), F.lit("₂"))).when(n == 2, F.concat(F.lit("α-"), "p_name")).when(n == 3, F.concat("p_name", F.lit(" &amp; co@x/y"))).otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query(f"SELECT p_partkey, {_KEY} AS key FROM ({_LABELS})")
def t1_label_key(spark, sf_dir):
    return _labels(spark, sf_dir).select("p_partkey", text.label_key(F.col("label")).alias("key"))


@query(f"SELECT p_partkey, CASE WHEN length(key) < 3 THEN 'paper_local' WHEN key IN ({', '.join(repr(w) for w in V.GENERIC)}) THEN 'generic' " + " ".join(f"WHEN regexp_matches(key, '{p}') THEN '{n}'" for n, p in text.key_patterns().items()) + f" ELSE 'specific' END AS specificity FROM (SELECT p_partkey, {_KEY} AS key FROM (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'COF-' || p_size WHEN 1 THEN 'Imine-COF' WHEN 2 THEN 'M-COF' WHEN 3 THEN 'compound ' || (p_size % 9) WHEN 4 THEN 'COF-3' || (p_size + 10) WHEN 5 THEN 'As-prepared' WHEN 6 THEN 'A1' WHEN 7 THEN 'H-COF1' ELSE 'Tp-Pa-' || p_size END AS label FROM part))")
def t2_specificity(spark, sf_dir):
    n, size = F.col("p_partkey") % 9, F.col("p_size")
    label = F.when(n == 0, F.concat(F.lit("COF-"), size)).when(n == 1, "Imine-COF").when(n == 2, "M-COF").when(n == 3, F.concat(F.lit("compound "), size % 9)).when(n == 4, F.concat(F.lit("COF-3"), size + 10)).when(n == 5, "As-prepared").when(n == 6, "A1").when(n == 7, "H-COF1").otherwise(F.concat(F.lit("Tp-Pa-"), size))
    return table(spark, sf_dir, "part").select("p_partkey", text.specificity(text.label_key(label)).alias("specificity"))


@query("SELECT doc_id, md5(nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '')) AS h FROM documents")
def t3_published_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.published(F.col("text")).cast("binary")).alias("h"))


@query("SELECT p_partkey, nullif(trim(regexp_replace('  ' || p_name || E'\\t\\n ' || p_type, '\\s+', ' ', 'g')), '') AS facet FROM part")
def t4_facet_clean(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.published(F.concat(F.lit("  "), "p_name", F.lit("\t\n "), "p_type")).alias("facet"))


_DOI = "CASE WHEN p_partkey % 2 = 0 THEN ' https://doi.org/10.1000/' ELSE 'HTTP://DX.DOI.ORG/10.1000/' END || p_brand || '/' || p_partkey"


def _dois(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 2 == 0, " https://doi.org/10.1000/").otherwise("HTTP://DX.DOI.ORG/10.1000/"), "p_brand", F.lit("/"), "p_partkey").alias("d"))


@query(f"SELECT p_partkey, regexp_replace(lower(trim({_DOI})), '^https?://(dx\\.)?doi\\.org/', '') AS doi FROM part")
def t5_doi(spark, sf_dir):
    return _dois(spark, sf_dir).select("p_partkey", text.doi(F.col("d")).alias("doi"))


@query(f"SELECT p_partkey, regexp_replace(regexp_replace(lower(trim({_DOI})), '^https?://(dx\\.)?doi\\.org/', ''), '^([^/]*)/', '\\1_') AS key FROM part")
def t6_identity_key(spark, sf_dir):
    return _dois(spark, sf_dir).select("p_partkey", text.identity_key(F.col("d")).alias("key"))


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS name FROM customer")
def t7_name_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.name_key(F.col("c_name")).alias("name"))


@query(f"SELECT p_partkey, CASE WHEN x <> '' THEN replace(x, '_', '/') END AS doi FROM (SELECT p_partkey, regexp_extract(CASE p_partkey % 3 WHEN 0 THEN 'file_10.1021_' || p_partkey || '_x' WHEN 1 THEN '10.1000.' || p_partkey ELSE 'none' END, '{V.DOI_IN_NAME}', 1) AS x FROM part)")
def t8_doi_in_name(spark, sf_dir):
    n = F.col("p_partkey") % 3
    name = F.when(n == 0, F.concat(F.lit("file_10.1021_"), "p_partkey", F.lit("_x"))).when(n == 1, F.concat(F.lit("10.1000."), "p_partkey")).otherwise("none")
    return table(spark, sf_dir, "part").select("p_partkey", text.doi_in_name(name).alias("doi"))


@query("SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower(trim(u)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'item') AS slug FROM (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN ' -- ' ELSE url END AS u FROM pages)")
def t9_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.slug(F.when(F.col("page_id") % 9 == 0, " -- ").otherwise(F.col("url"))).alias("slug"))


@query("SELECT doc_id, round(1 / (1 + exp(-(" + " + ".join(f"CASE WHEN contains(lower(text), '{k}') THEN {w} ELSE 0 END" for k, w in V.KEYWORDS + V.KEYWORDS_AGAINST) + "))), 4) AS score FROM documents")
def t10_keyword_score(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.keyword_score(F.col("text")), 4).alias("score"))


_FIG = "'See Fig. ' || p_size || chr(97 + CAST(p_partkey % 3 AS INT)) || ' and figure 2'"


@query(f"SELECT p_partkey, nullif(regexp_extract({_FIG}, '(?i)\\b(fig(?:ure)?\\.?\\s*[0-9]+[a-z]?)', 1), '') AS label FROM part")
def t11_figure_label(spark, sf_dir):
    s = F.concat(F.lit("See Fig. "), "p_size", F.chr((97 + F.col("p_partkey") % 3).cast("long")), F.lit(" and figure 2"))
    return table(spark, sf_dir, "part").select("p_partkey", text.figure_label(s).alias("label"))


_TOKEN = "CASE p_partkey % 6 WHEN 0 THEN ' 2O.' || p_size WHEN 1 THEN 'l' || p_size || ',5' WHEN 2 THEN '--' || p_size WHEN 3 THEN '.' || p_size WHEN 4 THEN p_size || '..5.1' ELSE 'S' || p_size || 'B' END"
_CLEAN = f"regexp_replace(translate(trim({_TOKEN}), '{V.MISREAD[0]}{V.MISREAD_GONE}', '{V.MISREAD[1]}'), '[^0-9.-]', '', 'g')"
_ONE_DOT = f"(SELECT CASE WHEN length(c) - length(replace(c, '.', '')) > 1 THEN left(c, strpos(c, '.')) || replace(substr(c, strpos(c, '.') + 1), '.', '') ELSE c END FROM (SELECT {_CLEAN} AS c))"
_ONE_SIGN = f"(SELECT CASE WHEN length(d) - length(replace(d, '-', '')) > 1 THEN '-' || replace(d, '-', '') ELSE d END FROM (SELECT {_ONE_DOT} AS d))"
_NUM = f"regexp_replace(regexp_replace({_ONE_SIGN}, '^\\.', '0.'), '^-\\.', '-0.')"


def _tokens(spark, sf_dir):
    n, size = F.col("p_partkey") % 6, F.col("p_size")
    t = F.when(n == 0, F.concat(F.lit(" 2O."), size)).when(n == 1, F.concat(F.lit("l"), size, F.lit(",5"))).when(n == 2, F.concat(F.lit("--"), size)).when(n == 3, F.concat(F.lit("."), size)).when(n == 4, F.concat(size, F.lit("..5.1"))).otherwise(F.concat(F.lit("S"), size, F.lit("B")))
    return table(spark, sf_dir, "part").select("p_partkey", t.alias("t"))


@query(f"SELECT p_partkey, {_NUM} AS token FROM part")
def t12_numeric_token(spark, sf_dir):
    return _tokens(spark, sf_dir).select("p_partkey", text.numeric_token(F.col("t")).alias("token"))


@query(f"SELECT p_partkey, CASE WHEN regexp_matches(n, '^-?[0-9]+(\\.[0-9]+)?$') THEN TRY_CAST(n AS DOUBLE) END AS value FROM (SELECT p_partkey, {_NUM} AS n FROM part)")
def t13_numeric_value(spark, sf_dir):
    return _tokens(spark, sf_dir).select("p_partkey", text.numeric_value(F.col("t")).alias("value"))


_AXIS = "CASE p_partkey % 4 WHEN 0 THEN '2θ (degree)' WHEN 1 THEN 'Wavelength (nm)' WHEN 2 THEN '10 15 20 25 x' ELSE '20 (degree) ' || p_size END"
_AXN = "trim(regexp_replace(regexp_replace(translate(" + _nested(f"lower({_AXIS})", V.AXIS_WORDS) + ", '-_', '  '), '[^a-z0-9(). ]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def _axes(spark, sf_dir):
    n = F.col("p_partkey") % 4
    return table(spark, sf_dir, "part").select("p_partkey", F.when(n == 0, "2θ (degree)").when(n == 1, "Wavelength (nm)").when(n == 2, "10 15 20 25 x").otherwise(F.concat(F.lit("20 (degree) "), "p_size")).alias("t"))


@query(f"SELECT p_partkey, {_AXN} AS label FROM part")
def t14_axis_label(spark, sf_dir):
    return _axes(spark, sf_dir).select("p_partkey", text.axis_label(F.col("t")).alias("label"))


@query(f"""WITH a AS (SELECT p_partkey, {_AXN} AS t FROM part), n AS (SELECT *, list_transform(regexp_extract_all(t, '\\b([0-9]{{1,2}})\\b', 1), lambda x: CAST(x AS INT)) AS v FROM a)
SELECT p_partkey, t <> '' AND (regexp_matches(t, 'two theta|\\b2\\s*theta\\b|\\b2\\s*t[hx][a-z]{{0,4}}\\b') OR (len(v) >= 3 AND (len(list_filter(range(2, len(v) + 1), lambda i: v[i] - v[i - 1] = 5)) >= 2 OR len(list_filter(range(2, len(v) + 1), lambda i: v[i] - v[i - 1] = 10)) >= 2))
OR (regexp_matches(t, '\\bdeg(ree)?\\b') AND regexp_matches(t, '\\b2\\b|\\b2.{{0,10}}deg|\\b2\\s*0\\b'))) AS angle FROM n""")
def t15_angle_axis(spark, sf_dir):
    return _axes(spark, sf_dir).select("p_partkey", text.angle_axis(F.col("t")).alias("angle"))


@query()
def t16_markup_strip(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("Growth of <jats:sub>"), "p_size", F.lit("</jats:sub>O<i>x</i> <b>films</b>")).alias("t"))
    return rows.select("p_partkey", text_markup(F.col("t")).alias("title"))


def text_markup(c):
    from ridgeline.functions.markup import without_markup

    return without_markup(c)


@query("SELECT p_partkey, regexp_replace(p_name || chr(8203) || chr(7) || p_type || chr(57344), '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x{9F}\\x{200B}-\\x{200F}\\x{FEFF}\\x{E000}-\\x{F8FF}]', '', 'g') AS t FROM part")
def t17_without_controls(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.without_controls(F.concat("p_name", F.lit("​\x07"), "p_type", F.lit(""))).alias("t"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(trim(regexp_replace('crys-  ' || p_name || ' meso- porous  **', '\\s+', ' ', 'g')), '([a-z])- ([a-z])', '\\1\\2', 'g'), '[\\s*]+$', '') AS title FROM part")
def t18_title(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.title(F.concat(F.lit("crys-  "), "p_name", F.lit(" meso- porous  **"))).alias("title"))


_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


@query(f"""SELECT page_id, length(t) BETWEEN 20 AND 500 AND len(regexp_extract_all(t, '[A-Za-z]')) >= 10 AND len(string_split_regex(t, '\\s+')) >= 4
AND NOT (regexp_matches(t, '{V.TITLE_DOI}') OR regexp_matches(t, '{V.TITLE_PAGE_RANGE}') OR regexp_matches(lower(t), '{V.TITLE_FILES}') OR regexp_matches(lower(t), '{"|".join(V.TITLE_BAD)}')) AS usable FROM (SELECT page_id, trim({_TITLE}) AS t FROM pages)""")
def t19_usable_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.usable_title(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("usable"))


_A, _B = "p_name", "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '  ') WHEN 2 THEN upper(p_name) || '!' ELSE p_type END"


@query(f"""SELECT p_partkey, CASE WHEN a = b THEN 'identical' WHEN regexp_replace(a, '\\s+', '', 'g') = regexp_replace(b, '\\s+', '', 'g') THEN 'whitespace'
WHEN regexp_replace(lower(a), '[^a-z0-9]', '', 'g') = regexp_replace(lower(b), '[^a-z0-9]', '', 'g') THEN 'punctuation' ELSE 'material' END AS kind FROM (SELECT p_partkey, {_A} AS a, {_B} AS b FROM part)""")
def t20_divergence(spark, sf_dir):
    n = F.col("p_partkey") % 4
    b = F.when(n == 0, F.col("p_name")).when(n == 1, F.replace("p_name", F.lit(" "), F.lit("  "))).when(n == 2, F.concat(F.upper("p_name"), F.lit("!"))).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.divergence(F.col("p_name"), b).alias("kind"))


@query("""SELECT o_custkey, CASE WHEN len(l) > 12 THEN array_to_string(l[1:12], ', ') || ' et al.' ELSE array_to_string(l, ', ') END AS authors FROM
(SELECT o_custkey, list(o_orderpriority || ' ' || o_orderkey ORDER BY o_orderkey) AS l FROM orders GROUP BY o_custkey)""")
def t21_authors(spark, sf_dir):
    none = F.lit(None).cast("string")
    who = F.struct("o_orderkey", none.alias("name"), F.col("o_orderpriority").alias("given"), F.col("o_orderkey").cast("string").alias("family"), none.alias("suffix"))
    people = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(who)).alias("p"))
    return people.select("o_custkey", text.authors(F.col("p")).alias("authors"))


_STAMP = "CASE p_partkey % 4 WHEN 0 THEN 'RETRACTED: ' WHEN 1 THEN ' Withdrawn ： ' WHEN 2 THEN 'Erratum: ' ELSE '' END || p_name"


@query(f"SELECT p_partkey, regexp_replace(t, '{V.TITLE_STAMP}', '') AS title, regexp_matches(t, '{V.NOTICE_TITLE}') AS notice FROM (SELECT p_partkey, {_STAMP} AS t FROM part)")
def t22_title_stamp(spark, sf_dir):
    n = F.col("p_partkey") % 4
    t = F.concat(F.when(n == 0, "RETRACTED: ").when(n == 1, " Withdrawn ： ").when(n == 2, "Erratum: ").otherwise(""), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.without_stamp(t).alias("title"), text.is_notice(t).alias("notice"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(lower(t), '\\baa\\b|eclips') THEN 'AA / eclipsed' WHEN regexp_matches(lower(t), '\\bab\\b|stagger') THEN 'AB / staggered' END AS stacking FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Eclipsed ' WHEN 1 THEN 'AB ' WHEN 2 THEN 'staggered ' ELSE '' END || p_name AS t FROM part)")
def t23_stacking(spark, sf_dir):
    n = F.col("p_partkey") % 4
    t = F.concat(F.when(n == 0, "Eclipsed ").when(n == 1, "AB ").when(n == 2, "staggered ").otherwise(""), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.stacking(t).alias("stacking"))


@query(f"SELECT p_partkey, regexp_matches(t, '{V.TREATED}') AS treated FROM (SELECT p_partkey, p_name || CASE p_size % 3 WHEN 0 THEN ' 1 M HCl' WHEN 1 THEN ' Calcined' ELSE '' END AS t FROM part)")
def t24_treated(spark, sf_dir):
    n = F.col("p_size") % 3
    return table(spark, sf_dir, "part").select("p_partkey", text.treated(F.concat("p_name", F.when(n == 0, " 1 M HCl").when(n == 1, " Calcined").otherwise(""))).alias("treated"))


@query("SELECT p_partkey, array_to_string(list_sort([p_brand, p_type]), '+') AS family FROM part")
def t25_pair_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.pair_key(F.col("p_brand"), F.col("p_type")).alias("family"))


@query("""WITH s AS (SELECT doc_id, i, trim(regexp_replace(l[i], '\\s+', ' ', 'g')) AS s FROM (SELECT doc_id, string_split_regex(text, '[.!?]') AS l FROM documents), range(1, 3000) r(i) WHERE i <= len(l)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, left(s, 60) ORDER BY i) AS d FROM s WHERE length(s) > 40 AND length(s) < 500 AND contains(lower(s), 'th')),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM k WHERE d = 1) SELECT doc_id, place, s AS sentence FROM n WHERE place <= 8""")
def t26_sentence_mining(spark, sf_dir):
    return mining.sentences(table(spark, sf_dir, "documents"), "doc_id", "text", "th", 8)


@query("""SELECT c.conv_id, s AS start, count(*) AS turns, md5(string_agg(text, chr(10) ORDER BY turn)) AS h FROM (SELECT conv_id, unnest(range(0, max(turn) + 1, 2)) AS s FROM conversations GROUP BY conv_id) w
JOIN conversations c ON c.conv_id = w.conv_id AND turn BETWEEN s AND s + 2 GROUP BY ALL""")
def t27_chunks(spark, sf_dir):
    return mining.chunks(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", 3, 1).select("conv_id", "start", "turns", F.md5(F.col("text").cast("binary")).alias("h"))


@query(f"SELECT page_id, regexp_matches(url, '{V.IDENTIFIER}') AS whole, regexp_matches(split_part(url, '/', 3), '{V.IDENTIFIER}') AS host FROM pages")
def t29_valid_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.valid_id(F.col("url")).alias("whole"), text.valid_id(F.split_part("url", F.lit("/"), F.lit(3))).alias("host"))


_OBJECTS = ["a/b.csv.gz", "x/digitized.webp", "p/fig_overlay-2.PNG", "page_012.jpg", "source.png.gz", "replot_qa.png", "m.json", "readme", "my.photo.png", ".emptyFolderPlaceholder"]
_CLASSES = ["data", "own_replot", "publisher_derived", "publisher_derived", "publisher_derived", "own_replot", "data", "unclassified", "unclassified", "data"]


@query("SELECT p_partkey, CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CLASSES)) + " END AS class FROM part")
def t30_object_class(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, _OBJECTS)), (F.col("p_partkey") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.object_class(name).alias("class"))


@query("SELECT p_partkey, printf('#%02x%02x%02x', CAST(p_size * 5 AS INT), CAST(p_partkey % 256 AS INT), 7) AS hex FROM part")
def t31_hex_colour(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.format_string("#%02x%02x%02x", (F.col("p_size") * 5).cast("int"), (F.col("p_partkey") % 256).cast("int"), F.lit(7)).alias("hex"))


@query("SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 20)[1] AS title, CAST(nullif(regexp_extract(text, '\\b((?:19|20)[0-9]{2})\\b', 1), '') AS INT) AS year FROM documents")
def t33_year_and_title(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.first_long_line(F.col("text")).alias("title"), text.year_in(F.col("text")).alias("year"))


# --- dates

@query("SELECT p_partkey, CAST(TRY_CAST(y || '-' || lpad(coalesce(m, 1)::VARCHAR, 2, '0') || '-' || lpad(coalesce(d, 1)::VARCHAR, 2, '0') AS DATE) AS VARCHAR) AS day FROM (SELECT p_partkey, 1990 + p_size AS y, nullif(p_partkey % 15, 0) AS m, nullif(p_partkey % 32, 0) AS d FROM part)")
def dt1_date_parts(spark, sf_dir):
    d = dates.from_parts(1990 + F.col("p_size"), F.expr("nullif(p_partkey % 15, 0L)"), F.expr("nullif(p_partkey % 32, 0L)"))
    return table(spark, sf_dir, "part").select("p_partkey", d.cast("string").alias("day"))


@query("SELECT p_partkey, coalesce(CASE WHEN a BETWEEN 1800 AND 2200 THEN a END, CASE WHEN b BETWEEN 1800 AND 2200 THEN b END, CASE WHEN c BETWEEN 1800 AND 2200 THEN c END) AS year FROM (SELECT p_partkey, 1780 + p_size AS a, nullif(2195 + p_partkey % 10, 2196) AS b, 2000 AS c FROM part)")
def dt2_year_preference(spark, sf_dir):
    y = dates.first_year(1780 + F.col("p_size"), F.expr("nullif(2195 + p_partkey % 10, 2196L)"), F.lit(2000))
    return table(spark, sf_dir, "part").select("p_partkey", y.cast("long").alias("year"))


@query("SELECT o_orderkey, CAST(TRY_CAST(left(CASE WHEN o_orderkey % 9 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END, 10) AS DATE) AS VARCHAR) AS day FROM orders")
def dt3_iso_date(spark, sf_dir):
    s = F.when(F.col("o_orderkey") % 9 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.iso_date(s).cast("string").alias("day"))


# --- JSON and maps

@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def n1_json_elements(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT event_id, nullif(json_extract_string(props, '$.k'), '7') AS k FROM events")
def n2_json_scalar(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.nullif(F.get_json_object("props", "$.k"), F.lit("7")).alias("k"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 2 THEN 0 ELSE 2 END AS n, CASE WHEN p_partkey % 4 < 2 THEN least(CAST(p_size AS DOUBLE), 50.5) END AS first_x FROM part""")
def n3_peak_list(spark, sf_dir):
    n, size = F.col("p_partkey") % 4, F.col("p_size")
    s = F.when(n == 3, "{not json").when(n == 2, "[]").otherwise(F.concat(F.lit('[{"two_theta": 50.5, "rel_height": 0.4, "prominence": 0.2}, {"two_theta": '), size, F.lit(', "rel_height": 1, "prominence": 0.9}, {"two_theta": "x"}, {"two_theta": 400, "prominence": 1}]')))
    peaks = json.peak_list(s)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(peaks).alias("n"), F.get(peaks, F.lit(0))["two_theta"].alias("first_x"))


@query("""SELECT p_partkey, '[{"x":' || p_size || ',"y":' || p_partkey || '},{"x":1,"y":2}]' AS s FROM part""")
def n4_serialized_peaks(spark, sf_dir):
    rows = F.array(F.struct(F.col("p_size").cast("long").alias("x"), F.col("p_partkey").alias("y")), F.struct(F.lit(1).cast("long").alias("x"), F.lit(2).cast("long").alias("y")))
    return table(spark, sf_dir, "part").select("p_partkey", F.to_json(rows).alias("s"))


@query("SELECT p_partkey, p_size / 100.0 AS slope, CAST(p_size % 3 AS BIGINT) AS accepted FROM part")
def n5_nested_report(spark, sf_dir):
    series = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(F.when(i < F.col("p_size") % 3, "accepted").otherwise("rejected").alias("status")))
    s = F.to_json(F.struct(F.struct(F.struct((F.col("p_size") / 100.0).alias("slope")).alias("fit")).alias("calibration"), series.alias("series")))
    r = F.from_json(s, "calibration struct<fit: struct<slope: double>>, series array<struct<status: string>>")
    return table(spark, sf_dir, "part").select("p_partkey", r["calibration"]["fit"]["slope"].alias("slope"), F.size(F.filter(r["series"], lambda x: x["status"] == "accepted")).cast("long").alias("accepted"))


@query("SELECT o_custkey, arg_max(o_orderpriority, (CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 ELSE 1 END, -o_orderkey)) AS worst FROM orders GROUP BY o_custkey")
def n6_severity(spark, sf_dir):
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("1-URGENT", 5, "2-HIGH", 4, "3-MEDIUM", 3)]), F.col("o_orderpriority")), F.lit(1))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct(rank, -F.col("o_orderkey"))).alias("worst"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'retracted' WHEN 1 THEN 'corrected' ELSE 'active' END AS lifecycle FROM part""")
def n7_lifecycle(spark, sf_dir):
    n = F.col("p_partkey") % 4
    kinds = F.when(n == 0, F.array(F.lit("correction"), F.lit("retraction"))).when(n == 1, F.array(F.lit("erratum"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select("p_partkey", json.lifecycle(kinds, n == 2).alias("lifecycle"))


