"""The pipeline's stages against brute force, and that every query of the subpackage is registered."""

import random

import __spark_entry__
import corpus_pipeline
from ridgeline.llm import decontam, quality, queries, secrets
from tests.llm.test_operators import brute_join, prose

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, folder):
    rng = random.Random(21)
    base = [prose(rng, rng.randrange(60, 120)) for _ in range(20)]
    items = [prose(rng, 20) for _ in range(4)]
    texts = base + [base[0], base[1] + " tail", base[2] + " " + items[0], items[1].upper() + " " + base[3]]
    texts += [prose(rng, 70) + ' token = "0123456789abcdef0123456789abcdef"', "short", None, "", "again and again " * 60]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(len(rows))], "doc_id long, quality int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return rows, items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, out = dict((r[0], r[1]) for r in rows), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "quality_rules":
            good = {r.doc_id for r in quality.quality(spark.createDataFrame(rows, DOCUMENTS), spark.read.parquet(f"{tmp_path}/labels.parquet")).collect() if r.kept}
            kept = {d: t for d, t in kept.items() if d in good}
        elif name == "near_duplicates":
            kept = {d: kept[d] for d, _, c, _ in brute_join(sorted(kept.items()), 5, 80) if d == c}
        elif name == "benchmark_decontamination":
            plain = [decontam.plain(i) for i in items]
            kept = {d: t for d, t in kept.items() if not any(i in decontam.plain(t) for i in plain)}
        elif name == "secret_scan":
            kept = {d: secrets.redact(t, secrets.base_spans(t), "[SECRET]") for d, t in kept.items()}
        if k < 4:
            assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {d: (t, len(t)) for d, t in kept.items()}, name
    assert sorted(r.doc_id for r in out.collect()) == sorted(kept)
    assert any("[SECRET]" in t for t in kept.values()) and len(kept) < len(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(kept)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registry():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} == {x.split("_")[0] for x in queries.queries()} and set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_license_sql_equals_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')" if __import__("os").path.isdir(f"{folder}/documents.parquet") else f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    sql = queries.oracle_sql()["op6_license_scan"]
    got = sorted(map(str, (tuple(r) for r in queries.op6_license_scan(spark, folder).select("doc_id", "text_digest", "license_id").collect())))
    assert got == sorted(map(str, con.execute(f"SELECT doc_id, text_digest, license_id FROM ({sql})").fetchall()))
