"""Registered queries and the pipeline on the given tables."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tablekit.llm.queries import ORACLES, QUERIES
from tests.oracle import _rows, connect

SF = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op2_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_vector_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op4_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op5_toxicity": "doc_id bigint, severity double, grade int, p_toxic double, toxic boolean, held_out boolean",
    "op6_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op8_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op9_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op12_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op13_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
}


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_contract(spark, name):
    made = QUERIES[name](spark, SF)
    wanted = CONTRACTS[name].split(", ")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in made.schema][: len(wanted)] == wanted
    key = wanted[0].split()[0]
    table = "embeddings" if key == "vec_id" else "documents"
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    rows = made.collect()
    assert {r[key] for r in rows} == ids and (name == "op10_packing" or len(rows) == len(ids))
    if name in ORACLES:
        relation = connect(SF).sql(ORACLES[name])
        assert _rows(made.columns, rows) == _rows(relation.columns, relation.fetchall())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    said = QUERIES["op2_language_id"](spark, sf).join(docs, "doc_id").where("held_out")
    assert said.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    good = QUERIES["op9_quality"](spark, sf).join(labels, "doc_id").where("held_out")
    assert good.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.98
    bad = QUERIES["op5_toxicity"](spark, sf).withColumnRenamed("toxic", "flag").join(labels, "doc_id").where("held_out")
    rates = {r[0]: r[1] for r in bad.groupBy("toxic").agg(F.avg(F.col("flag").cast("int"))).collect()}
    assert rates[1] > 0.85 and rates[0] < 0.03


def test_pipeline_stages(spark):
    """Every stage's decision against its own input, on small tables."""
    sf = SF
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, made[-1], sf)
        made.append(spark.createDataFrame(out.collect(), out.schema))
    for frame in made[1:-1]:
        assert frame.columns == list(corpus_pipeline.COLUMNS)
    before, kept, lined, near, passed, packed = made
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    wrong = [d for d, q in labels.items() if (d in ids) != bool(q)]
    assert len(wrong) <= 0.05 * len(labels)
    con = duckdb.connect()
    con.register("documents", kept.toPandas())
    want = {r[0]: r[3] for r in con.sql(ORACLES["op8_line_dedup"]).fetchall()}
    assert {r.doc_id: r.h for r in lined.select("doc_id", F.sha2("text", 256).alias("h")).collect()} == want
    from tests.llm import data

    rows = [(r.doc_id, r.text) for r in lined.orderBy("doc_id").collect()]
    sets = [data.shingle_set(t, 5) for _, t in rows]
    links = [
        (i, j) for i, a in enumerate(sets) for j in range(i)
        if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j])
    ]
    least = data.least_ids(rows, data.components(len(rows), links))
    keep = {i for (i, _), c, s in zip(rows, least, sets) if not s or i == c}
    assert {r.doc_id for r in near.collect()} == keep
    assert {r.doc_id for r in passed.collect()} == keep == {r.doc_id for r in packed.collect()}
    assert passed.where("length(text) < 0").count() == 0


def test_near_dedup_keeps_one_row_of_each_group(spark):
    """Repeated rows, an id with several texts and null ids."""
    one, two, near = "a b c d e f g h i j", "k l m n o p q r s t", " ".join(f"n{i}" for i in range(60))
    rows = [(1, one)] * 3 + [(2, two), (2, one), (None, one), (None, two), (None, "only here u v w x y z")]
    rows += [(None, "and here u v w x z y"), (None, near), (7, near + " more"), (7, near), (8, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "src", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs.repartition(3), SF).collect()]
    assert {t for _, t in left} >= {one, two, "only here u v w x y z", "and here u v w x z y", "", None}
    assert sorted(i for i, _ in left if i is not None) == [1, 2, 7, 8]
    assert len(left) == 7


def test_filter_audit_agrees_with_sql(spark):
    made = QUERIES["op11_filter_audit"](spark, SF)
    relation = connect(SF).sql(ORACLES["op11_filter_audit"])
    assert made.columns == relation.columns and made.count() % 600 == 0
    assert _rows(made.columns, made.collect()) == _rows(relation.columns, relation.fetchall())

