"""The pipeline's stages on a small table, each against the operator's own result; and the wiring."""

from __future__ import annotations

import __spark_entry__ as wiring
import corpus_pipeline
from pyspark.sql import functions as F

from accountrisk.llm import decontaminate, jaccard, pii, pu_quality
from accountrisk.session import written

FOLDER = "/root/testdata/sf0.01"


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    good = written(stages["quality"](spark, docs, FOLDER), "test")
    assert good.columns == docs.columns
    assert ids(good) == ids(pu_quality.score_quality(docs, labels).where("predicted = 1"))
    single = written(stages["near_duplicates"](spark, good, FOLDER), "test")
    groups = jaccard.link_documents(good).collect()
    assert ids(single) == {r.component_id for r in groups} and single.count() == len({r.component_id for r in groups})
    clean = written(stages["contamination"](spark, single, FOLDER), "test")
    assert ids(single) - ids(clean) == ids(decontaminate.decontaminate(single, items).where("contaminated"))
    private = written(stages["personal_data"](spark, clean, FOLDER), "test")
    assert private.columns == docs.columns and private.count() == clean.count()
    assert not any(pii.base_spans(r.text) for r in private.collect())
    last = stages["tokens"](spark, private, FOLDER)
    assert last.count() == private.count() and last.where("size(ids) <> n_tokens").count() == 0


def test_near_duplicates_of_repeated_rows_and_ids(spark):
    def text(k, n=40):
        return " ".join(f"w{k}x{i}" for i in range(n))

    near = text(3) + " and more"
    rows = [(1, text(1), "en"), (1, text(1), "en"), (1, text(1), "en")]  # a row that repeats
    rows += [(3, text(3), "en"), (5, near, "en"), (5, text(5), "en")]  # an id that repeats, with near copies of 3 and of nothing
    rows += [(7, text(7), "en"), (7, text(8), "en")]  # an id that repeats, of two components
    rows += [(9, text(9), "de"), (9, text(9), "en")]  # the same text and id, another column differs
    rows += [(None, text(2), "en"), (None, text(2), "de"), (None, near, "en"), (None, text(4), "en")]
    rows += [(None, None, "en"), (None, " ", "en"), (None, None, "en"), (2, "", "en"), (2, "", "en"), (6, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert got.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    want = [(1, text(1)), (3, text(3)), (5, text(5)), (7, text(7)), (7, text(8)), (9, text(9)), (None, text(2)), (None, text(4))]
    want += [(None, None), (None, " "), (2, ""), (6, "")]
    assert got == sorted(want, key=repr)


def test_personal_data_takes_one_worker_a_task(spark):
    rows = [(1, "card 4111 1111 1111 1111 or a@b.org, 10.0.0.1", 9), (2, "call (555) 201-3344 or +1 555 201 3344 after six", 9)]
    rows += [(3, None, None), (4, "", 0), (4, "ünïcode\nme@x.example.com", 9), (None, "no data here", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("pii", F.lit("stays"))
    got = corpus_pipeline.personal_data(spark, docs, FOLDER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and got.columns == docs.columns
    want = pii.redact(pii.find_pii(docs)).select("doc_id", "text", F.length("text").alias("n_chars"), F.lit("stays"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert {"<card>", "<email>", "<ip>", "<phone>"} <= {w.strip(",") for r in got.collect() for w in (r.text or "").split()}


def test_wiring():
    names = set(wiring.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
