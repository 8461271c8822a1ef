import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from ledgermart.llm import decontamination, jaccard, mixing, quality  # noqa: E402
from ledgermart.llm.queries import OPERATORS, oracle_sql, queries  # noqa: E402

from .test_decontamination import brute as contaminated  # noqa: E402
from .test_jaccard import shingle_set  # noqa: E402
from .test_quality import base_rules  # noqa: E402

DIRECTORY = "/root/testdata/sf0.001"


def test_stages_step_by_step(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "benchmark_passages", "mix", "token_files"]

    weights = quality.fitted_weights(docs, spark.read.parquet(f"{DIRECTORY}/labels.parquet"))
    verdict = {r["doc_id"]: r["kept"] for r in quality.with_quality(docs, weights).collect()}
    kept = stages["quality_rules"](spark, docs, DIRECTORY).checkpoint()
    left = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == columns and left == {i for i, ok in verdict.items() if ok}
    assert all(base_rules(rows[i])[0] >= 50 for i in left)

    sets = {i: shingle_set(rows[i]) for i in left}
    alike = lambda x, y: 100 * len(x & y) >= 85 * len(x | y)
    single = stages["near_duplicates"](spark, kept, DIRECTORY).checkpoint()
    ones = {r["doc_id"] for r in single.collect()}
    assert single.columns == columns
    assert all(i in ones or any(j < i and alike(sets[i], sets[j]) for j in left) for i in left)
    assert not any(i < j and alike(sets[i], sets[j]) for i in ones for j in ones)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()]
    clean = stages["benchmark_passages"](spark, single, DIRECTORY).checkpoint()
    bad = contaminated({i: rows[i] for i in ones}, items)
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {i for i in ones if not bad[i][4]}

    mix = stages["mix"](spark, clean, DIRECTORY).checkpoint()
    copies = {r["doc_id"]: r["_copies"] for r in mixing.sampled(mixing.sized(clean)).collect()}
    assert mix.columns == columns
    assert {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}

    coded = stages["token_files"](spark, mix, DIRECTORY).orderBy("start").collect()
    assert len(coded) == sum(copies.values())
    assert [r["start"] for r in coded][1:] == [r["start"] + r["n_tokens"] for r in coded][:-1]

    whole = corpus_pipeline.run(spark, DIRECTORY).orderBy("start").collect()
    assert [tuple(r) for r in whole] == [tuple(r) for r in coded]


def test_stages_on_odd_tables(spark, documents, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, text), (1, text), (None, text), (2, None), (3, "")]).withColumn("extra", F.lit(1))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, str(tmp_path))
            assert name == "token_files" or out.columns == given.columns
            out.collect()
    assert decontamination.decontaminated(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == 5
    assert jaccard.one_of_each(docs).count() == 4


def test_registered_queries(spark):
    from ledgermart.registry.compare import compare, connect

    con = connect(DIRECTORY)
    assert len(OPERATORS) == 10 and oracle_sql().keys() <= queries().keys()
    for name, sql in oracle_sql().items():
        same, note = compare(spark, con, DIRECTORY, queries()[name], sql)
        assert same, (name, note)


def test_near_copies_of_four_fifths_go(spark, documents):
    words = [f"w{i}" for i in range(1000)]
    block, single = list(words), list(words)
    block[400:490] = [f"x{i}" for i in range(90)]  # 0.83 of five-word shingles
    single[20:1000:45] = [f"y{i}" for i in range(22)]  # 0.80 of five-word, 0.84 of four-word shingles
    far = list(words)
    far[400:520] = [f"z{i}" for i in range(120)]  # 0.78
    docs = documents([" ".join(w) for w in (words, block, far)] + [" ".join(["v" + w for w in x]) for x in (words, single)])
    split = [r["text"].split() for r in docs.orderBy("doc_id").collect()]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in split]
    share = lambda x, y: len(x & y) / len(x | y)
    assert 0.8 <= share(sets[0], sets[1]) < 0.85 and 0.8 <= share(sets[3], sets[4]) < 0.85 and share(sets[0], sets[2]) < 0.8
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert {r["doc_id"] for r in left} == {0, 2, 3}
    assert jaccard.one_of_each(docs).count() == 5
