import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.llm.test_fertility import brute as base_measures
from tests.llm.test_fertility import files
from tests.llm.test_ngram_join import brute as classes
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.fertility import measure_quality
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.llm.secret_scan import RULES, redact_secrets
from tidemark.sources.scratch import scratch_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, tables[-1], SF_DIR).toPandas()
        tables.append(spark.createDataFrame(rows))
    return tables


def test_columns(stages):
    for table in stages[1:4]:
        assert table.columns == stages[0].columns


def test_each_decision_takes_effect(spark, stages, vocabulary):
    given, good, single, clean, packed = (table.collect() for table in stages)
    judged = measure_quality(stages[0], *files(vocabulary)).collect()
    assert {r.doc_id for r in good} == {r.doc_id for r in judged if r.kept}
    failed = {r.doc_id for r in given if base_measures(r.text)[-1]}
    assert failed and not failed & {r.doc_id for r in good}
    rows = [(r.doc_id, r.text) for r in good]
    assert {r.doc_id for r in single} == {c for _, _, c in classes(rows, corpus_pipeline.NEAR_COPIES)}
    before = {r.doc_id: r.text for r in single}
    assert {r.doc_id for r in clean} == set(before)
    for row in clean:
        assert row.n_chars == len(row.text)
        hit = any(
            m.end(rule.group) - m.start(rule.group) >= rule.least
            for rule in RULES
            for m in re.compile(rule.pattern, rule.flags).finditer(before[row.doc_id])
        )
        assert hit == (row.text != before[row.doc_id])
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    sizes = defaultdict(int)
    for row in packed:
        sizes[row.doc_id] += row.length
    assert sizes == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean}


def test_run_equals_the_stages(spark, stages):
    def rows(df):
        return sorted(df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())

    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(stages[-1])


def test_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_empty(spark, stages):
    empty = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
    assert redact_secrets(empty).columns == empty.columns


def test_odd_ids_and_names(spark, stages):
    """Null and repeated ids, and columns with the names that stages use inside."""
    names = ["other_id", "own_id", "listed_id", "own_node", "class", "node", "kept_id", "fertility_measures"]
    some = stages[0].limit(60).collect()
    rows = [tuple(r) for r in some] + [(None, *tuple(r)[1:]) for r in some[:20]]
    rows += [(some[0].doc_id, *tuple(r)[1:]) for r in some[20:30]] + [(None, None, None, None, None)]
    schema = stages[0].schema
    docs = spark.createDataFrame(rows, schema)
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    for name, stage in corpus_pipeline.STAGES:
        given, result = docs.columns, stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(result.collect(), result.schema)
        if name != "packing":
            assert docs.columns == given
        if name == "near_copies":
            # Each text once; its rows with a null id are copies of those with one.
            texts = [r.text for r in docs.collect()]
            assert len(texts) == len(set(texts))
    assert docs.count() >= len(texts)


def test_a_stage_deletes_what_the_one_before_needed(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    folder = Path(scratch_folder(spark))
    before = set(folder.iterdir())
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        made = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
        if name == "near_copies":
            assert made <= {"ngram-losers", "ngram-unclear", "ngram-winners"}
        if name == "secrets":
            assert made == set()


def test_stages_that_are_not_stored_between(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() > 0
