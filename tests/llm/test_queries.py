"""The registered text queries against their SQL twins, and the pipeline stage by stage."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from strideframe.llm import decontaminate, oracles, queries, simhash, superkmer
from strideframe.llm.tokens import load

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    assert set(queries.ALL) <= set(contract.queries()) and set(oracles.ALL) <= set(contract.oracle_sql())
    assert [n.split("_")[0] for n in queries.ALL] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", sorted(oracles.ALL))
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    want = duck.execute(oracles.ALL[name]).fetch_df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) == len(want) > 0
    got, want = (x[cols].sort_values(cols, ignore_index=True) for x in (got, want))
    for c in cols:
        assert (got[c] == want[c]).all(), c


def test_line_and_window_queries_drop_something(spark):
    assert queries.op6_line_dedup(spark, SF).where("n_dropped > 0").count() > 0
    assert queries.op7_substring_dedup(spark, SF).where("n_removed > 0").count() > 0


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_token_queries(spark):
    docs = texts(spark)
    word, byte = (load(public_tokenizers.path(f)) for f in (queries.WORD_TOKENIZER, queries.BYTE_TOKENIZER))
    ids = {i: np.array([*word.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, t in docs.items()}
    seen = dict.fromkeys(docs, 0)
    for r in queries.op8_packing(spark, SF).orderBy("doc_id", "start").collect():
        own = ids[r.doc_id]
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(own)
        seen[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(own[r.start : seen[r.doc_id]].tobytes())
    assert seen == {i: len(x) for i, x in ids.items()}
    at = 0
    for r in queries.op9_bitplane_tokens(spark, SF).orderBy("doc_id").collect():
        own = np.array([*byte.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    columns = docs.columns

    clean = stages["toxicity"](spark, docs, SF).cache()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    assert clean.columns == columns and gone and all(labels.get(i, 1) for i in gone)

    lines = stages["line_dedup"](spark, clean, SF).cache()
    assert lines.columns == columns and lines.count() == clean.count()
    assert all(r.n_chars == len(r.text) for r in lines.collect() if r.text is not None)

    one = stages["simhash_dedup"](spark, lines, SF).cache()
    assert one.columns == columns
    groups = {}
    for r in simhash.near_duplicates(lines).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(r.doc_id for r in one.collect()) == sorted(min(g) for g in groups.values())

    safe = stages["decontamination"](spark, one, SF).cache()
    assert safe.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    automaton = decontaminate.build(items)
    for r in one.collect():
        words = decontaminate.normal_words(r.text)
        hit = sum(n for _, n in automaton.scan(words)[0])
        bad = hit > 0 and 20 * hit >= len(words)
        assert bad == (r.doc_id not in {x.doc_id for x in safe.select("doc_id").collect()})

    pieces = stages["packing"](spark, safe, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in safe.collect()}


def test_run_is_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    got = corpus_pipeline.run(spark, SF)
    assert got.agg({"length": "sum"}).first()[0] == corpus_pipeline.pack(spark, docs, SF).agg({"length": "sum"}).first()[0]
    assert corpus_pipeline.ORACLE_SQL is None


def test_window_size_of_the_contract():
    assert superkmer.WINDOW == 20 and decontaminate.WINDOW == 13
