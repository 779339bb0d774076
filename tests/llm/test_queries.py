"""Registered corpus queries: against their SQL, by plan, and the pipeline against plain Python."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from cases import documents, prose
from comparison import assert_same, open_tables
from reference import contamination, exact_groups, near_components, repeats, simhash_components
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from authlytics.llm import language, oracle, queries

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = list(queries.queries())
    assert set(names) <= set(registry.queries())
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")]
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) == set(oracle.STATEMENTS) <= set(names)


@pytest.mark.parametrize("name", oracle.STATEMENTS)
def test_matches_sql(spark, name):
    expected = open_tables(SF_DIR).sql(queries.oracle_sql()[name]).to_arrow_table()
    found = queries.queries()[name](spark, SF_DIR)
    assert set(found.columns) == set(expected.column_names)
    assert_same(found.select(expected.column_names), expected)


@pytest.mark.parametrize("name", ["op2_urls", "op3_chat"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_bpe_query_is_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in queries.op7_bpe(spark, SMALL).collect()}
    counted = {r["doc_id"]: r for r in queries.op4_prefix_counts(spark, SMALL).collect()}
    assert len(found) == len(counted) == len(texts)
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = found[doc_id]
        assert row["n_tokens"] == counted[doc_id]["n_tokens"] == len(ids)
        assert counted[doc_id]["over_limit"] == (len(ids) > 512)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows.collect()]


def test_simhash_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [(r[0], int(r[1], 16), r[2]) for r in queries.op13_simhash(spark, SF_DIR).collect()]
    assert sorted(found, key=repr) == simhash_components(pairs(docs))


def test_suffix_query_removes_planted_passages_by_their_bytes(spark, tmp_path):
    rows, lengths = [], {}
    for i, size in enumerate([300, 350, 399, 400, 401, 900]):
        passage = prose(i, 400).encode()[:size].decode(errors="ignore")
        passage += "x" * (size - len(passage.encode()))
        assert len(passage.encode()) == size and len(passage.split()) > 50
        for j in range(2):
            # Other bytes on both sides: the passage is all that the two texts share.
            own = f"{prose(100 + 10 * i + j, 60, 2000)}{'AB'[j]}{passage}{'CD'[j]}"
            rows.append((len(rows), own + prose(300 + 10 * i + j, 30, 2000)))
            lengths[rows[-1][0]] = size
    rows += [(50, prose(50, 300, 2000)), (51, prose(51, 20, 2000)), (52, None)]
    rows.append((53, f"{prose(53, 110)}E{prose(54, 30, 2000)}F{prose(53, 110)}"))
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in queries.op6_suffix_dedup(spark, str(tmp_path)).collect()]
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in repeats(rows, 400, False)]
    assert sorted(found) == sorted(expected)
    removed = {r[0]: r[2] for r in found}
    alone = {50: 0, 51: 0, 52: 0, 53: 2 * len(prose(53, 110).encode())}
    assert removed == {i: size if size >= 400 else 0 for i, size in lengths.items()} | alone


def test_suffix_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [tuple(r) for r in queries.op6_suffix_dedup(spark, SMALL).collect()]
    expected = repeats(pairs(docs), 400, False)
    assert sorted(found) == sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in expected)


def test_pipeline_stage_by_stage(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "drop_unidentified",
        "drop_exact_copies",
        "drop_near_copies",
        "drop_benchmark_passages",
        "encode_texts",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = [function for _, function in corpus_pipeline.STAGES]
    states = [docs]
    for stage in stages[:-1]:
        states.append(stage(spark, states[-1], SF_DIR).checkpoint())
        assert states[-1].columns == docs.columns
    identified, distinct, apart, clean = states[1:]

    model = language.train(language.sample(docs))
    scores = language.Tagger(model).predict([t for _, t in pairs(docs)]).max(axis=1)
    expected = [p for p, score in zip(pairs(docs), scores) if score >= 0.4]
    assert sorted(pairs(identified)) == sorted(expected)

    kept = {g[0] for g in exact_groups(pairs(identified)) if g[3]}
    assert sorted(pairs(distinct)) == sorted(p for p in pairs(identified) if p[0] in kept)

    components = near_components(pairs(distinct), 5)
    expected = [p for p in pairs(distinct) if components[p[0]][1] == p[0]]
    assert sorted(pairs(apart)) == sorted(expected)

    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    items = [tuple(r) for r in benchmark.collect()]
    hit = {d for d, _, n, _ in contamination(pairs(apart), items) if n}
    assert hit and sorted(pairs(clean)) == sorted(p for p in pairs(apart) if p[0] not in hit)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = {r["doc_id"]: r for r in stages[-1](spark, clean, SF_DIR).collect()}
    assert len(last) == clean.count()
    for doc_id, text in pairs(clean):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(last[doc_id]["ids"], "<u4").tolist() == ids
        assert last[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
    assert 0 < found.count() < spark.read.parquet(f"{SMALL}/documents.parquet").count()
