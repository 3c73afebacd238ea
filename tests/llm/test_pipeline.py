"""The pipeline stage by stage and as a whole, and its registration."""

import hashlib

import public_tokenizers as P
import tiktoken

import __spark_entry__ as E
import corpus_pipeline as C
from quarry.llm import bpe, decontaminate, neardup, quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    after = [docs]
    for name, stage in C.STAGES[:-1]:
        after.append(stage(spark, after[-1], SF).cache())
        assert after[-1].columns == COLUMNS, name
    ids = [{r.doc_id for r in d.collect()} for d in after]
    assert ids[1] == {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    assert ids[2] == {r.doc_id for r in neardup.near_duplicates(after[1]).collect() if r.kept}
    assert ids[3] == ids[2] - {r.doc_id for r in decontaminate.contaminated(after[2], items).collect()}
    assert ids[4] == ids[3]
    text = {r.doc_id: r.text for r in docs.collect()}
    changed = {r.doc_id for r in after[4].collect() if r.text != text[r.doc_id]}
    assert all("[SECRET]" in r.text for r in after[4].collect() if r.doc_id in changed)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                 mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    want = {r.doc_id: (encoding.encode_ordinary(r.text), hashlib.sha256(r.text.encode()).hexdigest())
            for r in after[4].collect()}
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in C.run(spark, SF).collect()}
    assert got == want


def test_all_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op") and k[2].isdigit()}
    assert "pipeline" in names and len(C.STAGES) == 5
    assert set(E.oracle_sql()) <= names


def _odd(docs_of):
    """Null, empty and long texts, repeated ids with several texts, equal rows, no ids, and clashing columns."""
    text = "the quick brown fox jumps over the lazy dog while seven wizards watch from a quiet hill at dawn"
    rows = [(i, f"{text} number {i} and {i * 7} in plain prose") for i in range(20)]
    rows += [(100, None), (101, ""), (102, "word " * 60_000), (103, "b " + text), (103, "a " + text), (103, None), (104, text),
             (104, text), (None, text), (None, None), (105, f"password=hunter2hunter2 {text}")]
    return docs_of(rows).selectExpr("*", *[f"'{c}' AS {c}" for c in (
        "kept", "score", "predicted", "base", "found", "tested", "n_shingles", "component", "row", "place", "count",
        "item_id", "tokens", "ids", "decoded")])


def test_every_stage_takes_odd_rows(spark, docs_of):
    docs = _odd(docs_of)
    for name, stage in C.STAGES:
        first = sorted(map(str, stage(spark, docs, SF).collect()))
        assert first == sorted(map(str, stage(spark, docs.repartition(7), SF).collect())), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name != C.STAGES[-1][0]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert all(r[c] == c for r in out.collect() for c in docs.columns[5:])


def test_repeated_ids_keep_the_smallest_text(spark, docs_of):
    kept = neardup.keep_first(_odd(docs_of)).collect()
    by = {}
    for r in kept:
        by.setdefault(r.doc_id, []).append(r.text)
    assert all(len(t) == 1 for i, t in by.items() if i is not None) and len(by[None]) == 2
    if 103 in by:
        assert by[103] == [None]
    assert 100 in by and 101 in by


def test_pipeline_runs_alike_twice(spark):
    assert sorted(map(str, C.run(spark, SF).collect())) == sorted(map(str, C.run(spark, SF).collect()))
