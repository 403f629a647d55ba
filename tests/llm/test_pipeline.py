"""The corpus pipeline on the smallest table and on odd rows: every stage against its operator."""

import tempfile

import pytest

import corpus_pipeline as C
from stockout.llm import decontaminate, minhash, secrets, sentencepiece

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, stage in C.STAGES[:-1]:
        path = f"{tempfile.mkdtemp()}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        seen[name] = ({r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"]: r["text"] for r in after.collect()})
        docs = after
    before, after = seen["quality"]
    clean = [i for i in before if labels.get(i) == 1]
    junk = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.98 * len(clean) and sum(i in after for i in junk) <= 0.05 * len(junk)
    before, after = seen["near_duplicates"]
    first = {}
    for i in sorted(before):
        first.setdefault(" ".join(minhash.words_of(before[i])), i)
    assert set(after) <= set(first.values()) and all(before[i] == after[i] for i in after)
    before, after = seen["decontaminate"]
    items = [" ".join(decontaminate.words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, text in before.items():
        if any(f" {item} " in f" {' '.join(decontaminate.words_of(text))} " for item in items):
            assert i not in after
    assert len(after) > 0.5 * len(before)
    before, after = seen["secrets"]
    assert set(before) == set(after)
    assert not any(secrets.N_BASE and "token = \"" in t and "[secret]" not in t for t in after.values())
    table = sentencepiece.load_pieces(sentencepiece.default_model())
    out = C.tokens(spark, docs, SF)
    decoded = {r["doc_id"]: r["text"] for r in sentencepiece.decode_documents(out, table).collect()}
    assert decoded == after


@pytest.mark.parametrize("empty", [True, False])
def test_odd_and_empty_tables(spark, empty):
    root = tempfile.mkdtemp()
    rows = [(None, None, None, "k"), (1, "", 0, "k"), (2, "word " * 20_000, 1, "k"), (2, "word " * 20_000, 1, "k"),
            (3, "one two three four five six seven", 9, None)]
    spark.createDataFrame([] if empty else rows, "doc_id long, text string, n_chars long, _gone string") \
        .write.parquet(f"{root}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    out = C.run(spark, root).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == (
        [] if empty else [(False, 1), (False, 2), (False, 3), (True, 0)])
