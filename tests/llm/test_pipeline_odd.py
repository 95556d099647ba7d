"""The pipeline over odd and empty tables."""

import pytest

import corpus_pipeline


def tables(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_rows_pass_through(spark, odd, tmp_path):
    labels = [(2, 1, 0), (4, 1, 0), (5, None, None), (None, 0, 1), (5, 0, 0)]
    folder = tables(spark, tmp_path, odd, labels, [(1, None), (2, ""), (3, "MIXED Ünïcode — text 漢字 😀 end")])
    out = corpus_pipeline.run(spark, folder)
    assert set(out.columns) == {*odd.columns, "slot"} and out.schema["shard"].dataType.simpleString() == "int"
    rows = out.collect()
    taken = {r["doc_id"] for r in rows}
    # 5, 6, a missing id and -9 are copies of each other; 8 is an item of the benchmark.
    assert taken <= {-9, 1, 2, 3, 4, 7, None} and 8 not in taken
    assert all(r["size"] == 7 and r["spans"] == "own" and r["p_toxic"] == 0.5 for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("labelled", [False, True])
def test_no_documents(spark, none, tmp_path, labelled):
    labels = [(1, 0, 1)] if labelled else []
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, none, labels, [])).count() == 0
