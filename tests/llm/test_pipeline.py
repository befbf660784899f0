"""The pipeline on odd and on planted rows."""

import numpy as np
from llm_data import LABELS, SCHEMA, odd_rows, row

import corpus_pipeline
from tokenloom.llm.packing import WordEncoder
from tokenloom.llm.queries import tokenizer_path


def folder_of(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def texts_of(rows):
    """Ids of each copy of a document, in order of ``start``."""
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_planted_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(300):
        words = [f"{'abcdefg'[rng.integers(7)]}{'aeiou'[rng.integers(5)]}{rng.integers(40)}n" for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[10:10] = ["idiot", "moron"]
        rows.append(row(i, " ".join(words), "en", f"s{i % 2}"))
        labels.append((i, 1, int(bad)))
    rows.append(row(1001, rows[1][1] + " more", "en", "s1"))
    rows.append(row(1002, rows[2][1] + " token = abcdefghijkl123", "en", "s0"))
    folder = folder_of(spark, tmp_path, rows, labels)
    result = corpus_pipeline.run(spark, folder).collect()
    left = {r.doc_id for r in result}
    assert not any(i % 4 == 0 for i in left if i < 300)
    assert 1001 not in left and 1002 not in left
    ids = WordEncoder(tokenizer_path()).encode(" token = abcdefghijkl123")
    assert all(np.frombuffer(ids, "<u4")[-3:].tolist() != r.ids[-4:-1] for r in result)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    folder = folder_of(spark, tmp_path, odd_rows(), [(4, 1, 0), (5, None, None), (None, 1, 1)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == [f.name for f in SCHEMA], name
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, [], [])).count() == 0
