import hashlib

import corpus_pipeline
import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from quarrylane.llm import bpe, line_dedup, mixing, rule_classifier, simhash
from quarrylane.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
LABELS = "doc_id bigint, quality int, toxic int"


def staged(spark, docs, sf_dir, where):
    """What each stage returns, written and read again as run() does."""
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{where}/{k}")
        out.append(spark.read.parquet(f"{where}/{k}"))
    return out


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = staged(spark, docs, SF, str(tmp_path))
    assert all(f.columns == docs.columns for f in frames[:-1])
    counts = [f.count() for f in frames]
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2]
    removed = frames[1].select("doc_id", F.length("text").alias("n")).join(frames[2].select("doc_id", F.length("text").alias("m"), "n_chars"), "doc_id")
    assert removed.where("m < n").count() and not removed.where("m > n or n_chars <> m").count()
    unique = frames[3].toPandas()
    prints = [simhash.fingerprint(t) for t in unique.text]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    tokenizer = bpe.load(tokenizer_path())
    texts = dict(zip(unique.doc_id, unique.text, strict=True))
    rows = frames[-1].toPandas()
    assert len(rows) == counts[4] >= len(unique) * 0.5
    for r in rows.itertuples():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.token_ids) == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    # The places are those of the mix: each row of its files once.
    mix = spark.read.parquet(f"{tmp_path}/3").select(F.col("_metadata.file_name").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row"), "doc_id")
    assert sorted(map(tuple, mix.collect())) == sorted(zip(rows.mix_file, rows.mix_row, rows.doc_id, strict=True))


def test_run_gives_the_same(spark):
    one, two = (corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").toPandas().sort_values(["doc_id", "ids_sha256"]).reset_index(drop=True) for _ in range(2))
    assert one.equals(two) and len(one)


@pytest.fixture
def folder(spark, docs_of, tmp_path):
    """Odd rows and labels for some of them, as tables of a folder."""
    docs = docs_of(ODD).drop("d", "key")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 1, 1), (4, 1, 0), (4, 1, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_odd_rows_go_through_all_stages(spark, folder):
    """Nulls, empty and long texts, ties and repeats; labels of one kind reject nothing."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = staged(spark, docs, folder, f"{folder}/out")
    assert [f.count() for f in frames[:3]] == [len(ODD)] * 3
    kept = {(r.doc_id, r.text) for r in frames[3].collect()}
    assert kept <= {(r.doc_id, r.text) for r in frames[2].collect()} and len(kept) == len({simhash.fingerprint(t) for _, t in kept})
    assert {r.doc_id for r in frames[5].collect()} <= {i for i, _ in kept}


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert [f.count() for f in staged(spark, docs, folder, str(tmp_path / "empty"))] == [0] * 6


def test_stages_keep_columns_of_any_name(spark, folder):
    """keep_good, dedup_lines, keep_one_per_group and materialised pass on what else a table has."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as row", "2 as __text", "3 as unknown", "4 as id", "5 as hash", "6 as position", "7 as n_words", "8 as `a b,c`", "9 as kept_lines")
    for stage in (lambda d: rule_classifier.keep_good(d, labels), simhash.keep_one_per_group, mixing.materialised, lambda d: line_dedup.dedup_lines(d).select(*d.columns)):
        out = stage(docs)
        assert out.columns == docs.columns
        assert {tuple(r)[5:] for r in out.collect()} == {(1, 2, 3, 4, 5, 6, 7, 8, 9)}
        assert stage(docs.limit(0)).count() == 0
