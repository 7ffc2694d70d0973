"""The pipeline's stages and its edge cases."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def edge_documents(spark):
    """Documents of the small table with nulls in every column, empty and repeated rows and extra columns."""
    docs = read_table(spark, SMALL, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "12 34", None, "s", 5), (-3, "Allein hier.", None, None, None), (None, "Ohne Nummer hier", "de", "s", 16)],
        docs.schema,
    )
    return docs.unionByName(odd).unionByName(docs.limit(3)).withColumn("key", F.lit(1)).withColumn("told", F.lit("x")).coalesce(1)


def test_stages_keep_columns_and_survive_odd_rows(spark, tmp_path):
    docs = edge_documents(spark)
    counts = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        folder = f"{tmp_path}/{number}"
        docs.write.parquet(folder)
        docs = spark.read.parquet(folder)
        counts.append(docs.count())
        docs = stage(spark, docs, SMALL)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert counts[1] == counts[0] - 3  # null, empty and without a letter
    assert counts[2] < counts[1] and docs.count() == counts[-1]


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    texts = [(4, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "null id only"), (9, "alone in here")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["2", "9", "None"]


def test_near_duplicate_stage_survives_files_cut_anew(spark, tmp_path, monkeypatch):
    texts = [(i, f"alone {i} in here " * (1 + i % 7)) for i in range(40)] + [(100 + i, "a b c d e f") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(6).write.parquet(f"{tmp_path}/docs")
    plain = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), SMALL).collect()
    groups = corpus_pipeline.simhash.near_duplicates

    def then_cut_anew(*args, **kwargs):
        found = groups(*args, **kwargs)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return found

    monkeypatch.setattr(corpus_pipeline.simhash, "near_duplicates", then_cut_anew)
    try:
        kept = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), SMALL).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in plain)
    assert sum(r["text"] == "a b c d e f" for r in kept) == 1


def test_empty_table_passes_all_stages(spark):
    docs = read_table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_run_follows_the_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns[:2] == ["doc_id", "lang"] and 0 < rows.count() <= read_table(spark, SMALL, "documents").count()


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
