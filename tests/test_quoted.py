"""CSV files with quoted line breaks, read in splits."""

from __future__ import annotations

import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import files, quoted
from ledgerline.workloads import quality
from ledgerline.workloads.binding import Binding


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def whole(spark, path, encoding="UTF-8"):
    """All records by the reader's own parse of whole files."""
    raw = spark.read.csv(path, header=True, lineSep="\n", quote='"', escape='"', encoding=encoding, multiLine=True)
    return sorted((tuple(r) for r in raw.collect()), key=str)


def cell(draw):
    text = "".join(draw.choice(["a", "b ", ",", "\n", '"', "\n\n", "x,y", '""', "é", "\t"]) for _ in range(draw.randrange(0, 14)))
    if any(c in text for c in ',\n"'):
        return '"' + text.replace('"', '""') + '"'
    return text


@pytest.mark.parametrize("bits", [0, 3])
def test_records_run_through_parts_of_splits(spark, tmp_path, monkeypatch, small_splits, bits):
    monkeypatch.setattr(quoted, "PART_BITS", bits)
    path = tmp_path / "a.csv"
    texts = ["\n" * (i % 40) + f'x"{i}' for i in range(200)]
    path.write_text("id,text\n" + "".join('%d,"%s"\n' % (i, t.replace('"', '""')) for i, t in enumerate(texts)))
    got = files.read_csv_robust(spark, str(path), row_order=True).orderBy(files.ROW_ORDER).collect()
    assert [(r["id"], r["text"]) for r in got] == [(str(i), t) for i, t in enumerate(texts)]
    assert quoted.lines_of(spark, str(path), "UTF-8").groupBy("file", "block", "part").count().agg(F.max("count")).first()[0] <= 1 << bits


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_equal_those_of_a_whole_parse(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    rows = [f"{i},{cell(draw)},{cell(draw)},end" for i in range(900)]
    path = tmp_path / "a.csv"
    path.write_bytes(("id,one,two,three\n" + "\n".join(rows) + "\n").encode())
    df = files.read_csv_robust(spark, str(path), row_order=True)
    got = [tuple(None if c is None else c for c in r[:4]) for r in df.orderBy(files.ROW_ORDER).collect()]
    assert [r[0] for r in got] == [str(i) for i in range(900)]
    expected = [tuple(None if c in files.MISSING_CELLS else c for c in r) for r in whole(spark, str(path))]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert quoted.lines_of(spark, str(path), "UTF-8").select("block").distinct().count() > 5


def test_one_break_in_a_large_file_leaves_it_split(spark, tmp_path, small_splits):
    lines = [f"{i},plain {i}" for i in range(6_000)]
    lines[3_000] = '3000,"two\nlines"'
    path = tmp_path / "large.csv"
    path.write_text("id,text\n" + "\n".join(lines) + "\n")
    lines = quoted.lines_of(spark, str(path), "UTF-8")
    assert lines.groupBy("block").count().agg(F.count("*"), F.max("count")).first()[1] < 400
    df = files.read_csv_robust(spark, str(path))
    assert df.count() == 6_000
    assert df.where("id = 3000").first()["text"] == "two\nlines"


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i}, ""quoted""' for i in range(2_000))
    path = tmp_path / "long.csv"
    path.write_text(f'"id\nnumber",text\n1,"{long}"\n2,"a\nb"\n\n3,c\n')
    got = {r["id\nnumber"]: r["text"] for r in files.read_csv_robust(spark, str(path)).collect()}
    assert got == {"1": long.replace('""', '"'), "2": "a\nb", "3": "c"}


def test_odd_quotes_and_encodings(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes('﻿id,text\r\n1,5" pipe\r\n2,"a\r\nb"\r\n3,6" and 7" pipes,more\r\n4,"x" y\r\n5,"say ""hi"""\r\n'.encode())
    got = [tuple(r) for r in files.read_csv_robust(spark, str(path)).orderBy("id").collect()]
    assert got == [("1", '5" pipe'), ("2", "a\nb"), ("3", '6" and 7" pipes'), ("4", '"x" y'), ("5", 'say "hi"')]
    plain = tmp_path / "plain.csv"
    plain.write_text('id,text\n1,5" pipe\n2,x\n')
    assert not files.inspect_csv(spark, str(plain)).quoted_line_breaks
    latin = tmp_path / "latin.csv"
    latin.write_bytes('id,text\n1,"café\nnoir"\n2,naïve\n'.encode("latin-1"))
    assert [r["text"] for r in files.read_csv_robust(spark, str(latin)).orderBy("id").collect()] == ["café\nnoir", "naïve"]


def test_several_files_with_headers(spark, tmp_path, small_splits):
    for i in range(4):
        (tmp_path / f"p{i}.csv").write_text("a,b\n" + "".join(f'{i},"x\n{j}"\n' for j in range(300)))
    df = files.read_csv_robust(spark, str(tmp_path))
    assert df.columns == ["a", "b"] and df.count() == 1_200 and df.distinct().count() == 1_200


def test_a_quote_left_open_is_an_error_beyond_the_bound(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n1,"x\n' + "2,y\n" * 500)
    lines = quoted.lines_of(spark, str(path), "UTF-8")
    with pytest.raises(ValueError, match="left open"):
        quoted.records_of(lines, most_bytes=1_000)
    assert quoted.records_of(lines).count() == 2


def by_character(line, inside):
    state = "in" if inside else "border"
    for c in line:
        if state == "in":
            state = "quote" if c == '"' else "in"
        elif state == "quote" and c == '"' or state == "border" and c == '"':
            state = "in"
        else:
            state = "border" if c == "," else "plain"
    return state == "in"


def test_states_of_lines(spark):
    draw = random.Random(8)
    lines = ["", '"', '""', "a,b", *["".join(draw.choice('",a ') for _ in range(draw.randrange(12))) for _ in range(400)]]
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    got = rows.select("line", *[quoted.ends_inside(F.col("line"), b) for b in (False, True)]).collect()
    for line, outside, inside in got:
        assert (outside, inside) == (by_character(line, False), by_character(line, True)), line


def test_names_of_cells():
    assert quoted.cell_names('a,"b\nc",,a') == ["a0", "b\nc", "_c2", "a3"]
    assert quoted.cell_names("") == []


def test_a_table_of_many_splits_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    texts = F.concat(F.lit('a "b"\n'), F.col("id").cast("string"), F.lit("\r\n,c"))
    rows = spark.range(0, 400, 1, 6).select(F.col("id").alias("doc_id"), texts.alias("text"), F.lit("en").alias("lang"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(quality, "_scratch", lambda b, name: str(tmp_path / name))
    open_cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (open_cost, most)}
    try:
        spark.conf.set(open_cost, "0")
        spark.conf.set(most, "1k")
        got = quality.quoted_csv_round_trip(Binding(spark, str(tmp_path))).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "texts").glob("part-*.csv"))) > 2
    expected = [f'a "b"\n{i}\n,c' for i in range(400)]
    assert sorted((r["doc_id"], r["text_md5"], r["n_chars"]) for r in got) == [(i, md5(t.encode()).hexdigest(), len(t)) for i, t in enumerate(expected)]
