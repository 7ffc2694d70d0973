"""CSV reading and the whole load."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from ledgerline.operators import cleaning, integrity
from ledgerline.operators.profiling import column_profile
from ledgerline.plans import ingest
from ledgerline.sources import files, sinks, versions
from ledgerline.sources.contracts import ForeignKey, TableContract


def put(path, data: bytes) -> str:
    path.write_bytes(data)
    return str(path)


def test_carriage_returns_do_not_split_rows(spark, tmp_path):
    path = put(tmp_path / "a.csv", b'id,name,cur\r\n1,"a, b",INR\r\r\n2,x\ry,"USD"\r\n3,"q ""z""",\r\n')
    got = [tuple(r) for r in files.read_csv_robust(spark, path).orderBy("id").collect()]
    assert got == [("1", "a, b", "INR"), ("2", "xy", "USD"), ("3", 'q "z"', None)]


def test_latin_1_and_byte_order_mark(spark, tmp_path):
    latin = put(tmp_path / "l.csv", "id,name\n1,café\n2,naïve\n".encode("latin-1"))
    assert not files.inspect_csv(spark, latin).valid_utf8
    assert [r["name"] for r in files.read_csv_robust(spark, latin).orderBy("id").collect()] == ["café", "naïve"]
    marked = put(tmp_path / "b.csv", "id,name\n1,café\n".encode("utf-8-sig"))
    df = files.read_csv_robust(spark, marked)
    assert df.columns == ["id", "name"]
    assert df.first()["name"] == "café"


def test_quoted_line_breaks_are_detected(spark, tmp_path):
    path = put(tmp_path / "m.csv", b'id,text\n1,"two\nlines"\n2,one\n')
    assert files.inspect_csv(spark, path).quoted_line_breaks
    assert [r["text"] for r in files.read_csv_robust(spark, path).orderBy("id").collect()] == ["two\nlines", "one"]
    mixed = put(tmp_path / "x.csv", b'id,text\r\n1,"two\nlines"\r\n2,x\ry\r\n3,"a, ""b"""\r\n')
    got = [r["text"] for r in files.read_csv_robust(spark, mixed).orderBy("id").collect()]
    assert got == ["two\nlines", "xy", 'a, "b"']
    plain = put(tmp_path / "p.csv", b'id,text\n1,"one, line"\n')
    assert not files.inspect_csv(spark, plain).quoted_line_breaks


def test_row_order_follows_the_file(spark, tmp_path):
    path = put(tmp_path / "o.csv", b"v\n" + b"".join(b"%d\n" % i for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = files.read_csv_robust(spark, path, row_order=True)
        assert df.rdd.getNumPartitions() > 2
        ordered = [int(r["v"]) for r in df.orderBy(files.ROW_ORDER).select("v").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == list(range(50_000))


SOURCES = {
    "users": b"Id,Full Name,email,password,age,gender,marital,occupation,income,education,family size\n"
    b"U1, Ann ,a@x,p,30,F,,Student,,,2\nU1,Dup,,,,,,,,,\nU2,Bob,,,abc,M,,None,,,3\n",
    "restaurant": "id,name,city,rate,votes,Approx Cost (for two),cuisines,lic_no,link,address\n"
    "10.0,R1,X,--,1K+ ratings,₹ 200,\"North Indian, Chinese\",,,\n11,R2,Y,4.1,Too Few Ratings,₹ 300,,,,\n".encode(),
    "food": b"f_id,item,type\nfd1,Rice,Veg\nfd2,Egg,Non-veg\n",
    "menu": b"menu_id,r_id,f_id,cuisine,price\nmn0,10,fd1,Indian,50\nmn0,10,fd1,Indian,60\nmn0,10,fd9,Indian,70\nmn1,,fd1,X,1\n",
    "orders": b"order_date,sales_qty,amount,currency,user_id,r_id\n25/12/2019,1,100,INR\r,1,10.0\n03/04/2019,2,-50,USD,1,99\n"
    b"03/05/2019,2,70,INR,77,99\n04/05/2019,1,30,INR,,10\nsoon,1,20,INR,2,\n",
}


@pytest.fixture()
def sources(tmp_path):
    return {name: put(tmp_path / f"{name}.csv", data) for name, data in SOURCES.items()}


def test_load(spark, tmp_path, sources):
    target = str(tmp_path / "db")
    report = ingest.load(spark, sources, target)
    assert report.read == {"users": 3, "restaurant": 2, "food": 2, "menu": 4, "orders": 5}
    assert report.deduplicated == {"users": 1, "restaurant": 0, "food": 0, "menu": 2, "orders": 0}
    assert report.quarantined == {"users": 0, "restaurant": 0, "food": 0, "menu": 1, "orders": 2}
    assert report.stored == {"users": 2, "restaurant": 2, "food": 2, "menu": 1, "orders": 3}
    assert report.coerced == {"users": 1, "restaurant": 2, "food": 0, "menu": 0, "orders": 1}
    assert report.negative["orders"] == 1
    orders = spark.read.parquet(f"{target}/orders").orderBy("order_id").collect()
    assert [r["order_id"] for r in orders] == [1, 2, 3]
    assert [str(r["order_datetime"]) for r in orders] == ["2019-12-25 00:00:00", "2019-05-04 00:00:00", "None"]
    assert {r["currency"] for r in orders} == {"INR"}
    assert spark.read.parquet(f"{target}/menu").first()["price"] == 50
    rejected = spark.read.parquet(f"{target}/_quarantine/orders").collect()
    assert sorted(r["fk_column"] for r in rejected) == ["restaurant_id", "user_id"]
    users = spark.read.parquet(f"{target}/users").orderBy("user_id").collect()
    assert [(u["name"], u["age"], u["occupation"]) for u in users] == [("Ann", 30, "Student"), ("Bob", None, None)]
    tables = {n: spark.read.parquet(f"{target}/{n}") for n in SOURCES}
    orphans, missing = ingest.integrity_report(tables)
    assert all(r["orphans"] == 0 for r in orphans.collect())
    assert {r["fk_column"]: r["null_rows"] for r in missing.collect()} == {"user_id": 1, "restaurant_id": 1}

    with pytest.raises(RuntimeError, match="not empty"):
        ingest.load(spark, sources, target)
    again = ingest.load(spark, sources, target, reset=True, cluster_by={"orders": "order_datetime"})
    assert again.stored == report.stored
    with pytest.raises(ingest.CleaningRequired):
        ingest.load(spark, sources, target, reset=True, strict=True)


def test_guard_reports_missing_tables(spark, tmp_path):
    with pytest.raises(RuntimeError, match="missing"):
        sinks.guard_targets(spark, {"x": str(tmp_path / "none")}, reset=False, must_exist=True)


def test_exports(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.export_csv(spark.range(3), out, ["id"], single_file=True)
    assert [r["id"] for r in files.read_csv_inferred(spark, out).collect()] == [0, 1, 2]
    sinks.export_run_metadata(spark, str(tmp_path / "meta"), engine="seasonal", mae=1.5)
    assert spark.read.json(str(tmp_path / "meta")).first()["engine"] == "seasonal"


def test_import_and_sql(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    assert files.import_tables(spark, {"t_imported": str(tmp_path / "t")}) == ["t_imported"]
    assert files.query(spark, "SELECT max(id) AS m FROM t_imported").first()["m"] == 3


def test_samples_in_order_of_appearance(spark):
    df = spark.createDataFrame([(1, "z"), (2, "a"), (3, "z"), (4, "x" * 30), (5, None)], "at int, v string")
    row = column_profile(df, order_by="at", samples=3).where("column = 'v'").first()
    assert row["sample_values"] == "z, a, " + "x" * 22 + "..."
    assert (row["non_null"], row["nulls"], row["distinct_values"]) == (4, 1, 3)


def test_only_the_file_with_a_line_break_is_parsed_as_a_whole(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(10):
        lines = [f"{i},{j},plain {j}" for j in range(2_000)]
        if i == 3:
            lines[5] = '3,5,"two\nlines"'
        (folder / f"part-{i}.csv").write_text("a,b,c\n" + "\n".join(lines) + "\n")
    assert [t.quoted_line_breaks for t in files.inspect_csv_files(spark, str(folder)).values()] == [True]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = files.read_csv_robust(spark, str(folder))
        # The whole file is one task, the nine others are split into several each.
        assert df.rdd.getNumPartitions() > 20
        assert df.count() == 20_000
        assert df.where("a = 3 AND b = 5").first()["c"] == "two\nlines"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def state(spark, target):
    return {name: sorted(map(str, df.collect())) for name, df in versions.open_tables(spark, target).items()}


def test_a_load_runs_in_methods_that_the_jvm_compiles(spark, tmp_path, sources, monkeypatch):
    limit, seen, write = "spark.sql.codegen.hugeMethodLimit", [], ingest.write_table

    def noted(*args):
        seen.append(int(spark.conf.get(limit)))
        return write(*args)

    before = spark.conf.get(limit)
    monkeypatch.setattr(ingest, "write_table", noted)
    ingest.load(spark, sources, str(tmp_path / "clean"))
    assert set(seen) == {8_000} and spark.conf.get(limit) == before


@pytest.mark.parametrize("broken", ["food", "orders"])
def test_a_broken_load_leaves_readers_on_the_old_state(spark, tmp_path, sources, monkeypatch, broken):
    target = str(tmp_path / "db")
    ingest.load(spark, sources, target)
    old, opened = state(spark, target), versions.open_tables(spark, target)
    put(tmp_path / "users.csv", SOURCES["users"] + b"U3,Cyd,,,41,F,,,,,1\n")
    write = ingest.write_table

    def stop(df, path, *rest):
        if f"/{broken}/" in path:
            df.limit(1).write.parquet(path)
            raise OSError("killed")
        return write(df, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_table", stop)
        with pytest.raises(OSError, match="killed"):
            ingest.load(spark, sources, target, reset=True)
    assert versions.current(spark, target).version == 1 and state(spark, target) == old
    report = ingest.load(spark, sources, target, reset=True)
    assert versions.current(spark, target).version == 2 and report.stored["users"] == 3
    assert len(state(spark, target)["users"]) == 3 and state(spark, target)["orders"] == old["orders"]
    # Tables opened before the load are still those of the version before.
    assert opened["users"].count() == 2
    # A third load drops the first version and what the broken one left.
    ingest.load(spark, sources, target, reset=True)
    assert sorted(p.name for p in (tmp_path / "db" / "users").iterdir()) == ["version=2", "version=3"]


def test_a_first_load_that_breaks_can_be_repeated(spark, tmp_path, sources, monkeypatch):
    target = str(tmp_path / "db")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "require_reconciled", lambda check: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.load(spark, sources, target)
    assert versions.current(spark, target) is None and versions.open_tables(spark, target) == {}
    assert ingest.load(spark, sources, target).stored["orders"] == 3
    assert state(spark, target).keys() == set(SOURCES)


def test_one_version_is_published_once(spark, tmp_path):
    target = str(tmp_path / "db")
    versions.publish(spark, target, 1, {"a": 0})
    with pytest.raises(AnalysisException):
        versions.publish(spark, target, 1, {"a": 5})
    assert versions.current(spark, target).rows == {"a": 0}
    # A manifest that was begun and not finished names nothing.
    (tmp_path / "db" / versions.MANIFESTS / "version=2" / "_temporary").mkdir(parents=True)
    assert versions.current(spark, target).version == 1
    assert versions.clean(spark, target, ["a"]) == [f"{versions.MANIFESTS}/version=2"]


def test_tables_must_exist(spark, tmp_path, sources):
    target = str(tmp_path / "db")
    with pytest.raises(RuntimeError, match="missing tables"):
        ingest.load(spark, sources, target, must_exist=True)
    ingest.create_tables(spark, target)
    with pytest.raises(RuntimeError, match="already"):
        ingest.create_tables(spark, target)
    empty = versions.open_tables(spark, target)
    assert all(df.count() == 0 for df in empty.values()) and empty["orders"].columns[0] == "order_id"
    report = ingest.load(spark, sources, target, must_exist=True)
    assert report.stored["orders"] == 3 and versions.current(spark, target).version == 2
    loaded = versions.open_tables(spark, target)
    assert {n: df.dtypes for n, df in loaded.items()} == {n: df.dtypes for n, df in empty.items()}


def test_tables_from_before_versions_are_guarded_and_replaced(spark, tmp_path, sources):
    target = str(tmp_path / "db")
    spark.range(3).write.parquet(f"{target}/food")
    with pytest.raises(RuntimeError, match="not empty.*food.*3"):
        ingest.load(spark, sources, target)
    ingest.load(spark, sources, target, reset=True)
    assert [p.name for p in (tmp_path / "db" / "food").iterdir()] == ["version=1"]


def test_a_load_parses_a_file_once_for_both_readings_of_its_dates(spark, tmp_path, sources, monkeypatch):
    def parsed_again(df, columns):
        assert not columns, "the files are parsed once more for their dates"
        return {}

    monkeypatch.setattr(cleaning, "prefers_day_first", parsed_again)
    ingest.load(spark, sources, str(tmp_path / "db"))
    stored = spark.read.parquet(str(tmp_path / "db" / "orders")).orderBy("order_id")
    assert [str(r["order_datetime"]) for r in stored.collect()] == ["2019-12-25 00:00:00", "2019-05-04 00:00:00", "None"]


DATES = {
    "month first": ["12/25/2019", "11/26/2019 10:00", "03/04/2019", "25/12/2019", "13/13/2019", "2019-05-06", "soon", None],
    "day first": ["25/12/2019", "26/11/2019 10:00", "03/04/2019", "12/25/2019", "13/13/2019", "May 6, 2019", "soon", None],
    "a tie": ["25/12/2019", "12/25/2019", "03/04/2019 1:00 PM", "", "31/04/2019"],
}


@pytest.mark.parametrize("cells", DATES.values(), ids=DATES)
def test_a_load_chooses_readings_as_cleaning_does(spark, cells):
    contract = TableContract({"at": ("at",), "i": ("i",)}, {"at": "timestamp_ntz", "i": "int"}, integers=("i",), timestamps=("at",))
    df = spark.createDataFrame([(c, str(i)) for i, c in enumerate(cells)], "at string, i string")
    both = cleaning.type_columns(df, contract, both_readings=True)
    measures = cleaning.quality_measures(both, contract) | cleaning.reading_measures(contract)
    counts = both.agg(*[c.alias(n) for n, c in measures.items()]).first().asDict()
    kept = both.select("at", "i", *cleaning.reading_columns(contract))
    rows, quality = cleaning.clean_types(df, contract)
    assert sorted(map(repr, cleaning.chosen_readings(kept, contract, counts).collect())) == sorted(map(repr, rows.collect()))
    assert {f"lost_{r['column']}": r["coerced"] for r in quality.collect()} == {n: counts[n] for n in ("lost_at", "lost_i")}


def test_rows_numbered_by_split_stay_in_order(spark, tmp_path):
    folder = tmp_path / "split"
    folder.mkdir()
    for i in range(3):
        (folder / f"part-{i}.csv").write_text("v\n" + "".join(f"{i * 20_000 + j}\n" for j in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        numbered = ingest.number_splits(files.read_csv_robust(spark, str(folder), row_order=True))
        assert dict(numbered.dtypes)[files.ROW_ORDER] == "bigint"
        assert [int(r["v"]) for r in numbered.orderBy(files.ROW_ORDER).collect()] == list(range(60_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_without_orphans_are_not_joined(spark):
    parents = {"sellers": spark.createDataFrame([(1,), (2,)], "seller int")}
    rows = spark.createDataFrame([(1, 1), (2, None), (3, 2)], "id int, seller int")
    for orphans, joins in ((rows, False), (rows.union(spark.createDataFrame([(4, 9)], rows.schema)), True)):
        marked = integrity.mark_orphans(orphans, [ForeignKey("seller", "sellers", "seller")], parents)
        text = marked._jdf.queryExecution().executedPlan().toString()
        assert ("Join" in text) == joins and "SortMergeJoin" not in text
        assert marked.where("reject_reason = 'seller'").count() == int(joins)


def test_the_code_of_a_load_is_cut_twice(spark):
    """Before the closer look at integers and before dates."""
    contract = ingest.CONTRACTS["orders"]
    raw = spark.createDataFrame([tuple("1" for _ in contract.headers)], ", ".join(f"{c} string" for c in contract.headers))
    typed = cleaning.type_columns(raw, contract, both_readings=True)
    assert typed._jdf.queryExecution().executedPlan().toString().count("CollectMetrics") == 2
