import json
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from ratecraft.errors import AssetLoadError, CheckpointFolderError, EmptyFrameError, MissingColumnsError, ValidationError
from ratecraft.operators.checks import require_columns, require_rows, validate_frame
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.models import fit_multi_target, read_run_metadata, write_run_metadata
from ratecraft.plans.score_job import score, score_job
from ratecraft.session import ensure_checkpoint_dir
from ratecraft.sources.files import scan_json_records, scan_sectioned_tsv
from ratecraft.sources.sinks import sink_csv, sink_parquet
from ratecraft.sources.sqlite import scan_sqlite_table

COUNTS_SCHEMA = ("Notes string, Area string, `Area Code` string, Year bigint, "
                 "`Year Code` string, Site string, Sex string, `Sex Code` string, Count string")


def _write_sectioned(path, rows):
    head = "\t".join(['"Notes"', '"Area"', '"Area Code"', '"Year"', '"Year Code"',
                      '"Site"', '"Sex"', '"Sex Code"', '"Count"'])
    body = "\n".join("\t".join(r) for r in rows)
    notes = '"---"\n"Dataset: counts"\n"Query Date: x"\n"---"\n'
    with open(path, "w") as f:
        f.write(head + "\n" + body + "\n" + notes)


@pytest.mark.parametrize("whole_file", [False, True])
def test_sectioned_tsv_and_filename(spark, tmpdir_path, whole_file):
    p1 = os.path.join(tmpdir_path, "counts_agegte25lt45.txt")
    p2 = os.path.join(tmpdir_path, "counts_agegte65.txt")
    _write_sectioned(p1, [["", "North", "01", "2001", "2001", "Alpha", "Female", "F", "120"],
                          ["", "North", "01", "2001", "2001", "Beta", "Male", "M", "Suppressed"]])
    _write_sectioned(p2, [["", "South", "02", "2002", "2002", "Alpha", "Female", "F", "7"]])
    df = scan_sectioned_tsv(spark, [p1, p2], COUNTS_SCHEMA, file_column="age_group",
                            whole_file=whole_file)
    rows = sorted(df.collect(), key=lambda r: (r["Area"], r["Site"]))
    assert "Notes" not in df.columns and len(rows) == 3
    assert rows[0]["Area Code"] == "01" and rows[0]["age_group"] == "agegte25lt45"
    assert rows[1]["Count"] == "Suppressed" and rows[2]["age_group"] == "agegte65"


def test_sqlite_dates_and_flags(spark, tmpdir_path):
    db = os.path.join(tmpdir_path, "typed.db")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE t (d DATE, ts TIMESTAMP, ok BOOLEAN, x NUMERIC)")
    con.execute("INSERT INTO t VALUES ('2001-02-03', '2001-02-03 04:05:06', 1, 2.5), (NULL, NULL, NULL, NULL)")
    con.commit()
    con.close()
    rows = scan_sqlite_table(spark, db, "t").orderBy(F.col("ok").asc_nulls_last()).collect()
    assert tuple(rows[0]) == ("2001-02-03", "2001-02-03 04:05:06", 1, 2.5)
    assert tuple(rows[1]) == (None, None, None, None)


def test_local_checkpoint_folder_is_refused_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(CheckpointFolderError):
        ensure_checkpoint_dir(Session())


def test_json_records(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "survey.json")
    with open(p, "w") as f:
        json.dump([{"year": 2001, "area": "N", "data_value": 55.5},
                   {"year": 2002, "area": "S", "data_value": None}], f)
    df = scan_json_records(spark, p, "year bigint, area string, data_value double")
    assert df.count() == 2 and df.where(F.col("data_value").isNull()).count() == 1


def test_sqlite_table(spark, tmpdir_path):
    db = os.path.join(tmpdir_path, "pop.sqlite")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE population (fips TEXT, year INTEGER, sex TEXT, population INTEGER, r REAL)")
    con.executemany("INSERT INTO population VALUES (?, ?, ?, ?, ?)",
                    [(f"{i:02d}", 2000 + i % 3, "F", 1000 + i, i / 2) for i in range(25)])
    con.commit()
    con.close()
    df = scan_sqlite_table(spark, db, "population", num_partitions=3)
    assert df.schema.simpleString() == "struct<fips:string,year:bigint,sex:string,population:bigint,r:double>"
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3
    assert df.where("fips = '01'").first()["population"] == 1001
    picked = df.where((F.col("year") >= 2001) & F.col("fips").isin("03", "04", "05") & (F.col("r") < 2.1))
    assert sorted(r["fips"] for r in picked.collect()) == ["04"]
    plan = spark._jvm.PythonSQLUtils.explainString(picked._jdf.queryExecution(), "formatted")
    assert "In(fips" in plan and "GreaterThanOrEqual(year" in plan


SQLITE_SHAPES = {
    "gaps": "CREATE TABLE t (k INTEGER PRIMARY KEY, v TEXT); INSERT INTO t SELECT value * value * value * 1000003, 'v' || value FROM n; "
            "INSERT INTO t VALUES (-9223372036854775808, 'least'), (9223372036854775807, 'greatest')",
    "own_rowid": "CREATE TABLE t (rowid TEXT, v REAL); INSERT INTO t SELECT CASE WHEN value % 3 THEN 'r' || value END, value / 2.0 FROM n",
    "all_names": "CREATE TABLE t (rowid INTEGER, oid INTEGER, _rowid_ TEXT); INSERT INTO t SELECT NULL, value, value FROM n",
    "without_rowid": "CREATE TABLE t (a TEXT, b INTEGER, v REAL, PRIMARY KEY (b, a)) WITHOUT ROWID; "
                     "INSERT INTO t SELECT 'a' || (value % 7), value / 7, value FROM n",
    "view": "CREATE TABLE base (x INTEGER, y TEXT); INSERT INTO base SELECT value, 'y' FROM n; CREATE VIEW t AS SELECT x + 1 AS x1, y FROM base WHERE x % 2",
    "empty": "CREATE TABLE t (a INTEGER, b TEXT)",
    "empty_without_rowid": "CREATE TABLE t (a INTEGER PRIMARY KEY, b TEXT) WITHOUT ROWID",
    "odd_values": "CREATE TABLE t (\"a b\"\"c\" INTEGER, d TEXT, e REAL); INSERT INTO t SELECT value * 1.0, value, value FROM n",
}


@pytest.mark.parametrize("shape", sorted(SQLITE_SHAPES))
@pytest.mark.parametrize("parts", [1, 5])
def test_sqlite_shapes_equal_select_star(spark, tmpdir_path, shape, parts):
    db = os.path.join(tmpdir_path, "shape.db")
    con = sqlite3.connect(db)
    con.executescript("CREATE TABLE n (value INTEGER); "
                      "INSERT INTO n WITH RECURSIVE c(i) AS (SELECT 1 UNION ALL SELECT i + 1 FROM c WHERE i < 60) SELECT i FROM c; " + SQLITE_SHAPES[shape])
    want = [tuple(r) for r in con.execute("SELECT * FROM t").fetchall()]
    con.commit()
    con.close()
    df = scan_sqlite_table(spark, db, "t", num_partitions=parts)
    got = [tuple(r) for r in df.collect()]
    if shape == "odd_values":
        want = [(a, str(b), float(c)) for a, b, c in want]
    if shape == "view":  # a column of an expression has no declared type: text
        want = [(str(a), b) for a, b in want]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert df.count() == len(want)
    keyed = shape in ("gaps", "own_rowid", "without_rowid", "odd_values")
    assert df.rdd.getNumPartitions() == (parts if keyed else 1)
    if keyed and parts > 1:
        sizes = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
        assert all(sizes)  # gaps are not read as work
    column = df.columns[0]
    assert df.where(F.col(f"`{column}`").isNotNull()).count() == sum(r[0] is not None for r in want)


def test_sqlite_reader_needs_no_package_on_executors():
    """The classes travel whole, not as names to import."""
    from pyspark import cloudpickle
    from ratecraft.sources.sqlite import SQLiteDataSource
    assert b"_make_skeleton_class" in cloudpickle.dumps(SQLiteDataSource)


def test_sinks_and_metadata(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sink_parquet(df, os.path.join(tmpdir_path, "p"), partition_by=["v"])
    assert spark.read.parquet(os.path.join(tmpdir_path, "p")).count() == 2
    sink_csv(df, os.path.join(tmpdir_path, "c"), key_columns=["v"])
    back = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "c"))
    assert back.columns == ["v", "k"]
    write_run_metadata(spark, os.path.join(tmpdir_path, "m"), {"targets": ["a"], "best": {"x": 1}})
    assert read_run_metadata(spark, os.path.join(tmpdir_path, "m"))["best"] == {"x": 1}


def test_checks(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    with pytest.raises(EmptyFrameError):
        require_rows(df.limit(0))
    with pytest.raises(MissingColumnsError):
        require_columns(df, FeatureSpec(num=["x", "z"], cat=["c"]))
    with pytest.raises(ValidationError):
        validate_frame(df, ["y", "y"])
    with pytest.raises(MissingColumnsError):
        validate_frame(df, ["q"])
    with pytest.raises(ValidationError):
        validate_frame(df.select("y"), ["y"])
    validate_frame(df, ["y"])


def test_score_job_end_to_end(spark, tmpdir_path):
    rows = [(i, float(i % 7), "a" if i % 2 else "b", 2.0 * (i % 7) + (i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string, y double")
    inp = os.path.join(tmpdir_path, "in.parquet")
    df.write.parquet(inp)
    spec = FeatureSpec(num=["x"], cat=["c"], target=["y"])
    model = fit_multi_target(df, spec, ["y"], {"n_estimators": 4})
    mdir = os.path.join(tmpdir_path, "model")
    model.save(mdir)
    out = os.path.join(tmpdir_path, "out")
    score_job(spark, inp, out, mdir)
    res = spark.read.option("header", True).csv(out)
    assert res.count() == 200 and res.columns == ["id", "x", "c", "y", "y_pred"]
    with pytest.raises(AssetLoadError):
        score(spark, inp, mdir, iterations=10)  # no ensemble saved


def test_score_stream(spark, tmpdir_path):
    from ratecraft.streaming import score_stream
    rows = [(i, float(i % 5), 3.0 * (i % 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double")
    model = fit_multi_target(df, FeatureSpec(num=["x"], target=["y"]), ["y"], {"n_estimators": 3})
    mdir = os.path.join(tmpdir_path, "m")
    model.save(mdir)
    src = os.path.join(tmpdir_path, "incoming")
    df.select("id", "x").write.parquet(src)
    q = score_stream(spark, src, "id bigint, x double", mdir, os.path.join(tmpdir_path, "scored"),
                     os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(tmpdir_path, "scored")).count() == 100


def test_sectioned_large_file_line_mode(spark, tmpdir_path):
    """A file bigger than one split: body lines kept in order, notes dropped."""
    p = os.path.join(tmpdir_path, "big_agegte65.txt")
    body = [["", f"A{i}", f"{i % 100:02d}", "2001", "2001", "S", "F", "F", str(i)] for i in range(60000)]
    _write_sectioned(p, body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = scan_sectioned_tsv(spark, p, COUNTS_SCHEMA, file_column="age_group")
        assert df.rdd.getNumPartitions() >= 1
        rows = df.select("Count", "age_group").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 60000 and {r["age_group"] for r in rows} == {"agegte65"}
    assert sorted(int(r["Count"]) for r in rows) == list(range(60000))


def test_score_stream_resumes_from_checkpoint(spark, tmpdir_path):
    """A restarted stream scores only files that arrived after the last run."""
    from ratecraft.streaming import score_stream
    df = spark.createDataFrame([(i, float(i % 5), 3.0 * (i % 5)) for i in range(60)],
                               "id bigint, x double, y double")
    model = fit_multi_target(df, FeatureSpec(num=["x"], target=["y"]), ["y"], {"n_estimators": 2})
    mdir, src = os.path.join(tmpdir_path, "m"), os.path.join(tmpdir_path, "in")
    out, ckpt = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    model.save(mdir)
    df.where("id < 30").select("id", "x").write.parquet(os.path.join(src, "a"))
    os.makedirs(src, exist_ok=True)
    q = score_stream(spark, os.path.join(src, "*"), "id bigint, x double", mdir, out, ckpt)
    q.awaitTermination(120)
    df.where("id >= 30").select("id", "x").write.parquet(os.path.join(src, "b"))
    q = score_stream(spark, os.path.join(src, "*"), "id bigint, x double", mdir, out, ckpt)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert res.count() == 60 and res.select("id").distinct().count() == 60
