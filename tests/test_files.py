import pytest
from pyspark.sql import types as T

from flowguard.operators.clean import add_day_column
from flowguard.sources import files


def put(spark, path, name, text):
    """One file with a given name, through Spark's own file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    out = at.getFileSystem(conf).create(at)
    out.write(bytearray(text.encode()))
    out.close()


@pytest.fixture
def folder(spark):
    path = files.scratch_path(spark, "t-csv")
    put(spark, path, "Monday-x.csv", "a,b,name\n1,10,x\nNA,20,null\n")
    put(spark, path, "Tuesday-x.csv", "b,a\n200,2\n300,3.5\n")
    put(spark, path, "notes.txt", "z\n9\n")
    return path


def test_schema_is_applied_by_name(spark, folder):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.IntegerType()),
                           T.StructField("missing", T.StringType())])
    got = files.load_csv_files(spark, folder, schema=schema, keep_source=False)
    assert got.schema == schema
    assert sorted(got.collect(), key=str) == sorted(
        [(1.0, 10, None), (None, 20, None), (2.0, 200, None), (3.5, 300, None)], key=str)


def test_types_are_found_beside_missing_tokens(spark, folder):
    got = files.load_csv_files(spark, folder, keep_source=False)
    assert dict(got.dtypes)["a"] == "double" and dict(got.dtypes)["b"] in ("int", "bigint")
    assert sorted([(r["a"], r["b"], r["name"]) for r in got.collect()], key=str) == sorted(
        [(1.0, 10, "x"), (None, 20, None), (2.0, 200, None), (3.5, 300, None)], key=str)


def test_day_from_file_name(spark, folder):
    got = add_day_column(files.load_csv_files(spark, folder, day_from_name="DayName"), "DayName")
    assert {(r["DayName"], r["Day"], r[files.SOURCE_FILE]) for r in got.collect()} == {
        ("Monday", 0, "Monday-x.csv"), ("Tuesday", 1, "Tuesday-x.csv")}


def test_missing_and_empty_folders(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.load_csv_files(spark, folder + "-no-such")
    with pytest.raises(ValueError):
        files.load_csv_files(spark, _empty(spark))


def _empty(spark):
    path = files.scratch_path(spark, "t-empty")
    put(spark, path, "readme.txt", "x")
    return path


def test_writers_read_back(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, s string")
    p = files.write_parquet(df, files.scratch_path(spark, "t-pq"))
    assert sorted(files.read_parquet(spark, p).collect()) == sorted(df.collect())
    c = files.write_csv(df, files.scratch_path(spark, "t-csvw"))
    assert sorted(files.load_csv_files(spark, c, schema=df.schema, keep_source=False).collect()) == sorted(df.collect())


def test_unknown_days_are_all_listed(spark):
    df = spark.createDataFrame([(f"day{i:02d}",) for i in range(30)], "d string")
    with pytest.raises(ValueError) as e:
        add_day_column(df, "d")
    assert all(f"day{i:02d}" in str(e.value) for i in range(30))


def test_header_with_repeated_names(spark):
    path = files.scratch_path(spark, "t-rep")
    put(spark, path, "a.csv", "Len,x,Len,Len,Len.1\n1,a,2,3,4\n5,b,NA,7,8\n")
    put(spark, path, "b.csv", "x,Len\nc,9\n")
    got = files.load_csv_files(spark, path, keep_source=False)
    assert got.columns == ["Len", "x", "Len.2", "Len.3", "Len.1"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", 2, 3, 4), (5, "b", None, 7, 8), (9, "c", None, None, None)], key=str)
    schema = T.StructType([T.StructField("Len.2", T.LongType()), T.StructField("x", T.StringType())])
    assert {tuple(r) for r in files.load_csv_files(spark, path, schema=schema, keep_source=False).collect()} == {
        (2, "a"), (None, "b"), (None, "c")}
    assert files.distinct_names(["a", "a", "b", "a"]) == ["a", "a.1", "b", "a.2"]


def test_header_over_two_lines_is_an_error(spark):
    path = files.scratch_path(spark, "t-lines")
    put(spark, path, "a.csv", 'a,"b\nc"\n1,2\n')
    with pytest.raises(ValueError, match="next line"):
        files.load_csv_files(spark, path)
