"""Readers, writers, saved models and the catalog."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loamwork.learning import estimators
from loamwork.sources import catalog, models, readers, schemas, writers
from loamwork.workspace import cut_lineage, fresh_path, held, spread


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_users_file(spark, tmp_path):
    path = put(tmp_path / "users", "1|27|M|baker|20001\n2|61|F|glazier|T9Z9Z\n")
    users = readers.read_delimited(spark, path, schemas.USERS, sep="|")
    assert [tuple(r) for r in users.orderBy("userid").collect()] == [
        (1, 27, "M", "baker", "20001"), (2, 61, "F", "glazier", "T9Z9Z"),
    ]


def test_ratings_file_keeps_three_fields(spark, tmp_path):
    path = put(tmp_path / "ratings", "501\t77\t4\t900000001\n502\t78\t2\t900000002\n")
    ratings = readers.read_delimited(spark, path, schemas.RATINGS, sep="\t").drop("rated_at")
    assert sorted(tuple(r) for r in ratings.collect()) == [(501, 77, 4), (502, 78, 2)]


def test_item_schema_has_24_fields(spark, tmp_path):
    line = "1|A Made-Up Film (2001)|02-Feb-2001||http://x/" + "|0" * 18 + "|1"
    item = readers.read_delimited(spark, put(tmp_path / "items", line + "\n"), schemas.items(), sep="|").first()
    assert len(item) == 24
    assert (item.item_id, item.title, item.video_date, item.genre_0, item.genre_18) == (1, "A Made-Up Film (2001)", None, 0, 1)


def test_quotes_honoured_or_stripped(spark, tmp_path):
    path = put(tmp_path / "zips", '"zip","city"\n"00501","Holtsville, NY"\n"00544","Hicksville"\n')
    honoured = readers.read_delimited(spark, path, "zip string, city string", header=True)
    assert sorted(r.city for r in honoured.collect()) == ["Hicksville", "Holtsville, NY"]
    stripped = readers.read_quote_stripped(spark, path, ["zip", "city", "rest"], ",")
    assert sorted(((r.zip, r.city, r.rest) for r in stripped.collect())) == [
        ("00501", "Holtsville", " NY"), ("00544", "Hicksville", None),
    ]


def test_short_rows_give_nulls_where_permitted(spark, tmp_path):
    path = put(tmp_path / "cover", "f0,f1,f2,f3,f4,f5\n1,2,3,4,5\n")
    row = readers.read_delimited(spark, path, schemas.numbered(6), header=True, mode="PERMISSIVE").first()
    assert tuple(row) == ("1", "2", "3", "4", "5", None)


def test_header_line_is_dropped_wherever_it_occurs(spark, tmp_path):
    path = put(tmp_path / "lines", "h\na\nh\nb\n")
    lines = readers.read_lines(spark, path)
    assert sorted(r.value for r in readers.drop_header_lines(lines, "h").collect()) == ["a", "b"]


def test_only_newlines_end_a_line(spark):
    path = fresh_path(spark, "test")
    writers.write_lines(spark.createDataFrame([("a\rb",), ("",), ("c d",)], "v string"), path)
    assert sorted(r.value for r in readers.read_lines(spark, path).collect()) == ["", "a\rb", "c d"]


def test_delimited_round_trip_of_awkward_text(spark):
    rows = [('say "hi"', "a\tb", 1.5), ("back\\slash", ",|", -0.25), ("'", "x", 1e300)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    for sep in (",", "\t", "|"):
        path = fresh_path(spark, "test")
        writers.write_delimited(df, path, sep=sep, header=True, quote_all=True)
        again = readers.read_delimited(spark, path, df.schema, sep=sep, header=True)
        assert sorted(map(tuple, again.collect())) == sorted(rows)


def test_empty_fields_read_as_null(spark):
    df = spark.createDataFrame([("", None, "x")], "a string, b double, c string")
    path = fresh_path(spark, "test")
    writers.write_delimited(df, path)
    assert tuple(readers.read_delimited(spark, path, df.schema).first()) == (None, None, "x")


def test_text_sink_refuses_an_existing_path(spark):
    path, lines = fresh_path(spark, "test"), spark.createDataFrame([("x",)], "v string")
    assert writers.write_lines_once(lines, path)
    assert not writers.write_lines_once(lines, path)
    with pytest.raises(AnalysisException):
        writers.write_lines(lines, path)


def test_model_sink_and_source(spark):
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 0.0, 0.0), (0.0, 3.0, 1.0), (2.0, 1.0, 0.0)], "a double, b double, label double")
    )
    model, path = estimators.naive_bayes(1.0).fit(data), fresh_path(spark, "test")
    assert models.save_model(model, path)
    assert not models.save_model(model, path)
    assert models.save_model(model, path, overwrite=True)
    again = models.load_model(NaiveBayesModel, path)
    assert again.theta == model.theta and again.pi == model.pi
    assert models.model_metadata(spark, path).first()["class"].endswith("NaiveBayesModel")


def test_catalog(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    assert catalog.register_view(df, "catalog_test").count() == 2
    assert [tuple(r) for r in catalog.schema_table(df).collect()] == [
        (0, "k", "int", True, 2), (1, "s", "string", True, 1),
    ]
    assert [tuple(r) for r in catalog.row_counts({"df": df}).collect()] == [("df", 2)]
    assert tuple(catalog.cache_report(df).first()) == (False, True, False, 2)


def test_held_frames_are_released_after_a_failure(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError), held(df):
        assert df.is_cached
        raise RuntimeError
    assert not df.is_cached


def test_lineage_cut_keeps_rows(spark):
    df = spark.range(100).filter(F.col("id") % 3 == 0)
    assert sorted(r.id for r in cut_lineage(df).collect()) == list(range(0, 100, 3))


def test_spread_deals_rows_alike_from_any_partitions(spark):
    def dealt_rows(frame):
        with spread(frame, 7) as rows:
            assert rows.rdd.getNumPartitions() == 7
            return rows.withColumn("p", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()

    narrow, wide = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 32)
    first = dealt_rows(narrow)
    assert first == dealt_rows(wide) and sorted(r.id for r in first) == list(range(100))
    assert not narrow.is_cached and not wide.is_cached


def test_delimited_text_keeps_blanks_and_line_ends(spark, tmp_path):
    rows = [(1, "  a "), (2, "x\ny\r\\n\\"), (3, 'q"z'), (4, None), (5, ""), (6, "\\")]
    empty_as_null = [(k, v or None) for k, v in rows]
    df = spark.createDataFrame(rows, "k int, v string")
    writers.write_delimited(df, f"{tmp_path}/a", escaped=True)
    assert sorted(map(tuple, readers.read_delimited(spark, f"{tmp_path}/a", df.schema, escaped=True).collect())) == empty_as_null
    plain = df.where("k <> 2")
    writers.write_delimited(plain, f"{tmp_path}/b", header=True)
    assert sorted(map(tuple, readers.read_delimited(spark, f"{tmp_path}/b", df.schema, header=True).collect())) == [r for r in empty_as_null if r[0] != 2]
    with pytest.raises(Exception, match="line end"):
        writers.write_delimited(df, f"{tmp_path}/c")


def test_bad_numbers_fail_unless_permitted(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("1,2\nx,3\n4\n")
    with pytest.raises(Exception):
        readers.read_delimited(spark, f"{tmp_path}/bad.csv", "a int, b int").collect()
    kept = readers.read_delimited(spark, f"{tmp_path}/bad.csv", "a int, b int", mode="PERMISSIVE").collect()
    assert sorted(map(str, map(tuple, kept))) == ["(1, 2)", "(4, None)", "(None, 3)"]
