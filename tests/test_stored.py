"""File order, models stored for lookups, mergeable score counts and dictionaries built on the cluster."""

import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import DataFrame, functions as F

from loamwork.learning import dictionary, evaluate, features, histograms, recommend, store
from loamwork.operators import file_order
from loamwork.sources import readers
from loamwork.workspace import fresh_path


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def numbered_files(spark, tmp_path_factory):
    """Files of very different sizes, the lines of which hold their number and no order."""
    folder, number = tmp_path_factory.mktemp("lines"), 0
    for k, size in enumerate((5, 3000, 1, 0, 700, 2, 900)):
        lines = []
        for _ in range(size):
            lines.append(f"{number}|{number * 7919 % 13}|{'x' * (number % 50)}")
            number += 1
        (folder / f"part-{k:03d}").write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(folder), number


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "128"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def read(spark, path):
    return readers.read_delimited(spark, path, "n bigint, k int, pad string", sep="|")


def test_lines_are_numbered_in_file_order(spark, numbered_files, small_splits):
    path, total = numbered_files
    lines = read(spark, path)
    assert lines.rdd.getNumPartitions() > 20
    numbered = file_order.in_file_order(lines)
    assert numbered.columns == ["n", "k", "pad", "line_number"]
    assert numbered.where("n <> line_number").count() == 0 and numbered.count() == total
    text = file_order.in_file_order(readers.read_lines(spark, path))
    assert text.where(F.split("value", "[|]")[0].cast("bigint") != F.col("line_number")).count() == 0


def test_very_many_splits_are_numbered_by_ranges(spark, numbered_files, small_splits, monkeypatch):
    monkeypatch.setattr(file_order, "_MANY_SPLITS", 3)
    by_ranges = file_order._by_ranges
    monkeypatch.setattr(file_order, "_by_ranges", lambda sizes: by_ranges(sizes, 4))
    path, total = numbered_files
    numbered = file_order.in_file_order(read(spark, path))
    assert numbered.where("n <> line_number").count() == 0 and numbered.count() == total


def test_folds_and_splits_in_file_order(spark, numbered_files, small_splits):
    path, total = numbered_files
    folds = file_order.file_folds(read(spark, path), 5)
    assert folds.where(F.expr(f"n * 5 div {total}") != F.col("fold")).count() == 0
    left = file_order.leave_range_out_of_file(read(spark, path), "k", 2, 4)
    nth, wanted = {}, set()
    for n in range(total):
        k = n * 7919 % 13
        nth[k] = nth.get(k, 0) + 1
        if 2 <= nth[k] <= 4:
            wanted.add(n)
    assert {r.n for r in left.where("split = 'test'").collect()} == wanted and left.count() == total
    rest = file_order.drop_first_lines(read(spark, path), 6)
    assert rest.agg(F.min("n"), F.count("n")).first() == (6, total - 6)


def test_numbering_does_not_shuffle_lines(spark, numbered_files):
    plan = plan_of(file_order.in_file_order(read(spark, numbered_files[0])))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    lines = read(spark, str(tmp_path / "empty"))
    assert file_order.in_file_order(lines).count() == 0 and file_order.file_folds(lines, 3).count() == 0


@pytest.fixture(scope="module")
def served(spark):
    rows = [(u, i, float(1 + (u * 3 + i * 5) % 5)) for u in range(90) for i in range(60) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    model, path = recommend.train(ratings, rank=3, iterations=3, blocks=2), fresh_path(spark, "served")
    store.FOLDER_ROWS, before = 10, store.FOLDER_ROWS
    store.save_factors(model, path, 8)
    store.FOLDER_ROWS = before
    return model, path


def test_a_lookup_opens_one_folder(spark, served):
    model, path = served
    found = store.lookup(spark, path, "user", 17)
    plan = plan_of(found)
    assert "EqualTo(id,17)" in plan and "PartitionFilters: [isnotnull(folder" in plan
    assert spark.read.parquet(f"{path}/user").select("folder").distinct().count() == 9
    assert found.select(F.input_file_name()).distinct().count() == 1
    assert found.first()["features"] == model.userFactors.where("id = 17").first()["features"]
    assert store.lookup(spark, path, "user", 12345).count() == 0


def test_lists_and_pairs_from_the_store(spark, served):
    model, path = served
    titles = spark.createDataFrame([(i, f"title {i}") for i in range(60)], "item_id int, title string")
    listed = store.serve_stored(spark, path, "U", 17, 4, titles).orderBy("place").collect()
    whole = model.recommendForUserSubset(spark.createDataFrame([(17,)], "user_id int"), 4).first()["recommendations"]
    assert [r.score for r in listed] == pytest.approx([r.rating for r in whole], abs=1e-5) and all(r.title == f"title {r.item_id}" for r in listed)
    assert [r.place for r in store.serve_stored(spark, path, "M", 3, 6, titles).orderBy("place").collect()] == [1, 2, 3, 4, 5, 6]
    pair = recommend.predict_pairs(model, spark.createDataFrame([(17, 5)], "user_id int, item_id int")).first()
    assert store.predict_pair(spark, path, 17, 5) == pytest.approx(pair.prediction, abs=1e-5)
    assert store.predict_pair(spark, path, 17, 999) is None
    assert store.serve_stored(spark, path, "U", 999, 4, titles).count() == 0
    with pytest.raises(ValueError):
        store.serve_stored(spark, path, "X", 1, 4, titles)


def test_areas_of_merged_counts(spark):
    rng = np.random.default_rng(3)
    rows = [(int(d), float(np.round(rng.normal(y, 1.5), 1)) + 0.0, float(y)) for d, y in zip(rng.integers(0, 6, 4000), rng.integers(0, 2, 4000))]
    rows += [(0, None, 1.0), (1, 0.5, None), (2, 0.0, 1.0), (2, 0.0, 0.0), (9, 1.0, 1.0)]
    scored = spark.createDataFrame(rows, "day int, score double, label double")
    clean = scored.dropna()
    daily = histograms.score_counts(scored, ["day"]).cache()
    whole = histograms.area(histograms.merged(daily)).first()
    assert whole.auc == pytest.approx(evaluate.score_auc(clean, score="score"), abs=1e-12)
    assert whole.positives + whole.negatives == clean.count()
    # Any selection of days, merged from their counts, is what a scan of their rows gives.
    some = histograms.merged(daily.where("day < 2"), daily.where("day = 4"))
    assert histograms.area(some).first().auc == pytest.approx(evaluate.score_auc(clean.where("day < 2 OR day = 4"), score="score"), abs=1e-12)
    for r in histograms.area(daily, ["day"]).collect():
        own = clean.where(F.col("day") == r.day)
        assert r.auc == (0.5 if r.day == 9 else pytest.approx(evaluate.score_auc(own, score="score"), abs=1e-12))
    for width in (0.25, 1.0, 100.0):
        binned = histograms.area(histograms.score_counts(scored, width=width)).first()
        assert abs(binned.auc - whole.auc) <= binned.error + 1e-12
    assert histograms.area(histograms.score_counts(scored.limit(0))).where("positives > 0").count() == 0


def test_dictionary_equals_the_indexer(spark):
    rows = [(i, v) for i, v in enumerate(["b"] * 5 + ["a"] * 3 + ["c"] * 3 + ["d"] + [None])]
    frame = spark.createDataFrame(rows, "id int, kind string")
    values = dictionary.ranked_values(frame, "kind").cache()
    known = frame.where("kind <> 'd'")
    model = features.indexer(["kind"]).fit(frame)
    ours = {r.id: r.kind_index for r in dictionary.indexed(frame, "kind", values).collect()}
    assert ours == {r.id: r.kind_index for r in model.transform(frame).collect()}
    few = dictionary.ranked_values(known, "kind")
    assert dictionary.indexed(frame, "kind", few, "skip").count() == 11
    assert {r.id for r in dictionary.indexed(frame, "kind", few).where("kind_index = 3").collect()} == {11, 12}
    vectors = dictionary.slots(dictionary.indexed(frame, "kind", few), "kind_index", 3, "slots").collect()
    assert all(r.slots.size == 4 and r.slots[int(r.kind_index)] == 1.0 for r in vectors)


def test_a_dictionary_never_reaches_the_driver(spark, monkeypatch):
    """More values than may be collected; only counts and sizes of ranges come back."""
    frame = spark.range(60_000).select((F.col("id") * 7 % 50_021).cast("string").alias("kind"))
    collect = DataFrame.collect

    def bounded(self):
        rows = collect(self)
        assert len(rows) < 1000
        return rows

    monkeypatch.setattr(DataFrame, "collect", bounded)
    values = dictionary.ranked_values(frame, "kind")
    ready = dictionary.indexed(frame, "kind", values, name="at").where("at < 50021")
    assert ready.count() == 60_000 and ready.select("at").distinct().count() == values.count() == 50_021
