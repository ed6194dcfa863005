"""Hand-derived results on tiny inputs."""

import pytest
from pyspark.sql import functions as F

from loamwork.functions import lookup, numeric, text
from loamwork.operators import aggregates, joins, positions, projection, reports, sets, sorting, splits


@pytest.fixture(scope="module")
def ints(spark):
    return spark.createDataFrame([(3,), (1,), (2,), (5,), (5,)], "x int")


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(3, 4, 0), (3, 6, 1), (5, 6, 2), (1, 2, 3)]
    return spark.createDataFrame(rows, "k int, v int, seq int")


@pytest.fixture(scope="module")
def other(spark):
    return spark.createDataFrame([(3, 8)], "k int, w int")


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def flat(df):
    return [r[0] for r in df.collect()]


def test_map_and_filters(ints):
    x = F.col("x")
    assert sorted(flat(ints.select(x + 1))) == [2, 3, 4, 6, 6]
    assert sorted(flat(ints.filter((x > 1) & (x < 5)))) == [2, 3]
    assert sorted(flat(ints.filter((x >= 5) | (x < 3)))) == [1, 2, 5, 5]


def test_set_operations(spark, ints):
    five_six = spark.createDataFrame([(5,), (6,)], "x int")
    two_seven = spark.createDataFrame([(2,), (7,)], "x int")
    assert sorted(flat(sets.union_all(ints, five_six, two_seven))) == [1, 2, 2, 3, 5, 5, 5, 6, 7]
    assert flat(sets.intersection(ints, five_six)) == [5]
    assert sorted(flat(sets.subtract_values(ints, five_six))) == [1, 2, 3]
    assert sorted(flat(ints.distinct())) == [1, 2, 3, 5]
    assert joins.all_pairs(ints, five_six.withColumnRenamed("x", "y")).count() == 10


def test_subtract_keeps_left_duplicates_and_matches_nulls(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    right = spark.createDataFrame([(2,), (None,)], "x int")
    assert flat(sets.subtract_values(left, right)) == [1, 1]


def test_top_k(ints):
    assert flat(sorting.first_rows(ints, 3, "x")) == [1, 2, 3]
    assert flat(sorting.first_rows(ints, 3, F.desc("x"))) == [5, 5, 3]


def test_summary(ints):
    row = aggregates.summary(ints, "x").first()
    assert (row.n, row.total, row.smallest, row.largest) == (5, 16, 1, 5)
    assert row["mean"] == pytest.approx(3.2)
    assert row.stdev == pytest.approx(1.6)


def test_groups_by_parity(ints):
    parity = F.when(F.col("x") % 2 == 0, "even").otherwise("odd")
    lists = aggregates.group_member_lists(ints, parity, "x")
    assert {r.grp: r.members for r in lists.collect()} == {"even": [2], "odd": [1, 3, 5, 5]}


def test_large_groups_are_spread_but_whole(spark):
    rows = [(1, 7)] * 950 + [(1, i) for i in range(300)] + [(2, 1), (None, 4), (None, 4)]
    df = spark.createDataFrame(rows, "k int, x int")
    lists = aggregates.group_member_lists(df, F.col("k"), "x", list_size=100).collect()
    assert max(len(r.members) for r in lists) < 300
    assert len([r for r in lists if r.grp == 1]) > 4
    rebuilt = sorted(((r.grp, m) for r in lists for m in r.members), key=str)
    assert rebuilt == sorted(rows, key=str)


def test_pairs(pairs):
    assert values(projection.map_values(pairs, "v", F.col("v") * F.col("v")), "k", "v") == [(1, 4), (3, 16), (3, 36), (5, 36)]
    assert [r.k for r in sorting.ordered(pairs, "k", "v").collect()] == [1, 3, 3, 5]
    assert [r.k for r in sorting.ordered(pairs, F.desc("k"), "v").collect()] == [5, 3, 3, 1]
    assert values(aggregates.sum_by(pairs, ["k"], "v"), "k", "total") == [(1, 2), (3, 10), (5, 6)]
    assert values(aggregates.count_by(pairs, "k"), "k", "n") == [(1, 1), (3, 2), (5, 1)]
    assert values(aggregates.last_value_by(pairs, "k", "v", "seq"), "k", "v") == [(1, 2), (3, 6), (5, 6)]
    assert sorted(flat(pairs.filter("k = 3").select("v"))) == [4, 6]


def test_joins(pairs, other):
    kv = pairs.select("k", "v")
    matched = [(3, 4, 8), (3, 6, 8)]
    assert values(joins.matched(kv, other, ["k"]), "k", "v", "w") == matched
    assert values(joins.left_outer(kv, other, ["k"]), "k", "v", "w") == [(1, 2, None), *matched, (5, 6, None)]
    assert values(joins.right_outer(kv, other, ["k"]), "k", "v", "w") == matched
    assert values(joins.anti(kv, other, ["k"]), "k", "v") == [(1, 2), (5, 6)]


def test_outer_joins_match_plain_outer_joins_with_duplicates_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, r string")
    for how, ours in (("left", joins.left_outer), ("right", joins.right_outer)):
        assert values(ours(left, right, ["k"]), "k", "l", "r") == values(left.join(right, "k", how), "k", "l", "r")


def test_lookup_join_switches_strategy_by_measured_size(spark):
    ids = spark.createDataFrame([(2,), (4,), (1,), (3,)], "id int")
    names = spark.createDataFrame([(1, "apple"), (2, "orange"), (3, "banana"), (4, "grape")], "id int, name string")
    small = joins.lookup_join(ids, names, ["id"])
    large = joins.lookup_join(ids, names, ["id"], limit=1)
    assert values(small, "id", "name") == values(large, "id", "name") == [(1, "apple"), (2, "orange"), (3, "banana"), (4, "grape")]


def test_text_key_join(spark):
    users = spark.createDataFrame([("85711",), ("T8H1N",), ("02154",)], "zipcode string")
    zips = spark.createDataFrame([(85711, "WI"), (2154, "MA")], "zip bigint, state string")
    joined = joins.text_key_join(users, "zipcode", zips, "zip")
    assert {r.zipcode: r.state for r in joined.collect()} == {"85711": "WI", "T8H1N": None, "02154": "MA"}


def test_counts_by_attribute_with_repeated_dimension_key_and_no_match(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    names = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "d int, name string")
    plain = facts.join(names, F.col("k") == F.col("d"), "left").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    ours = joins.counts_by_attribute(facts, "k", names, "d", "name")
    assert values(ours, "name", "n") == values(plain, "name", "n")


def test_word_count(spark):
    lines = spark.createDataFrame([("Apple Apple Orange",), ("Banana Grape Grape",)], "value string")
    assert values(aggregates.word_count(lines, "value"), "word", "n") == [("Apple", 2), ("Banana", 1), ("Grape", 2), ("Orange", 1)]


def test_empty_tokens_are_counted(spark):
    lines = spark.createDataFrame([("a  b",), ("",)], "value string")
    assert values(aggregates.word_count(lines, "value"), "word", "n") == [("", 2), ("a", 1), ("b", 1)]


def test_crosstab_and_transpose(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "p string, q string")
    table = aggregates.crosstab(df, "p", "q")
    assert table.columns == ["p_q", "x", "y"]
    assert values(table, "p_q", "x", "y") == [("a", 2, 0), ("b", 0, 1)]
    assert tuple(reports.transposed_counts(df, "p").first()) == ("n", 2, 1)
    assert values(reports.shares(df, "p"), "p", "n", "percent") == [("a", 2, 66.7), ("b", 1, 33.3)]


def test_describe_matches_the_built_in(spark, ints):
    long = {r.stat: r.value for r in aggregates.describe(ints, ["x"]).collect()}
    built_in = {r.summary: float(r.x) for r in ints.describe("x").collect()}
    assert long == pytest.approx(built_in)


def test_text_functions(spark):
    row = spark.createDataFrame([("a||b.c|",)], "s string").select(
        text.split_on(F.col("s"), "|").alias("f"), text.split_on(F.col("s"), ".").alias("d")
    )
    first = row.select(
        "f", "d", text.field(F.col("f"), -1).alias("last"), text.field(F.col("f"), 9).alias("absent"),
        text.field_slice(F.col("f"), 1, -1).alias("middle"), text.field_slice(F.col("f"), 3).alias("tail"),
    ).first()
    assert first.f == ["a", "", "b.c", ""] and first.d == ["a||b", "c|"]
    assert (first["last"], first.absent, first.middle, first.tail) == ("", None, ["", "b.c"], [""])


def test_cleaning(spark):
    df = spark.createDataFrame([("?",), ("-1.5",), ("junk",), (None,)], "s string")
    cleaned = df.select(numeric.sentinel_to_zero(F.col("s")).alias("v"))
    assert flat(cleaned) == [0.0, -1.5, None, None]
    assert flat(cleaned.select(numeric.clamp_negative(F.col("v")))) == [0.0, 0.0, None, None]
    whole = spark.createDataFrame([(2.9,), (-2.9,)], "v double").select(numeric.truncate(F.col("v")))
    assert flat(whole) == [2, -2]


def test_decode(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (7.0,)], "season double")
    assert flat(df.select(lookup.decode(F.col("season"), lookup.SEASONS))) == ["春", "冬", None]


def test_positions_against_brute_force(spark):
    keys = [((i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(keys, "a int, b int")
    ranked = sorted(keys)
    asked = [0, 1, 499, 500, 998, 999]
    assert positions.keys_at(df, ["a", "b"], asked, 1000) == [ranked[p] for p in asked]
    numbered = positions.number_rows(df, ["a", "b"], "pos").collect()
    assert [(r.a, r.b) for r in sorted(numbered, key=lambda r: r.pos)] == ranked
    assert sorted(r.pos for r in numbered) == list(range(1000))


def test_dense_index_of_few_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    assert values(positions.dense_index(df, "x"), "x", "idx") == [("a", 0), ("b", 1), ("c", 2)]


def test_leave_range_out_against_brute_force(spark):
    rows = [(i % 7 if i % 3 else 0, i) for i in range(400)]  # user 0 holds more than a third
    df = spark.createDataFrame(rows, "u int, seq int")
    for cap in (0, 5, 1000):
        seen, taken, expected = {}, 0, {}
        for user, seq in rows:
            seen[user] = seen.get(user, 0) + 1
            hit = 2 <= seen[user] <= 4 and (cap <= 0 or taken < cap)
            taken += hit
            expected[seq] = "test" if hit else "base"
        ours = splits.leave_range_out(df, "u", ["seq"], 2, 4, max_test=cap)
        assert {r.seq: r.split for r in ours.collect()} == expected


def test_contiguous_folds(spark):
    df = spark.range(103).withColumnRenamed("id", "seq")
    folds = splits.contiguous_folds(df, ["seq"], 5)
    assert {r.seq: r.fold for r in folds.collect()} == {i: i * 5 // 103 for i in range(103)}
    blocks = splits.contiguous_folds(df, ["seq"], 5, block_rows=20)
    assert {r.seq: r.fold for r in blocks.collect()} == {i: min(i // 20, 5) for i in range(103)}
    base, test = splits.fold_frames(folds, 2)
    assert base.count() + test.count() == 103 and base.intersect(test).count() == 0


def test_hash_split_is_disjoint_and_complete(spark):
    df = spark.range(2000)
    parts = splits.split_frames(df, F.col("id"), {"train": 8, "validation": 1, "test": 1})
    sizes = {n: p.count() for n, p in parts.items()}
    assert sum(sizes.values()) == 2000
    assert 1500 < sizes["train"] < 1700 and 150 < sizes["test"] < 250
    assert sets.union_all(*parts.values()).distinct().count() == 2000


def test_sweep_ties_go_to_the_earlier_setting(spark):
    metrics = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7), (3, None)], "grid_position int, m double")
    assert sorting.best_setting(metrics, "m", True).first().grid_position == 1
    assert sorting.best_setting(metrics, "m", False).first().grid_position == 0
