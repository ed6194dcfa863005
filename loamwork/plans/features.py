"""Feature engineering (M). Vectors are compared in long form."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loamwork.learning import features
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.workspace import held

_RANKED = """
langs AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx FROM pages_in GROUP BY lang)"""


def _fitted(stages, df):
    with held(df):
        return Pipeline(stages=stages).fit(df)


@query("m01_string_index", f"WITH {derived.BINARY_SQL}, {_RANKED} SELECT doc_id, p.lang, CAST(idx AS DOUBLE) AS lang_index FROM pages_in p JOIN langs USING (lang)")
def string_index(t):
    docs = derived.labelled_documents(t).select("doc_id", "lang")
    return features.indexer(["lang"]).fit(docs).transform(docs)


@query("m02_one_hot", f"WITH {derived.BINARY_SQL}, {_RANKED} SELECT doc_id, CAST(idx AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM pages_in p JOIN langs USING (lang)")
def one_hot(t):
    docs = derived.labelled_documents(t).select("doc_id", "lang")
    model = _fitted([features.indexer(["lang"]), features.encoder(["lang"])], docs)
    return features.vector_rows(model.transform(docs), ["doc_id"], "lang_slots").filter("value <> 0")


_NUMBER_ROWS = """
numbers AS (
  SELECT doc_id, 0 AS slot, n_chars AS value FROM pages_in UNION ALL
  SELECT doc_id, 1, n_spaces FROM pages_in UNION ALL SELECT doc_id, 2, n_lines FROM pages_in)"""


@query("m03_assemble", f"WITH {derived.BINARY_SQL}, {_NUMBER_ROWS} SELECT doc_id, CAST(slot AS INTEGER) AS slot, value FROM numbers")
def assemble(t):
    docs = derived.labelled_documents(t)
    return features.vector_rows(features.assembler(derived.NUMBERS).transform(docs), ["doc_id"])


@query("m04_vector_index", f"""
WITH {derived.HOURLY_SQL}
SELECT day_of_year, hr, 0 AS slot, CAST(dense_rank() OVER (ORDER BY hr) - 1 AS DOUBLE) AS value FROM hours UNION ALL
SELECT day_of_year, hr, 1, CAST(dense_rank() OVER (ORDER BY weekday) - 1 AS DOUBLE) FROM hours UNION ALL
SELECT day_of_year, hr, 2, round(mean_value, 6) FROM hours""")
def vector_index(t):
    hours = derived.hours(t)
    stages = [features.assembler(derived.HOUR_FEATURES, "assembled"), features.category_slots(24)]
    model = _fitted(stages, hours)
    rows = features.vector_rows(model.transform(hours), ["day_of_year", "hr"])
    return rows.withColumn("value", F.round("value", 6))


@query("m05_standardise", f"""
WITH {derived.BINARY_SQL}, {_NUMBER_ROWS}, moments AS (SELECT slot, avg(value) AS m, stddev_samp(value) AS s FROM numbers GROUP BY slot)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round((value - m) / s, 6) AS value FROM numbers JOIN moments USING (slot)""")
def standardise(t):
    return _scaled(t, center=True)


@query("m06_scale_by_deviation", f"""
WITH {derived.BINARY_SQL}, {_NUMBER_ROWS}, moments AS (SELECT slot, stddev_samp(value) AS s FROM numbers GROUP BY slot)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(value / s, 6) AS value FROM numbers JOIN moments USING (slot)""")
def scale_by_deviation(t):
    return _scaled(t, center=False)


def _scaled(t, center):
    docs = derived.labelled_documents(t)
    model = _fitted([features.assembler(derived.NUMBERS, "assembled"), features.scaler(center)], docs)
    rows = features.vector_rows(model.transform(docs), ["doc_id"])
    return rows.withColumn("value", F.round("value", 6))


@query("m07_mixed_vector", f"""
WITH {derived.BINARY_SQL}, {_RANKED}, {_NUMBER_ROWS}, width AS (SELECT count(*) + 1 AS n FROM langs),
slots AS (SELECT unnest(range(0, (SELECT n FROM width))) AS slot)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CASE WHEN slot = idx THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM pages_in JOIN langs USING (lang), slots
UNION ALL SELECT doc_id, CAST(slot + (SELECT n FROM width) AS INTEGER), value FROM numbers""")
def mixed_vector(t):
    docs = derived.labelled_documents(t)
    model = _fitted(features.mixed_features(["lang"], derived.NUMBERS), docs)
    return features.vector_rows(model.transform(docs), ["doc_id"])


@query("m08_numeric_vector", """
SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(slot - 1 AS INTEGER) AS slot, CAST(embedding[slot] AS DOUBLE) AS value
FROM embeddings, (SELECT unnest(range(1, 65)) AS slot)""")
def numeric_vector(t):
    one_based = t.embeddings.select(
        "vec_id", (F.col("label") + 1).alias("code"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    points = features.labelled_points(one_based, "code", keep=["vec_id"], shift=1)
    return features.vector_rows(points, ["vec_id", "label"])


@query("m09_chosen_columns", f"""
WITH {derived.HOURLY_SQL}
SELECT day_of_year, hr, cnt AS label, 0 AS slot, hr AS value FROM hours UNION ALL
SELECT day_of_year, hr, cnt, 1, weekday FROM hours UNION ALL
SELECT day_of_year, hr, cnt, 2, round(mean_value, 6) FROM hours""")
def chosen_columns(t):
    # n_users is left out: it nearly states the count that is to be predicted.
    hours = derived.hours(t).withColumn("mean_value", F.round("mean_value", 6))
    points = features.labelled_points(
        features.assembler(derived.HOUR_FEATURES).transform(hours), "cnt", keep=["day_of_year", "hr"]
    )
    return features.vector_rows(points, ["day_of_year", "hr", "label"])


@query("m10_labelled_point", f"WITH {derived.BINARY_SQL}, {_NUMBER_ROWS} SELECT doc_id, label, CAST(slot AS INTEGER) AS slot, value FROM numbers JOIN pages_in USING (doc_id)")
def labelled_point(t):
    docs = features.assembler(derived.NUMBERS).transform(derived.labelled_documents(t))
    return features.vector_rows(features.labelled_points(docs, "label", keep=["doc_id"]), ["doc_id", "label"])
