"""Users and zip codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.operators.aggregates import count_by, crosstab
from loamwork.operators.joins import text_key_join
from loamwork.operators.reports import shares
from loamwork.sources import schemas
from loamwork.sources.readers import read_delimited


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.USERS, sep="|")


def read_zipcodes(spark: SparkSession, path: str) -> DataFrame:
    """The first four columns of the zip-code file; further columns are ignored."""
    return read_delimited(spark, path, schemas.ZIPCODES, header=True, mode="PERMISSIVE")


def with_birth_year(users: DataFrame, year: int = 2016) -> DataFrame:
    return users.select("userid", "occupation", "gender", "age", (F.lit(year) - F.col("age")).alias("birthyear"))


def matching(users: DataFrame, occupation: str, gender: str, age: int) -> DataFrame:
    found: Column = (F.col("occupation") == occupation) & (F.col("gender") == gender) & (F.col("age") == age)
    return users.filter(found)


def by_age_and_gender(users: DataFrame) -> DataFrame:
    """Oldest first, then gender, then id."""
    return users.orderBy(F.desc("age"), "gender", "userid")


def with_places(users: DataFrame, zipcodes: DataFrame) -> DataFrame:
    """Every user with city and state, null where the zip code is unknown or no number."""
    places = zipcodes.select(F.col("zipcode").alias("_zip"), "city", "state")
    return text_key_join(users, "zipcode", places, "_zip").drop("_zip")


def in_state(users: DataFrame, zipcodes: DataFrame, state: str) -> DataFrame:
    return with_places(users, zipcodes).filter(F.col("state") == state)


def by_state(users: DataFrame, zipcodes: DataFrame) -> DataFrame:
    """(state, n). Users are counted per zip code before they meet the states; unknown zips form the null state."""
    per_zip = users.groupBy("zipcode").agg(F.count(F.lit(1)).alias("_n"))
    return with_places(per_zip, zipcodes).groupBy("state").agg(F.sum("_n").alias("n"))


def by_gender_and_occupation(users: DataFrame) -> DataFrame:
    return count_by(users, "gender", "occupation").orderBy("gender", "occupation")


def occupations_by_gender(users: DataFrame) -> DataFrame:
    return crosstab(users, "occupation", "gender", ["F", "M"])


def occupation_shares(users: DataFrame) -> DataFrame:
    return shares(users, "occupation")
