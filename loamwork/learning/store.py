"""Factor models stored for point lookups.

Each side's factors lie in folders by a hash of the id, sorted by id: looking one up opens one folder, and within it the row group whose
bounds hold the id. Next to them lie the side's blocks of falling norm, so a list is served from one factor and the blocks
in its reach, without loading the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.learning.recommend import with_titles
from loamwork.learning.serving import norm_blocks, search_blocks

#: Factors of one folder, about; bytes of a row group.
FOLDER_ROWS, GROUP_BYTES = 200_000, 1 << 20
SIDES = {"user": "userFactors", "item": "itemFactors"}


def _folder(key: Column, folders: int) -> Column:
    return F.pmod(F.hash(key.cast("int")), F.lit(folders)).cast("int")


def save_factors(model, path: str, block_rows: int = 1024) -> None:
    """Write both sides of a factor model below ``path``, which must not exist."""
    spark = model.userFactors.sparkSession
    layout = []
    for side, attribute in SIDES.items():
        factors = getattr(model, attribute)
        folders = max(1, -(-factors.count() // FOLDER_ROWS))
        rows = factors.withColumn("folder", _folder(F.col("id"), folders))
        (
            rows.repartition(folders, "folder").sortWithinPartitions("folder", "id")
            .write.partitionBy("folder").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/{side}")
        )
        norm_blocks(factors, block_rows).repartitionByRange("block").sortWithinPartitions("block").write.option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/{side}-blocks")
        layout.append((side, folders))
    spark.createDataFrame(layout, "side string, folders int").coalesce(1).write.parquet(f"{path}/layout")


def lookup(spark: SparkSession, path: str, side: str, key: int) -> DataFrame:
    """(id, features) of one id of a side; no row if the model doesn't know it."""
    folders = spark.read.parquet(f"{path}/layout").where(F.col("side") == side).first()["folders"]
    folder = spark.range(1).select(_folder(F.lit(key), folders)).first()[0]
    stored = spark.read.schema("id int, features array<float>, folder int").parquet(f"{path}/{side}")
    return stored.where((F.col("folder") == folder) & (F.col("id") == key)).select("id", "features")


def predict_pair(spark: SparkSession, path: str, user: int, item: int) -> float | None:
    """The predicted rating of one pair, from two lookups; None if either side is unknown."""
    found = [lookup(spark, path, side, key).first() for side, key in (("user", user), ("item", item))]
    if None in found:
        return None
    return float(sum(a * b for a, b in zip(found[0]["features"], found[1]["features"])))


def serve_stored(spark: SparkSession, path: str, direction: str, key: int, n: int, titles: DataFrame) -> DataFrame:
    """Top list from a stored model: ``direction`` "U" gives items for a user, "M" gives users for an item."""
    if direction not in ("U", "M"):
        raise ValueError("direction is U or M")
    own, other = ("user", "item") if direction == "U" else ("item", "user")
    blocks = spark.read.parquet(f"{path}/{other}-blocks")
    found = search_blocks(lookup(spark, path, own, key), blocks, n)
    listed = found.select(F.col("id").alias(f"{own}_id"), "place", F.col("other").alias(f"{other}_id"), "score")
    return with_titles(listed, titles)
