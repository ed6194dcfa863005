"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct shingle hashes of a text. Sketches of parts merge into the
sketch of the whole, so a long text is sketched part by part and a corpus partition by partition. Two sketches give
estimates of resemblance and containment, one gives the number of distinct shingles.

Null and empty texts have an empty sketch; two empty sketches resemble each other fully, an empty and a filled one not at all.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamwork.llm.common import bound, partitions, query, shingles, table, word_hashes

_PART_WORDS = 16_384


def merged(a: Column, b: Column, k: int) -> Column:
    """The sketch of two parts together. A hash keeps its place when more is merged in, so the order of merges is free."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def sketch(text: Column, k: int = 128, width: int = 5) -> Column:
    """Sketch of a text. Parts overlap by ``width - 1`` words, so every shingle lies in one; memory holds one part's hashes."""
    none = F.array().cast("array<bigint>")

    def folded(hashes: Column) -> Column:
        def add(state: Column, part: Column) -> Column:
            own = shingles(F.slice(hashes, part * _PART_WORDS + 1, _PART_WORDS + width - 1), width)
            return merged(state, F.slice(F.sort_array(F.array_distinct(own)), 1, k), k)

        # A last part of fewer than ``width`` words lies wholly in the one before.
        last = F.greatest(F.floor((F.size(hashes) - width) / _PART_WORDS), F.lit(0)).cast("int")
        return F.aggregate(F.sequence(F.lit(0), last), none, add)

    return bound(word_hashes(text), folded)


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated Jaccard similarity of two shingle sets: the shared part of the k smallest hashes of both together."""
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_count(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``.

    From J = |A∩B| / |A∪B| and |A∪B| estimated on the merged sketch.
    """
    inside = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), inside / distinct_count(a, k)))


def corpus_sketch(docs: DataFrame, by: list[str], k: int = 128) -> DataFrame:
    """One sketch of all texts per group: documents are sketched where they lie, then their hashes merge.

    Each hash is counted map-side, and only the k smallest of a group's task leave it.
    """
    hashes = docs.select(*by, F.explode(sketch(F.col("text"), k)).alias("h")).distinct()
    salted = hashes.groupBy(*by, (F.pmod(F.xxhash64("h"), F.lit(64))).alias("salt")).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias("s"))
    return salted.groupBy(*by).agg(F.slice(F.sort_array(F.flatten(F.collect_list("s"))), 1, k).alias("sketch"))


def as_text(a: Column) -> Column:
    """A sketch as 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _buckets(ids: DataFrame, wanted: int) -> Column:
    """Number of the id range that ``k`` falls in, of up to ``wanted`` ranges of about equal size, at most 10,000.

    The edges are quantiles, found by one aggregation. They are searched in two steps, so a row compares with about twice
    the square root of their number.
    """
    n = min(max(wanted, 1), 10_000)
    found = ids.select(F.percentile_approx("k", [(i + 0.5) / n for i in range(n)], 10 * n).alias("q")).first()["q"]
    edges = sorted(set(found or []))
    if not edges:
        return F.lit(0)
    width = ceil(sqrt(len(edges)))
    chunks = [edges[i:i + width] for i in range(0, len(edges), width)]

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda e: e <= F.col("k")))

    coarse = at_most(F.array(*[F.lit(c[0]) for c in chunks]))
    fine = at_most(F.element_at(F.array(*[F.array(*map(F.lit, c)) for c in chunks]), F.greatest(coarse, F.lit(1))))
    return coarse * 100_000 + fine


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, edited): the last third of each text replaced from the next document.

    Next is by descending doc_id, null last, equal ids by a hash of their text; after the last comes the first. Texts are
    shuffled once, into ranges of ids. The first row of each range also goes, as an extra row, to the end of the range
    before it, so that every row finds its next one in its own range.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("k"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("bucket", _buckets(rows, 4 * partitions(docs.sparkSession)))
    # At most one row per range, 10,000 in all; without texts, as one task puts them in order.
    before = F.lag("bucket").over(Window.orderBy(F.desc("bucket")))
    last = F.min("bucket").over(Window.partitionBy())
    top = rows.groupBy("bucket").agg(F.max(F.struct("k", "tie")).alias("top")).select(
        "bucket", "top.k", "top.tie", F.coalesce(before, last).alias("target")
    )
    heads = rows.join(F.broadcast(top), ["bucket", "k", "tie"]).groupBy("target").agg(F.min("text").alias("text"))
    copies = heads.select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", F.lit(None).cast("bigint").alias("k"),
        F.lit(None).cast("bigint").alias("tie"), F.col("target").alias("bucket"), F.lit(True).alias("copied"),
    )
    ordered = Window.partitionBy("bucket").orderBy("copied", F.desc("k"), F.desc("tie"))
    both = rows.withColumn("copied", F.lit(False)).unionByName(copies)
    paired = both.withColumn("next_text", F.lead("text").over(ordered)).where(~F.col("copied"))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third))
    return paired.select("doc_id", "text", "next_text", edited.alias("edited"))


@query("op7_fingerprints")
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = edited_neighbours(table(spark, folder, "documents"))
    s = pairs.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("edit"), sketch(F.col("next_text")).alias("next"),
    )
    return s.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edit")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("edit")).alias("near_edited"), resemblance(F.col("own"), F.col("next")).alias("near_next"),
    )
