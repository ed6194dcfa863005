"""Divergence of the sources of a language, by a quadtree over the matrix of groups and terms.

A group is a language and a source, a term a run of letters that at least ``min_docs`` documents of the language have. With add-two
smoothing each group gives every term an integer share p in billionths, and two groups differ in a term by
f = (p - q)**2 // (p + q). Everything is whole numbers, so results don't depend on the order of sums.

The matrix of counts has a row per group and a column per term, larger groups and more frequent terms first, and is kept as a
quadtree: only tiles of 64 rows and 2,048 columns with a count are stored, and a tile is cut, and again in four, as long as a part has counts.
Most of the matrix is zero, and all zeros of a group have the same share. So pairs of groups are priced in three parts:

1. As if both groups were all zero: the number of terms times one f.
2. Against a group of zeros only: a group's counts, of which few are different, folded by value.
3. Where both have counts: the trees of both groups are descended together, along the same columns, and only quadrants in
   which neither is all zero are entered; at the leaves the first two parts are put right.

Texts are counted in Arrow batches, combined in the task before they are shuffled. A null text, language or source counts as ''.
Groups without a kept term stay, with equal shares. Repeated rows are documents of their own; extra columns are ignored.
The result has one row for each pair of groups of a language, which is what it grows with.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamwork.llm.common import query, stored, table
from loamwork.operators.joins import broadcast_if_small
from loamwork.operators.positions import number_rows

#: ASCII bytes that are no letters become blanks, A-Z become a-z; the bytes of all other characters stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Rows and columns of a stored tile, and the side of the quadrants where the descent ends.
TILE, SPAN, LEAF = 64, 2048, 16
_HELD = 400_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df): occurrences and documents, summed over up to ``_HELD`` entries at a time."""
    times: dict[tuple, Counter] = {}
    documents: dict[tuple, Counter] = {}

    def given():
        langs, sources, terms, n, df = [], [], [], [], []
        for (lang, source), counter in times.items():
            within = documents[lang, source]
            langs.extend([lang] * len(counter))
            sources.extend([source] * len(counter))
            terms.extend(counter)
            n.extend(counter.values())
            df.extend(map(within.__getitem__, counter))
        times.clear()
        documents.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(df, pa.int64())],
            names=["lang", "source", "term", "n", "df"],
        )

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            words = text.encode().translate(_LETTERS).split()
            counter = times.setdefault((lang, source), Counter())
            within = documents.setdefault((lang, source), Counter())
            held -= len(counter)
            counter.update(words)
            within.update(set(words))
            held += len(counter)
            if held > _HELD:
                yield given()
                held = 0
    yield given()


def term_counts(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """(lang, source, term, n, total) of all terms that at least ``min_docs`` documents of the language have.

    ``n`` counts the group's occurrences, ``total`` the language's. Rows are shuffled once, by language and term.
    """
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = named.mapInArrow(_counted, "lang string, source string, term string, n bigint, df bigint")
    cells = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    everywhere = Window.partitionBy("lang", "term")
    summed = cells.withColumns({"total": F.sum("n").over(everywhere), "df": F.sum("df").over(everywhere)})
    return summed.where(F.col("df") >= min_docs).select("lang", "source", "term", "n", "total")


def _share(count: Column | str, n: str = "n_all", terms: str = "n_terms") -> Column:
    """1 + floor(1e9 * (count + 2) / (N + 2 V)) in decimals, so that no count is too large; null without terms."""
    return F.expr(f"1 + CAST(1000000000 AS DECIMAL(38,0)) * ({count} + 2) div nullif({n} + 2 * {terms}, 0)").cast("bigint")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def descend(a: np.ndarray, b: np.ndarray, zero_a: np.ndarray, zero_b: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` (rows of a, rows of b) what the columns where both have counts differ from the price against zeros.

    ``a`` and ``b`` hold shares, 0 where the count is 0, of two row quadrants over the same columns; ``zero_a`` and ``zero_b`` the
    shares of their zeros. A quadrant without counts ends the descent: it is priced already.
    """
    if not a.any() or not b.any():
        return
    longest = max(a.shape + b.shape)
    if longest > LEAF:
        def halves(n):
            return (slice(0, n // 2), slice(n // 2, n)) if n == longest else (slice(0, n),)

        for columns in halves(a.shape[1]):
            for top in halves(a.shape[0]):
                for left in halves(b.shape[0]):
                    descend(a[top, columns], b[left, columns], zero_a[top], zero_b[left], out[top, left])
        return
    both = (a[:, None, :] > 0) & (b[None, :, :] > 0)
    row, other, column = np.nonzero(both)
    p, q, p0, q0 = a[row, column], b[other, column], zero_a[row], zero_b[other]
    change = _difference(p, q) - _difference(p, q0) - _difference(p0, q) + _difference(p0, q0)
    np.add.at(out, (row, other), change)


def _dense(cells: np.ndarray, shares: np.ndarray) -> np.ndarray:
    out = np.zeros(TILE * SPAN, np.int64)
    out[cells] = shares
    return out.reshape(TILE, SPAN)


def _jointly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of tiles on the same columns to (lang, g, h, value)."""
    def numbers(batch, name, i):
        return batch.column(name)[i].values.to_numpy()

    for batch in batches:
        for k, (lang, i, j) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "i", "j")))):
            a = _dense(numbers(batch, "cells", k), numbers(batch, "shares", k))
            b = _dense(numbers(batch, "other_cells", k), numbers(batch, "other_shares", k))
            out = np.zeros((TILE, TILE), np.int64)
            descend(a, b, numbers(batch, "zeros", k), numbers(batch, "other_zeros", k), out)
            row, other = np.nonzero(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(row), pa.string()), pa.array(row + i * TILE), pa.array(other + j * TILE), pa.array(out[row, other])], names=["lang", "g", "h", "value"]
            )


def _tiles(cells: DataFrame, groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, i, column, cells, shares, zeros): every tile that has a count, with the shares of its rows' zeros."""
    placed = cells.join(broadcast_if_small(terms), ["lang", "term"]).join(broadcast_if_small(groups.select("lang", "source", "g", "n_all", "n_terms")), ["lang", "source"])
    priced = placed.select("lang", F.expr(f"g div {TILE}").alias("i"), F.expr(f"at div {SPAN}").alias("column"), ((F.col("g") % TILE) * SPAN + F.col("at") % SPAN).alias("cell"), _share("n").alias("p"))
    tiles = priced.groupBy("lang", "i", "column").agg(F.collect_list(F.struct("cell", "p")).alias("filled"))
    zeros = groups.groupBy("lang", F.expr(f"g div {TILE}").alias("i")).agg(F.sort_array(F.collect_list(F.struct("g", "p0"))).alias("rows"))
    # Rows beyond the last group have no counts, so their share is never used; one keeps it from dividing by zero.
    padded = F.concat(F.col("rows.p0"), F.array_repeat(F.lit(1).cast("bigint"), F.lit(TILE) - F.size("rows")))
    return tiles.join(broadcast_if_small(zeros.select("lang", "i", padded.alias("zeros"))), ["lang", "i"]).select(
        "lang", "i", "column", F.col("filled.cell").alias("cells"), F.col("filled.p").alias("shares"), "zeros"
    )


def pair_values(cells: DataFrame, groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, g, h, value) for all pairs of different groups of a language, in both orders."""
    sides = groups.select("lang", F.col("g").alias("h"), F.col("p0").alias("q0"))
    partners = broadcast_if_small(sides)
    empty = groups.join(partners, "lang").where("g <> h").select("lang", "g", "h", F.expr(f"coalesce(n_terms * ({_apart('p0', 'q0')}), 0)").alias("value"))
    # Equal counts of a group have equal shares.
    folded = stored(cells.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("times")), "count-values")
    priced = folded.join(broadcast_if_small(groups), ["lang", "source"]).select("lang", "g", "p0", _share("n").alias("p"), "times")
    against = priced.join(partners, "lang").where("g <> h").groupBy("lang", "g", "h").agg(
        F.sum(F.expr(f"times * ({_apart('p', 'q0')} - {_apart('p0', 'q0')})")).alias("value")
    )
    mirrored = against.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value")

    tiles = stored(_tiles(cells, groups, terms), "count-tiles")
    others = tiles.select("lang", "column", F.col("i").alias("j"), *[F.col(c).alias(f"other_{c}") for c in ("cells", "shares", "zeros")])
    met = tiles.join(others, ["lang", "column"]).where("i <= j").drop("column")
    joint = met.mapInArrow(_jointly, "lang string, g bigint, h bigint, value bigint").where("g <> h")
    # Two row blocks meet once, a block with itself in both orders.
    turned = joint.where(F.expr(f"g div {TILE} <> h div {TILE}")).select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value")
    parts = empty.unionByName(against).unionByName(mirrored).unionByName(joint).unionByName(turned)
    return parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language, and by which terms.

    Part ``pair`` has every other source with the sum of f over all kept terms. Part ``term`` has the ``top`` terms that the source has
    more of than the language, by f against the language's share.
    """
    cells = stored(term_counts(docs, min_docs), "kept-counts")
    listed = stored(cells.groupBy("lang", "term").agg(F.max("total").alias("total")), "kept-terms")
    languages = listed.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("total").alias("n_lang"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    present = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    filled = present.join(sums, ["lang", "source"], "left").join(languages, "lang", "left").fillna(0, ["n_all", "n_terms", "n_lang"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_all"), "source")) - 1
    groups = stored(filled.withColumns({"g": place.cast("bigint"), "p0": _share("0")}), "groups")
    # Columns are numbered through all languages: a tile belongs to one language all the same.
    numbered = number_rows(listed.withColumn("order", -F.col("total")), ["lang", "order", "term"], "at")
    terms = stored(numbered.select("lang", "term", "at"), "term-columns")

    names = groups.select("lang", "g", "source")
    valued = pair_values(cells, groups, terms).join(broadcast_if_small(names), ["lang", "g"]).join(
        broadcast_if_small(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))), ["lang", "h"])
    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = valued.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(within).alias("rank"))

    shared = cells.join(broadcast_if_small(groups.drop("g", "p0")), ["lang", "source"])
    marked = shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _share("n").alias("p"), _share("total", "n_lang").alias("q"))
    ahead = marked.where("p > q").select("lang", "source", "part", "item", F.expr(_apart("p", "q")).alias("value"))
    best = ahead.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top)
    return pairs.unionByName(best)


_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
tokens AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY ALL HAVING count(DISTINCT r) >= 10),
languages AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(s.n, 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN languages USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) s USING (lang, source)
),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * g.v) AS p,
        1 + 1000000000::HUGEINT * (k.total + 2) // (l.n + 2 * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN languages l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
    SELECT g.lang, g.source, h.source AS item, coalesce(s.value, 0) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
),
rows AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_divergence", _SQL)
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents").select("lang", "source", "text"))
