"""Exact join of documents on the Jaccard similarity of their word shingles, by vertical partitioning.

The shingles have one global order: rarer ones first, then by hash. A document can only link if at most a fifth of its shingles is
its own, because two linked sets share four fifths of either.

1. The shingles in a fixed part of the hash space are counted for all documents. Documents with too many of them
   that no other has are out. This leaves few. All shingles of these are counted in the same way, and more documents go.
2. The rarest shared shingles of a document, up to the number that a partner may lack plus one, are its prefix. Linked
   documents share a shingle of their prefixes: these pairs are candidates.
3. The global order is cut at pivots into ``FRAGMENTS`` fragments with as many shingles of all documents each, and every set with it.
   Candidates meet fragment by fragment: their partial overlap there is counted, and given out unless it can't reach the bound with all
   that either set has before and after. Partial overlaps are summed per pair.

A group of many alike documents is not expanded into its pairs. Within each prefix shingle all documents are first paired
with one centre, the one with the smallest share of own shingles. Only where a shingle still holds several components,
the documents outside the largest are paired with all of the other components: every pair that could link two components
is compared, so no component is missed. Where texts are put together from common blocks but seldom link, these are most pairs
that a block's documents form with the places of the block in their orders bounding the overlap: the cost of exactness there.

Texts with equal shingle sets are one vertex, named by a 64-bit hash of the set; the chance of error is 2**-64 a pair of
sets or shingles. Null and empty texts have no shingles and link with nothing. A null doc_id counts after all others:
a component without any other has a null component_id. Rows with equal doc_id are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import opened, partitions, query, sealed, stored, table
from loamwork.llm.components import components

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]
#: The part of the hash space that is counted first, for all documents.
_FIRST = 0.25
#: Fragments of the global order.
FRAGMENTS = 4


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


class _Shingler:
    """Sorted distinct shingle hashes of texts. Word hashes are kept from text to text, up to a bound."""

    def __init__(self, width: int = 5, memory: int = 500_000):
        self.width, self.memory, self.known = width, memory, {}

    def _words(self, text: str) -> np.ndarray:
        # On bytes, lower() and split() know ASCII only: A-Z, and the blanks 09-0D and 20.
        words, known = text.encode().lower().split(), self.known
        if len(known) > self.memory:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        h = self._words(text or "")
        if not len(h):
            return h
        n = len(h) - self.width + 1
        if n < 1:
            whole = np.uint64(len(h))
            for x in h:
                whole = _mixed(np.array([whole ^ x]) * _MIX[0])[0]
            return np.array([whole], np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(self.width):
            total = _mixed(total + h[k:k + n] * _MIX[k % 5])
        total.sort()
        return total[np.append(True, total[1:] != total[:-1])]


def _name(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = _Shingler()
    for batch in batches:
        sets = [shingler(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tie"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_name, sets), pa.int64())],
            names=["doc_id", "tie", "n", "v"],
        )


def _sets(part: float):
    """Arrow step: (v, n, s) with the shingles in the lowest ``part`` of the hash space."""
    top = np.uint64(min(int(part * 2.0**64), 2**64 - 1))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                sets = [shingler(t.as_py()) for t in batch.column("text").slice(start, 512)]
                kept = [s[:np.searchsorted(s, top, "right")] for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                values = np.concatenate(kept).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(map(_name, sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(values)),
                ], names=["v", "n", "s"])

    return step


def _own(sets: DataFrame) -> DataFrame:
    """(v, n, own): documents that have shingles which no other vertex has, and how many."""
    shingles = sets.select("v", "n", F.explode("s").alias("s"))
    single = shingles.groupBy("s").agg(F.min("v").alias("v"), F.max("v").alias("other"), F.max("n").alias("n")).where(F.col("v") == F.col("other"))
    return single.groupBy("v").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("own"))


def _few_own():
    # 9 * overlap >= 4 * (n + m) and overlap <= m give 5 * overlap >= 4 * n.
    return 5 * (F.col("n") - F.col("own")) >= 4 * F.col("n")


def _could_link(a: str, b: str):
    """Whether two documents can link whose first common shingle is at these places of their orders.

    What comes before is not common, so the overlap is at most what comes from there. Where the shingle is not their
    first common one, the pair is found, and bounded rightly, at that one.
    """
    most = F.least(F.col(f"{a}n") - F.col(f"{a}at"), F.col(f"{b}n") - F.col(f"{b}at"))
    return 9 * most >= 4 * (F.col(f"{a}n") + F.col(f"{b}n"))


def pivots(shared: DataFrame, fragments: int = FRAGMENTS) -> list[tuple[int, int]]:
    """(df, hash) where fragments of the global order begin, from ``shared`` (s, df): each has about as many places of shingles.

    Shingles are counted per frequency, of which there are few; within a frequency the hashes are even.
    """
    counts = sorted((r["df"], r["n"]) for r in shared.groupBy("df").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(df * n for df, n in counts)
    out, before = [], 0
    for df, n in counts:
        while len(out) < fragments - 1 and before + df * n > total * (len(out) + 1) // fragments:
            share = (total * (len(out) + 1) // fragments - before) / (df * n)
            out.append((df, int(share * (2**64 - 1)) - 2**63))
        before += df * n
    return out


def _cut(cuts: list[tuple[int, int]]):
    """Arrow step: (v, n, order) to (v, n, fragment, before, after, s), the part of a set in each fragment, by hash."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = batch.column("order")
            offsets = order.offsets.to_numpy()
            df, s = (order.values.field(name).to_numpy() for name in ("df", "s"))
            fragment = np.zeros(len(df), np.int32)
            for at, low in cuts:
                fragment += (df > at) | (df == at) & (s >= low)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            used = np.lexsort((s[offsets[0]:offsets[-1]], fragment[offsets[0]:offsets[-1]], row)) + offsets[0]
            row, fragment, s = row, fragment[used], s[used]
            edges = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1]))) if len(row) else np.empty(0, int)
            owner = row[edges]
            # Places in the row, which hold what lies before and after a part.
            before = edges - (offsets[:-1] - offsets[0])[owner]
            sizes = np.diff(np.append(edges, len(row)))
            after = np.diff(offsets)[owner] - before - sizes
            yield pa.RecordBatch.from_arrays([
                batch.column("v").take(pa.array(owner)), batch.column("n").take(pa.array(owner)), pa.array(fragment[edges], pa.int32()),
                pa.array(before, pa.int64()), pa.array(after, pa.int64()),
                pa.ListArray.from_arrays(np.append(edges, len(row)).astype(np.int32), pa.array(s)),
            ], names=["v", "n", "fragment", "before", "after", "s"])

    return step


_PARTS = "v bigint, n bigint, fragment int, before bigint, after bigint, s array<bigint>"


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps (a, b, both, overlap) of a centre's part with those of its candidates, which follow it; ``both`` is the sum of sizes."""
    key, own = None, None
    names = ("centre", "salt", "fragment", "v", "first", "n", "before", "after")
    for batch in batches:
        out = []
        values = batch.column("s")
        offsets, flat = values.offsets.to_numpy(), values.values.to_numpy()
        for i, (c, salt, fragment, v, first, n, before, after) in enumerate(zip(*(batch.column(name).to_pylist() for name in names))):
            s = flat[offsets[i]:offsets[i + 1]]
            if first:
                key, own, own_n, own_before, own_after = (c, salt, fragment), np.array(s), n, before, after
            elif key == (c, salt, fragment):
                # Both are sorted and distinct: places where a value of one stands in the other.
                at = np.searchsorted(own, s)
                overlap = int((own[np.minimum(at, len(own) - 1)] == s).sum())
                if overlap and 9 * (overlap + min(before, own_before) + min(after, own_after)) >= 4 * (n + own_n):
                    out.append((c, v, n + own_n, overlap))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["a", "b", "both", "overlap"])


def _links(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (centre, v) that link, as stored edges (a, b). A centre's part is sent once per few thousand candidates and fragment.

    A pair is dropped in a fragment only where its whole overlap is too small, so a smaller sum drops no link.
    """
    pairs = stored(pairs, "candidates")
    per = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / 2000).cast("int").alias("salts"))
    own = per.join(parts, F.col("centre") == parts["v"]).select("centre", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *parts.columns, F.lit(True).alias("first"))
    salted = pairs.join(per, "centre").select("centre", "v", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("salt"))
    members = salted.join(parts, "v").select("centre", "salt", *parts.columns, F.lit(False).alias("first"))
    met = ["centre", "salt", "fragment"]
    rows = own.unionByName(members).repartition(partitions(parts.sparkSession), *met).sortWithinPartitions(*met, F.desc("first"))
    counted = rows.mapInArrow(_partial, "a bigint, b bigint, both bigint, overlap bigint")
    summed = counted.groupBy("a", "b").agg(F.max("both").alias("both"), F.sum("overlap").alias("overlap"))
    return stored(summed.where("9 * overlap >= 4 * both").select("a", "b"), "links")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, vertices, links).

    documents: doc_id, tie (hash of the text), n, v. vertices: v, root for each vertex that links with another. links: a, b,
    enough links between vertices to connect every component.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    described = stored(source.mapInArrow(_described, "doc_id bigint, tie bigint, n bigint, v bigint"), "shingle-sets")

    first = source.select("text").mapInArrow(_sets(_FIRST), "v bigint, n bigint, s array<bigint>")
    out = stored(_own(first).where(~_few_own()).select("v"), "alone")
    chosen = described.where("n > 0").groupBy("v").agg(F.min(F.struct("tie", "doc_id")).alias("row")).join(out, "v", "left_anti")
    chosen = chosen.select(F.col("row.tie").alias("tie"), F.coalesce("row.doc_id", F.lit(-1)).alias("key")).distinct()
    # Id and text together: equal texts do not meet in one task, and equal rows give one.
    keyed = source.select("text", "tie", F.coalesce("doc_id", F.lit(-1)).alias("key"))
    texts = keyed.join(chosen, ["tie", "key"], "left_semi").dropDuplicates(["tie", "key"]).select("text")
    sets = stored(texts.mapInArrow(_sets(1.0), "v bigint, n bigint, s array<bigint>"), "full-sets")

    own = stored(_own(sets), "own")
    near = stored(
        sets.select("v", "n").distinct().join(own.select("v", "own"), "v", "left").fillna(0, ["own"]).where(_few_own()).where(F.col("own") < F.col("n")), "near"
    )
    shingles = sets.join(near.select("v", "own"), "v").select("v", "n", "own", F.explode("s").alias("s"))
    shared = stored(
        shingles.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("v").alias("low"), F.max("v").alias("high")).where("low <> high").select("s", "df"), "shared-shingles"
    )
    ordered = shingles.join(shared, "s").groupBy("v").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_set(F.struct("df", "s"))).alias("order")
    )
    # What no document that is left shares is the document's own as well, and comes first in the order.
    counted = stored(ordered.withColumn("own", F.col("n") - F.size("order")).where(_few_own()), "ordered-sets")
    parts = stored(counted.select("v", "n", "order").mapInArrow(_cut(pivots(shared)), _PARTS), "set-parts")
    length = F.floor(F.col("n") / 5) - F.col("own") + 1
    prefix = stored(counted.select("v", "n", "own", F.posexplode(F.slice("order", F.lit(1), length.cast("int"))).alias("at", "o")).select(
        "v", "n", "own", (F.col("own") + F.col("at")).alias("at"), "o.s"), "prefixes")

    centre = prefix.groupBy("s").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "v", "n", "at")).alias("c"))
    centre = centre.select("s", F.col("c.v").alias("centre"), F.col("c.n").alias("cn"), F.col("c.at").alias("cat"))
    starred = prefix.join(centre, "s").where((F.col("v") != F.col("centre")) & _could_link("c", "")).select("centre", "v").distinct()
    links = _links(starred, parts)
    roots = components(links)

    # A shingle whose documents are all in one component is done.
    labelled = stored(prefix.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v")), "labelled")
    sizes = labelled.groupBy("s", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("s").agg(
        F.max(F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("kinds")
    ).where("kinds > 1").select("s", F.col("largest.root").alias("main"))
    open_rows = labelled.join(sizes, "s")
    outside = open_rows.where("root <> main").select("s", F.col("v").alias("centre"), F.col("root").alias("croot"), F.col("n").alias("cn"), F.col("at").alias("cat"))
    crossing = outside.join(open_rows, "s").where((F.col("root") != F.col("croot")) & _could_link("c", "")).where((F.col("root") == F.col("main")) | (F.col("v") < F.col("centre")))
    tried = starred.select("centre", "v").unionByName(starred.select(F.col("v").alias("centre"), F.col("centre").alias("v")))
    rest = crossing.select("centre", "v").distinct().join(tried, ["centre", "v"], "left_anti")
    more = _links(rest, parts)
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = components(links)
    return described, roots, links


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_shingles, component_id, for every row."""
    described, roots, _ = join(docs)
    rooted = described.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    least = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    labelled = rooted.join(least, "root", "left")
    return labelled.select("doc_id", "tie", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, then the smallest hash of its text.

    Texts without words are in no component and all stay.
    """
    described, roots, _ = join(docs)
    rooted = described.where("n > 0").join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1))
    kept = rooted.groupBy("root").agg(F.min(F.struct(key.alias("_key"), F.col("tie").alias("_tie"))).alias("k")).select("k._key", "k._tie")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(sealed(docs), key.alias("_key"), F.xxhash64(text).alias("_tie"), text.rlike(r"^[\x20\x09-\x0D]*$").alias("_wordless"))
    one = rows.where("NOT _wordless").join(kept, ["_key", "_tie"], "left_semi").dropDuplicates(["_key", "_tie"])
    return opened(one.unionByName(rows.where("_wordless")), docs.columns)


@query("op4_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
