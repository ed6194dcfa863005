"""Merkle manifest of a dataset, proved by a recursive climb.

A row's leaf is the SHA-256 of its fields. The leaves of a source, in order of id, are joined in runs of 16 to nodes, these to
nodes again, up to the source's root; the roots of the sources, in order of name, are joined in the same way to the dataset's root.
Every inner node is a stored row: its children's digests and a link to its parent. A Spark recursive query then climbs
from the leaves along the parent links, appends the siblings it passes and folds the digest of the row as it was found.

All leaves of one run share every sibling above the run. So one row climbs for a run: it holds the folded digest of each of
its leaves and the siblings once, and is at most 16 digests wide plus 15 a level. A node near the root is met by every run below
it; such nodes are repeated per salt, one salt for ``RUNS_PER_SALT`` runs, so no key is hot however large a source is.

Nulls in any column have a mark of their own, differing from an empty text. A null id comes before all others and a null source
is a source of its own, before ''. Rows of equal id are ordered by their leaf digest; repeated rows are leaves of their own.
An empty table has no rows and no root. Extra columns are not part of a leaf and are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.llm.common import lowered, query, stored, table
from loamwork.operators.joins import broadcast_if_small
from loamwork.operators.positions import number_rows

#: Children of a node; runs of leaves that meet one copy of a node.
FANOUT, RUNS_PER_SALT = 16, 256
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: The tree over the sources' roots; trees of sources count from 0.
_TOP = -1
_NODE = "node string, children binary, digest binary, up string, slot int, below bigint, top boolean"


def digest(*values: Column) -> Column:
    """SHA-256 of fields in order: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _text(digests: Column) -> Column:
    """Digests travel as bytes, one after the other, and are hashed as lower-case hexadecimal text."""
    return F.lower(F.hex(digests))


def _hashed(digests: Column) -> Column:
    return F.unhex(F.sha2(_text(digests).cast("binary"), 256))


def _joined(digests: Column) -> Column:
    """The digests of an array, one after the other."""
    return F.unhex(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""))


def _before(joined: Column, at: Column) -> Column:
    return F.substring(joined, F.lit(1), 32 * at)


def _after(joined: Column, at: Column) -> Column:
    return F.substring(joined, 32 * at + 33, F.lit(32 * FANOUT))


def _name(tree: Column, level: int | Column, pos: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), (F.lit(level) if isinstance(level, int) else level).cast("string"), pos.cast("string"))


def _grown(bottom: DataFrame, sizes: DataFrame, most: int, above) -> tuple[list[DataFrame], DataFrame]:
    """(levels, roots) of the trees over ``bottom`` (tree, pos, digest, below).

    ``sizes`` has tree and n, the number of bottom nodes; ``most`` is the largest n. ``above`` gives a tree's root its link: a
    function of the column tree to (up, slot). Each level is a table of inner nodes, roots has (tree, digest, below).
    """
    up, slot = above(F.col("tree"))
    levels, nodes, level = [], bottom.join(broadcast_if_small(sizes), "tree"), 0
    roots = nodes.where("n = 1").select("tree", "digest", "below")
    while most > 1:
        level, most = level + 1, -(-most // FANOUT)
        runs = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FANOUT}").alias("run"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("kids"), F.sum("below").alias("below")
        )
        made = runs.select("tree", F.col("run").alias("pos"), "n", "below", _joined(F.col("kids.digest")).alias("children")).withColumn("digest", _hashed(F.col("children")))
        last = F.col("n") == 1
        linked = made.select(
            "tree", "pos", "n", _name(F.col("tree"), level, F.col("pos")).alias("node"), "children", "digest",
            F.when(last, up).otherwise(_name(F.col("tree"), level + 1, F.expr(f"pos div {FANOUT}"))).alias("up"),
            F.when(last, slot).otherwise((F.col("pos") % FANOUT).cast("int")).alias("slot"), "below", (F.col("tree") == _TOP).alias("top"),
        )
        nodes = stored(linked, f"merkle-level-{level}")
        levels.append(nodes)
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest", "below"))
    return levels, roots


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """Lifts the limit on the rows of a recursive query, which is set for small tables, while one is run."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, runs) of ``leaves`` (doc_id, source, leaf, found): digests as bytes, ``found`` that of the row as it was found, null if the same.

    nodes: every inner node with its children and the link to its parent; the root has none. runs: the leaves, 16 a row as the
    lowest nodes join them, with the link of the node that joins them; the leaf of a source of one row links for itself.
    """
    spark = leaves.sparkSession
    placed = stored(number_rows(leaves.select("source", "doc_id", "leaf", "found"), ["source", "doc_id", "leaf"], "_at"), "merkle-leaves")
    per_source = stored(placed.groupBy("source").agg(F.min("_at").alias("start"), F.count(F.lit(1)).alias("n")), "merkle-sources")
    sources = stored(number_rows(per_source, ["start"], "tree"), "merkle-source-numbers")
    n_sources, most = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    # Rows are joined to their tree by the source's name; a source's rows are one range, so only its start is taken off.
    numbered = placed.join(broadcast_if_small(sources.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source")))
    rows = numbered.select("tree", "n", (F.col("_at") - F.col("start")).alias("pos"), "doc_id", "leaf", "found")
    runs = stored(
        rows.groupBy("tree", "n", F.expr(f"pos div {FANOUT}").alias("run")).agg(F.sort_array(F.collect_list(F.struct("pos", "leaf", "found", "doc_id"))).alias("leaves")),
        "merkle-runs",
    )
    # The lowest inner node of a run stands for it; a source of one row is its own root.
    joined = F.when(F.col("n") > 1, _hashed(_joined(F.col("leaves.leaf")))).otherwise(F.col("leaves")[0]["leaf"])
    bottom = runs.select("tree", F.col("run").alias("pos"), joined.alias("digest"), F.lit(1).cast("bigint").alias("below"))
    sizes = sources.select("tree", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))

    def to_top(tree: Column):
        if n_sources <= 1:
            return F.lit(None).cast("string"), F.lit(None).cast("int")
        return _name(F.lit(_TOP), 1, F.expr(f"tree div {FANOUT}")), (tree % FANOUT).cast("int")

    def nowhere(_):
        return F.lit(None).cast("string"), F.lit(None).cast("int")

    levels, roots = _grown(bottom, sizes, -(-most // FANOUT), to_top)
    tops = stored(roots.select(F.lit(_TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest", "below"), "merkle-subroots")
    top_sizes = spark.range(1).select(F.lit(_TOP).cast("bigint").alias("tree"), F.lit(n_sources).cast("bigint").alias("n"))
    more, _ = _grown(tops, top_sizes, n_sources, nowhere)
    nodes = spark.createDataFrame([], _NODE)
    for part in [*levels, *more]:
        nodes = nodes.unionByName(part.select(*nodes.columns))
    up, slot = to_top(F.col("tree"))
    alone = F.col("n") <= FANOUT
    linked = runs.select(
        "tree", "run", "leaves", joined.alias("digest"),
        F.when(alone, up).otherwise(_name(F.col("tree"), 1, F.expr(f"run div {FANOUT}"))).alias("up"),
        F.when(alone, slot).otherwise((F.col("run") % FANOUT).cast("int")).alias("slot"),
    )
    return nodes, linked


#: One row a run. ``folded`` has the digest of each leaf as found, folded so far; ``above`` the siblings passed.
_CLIMB = """
WITH RECURSIVE climb (tree, run, folded, above, subroot, root, up, slot, salt) AS (
    SELECT tree, run, folded, above, subroot, root, up, slot, salt FROM {start}
  UNION ALL
    SELECT c.tree, c.run,
        transform(c.folded, f -> unhex(sha2(lower(hex(
            concat(substring(p.children, 1, 32 * c.slot), f, substring(p.children, 32 * c.slot + 33)))), 256))),
        concat(c.above, substring(p.children, 1, 32 * c.slot), substring(p.children, 32 * c.slot + 33)),
        coalesce(c.subroot, IF(p.top, substring(p.children, 32 * c.slot + 1, 32), NULL)),
        p.digest, p.up, p.slot, CAST(pmod(c.run, p.salts_above) AS INT)
    FROM climb c JOIN {nodes} p ON c.up = p.node AND c.salt = p.salt
)
SELECT tree, run, folded, above, coalesce(subroot, root) AS subroot, root FROM climb WHERE up IS NULL
"""


def prove(nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, leaf, found, subroot, root, proof_sha256, folded_root and verified of every leaf of a manifest.

    ``proof_sha256`` is the SHA-256 of all siblings from the leaf to the root; ``folded_root`` the root that the siblings and
    the digest as found give; ``verified`` whether it is the root.
    """
    spark = nodes.sparkSession
    salts = F.ceil(F.col("below") / RUNS_PER_SALT).cast("bigint")
    widths = stored(nodes.select(F.col("node").alias("up"), salts.alias("salts_above")), "merkle-salts")
    one = F.coalesce("salts_above", F.lit(1).cast("bigint"))
    climbed = stored(
        nodes.withColumn("salts", salts).join(widths, "up", "left").withColumn("salts_above", one)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int")))).select("node", "salt", "children", "digest", "up", "slot", "salts_above", "top"),
        "merkle-nodes",
    )
    # The digests of a run's leaves are joined once, as a column of their own.
    joined = runs.withColumn("joined", _joined(F.col("leaves.leaf")))
    shown = F.transform("leaves", lambda leaf: F.coalesce(leaf["found"], leaf["leaf"]))
    folded = F.transform(shown, lambda f, i: _hashed(F.concat(_before(F.col("joined"), i), f, _after(F.col("joined"), i))))
    # A run of one leaf is hashed too, unless it is all of its source.
    single = (F.size("leaves") == 1) & (F.col("digest") == F.col("joined"))
    start = stored(joined.join(widths, "up", "left").select(
        "tree", "run", F.when(single, shown).otherwise(folded).alias("folded"), F.lit("").cast("binary").alias("above"),
        F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"), "up", "slot", F.pmod("run", one).cast("int").alias("salt"),
    ), "merkle-start")
    with _any_number_of_rows(spark):
        ends = stored(spark.sql(_CLIMB, start=start, nodes=climbed), "merkle-climbed")
    rows = joined.select("tree", "run", "leaves", "joined").join(ends, ["tree", "run"])
    at, end = F.col("at"), F.col("folded")[F.col("at")]
    siblings = F.concat(_before(F.col("joined"), at), _after(F.col("joined"), at), "above")
    return rows.select("folded", "above", "subroot", "root", "joined", F.posexplode("leaves").alias("at", "row")).select(
        "row.doc_id", _text(F.col("row.leaf")).alias("leaf"), _text(F.coalesce("row.found", "row.leaf")).alias("found"), _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"), F.sha2(_text(siblings).cast("binary"), 256).alias("proof_sha256"),
        _text(end).alias("folded_root"), (end == F.col("root")).alias("verified"),
    )


def audit(docs: DataFrame, found: Column) -> DataFrame:
    """Proofs of all rows of ``docs`` (doc_id, source, lang, n_chars, text), whose text was later found to be ``found``."""
    fields = [F.col(c) for c in FIELDS]
    changed = F.when(~found.eqNullSafe(F.col("text")), F.unhex(digest(*fields[:-1], found)))
    return prove(*build(docs.select("doc_id", "source", F.unhex(digest(*fields)).alias("leaf"), changed.alias("found"))))


_SQL = """
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)
    )
),
shown AS (
    SELECT doc_id, source, lang, n_chars, text,
        CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0
            THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found
    FROM documents, crc
),
fields AS (
    SELECT doc_id, source, found, text,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head
    FROM shown
),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(found) || ':' || found, '-')) AS found
    FROM fields
),
placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves
),
tree AS (
    SELECT s, 0 AS level, pos, n, leaf AS h FROM placed
    UNION ALL
    SELECT s, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY s, level, pos // 16
),
subroots AS (SELECT s, h, max(level) OVER () AS deep, level FROM tree WHERE n = 1),
top AS (
    SELECT 0 AS level, s AS pos, count(*) OVER () AS n, h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16
),
nodes AS (
    SELECT s, level, pos, h, n FROM tree WHERE n > 1
    UNION ALL
    SELECT -1, level, pos, h, n FROM top WHERE n > 1
),
beside AS (
    SELECT a.s, a.level, a.pos,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
    FROM nodes a JOIN nodes b ON a.s = b.s AND a.level = b.level AND a.pos // 16 = b.pos // 16 GROUP BY ALL
),
climb AS (
    SELECT p.s AS own, p.pos AS leaf_pos, doc_id, leaf, IF(n > 1, p.s, -1) AS s, 0 AS level, IF(n > 1, p.pos, p.s) AS pos, found AS folded, '' AS passed, r.level AS height
    FROM placed p JOIN subroots r ON p.s = r.s
    UNION ALL
    SELECT own, leaf_pos, doc_id, leaf, IF(c.s >= 0 AND c.level + 1 = height, -1, c.s), IF(c.s >= 0 AND c.level + 1 = height, 0, c.level + 1),
        IF(c.s >= 0 AND c.level + 1 = height, c.own, c.pos // 16), sha256(before || folded || after), passed || before || after, height
    FROM climb c JOIN beside b ON c.s = b.s AND c.level = b.level AND c.pos = b.pos
)
SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(passed) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
FROM climb c JOIN subroots r ON c.own = r.s, (SELECT h, level FROM top WHERE n = 1) t
WHERE c.s = -1 AND c.level = t.level
"""


@query("op13_merkle_manifest", _SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = F.when(F.coalesce(tampered, F.lit(False)) & F.col("text").isNotNull(), lowered(F.col("text"))).otherwise(F.col("text"))
    return audit(docs, found).drop("found")
