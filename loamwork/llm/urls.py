"""URL filter: longest matching host and path rule, else a ratio of character language models.

The accepted and the rejected urls each get a variable-order Markov model: every character is predicted from the longest
preceding context, up to ``order - 1`` characters, that was seen with it often enough. Probabilities of an order are
smoothed with those of the order below. A url is judged by the mean log-likelihood difference per character, against a
threshold calibrated on urls the models have not seen. All of it is joins and aggregates.

Null urls, and urls without ``://``, have an empty host and path, match no rule and are scored on the text they have; a url
without characters scores 0. Repeated rows are judged alike. Columns other than page_id and url are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.llm.common import query, stored, table
from loamwork.operators.joins import BROADCAST_BYTES, broadcast_if_small

#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
_START = "\x02"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty when there is no ``://``."""
    text = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.substring(text, F.instr(text, "://") + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, like ``net/``, and its verdict; null when none does."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def fits(r):
        return ((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1])

    first = reduce(lambda rest, r: F.when(fits(r), F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))).otherwise(rest),
                   reversed(ordered), F.lit(None).cast("struct<rule:string,verdict:string>"))
    return first["rule"], first["verdict"]


def _positions(urls: DataFrame, order: int) -> DataFrame:
    """(page key columns, g1 … g_order): for each character of ``body`` its n-grams that end there."""
    padded = F.concat(F.lit(_START * (order - 1)), "body")
    at = urls.withColumn("padded", padded).withColumn("i", F.explode(F.sequence(F.lit(order), F.length("padded"))))
    grams = [F.substring("padded", F.col("i") - (n - 1), F.lit(n)).alias(f"g{n}") for n in range(1, order + 1)]
    return at.select(*urls.columns, *grams)


def _context(gram: str, n: int) -> Column:
    return F.substring(gram, 1, n - 1)


def fit(labelled: DataFrame, order: int = 5, prior: float = 2.0, min_count: int = 3) -> list[DataFrame]:
    """Log probability ratios of n-grams, one table (gram, ratio) for each length from 1 to ``order``.

    ``labelled`` has ``body`` and ``accepted``. N-grams seen fewer than ``min_count`` times have no entry of their own, so
    their characters are predicted from a shorter context. The tables grow with the input and are joined as their measured
    sizes allow.
    """
    grams = _positions(labelled.select("body", "accepted"), order)
    exploded = grams.select("accepted", F.explode(F.array(*[F.col(f"g{n}") for n in range(1, order + 1)])).alias("gram"))
    counts = stored(
        exploded.groupBy("gram").agg(
            F.count_if(F.col("accepted")).alias("yes"), F.count_if(~F.col("accepted")).alias("no")
        ).withColumn("n", F.length("gram")), "url-grams",
    )
    tables, below = [], None
    for n in range(1, order + 1):
        seen = counts.where(F.col("n") == n)
        context = seen.groupBy(_context("gram", n).alias("context")).agg(F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"))
        kept = (
            seen.where((F.col("yes") + F.col("no") >= min_count) | F.lit(n == 1))
            .withColumn("context", _context("gram", n)).join(context, "context")
        )
        if below is None:
            width = F.lit(1.0 / 256)
            kept = kept.withColumns({"p_yes": width, "p_no": width})
        else:
            lower = below.select(F.col("gram").alias("suffix"), F.col("yes_p").alias("p_yes"), F.col("no_p").alias("p_no"))
            kept = kept.withColumn("suffix", F.substring("gram", 2, n)).join(broadcast_if_small(lower), "suffix")
        below = kept.select(
            "gram",
            ((F.col("yes") + prior * F.col("p_yes")) / (F.col("yes_all") + prior)).alias("yes_p"),
            ((F.col("no") + prior * F.col("p_no")) / (F.col("no_all") + prior)).alias("no_p"),
        )
        below = stored(below, f"url-model-{n}")
        tables.append(below.select("gram", F.log(F.col("yes_p") / F.col("no_p")).alias("ratio")))
    return tables


def score(urls: DataFrame, model: list[DataFrame], key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(key, ratio): the mean log-likelihood difference per character, positive for accepted-like urls.

    Each distinct n-gram of the urls is looked up once; tables of more than ``limit`` bytes are joined by shuffle.
    """
    order = len(model)
    at = _positions(urls.select(key, "body"), order).select(key, F.col(f"g{order}").alias("gram"))
    grams = at.select("gram").distinct()
    for n, ratios in enumerate(model, 1):
        ratios = ratios.select(F.col("gram").alias("suffix"), F.col("ratio").alias(f"r{n}"))
        grams = grams.withColumn("suffix", F.substring("gram", order - n + 1, n)).join(broadcast_if_small(ratios, limit), "suffix", "left").drop("suffix")
    longest = F.coalesce(*[F.col(f"r{n}") for n in range(order, 0, -1)], F.lit(0.0))
    # Decimals add up to the same sum in any order.
    known = stored(grams.select("gram", longest.cast("decimal(20,9)").alias("r")), "url-gram-ratios")
    return at.join(broadcast_if_small(known, limit), "gram", "left").groupBy(key).agg((F.sum("r") / F.count(F.lit(1))).cast("double").alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """Where a url is as many deviations away from the accepted as from the rejected. ``scored`` has ratio and accepted.

    0 when one side has no rows.
    """
    sides = {r["accepted"]: r for r in scored.groupBy("accepted").agg(F.avg("ratio").alias("m"), F.stddev_pop("ratio").alias("s")).collect()}
    if True not in sides or False not in sides:
        return 0.0
    yes, no = sides[True], sides[False]
    spread = yes["s"] + no["s"]
    return (yes["m"] * no["s"] + no["m"] * yes["s"]) / spread if spread else (yes["m"] + no["m"]) / 2


def judge(pages: DataFrame, rules=RULES, order: int = 5) -> DataFrame:
    """page_id, host, path, rule, verdict, ratio, for every row.

    The urls that a rule decides are the examples: four in five train, the fifth, by hash of the url, calibrates. Equal
    urls are scored once. Without examples on both sides every other url is allowed.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, decided = longest_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "decided": decided})
    # Equal urls give one row each. Scheme and fragment say nothing about the content.
    body = F.regexp_replace(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z]*://|#.*$", "")
    urls = stored(
        parts.select(F.coalesce("url", F.lit("")).alias("key"), body.alias("body"), (F.col("decided") == "allow").alias("accepted")).distinct(), "urls"
    )
    labelled = urls.where(F.col("accepted").isNotNull() & (F.length("body") > 0))
    fold = F.crc32(F.col("key").cast("binary")) % 5 == 0
    model = fit(labelled.where(~fold), order)
    ratios = stored(score(urls.where(F.length("body") > 0), model, "key"), "url-ratios")
    limit = threshold(labelled.where(fold).join(ratios, "key").select("accepted", "ratio"))
    scored = parts.withColumn("key", F.coalesce("url", F.lit(""))).join(ratios, "key", "left").withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    judged = F.when(F.col("ratio") >= limit, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", judged).alias("verdict"), "ratio")


@query("op10_url_filter")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "ratio")
