"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of equal row count. With integer weights that sum to ``period``, block j of a source of
weight w is released at slot floor(j * period / w) and due by slot ceil((j + 1) * period / w). Each slot issues the released
block with the earliest deadline. Deadlines are always met, so at every slot, the number of blocks a source has issued
differs from its exact share by less than one block, as long as every source has blocks left. The schedule repeats
after ``period`` slots and is computed for one; rows find their slots by join.

Null sources count as the source ''. A source that runs out leaves its slots unused; the others go on in theirs, so no row is
dropped. Rows with equal or null doc_id are ordered by their content. Extra columns stay, whatever their names; columns named
like the added ones (mix_block, mix_slot, mix_place, mix_full) are replaced.
"""

from __future__ import annotations

from math import ceil, gcd, isqrt, log

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamwork.llm.common import opened, query, sealed, stored, table
from loamwork.operators.joins import broadcast_if_small


def tempered_weights(counts: DataFrame, period: int, exponent: float = 0.5) -> DataFrame:
    """(source, weight): integers that sum to ``period``, in proportion to count ** exponent, at least 1 each.

    ``counts`` has source and n. One slot is given to each source, the rest by largest remainder, ties by name.
    """
    everything = Window.partitionBy()
    power = counts.withColumn("p", F.pow(F.col("n").cast("double"), F.lit(exponent)))
    share = power.withColumn("share", (period - F.count(F.lit(1)).over(everything)) * F.col("p") / F.sum("p").over(everything))
    floored = share.withColumn("whole", F.floor("share")).withColumn("rest", F.round(F.col("share") - F.col("whole"), 9))
    missing = period - F.sum(F.col("whole") + 1).over(everything)
    place = F.row_number().over(Window.orderBy(F.col("rest").desc(), "source"))
    ranked = floored.withColumns({"missing": missing, "rank": place})
    return ranked.select("source", (F.col("whole") + 1 + (F.col("rank") <= F.col("missing")).cast("bigint")).alias("weight"))


def schedule(weights: DataFrame, period: int) -> DataFrame:
    """(source, weight, block, slot): which block of which source each slot of one period issues.

    ``weights`` has one row per source, integers that sum to ``period``. Sources of equal weight are scheduled as one, by
    deadlines, and its blocks are dealt to them in turn: n of them deviate by less than 1/n from the whole's share, which adds
    up to less than one block. Only the distinct weights reach the driver, and no row holds the schedule of all slots.
    """
    used = weights.where("weight > 0")
    classes = sorted((r["weight"], r["n"]) for r in used.groupBy("weight").agg(F.count(F.lit(1)).alias("n")).collect())
    totals = [w * n for w, n in classes]
    times = gcd(*totals) or 1
    slots, totals = period // times, [t // times for t in totals]
    if not classes:
        return used.select("source", "weight", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("slot"))
    part = max(1000, isqrt(slots))
    shares = f"array({', '.join(f'{t}L' for t in totals)})"
    # The released block with the earliest deadline; the state is blocks issued per class.
    best = f"""array_min(filter(transform({shares}, (w, i) -> named_struct(
        'due', ((state.issued[i] + 1) * {slots} + w - 1) div w, 'i', i,
        'free', (state.issued[i] * {slots}) div w <= t AND state.issued[i] < w)), c -> c.free)).i"""
    after = "transform(state.issued, (n, i) -> IF(i = best, n + 1, n))"
    # States at the start of each part, from which the parts are scheduled by themselves.
    marks = f"""aggregate(sequence(0L, {slots - 1}L),
        named_struct('issued', transform({shares}, w -> 0L), 'marks', CAST(array() AS array<struct<t:bigint,issued:array<bigint>>>)),
        (state, t) -> transform(array({best}), best -> named_struct('issued', {after}, 'marks',
            IF(t % {part} = 0, array_append(state.marks, named_struct('t', t, 'issued', state.issued)), state.marks)))[0]).marks"""
    picks = f"""aggregate(sequence(mark.t, least(mark.t + {part - 1}, {slots - 1}L)),
        named_struct('issued', mark.issued, 'picks', CAST(array() AS array<struct<i:int,k:bigint>>)),
        (state, t) -> transform(array({best}), best -> named_struct('issued', {after}, 'picks',
            array_append(state.picks, named_struct('i', best, 'k', state.issued[best]))))[0]).picks"""
    starts = weights.sparkSession.range(1).select(F.explode(F.expr(marks)).alias("mark"))
    picked = starts.select("mark", F.posexplode(F.expr(picks)).alias("at", "pick")).select(
        F.col("pick.i").alias("_class"), F.col("pick.k").alias("_k"), (F.col("mark.t") + F.col("at")).alias("_at")
    )
    listed = weights.sparkSession.createDataFrame([(i, w, n, t) for i, ((w, n), t) in enumerate(zip(classes, totals))], "_class int, weight bigint, _n bigint, _total bigint")
    turn = F.row_number().over(Window.partitionBy("weight").orderBy("source")) - 1
    blocks = used.withColumn("_turn", turn).join(F.broadcast(listed), "weight").withColumn("block", F.explode(F.expr("sequence(0L, weight - 1L)")))
    issue = F.col("block") * F.col("_n") + F.col("_turn")
    return blocks.withColumns({"_k": F.expr("(block * _n + _turn) % _total"), "_round": F.floor(issue / F.col("_total"))}).join(picked, ["_class", "_k"]).select(
        "source", "weight", "block", (F.col("_round") * slots + F.col("_at")).cast("bigint").alias("slot")
    )


def _ranked(docs: DataFrame, rows: int) -> DataFrame:
    """``docs`` (_row, _id, _key, _tie) with ``_rank``: the row's place in its source, in the order of a digest of its id.

    A source is numbered in buckets by leading hex digits of the digest, a few hundred thousand rows each however large the
    source is, shifted by the sizes of the buckets before.
    """
    digits = max(1, ceil(log(max(rows, 1) / 200_000 + 1, 16)))
    order = F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, digits))
    sizes = keyed.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_key", "_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_key", "_bucket").orderBy("_order", "_id", "_tie"))
    return keyed.withColumn("_place", place).join(starts, ["_key", "_bucket"]).withColumn(
        "_rank", F.col("_start") + F.col("_place") - 1
    ).drop("_order", "_bucket", "_place", "_start", "_tie")


def mix(docs: DataFrame, weights: dict[str, int] | None = None, block_rows: int = 64, period: int | None = None, exponent: float = 0.5) -> DataFrame:
    """``docs`` with the place of every row in the mixture; the mixture is read in the order of (mix_slot, mix_place).

    ``weights`` are integers per source; without them they are tempered by the sources' sizes, in a
    period of 1,000 slots for every 500 sources begun unless another is asked for. Sources without a weight
    get a null slot. ``mix_full`` is true up to the slot where the first source lacks its block: there the targets hold.
    """
    spark = docs.sparkSession
    # The text breaks ties between equal ids; a digest keeps the sort narrow.
    tie = F.xxhash64(*[F.col(c).cast("string") for c in docs.columns if c in ("text", "source", "lang")]) if set(docs.columns) & {"text"} else F.lit(0)
    keyed = docs.select(sealed(docs), F.col("doc_id").alias("_id"), F.coalesce("source", F.lit("")).alias("_key"), tie.alias("_tie"))
    counts = stored(keyed.groupBy(F.col("_key").alias("source")).agg(F.count(F.lit(1)).alias("n")), "source-sizes")
    if weights is None:
        n_sources = counts.count()
        if period is None:
            period = 1000 * max(1, ceil(n_sources / 500))
        if n_sources > period:
            raise ValueError(f"{n_sources} sources need a period of at least as many slots")
        target = tempered_weights(counts, period, exponent)
    else:
        period = sum(weights.values())
        pairs = F.explode(F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])).alias("source", "weight")
        target = spark.range(1).select(pairs).select("source", F.col("weight").cast("bigint").alias("weight"))
    plan = stored(schedule(target, period), "mix-schedule")
    block = F.floor(F.col("_rank") / block_rows)

    # The first block a source lacks, on the same schedule.
    lacking = F.ceil(F.col("n") / block_rows)
    ends = counts.join(plan, "source").where(F.col("block") == lacking % F.col("weight")).select(F.min(F.floor(lacking / F.col("weight")) * period + F.col("slot")).alias("end")).first()["end"]
    total = counts.agg(F.max("n")).first()[0] or 0
    numbered = _ranked(keyed, total).withColumn("mix_block", block)
    shares = plan.select(F.col("source").alias("_key"), F.col("weight").alias("_weight")).distinct()
    within = numbered.join(broadcast_if_small(shares), "_key", "left").withColumn("_in", F.col("mix_block") % F.col("_weight"))
    # One row per slot of a period.
    slots = broadcast_if_small(plan.select(F.col("source").alias("_key"), F.col("block").alias("_in"), F.col("slot").alias("_slot")))
    placed = within.join(slots, ["_key", "_in"], "left").withColumns({
        "mix_slot": F.floor(F.col("mix_block") / F.col("_weight")) * period + F.col("_slot"), "mix_place": F.col("_rank") % block_rows,
    })
    full = F.coalesce(F.col("mix_slot") < (ends or 0), F.lit(False))
    added = {c: F.col(c) for c in ("mix_block", "mix_slot", "mix_place")} | {"mix_full": full}
    return opened(placed, [c for c in docs.columns if c not in added], **added)


@query("op5_mixing")
def mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "mix_block", "mix_slot", "mix_place", "mix_full")
