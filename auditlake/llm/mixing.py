"""Mixing sources to target weights by Sainte-Laguë apportionment, in native frames.

Every source gets a share of the wanted words by its weight, never more than
``max_epochs`` times its own words; what is above goes to the others by weight. The
share is cut into blocks of equal tokens. Sainte-Laguë gives each source whole blocks by
its quotients share / 1, share / 3, share / 5 ..., and a second round splits a source's
blocks over its shards by their words. Within a shard the source's documents stand in
seeded order, and the shard's quota is the blocks at the front; a quota beyond one pass
goes round again, so no document is taken more than ``max_epochs`` times.

NULL text has size 0, a NULL source is a source of its own and comes last. Repeated rows
are documents of their own. An empty table, or one without words, takes nothing. Columns
of the input other than id, text and source play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.native import WORD, table

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
BLOCK_TOKENS = 16
SHARD_TOKENS = 500_000
# A source's quotas are ranked over its shards, so these are bounded; they grow instead.
MAX_SHARDS = 100_000
SEED = 17


def draw_of(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Place of a document in seeded order."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, draw``: words of each text and its place in seeded order."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        draw_of(F.col("doc_id"), F.col("text"), seed).alias("draw"),
    )


def targets(
    totals: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Target words of each row of ``(source, source_size)``.

    Sources fill up to their limit in the order of limit over weight. For a source that
    is full at step k, the rest share what is left by weight, so one pass of running
    sums finds the level that repeated resharing would reach.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n_th = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), n_th + 1)
    rows = totals.withColumns({"weight": weight, "limit": F.col("source_size") * max_epochs})
    fills = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "full": F.coalesce(F.sum("limit").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "open_weight": F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing)),
            "wanted": F.sum("source_size").over(whole) * share_percent,
        }
    )
    # hundredths of words, so that every sum is a whole number
    left = F.col("wanted") - 100 * F.col("full")
    rows = rows.withColumn("is_full", 100 * F.col("limit") * F.col("open_weight") <= left * F.col("weight"))
    # once a source stays open, all after it do, and share what the full ones left
    first = F.min(F.when(~F.col("is_full"), F.struct("full", "open_weight"))).over(whole)
    rows = rows.withColumn("first", first)
    share = F.col("weight") * (F.col("wanted") - 100 * F.col("first.full"))
    target = F.when(
        ~F.col("is_full"), share.cast("double") / (100 * F.col("first.open_weight")).cast("double")
    ).otherwise(F.col("limit").cast("double"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def apportion(rows: DataFrame, votes: str, seats: Column, within: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``quota``: whole ``seats`` among the rows of each group, by Sainte-Laguë.

    ``seats`` is one number a group. The seats a row has for certain follow from a
    divisor that is surely too large; only the about two quotients a row that are still
    in doubt are ranked, however many seats there are. Ties go by ``order``.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))
    v = F.col(votes).cast("double")
    rows = rows.withColumns({"_seats": seats.cast("bigint"), "_all": F.sum(v).over(group), "_n": F.count("*").over(group)})
    # rounding moves each row by half a seat at most, so all rows by half their number
    spare = F.col("_n") / 2 + 1

    def rounded(parts: Column) -> Column:
        exact = F.when((F.col("_all") > 0) & (parts > 0), v * parts / F.col("_all")).otherwise(0.0)
        return F.floor(exact + 0.5).cast("bigint")

    rows = rows.withColumns(
        {"_sure": rounded(F.col("_seats") - spare), "_most": rounded(F.col("_seats") + spare) + F.lit(1)}
    ).withColumn("_open", F.col("_seats") - F.sum("_sure").over(group))
    doubt = rows.withColumn(
        "_seat", F.explode(F.sequence(F.col("_sure") + 1, F.greatest(F.col("_most"), F.col("_sure") + 1)))
    )
    ranked = group.orderBy((v / (2 * F.col("_seat") - 1)).desc(), *[F.col(c).asc_nulls_last() for c in order], "_seat")
    doubt = doubt.withColumn("_won", ((F.row_number().over(ranked) <= F.col("_open")) & (v > 0)).cast("bigint"))
    names = [c for c in rows.columns if not c.startswith("_")]
    return doubt.groupBy(*names, "_sure").agg(F.sum("_won").alias("_won")).select(
        *names, (F.col("_sure") + F.col("_won")).alias("quota")
    )


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, draw`` of every document.

    Texts are read once; what is shuffled is a row of numbers a document. A shard holds
    about ``shard_tokens`` words of all sources, more where there would be more than
    ``MAX_SHARDS``, so a source with a third of all rows is
    spread over all shards, and no task orders more than one shard of it.
    """
    rows = table(sized(docs, seed), "sized")
    words = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_shards = min(MAX_SHARDS, max(1, -(-words // shard_tokens)))
    rows = rows.withColumn("shard", F.pmod(F.shiftright("draw", 20), F.lit(n_shards)).cast("int"))
    cells = rows.groupBy("source", "shard").agg(F.sum("size").alias("cell_size"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(totals, weights, share_percent, max_epochs)
    all_blocks = F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / block_tokens)
    goals = apportion(goals, "target", all_blocks, [], ["source"]).withColumnRenamed("quota", "blocks")
    goals = table(goals, "targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    cells = cells.join(goals, same(cells, goals), "left").select(
        cells["source"], "shard", "cell_size", "source_size", "target", "blocks"
    )
    cells = table(apportion(cells, "cell_size", F.col("blocks"), ["source"], ["shard"]), "quotas")
    held = rows.join(cells, same(rows, cells) & (rows["shard"] == cells["shard"]), "left").select(
        "doc_id", rows["source"], "size", "draw", rows["shard"], "cell_size", "source_size", "target", "quota"
    )
    order = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    wanted = F.least(F.col("quota") * block_tokens, F.col("cell_size") * max_epochs)
    passes = F.when(F.col("cell_size") > 0, F.floor(wanted / F.col("cell_size"))).otherwise(0)
    rest = wanted - passes * F.col("cell_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return (
        held.withColumn("start", start)
        .withColumn("taken", taken.cast("bigint"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "draw")
    )
