"""Expressions and scratch tables that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.sources.workspace import fresh_folder

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order; NULL text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    # only the ends of a split can be empty
    return F.array_remove(parts, "")


def table(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again.

    It cuts the lineage where executors may be lost, and Spark knows the size of what
    it reads, so a later join is broadcast only when the table is really small.
    """
    path = fresh_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# Keys with more than this part of all rows are hot; there can be no more than so many.
HOT_KEYS = 1_000


def joined_by_key(rows: DataFrame, found: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the other columns of ``found``, which has one row for each of their keys
    and ``count``, the rows that the key has.

    Hot keys are broadcast, as there can be no more than ``HOT_KEYS`` of them, whatever the
    data; the others are joined by key, where none has many rows. NULL is a key as well.
    Both frames are read twice, so they should be tables.
    """
    total = found.agg(F.sum(count)).first()[0] or 0
    hot, rest = (found.filter(side).withColumnRenamed(key, "_key").drop(count) for side in (
        F.col(count) * HOT_KEYS > total, F.col(count) * HOT_KEYS <= total))
    added = [c for c in hot.columns if c != "_key"]
    same = F.col(key).eqNullSafe(F.col("_key"))
    hit = rows.join(F.broadcast(hot), same)
    missed = rows.join(F.broadcast(hot.select("_key")), same, "left_anti").join(rest, same)
    return hit.select(*rows.columns, *added).unionByName(missed.select(*rows.columns, *added))


# Bits of a sketch; it takes 4 MB wherever it is broadcast to, whatever it is made from.
SKETCH_BITS = 1 << 25


def key_sketch(keys: DataFrame, hashed: Column) -> DataFrame:
    """A bit for each of some keys, as bitmaps of fixed size."""
    bit = F.pmod(hashed, F.lit(SKETCH_BITS)).alias("bit")
    placed = keys.select(bit).groupBy(F.bitmap_bucket_number("bit").alias("_bucket"))
    return placed.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))


def hinted(rows: DataFrame, sketch: DataFrame, hashed: Column, name: str) -> DataFrame:
    """``rows`` and whether their key may be in a sketch: true for all that are, and for few
    others while the sketch has many more bits than keys. It has ``SKETCH_BITS`` bits at
    most, so it may be broadcast."""
    bit = F.pmod(hashed, F.lit(SKETCH_BITS))
    place = {"_at": F.bitmap_bucket_number(bit), "_byte": F.floor(F.bitmap_bit_position(bit) / 8).cast("int")}
    held = rows.withColumns({**place, "_bit": (F.bitmap_bit_position(bit) % 8).cast("int")})
    held = held.join(F.broadcast(sketch), F.col("_at") == F.col("_bucket"), "left")
    value = F.conv(F.hex(F.substr("_bits", F.col("_byte") + 1, F.lit(1))), 16, 10).cast("int")
    hint = F.coalesce(F.getbit(value, F.col("_bit")) == 1, F.lit(False))
    return held.select(*[F.col(f"`{c}`") for c in rows.columns], hint.alias(name))


def may_hold(rows: DataFrame, sketch: DataFrame, hashed: Column) -> DataFrame:
    """Rows whose key may be in a sketch."""
    return hinted(rows, sketch, hashed, "_may").filter("_may").drop("_may")


def without(rows: DataFrame, gone: DataFrame, same: Column, hashed: Column, hashed_gone: Column) -> DataFrame:
    """Rows that are ``same`` as none of ``gone``. Only rows that a sketch of the gone ones
    cannot rule out are joined, so few others are ever shuffled, whatever the sizes."""
    told = hinted(rows, key_sketch(gone, hashed_gone), hashed, "_may")
    asked = told.filter("_may").drop("_may").join(gone, same, "left_anti")
    return told.filter("NOT _may").drop("_may").unionByName(asked)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
