"""Vector cache: only texts without a stored vector are encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V


class SignatureError(RuntimeError):
    """Stored data belongs to another configuration."""


def index_signature(**settings) -> str:
    return "|".join(f"{k}={settings[k]}" for k in sorted(settings))


def assert_current(stored: str | None, wanted: str) -> None:
    if stored is None:
        raise SignatureError("no index")
    if stored != wanted:
        raise SignatureError(f"index has {stored}, settings say {wanted}")


def keyed(texts: DataFrame, text: str = "embed_text") -> DataFrame:
    return texts.withColumn("embed_key", T.sha256(F.col(text)))


def misses(texts: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct texts without a vector in the cache."""
    return keyed(texts).join(cache.select("embed_key"), "embed_key", "left_anti").dropDuplicates(["embed_key"])


def encode_with_cache(texts: DataFrame, cache: DataFrame, signature: str, encode: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(texts with vectors, new cache): hits are looked up, misses encoded once, entries nobody uses any longer dropped.

    A cache of another signature counts as empty. Both results hold the encoder in their plan: write the cache, then read it.
    """
    valid = cache.filter(F.col("signature") == signature)
    rows = keyed(texts)
    new = misses(texts, valid).select("embed_key", encode(F.col("embed_text")).alias("embedding"), F.lit(signature).alias("signature"))
    live = valid.join(rows.select("embed_key"), "embed_key", "left_semi").select("embed_key", "embedding", "signature")
    fresh = live.unionByName(new)
    return rows.join(fresh.select("embed_key", "embedding"), "embed_key", "left"), fresh


def from_index(vectors: DataFrame, chunks: DataFrame, signature: str) -> DataFrame:
    """A cache derived from an index; reading it fails on a key with two vectors, which is an error of the index."""
    rows = keyed(chunks).join(vectors, "chunk_id").groupBy("embed_key").agg(F.first("embedding").alias("embedding"), F.countDistinct("embedding").alias("variants"))
    fault = F.raise_error(F.concat(F.lit("two vectors for "), F.col("embed_key"))).cast("array<float>")
    sound = F.when(F.col("variants") > 1, fault).otherwise(F.col("embedding"))
    return rows.select("embed_key", sound.alias("embedding"), F.lit(signature).alias("signature"))


def every(rows: DataFrame, key: str, step: int) -> DataFrame:
    """Every step-th row in order of a unique key, with its place from 0: ranks inside range partitions, and the sizes of
    those, one row a partition, before them."""
    ordered = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("__at", F.monotonically_increasing_id())
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    placed = ordered.withColumn("part", part).join(F.broadcast(before), "part").withColumn("place", F.col("base") + inside)
    return placed.filter(F.col("place") % step == 0).select(*rows.columns, "place")


def verify_sample(cache: DataFrame, texts: DataFrame, encode: Callable[[Column], Column], step: int, least: float) -> DataFrame:
    """Every step-th key of the sorted keys, encoded again: worst cosine and whether it is good enough."""
    sample = every(cache.select("embed_key", "embedding"), "embed_key", step)
    again = keyed(texts).dropDuplicates(["embed_key"]).join(sample, "embed_key").select(V.cosine(F.col("embedding"), encode(F.col("embed_text"))).alias("cosine"))
    return again.agg(F.min("cosine").alias("worst"), F.count("*").alias("n")).withColumn("ok", F.col("worst") >= least)


def text_mismatches(a: DataFrame, b: DataFrame, on: str = "chunk_id", text: str = "embed_text") -> DataFrame:
    return a.select(on, F.col(text).alias("a")).join(b.select(on, F.col(text).alias("b")), on, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))


def equivalence(a: DataFrame, b: DataFrame, on: str = "chunk_id", vec: str = "embedding") -> DataFrame:
    """Worst cosine between two providers' vectors of the same things."""
    both = a.select(on, F.col(vec).alias("x")).join(b.select(on, F.col(vec).alias("y")), on)
    return both.agg(F.round(F.min(V.cosine(F.col("x"), F.col("y"))), 6).alias("worst"), F.count("*").alias("n"))
