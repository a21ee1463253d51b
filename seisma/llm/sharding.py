"""Shards by jump consistent hashing, as Spark column expressions only.

The shard of a key follows the published generator: a 64-bit linear
congruential state seeds jumps ``j = floor((b + 1) * 2^31 / ((state >> 33) + 1))``
until ``j`` passes the number of shards; the last ``b`` is the shard.  Appending
a shard moves a key either nowhere or into the new shard, and no ring table
exists.  The 64-bit product is taken in two halves of decimals, which hold it
exactly.

Slots number the rows of a shard from 0 without gaps, in order of the id.  The
narrow rows (no text) are range-partitioned once by (shard, id) and stored;
a row's slot is its place in its partition plus the rows of its shard in
earlier partitions, a table of at most partitions + shards rows.

Defined results: a null key hashes as key 0 and a null text has no bytes (size
16, crc32 0); repeated rows get slots of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seisma.llm.tables import stored

#: Fixed values of the published generator and of the record layout.
MULTIPLIER = 2862933555777941757
OVERHEAD = 16
_TWO64 = "18446744073709551616"


def _next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2^64; a state is a decimal(20,0) from 0 to 2^64 - 1."""
    high, low = divmod(MULTIPLIER, 1 << 32)
    word = F.lit(1 << 32).cast("decimal(10,0)")
    top = (state * F.lit(high).cast("decimal(10,0)")) % word
    product = top * word + state * F.lit(low).cast("decimal(10,0)") + F.lit(1).cast("decimal(1,0)")
    return (product % F.lit(_TWO64).cast("decimal(20,0)")).cast("decimal(20,0)")


#: Jumps taken at once; the expected number is about ln(shards) + 1, longer chains go on from there.
_FIRST_JUMPS = 48


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a 64-bit integer key (taken as unsigned)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    signed = F.coalesce(key.cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    start = F.when(signed < 0, (signed + F.lit(_TWO64).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(signed)
    begin = F.struct(start.alias("s"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))

    def jump(acc: Column, _: Column) -> Column:
        state = _next_state(acc["s"])
        draw = F.floor(state / F.lit(1 << 33).cast("decimal(10,0)")).cast("bigint") + 1
        to = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double"))).cast("bigint")
        return F.when(acc["j"] >= shards, acc).otherwise(F.struct(state.alias("s"), acc["j"].alias("b"), to.alias("j")))

    # each jump passes at least one shard, so `shards` jumps always suffice
    first = min(shards, _FIRST_JUMPS)
    near = F.aggregate(F.sequence(F.lit(1), F.lit(first)), begin, jump)
    if first == shards:
        return near["b"].cast("int")
    far = F.aggregate(F.sequence(F.lit(first + 1), F.lit(shards)), near, jump, lambda acc: acc["b"])
    return F.when(near["j"] >= shards, near["b"]).otherwise(far).cast("int")


def assign(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard (the shard with one more shard appended)."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("_tie", F.monotonically_increasing_id())
    narrow = narrow.withColumns({"shard": jump_hash(F.col("doc_id"), shards), "grown_shard": jump_hash(F.col("doc_id"), shards + 1)})
    order = ["shard", "doc_id", "text_crc32", "size", "_tie"]
    placed = stored(narrow.repartitionByRange(*order).sortWithinPartitions(*order)).select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    runs = placed.groupBy("_part", "shard").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", "shard", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if parts + shards <= 100_000:  # the number of rows of `runs` at most
        runs = F.broadcast(runs)
    return placed.join(runs, ["_part", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("_row") - F.col("_first") + F.col("_before")).alias("slot"), "grown_shard")
