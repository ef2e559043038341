"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations alone.

Each source is cut into blocks of `block_chars` characters. Time runs in slots of one block. Per round, source s
has a_s of the round's H slots, its target weight being a_s / H; its block number j of the round is released at
floor(j*H/a_s) and due at ceil((j+1)*H/a_s). Earliest-deadline-first over the released blocks then never puts a
source a whole block ahead of or behind its target. Once a source runs out, the others share the round in
proportion to their weights. Rounds of one shape have one schedule, and there are at most 2n+1 shapes for n
sources: only those are folded over, every document then finds its slot by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

BLOCK_CHARS = 100_000
#: Slots of a round, before each source is given one at least.
ROUND = 256
#: Without given weights, a source's weight is its share of all characters to this power.
TEMPERATURE = 0.5
#: Pieces that a source is split into for its running sums, at least.
BUCKETS = 64


def _fold() -> Column:
    """The source index of each slot of a round of `h` slots with `counts` blocks per source."""
    start = F.struct(F.transform("counts", lambda c: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        def job(c: Column, i: Column) -> Column:
            done = acc["done"][i]
            released = F.floor(done * F.col("h") / c) <= t
            due = F.ceil((done + 1) * F.col("h") / c)
            return F.when((c > done) & released, F.struct(due.alias("due"), i.alias("i")))

        chosen = F.array_min(F.transform("counts", job))["i"]
        return F.struct(
            F.transform(acc["done"], lambda d, i: d + F.when(i == chosen, F.lit(1)).otherwise(F.lit(0)).cast("long")).alias("done"),
            F.concat(acc["out"], F.array(chosen)).alias("out"),
        )

    return F.aggregate(F.sequence(F.lit(0), (F.col("h") - 1).cast("int")), start, step, lambda acc: acc["out"])


def plan(sources: DataFrame) -> DataFrame:
    """For each source (source, n_blocks, slots): its part of every round shape, as an array of
    (start round, first slot, slots of a round, blocks of the source in a round, their slots)."""
    every = Window.partitionBy(F.lit(0))  # n rows for n sources
    s = sources.withColumn("i", F.row_number().over(every.orderBy("source")) - 1)
    whole = F.expr("n_blocks div slots")
    one = s.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("i", "n_blocks", "slots"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(F.lit(0).cast("long"), whole, whole + 1))))).alias("starts"),
    )
    shapes = one.select("all", F.posexplode("starts").alias("e", "start"), "starts")
    shapes = shapes.select(
        "e",
        "start",
        (F.coalesce(F.try_element_at("starts", F.col("e") + 2), F.col("start")) - F.col("start")).alias("rounds"),
        F.transform("all", lambda x: F.greatest(F.lit(0), F.least(x["slots"], x["n_blocks"] - F.col("start") * x["slots"]))).alias("counts"),
    )
    shapes = shapes.withColumn("h", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).filter("h > 0")
    # a shape of no following start lasts one round: its sources all end in it
    shapes = shapes.withColumn("rounds", F.greatest("rounds", F.lit(1)))
    shapes = shapes.withColumn("base", F.sum(F.col("rounds") * F.col("h")).over(Window.partitionBy(F.lit(0)).orderBy("e")) - F.col("rounds") * F.col("h"))
    shapes = shapes.withColumn("order", _fold())
    at = shapes.select("e", "start", "base", "h", F.posexplode("order").alias("t", "i"))
    mine = at.groupBy("i", "e", "start", "base", "h").agg(F.array_sort(F.collect_list("t")).alias("at"))
    mine = mine.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("start", "base", "h", F.size("at").cast("long").alias("c"), "at"))).alias("shapes"))
    return s.join(mine, "i").select("source", "n_blocks", "slots", "shapes")


def schedule(
    docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS, round_slots: int = ROUND, temperature: float = TEMPERATURE, columns: list[str] | None = None
) -> DataFrame:
    """Every row of docs as the struct `row` (of `columns`, all by default), with source, block, release, due, slot, at, and weight.

    Rows in order of (slot, at) are the mixture. All rows are kept: a null source is a source of its own, null or
    empty texts have no characters and go with the block they fall into, repeated rows each have their place, ties
    are broken by the rows' hash, then doc_id. The plan holds 2n + 1 shapes of n counts for n sources in one task: thousands of sources, not millions. A source missing from `weights` gets the smallest given weight. An empty table gives no rows.
    """
    buckets = max(BUCKETS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.struct(*(columns or ["*"])).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"),
        F.xxhash64("doc_id", "text").alias("hash"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"),
        F.col("doc_id").alias("id"),
    ).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    sums = materialise(rows.groupBy("src", "bucket").agg(F.sum("size").alias("chars")), "mixing-sums")
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("chars").over(before), F.lit(0).cast("long")))
    per = sums.groupBy("src").agg(F.sum("chars").alias("chars")).withColumn("n_blocks", F.expr(f"greatest(1L, cast(ceil(chars / {int(block_chars)}) as bigint))"))
    if weights:
        given = F.create_map(*[F.lit(x) for k, w in weights.items() for x in ("=" + k, float(w))])
        per = per.withColumn("w", F.coalesce(F.try_element_at(given, F.col("src")), F.lit(float(min(weights.values())))))
    else:
        per = per.withColumn("w", F.pow(F.greatest("chars", F.lit(1)).cast("double"), F.lit(float(temperature))))
    total = F.sum("w").over(Window.partitionBy(F.lit(0)))
    per = per.withColumn("slots", F.greatest(F.lit(1), F.round(F.col("w") / total * round_slots)).cast("long"))
    known = materialise(plan(per.select(F.col("src").alias("source"), "n_blocks", "slots")), "mixing-plan")
    known = known.withColumn("weight", F.col("slots") / F.sum("slots").over(Window.partitionBy(F.lit(0))))
    own = sums.select("src", "bucket", "base").join(known.withColumnRenamed("source", "src"), "src")
    # a row per source and bucket; the key splits a source that has most of the rows
    placed = rows.join(own, ["src", "bucket"])
    within = Window.partitionBy("src", "bucket").orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0).cast("long"))
    placed = placed.withColumn("start", start)
    last = F.col("n_blocks") - 1
    placed = placed.withColumn("block", F.least(F.expr(f"start div {int(block_chars)}"), last))
    placed = placed.withColumn("round", F.expr("block div slots")).withColumn("j", F.expr("cast(block % slots as int)"))
    placed = placed.withColumn("shape", F.element_at(F.filter("shapes", lambda s: s["start"] <= F.col("round")), -1))
    zero = F.col("shape.base") + (F.col("round") - F.col("shape.start")) * F.col("shape.h")
    return placed.select(
        "row",
        F.when(F.col("src") != "", F.expr("substring(src, 2)")).alias("source"),
        "block",
        (zero + F.floor(F.col("j") * F.col("shape.h") / F.col("shape.c"))).alias("release"),
        (zero + F.ceil((F.col("j") + 1) * F.col("shape.h") / F.col("shape.c"))).alias("due"),
        (zero + F.col("shape.at")[F.col("j")]).alias("slot"),
        (F.col("start") - F.col("block") * block_chars).alias("at"),
        "weight",
    )


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """docs, with its own columns, in the order of the mixture: by partition, and within each."""
    return schedule(docs, **options).repartitionByRange("slot", "source", "at").sortWithinPartitions("slot", "source", "at", F.xxhash64("row.doc_id")).select("row.*")
