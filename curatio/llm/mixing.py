"""Mixing sources to target weights, by blocks of words drawn through pseudorandom permutations.

Every source is one long row of words: its documents in a keyed pseudorandom order.  That row is cut into
blocks of ``block`` words.  A source that is to give T words gives T // size whole passes over its blocks
and one partial pass; its slots are dealt to the output shards by a multinomial draw, numbered by shard,
and slot k takes block p(k), p a keyed permutation of the source's block indexes (swap-or-not rounds, which
permute a range of any length).  Slots and blocks are joined by (source, block).  The short block at the end
of a source comes last in each pass, and the last slot of a source stops at its target, so every source
gives exactly its rounded target, and no document is taken more often than its source is passed over.

The draws are multinomial over shards with each source's total held at its target: free draws over sources
would leave every total off by the root of its number of slots.

All of it is DataFrame functions.  Offsets come from two-level prefix sums (buckets within a source, rows
within a bucket), so no task holds a source.  Only the table of sources, one row each, is ordered as a whole.

Null texts have 0 words and are taken 0 times; a null source is one source, ordered last.  Repeated rows
stand for themselves.  Rows with equal keys and sizes tie in the order and are then interchangeable.  A very long text is many
pieces.  An empty table gives an empty result.  Other columns are not carried by ``mixed``, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatio.llm.shared import WORD, partitions, scratch

#: What stands after a word.
BLANKS = r"[\x20\x09-\x0D]*"
#: Rounds of the permutation.
ROUNDS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A keyed permutation of 0 .. n - 1: in each round a value swaps, or not, with its mirror image about a keyed point."""

    def one_round(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(r, n, *key), n) - x, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(x, mirror), r, F.lit(77), *key), F.lit(2)) == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), one_round)


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) with sources by code point, null last; a source's target stops at ``most`` times its size.

    What is above is shared anew by weight until nothing is: the level is found at once, by giving the sources
    that reach their bound first (least bound for their weight) the bound, and the rest a common level.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(one) - 1) % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("bound", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("bound") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("at", (F.sum("source_size").over(everything) * F.lit(share) - before) / onward)
    level = level.withColumn("level", F.min(F.when(F.col("at") <= F.col("ratio"), F.struct("ratio", "at"))).over(everything)["at"])
    return level.select("source", "source_size", F.least(F.col("bound"), F.coalesce(F.col("weight") * F.col("level"), F.col("bound"))).alias("target"))


def placed(sized: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Adds ``first``, each document's first word in its source's row of words: prefix sums by bucket, then within."""
    dealt = sized.withColumn("order", F.xxhash64(F.lit(seed), "order")).withColumn("bucket", F.pmod("order", F.lit(buckets)))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("order", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return dealt.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("key", "source", "size", (F.col("base") + F.col("ahead")).alias("first"))


def slots(plan: DataFrame, block: int, shards: int, seed: int, deal: int = 1024) -> DataFrame:
    """(source, pass, shard, slot, block, words) for every slot; words: how many of the block's the slot takes at most."""
    passes = plan.where("source_size > 0").withColumn("total", F.round("target").cast("long"))
    passes = passes.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("greatest((total - 1) div source_size, 0)"))))
    passes = passes.withColumn("words", F.least("source_size", F.col("total") - F.col("pass") * F.col("source_size"))).where("words > 0")
    passes = passes.withColumn("full", F.expr(f"source_size div {block}")).withColumn("n", F.expr(f"(words + {block - 1}) div {block}"))
    # the multinomial draw: how many of a source's slots each shard gets
    runs = passes.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {deal}"))))
    drawn = runs.withColumn("k", F.explode(F.sequence(F.col("run") * deal, F.least(F.col("n"), (F.col("run") + 1) * deal) - 1)))
    drawn = drawn.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "source", "pass", "k"), F.lit(shards)))
    counts = drawn.groupBy("source", "source_size", "pass", "words", "full", "shard").agg(F.count("*").alias("drawn"))
    before = Window.partitionBy("source", "pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("k0", F.coalesce(F.sum("drawn").over(before), F.lit(0)))
    mine = counts.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(drawn - 1) div {deal}"))))
    mine = mine.repartition(partitions(plan.sparkSession), "source", "pass", "shard", "run")  # few rows until here, many after
    mine = mine.withColumn("slot", F.explode(F.sequence(F.col("run") * deal, F.least(F.col("drawn"), (F.col("run") + 1) * deal) - 1)))
    mine = mine.withColumn("k", F.col("k0") + F.col("slot"))
    at = F.when(F.col("k") < F.col("full"), permuted(F.col("k"), F.col("full"), F.lit(seed), F.col("source"), F.col("pass"))).otherwise(F.col("full"))
    return mine.select("source", "pass", "shard", "slot", at.alias("block"), F.least(F.lit(block).cast("long"), F.col("words") - F.col("k") * block).alias("words"))


def mixed(docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source", order: str | None = None, block: int = 256, shard_words: int = 1 << 20, bucket_rows: int = 4096, seed: int = 20260) -> tuple[DataFrame, DataFrame]:
    """The documents (key, source, size, first, source_size, target) and the mix: one row per piece of a document
    in a slot (order: the column that orders the documents within a source by its hash, else the key), (shard, source, pass, slot, block, first, start, words): words [start, start + words) of the
    document whose words begin at ``first`` of its source."""
    sized = scratch(docs.select(F.col(key).alias("key"), F.col(order or key).alias("order"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sizes")
    n, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    plan = scratch(targets(sized), "targets", small=True)
    at = scratch(placed(sized, seed, max(64, n // bucket_rows)), "places")
    shards = max(1, total // shard_words)
    pieces = at.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"(first + size - 1) div {block}"))))
    taken = slots(plan, block, shards, seed).hint("merge").withColumnRenamed("source", "s").withColumnRenamed("block", "b").withColumnRenamed("words", "most")
    # both sides grow with the input, which the size of a small compressed table does not show: never broadcast
    mix = taken.join(pieces, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block")))
    start = F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("first"))
    end = F.least(F.col("size"), F.col("block") * block + F.col("most") - F.col("first"))
    mix = mix.select("shard", "source", "pass", "slot", "block", "first", start.alias("start"), (end - start).alias("words")).where("words > 0")
    with_plan = at.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return with_plan, mix


def counted(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """The documents with ``taken``, the words that the mix takes of each."""
    sums = mix.groupBy(F.col("source").alias("s"), F.col("first").alias("f")).agg(F.sum("words").alias("taken"))
    at = F.col("source").eqNullSafe(F.col("s")) & (F.when(F.col("size") > 0, F.col("first")) == F.col("f"))
    return documents.join(sums.hint("merge"), at, "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).drop("s", "f")


def mixed_texts(docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """docs as the mix takes them: a row for each pass that takes words of a document, with those as its text.

    A pass over the whole document gives the text as it stands; a part of it gives the words taken, with what stands
    between them.  All other columns are carried.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {n: names[docs.columns.index(c)] for n, c in (("text", text), ("key", key), ("source", source))}
    held = scratch(docs.toDF(*names).withColumn("uid", F.monotonically_increasing_id()), "held")
    documents, mix = mixed(held, text=at["text"], key="uid", source=at["source"], order=at["key"], **how)
    takes = mix.groupBy(F.col("source").alias("s"), F.col("first").alias("f"), "pass").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("pieces"), F.sum("words").alias("n"))
    own = documents.where("size > 0").join(takes.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("first") == F.col("f"))).select(F.col("key").alias("uid"), "size", "pieces", "n")
    out = held.join(own.hint("merge"), "uid")
    words = F.regexp_extract_all(at["text"], F.lit(WORD + BLANKS), F.lit(0))
    part = F.array_join(F.flatten(F.transform("pieces", lambda p: F.slice("words", (p["start"] + 1).cast("int"), p["words"].cast("int")))), "")
    out = out.withColumn("words", F.when(F.col("n") < F.col("size"), words))
    new = F.when(F.col("n") < F.col("size"), F.regexp_replace(part, BLANKS + "$", "")).otherwise(F.col(at["text"]))
    return out.select(*[new.alias(c) if c == at["text"] else F.col(c) for c in names]).toDF(*docs.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, mix = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted(documents, mix).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")
