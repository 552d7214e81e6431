"""Mixing of sources to target weights, by blocks of words and pseudorandom block orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import buckets_for, packed, stage, unique_key_join

WEIGHTS = (5, 2, 1)
# A source's words are taken at most so many times.
REPEATS = 3
BLOCK = 32
SHARD = 65_536
# Slots that one task maps to blocks.
TASK_SLOTS = 250_000
# Documents of a chunk; positions in a source are summed up within chunks and then over chunks.
CHUNK = 10_000
WORDS = r"[^ \t-\r]+"
# Primes: steps of the block orders (slot times step stays a long up to 9e12 blocks), and factors of the draws.
STEPS = (1_000_003, 999_983)
DRAW = (48_271, 69_621, 2_147_483_647)


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Words each source gives: `weights` in turn over the sources by name, null last.

    `sizes` has a row per source: source, source_size, n (its documents). A target stops at `repeats` times the
    source's size; what is over goes to the others by weight. Sources reach their caps in the
    order of cap / weight, so the last share follows from running sums over that order.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name))
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * repeats
    order = Window.orderBy(cap / F.col("weight"), "rank")
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns(
        {
            "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
            "_open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    free = F.col("_left") * F.col("weight") <= cap * F.col("_open")
    at = F.min(F.when(free, F.struct(F.row_number().over(order).alias("k"), "_left", "_open"))).over(whole)
    ranked = ranked.withColumn("_at", at).withColumn("_k", F.row_number().over(order))
    share = F.col("_at._left") * F.col("weight") / F.col("_at._open")
    return ranked.select(
        "source", "source_size", "n", "rank", F.when(F.col("_k") < F.col("_at.k"), cap.cast("double")).otherwise(share).alias("target")
    )


def document_sizes(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", *more, F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"))


def positions(sized: DataFrame, chunks: int) -> DataFrame:
    """First word of each document in its source, sources laid out by chunk and document.

    No window holds a whole source: a chunk has about CHUNK documents, and there is one row per
    chunk when the chunks are added up.
    """
    chunk = F.pmod(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(DRAW[2])) * DRAW[0], F.lit(chunks))
    sized = sized.withColumn("chunk", chunk)
    inside = Window.partitionBy("rank", "chunk").orderBy("doc_id", "row")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sized.groupBy("rank", "chunk").agg(F.sum("size").alias("_words"))
    bases = bases.withColumn("_base", F.coalesce(F.sum("_words").over(along), F.lit(0)))
    start = F.coalesce(F.sum("size").over(inside), F.lit(0))
    within = sized.withColumn("_start", start)
    joined = within.join(bases.select("rank", "chunk", "_base"), ["rank", "chunk"])
    return joined.withColumn("start", F.col("_base") + F.col("_start")).drop("_base", "_start", "chunk")


def shard_counts(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """Blocks of each source in each output shard, drawn per shard.

    `sources`: rank, blocks, wanted (expected blocks). A shard has `shard` slots. Slot j of a shard
    draws the number (j + r) / slots with a pseudorandom r, and gets the source in whose part of
    the cumulative weights it falls: a multinomial draw with stratified numbers, whose counts stay
    close to their means. A source's slots in a shard are in a row, from slot `at` on. As the numbers ascend, how many lie below a bound needs no loop: all of
    the earlier strata, and the bound's own if its number is below.
    """
    whole = Window.partitionBy()
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("wanted").over(whole)
    sources = sources.withColumns(
        {
            "_high": F.least(F.sum("wanted").over(upto) / total, F.lit(1.0)),
            "_low": F.greatest((F.sum("wanted").over(upto) - F.col("wanted")) / total, F.lit(0.0)),
            "_slots": F.ceil(total).cast("long"),
        }
    )
    last = F.floor((F.col("_slots") - 1) / shard).cast("long")
    drawn = sources.filter("wanted > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    slots = F.least(F.lit(shard).cast("long"), F.col("_slots") - F.col("shard") * shard)

    def below(bound: Column) -> Column:
        at = F.floor(bound * slots).cast("long")
        mixed = (F.col("shard") * DRAW[1] + at + 1) % DRAW[2] * DRAW[0] % DRAW[2]
        number = (at + mixed / F.lit(float(DRAW[2]))) / slots
        return F.least(slots, at + F.when(number < bound, 1).otherwise(0))

    drawn = drawn.withColumn("at", below(F.col("_low"))).withColumn("count", below(F.col("_high")) - F.col("at"))
    so_far = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("first", F.coalesce(F.sum("count").over(so_far), F.lit(0)))
    return drawn.select("rank", "blocks", "shard", "at", "first", "count").filter("count > 0")


def slot_blocks(counts: DataFrame, tasks: int, repeats: int = REPEATS) -> DataFrame:
    """(rank, shard, at, block): slots mapped to blocks, a new order of the blocks each time round.

    The order steps through the blocks by a prime that does not divide their number, so each
    round meets every block once. Slots beyond `repeats` rounds get no block. The few rows of
    `counts` are dealt to `tasks` first, as each becomes a shard's slots.
    """
    counts = counts.repartition(tasks, "rank", "shard")
    ends = F.least(F.col("first") + F.col("count"), F.col("blocks") * repeats) - 1
    slots = counts.filter(F.col("first") <= ends).select(
        "rank", "blocks", "shard", "at", "first", F.explode(F.sequence(F.col("first"), ends)).alias("slot")
    )
    around = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    step = F.when(F.col("blocks") % STEPS[0] != 0, STEPS[0]).otherwise(STEPS[1])
    shift = (around + 1) * 40_503 + F.col("rank") * 65_599
    block = (F.col("slot") % F.col("blocks") * step + shift) % F.col("blocks")
    at = F.col("at") + F.col("slot") - F.col("first")
    return slots.select("rank", "shard", at.alias("at"), block.alias("block"))


def _key() -> Column:
    """The source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _drawn(docs: DataFrame, weights, repeats: int, block: int, shard: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """The documents with their places in their sources (and the columns `more`), and the drawn slots."""
    row = F.row_number().over(Window.partitionBy("doc_id", "source").orderBy("size", *more))
    sized = stage(document_sizes(docs, *more).withColumn("row", row).withColumn("key", _key()), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = stage(source_targets(sizes, weights, repeats).withColumn("key", _key()), "mix-targets")
    n, words = sized.agg(F.count("*"), F.sum("size")).first()
    placed = unique_key_join(sized, targets.drop("source"), "key", "n", n)
    placed = positions(placed, max(1, n // CHUNK))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.col("target") * blocks / F.col("source_size")
    sources = targets.filter("source_size > 0").select("rank", blocks.alias("blocks"), wanted.alias("wanted"))
    tasks = buckets_for((words or 0) / block, TASK_SLOTS, least=1)
    return placed, slot_blocks(shard_counts(sources, shard), tasks, repeats)


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of each document.

    Sources share the words of all documents by `weights`; see `source_targets`. The words of a
    source, document after document, form blocks of `block` words; output shards draw how many
    blocks each source gives (`shard_counts`), slots are mapped to blocks (`slot_blocks`) and
    joined with them by index. No block is taken more than `repeats` times, so no document is.
    The same rows give the same mix. A null or empty text has size 0 and gives nothing; an empty
    table gives an empty result. Repeated rows are documents of their own, in any order.
    """
    placed, slots = _drawn(docs, weights, repeats, block, shard)
    times = slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
    end = F.col("start") + F.col("size")
    low, high = F.floor(F.col("start") / block).cast("long"), F.floor((end - 1) / block).cast("long")
    whole = placed.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(low, high)).otherwise(F.array(F.lit(-1).cast("long")))))
    words = F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    taken = F.when(F.col("block") >= 0, words * F.coalesce("times", F.lit(0))).otherwise(0)
    # As many rows as blocks, which the size estimate before the explode does not see: not to be broadcast.
    joined = whole.join(times.hint("merge"), ["rank", "block"], "left").withColumn("taken", taken)
    keys = ("doc_id", "rank", "row", "size", "source_size", "target")
    summed = joined.groupBy(*keys).agg(F.sum("taken").cast("long").alias("taken"))
    return summed.select("doc_id", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """shard, slot, source, words: the mixed shards, a row per slot with its block's words in order.

    The draws and blocks are those of `mix`, whose `taken` counts these words by document. A slot
    beyond `repeats` rounds of its source has no row; the last block of a source may be short. The
    slots of a shard are shuffled by a hash of their number, so its sources alternate.
    """
    placed, slots = _drawn(docs, weights, repeats, block, shard, "text")
    # A shard has `shard` slots at most.
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "at"), "at")
    slots = slots.withColumn("at", (F.row_number().over(shuffled) - 1).cast("long"))
    low = F.floor(F.col("start") / block).cast("long")
    high = F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")
    # Words are found once per document, and cut at the block bounds.
    every = placed.filter("size > 0").withColumn("_words", F.regexp_extract_all("text", F.lit(WORDS), 0))
    first = lambda b: F.greatest(b * block - F.col("start"), F.lit(0))
    piece = lambda b: F.struct(
        b.alias("block"),
        (F.col("start") + first(b)).alias("place"),
        F.slice("_words", (first(b) + 1).cast("int"), ((b + 1) * block - F.col("start") - first(b)).cast("int")).alias("words"),
    )
    pieces = every.select("rank", "source", F.explode(F.transform(F.sequence(low, high), piece)).alias("_p"))
    # A block has at most `block` pieces.
    parts = F.sort_array(F.collect_list(F.struct("_p.place", "_p.words")))
    packed = pieces.groupBy("rank", F.col("_p.block").alias("block")).agg(
        F.first("source").alias("source"), F.flatten(F.transform(parts, lambda x: x["words"])).alias("words")
    )
    joined = slots.hint("merge").join(packed, ["rank", "block"])
    return joined.select("shard", F.col("at").alias("slot"), "source", "words")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, as often as the mix takes them.

    A document of which the mix takes x times its words comes floor(x) times, and once more if a
    number from its id, uniform over documents, is below the rest: so the words of whole documents
    come near the words taken. Rows that share a doc_id are taken alike, by the words of all. Texts
    without words have nothing to be taken. Other columns may have any name and value; a null doc_id
    or source is one of its own. An empty table gives an empty result.
    """
    taken = mix(docs).filter("size > 0").groupBy("doc_id").agg((F.sum("taken") / F.sum("size")).alias("times"))
    number = F.pmod(F.xxhash64("doc_id"), F.lit(DRAW[2])) / F.lit(float(DRAW[2]))
    copies = F.floor("times") + F.when(number < F.col("times") - F.floor("times"), 1).otherwise(0)
    times = taken.select(F.col("doc_id").alias("taken_id"), copies.cast("int").alias("copies")).filter("copies > 0")
    rows = packed(docs, doc_id=F.col("doc_id")).join(times, F.col("doc_id").eqNullSafe(F.col("taken_id")))
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
