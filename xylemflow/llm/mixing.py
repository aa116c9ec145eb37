"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots, each for one block of equally many tokens. Slot ``i`` maps the
golden-ratio point ``frac(i * phi)`` through the cumulative target shares to a source, and is the
``k``-th slot of that source; it takes the source's ``k``-th block. A source's blocks are cut from
its documents in shuffled order, over again for each further epoch. The mix is what the slots take:
slots beyond a source's target go unused, and a block without a slot stays out. There are
:data:`SPARE` times as many slots as blocks, so that a source gives its target, rounded down to
whole tokens; one whose target is a few blocks of 1/:data:`LEAST_BLOCKS` of the mix at most may give
a block less. A document's slot is the first one that takes a part of it.

DataFrame functions only. Prefix sums and ranks inside a source go through buckets, so that no task
needs a whole source.

Defined results: a null text has size 0; a source without tokens has target 0; documents of size 0
are taken 0 times; repeated rows count one by one; null is a source of its own and ranks last;
the result of equal input is always the same, up to the order of rows that agree in everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.functions.ordered import global_index
from xylemflow.llm.staging import Staging, unique_names

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, VOLUME_PERCENT, MOST_TIMES = (3, 1, 2), 150, 2
BLOCK_TOKENS = 4096
#: At least so many blocks make a mix of little text.
LEAST_BLOCKS = 1 << 16
#: Slots of the schedule for each block of the mix.
SPARE = 2
GOLDEN = 0.6180339887498949
#: Cells of the unit interval that connect points to shares, and rows of a bucket of documents.
CELLS, SLOT_BITS = 1024, 16
BUCKET_ROWS, LEAST_BUCKETS = 1 << 16, 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, staging: Staging, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, target`` of every source of ``source, size`` rows.

    The common level is raised until the sources that are at their bound and the others at
    ``level * weight`` together have the mix's volume; each round is one aggregate.
    """
    totals = staging.table(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ordered = global_index(totals.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank").drop("_null")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = staging.table(
        ordered.withColumn("weight", cycle.cast("double")).withColumn("bound", (MOST_TIMES * F.col("source_size")).cast("double")), "source-ranks"
    )
    volume = (ranked.agg(F.sum("source_size")).first()[0] or 0) * VOLUME_PERCENT / 100
    level, full = 0.0, -1
    while True:
        at_bound = F.col("bound") <= F.lit(level) * F.col("weight")
        held, free, count = ranked.agg(
            F.sum(F.when(at_bound, F.col("bound")).otherwise(0.0)), F.sum(F.when(at_bound, 0.0).otherwise(F.col("weight"))), F.count_if(at_bound)
        ).first()
        if count == full or not free:
            break
        level, full = (volume - held) / free, count
    target = F.least(F.col("bound"), F.lit(level) * F.col("weight")) if free else F.col("bound")
    return staging.table(ranked.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"), "_rank"), "targets")


def _running(rows: DataFrame, group: str, bucket: str, order: Sequence[str], value: str, output: str) -> DataFrame:
    """Add ``output`` = sum of ``value`` over the earlier rows of the group, by (bucket, order)."""
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    starts = sums.select(group, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    return (
        rows.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, [group, bucket])
        .withColumn(output, F.col("_start") + F.col("_inner"))
        .drop("_start", "_inner")
    )


def schedule(targets: DataFrame, block: int, staging: Staging) -> DataFrame:
    """``slot, _rank, k``: the source of each slot and the slot's number within its source."""
    volume = targets.agg(F.sum("target")).first()[0] or 0.0
    slots = SPARE * (int(volume // block) + 1)
    shares = targets.where("target > 0").select("_rank", (F.col("target") / F.lit(volume or 1.0)).alias("share"))
    upto = global_prefix(shares, staging)
    # A source's interval is found through the cells of the unit interval that it touches.
    intervals = upto.select(
        "_rank", F.col("low"), F.col("high"),
        F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.least(F.col("high"), F.lit(1.0)) * CELLS))).alias("cell"),
    )
    turn = F.col("slot") * F.lit(GOLDEN)
    points = targets.sparkSession.range(slots).withColumnRenamed("id", "slot").withColumn("u", turn - F.floor(turn))
    met = (
        points.withColumn("cell", F.floor(F.col("u") * CELLS)).join(intervals, "cell").where("u >= low AND u < high").select("slot", "_rank")
    )
    numbered = _running(
        met.withColumns({"bucket": F.shiftright("slot", SLOT_BITS), "one": F.lit(1)}), "_rank", "bucket", ["slot"], "one", "k"
    )
    return numbered.select("slot", "_rank", "k")


def global_prefix(shares: DataFrame, staging: Staging) -> DataFrame:
    """``_rank, low, high``: each source's half-open interval of the unit interval, in rank order."""
    cut = shares.withColumns({"all": F.lit(0), "bucket": F.shiftright("_rank", 12)})
    lows = staging.table(_running(cut, "all", "bucket", ["_rank"], "share", "low"), "shares")
    return lows.select("_rank", "low", (F.col("low") + F.col("share")).alias("high"))


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = 1) -> DataFrame:
    """``doc_id, row_nr, source, size, source_size, target, taken, slot`` of every row of ``docs``.

    ``row_nr`` is the row's ``monotonically_increasing_id`` in ``docs``, ``taken`` the words that
    the mix takes of it, repeats counted, and ``slot`` where it comes first, null if it is left out.
    """
    staging = Staging(docs.sparkSession, "mixing")
    sized = staging.table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row_nr"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    targets = source_targets(sized, staging, weights)
    volume = targets.agg(F.sum("target")).first()[0] or 0.0
    block = max(1, min(BLOCK_TOKENS, int(volume // LEAST_BLOCKS)))

    buckets = max(LEAST_BUCKETS, -(-sized.count() // BUCKET_ROWS))
    shuffled = F.xxhash64("doc_id", F.lit(seed))
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "row_nr", "size", "_rank", "source_size", "target"
    )
    placed = _running(
        rows.where("size > 0").withColumns({"order": shuffled, "bucket": F.pmod(F.shiftright(shuffled, 20), F.lit(buckets))}),
        "_rank", "bucket", ["order", "doc_id", "size", "row_nr"], "size", "start",
    )
    epochs = F.explode(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1))).alias("epoch")
    runs = placed.select("*", epochs).withColumn("start", F.col("start") + F.col("epoch") * F.col("source_size"))
    needed = F.floor("target")
    pieces = (
        runs.withColumn("end", F.least(F.col("start") + F.col("size"), needed))
        .where("end > start")
        .select("row_nr", "_rank", "start", "end", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))).alias("k"))
        .select("row_nr", "_rank", "k", (F.least("end", (F.col("k") + 1) * block) - F.greatest("start", F.col("k") * block)).alias("tokens"))
    )
    slots = schedule(targets, block, staging)
    mixed = pieces.join(slots, ["_rank", "k"])
    taken = staging.table(mixed.groupBy("row_nr").agg(F.sum("tokens").alias("taken"), F.min("slot").alias("slot")), "taken")
    named = sized.join(targets.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return named.join(taken, "row_nr", "left").select(
        "doc_id", "row_nr", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "slot"
    )


def mixed_texts(docs: DataFrame) -> DataFrame:
    """``docs`` after mixing, in slot order: a text once for each whole time it is taken, then its first words.

    Documents that the mix leaves out go; ``n_chars`` follows the text where ``docs`` has it.
    ``docs`` must be a plain scan.
    """
    row, taken, size, slot, mixed = unique_names(docs.columns, "_row", "_taken", "_size", "_slot", "_text")
    told = mix_documents(docs).where("taken > 0").select(F.col("row_nr").alias(row), F.col("taken").alias(taken), F.col("size").alias(size), F.col("slot").alias(slot))
    whole, rest = F.floor(F.col(taken) / F.col(size)).cast("int"), (F.col(taken) % F.col(size)).cast("int")
    head = F.when(rest > 0, F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), rest), " "))
    text = F.array_join(F.concat(F.array_repeat(F.col("text"), whole), F.array(head)), "\n")
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(told, row).withColumn(mixed, text)
    values = {"text": F.col(mixed), "n_chars": F.length(mixed).cast("long")}
    columns = [values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]
    # Written once before it is put in order, since finding the ranges reads it twice.
    staged = Staging(docs.sparkSession, "mixed").table(joined.select(*columns, slot, row), "texts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged.repartitionByRange(parts, slot, row).sortWithinPartitions(slot, row).drop(slot, row)
