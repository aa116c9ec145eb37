"""Packing documents into token sequences by cutting-stock column generation.

A document gives full sequences, a body of whole units (64 tokens) and a tail below one unit. The
bodies are a cutting-stock problem over the histogram of their unit counts, at most 63 classes:
a linear program over patterns, whose columns a knapsack dynamic program prices, rounded down to
whole patterns. Patterns are given to the documents of each class by rank. Tails, and bodies that
rounding left over or that only patterns with room hold, are laid end to end and cut at sequence borders.

Defined results: a null or empty text is the end token alone; repeated rows are packed one by one;
an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.llm.mixing import _running
from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import Staging
from xylemflow.llm.tokens import word_tokenizer

CAPACITY, UNIT, END_ID = 4096, 64, 2
ID_TYPE = "<u2"

TOKENS = "row_nr long, doc_id long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _tokenized(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], ID_TYPE).tobytes()
    for batch in batches:
        tokenizer = word_tokenizer(path, ID_TYPE)
        ids = [(tokenizer.encode(text) if text else b"") + end for text in batch.column(2).to_pylist()]
        counts = pa.array([len(x) // np.dtype(ID_TYPE).itemsize for x in ids], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts, pa.array(ids, pa.binary())], names=["row_nr", "doc_id", "doc_tokens", "ids"])


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of items within the capacity."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        fits = np.flatnonzero(sizes <= room)
        if len(fits):
            offers = value[room - sizes[fits]] + prices[fits]
            k = int(offers.argmax())
            if offers[k] > value[room] + 1e-12:
                value[room], choice[room] = offers[k], fits[k]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), pattern


def cutting_stock(demand: dict[int, int], capacity: int, rounds: int = 2000) -> list[tuple[int, dict[int, int]]]:
    """Whole patterns ``(times, {size: items})`` that use no item more often than it is there.

    Column generation from single-size patterns; the sizes are whole numbers below the capacity.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    wanted = np.array([demand[s] for s in sizes.tolist()], float)
    basis = np.diag((capacity // sizes).astype(float))
    amount = wanted / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, column = best_pattern(np.maximum(prices, 0.0), sizes, capacity)
        if worth <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column.astype(float))
        grows = change > 1e-9
        ratio = np.where(grows, amount / np.where(grows, change, 1.0), np.inf)
        leave = int(ratio.argmin())
        amount = np.maximum(amount - ratio[leave] * change, 0.0)
        amount[leave] = ratio[leave]
        basis[:, leave] = column
    patterns = []
    left = wanted.astype(np.int64)
    for k, x in enumerate(amount):
        column = basis[:, k].round().astype(np.int64)
        used = np.flatnonzero(column)
        times = min([int(x + 1e-6), *(int(left[i] // column[i]) for i in used)]) if len(used) else 0
        if times > 0:
            left = left - times * column
            patterns.append((times, {int(sizes[i]): int(column[i]) for i in used}))
    return patterns


def _assignments(patterns: list[tuple[int, dict[int, int]]]) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Rows ``(units, low, high, each, sequence, at)``: ranks from low to high of a class go to the
    pattern's sequences, ``each`` a sequence, from unit ``at`` on. At most classes squared rows."""
    rows, taken, sequence = [], {}, 0
    for times, pattern in patterns:
        at = 0
        for size, each in pattern.items():
            low = taken.get(size, 0)
            taken[size] = low + times * each
            rows.append((size, low, taken[size], each, sequence, at))
            at += size * each
        sequence += times
    return rows, sequence


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ids with their pieces to one row for each piece."""
    for batch in batches:
        rows = []
        for doc_id, count, ids, pieces in zip(*(batch.column(i).to_pylist() for i in range(4))):
            wide = np.frombuffer(ids, ID_TYPE).astype("<u4")
            for p in pieces:
                part = wide[p["start"] : p["start"] + p["length"]]
                rows.append((doc_id, p["start"], p["length"], zlib.crc32(part.tobytes()), count, p["sequence_id"], p["offset"]))
        columns = list(zip(*rows)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECES.split(", ")])


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, staging: Staging) -> DataFrame:
    """A staged table of :data:`TOKENS`, one row per document."""
    source = docs.select(F.monotonically_increasing_id().alias("row_nr"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staging.table(source.mapInArrow(mapper(_tokenized, tokenizer_path, end_id), TOKENS), "tokens")


def plan_pieces(lengths: DataFrame, staging: Staging, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """``row_nr, pieces`` (array of ``start, length, sequence_id, offset``) of ``row_nr, doc_tokens``."""
    spark = lengths.sparkSession
    rest = F.col("doc_tokens") % capacity
    shaped = lengths.select(
        "row_nr",
        F.shiftright("row_nr", 33).alias("bucket"),
        F.floor(F.col("doc_tokens") / capacity).alias("full"),
        F.floor(rest / unit).alias("units"),
        (rest % unit).alias("tail"),
        F.lit(1).alias("one"),
    )
    # The histogram has at most capacity / unit rows, whatever the corpus holds.
    demand = {int(r["units"]): int(r["count"]) for r in shaped.where("units > 0").groupBy("units").count().collect()}
    # A pattern that leaves room would be padded; its bodies do better end to end.
    patterns = [(n, p) for n, p in cutting_stock(demand, capacity // unit) if sum(s * k for s, k in p.items()) == capacity // unit]
    given, sequences = _assignments(patterns)
    table = spark.createDataFrame(given, "units long, low long, high long, each long, sequence long, at long")
    ranked = _running(shaped, "units", "bucket", ["row_nr"], "one", "rank")
    placed = ranked.join(F.broadcast(table), "units", "left").where("low IS NULL OR (rank >= low AND rank < high)")
    placed = placed.select("row_nr", (F.col("sequence") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("body_sequence"),
                           (unit * (F.col("at") + (F.col("rank") - F.col("low")) % F.col("each") * F.col("units"))).alias("body_offset"))
    laid = staging.table(
        shaped.join(placed.where("body_sequence IS NOT NULL"), "row_nr", "left").withColumn(
            "loose", F.col("tail") + F.when(F.col("body_sequence").isNull(), F.col("units") * unit).otherwise(0)
        ),
        "placed",
    )
    per_bucket = Window.partitionBy("bucket").orderBy("row_nr").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    # One row for each input partition goes through the unpartitioned window.
    buckets = staging.table(
        laid.groupBy("bucket").agg(F.sum("full").alias("f"), F.sum("loose").alias("l")).select(
            "bucket", F.coalesce(F.sum("f").over(earlier), zero).alias("full_start"), F.coalesce(F.sum("l").over(earlier), zero).alias("loose_start"), "l"
        ),
        "buckets",
    )
    loose_total = buckets.agg(F.sum("l")).first()[0] or 0
    loose_sequences = -(-loose_total // capacity)
    summed = (
        laid.withColumns({"f": F.coalesce(F.sum("full").over(per_bucket), zero), "l": F.coalesce(F.sum("loose").over(per_bucket), zero)})
        .join(buckets.drop("l"), "bucket")
        .withColumns({"f": F.col("f") + F.col("full_start"), "l": F.col("l") + F.col("loose_start")})
    )
    first_loose, first_full = sequences, sequences + loose_sequences
    piece = lambda start, length, sequence, offset: F.struct(
        start.cast("long").alias("start"), length.cast("long").alias("length"), sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset")
    )
    i = lambda n: F.lit(n).cast("long")
    full = F.when(F.col("full") > 0, F.transform(F.sequence(i(0), F.col("full") - 1), lambda k: piece(k * capacity, i(capacity), F.col("f") + first_full + k, i(0))))
    rest_start = F.col("full") * capacity
    in_pattern = F.col("body_sequence").isNotNull()
    body = F.when(in_pattern, F.array(piece(rest_start, F.col("units") * unit, F.col("body_sequence"), F.col("body_offset"))))
    loose_start = rest_start + F.when(in_pattern, F.col("units") * unit).otherwise(0)
    room = capacity - F.col("l") % capacity
    head = F.least(F.col("loose"), room)
    loose = F.when(
        F.col("loose") > 0,
        F.filter(
            F.array(
                piece(loose_start, head, first_loose + F.floor(F.col("l") / capacity), F.col("l") % capacity),
                piece(loose_start + head, F.col("loose") - head, first_loose + F.floor(F.col("l") / capacity) + 1, i(0)),
            ),
            lambda p: p["length"] > 0,
        ),
    )
    none = F.array().cast("array<struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>>")
    return summed.select("row_nr", F.concat(*[F.coalesce(x, none) for x in (full, body, loose)]).alias("pieces"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, as :data:`PIECES`."""
    staging = Staging(docs.sparkSession, "packing")
    tokens = tokenize(docs, tokenizer_path, end_id, staging)
    pieces = plan_pieces(tokens.select("row_nr", "doc_tokens"), staging)
    return tokens.join(pieces, "row_nr").select("doc_id", "doc_tokens", "ids", "pieces").mapInArrow(_cut, PIECES)
