"""Ranked lexical search by an Aho-Corasick scan of the documents, without an index of them.

1. *Items.* The terms of the items with their repeats, in blocks of about :data:`BLOCK_POSTINGS`
   item terms. Items are the stated query set; a block is the largest thing that is broadcast.
2. *Scan.* One automaton holds every term of a block between two guard characters. It runs over
   each whole text, in which everything that is no term character has become the guard, so that
   a hit is a maximal match and neighbours share the guard between them. Its outputs are term
   numbers: their counts are the document's tf. A document leaves its term total and its hits.
3. *Weights.* N, L and the df of the block's terms are sums over the scan's rows.
4. *Score.* Each hit is mapped to the items that hold its term, and its contribution is added
   up per document and item, in slices of :data:`CELLS` scores. A task keeps the best rows of
   each item; those of all tasks are ranked in salted shares, then as a whole.

Defined results: a document without terms (null, empty, only separators) counts in neither N nor
L and is never found; an item without terms has no rows; repeated ``item_id`` rows are searched
one by one and repeated ``doc_id`` rows are found one by one; a null ``doc_id`` ranks behind equal
scores; bytes that are not UTF-8 are term characters; other columns play no part. One item's terms
stay together in one block, however long its text is.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.llm.hashing import binary_column, binary_values
from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import Staging

K = 10
#: Distinct item terms, summed over the items, that one automaton and broadcast holds on average.
BLOCK_POSTINGS = 1 << 18
#: Scores of documents and items that a task holds at once, and expanded contributions.
CELLS, EXPANDED, SALTS = 1 << 21, 1 << 21, 64
GUARD = " "

# --- Fixed values: ASCII characters of terms, besides everything above ASCII --------------
TERM_CHARACTERS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# --- End of fixed values ------------------------------------------------------------------

_GUARDED = bytes(c if c in TERM_CHARACTERS or c > 127 else ord(GUARD) for c in range(256)).lower()

ITEM_TERMS = "item_row long, item_id long, term binary, times long"
SCANNED = "doc_id long, doc_row long, n long, terms binary, times binary"
BEST = "item int, doc_id long, doc_row long, score long"


def guarded(text: bytes | None) -> bytes:
    """A text's terms in lower case, with the guard in place of every other character."""
    return (text or b"").translate(_GUARDED)


def _as_text(body: bytes) -> str:
    return body.decode("utf-8", "surrogateescape")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (row, item, term, times)
            for row, item, text in zip(*(batch.column(i).to_pylist() for i in range(3)))
            for term, times in Counter(guarded(text).split()).items()
        ]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[i], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
            names=["item_row", "item_id", "term", "times"],
        )


def automaton(terms: list[bytes]):
    """Guarded terms with their numbers as outputs."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        machine.add_word(GUARD + _as_text(term) + GUARD, number)
    machine.make_automaton()
    return machine


def _term_total(body: bytes) -> int:
    is_term = np.frombuffer(body, np.uint8) != ord(GUARD)
    return int(np.count_nonzero(is_term[1:] & ~is_term[:-1])) + int(len(is_term) > 0 and is_term[0])


def _scan(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    machine, number = automaton(terms.value), itemgetter(1)
    for batch in batches:
        doc_ids, doc_rows, totals, hits, bounds = [], [], [], [], [0]
        for doc_id, doc_row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            body = guarded(text.as_py())
            total = _term_total(body)
            if not total:
                continue
            found = Counter(map(number, machine.iter(GUARD + _as_text(body) + GUARD))) if len(machine) else {}
            doc_ids.append(doc_id)
            doc_rows.append(doc_row)
            totals.append(total)
            hits.extend(found.items())
            bounds.append(len(hits))
        pairs = np.array(hits, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, pa.int64()), pa.array(doc_rows, pa.int64()), pa.array(totals, pa.int64()),
                binary_column(pairs[:, 0].astype(np.int32), np.array(bounds)), binary_column(pairs[:, 1].copy(), np.array(bounds)),
            ],
            names=["doc_id", "doc_row", "n", "terms", "times"],
        )


def _term_documents(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """One row per task and term that it met: the number of documents that hold it."""
    counts = np.zeros(n_terms, np.int64)
    for batch in batches:
        counts += np.bincount(binary_values(batch.column(0), np.int32)[0], minlength=n_terms)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["term", "df"])


def term_weight(df: int, n_documents: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class _Best:
    """The best documents of each item so far, among the rows a task has seen."""

    def __init__(self, n_items: int, keep: int):
        self.keep = keep
        self.reach = np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, doc_rows: np.ndarray) -> None:
        """``scores`` by document and item; null ids are passed as the largest number."""
        n = len(scores)
        if n > self.keep:
            self.reach = np.maximum(self.reach, np.partition(scores, n - self.keep, axis=0)[n - self.keep])
        doc, item = np.nonzero(scores >= self.reach)
        fresh = (item, -scores[doc, item], doc_ids[doc], doc_rows[doc])
        rows = [np.concatenate(both) for both in zip(self.rows, fresh)]
        order = np.lexsort(rows[::-1])
        rows = [column[order] for column in rows]
        starts = np.searchsorted(rows[0], np.arange(len(self.reach)))
        rank = np.arange(len(order)) - starts[rows[0]]
        kept = rank < self.keep
        last = rank == self.keep - 1
        self.reach[rows[0][last]] = np.maximum(self.reach[rows[0][last]], -rows[1][last])
        self.rows = [column[kept] for column in rows]


def _contributions(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` in 64 bits."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _scores(batches: Iterator[pa.RecordBatch], block, n_documents: int, n_terms_all: int, keep: int) -> Iterator[pa.RecordBatch]:
    weights, starts, items, repeats, n_items, exact = block.value
    lengths = np.diff(starts)
    best = _Best(n_items, keep)
    slice_rows = max(1, CELLS // max(1, n_items))
    null_id = np.iinfo(np.int64).max

    def summed(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        add = lambda v: np.bincount(owner, weights=v, minlength=rows * n_items)
        if exact:
            return add(values).astype(np.int64)
        # Halves of 26 bits stay exact as doubles, however many terms an item has.
        return (add(values >> 26).astype(np.int64) << 26) + add(values & ((1 << 26) - 1)).astype(np.int64)

    for batch in batches:
        doc_ids = np.array([null_id if i is None else i for i in batch.column(0).to_pylist()], np.int64)
        doc_rows = batch.column(1).to_numpy()
        # Python's integers: 75 * n * N may pass 64 bits on the way.
        m = np.array([25 + 75 * n * n_documents // n_terms_all for n in batch.column(2).to_pylist()], np.int64)
        terms, bounds = binary_values(batch.column(3), np.int32)
        tf, _ = binary_values(batch.column(4), np.int64)
        owner = np.repeat(np.arange(len(m)), np.diff(bounds))
        values = _contributions(tf, m[owner], weights[terms])
        # The items that the hits of a document lead to, so that no slice expands too far.
        reach = np.append(0, np.cumsum(lengths[terms]))[bounds]
        low = 0
        while low < len(m):
            high = int(np.searchsorted(reach, reach[low] + EXPANDED, "right")) - 1
            high = min(max(high, low + 1), low + slice_rows, len(m))
            a, b = bounds[low], bounds[high]
            if b > a:
                times = lengths[terms[a:b]]
                at = np.repeat(starts[terms[a:b]] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
                cell = np.repeat(owner[a:b] - low, times) * n_items + items[at]
                scores = summed(cell, np.repeat(values[a:b], times) * repeats[at], high - low)
                best.add(scores.reshape(high - low, n_items), doc_ids[low:high], doc_rows[low:high])
            low = high
    item, score, doc_id, doc_row = best.rows
    yield pa.RecordBatch.from_arrays(
        [pa.array(item.astype(np.int32)), pa.array(doc_id, mask=doc_id == null_id), pa.array(doc_row), pa.array(-score)],
        names=["item", "doc_id", "doc_row", "score"],
    )


def _first(rows: DataFrame, keep: int) -> DataFrame:
    """The first rows of each item, thinned in salted shares first, with their rank."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "doc_row"]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_row"), F.lit(SALTS)))
    for keys in (["item", "_salt"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= keep)
    return salted


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items``.

    ``docs`` has ``doc_id, text`` and ``items`` has ``item_id, text``.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "lexical-search")
    asked = items.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary"))
    item_terms = staging.table(asked.mapInArrow(_item_terms, ITEM_TERMS), "item-terms")
    blocks = max(1, -(-item_terms.count() // BLOCK_POSTINGS))
    texts = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("doc_row"), F.col("text").cast("string").cast("binary"))
    totals, found = None, []
    for number in range(blocks):
        held = item_terms.where(F.pmod(F.xxhash64("item_row"), F.lit(blocks)) == number).orderBy("item_row", "term").toArrow()
        rows, item_of = np.unique(held["item_row"].to_numpy(), return_inverse=True)
        item_ids = dict(zip(held["item_row"].to_pylist(), held["item_id"].to_pylist()))
        terms = sorted(set(held["term"].to_pylist()))
        numbers = {term: i for i, term in enumerate(terms)}
        term_of = np.array([numbers[term] for term in held["term"].to_pylist()], np.int64)
        if not terms:
            continue
        sent = spark.sparkContext.broadcast(terms)
        scanned = staging.table(texts.mapInArrow(mapper(_scan, sent), SCANNED), "scanned")
        if totals is None:
            totals = scanned.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not totals[0]:
            break
        met = scanned.select("terms").mapInArrow(mapper(_term_documents, len(terms)), "term int, df long")
        df = {row.term: row.df for row in met.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = np.array([term_weight(df.get(t, 0), totals[0]) for t in range(len(terms))], np.int64)
        by_term = np.lexsort((item_of, term_of))
        starts = np.searchsorted(term_of[by_term], np.arange(len(terms) + 1))
        repeats = held["times"].to_numpy()[by_term]
        most = int(np.bincount(item_of, weights=held["times"].to_numpy()).max()) * max(1, int(weights.max())) * 1_000_000
        block = spark.sparkContext.broadcast((weights, starts, item_of[by_term], repeats, len(rows), most < 1 << 53))
        best = staging.table(scanned.mapInArrow(mapper(_scores, block, totals[0], totals[1], k), BEST), "best")
        staging.drop(scanned)
        names = spark.createDataFrame([(i, item_ids[row]) for i, row in enumerate(rows.tolist())], "item int, item_id long")
        found.append(_first(best, k).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
