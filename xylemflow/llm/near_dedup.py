"""Exact set-similarity join of documents by word shingles, and its components.

A document is the set of its distinct five-word shingles; two documents link when their Jaccard
similarity is at least 0.8. The join is complete:

1. Documents with equal sets are one class; only classes go on.
2. The number of classes that hold each shingle gives a global order, rarest first. Linked sets
   share a shingle in their prefixes of ``n - ceil(0.8 n) + 1`` shingles. Shingles of one class
   only are at the front, so a class whose prefix holds nothing else has no link and is done.
3. Each class is compared with its leader: of the sets it meets in the index lists the one that
   has the fewest shingles of its own, which is the common origin where there is one. Where that
   leader has a leader itself, the class is compared with the last one of the chain too. Classes
   that share at least half of the smaller set with the last (or else the first) are its group.
4. The answers of a group's members are derived from their leader's. With ``d`` shingles of the
   leader missing and ``s`` shared ones besides it, two members have at most
   ``n_leader - max(d, d') + min(s, s')`` shingles in common. Members linked to the leader are one
   component; another member is *open* only if this bound still admits a partner in its group.
   The others are done without a pair being formed, however large the group is.
5. The index lists of the remaining prefix shingles are cut into blocks of sets of one group, of
   like size and position. A probe skips a whole block when its position, size or group already
   rule out the needed overlap; pairs of different components in the other blocks are compared.

Shingles count as equal by 64-bit hashes; words above 64 bytes go into them by a digest. Linked sets
are told apart from others by counts of equal hashes, so a chance agreement of two different
shingles (below 1e-6 for 10^7 distinct ones) could shift a count by one.

Defined results: null or blank texts have an empty set, link with nothing and form their own
component; repeated rows with one ``doc_id`` have equal components; a null ``doc_id`` ranks last,
and is a component's id only if all its ids are null. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm import postings as P
from xylemflow.llm.components import connected_components
from xylemflow.llm.hashing import binary_values, row_slices, set_keys, shingle_sets, text_bytes
from xylemflow.llm.staging import Staging, unique_names

WIDTH, PERCENT = 5, 80
#: Members of one block of an index list.
BLOCK = 64
#: The share of the smaller set, in percent, that a class has in common with the leader of its group.
GROUP_PERCENT = 50
#: Steps along chains of leaders, each of which doubles the length that is followed.
JUMPS = 4


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    flat, offsets = text_bytes(column)
    for low, high in row_slices(offsets):
        start, end = int(offsets[low]), int(offsets[high])
        yield low, high, shingle_sets(flat[start:end], offsets[low : high + 1] - start, width)


def _set_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for low, high, sets in _sets(batch.column(2), width):
            sizes[low:high], keys[low:high] = [len(s) for s in sets], set_keys(sets)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes), pa.array(keys)], names=["row_nr", "doc_id", "n_shingles", "set_key"]
        )


def _sampled_hashes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, sets in _sets(batch.column(0), width):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["hash"])


def _packed(batches: Iterator[pa.RecordBatch], width: int, parts: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    def documents() -> Iterator[tuple[int, np.ndarray, None, None]]:
        for batch in batches:
            for _, _, sets in _sets(batch.column(0), width):
                for key, s in zip(set_keys(sets).tolist(), sets):
                    if len(s):
                        yield key, s, None, None

    return P.pack(documents(), parts, frequent)


_INDEXED = "set_key long, n long, first long, q long, tokens binary"


def _indexed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Returned shared hashes of each class to its ordered shared shingles and prefix length.

    ``first`` counts the shingles of this class alone, which come before the ``tokens``; ``q`` of
    those belong to the prefix. Classes without such a shingle are dropped.
    """
    for batch in batches:
        rows = []
        all_hashes, bounds = binary_values(batch.column(2), np.uint64)
        all_weights, _ = binary_values(batch.column(3), np.uint32)
        for key, n, low, high in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds[:-1], bounds[1:]):
            hashes, weights = all_hashes[low:high], all_weights[low:high]
            alone = n - len(hashes)
            q = n - (percent * n + 99) // 100 + 1 - alone
            if q > 0:
                rows.append((key, n, alone, min(q, len(hashes)), hashes[np.lexsort((hashes, weights))].tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(columns[i], pa.int64()) for i in range(4)), pa.array(columns[4], pa.binary())],
            names=["set_key", "n", "first", "q", "tokens"],
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        q = batch.column(3).to_numpy()
        values, bounds = binary_values(batch.column(4), np.int64)
        owner = np.repeat(np.arange(len(q)), q)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(q) - q, q)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(values[bounds[:-1][owner] + at]),
                pa.array(batch.column(0).to_numpy()[owner]),
                pa.array(batch.column(1).to_numpy()[owner]),
                pa.array(batch.column(2).to_numpy()[owner] + at),
            ],
            names=["token", "set_key", "n", "position"],
        )


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [batch.column(i).to_numpy() for i in (1, 4)]
        left, left_at = binary_values(batch.column(2), np.uint64)
        right, right_at = binary_values(batch.column(5), np.uint64)
        common = np.array(
            [
                len(np.intersect1d(left[a:b], right[c:d], assume_unique=True))
                for a, b, c, d in zip(left_at[:-1], left_at[1:], right_at[:-1], right_at[1:])
            ],
            np.int64,
        )
        ok = pa.array(100 * common >= percent * (sizes[0] + sizes[1] - common)) if len(common) else pa.array([], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(common), ok], names=["a", "b", "common", "linked"])


def _verified(pairs: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """``a, b, common, linked`` for distinct pairs of classes; a class's shingles are sent once per pair."""
    side = lambda name: index.select(F.col("set_key").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "n_a", "tokens_a", "b", "n_b", "tokens_b").mapInArrow(P.mapper(_linked, percent), "a long, b long, common long, linked boolean")


def _leader_pairs(entries: DataFrame) -> DataFrame:
    """``a, b``: each class with the leader it meets in most of its lists."""
    leaders = entries.groupBy("token").agg(F.min(F.struct("alone", F.xxhash64("set_key").alias("h"), F.col("set_key").alias("k"))).alias("_leader"))
    votes = (
        entries.join(leaders, "token").where(F.col("set_key") != F.col("_leader.k"))
        .groupBy("set_key", F.col("_leader.k").alias("leader")).agg(F.count(F.lit(1)).alias("votes"))
    )
    return votes.groupBy("set_key").agg(F.max_by("leader", F.struct("votes", "leader")).alias("b")).select(F.col("set_key").alias("a"), "b")


def _last_leaders(pairs: DataFrame, staging: Staging) -> DataFrame:
    """``a, b``: classes whose leader has a leader, with the last leader of that chain.

    A leader comes before its class in one order of all classes, so chains end. Each of the
    :data:`JUMPS` steps doubles the part of a chain that is followed; where one goes on beyond that,
    ``b`` is a leader nearer to the class.
    """
    last = pairs
    for _ in range(JUMPS):
        further = last.select(F.col("a").alias("b"), F.col("b").alias("_next"))
        last = staging.table(last.join(further, "b", "left").select("a", F.coalesce("_next", "b").alias("b")), "last-leaders")
    return last.join(pairs, ["a", "b"], "left_anti")


def _grouped(index: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """``set_key, grp, open, n_leader, missing, besides`` of leaders and of their groups' members.

    ``met`` has one or two leaders of a class: the ``last`` one counts if it is close enough. A
    class that leads others and is a member itself belongs to its leader's group. A member is open
    if it is not linked to its leader and some other member could still be linked to it.
    """
    sizes = index.select("set_key", "n", F.col("first").alias("alone"))
    near = (
        met.join(sizes.select(F.col("set_key").alias("a"), "n", "alone"), "a")
        .join(sizes.select(F.col("set_key").alias("b"), F.col("n").alias("n_leader")), "b")
        .where(F.col("common") * 100 >= GROUP_PERCENT * F.least("n", "n_leader"))
    )
    close = near.groupBy("a").agg(F.max_by(F.struct(*(c for c in near.columns if c != "a")), "last").alias("_of")).select("a", "_of.*")
    leaders = close.select(F.col("b").alias("set_key")).distinct().join(close.select(F.col("a").alias("set_key")), "set_key", "left_anti")
    members = close.select(
        F.col("a").alias("set_key"), F.col("b").alias("grp"), "linked", "n", "n_leader",
        (F.col("n_leader") - F.col("common")).alias("missing"), (F.col("n") - F.col("alone") - F.col("common")).alias("besides"),
    )
    bounds = members.groupBy("grp").agg(F.max("besides").alias("most_besides"), F.min("n").alias("least_n"))
    # A smaller partner misses at least what it is smaller by, so its size need not be below that.
    partner = F.greatest(F.col("least_n"), F.col("n_leader") - F.col("missing"))
    reach = F.col("n_leader") - F.col("missing") + F.least("besides", "most_besides")
    admits = (100 + percent) * reach >= percent * (F.col("n") + F.least(partner, F.col("n")))
    # Then the same bound between the distinct shapes of a group's members: few, whatever their number.
    shape = ["grp", "n", "missing", "besides"]
    shapes = members.groupBy(*shape).agg(F.count(F.lit(1)).alias("count"))
    asking = members.join(bounds, "grp").where(~F.col("linked") & admits).select(*shape, "n_leader").distinct()
    met = asking.join(shapes.select("grp", *(F.col(c).alias(f"{c}_b") for c in ("n", "missing", "besides", "count"))), "grp").where(
        f"{100 + percent} * (n_leader - greatest(missing, missing_b) + least(besides, besides_b)) >= {percent} * (n + n_b)"
        " AND (count_b > 1 OR n <> n_b OR missing <> missing_b OR besides <> besides_b)"
    )
    admitted = met.select(*shape).distinct().withColumn("open", F.lit(True))
    told = members.join(admitted, shape, "left").select(
        "set_key", "grp", (~F.col("linked") & F.coalesce("open", F.lit(False))).alias("open"), "n_leader", "missing", "besides"
    )
    none = [F.lit(0).cast("long").alias(c) for c in ("missing", "besides")]
    own = leaders.join(sizes, "set_key").select("set_key", F.col("set_key").alias("grp"), F.lit(False).alias("open"), F.col("n").alias("n_leader"), *none)
    return told.unionByName(own)


def _block_pairs(entries: DataFrame, groups: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes of different components that pass the group, size and position filters."""
    known = (
        entries.join(groups, "set_key", "left").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumns(
            {
                "grp": F.coalesce("grp", "set_key"), "open": F.coalesce("open", F.lit(False)), "component": F.coalesce("component", "set_key"),
                **{c: F.coalesce(c, F.lit(0)) for c in ("n_leader", "missing", "besides")},
            }
        )
    )
    # Lists of one component, and those of one group without an open member, can bring no new pair.
    mixed = known.groupBy("token").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.min("grp").alias("_first"), F.max("grp").alias("_last"), F.max("open").alias("_open")
    ).where("_low < _high AND (_first < _last OR _open)")
    sized = known.join(mixed.select("token"), "token", "left_semi").withColumns(
        {
            "level": F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int"),
            "depth": F.floor(F.log2(F.col("position") + 1.0)).cast("int"),
        }
    )
    cell = ["token", "level", "depth", "grp", "open"]
    counts = sized.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    member = F.struct("set_key", "n", "position", "component", "missing", "besides")
    blocks = (
        sized.join(counts, cell).withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("_blocks")))
        .groupBy(*cell, "block")
        .agg(
            F.min("position").alias("low_position"), F.min("n").alias("low_n"), F.max("n").alias("high_n"),
            F.min("missing").alias("low_missing"), F.max("besides").alias("high_besides"), F.collect_list(member).alias("members"),
        )
    )
    # Floating-point levels may be off by one at a border, so a probe looks one level further down.
    probes = sized.select(
        F.col("token"), F.explode(F.sequence(F.col("level") - 2, F.col("level"))).alias("level"), F.col("grp").alias("grp_b"), F.col("open").alias("open_b"),
        F.col("set_key").alias("b"), F.col("n").alias("n_b"), F.col("position").alias("position_b"), F.col("component").alias("component_b"),
        "n_leader", F.col("missing").alias("missing_b"), F.col("besides").alias("besides_b"),
    )

    def derived(missing: str, besides: str, n: str) -> str:
        """Another group, or what the leader's answers admit within the group."""
        most = f"n_leader - greatest(missing_b, {missing}) + least(besides_b, {besides})"
        return f"(grp <> grp_b OR ((open OR open_b) AND {100 + percent} * ({most}) >= {percent} * (n_b + {n})))"

    reachable = (
        f"{derived('low_missing', 'high_besides', 'low_n')} AND 100 * high_n >= {percent} * n_b AND low_n <= n_b"
        f" AND {percent} * (n_b + low_n) <= {100 + percent} * least(n_b - position_b, high_n - low_position)"
    )
    partner = (
        f"m.component <> component_b AND m.n <= n_b AND 100 * m.n >= {percent} * n_b"
        f" AND {percent} * (n_b + m.n) <= {100 + percent} * least(n_b - position_b, m.n - m.position)"
        f" AND {derived('m.missing', 'm.besides', 'm.n')}"
    )
    hits = probes.join(blocks, ["token", "level"]).where(reachable)
    pairs = hits.select("b", F.expr(f"inline(transform(filter(members, m -> {partner}), m -> named_struct('set_key', m.set_key)))"))
    return pairs.select(F.greatest("b", "set_key").alias("a"), F.least("b", "set_key").alias("b")).distinct()


def _components(docs: DataFrame, staging: Staging, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``row_nr, doc_id, n_shingles, set_key`` of every row, and ``set_key, n_shingles, component``."""
    spark = docs.sparkSession
    source = docs.select(F.monotonically_increasing_id().alias("row_nr"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = source.select("text")
    thin = staging.table(source.mapInArrow(P.mapper(_set_rows, width), "row_nr long, doc_id long, n_shingles long, set_key long"), "sets")
    classes = staging.table(thin.where("n_shingles > 0").select("set_key", F.col("n_shingles").alias("n")).distinct(), "classes")
    postings = thin.agg(F.sum("n_shingles")).first()[0] or 0
    parts = P.range_count(postings, int(spark.conf.get("spark.sql.shuffle.partitions")))
    frequent = P.frequent_hashes(P.sampled_texts(texts, P.SAMPLE_DOCUMENTS).mapInArrow(P.mapper(_sampled_hashes, width), "hash long"))
    packed = texts.mapInArrow(P.mapper(_packed, width, parts, frequent), P.PACKED)
    returned = staging.table(P.shared_hashes(packed, P.bucket_count(postings)), "shared")
    index = staging.table(
        P.by_document(returned)
        .join(classes.select(F.col("set_key").alias("doc_key"), "n"), "doc_key")
        .select(F.col("doc_key").alias("set_key"), "n", "hashes", "weights")
        .mapInArrow(P.mapper(_indexed, percent), _INDEXED),
        "index",
    )
    staging.drop(returned)
    sizes = index.select("set_key", F.col("first").alias("alone"))
    entries = staging.table(index.mapInArrow(_prefixes, "token long, set_key long, n long, position long").join(sizes, "set_key"), "entries")

    first = staging.table(_leader_pairs(entries), "leader-pairs")
    last = _verified(staging.table(_last_leaders(first, staging), "last-pairs"), index, percent).withColumn("last", F.lit(True))
    led = staging.table(_verified(first, index, percent).withColumn("last", F.lit(False)).unionByName(last), "led")
    labels = connected_components(led.where("linked").select("a", "b"), staging)
    groups = staging.table(_grouped(index, led, percent), "groups")
    pairs = _block_pairs(entries, groups, labels, percent)
    checked = led.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    others = staging.table(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
    linked = staging.table(_verified(others, index, percent).where("linked").select("a", "b"), "linked")
    labels = connected_components(led.where("linked").select("a", "b").unionByName(linked), staging)
    return thin, classes.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").select(
        "set_key", F.col("n").alias("n_shingles"), F.coalesce("component", "set_key").alias("component")
    )


def near_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id``, ``text``)."""
    staging = Staging(docs.sparkSession, "near-dedup")
    thin, named = _components(docs, staging, width, percent)
    of_class = thin.where("n_shingles > 0").groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("least_id"))
    found = staging.table(named.join(of_class, ["set_key", "n_shingles"]), "class-components")
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    results = staging.table(found.join(least, "component").select("set_key", "n_shingles", "component_id"), "class-results")
    return thin.join(results, ["set_key", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, the first one of equal ids."""
    (number,) = unique_names(docs.columns, "_near_row")
    staging = Staging(docs.sparkSession, "near-copies")
    thin, named = _components(docs, staging, WIDTH, PERCENT)
    order = F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"), F.col("row_nr").alias("r"))
    of_class = thin.where("n_shingles > 0").groupBy("set_key", "n_shingles").agg(F.min(order).alias("first"))
    kept = named.join(of_class, ["set_key", "n_shingles"]).groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.r").alias(number))
    kept = staging.table(kept.unionByName(thin.where("n_shingles = 0").select(F.col("row_nr").alias(number))), "kept")
    return docs.withColumn(number, F.monotonically_increasing_id()).join(kept, number, "left_semi").select(*docs.columns)
