"""Personal data, and the terms that disclose it, by DataFrame functions only.

Base spans are e-mail and IP addresses, payment-card and phone numbers. The method estimates
disclosure over the whole corpus: for an entity ``e`` and a term ``t``, the share of the information
content of ``e`` that ``t`` gives away is ``PMI(e; t) / IC(e)``, from the numbers of distinct texts
that hold ``e``, ``t`` and both, with or without an entity. A term that shares :data:`SUPPORT` texts
or more with the entity and whose share reaches :data:`DISCLOSURE` gets a ``term`` span wherever it
stands; in sanitised texts terms without digits are generalised to their class and others are
removed. Terms are whole words; a word that a base span touches is none.

The pairs of one text are counted only for entities of :data:`SUPPORT` texts or more and terms rare
enough to reach the share with them, so that no pair is lost.

Defined results: a null text is empty; repeated rows are found one by one, and equal texts count
once; all positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xylemflow.llm.staging import Staging, unique_names

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: Possessive forms that match what the plain patterns match: no class holds what follows it. A
#: match starts where the last one ended or where its first run of characters starts.
PATTERNS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Stands for letters and digits of base spans while words are cut.
MASK = "\ue000"
TERM = rf"[\p{{L}}\p{{N}}{MASK}]{{4,}}+"
SUPPORT, DISCLOSURE = 3, 0.8


def _cells(text: Column, pattern: str) -> Column:
    """Gap lengths and matches of a pattern; the last gap has no match."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    return F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))


def _positions(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``start, end`` of rows ``nr, gap, value``, by a running sum within each text and kind."""
    upto = Window.partitionBy(*keys).orderBy("nr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        cells.withColumn("end", F.sum(F.col("gap") + F.coalesce(F.length("value"), F.lit(0))).over(upto))
        .where("value IS NOT NULL").withColumn("start", F.col("end") - F.length("value")).drop("nr", "gap")
    )


def _holds() -> Column:
    digits = F.regexp_replace("value", "[^0-9]", "")
    size = F.length(digits)
    part = lambda p: F.regexp_replace(p, "^0+", "")
    low_parts = F.forall(F.split("value", r"\."), lambda p: (F.length(part(p)) <= 3) & (F.lpad(part(p), 3, "0") <= "255"))
    return (
        (F.col("kind") == 0)
        | ((F.col("kind") == 1) & low_parts)
        | ((F.col("kind") == 2) & size.between(16, 19) & F.call_function("luhn_check", digits))
        | ((F.col("kind") == 3) & size.between(8, 15))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _masked(text: Column, spans: Column) -> Column:
    """The text with the letters and digits of its sorted spans masked; lengths stay."""

    def step(done: Column, s: Column) -> Column:
        start = F.greatest(s["start"], done["at"])
        cut = F.substring(text, done["at"].cast("int") + 1, (start - done["at"]).cast("int"))
        inner = F.substring(text, start.cast("int") + 1, (s["end"] - start).cast("int"))
        moved = F.struct(s["end"].alias("at"), F.concat(done["out"], cut, F.regexp_replace(inner, r"[\p{L}\p{N}]", MASK)).alias("out"))
        return F.when(s["end"] > done["at"], moved).otherwise(done)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"].cast("int") + 1, F.length(text))))


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _term_spans(text: Column, terms: Column) -> Column:
    """Places of the words of a masked text that are among ``terms``."""

    def step(done: Column, cell: Column) -> Column:
        start = done["at"] + cell["gap"]
        end = start + F.coalesce(F.length(cell["value"]), F.lit(0))
        hit = cell["value"].isNotNull() & ~F.contains(cell["value"], F.lit(MASK)) & F.array_contains(terms, _term(cell["value"]))
        span = F.array(F.struct(F.lit(4).alias("kind"), start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(hit, F.concat(done["out"], span)).otherwise(done["out"]).alias("out"))

    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return F.aggregate(_cells(text, TERM), F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step, lambda d: d["out"])


def _disclosing_terms(scanned: DataFrame, plain: DataFrame, base: DataFrame, staging: Staging) -> DataFrame:
    """``row_nr, kind, start, end`` of the terms that give an entity away, wherever they stand.

    ``plain`` holds ``row_nr, text`` of the rows whose ``kinds`` are null in ``scanned``.
    """
    spans = base.groupBy("row_nr").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("found"))
    clear = F.translate("text", MASK, " ")
    masked = staging.table(
        scanned.where("kinds IS NOT NULL").select("row_nr", clear.alias("text")).join(spans, "row_nr", "left")
        .select("row_nr", F.when(F.col("found").isNull(), F.col("text")).otherwise(_masked(F.col("text"), F.col("found"))).alias("text")),
        "masked",
    )
    texts = plain.select("row_nr", clear.alias("text")).unionByName(masked)
    words = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))), lambda w: ~F.contains(w, F.lit(MASK)))
    bags = staging.table(texts.select("row_nr", F.array_distinct(F.transform(words, _term)).alias("terms")), "bags")

    keyed = scanned.select("row_nr", "text_key")
    groups = keyed.groupBy("text_key").agg(F.min("row_nr").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = staging.table(keyed.join(groups, "text_key").where("row_nr <> first").select("row_nr"), "copies")
    total = scanned.count() - copies.count()
    seen = base.select("row_nr", F.xxhash64("kind", F.lower("value")).alias("entity")).distinct().join(copies, "row_nr", "left_anti")
    of_entity = staging.table(
        seen.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity").between(SUPPORT, total - 1)), "entities"
    )
    # A share of DISCLOSURE needs n_term <= total^(1 - DISCLOSURE) * n_entity^DISCLOSURE, since n_both <= n_entity.
    reach = lambda n: F.pow(F.lit(float(total)), F.lit(1 - DISCLOSURE)) * F.pow(n, F.lit(DISCLOSURE)) * (1 + 1e-9)
    most = of_entity.agg(reach(F.max("n_entity"))).first()[0] or 0.0
    counted = bags.join(copies, "row_nr", "left_anti")
    of_term = staging.table(
        counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where(F.col("n_term").between(SUPPORT, most)), "term-counts"
    )
    holders = staging.table(seen.join(of_entity, "entity"), "holders")
    near = counted.join(holders.select("row_nr").distinct(), "row_nr", "left_semi").select("row_nr", F.explode("terms").alias("term")).join(of_term, "term")
    both = (
        near.join(holders, "row_nr").where(F.col("n_term") <= reach(F.col("n_entity")))
        .groupBy("entity", "term", "n_entity", "n_term").agg(F.count(F.lit(1)).alias("n_both")).where(F.col("n_both") >= SUPPORT)
    )
    share = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term"))) / F.log(F.lit(float(total)) / F.col("n_entity"))
    disclosing = staging.table(both.where(share >= DISCLOSURE).select("term").distinct(), "disclosing")
    wanted = staging.table(
        bags.select("row_nr", F.explode("terms").alias("term")).join(disclosing, "term").groupBy("row_nr").agg(F.collect_list("term").alias("terms")), "wanted"
    )
    staging.drop(bags, copies, of_entity, of_term, holders, disclosing)
    found = texts.join(wanted, "row_nr").select("row_nr", F.inline(_term_spans(F.col("text"), F.col("terms"))))
    spans = staging.table(found, "term-spans")
    staging.drop(masked, wanted)
    return spans


def find_private_data(docs: DataFrame) -> DataFrame:
    """``row_nr, doc_id, base, spans`` of every row of ``docs``: arrays of ``kind, start, end``.

    ``kind`` counts :data:`KINDS`; ``base`` is null or empty where a text has none, ``spans`` holds all.
    ``docs`` must be a plain scan.
    """
    staging = Staging(docs.sparkSession, "private-data")
    source = docs.select(
        F.monotonically_increasing_id().alias("row_nr"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_key", F.md5(F.col("text").cast("binary")))
    signs = ("@", ".", "", "+")
    kinds = [
        F.struct(F.lit(k).alias("kind"), F.when(F.contains("text", F.lit(sign)) & F.col("text").rlike("[0-9]" if k else "@"), _cells(F.col("text"), p)).alias("cells"))
        for k, (sign, p) in enumerate(zip(signs, PATTERNS))
    ]
    searched = source.withColumn("kinds", F.array(*kinds))
    some = F.coalesce(F.exists("kinds", lambda k: F.size(k["cells"]) > 1), F.lit(False))
    scanned = staging.table(
        searched.select("row_nr", "doc_id", F.when(some, F.col("text")).alias("text"), "text_key", F.when(some, F.col("kinds")).alias("kinds")), "scanned"
    )
    plain = searched.where(~some).select("row_nr", "text")
    cells = scanned.where("kinds IS NOT NULL").select("row_nr", F.inline("kinds")).select("row_nr", "kind", F.posexplode("cells").alias("nr", "cell")).select(
        "row_nr", "kind", "nr", "cell.gap", "cell.value"
    )
    base = staging.table(_positions(cells, ["row_nr", "kind"]).where(_holds()), "base")
    added = _disclosing_terms(scanned, plain, base, staging)
    spans = base.select("row_nr", "kind", "start", "end").unionByName(added)
    span = F.struct("kind", "start", "end")
    of_row = spans.groupBy("row_nr").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return scanned.join(of_row, "row_nr", "left").select(
        "row_nr", "doc_id", F.filter("spans", lambda s: s["kind"] < 4).alias("base"), "spans"
    )


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`find_private_data` rows."""
    base = F.coalesce("base", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))
    spans = F.coalesce("spans", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *map(count, range(4)), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def sanitised_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with each span's text replaced by its class, terms with digits removed; ``docs`` a plain scan."""
    row, spans = unique_names(docs.columns, "_row", "_spans")
    found = find_private_data(docs).where("spans IS NOT NULL").select(F.col("row_nr").alias(row), F.col("spans").alias(spans))
    own = F.coalesce("text", F.lit(""))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def step(done: Column, s: Column) -> Column:
        cut = F.substring(own, done["at"].cast("int") + 1, (s["start"] - done["at"]).cast("int"))
        inner = F.substring(own, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))
        sign = F.when((s["kind"] == 4) & inner.rlike("[0-9]"), F.lit("")).otherwise(F.get(names, s["kind"]))
        moved = F.struct(s["end"].alias("at"), F.concat(done["out"], cut, sign).alias("out"))
        return F.when(s["start"] >= done["at"], moved).otherwise(done)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.aggregate(by_place, start, step, lambda d: F.concat(d["out"], F.substring(own, d["at"].cast("int") + 1, F.length(own))))
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(found, row, "left")
    values = {"text": F.when(F.col(spans).isNull(), F.col("text")).otherwise(text)}
    return joined.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
