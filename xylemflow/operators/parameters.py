"""Calculation parameters through the override hierarchy, with provenance.

Overrides are resolved once per distinct scope (deployment, stem, plant, ...), never per
observation. Each override is indexed under its most specific scope id and met by an equi
join; its other scope ids are residual conditions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.values import json_to_kind
from xylemflow.schema import KIND_TYPES, PARAMETERS, SCOPE_COLUMNS, SCOPE_LABELS, Parameter

EVERYWHERE = len(SCOPE_COLUMNS)  # rank of an override without any scope


def precedence() -> Column:
    """Rank of the most specific scope id that is set; lower wins."""
    cases = " ".join(f"WHEN {c} IS NOT NULL THEN {i}" for i, c in enumerate(SCOPE_COLUMNS))
    return F.expr(f"CASE {cases} ELSE {EVERYWHERE} END")


def provenance_label(rank: str) -> str:
    labels = ", ".join(f"'{label}'" for label in SCOPE_LABELS)
    return f"element_at(array({labels}), {rank} + 1)"


def ranked_overrides(overrides: DataFrame) -> DataFrame:
    """Overrides keyed by their most specific scope id, first one per code and scope set."""
    ids = [f"CAST({c} AS STRING) AS {c}" for c in SCOPE_COLUMNS]
    anchor = f"CAST(coalesce({', '.join(SCOPE_COLUMNS)}, '*') AS STRING) AS _anchor"
    ranked = overrides.selectExpr("code", "value", "seq", *ids, anchor).withColumn(
        "_rank", precedence()
    )
    return ranked.groupBy("code", "_rank", "_anchor", *SCOPE_COLUMNS).agg(
        F.expr("min(seq) AS seq"), F.expr("min_by(struct(value), seq).value AS value")
    )


def override_matches(scopes: DataFrame, overrides: DataFrame) -> DataFrame:
    """All (scope, override) pairs that apply: every scope id the override sets must be equal."""
    anchors = [
        f"struct({i} AS rank, CAST({c} AS STRING) AS anchor)" for i, c in enumerate(SCOPE_COLUMNS)
    ] + [f"struct({EVERYWHERE} AS rank, '*' AS anchor)"]
    probes = scopes.selectExpr(
        *SCOPE_COLUMNS,
        f"inline(filter(array({', '.join(anchors)}), a -> a.anchor IS NOT NULL))",
    )
    residual = " AND ".join(
        f"(o.{c} IS NULL OR o.{c} = CAST(s.{c} AS STRING))" for c in SCOPE_COLUMNS
    )
    condition = F.expr(f"s.rank = o._rank AND s.anchor = o._anchor AND {residual}")
    return (
        probes.alias("s")
        .join(ranked_overrides(overrides).alias("o"), condition)
        .selectExpr(*[f"s.{c}" for c in SCOPE_COLUMNS], "o.code", "o.value", "o.seq", "o._rank")
    )


def default_value(parameter: Parameter) -> Column:
    return F.lit(parameter.default).cast(KIND_TYPES[parameter.kind])


def resolve_scopes(
    scopes: DataFrame, overrides: DataFrame, definitions: Sequence[Parameter] = PARAMETERS
) -> DataFrame:
    """One row per distinct scope with value and source of every parameter.

    The winner is the override with the lowest (rank, seq). A winning value that cannot be
    converted gives null, not the default.
    """
    distinct = scopes.select(*SCOPE_COLUMNS).distinct()
    kinds = sorted({p.kind for p in definitions})
    typed = override_matches(distinct, overrides).select(
        *SCOPE_COLUMNS,
        "code",
        F.expr("struct(_rank, seq) AS _order"),
        F.struct(
            F.expr(f"{provenance_label('_rank')} AS source"),
            *[json_to_kind(F.col("value"), kind).alias(kind) for kind in kinds],
        ).alias("_won"),
    )
    winners = typed.groupBy(*SCOPE_COLUMNS, "code").agg(F.min_by("_won", "_order").alias("_won"))
    # One entry per code, so the collected list is bounded by the number of parameters.
    by_code = winners.groupBy(*SCOPE_COLUMNS).agg(
        F.expr("map_from_entries(collect_list(struct(code, _won))) AS _by_code")
    )
    joined = distinct.alias("s").join(by_code.alias("w"), same_scope("s", "w"), "left")
    columns = []
    for p in definitions:
        won = f"w._by_code['{p.code}']"
        fallback = f"CAST('{p.default}' AS {KIND_TYPES[p.kind]})"
        columns.append(f"CASE WHEN {won} IS NULL THEN {fallback} ELSE {won}.{p.kind} END AS {p.code}")
        columns.append(f"coalesce({won}.source, '{SCOPE_LABELS[EVERYWHERE]}') AS {p.source_column}")
    return joined.selectExpr(*[f"s.{c}" for c in SCOPE_COLUMNS], *columns)


def same_scope(left: str, right: str) -> Column:
    """Null-safe equality of all scope ids."""
    return F.expr(" AND ".join(f"{left}.{c} <=> {right}.{c}" for c in SCOPE_COLUMNS))


def parameter_columns(definitions: Sequence[Parameter] = PARAMETERS) -> list[str]:
    return [name for p in definitions for name in (p.code, p.source_column)]


def resolve_parameters(
    observations: DataFrame,
    overrides: DataFrame,
    definitions: Sequence[Parameter] = PARAMETERS,
) -> DataFrame:
    """Add value and source columns for every definition; missing scope columns count as null."""
    if not definitions:
        return observations
    absent = [c for c in SCOPE_COLUMNS if c not in observations.columns]
    source = observations
    for c in absent:
        source = source.withColumn(c, F.lit(None).cast("string"))
    resolved = resolve_scopes(source, overrides, definitions).alias("p")
    return source.alias("o").join(resolved, same_scope("o", "p")).select(
        *[f"o.{c}" for c in observations.columns],
        *[f"p.{c}" for c in parameter_columns(definitions)],
    )


def with_defaults(
    df: DataFrame, definitions: Sequence[Parameter] = PARAMETERS
) -> DataFrame:
    """Attach every parameter at its default."""
    values = {}
    for p in definitions:
        values[p.code] = default_value(p)
        values[p.source_column] = F.lit(SCOPE_LABELS[EVERYWHERE])
    return df.withColumns(values)
