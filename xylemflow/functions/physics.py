"""Heat-pulse sap-flow formulas as SQL expression text.

Arguments are column names or expressions. Division is ``try_divide``: a zero denominator
gives null instead of an error.
"""

from __future__ import annotations

SECONDS_PER_HOUR = "3600D"
METRES_PER_CM = "0.01D"


def heat_ratio_velocity(k: str, alpha: str, downstream: str, upstream: str) -> str:
    """Velocity in cm/h from the log ratio of the temperature rises."""
    return f"try_divide(2D * {k} * {alpha}, {downstream} + {upstream}) * {SECONDS_PER_HOUR}"


def time_to_max_velocity(k: str, pulse: str, peak: str, downstream: str) -> str:
    """Velocity in cm/h from the time of the downstream maximum; null where it is undefined."""
    decay = f"ln(1D - try_divide({pulse}, {peak}))"
    inside = f"(try_divide(4D * {k}, {pulse}) * {decay} + {downstream} * {downstream})"
    return (
        f"CASE WHEN {peak} > {pulse} AND {peak} > 0D AND NOT isnan({peak})"
        f" AND NOT isnan({decay}) AND abs({decay}) < double('inf') AND {inside} > 0D"
        f" THEN try_divide(sqrt({inside}), {peak} * ({peak} - {pulse})) * {SECONDS_PER_HOUR} END"
    )


def wound_corrected(v: str, a: str, b: str, c: str) -> str:
    return f"{a} * {v} + {b} * ({v} * {v}) + {c} * ({v} * {v} * {v})"


def flux_density(
    velocity: str,
    wood_density: str,
    wood_heat: str,
    water_content: str,
    water_heat: str,
    water_density: str,
) -> str:
    """Sap flux density in cm/h from corrected velocity and wood and water properties."""
    metres = f"{velocity} * {METRES_PER_CM} / {SECONDS_PER_HOUR}"
    numerator = f"{metres} * {wood_density} * ({wood_heat} + {water_content} * {water_heat})"
    return (
        f"try_divide({numerator}, {water_density} * {water_heat})"
        f" * {SECONDS_PER_HOUR} / {METRES_PER_CM}"
    )
