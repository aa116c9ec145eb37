"""Dual-method sap flux density: heat ratio below the Péclet switch, time-to-maximum above."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.functions import physics

HRM, TMAX = "HRM", "Tmax"
COMPLETE = "_complete"

REQUIRED = [
    "alpha",
    "beta",
    "parameter_heat_pulse_duration_s",
    "parameter_thermal_diffusivity_k_cm2_s",
    "parameter_probe_distance_downstream_cm",
    "parameter_probe_distance_upstream_cm",
    "parameter_wound_correction_a",
    "parameter_wound_correction_b",
    "parameter_wound_correction_c",
    "parameter_wood_density_kg_m3",
    "parameter_wood_specific_heat_j_kg_c",
    "parameter_water_content_g_g",
    "parameter_water_specific_heat_j_kg_c",
    "parameter_water_density_kg_m3",
]


def _wounded(velocity: str) -> str:
    return physics.wound_corrected(velocity, *[f"parameter_wound_correction_{k}" for k in "abc"])


def _flux(velocity: str) -> str:
    return physics.flux_density(
        velocity,
        "parameter_wood_density_kg_m3",
        "parameter_wood_specific_heat_j_kg_c",
        "parameter_water_content_g_g",
        "parameter_water_specific_heat_j_kg_c",
        "parameter_water_density_kg_m3",
    )


def apply_dma_peclet(df: DataFrame) -> DataFrame:
    """Add both velocities, their corrections and fluxes, the method and the chosen flux.

    If any required input is null, all eight results are null; only the peak time may be
    null, which leaves the time-to-maximum branch empty. One step per line of the
    calculation, so that no formula is evaluated twice.
    """
    k = "parameter_thermal_diffusivity_k_cm2_s"
    down = "parameter_probe_distance_downstream_cm"
    up = "parameter_probe_distance_upstream_cm"
    pulse = "parameter_heat_pulse_duration_s"
    peak = "time_to_max_temp_downstream_s"
    complete = " AND ".join(f"{name} IS NOT NULL" for name in REQUIRED)
    hrm = physics.heat_ratio_velocity(k, "alpha", down, up)
    tmax = physics.time_to_max_velocity(k, pulse, peak, down)
    steps = [
        {COMPLETE: complete},
        {
            "vh_hrm_cm_hr": f"CASE WHEN {COMPLETE} THEN {hrm} END",
            "vh_tmax_cm_hr": f"CASE WHEN {COMPLETE} THEN {tmax} END",
        },
        {
            "vc_hrm_cm_hr": _wounded("vh_hrm_cm_hr"),
            "vc_tmax_cm_hr": _wounded("vh_tmax_cm_hr"),
        },
        {"j_hrm_cm_hr": _flux("vc_hrm_cm_hr"), "j_tmax_cm_hr": _flux("vc_tmax_cm_hr")},
        {
            "calculation_method_used": f"CASE WHEN {COMPLETE} THEN "
            f"CASE WHEN beta <= 1D THEN '{HRM}' ELSE '{TMAX}' END END",
            "sap_flux_density_j_dma_cm_hr": f"CASE WHEN {COMPLETE} THEN "
            "CASE WHEN beta <= 1D THEN j_hrm_cm_hr ELSE j_tmax_cm_hr END END",
        },
    ]
    result = df
    for step in steps:
        result = result.withColumns({name: F.expr(text) for name, text in step.items()})
    return result.drop(COMPLETE)
