"""Fixed column lists, types and parameter definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: canonical observation columns, in output order -------------------------
LOGGER_COLUMNS = ["timestamp", "record", "battery_voltage_v", "panel_temperature_c", "logger_id"]

METRIC_COLUMNS = [
    "alpha",
    "beta",
    "time_to_max_temp_downstream_s",
    "time_to_max_temp_upstream_s",
    "pre_pulse_temp_downstream_c",
    "max_temp_rise_downstream_c",
    "post_pulse_temp_downstream_c",
    "pre_pulse_temp_upstream_c",
    "max_temp_rise_upstream_c",
    "post_pulse_temp_upstream_c",
]

OBSERVATION_COLUMNS = (
    LOGGER_COLUMNS + ["file_hash", "sdi12_address", "thermistor_depth"] + METRIC_COLUMNS
)

CONTEXT_COLUMNS = [
    "deployment_id",
    "datalogger_id",
    "project_id",
    "site_id",
    "zone_id",
    "plot_id",
    "plant_id",
    "species_id",
    "stem_id",
    "project_code",
    "project_name",
    "site_code",
    "site_name",
    "zone_name",
    "plot_name",
    "plant_code",
    "stem_code",
    "species_code",
    "species_scientific_name",
    "deployment_start_timestamp_utc",
    "deployment_end_timestamp_utc",
]

CALCULATED_COLUMNS = [
    "vh_hrm_cm_hr",
    "vh_tmax_cm_hr",
    "vc_hrm_cm_hr",
    "vc_tmax_cm_hr",
    "j_hrm_cm_hr",
    "j_tmax_cm_hr",
    "calculation_method_used",
    "sap_flux_density_j_dma_cm_hr",
]

# Override scopes from most to least specific; the position is the precedence rank.
SCOPE_COLUMNS = [
    "deployment_id",
    "stem_id",
    "plant_id",
    "plot_id",
    "zone_id",
    "species_id",
    "site_id",
]
SCOPE_LABELS = [
    "deployment_override",
    "stem_override",
    "plant_override",
    "plot_override",
    "zone_override",
    "species_override",
    "site_override",
    "default",
]
# --- End of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Parameter:
    """One calculation or quality parameter: code, kind (float/integer/boolean/string), default."""

    code: str
    kind: str
    default: object

    @property
    def source_column(self) -> str:
        return f"parameter_source_{self.code}"


# --- Fixed values: parameter codes and defaults -------------------------------------------
PARAMETERS = [
    Parameter("parameter_thermal_diffusivity_k_cm2_s", "float", 0.002409611),
    Parameter("parameter_probe_distance_downstream_cm", "float", 0.6),
    Parameter("parameter_probe_distance_upstream_cm", "float", 0.6),
    Parameter("parameter_heat_pulse_duration_s", "float", 3.0),
    Parameter("parameter_wound_correction_a", "float", 1.8905),
    Parameter("parameter_wound_correction_b", "float", 0.0),
    Parameter("parameter_wound_correction_c", "float", 0.0),
    Parameter("parameter_wood_density_kg_m3", "float", 500.0),
    Parameter("parameter_wood_specific_heat_j_kg_c", "float", 1000.0),
    Parameter("parameter_water_content_g_g", "float", 1.0),
    Parameter("parameter_water_specific_heat_j_kg_c", "float", 4182.0),
    Parameter("parameter_water_density_kg_m3", "float", 1000.0),
    Parameter("quality_max_flux_cm_hr", "float", 40.0),
    Parameter("quality_min_flux_cm_hr", "float", -15.0),
    Parameter("quality_gap_years", "float", 2.0),
    Parameter("quality_deployment_start_grace_minutes", "float", 0.0),
    Parameter("quality_deployment_end_grace_minutes", "float", 0.0),
    Parameter("quality_future_lead_minutes", "float", 5.0),
]
# --- End of fixed values ------------------------------------------------------------------

KIND_TYPES = {"float": "double", "integer": "bigint", "boolean": "boolean", "string": "string"}

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("record", T.LongType()),
        T.StructField("battery_voltage_v", T.DoubleType()),
        T.StructField("panel_temperature_c", T.DoubleType()),
        T.StructField("logger_id", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("sdi12_address", T.StringType()),
        T.StructField("thermistor_depth", T.StringType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in METRIC_COLUMNS]
)

ALIAS_SCHEMA = "alias string, datalogger_id string, start_timestamp_utc timestamp_ntz, end_timestamp_utc timestamp_ntz"

OVERRIDE_SCHEMA = "seq bigint, code string, value string, " + ", ".join(
    f"{name} string" for name in SCOPE_COLUMNS
)
