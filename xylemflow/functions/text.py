"""Text helpers: species names, labels, slugs and object keys."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: keys tried for a species name, and object-key prefixes ------------------
NAME_KEYS = ["binomial", "scientific", "value", "name", "text"]
RAW_PREFIX = "raw-files/"
OUTPUT_PREFIX = "outputs/"
CARTRIDGE_PREFIX = "repro-cartridges/"
# --- End of fixed values ------------------------------------------------------------------


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def normalised_name(text: Column) -> Column:
    """Collapse blanks, capitalise the first letter, lower-case ASCII letters of the rest."""
    joined = F.trim(F.regexp_replace(text, r"\s+", " "))
    first = F.upper(F.substring(joined, 1, 1))
    rest = _ascii_lower(joined.substr(F.lit(2), F.length(joined)))
    return F.when(joined != "", F.concat(first, rest))


def _string_field(doc: Column, key: str) -> Column:
    """A JSON field only when its value is a string."""
    typed = F.from_json(doc, "map<string,variant>")
    field = F.try_element_at(typed, F.lit(key))
    return F.when(F.schema_of_variant(field) == "STRING", field.cast("string"))


def _name_from_object(doc: Column) -> Column:
    typed = F.from_json(doc, "map<string,variant>")
    listed = [normalised_name(_string_field(doc, key)) for key in NAME_KEYS]
    genus, species = _string_field(doc, "genus"), _string_field(doc, "species")
    parts = F.when(
        genus.isNotNull() & species.isNotNull(),
        normalised_name(F.concat_ws(" ", genus, species, _string_field(doc, "subspecies"))),
    )
    strings = F.transform(
        F.filter(
            F.array_sort(F.transform(F.map_entries(typed), lambda e: F.struct(e["key"].alias("k"), F.to_json(e["value"]).alias("v")))),
            lambda e: e["v"].startswith('"'),
        ),
        lambda e: normalised_name(
            F.get_json_object(F.concat(F.lit('{"v":'), e["v"], F.lit("}")), "$.v")
        ),
    )
    any_string = F.get(F.filter(strings, lambda s: s.isNotNull()), F.lit(0))
    return F.coalesce(*listed, parts, any_string)


def scientific_name(latin_json: Column) -> Column:
    """Scientific name from a JSON value: text, object, or the first usable item of an array."""
    doc = F.trim(latin_json)
    as_text = normalised_name(
        F.get_json_object(F.concat(F.lit('{"v":'), doc, F.lit("}")), "$.v")
    )
    items = F.transform(
        F.from_json(doc, "array<variant>"),
        lambda item: F.to_json(item),
    )
    names = F.transform(
        items,
        lambda item: F.when(
            item.startswith('"'),
            normalised_name(
                F.get_json_object(F.concat(F.lit('{"v":'), item, F.lit("}")), "$.v")
            ),
        ).when(item.startswith("{"), _name_from_object(item)),
    )
    first_item = F.get(F.filter(names, lambda n: n.isNotNull()), F.lit(0))
    return (
        F.when(doc.startswith('"'), as_text)
        .when(doc.startswith("{"), _name_from_object(doc))
        .when(doc.startswith("["), first_item)
    )


def clean(value: Column, fallback: str | None) -> Column:
    """Trimmed text, or the fallback when it is null or blank."""
    text = F.trim(value.cast("string"))
    return F.coalesce(F.when(text != "", text), F.lit(fallback).cast("string"))


def slug(value: Column) -> Column:
    dashed = F.translate(F.trim(value), "/ ", "--")
    kept = F.lower(F.regexp_replace(dashed, r"[^\p{L}\p{N}_-]", ""))
    return F.when(F.coalesce(kept, F.lit("")) == "", F.lit("unknown")).otherwise(kept)


def deployment_title(
    site: Column, zone: Column, plot: Column, logger: Column, deployment_id: Column
) -> Column:
    """Title line of one deployment; a null or empty part takes its placeholder."""

    def part(value: Column, fallback: str) -> Column:
        return F.coalesce(F.when(value != "", value), F.lit(fallback))

    return F.concat_ws(
        " | ",
        part(site, "Unknown site"),
        F.concat(F.lit("Zone "), part(zone, "Unknown zone")),
        F.concat(F.lit("Plot "), part(plot, "Unknown plot")),
        part(logger, "Logger ?"),
        F.substring(part(deployment_id, "?"), 1, 6),
    )


def panel_title(plant: Column, stem: Column, species: Column) -> Column:
    return F.concat_ws(
        " | ",
        F.concat(F.lit("Tree "), clean(plant, "?")),
        F.concat(F.lit("Stem "), clean(stem, "?")),
        clean(species, "Species ?"),
    )


def raw_file_key(file_hash: Column) -> Column:
    return F.concat(F.lit(RAW_PREFIX), file_hash)


def output_key(output_id: Column) -> Column:
    return F.concat(F.lit(OUTPUT_PREFIX), output_id, F.lit(".parquet"))


def cartridge_key(output_id: Column) -> Column:
    return F.concat(F.lit(CARTRIDGE_PREFIX), output_id, F.lit(".zip"))
