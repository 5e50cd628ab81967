"""The composite configuration key: encode, decode, roll forward, remap, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order of the parts in a configuration key.
CONFIG_PARTS = (
    "model_year", "country", "model_powertrain", "paint_id", "interior_id", "wheels_id",
    "audio_id", "roof_id", "tonneau_id", "accents_and_badging_id", "utility_panel_id",
)
# Option prefix in the key → attribute it names.
OPTION_PREFIXES = {
    "EXP": "exterior",
    "INT": "interior",
    "WHL": "wheels",
    "AUD": "audio",
    "ROOF": "roof",
    "TON": "tonneau",
    "ACTBDG": "badging",
    "UTL": "utility",
}
# An instruction also names the camp speaker, which few keys hold.
INSTRUCTION_PREFIXES = OPTION_PREFIXES | {"SPKR": "camp_speaker"}
# Country code in the key → region code.
REGION_CODES = {"US": "RGN-USA", "CA": "RGN-CAN"}
# Wheel sets that come with the all-terrain package.
ATP_WHEELS = ("WHL-0AD", "WHL-0A1", "WHL-0DN", "WHL-0DD")


def encode_config(cols: Sequence[str] = CONFIG_PARTS, sep: str = "_") -> Column:
    """Joined key; any NULL part makes the whole key NULL."""
    pieces: list[Column] = []
    for c in cols:
        pieces += [F.lit(sep), F.col(c)] if pieces else [F.col(c)]
    return F.concat(*pieces)


def short_config(cols: Sequence[str]) -> Column:
    return encode_config(cols, " | ")


def region_code(country: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in REGION_CODES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, country), F.concat(F.lit("RGN-"), country))


def decode_config(
    col: str, prefixes: Mapping[str, str] = OPTION_PREFIXES, sep: str = "_", strict: bool = True,
    options_from: int = 3,
) -> dict[str, Column]:
    """Positional year, country and model plus prefixed options; the last matching part wins.

    ``strict`` asks for ``PREFIX-``; otherwise the bare prefix is enough. Options may be looked
    for in every part (``options_from=0``) or only behind the positional ones.
    """
    parts = F.split(F.col(col), sep)
    tail = F.slice(parts, options_from + 1, F.greatest(F.size(parts) - options_from, F.lit(0)))
    out = {
        "model_year": F.get(parts, 0),
        "country": F.get(parts, 1),
        "model_powertrain": F.get(parts, 2),
    }
    for prefix, name in prefixes.items():
        mark = prefix + ("-" if strict else "")
        out[name] = F.try_element_at(F.filter(tail, _starts_with(mark)), F.lit(-1))
    return out


def _starts_with(mark: str):
    return lambda part: part.startswith(mark)


def model_words(col: Column, n: int = 3) -> Column:
    """``A B C D`` → ``A_B_C``."""
    return F.array_join(F.slice(F.split(col, " "), 1, n), "_")


def atp_for_wheels(wheels: Column, atp_wheels: Sequence[str] = ATP_WHEELS) -> Column:
    return F.when(wheels.isin(*atp_wheels), "ATP-001").otherwise("ATP-NULL")


def build_option_id(
    by_model_powertrain: Mapping[str, str], paint_override: Mapping[tuple[str, str], str]
) -> Column:
    """Build option by model and powertrain; a (model, paint) override beats it."""
    branches = [
        ((F.col("model") == model) & (F.col("paint_id") == paint), option)
        for (model, paint), option in paint_override.items()
    ] + [(F.col("model_powertrain") == mp, option) for mp, option in by_model_powertrain.items()]
    out = None
    for hit, option in branches:
        out = F.when(hit, option) if out is None else out.when(hit, option)
    return F.lit(None).cast("string") if out is None else out


def roll_model_year(
    col: str, port: str | None = "charging_port_id", port_value: str = "CHRG-NACS01",
    old: str = "2025", new: str = "2026",
) -> Column:
    """Move a key or year to the next model year, for units with the new port (or all of them)."""
    rolled = F.replace(F.col(col), F.lit(old), F.lit(new))
    return rolled if port is None else F.when(F.col(port) == port_value, rolled).otherwise(F.col(col))


@dataclass(frozen=True)
class RemapRules:
    """Option substitutions between two model years (all values are data of the caller)."""

    old_year: str = "2025"
    new_year: str = "2026"
    interior: Mapping[str, str] = field(default_factory=dict)
    premium_powertrains: Sequence[str] = ()
    premium_wheels: Mapping[str, str] = field(default_factory=dict)
    sound_package: tuple[str, str] = ("AUD-P01", "ROOF-DGP")
    tonneau_models: Sequence[str] = ()
    tonneau: Mapping[str, str] = field(default_factory=lambda: {"TON-P01": "TON-P02"})
    tonneau_new: str = "TON-P02"
    badging: Mapping[str, str] = field(default_factory=dict)
    base_configs: Sequence[str] = ()
    base_utility: str = "UTL-NULL"
    utility: Mapping[str, str] = field(default_factory=dict)


def _swap(col: Column, values: Mapping[str, str], otherwise: Column) -> Column:
    out = None
    for old, new in values.items():
        out = F.when(col == old, new) if out is None else out.when(col == old, new)
    return otherwise if out is None else out.otherwise(otherwise)


def remap_options(rules: RemapRules) -> dict[str, Column]:
    """The eight substitutions; every condition reads the values before the remap."""
    powertrain, mp = F.col("powertrain"), F.col("model_powertrain")
    premium = powertrain.isin(*rules.premium_powertrains)
    audio, roof = rules.sound_package
    packaged = premium & ((F.col("audio_id") == audio) | (F.col("roof_id") == roof))
    wheels = F.col("wheels_id")
    return {
        "model_year": F.replace(F.col("model_year"), F.lit(rules.old_year), F.lit(rules.new_year)),
        "interior_id": _swap(F.col("interior_id"), rules.interior, F.col("interior_id")),
        "wheels_id": F.when(premium, _swap(wheels, rules.premium_wheels, wheels)).otherwise(wheels),
        "audio_id": F.when(packaged, audio).otherwise(F.col("audio_id")),
        "roof_id": F.when(packaged, roof).otherwise(F.col("roof_id")),
        "tonneau_id": F.when(mp.isin(*rules.tonneau_models), rules.tonneau_new).otherwise(
            _swap(F.col("tonneau_id"), rules.tonneau, F.col("tonneau_id"))
        ),
        "accents_and_badging_id": _swap(powertrain, rules.badging, F.col("accents_and_badging_id")),
        "utility_panel_id": F.when(
            F.col("config_string").isin(*rules.base_configs), rules.base_utility
        ).otherwise(_swap(mp, rules.utility, F.col("utility_panel_id"))),
    }


def remap_config(orders: DataFrame, rules: RemapRules) -> DataFrame:
    """Distinct map from each configuration of the old year to its successor and attributes."""
    source = ["config_string", "powertrain", *CONFIG_PARTS]
    # Distinct before the rules run: the shuffle carries configurations, not orders.
    known = (
        orders.filter((F.col("model_year") == rules.old_year) & F.col("config_string").isNotNull())
        .select(*source)
        .distinct()
    )
    mapped = known.withColumns(remap_options(rules))
    return mapped.select(
        F.col("config_string").alias("config_string_original"),
        encode_config().alias("mapped_config_string"),
        *CONFIG_PARTS,
    ).distinct()


def blank_unchanged(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Suggested options that equal the original become NULL, so only changes remain."""
    return df.withColumns({new: F.nullif(F.col(new), F.col(old)) for new, old in pairs.items()})
