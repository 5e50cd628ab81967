"""One-to-one pairing of demand and supply units on equal keys, strict or step by step relaxed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.operators.ordered import first_per_key, hottest_group, number_rows
from fleetloom.session import hot_group_rows, materialize

# Option columns that every relaxation step starts from.
COMMON_OPTIONS = (
    "sku", "trim", "motor", "battery", "exterior", "interior", "wheels", "offroad", "atp",
    "tonneau", "build_country", "roof", "audio", "utility", "badging",
)
# Steps in order.
STEP_ORDER = (
    "exact_matches", "exterior_agnostic_grouped", "interior_agnostic_grouped", "badging_agnostic",
    "camp_speaker_agnostic", "mats_agnostic", "utility_panel_agnostic", "tonneau_agnostic",
    "audio_agnostic", "wheel_agnostic", "off_road_atp_agnostic", "accessories_agnostic",
    "powertrain_constant_ext_int_whl_grouped_accessories_agnostic",
    "powertrain_constant_ext_int_grouped_accessories_agnostic", "powertrain_constant",
)
# Steps that a run may add.
OPTIONAL_STEPS = (
    "dual_dualper_quad_agnostic", "battery_flexible", "battery_flex_ext_int_whl",
    "battery_flex_ext_int_whl_aud_roof", "battery_flex_ext_int", "exterior_interior_wheels_agnostic",
    "exterior_interior_agnostic", "exterior_agnostic", "battery_constant", "only_location_based",
)
# Attributes that the steps group or leave out.
_ACCESSORIES = ("utility", "badging")
_BODY = ("exterior", "interior", "wheels", "atp", "offroad", "roof", "audio", "utility", "badging")
_ALL_GROUPS = (
    "total_trim_agnostic", "total_motor_agnostic", "total_battery_agnostic",
    "exterior_agnostic_grouped", "interior_agnostic_grouped", "total_wheel_agnostic",
    "offroad_agnostic", "atp_agnostic", "roof_agnostic", "audio_agnostic",
    "utility_panel_agnostic", "badging_agnostic", "camp_speaker_agnostic", "mats_agnostic",
)
# Per step, the options it lets go and the grouping columns it asks for instead.
RELAXATIONS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "exact_matches": ((), ()),
    "exterior_agnostic_grouped": (("exterior",), ("exterior_agnostic_grouped",)),
    "interior_agnostic_grouped": (("interior",), ("interior_agnostic_grouped",)),
    "badging_agnostic": (("badging",), ("badging_agnostic",)),
    "camp_speaker_agnostic": ((), ("camp_speaker_agnostic",)),
    "mats_agnostic": ((), ("mats_agnostic",)),
    "utility_panel_agnostic": (("utility",), ("utility_panel_agnostic",)),
    "tonneau_agnostic": (("tonneau",), ("tonneau_agnostic",)),
    "audio_agnostic": (("audio",), ("audio_agnostic",)),
    "wheel_agnostic": (("wheels",), ("wheels_agnostic_grouped",)),
    "off_road_atp_agnostic": (("offroad", "atp"), ("offroad_agnostic", "atp_agnostic")),
    "accessories_agnostic": (_ACCESSORIES, ()),
    "powertrain_constant_ext_int_whl_grouped_accessories_agnostic": (
        ("exterior", "interior", "wheels", *_ACCESSORIES),
        ("exterior_agnostic_grouped", "interior_agnostic_grouped", "wheels_agnostic_grouped"),
    ),
    "powertrain_constant_ext_int_grouped_accessories_agnostic": (
        ("exterior", "interior", *_ACCESSORIES),
        ("exterior_agnostic_grouped", "interior_agnostic_grouped"),
    ),
    "powertrain_constant": (("trim", *_BODY), ()),
    # Optional steps, not part of STEP_ORDER.
    "dual_dualper_quad_agnostic": (("motor",), ("agnostic_motor",)),
    "battery_flexible": (("battery",), ("total_battery_agnostic",)),
    "battery_flex_ext_int_whl": (
        ("battery", "offroad", "atp", "roof", "audio", *_ACCESSORIES), ("total_battery_agnostic",)
    ),
    "battery_flex_ext_int_whl_aud_roof": (
        ("battery", "offroad", "atp", *_ACCESSORIES), ("total_battery_agnostic",)
    ),
    "battery_flex_ext_int": (
        ("battery", "offroad", "wheels", "atp", "roof", "audio", *_ACCESSORIES),
        ("total_battery_agnostic",),
    ),
    "exterior_interior_wheels_agnostic": (
        ("exterior", "interior", "wheels"),
        ("total_wheel_agnostic", "total_exterior_agnostic", "total_interior_agnostic"),
    ),
    "exterior_interior_agnostic": (
        ("exterior", "interior"), ("total_exterior_agnostic", "total_interior_agnostic")
    ),
    "exterior_agnostic": (("exterior",), ("total_exterior_agnostic",)),
    "battery_constant": (
        ("trim", "motor", *_BODY),
        ("total_trim_agnostic", "agnostic_motor", "exterior_agnostic_grouped", "interior_agnostic_grouped"),
    ),
    "only_location_based": (("trim", "motor", "battery", *_BODY), _ALL_GROUPS),
}
# Grouping columns that differ when supply ships from local centres.
LOCAL_GROUPS = {
    "utility_panel_agnostic": (),
    "tonneau_agnostic": ("utility_panel_agnostic",),
}
# Steps that ignore the centre even when shipping locally.
LOCAL_ANYWHERE = (
    "exterior_interior_wheels_agnostic", "exterior_interior_agnostic", "exterior_agnostic",
)


def step_keys(local: bool = False, order: Sequence[str] = STEP_ORDER) -> dict[str, list[str]]:
    """Key columns per step; local shipping adds the distribution centre."""
    keys = {}
    for step in order:
        dropped, groups = RELAXATIONS[step]
        if local:
            groups = LOCAL_GROUPS.get(step, groups)
        keys[step] = [c for c in COMMON_OPTIONS if c not in dropped] + list(groups)
        if local and step not in LOCAL_ANYWHERE:
            keys[step].append("distribution_center")
    return keys


def add_groups(df: DataFrame, groups: Mapping[str, tuple[str, Mapping[str, str]]]) -> DataFrame:
    """Grouping columns: name → (option column, option → group); unlisted options share a group.
    An option column of ``""`` makes the grouping constant."""
    cols: dict[str, Column] = {}
    for name, (source, mapping) in groups.items():
        group = None
        for option, label in mapping.items():
            hit = F.col(source) == option
            group = F.when(hit, label) if group is None else group.when(hit, label)
        cols[name] = F.lit("any") if group is None else group.otherwise("any")
    return df.withColumns(cols)


def match_key(cols: Sequence[str]) -> Column:
    """One comparable text per row; NULL options equal each other, as in a data-frame merge."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])


def pair_units(units: DataFrame, rows: int, keep: Sequence[str] = ()) -> DataFrame:
    """Pair the n-th demand with the n-th supply unit of the same ``_key``.

    ``units`` (``rows`` of them) has side (0 demand, 1 supply), id, ord and _key; the result
    adds ``partner``.
    """
    cols = ["side", "id", "ord", *keep]
    limit = hot_group_rows(units.sparkSession)
    if rows > limit and hottest_group(units, ["_key"]) > limit:
        ranked = number_rows(units, ["_key", "side"], ["ord", "id"], "_rank")
        nth = Window.partitionBy("_key", "_rank").orderBy("side")
    else:
        # Both numberings and the pairing share one shuffle by key.
        by_key = Window.partitionBy("_key")
        place = F.row_number().over(by_key.orderBy("side", "ord", "id"))
        demands = F.sum(1 - F.col("side")).over(by_key)
        ranked = units.withColumn("_rank", place - F.col("side") * demands)
        nth = by_key.orderBy("_rank", "side")
    ahead, behind = F.struct("_rank", "side", "id"), F.col("side") == 0
    other = F.when(behind, F.lead(ahead).over(nth)).otherwise(F.lag(ahead).over(nth))
    paired = ranked.withColumn("_other", other)
    fits = (F.col("_other._rank") == F.col("_rank")) & (F.col("_other.side") != F.col("side"))
    return paired.withColumn("partner", F.when(fits, F.col("_other.id"))).select(*cols, "partner")


def exact_match(demand: DataFrame, supply: DataFrame, key: str) -> DataFrame:
    """Each demand in order takes the first unused unit with the same key.

    Both sides have id, ord and ``key``. Supply repeats of an id count once. Returns every
    demand's id with the matched ``supply_id`` (NULL where none is left).
    """
    supply = first_per_key(supply.select("id", "ord", key), ["id"], ["ord", key])
    units = (
        demand.select(F.lit(0).alias("side"), "id", "ord", F.col(key).alias("_key"))
        .unionByName(supply.select(F.lit(1).alias("side"), "id", "ord", F.col(key).alias("_key")))
    )
    units = materialize(units.filter(F.col("_key").isNotNull()))
    paired = pair_units(units, units.count())
    found = paired.filter((F.col("side") == 0) & F.col("partner").isNotNull())
    return demand.join(
        found.select("id", F.col("partner").alias("supply_id")), "id", "left"
    )


def cascade_match(demand: DataFrame, supply: DataFrame, steps: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pair on the first step's key, then the leftovers on the next step's key, and so on.

    Both sides have id, ord and all key columns. Returns id, supply_id and match_step per
    demand; the last two are NULL for demands no step could serve.
    """
    todo: list[tuple[str, list[str]]] = []
    for name, cols in steps.items():
        # A key that contains an earlier key can find nothing the earlier step left over.
        if not any(set(earlier) <= set(cols) for _, earlier in todo):
            todo.append((name, list(cols)))
    options = sorted({c for _, cols in todo for c in cols})
    rest = (
        demand.select(F.lit(0).alias("side"), "id", "ord", *options)
        .unionByName(supply.select(F.lit(1).alias("side"), "id", "ord", *options))
    )
    rest = materialize(rest)
    found: list[DataFrame] = []
    for i, (name, cols) in enumerate(todo):
        sizes = [r["count"] for r in rest.groupBy("side").count().collect()]
        if len(sizes) < 2:
            break
        later = sorted({c for _, ks in todo[i + 1:] for c in ks})
        paired = materialize(pair_units(rest.withColumn("_key", match_key(cols)), sum(sizes), later))
        found.append(
            paired.filter((F.col("side") == 0) & F.col("partner").isNotNull())
            .select("id", F.col("partner").alias("supply_id"), F.lit(name).alias("match_step"))
        )
        rest = paired.filter(F.col("partner").isNull()).drop("partner")
    if not found:
        empty = F.lit(None).cast("string")
        return demand.select("id", empty.alias("supply_id"), empty.alias("match_step"))
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionByName(more)
    return demand.select("id").join(matches, "id", "left")
