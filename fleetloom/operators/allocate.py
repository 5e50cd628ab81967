"""Build-to-stock allocation: extra units go, one by one, to the scarcest configuration.

Adding the j-th unit (j = 0, 1, …) to a configuration happens at level (net + j) / velocity,
and levels rise with j. Handing N units to the lowest level each time therefore picks the N
lowest (level, tie-break) pairs over all configurations and j. Two water levels per model
bound that set from running totals: every pair up to the lower level is certain, no pair above
the upper one is taken, and only about one pair per configuration in between is ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.operators.ordered import number_rows
from fleetloom.session import materialize


def allocate_units(state: DataFrame, plan: DataFrame) -> DataFrame:
    """Units added per configuration.

    ``state`` has config_string, model_powertrain, net_supply, velocity (> 0) and report_dos;
    ``plan`` has model_powertrain and units. Ties on the level go to the lower ``report_dos``,
    then to the lower configuration key.
    """
    levels = materialize(
        state.join(plan.filter(F.col("units") > 0), "model_powertrain").withColumn(
            "start", F.col("net_supply") / F.col("velocity")
        )
    )
    summed = number_rows(
        levels, ["model_powertrain"], ["start", "config_string"], "k",
        {"cum_net": "net_supply", "cum_velocity": "velocity"},
    )
    # Pouring N units over the k scarcest configurations reaches (N + sum(net)) / sum(velocity);
    # the minimum over k is where the water stands. Counting whole units, k of them may be
    # partly filled, which lowers the level that is certainly reached.
    water = summed.groupBy("model_powertrain").agg(
        F.min((F.col("units") + F.col("cum_net")) / F.col("cum_velocity")).alias("high"),
        F.min((F.col("units") + F.col("cum_net") - F.col("k")) / F.col("cum_velocity")).alias("low"),
    )

    def filled(level: str):
        return F.floor(F.col("velocity") * F.col(level) - F.col("net_supply"))

    # One unit of slack on both sides keeps rounding in the products harmless.
    bounded = levels.join(water, "model_powertrain").withColumns(
        {"sure": F.greatest(filled("low"), F.lit(0)), "last": filled("high") + 1}
    )
    open_units = bounded.filter(F.col("last") >= F.col("sure")).select(
        "model_powertrain", "config_string", "net_supply", "velocity", "report_dos",
        F.explode(F.sequence("sure", "last")).alias("j"),
    ).withColumn("level", (F.col("j") + F.col("net_supply")) / F.col("velocity"))
    ranked = number_rows(
        open_units, ["model_powertrain"], ["level", "report_dos", "config_string", "j"], "place"
    )
    left = bounded.groupBy("model_powertrain").agg(
        (F.first("units") - F.sum("sure")).alias("left")
    )
    won = (
        ranked.join(left, "model_powertrain")
        .filter(F.col("place") <= F.col("left"))
        .groupBy("config_string")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    added = bounded.join(won, "config_string", "left").withColumn(
        "added_volume", F.col("sure") + F.coalesce("won", F.lit(0))
    )
    return added.withColumn("new_net_supply", F.col("added_volume") + F.col("net_supply")).select(
        "config_string", "model_powertrain", "net_supply", "velocity", "report_dos", "added_volume",
        "new_net_supply", (F.col("new_net_supply") / F.col("velocity")).alias("new_dos"),
    )


def apportion_units(weights: DataFrame, plan: DataFrame) -> DataFrame:
    """Planned units split by take rate, in whole units that add up to the plan (largest remainder).

    ``weights`` has config_string, model_powertrain and ``weight`` (a whole number, e.g. orders); its share
    of the model's total is the take rate. A model without any weight is split evenly. Equal remainders go
    to the lower configuration key.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0)).cast("decimal(19,0)")
    shares = materialize(
        weights.select("config_string", "model_powertrain", weight.alias("weight"))
        .join(plan.filter(F.col("units") > 0), "model_powertrain")
    )
    totals = shares.groupBy("model_powertrain").agg(
        F.sum("weight").cast("decimal(19,0)").alias("_total"), F.count(F.lit(1)).alias("_n"))
    split = shares.join(totals, "model_powertrain").withColumns({
        "_part": F.col("units").cast("decimal(18,0)") * F.when(F.col("_total") > 0, F.col("weight")).otherwise(F.lit(1).cast("decimal(19,0)")),
        "_whole": F.when(F.col("_total") > 0, F.col("_total")).otherwise(F.col("_n").cast("decimal(19,0)")),
    }).withColumns({"_sure": F.expr("_part div _whole"), "_rest": F.expr("-(_part % _whole)")})
    ranked = number_rows(split, ["model_powertrain"], ["_rest", "config_string"], "_place")
    left = split.groupBy("model_powertrain").agg((F.min("units") - F.sum("_sure")).alias("_left"))
    added = F.col("_sure") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)
    return ranked.join(left, "model_powertrain").select(
        "config_string", "model_powertrain", F.col("weight").cast("long").alias("weight"), added.cast("long").alias("added_volume")
    )


def allocate_or_apportion(state: DataFrame, plan: DataFrame) -> DataFrame:
    """Units per configuration: to the scarcest ones, or by take rate for models without any supply.

    ``state`` has ``supply`` and ``demand`` besides what ``allocate_units`` needs.
    """
    stocked = materialize(
        state.groupBy("model_powertrain").agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("_s"))
        .filter("_s > 0").select("model_powertrain")
    )
    filled = allocate_units(state, plan.join(stocked, "model_powertrain", "left_semi"))
    rated = apportion_units(
        state.withColumn("weight", F.col("demand")), plan.join(stocked, "model_powertrain", "left_anti"))
    columns = ["config_string", "model_powertrain", "added_volume"]
    return filled.select(*columns).unionByName(rated.select(*columns))


def unplaced_units(state: DataFrame, plan: DataFrame) -> DataFrame:
    """Planned units of models without any configuration to put them on."""
    return plan.filter(F.col("units") > 0).join(
        state.select("model_powertrain").distinct(), "model_powertrain", "left_anti"
    )


def expand_units(df: DataFrame, n_col: str = "added_volume") -> DataFrame:
    """One row per unit, numbered 1 … n."""
    return df.filter(F.col(n_col) > 0).withColumn(
        "unit", F.explode(F.sequence(F.lit(1).cast("long"), F.col(n_col).cast("long")))
    )


def covered_counts(planned: DataFrame, stock: DataFrame, compliant: DataFrame, block: Column, n_col: str = "added_volume") -> DataFrame:
    """``planned`` (one row per configuration) with ``covered``: how many of its units get a vehicle.

    Counts are enough. Units take vehicles of their own configuration first; of what is left, units of a
    block in order of their configuration take any unused compliant vehicle of the block (by similarity,
    but some vehicle is always the most similar one), so the first as many as there are vehicles get one.
    ``stock`` has config_string and n, ``compliant`` config_string; ``block`` is an expression over it.
    """
    wanted = materialize(
        planned.filter(F.col(n_col) > 0).join(stock, "config_string", "left")
        .withColumn("exact", F.least(F.col(n_col), F.coalesce("n", F.lit(0)))).drop("n")
        .withColumns({"open": F.col(n_col) - F.col("exact"), "block": block, "ord": F.concat("config_string", F.lit("#"))})
    )
    unused = (
        stock.join(compliant.select("config_string").distinct(), "config_string", "left_semi")
        .join(wanted.select("config_string", "exact"), "config_string", "left")
        .groupBy(block.alias("block")).agg(F.sum(F.col("n") - F.coalesce("exact", F.lit(0))).alias("unused"))
    )
    turns = number_rows(wanted, ["block"], ["ord"], "_n", {"upto": "open"}).join(unused, "block", "left")
    before = F.col("upto") - F.col("open")
    close = F.least(F.greatest(F.coalesce("unused", F.lit(0)) - before, F.lit(0)), F.col("open"))
    return turns.withColumn("covered", F.col("exact") + close).select(*planned.columns, "covered")
