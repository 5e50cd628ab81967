"""Most similar configuration, without and with consumption of the supply.

Scores depend on texts only, so they are computed on distinct texts. Both sides are cut into
chunks of a fixed size inside each block; a pair of chunks is a tile, one row, and tiles are
spread evenly over tasks whatever the size of the block. A tile returns only the candidates
that can still matter, so the pairs of a block are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.functions.text import SCORERS, clean, levenshtein_score, overlap_bounds, rounded_score
from fleetloom.operators.ordered import number_rows
from fleetloom.session import materialize, shuffle_partitions

# Long right chunks prune better, short left chunks spread the work better.
LEFT_CHUNK, RIGHT_CHUNK = 8, 1024
# Tiles per task: bounds the Arrow batches that tasks hold.
TASK_TILES = 16
HOT_CHUNKS, SPREAD = 256, 32
# Rows (demands and options) per group of picking demands, give or take one chunk.
GROUP_ROWS = 20_000
HITS = "array<struct<text:string, other:string, score:int>>"


def _chunks(texts: DataFrame, size: int, name: str, weight: str) -> DataFrame:
    """Rows (block, chunk, list of ``size`` (text, weight))."""
    numbered = number_rows(texts, ["block"], ["text"], "_n")
    chunk = F.floor((F.col("_n") - 1) / size)
    return materialize(
        numbered.groupBy("block", chunk.alias(f"{name}_chunk")).agg(
            F.collect_list(F.struct("text", F.col(weight).alias("weight"))).alias(name)
        )
    )


def _tiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """left (block, text, need) × right (block, text, capacity), chunk by chunk."""
    spark = left.sparkSession
    ls = _chunks(left, LEFT_CHUNK, "l", "need")
    rs = _chunks(right, RIGHT_CHUNK, "r", "capacity")
    per_block = ls.groupBy("block").agg(F.count(F.lit(1)).alias("a")).join(
        rs.groupBy("block").agg(F.count(F.lit(1)).alias("b")), "block"
    )
    most, tiles = per_block.agg(F.max("a"), F.sum(F.col("a") * F.col("b"))).first()
    if (most or 0) > HOT_CHUNKS:
        ls = ls.withColumn("_salt", F.col("l_chunk") % SPREAD)
        rs = rs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        pairs = ls.join(rs, ["block", "_salt"])
    else:
        pairs = ls.join(rs, "block")
    # A fixed number of partitions: tiles are small in bytes but heavy to score, so they must
    # not be coalesced.
    tasks = max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism, (tiles or 0) // TASK_TILES)
    return pairs.repartition(tasks, "block", "l_chunk", "r_chunk").select("block", "l", "r")


def _shortlist(scorer: str):
    """Per left text, the right texts whose better-scored ones cannot cover its need."""
    against, bounded = SCORERS[scorer], scorer == "ratio"

    @F.pandas_udf(HITS)
    def shortlist(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lefts, rights in batches:
            yield pd.Series([_tile_hits(l, r, against, bounded) for l, r in zip(lefts, rights)])

    return shortlist


def _tile_hits(lefts, rights, against, bounded: bool) -> list[dict]:
    others = [clean(r["text"]) for r in rights]
    scores = [against(o) for o in others]
    texts = [clean(left["text"]) for left in lefts]
    all_bounds = overlap_bounds(texts, others).tolist() if bounded else [[100] * len(others)] * len(texts)
    hits = []
    for left, text, bounds in zip(lefts, texts, all_bounds):
        need = left["weight"]
        supply = [0] * 101  # capacity seen per score
        seen: list[tuple[int, int]] = []
        for i in sorted(range(len(others)), key=lambda i: -bounds[i]):
            if sum(supply[bounds[i] + 1:]) >= need:
                break  # whatever is left scores lower than enough others
            score = scores[i](text)
            supply[score] += rights[i]["weight"]
            seen.append((score, i))
        covered, level = 0, None
        for score, i in sorted(seen, reverse=True):
            if score != level and covered >= need:
                break
            level = score
            covered += rights[i]["weight"]
            hits.append({"text": left["text"], "other": rights[i]["text"], "score": score})
    return hits


def candidates(left: DataFrame, right: DataFrame, scorer: str) -> DataFrame:
    """(block, text, other, score): per left text all right texts at the score levels needed
    until their capacity covers ``need``; every level is complete."""
    tiles = _tiles(left, right)
    hits = tiles.select("block", F.inline(_shortlist(scorer)("l", "r")))
    scored = hits.join(
        right.select("block", F.col("text").alias("other"), "capacity"), ["block", "other"]
    ).join(left.select("block", "text", "need"), ["block", "text"])
    return _cut_levels(materialize(scored), "need")


def _cut_levels(scored: DataFrame, need: str) -> DataFrame:
    """Keep the score levels before which the better ones do not yet cover ``need``.

    There are at most 101 levels per text, so the window below is small by construction.
    """
    better = Window.partitionBy("block", "text").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    levels = (
        scored.groupBy("block", "text", "score")
        .agg(F.sum("capacity").alias("capacity"), F.first(need).alias("need"))
        .withColumn("before", F.coalesce(F.sum("capacity").over(better), F.lit(0)))
        .filter(F.col("before") < F.col("need"))
        .select("block", "text", "score")
    )
    return scored.join(levels, ["block", "text", "score"], "left_semi")


def _block(cols: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *[F.col(c).cast("string") for c in cols])


# Fixed value: the sentence for units without any candidate.
NO_CANDIDATE = (
    "Best Matching config_string could not be found; Does compliant config_string with exact "
    "model_powertrain, model_year, or country exist"
)


def _options_of(text: Column) -> Column:
    return F.split(text, "_")


def _nearest_by_edits(left: DataFrame, right: DataFrame) -> DataFrame:
    """(block, text, best (loss, other)) by ``levenshtein_score``; both sides are (block, text).

    First, an index over the options of a key: keys that agree in all options but one meet by a hash of
    the others, and the best of them is a score that the answer reaches at least. Then every key of the
    block is asked, but only for the edits that such a score allows: keys whose lengths or sets of options
    rule it out are passed over (an edit changes two options at most), and the distance is computed in
    a band of that width.
    """
    def without_one(df: DataFrame, name: str) -> DataFrame:
        parts = _options_of(F.col("text"))
        others = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.xxhash64(
            i, F.array_join(F.slice(parts, F.lit(1), i - 1), "_"), F.array_join(F.slice(parts, i + 1, F.size(parts)), "_")))
        return df.withColumn("key", F.explode(others)).select("block", F.col("text").alias(name), "key")

    close = without_one(left, "text").join(without_one(right, "other"), ["block", "key"])
    first = close.groupBy("block", "text").agg(F.max(levenshtein_score(F.col("text"), F.col("other"))).alias("reached"))
    asked = left.join(first, ["block", "text"], "left").withColumns({
        "reached": F.coalesce("reached", F.lit(0)), "options": _options_of(F.col("text"))})
    choices = right.select("block", F.col("text").alias("other"), _options_of(F.col("text")).alias("other_options"))
    a, b = F.length("text"), F.length("other")
    longest = F.greatest(a, b)
    # A score of ``reached`` or more, by the rounding of the score.
    limit = F.floor(longest * (100.5 - F.col("reached")) / 100).cast("int")
    apart = F.size(F.array_except("options", "other_options"))
    edits = F.call_function("levenshtein", F.col("text"), F.col("other"), F.col("limit"))
    near = (
        asked.join(choices, "block").withColumn("limit", limit)
        .filter((F.abs(a - b) <= F.col("limit")) & (apart <= 2 * F.col("limit")))
        .withColumn("edits", edits).filter("edits >= 0")
    )
    loss = -rounded_score(longest, F.col("edits"))
    return near.groupBy("block", "text").agg(F.min(F.struct(loss.alias("loss"), "other")).alias("best"))


def nearest_config(
    units: DataFrame, catalog: DataFrame, block: Sequence[str], scorer: str = "levenshtein",
    no_candidate: str | None = NO_CANDIDATE,
) -> DataFrame:
    """Add best_match_config_string and best_match_score: the catalog configuration of the same
    block most similar to the unit's (ties: the lower key). Without one: ``no_candidate`` and 0."""
    present = None
    for c in block:
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
    texts = units.filter(present).select(_block(block).alias("block"), F.col("config_string").alias("text"))
    choices = catalog.filter(present).select(_block(block).alias("block"), F.col("config_string").alias("text"))
    left, right = materialize(texts.distinct()), materialize(choices.distinct())
    if scorer == "levenshtein":
        hits = _nearest_by_edits(left, right)
    else:
        tiles = _tiles(left.withColumn("need", F.lit(1)), right.withColumn("capacity", F.lit(1)))
        hits = tiles.select("block", F.inline(_shortlist(scorer)("l", "r"))).select(
            "block", "text", F.struct((-F.col("score")).alias("loss"), "other").alias("best")
        )
    best = hits.groupBy("block", "text").agg(F.min("best").alias("best")).select(
        F.col("block").alias("_block"), F.col("text").alias("_text"),
        F.col("best.other").alias("_other"), (-F.col("best.loss")).cast("int").alias("_score"),
    )
    same = (_block(block) == F.col("_block")) & (F.col("config_string") == F.col("_text")) & present
    return units.join(best, same, "left").withColumns({
        "best_match_config_string": F.coalesce("_other", F.lit(no_candidate)),
        "best_match_score": F.coalesce("_score", F.lit(0)),
    }).drop("_block", "_text", "_other", "_score")


def blended_score(
    text_score: Column, dos: Column, max_dos: float, take_rate: Column,
    weights: tuple[float, float, float] = (0.6, 0.2, 0.2),
) -> Column:
    """Text similarity (0-100) blended with scarcity and take rate."""
    scarcity = 1 - dos / max_dos if max_dos > 0 else F.lit(0.5)
    return text_score / 100 * weights[0] + scarcity * weights[1] + take_rate * weights[2]


def similar_match(
    demand: DataFrame, supply: DataFrame, scorer: str = "ratio", group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Demands in order take the most similar unused unit of their block (ties: the first unit).

    Both sides have id, ord, block and text. Returns every demand's id with ``similar_id`` and
    ``similar_text``, NULL where the block ran out.

    Taking turns is the one stable matching when every unit prefers the earlier demand, so it
    can be found in parallel. Demands are cut into groups of a bounded number of rows, of
    neighbouring texts, which tend to want the same units. Every group settles its own order of
    picks around the units that earlier demands of other groups hold; where two groups pick one
    unit, the earlier demand keeps it and the other group settles again. Whatever a demand
    passes over stays out of its reach for good, so any cut into groups gives the same result.
    The k-th demand of a text cannot end above the k-th option of that text, which is where
    its chunk starts looking.
    """
    texts = ["block", "text"]
    present = "block is not null and text is not null"
    wanted = materialize(demand.select("id", "ord", *texts).filter(present))
    queued = number_rows(wanted, ["block"], ["ord", "id"], "dpos")
    d = number_rows(queued, texts, ["dpos"], "turn").withColumn(
        "chunk", F.floor((F.col("turn") - 1) / (group_rows // 4))
    )
    d = materialize(d)
    chunks = _group_chunks(d, group_rows)
    d = materialize(d.join(chunks.select(*texts, "chunk", "grp"), [*texts, "chunk"]).select("id", *texts, "dpos", "grp"))
    on_hand = materialize(supply.select("id", "ord", *texts).filter(present))
    stocked = number_rows(on_hand, ["block"], ["ord", "id"], "vpos")
    # No more units of one text than its block has demands can ever be used.
    waiting = d.groupBy("block").agg(F.count(F.lit(1)).alias("demands"))
    v = materialize(
        number_rows(stocked, texts, ["vpos"], "nth").join(waiting, "block").filter("nth <= demands")
    )
    stock = materialize(v.groupBy(*texts).agg(F.count(F.lit(1)).alias("capacity")))
    options = _options(chunks, stock, v, scorer)
    held = d.select("block", F.col("dpos").alias("vpos"), "dpos", "grp").limit(0)
    dirty = chunks.select("block", "grp").distinct()
    while True:
        picks = materialize(_settle(d, chunks, options, held, dirty))
        held = picks.filter("rank = 1").drop("rank")
        dirty = picks.filter("rank > 1").select("block", "grp").distinct()
        if not dirty.isEmpty():
            continue
        # All picks stand. Demands without one may only have seen too few options.
        free = d.join(held, ["block", "dpos"], "left_anti").select(*texts, "grp").distinct()
        total = stock.groupBy("block").agg(F.sum("capacity").alias("total"))
        short = materialize(
            chunks.join(free, [*texts, "grp"], "left_semi").join(total, "block")
            .filter("first_place + want <= total").select(*texts, "chunk")
        )
        if short.isEmpty():
            break
        wider = F.when(F.col("hit").isNotNull(), F.col("want") * 16).otherwise(F.col("want"))
        chunks = materialize(
            chunks.join(short.withColumn("hit", F.lit(1)), [*texts, "chunk"], "left")
            .withColumn("want", wider).drop("hit")
        )
        grown = chunks.join(short.select(*texts), texts, "left_semi")
        more = _options(grown, stock, v, scorer)
        options = materialize(options.join(short, texts, "left_anti").unionByName(more))
        dirty = grown.select("block", "grp").distinct()
    given = held.join(
        v.select("block", "vpos", F.col("id").alias("similar_id"), F.col("text").alias("similar_text")),
        ["block", "vpos"],
    )
    matched = d.join(given, ["block", "dpos"]).select("id", "similar_id", "similar_text")
    return demand.join(matched, "id", "left")


def _group_chunks(d: DataFrame, group_rows: int) -> DataFrame:
    """Chunks of one text with the options they look at, packed into groups in text order."""
    sized = d.groupBy("block", "text", "chunk").agg(
        F.min("turn").alias("first_place"), F.count(F.lit(1)).alias("n")
    ).withColumn("want", F.col("n") * 2 + 16).withColumn("rows", F.col("n") + F.col("want"))
    packed = number_rows(sized, ["block"], ["text", "chunk"], "_n", {"upto": "rows"})
    return materialize(
        packed.select("block", "text", "chunk", "first_place", "want", F.floor(F.col("upto") / group_rows).alias("grp"))
    )


def _options(chunks: DataFrame, stock: DataFrame, v: DataFrame, scorer: str) -> DataFrame:
    """(block, text, place, vpos): per text its first units, best score first."""
    reach = chunks.groupBy("block", "text").agg(F.max(F.col("first_place") + F.col("want")).alias("need"))
    menu = candidates(reach, stock, scorer)
    units = menu.select("block", "text", "need", "score", "other").join(
        v.select("block", F.col("text").alias("other"), "vpos", "nth"), ["block", "other"]
    ).filter("nth <= need")
    ranked = number_rows(units, ["block", "text"], [F.desc("score"), F.col("vpos")], "place")
    return materialize(ranked.filter("place <= need").select("block", "text", "place", "vpos"))


def _settle(d: DataFrame, chunks: DataFrame, options: DataFrame, held: DataFrame, dirty: DataFrame) -> DataFrame:
    """The dirty groups pick anew; ranks all claims on each unit (1 = the earliest, who holds it)."""
    group = ["block", "grp"]
    asking = d.join(dirty, group, "left_semi").select("block", F.col("grp").alias("d_grp"), "text", "dpos")
    holders = held.select("block", "vpos", F.col("dpos").alias("holder"), F.col("grp").alias("holder_grp"))
    seen = chunks.join(dirty, group, "left_semi").select("block", "text", "grp", "first_place", "want")
    offers = (
        options.join(seen, ["block", "text"])
        .filter("place >= first_place and place < first_place + want")
        .join(holders, ["block", "vpos"], "left")
        .select("block", F.col("grp").alias("o_grp"), "text", "place", "vpos",
                F.expr("case when holder_grp <> grp then holder end").alias("holder"))
    )
    picks = (
        asking.groupBy("block", "d_grp").cogroup(offers.groupBy("block", "o_grp"))
        .applyInPandas(_pick, "block string, vpos long, dpos long, grp long")
    )
    claims = held.join(dirty, group, "left_anti").unionByName(picks)
    # As many claims on a unit as groups want it.
    return claims.withColumn("rank", F.row_number().over(Window.partitionBy("block", "vpos").orderBy("dpos")))


def _pick(key: tuple, demands: pd.DataFrame, offers: pd.DataFrame) -> pd.DataFrame:
    """The demands of one group, in order, each pick the best unit still open to them."""
    offers = offers.drop_duplicates(["text", "vpos"]).sort_values("place")
    lists = {
        text: list(zip(rows["vpos"], rows["holder"].fillna(float("inf"))))
        for text, rows in offers.groupby("text", sort=False)
    }
    at = dict.fromkeys(lists, 0)
    picked: dict[int, int] = {}
    for text, dpos in demands.sort_values("dpos")[["text", "dpos"]].itertuples(index=False):
        mine = lists.get(text, [])
        # What this demand passes over, later demands with the same text pass over as well.
        while at.get(text, 0) < len(mine):
            vpos, holder = mine[at[text]]
            at[text] += 1
            if holder > dpos and vpos not in picked:
                picked[vpos] = dpos
                break
    return pd.DataFrame({"block": key[0], "vpos": list(picked), "dpos": list(picked.values()), "grp": key[1]})
