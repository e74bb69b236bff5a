"""Three kinds of streaks, all on one sort per (fund, stock).

Input is the paired frame: a row per date on which the stock is held now or was held on the
previous valid date. Recursions over stored counts become running anchors: a streak is the
distance from the last position at which the run could not have continued.

A range of dates can go on from what is stored about the dates before it: seeds are rows that stand
for a fund's own last date (counts of the held stocks) and for its last valid date (flow counts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.carried import pack, unpack
from tidemark.params import DEFAULT, Params


def _frame(end: int) -> WindowSpec:
    """All rows of the position up to ``end`` rows from the current one, by date."""
    position = W.partitionBy("etf_code", "stock_code").orderBy("date")
    return position.rowsBetween(W.unboundedPreceding, end)


def _before() -> WindowSpec:
    return _frame(-1)


def _upto() -> WindowSpec:
    return _frame(W.currentRow)


def _last(condition: Column, fields: list[Column], frame) -> Column:
    """Latest struct of ``fields`` among rows meeting ``condition``."""
    return F.last(F.when(condition, F.struct(*fields)), ignorenulls=True).over(frame)


_KINDS = {"wa": ("weight_dir", 1), "wr": ("weight_dir", -1), "sa": ("share_dir", 1), "sr": ("share_dir", -1)}
_SIDES = {"add": "is_active_add", "reduce": "is_active_reduce"}
_SEEDED = (*_KINDS, *_SIDES)
# All that the streaks read of a row; its other columns only go along.
STREAK_INPUT = (
    "date", "prev_date", "etf_code", "stock_code", "vi", "date_valid", "ti", "in_now", "now_weight", "shares", "compared",
    "etf_scale_factor", *_SIDES.values(),
)


def held_seeds(state: DataFrame) -> DataFrame:
    """Seeds from rows (date, etf_code, stock_code, ti, now_weight, shares, wa, wr, sa, sr) of each fund's own last date."""
    return state.select(
        "date", "etf_code", "stock_code", "ti", "now_weight", "shares", F.lit(1).alias("in_now"),
        F.lit(False).alias("compared"), F.lit(False).alias("date_valid"), *[F.col(k).alias(f"seed_{k}") for k in _KINDS],
    )


def linked_seeds(changes: DataFrame) -> DataFrame:
    """Seeds from stored change rows (with ``vi``) of the last valid date."""
    return changes.select(
        "date", "vi", "etf_code", "stock_code", *_SIDES.values(), F.lit(0).alias("in_now"), F.lit(True).alias("compared"),
        F.lit(True).alias("date_valid"), *[F.col(f"consecutive_active_{s}_days").alias(f"seed_{s}") for s in _SIDES],
    )


def with_position_anchors(classed: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Everything the three streaks look back for, in two passes over one sort.

    First pass: the last held row and the last row another row can link to. Second pass: for
    each direction, the last own date at which a run could not have continued.
    """
    eps = params.epsilon
    held = F.col("in_now") == 1
    link = F.col("compared") & F.col("date_valid")
    ti, weight, shares = F.col("ti"), F.col("now_weight"), F.col("shares")
    looked = classed.select(
        "*",
        _last(held, [ti.alias("ti"), weight.alias("weight"), shares.alias("shares")], _before()).alias("was"),
        _last(link, [F.col("date"), F.col("vi"), *[F.col(flag) for flag in _SIDES.values()]], _before()).alias("pred"),
    )
    follows = F.coalesce(F.col("was.ti") == ti - 1, F.lit(False))
    old_weight = F.when(F.col("follows"), F.col("was.weight")).otherwise(0.0)
    old_shares = F.when(F.col("follows"), F.col("was.shares"))
    moved = looked.withColumn("follows", follows).withColumns(
        {
            "weight_dir": F.when(ti == 1, 0).when(weight > old_weight + eps, 1).when(weight < old_weight - eps, -1).otherwise(0),
            "share_dir": F.when(shares > old_shares + eps, 1).when(shares < old_shares - eps, -1).otherwise(0),
        }
    )

    def anchor(name: str, direction: str, sign: int) -> Column:
        # A run that starts after a gap is anchored one date before its first row.
        stop = F.when(held & (F.col(direction) != sign), ti).when(held & ~F.col("follows"), ti - 1)
        return F.max(F.coalesce(ti - F.col(f"seed_{name}"), stop)).over(_upto())

    anchored = moved.select("*", *[anchor(name, *kind).alias(f"{name}_anchor") for name, kind in _KINDS.items()])
    return anchored.withColumns(
        {
            name: F.coalesce(
                f"seed_{name}", F.when(held & (F.col(direction) == sign), ti - F.col(f"{name}_anchor")).otherwise(0))
            for name, (direction, sign) in _KINDS.items()
        }
    )


def with_streaks(classed: DataFrame, params: Params = DEFAULT, seeds: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Weight, share and flow streaks of every paired row; ``seeds`` stand for the dates before the first.

    Weight and share streaks run over the fund's own valid dates (index ``ti``): a date without
    the stock counts as weight zero and breaks a share run. Flow streaks run along previous
    valid dates: only compared rows on valid dates can be anyone's previous row.
    """
    eps = params.epsilon
    held = F.col("in_now") == 1
    link = F.col("compared") & F.col("date_valid")
    scale = F.col("etf_scale_factor")
    rows = pack(classed, STREAK_INPUT).withColumns({f"seed_{k}": F.lit(None).cast("int") for k in _SEEDED})
    for seed in seeds:
        rows = rows.unionByName(seed, allowMissingColumns=True)
    anchored = with_position_anchors(rows, params)
    shares = {"add": F.col("sa"), "reduce": F.col("sr")}
    linked = F.col("pred.date") == F.col("prev_date")
    flow = {}
    for side, flag in _SIDES.items():
        on = F.col(flag) == 1
        flow[f"{side}_goes_on"] = scale.isNotNull() & on & F.coalesce(linked & (F.col(f"pred.{flag}") == 1), F.lit(False))
        flow[f"{side}_base"] = F.coalesce(f"seed_{side}", F.when(scale.isNull(), shares[side]).when(on, 1).otherwise(0))
    based = anchored.withColumns(flow)
    closed = based.select(
        "*",
        _last(held, [F.col("ti"), F.col("now_weight").alias("weight"), F.col("wa"), F.col("wr")], _before()).alias("gone"),
        *[
            _last(link & ~F.col(f"{s}_goes_on"), [F.col("vi"), F.col(f"{s}_base").alias("base")], _upto()).alias(f"{s}_start")
            for s in _SIDES
        ],
    )
    # A stock sold since the fund's own last date: its weight fell to zero.
    just_gone = ~held & F.coalesce(F.col("gone.ti") == F.col("ti") - 1, F.lit(False))

    def flow_days(side: str) -> Column:
        # The previous row lies on the run that began at ``start``, one valid date per step.
        start = F.col(f"{side}_start")
        run = start["base"] + F.col("pred.vi") - start["vi"] + 1
        return F.when(F.col(f"{side}_goes_on"), run).otherwise(F.col(f"{side}_base")).cast("int")

    temp = [*_KINDS, *[f"{k}_anchor" for k in _KINDS], *[f"{s}_{x}" for s in _SIDES for x in ("goes_on", "base", "start")]]
    if seeds:
        closed = closed.where(F.coalesce(*[f"seed_{k}" for k in _SEEDED]).isNull())
    timed = closed.withColumns(
        {
            "consecutive_add_days": F.when(just_gone & (F.col("gone.weight") < -eps), F.col("gone.wa") + 1).otherwise(F.col("wa")),
            "consecutive_reduce_days": F.when(just_gone & (F.col("gone.weight") > eps), F.col("gone.wr") + 1).otherwise(F.col("wr")),
            "share_add_days": F.col("sa"),
            "share_reduce_days": F.col("sr"),
            "consecutive_active_add_days": flow_days("add"),
            "consecutive_active_reduce_days": flow_days("reduce"),
        }
    )
    return unpack(timed).drop("was", "pred", "gone", "follows", "weight_dir", "share_dir", *temp, *[f"seed_{k}" for k in _SEEDED])
