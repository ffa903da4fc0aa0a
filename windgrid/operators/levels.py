"""Joins of plant rows to the rows of their complex."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windgrid.functions import normalize, percent
from windgrid.schemas import COMPLEX_PAYLOAD, TS
from windgrid.sinks.files import write_layer


def join_levels(
    spe: DataFrame,
    wind: DataFrame,
    spe_name: str = "nom_conjuntousina",
    wind_name: str = "nom_usina",
    ts: str = TS,
    payload: Sequence[str] = COMPLEX_PAYLOAD,
    collapse_ws: bool = False,
    salt: int = 1,
    spread_by: Sequence[str] = ("nom_usina", TS),
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Plant rows LEFT JOIN complex rows on normalised name and timestamp.

    Every plant row stays; several matches multiply it; a null key matches nothing. The third join key
    ``_slot`` is equal on both sides wherever the names are. Rows that cannot match get a hash of the
    ``spread_by`` columns there, so a mass of null names does not meet in one task; only these columns are read
    for it (all, where the table lacks one of them). ``salt`` above one also cuts each (name, timestamp) into that many slots and repeats the complex rows per
    slot; use it for a hot pair when adaptive skew handling is off. ``hot``, the result of ``hot_pairs``, does so for the hot pairs alone,
    each with the slots that it needs, and needs no guess.
    """
    spread = _spread(spe, spread_by)
    key = normalize(spe_name, collapse_ws)
    slots = _slots(key, F.col(ts), salt, hot)
    slot = F.pmod(spread, slots) if salt > 1 or hot else F.lit(0).cast("bigint")
    unmatched = key.isNull() | F.col(ts).isNull()
    left = spe.select(
        *spe.columns,
        key.alias("_name"),
        F.when(unmatched, spread).otherwise(F.xxhash64(key, slot)).alias("_slot"),
    )
    right_key = normalize(wind_name, collapse_ws)
    right = wind.select(right_key.alias("_right_name"), F.col(ts).alias("_right_ts"), *payload)
    if salt > 1 or hot:
        last = _slots(F.col("_right_name"), F.col("_right_ts"), salt, hot) - 1
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    else:
        right = right.withColumn("_salt", F.lit(0).cast("bigint"))
    right = right.withColumn("_right_slot", F.xxhash64("_right_name", "_salt")).drop("_salt")
    matches = (
        (F.col("_name") == F.col("_right_name"))
        & (F.col(ts) == F.col("_right_ts"))
        & (F.col("_slot") == F.col("_right_slot"))
    )
    return left.join(right, matches, "left").select(*spe.columns, *payload)


def hot_pairs(
    spe: DataFrame,
    spe_name: str = "nom_conjuntousina",
    ts: str = TS,
    collapse_ws: bool = False,
    rows_per_slot: int | None = None,
    most: int = 1000,
) -> dict[int, int]:
    """The (name, timestamp) pairs with more than ``rows_per_slot`` rows, as hash and number of slots, for ``join_levels``.

    One pass: a sketch of the most frequent pairs and the number of rows. By default a slot holds what a shuffle partition would of evenly spread
    rows, so there are fewer such pairs than partitions; at most ``most`` come back, the largest first. The sketch may
    miss or overrate a pair near the limit, which moves work and never changes the joined rows.
    """
    name = normalize(spe_name, collapse_ws)
    pairs = spe.filter(name.isNotNull() & F.col(ts).isNotNull()).select(F.xxhash64(name, F.col(ts)).alias("_pair"))
    found = pairs.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(_pair, {most}, {100 * most})").alias("top")).first()
    goal = rows_per_slot or max(1, found["n"] // int(spe.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return {r["item"]: -(-r["count"] // goal) for r in found["top"] or () if r["count"] > goal}


def _slots(name: Column, ts: Column, salt: int, hot: Mapping[int, int] | None) -> Column:
    """How many slots a pair has."""
    if not hot:
        return F.lit(salt).cast("bigint")
    known = F.create_map(*[F.lit(x).cast("bigint") for pair in sorted(hot.items()) for x in pair])
    return F.coalesce(F.try_element_at(known, F.xxhash64(name, ts)), F.lit(salt).cast("bigint"))


def _spread(spe: DataFrame, spread_by: Sequence[str]) -> Column:
    return F.xxhash64(*(spread_by if set(spread_by) <= set(spe.columns) else spe.columns))


def first_per_name(
    wind: DataFrame,
    wind_name: str = "nom_usina",
    ts: str = TS,
    payload: Sequence[str] = COMPLEX_PAYLOAD,
    collapse_ws: bool = True,
) -> DataFrame:
    """One complex row per normalised name: the earliest, ties broken by all other columns, nulls last.

    Spark keeps the best row per name inside each task before the shuffle (window group limit), so a
    name with a third of all rows sends one row per task.
    """
    keyed = wind.withColumn("_right_name", normalize(wind_name, collapse_ws))
    rest = [c for c in wind.columns if c != ts]
    order = [F.col(c).asc_nulls_last() for c in [ts, *rest]]
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("_right_name").orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).select("_right_name", *payload)


def join_first(
    spe: DataFrame,
    firsts: DataFrame,
    spe_name: str = "nom_conjuntousina",
    payload: Sequence[str] = COMPLEX_PAYLOAD,
    collapse_ws: bool = True,
    salt: int = 1,
    spread_by: Sequence[str] = ("nom_usina", TS),
) -> DataFrame:
    """Plant rows LEFT JOIN one complex row per name, whatever the timestamp; null matches null.

    ``salt`` above one cuts each name, null included, into that many slots by a hash of ``spread_by`` and repeats the complex rows per
    slot; use it where one name has a large share of the rows and the complex rows are too many to broadcast.
    """
    keyed = spe.withColumn("_name", normalize(spe_name, collapse_ws))
    same = F.col("_name").eqNullSafe(F.col("_right_name"))
    if salt > 1:
        spread = _spread(spe, spread_by)
        keyed = keyed.withColumn("_slot", F.pmod(spread, F.lit(salt)))
        firsts = firsts.withColumn("_right_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
        same = same & (F.col("_slot") == F.col("_right_slot"))
    return keyed.join(firsts, same, "left").select(*spe.columns, *payload)


def dedupe_then_join(
    spe: DataFrame,
    wind: DataFrame,
    spe_name: str = "nom_conjuntousina",
    wind_name: str = "nom_usina",
    ts: str = TS,
    payload: Sequence[str] = COMPLEX_PAYLOAD,
    collapse_ws: bool = True,
    store: str | None = None,
    salt: int = 1,
) -> DataFrame:
    """``join_first`` over ``first_per_name``: the row count of the plant side never changes.

    With ``store``, a folder, the first rows are written there and read back, so that the join is planned with their true
    size: a small result is broadcast and the plant rows stay where they are.
    """
    firsts = first_per_name(wind, wind_name, ts, payload, collapse_ws)
    firsts = write_layer(firsts, store) if store else firsts
    return join_first(spe, firsts, spe_name, payload, collapse_ws, salt)


def join_metrics(joined: DataFrame, matched_by: str = "nom_estado") -> DataFrame:
    """Total rows, matched rows and their share; the share of an empty table is null."""
    total, matched = F.count("*"), F.count(matched_by)
    return joined.agg(
        total.alias("total_records"),
        matched.alias("matched_records"),
        percent(matched, total).alias("match_rate_pct"),
    )


def null_safe_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """All pairs equal, null counted as equal to null."""
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & left.eqNullSafe(right)
    return condition
