"""Star schema over the joined table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.functions import timestamp_column
from windgrid.operators.keys import add_surrogate_key, extend_surrogate_key
from windgrid.operators.levels import null_safe_equal
from windgrid.schemas import DIM_CONJUNTO, DIM_SPE, FACT_MEASURES, TS

# Fixed value: label of a fact row without a restriction reason.
FACT_NO_REASON = "SEM_RESTRICAO"

# The part of each natural key that the short lookup uses.
SHORT_SPE = ["nom_usina", "id_ons", "ceg"]
SHORT_CONJUNTO = ["nom_conjuntousina"]


def dim_spe(joined: DataFrame, natural: Sequence[str] = DIM_SPE, key: str = "spe_key") -> DataFrame:
    """Distinct plants with a key."""
    return add_surrogate_key(joined.select(*natural).distinct(), natural, key)


def dim_conjunto(joined: DataFrame, natural: Sequence[str] = DIM_CONJUNTO, key: str = "conjunto_key") -> DataFrame:
    """Distinct complexes with a key."""
    return add_surrogate_key(joined.select(*natural).distinct(), natural, key)


def append_dimension(stored: DataFrame, joined: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """A stored plant or complex dimension with what a later joined table adds; keys given before do not move."""
    return extend_surrogate_key(stored, joined.select(*natural).distinct(), natural, key)


def dim_tempo(joined: DataFrame, ts: str = TS, key: str = "tempo_key") -> DataFrame:
    """Distinct timestamps with a key in time order, year, month, day and hour; null comes last."""
    return add_surrogate_key(_moments(joined, ts), [ts], key, bucket=_day(ts)).select(ts, key, *_PARTS)


def append_tempo(stored: DataFrame, joined: DataFrame, ts: str = TS, key: str = "tempo_key") -> DataFrame:
    """A stored time dimension with the timestamps that a later joined table adds: stored keys stay, new ones follow in time order."""
    return extend_surrogate_key(stored, _moments(joined, ts).select(ts, *_PARTS), [ts], key, bucket=_day(ts)).select(*stored.columns)


_PARTS = ("ano", "mes", "dia", "hora")


def _moments(joined: DataFrame, ts: str) -> DataFrame:
    moments = joined.select(timestamp_column(joined, ts, "strict").alias(ts)).distinct()
    return moments.withColumns(dict(zip(_PARTS, (F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts)))))


def _day(ts: str) -> Column:
    return F.coalesce(F.unix_date(F.col(ts).cast("date")), F.lit(2**31 - 1))


def fact_generation(
    joined: DataFrame,
    spe: DataFrame,
    conjunto: DataFrame,
    tempo: DataFrame,
    lookup: str = "full",
    default_label: str = FACT_NO_REASON,
    measures: Sequence[str] = FACT_MEASURES,
    reason: str = "cod_razaorestricao",
    ts: str = TS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fact rows: three dimension keys, the measures and the reason with nulls labelled.

    ``lookup="full"`` compares the whole natural key and keeps one fact row per input row. ``"short"``
    compares only plant name, id and code, and the complex name; a plant or complex that occurs with
    several attribute values then multiplies its rows. Null equals null in both. Pass the dimensions as
    stored tables: Spark then knows their size and broadcasts the small ones, so the fact rows stay in place. ``keep``
    names further columns of the joined table to carry along, such as those to store the facts by.
    """
    if lookup not in ("full", "short"):
        raise ValueError(f"lookup must be 'full' or 'short', not {lookup!r}")
    full = lookup == "full"
    by_spe = [c for c in spe.columns if c != "spe_key"] if full else SHORT_SPE
    by_conjunto = [c for c in conjunto.columns if c != "conjunto_key"] if full else SHORT_CONJUNTO
    fact = joined.withColumn(ts, timestamp_column(joined, ts, "strict"))
    fact = _look_up(fact, spe, by_spe, "spe_key")
    fact = _look_up(fact, conjunto, by_conjunto, "conjunto_key")
    fact = _look_up(fact, tempo, [ts], "tempo_key")
    label = F.coalesce(F.col(reason), F.lit(default_label)).alias(reason)
    return fact.select("spe_key", "conjunto_key", "tempo_key", *measures, label, *keep)


def _look_up(fact: DataFrame, dim: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    side = dim.select(key, *[F.col(c).alias(f"_dim_{c}") for c in by])
    same = null_safe_equal([(F.col(c), F.col(f"_dim_{c}")) for c in by])
    return fact.join(side, same, "left").select(*fact.columns, key)
