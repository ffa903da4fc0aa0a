"""One wide row of results as long rows with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def long_rows(
    df: DataFrame, labels: Sequence[str], lines: Sequence[tuple], value: str = "value", kind: str = "double", by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates ``df`` once and returns a row per line: its labels, then its aggregate as ``kind``.

    Each line holds one text per label and then the aggregate column. ``by`` does so for each group of these columns, which come first.
    """
    wide = df.groupBy(*by).agg(*[line[-1].alias(f"_{i}") for i, line in enumerate(lines)])
    cells = [", ".join([*map(_quoted, line[:-1]), f"CAST(_{i} AS {kind})"]) for i, line in enumerate(lines)]
    return wide.selectExpr(*by, f"stack({len(lines)}, {', '.join(cells)}) AS ({', '.join([*labels, value])})")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
