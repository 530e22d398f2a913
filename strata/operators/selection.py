"""Latest-N selection (L1, L2) and the newest-N walk over paged feeds (L3, U4)."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AS_WRITTEN = "as_written"
LATEST = "latest"
#: Files a month is written in, at most, by one write.
FILES_PER_MONTH = 4
#: The folder name of a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def select_days(df: DataFrame, n: int | None, y: str, m: str, d: str,
                order: str = LATEST, tiebreak: list[str] | None = None) -> DataFrame:
    """L1/L2: N rows by date.

    ``'as_written'`` sorts year ASC, month ASC, day DESC (only the last key
    descending, so it picks from the oldest month); ``'latest'`` sorts all
    three descending.  ``tiebreak`` columns make the cut deterministic.
    ``n=None`` keeps every row (no sort, no single-task limit).
    """
    if n is None:
        return df
    tb = [F.col(c).asc() for c in (tiebreak or [])]
    if order == AS_WRITTEN:
        keys = [F.col(y).asc(), F.col(m).asc(), F.col(d).desc()]
    elif order == LATEST:
        keys = [F.col(y).desc(), F.col(m).desc(), F.col(d).desc()]
    else:
        raise ValueError(order)
    return df.orderBy(*keys, *tb).limit(n)


def write_by_month(df: DataFrame, path: str, y: str, m: str, mode: str = "append") -> None:
    """Rows stored with year and month as partitions; a busy month is written by several tasks."""
    part = F.pmod(F.hash(*[F.col(c) for c in df.columns]), F.lit(FILES_PER_MONTH))
    df.repartition(F.col(y), F.col(m), part).write.mode(mode).partitionBy(y, m).parquet(path)


def months_of(stored: DataFrame, y: str, m: str) -> list[tuple[int | None, int | None]]:
    """The months that a table of ``write_by_month`` has, from its file names: no file is opened."""
    found = set()
    for f in stored.inputFiles():
        parts = dict(p.split("=", 1) for p in unquote(f).split("/") if "=" in p)
        found.add(tuple(None if parts[c] == NO_VALUE else int(parts[c]) for c in (y, m)))
    return list(found)


def in_months(months: list[tuple[int | None, int | None]], y: str, m: str) -> Column:
    """A filter on the partitions alone."""
    years: dict[int | None, list[int | None]] = {}
    for year, month in months:
        years.setdefault(year, []).append(month)
    each = []
    for year, own in years.items():
        month = F.coalesce(F.col(m).isin([x for x in own if x is not None]), F.lit(False))
        each.append(F.col(y).eqNullSafe(F.lit(year)) & (month | F.col(m).isNull() if None in own else month))
    return reduce(lambda a, b: a | b, each, F.lit(False))


def select_days_by_month(stored: DataFrame, n: int | None, y: str, m: str, d: str,
                         order: str = LATEST, tiebreak: list[str] | None = None) -> DataFrame:
    """L1/L2 over a table of ``write_by_month``: what ``select_days`` gives, from as many months as ``n`` needs.

    Months are counted (from the files' footers) in the wanted order, one, two,
    four at a time, until they hold ``n`` rows; only those are then sorted.  Every
    month ahead of the last one is kept whole, so ties and ``tiebreak`` come out as
    over the whole table.  Null years or months sort as Spark sorts them: first
    ascending, last descending.  The driver holds the list of months.
    """
    if n is None:
        return stored
    if order not in (AS_WRITTEN, LATEST):
        raise ValueError(order)
    months = sorted(months_of(stored, y, m), key=lambda k: [(v is not None, v or 0) for v in k], reverse=order == LATEST)
    taken, rows, step = 0, 0, 1
    while taken < len(months) and rows < n:
        part = months[taken:taken + step]
        rows += stored.filter(in_months(part, y, m)).count()
        taken, step = taken + len(part), 2 * step
    return select_days(stored.filter(in_months(months[:taken], y, m)), n, y, m, d, order, tiebreak)


def newest(entries: DataFrame, n: int | None, order: list[Column]) -> DataFrame:
    """L3: the first N rows in ``order`` (newest first); all of them, unsorted,
    if ``n`` is None."""
    return entries if n is None else entries.orderBy(*order).limit(n)
