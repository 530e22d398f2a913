"""Column functions of the typed layers.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Each takes and returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_to_null(c: ColLike) -> Column:
    """The sentinel 0 means "none"."""
    return F.nullif(_col(c), F.lit(0))


def blank_to_null(c: ColLike) -> Column:
    """Empty text means "none"."""
    return F.nullif(_col(c), F.lit(""))


def greater_flag(c: ColLike, bound: int = 1) -> Column:
    """Three-valued flag - NULL stays NULL, else ``c > bound``."""
    return _col(c) > F.lit(bound)


def first_key(*cols: ColLike) -> Column:
    """P5: first non-null of several keys."""
    return F.coalesce(*[_col(c) for c in cols])


def ms_to_seconds(c: ColLike) -> Column:
    """Text or number of milliseconds -> double seconds."""
    return _col(c).cast("double") / F.lit(1000)


def strict_cast(c: ColLike, dtype: str, strict: bool = True) -> Column:
    """ANSI cast (a bad value fails the job); ``try_cast`` when not strict."""
    return _col(c).cast(dtype) if strict else _col(c).try_cast(dtype)


def int_list(c: ColLike, sep: str = ",", strict: bool = True) -> Column:
    """C4: comma list text -> array<int>.  '' is the empty array, NULL stays NULL."""
    c = _col(c)
    parts = F.split(c, sep)
    if strict:
        arr = parts.cast("array<int>")
    else:  # one bad element makes the whole value NULL (a quarantine reason)
        tried = parts.try_cast("array<int>")
        arr = F.when(F.size(F.array_compact(tried)) == F.size(parts), tried)
    return F.when(c == F.lit(""), F.array().cast("array<int>")).otherwise(arr)


# Fixed value: a style code is '$' followed by exactly three letters or
# digits; every match is removed.
STYLE_CODE = r"\$[A-Za-z0-9][A-Za-z0-9][A-Za-z0-9]"


def strip_codes(c: ColLike) -> Column:
    """Remove every ``$`` + three letters/digits."""
    return F.regexp_replace(_col(c), STYLE_CODE, "")


def weekday_name(d: ColLike) -> Column:
    """Upper-case English weekday, blank-padded to 9 characters."""
    return F.rpad(F.upper(F.date_format(_col(d), "EEEE")), 9, " ")


def build_date(y: ColLike, m: ColLike, d: ColLike) -> Column:
    """Date from year, month, day; NULL part -> NULL, impossible date fails."""
    return F.make_date(_col(y), _col(m), _col(d))


def days_between(later: ColLike, earlier: ColLike) -> Column:
    """``later - earlier`` as whole days (int)."""
    return F.date_diff(_col(later), _col(earlier))


def year_month_day(d: ColLike, prefix: str) -> list[Column]:
    """The three int parts of a date, aliased ``{prefix}_year`` etc."""
    d = _col(d)
    return [F.year(d).alias(f"{prefix}_year"), F.month(d).alias(f"{prefix}_month"),
            F.dayofmonth(d).alias(f"{prefix}_day")]


def text_to_date(c: ColLike, strict: bool = True) -> Column:
    """Timestamp or date text -> the written calendar date (no zone shift).

    The date part is taken as written, so '2023-01-01T23:30:00+05:00' is
    2023-01-01, the same as a cast to DATE in the row store.
    """
    c = _col(c)
    return c.cast("date") if strict else c.try_cast("date")


def pad_fit(c: ColLike, n: int) -> Column:
    """VARCHAR(n) store rule: over-long blanks are cut, real overflow is kept
    (and reported by the constraint check)."""
    c = _col(c)
    return F.when((F.length(c) > n) & (F.length(F.rtrim(c)) <= n),
                  F.substring(c, 1, n)).otherwise(c)


class Casts:
    """Cast sites of one batch: strict (ANSI, a bad value fails the job) or
    lenient (``try_cast``) with the first failing site kept as a reason."""

    def __init__(self, strict: bool = True):
        self.strict = strict
        self._bad: list[Column] = []

    def __call__(self, c: ColLike, dtype: str, name: str) -> Column:
        c = _col(c)
        if self.strict:
            return c.cast(dtype)
        v = c.try_cast(dtype)
        self._bad.append(F.when(c.isNotNull() & v.isNull(), F.lit("bad " + name)))
        return v

    def int_list(self, c: ColLike, name: str) -> Column:
        c = _col(c)
        v = int_list(c, strict=self.strict)
        if not self.strict:
            self._bad.append(F.when(c.isNotNull() & v.isNull(), F.lit("bad " + name)))
        return v

    def reason(self) -> list[Column]:
        """The ``_reason`` column to add to the batch (none when strict)."""
        if self.strict or not self._bad:
            return []
        return [F.coalesce(*self._bad).alias("_reason")]
