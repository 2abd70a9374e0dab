"""Small column-expression helpers shared by operators and oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rnd(c: Column | str, digits: int = 8) -> Column:
    """Round half-up and normalise -0.0 to 0.0 (hash-stable output)."""
    c = F.col(c) if isinstance(c, str) else c
    r = F.round(c, digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def sql_rnd(expr: str, digits: int = 8) -> str:
    """SQL twin of :func:`rnd` for DuckDB / Spark SQL strings."""
    return f"(CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END)"


def round_doubles(df: DataFrame, digits: int = 8, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    out = []
    for name, typ in df.dtypes:
        if typ in ("double", "float"):
            out.append(rnd(F.col(name).cast("double"), overrides.get(name, digits)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def ntz_to_micros(c: Column) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ by field arithmetic (no session
    time zone is involved, unlike casts to TIMESTAMP)."""
    days = F.unix_date(F.to_date(c)).cast("bigint")
    sec_frac = F.date_part(F.lit("SECOND"), c)  # decimal seconds with micro fraction
    return (days * F.lit(86_400_000_000) + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(c).cast("bigint") * F.lit(60_000_000)
            + (sec_frac * F.lit(1_000_000)).cast("bigint"))


def micros_to_ntz(m: Column) -> Column:
    """Inverse of :func:`ntz_to_micros` (whole seconds)."""
    days = F.floor(m / F.lit(86_400_000_000))
    rem = (m - days * F.lit(86_400_000_000)) / F.lit(1_000_000)
    d = F.date_from_unix_date(days.cast("int"))
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.floor(rem / 3600).cast("int"), F.floor((rem % 3600) / 60).cast("int"),
                                (rem % 60).cast("decimal(16,6)"))
