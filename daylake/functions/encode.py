"""Row encodings as projections (I2 JSON, I3 CSV, I4 Markdown).

Each returns one text column per row, computed on the executors; the file
sinks (J4) write the same encodings for volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the Markdown cell rule.
MD_MAX = 50
MD_KEEP = 47
MD_ELLIPSIS = "..."


def iso_text(c: Column, dt: T.DataType) -> Column:
    """Date/time as ISO text (``T`` between date and time, micros only when set)."""
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def json_ready(df: DataFrame) -> list[Column]:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c, f.dataType)
        out.append(c.alias(f.name))
    return out


def json_row(df: DataFrame) -> Column:
    """NaN/Inf -> null, date/time -> ISO text, non-ASCII kept, NULL fields kept as null."""
    return F.to_json(F.struct(*json_ready(df)), {"ignoreNullFields": "false"})


def csv_cell(c: Column) -> Column:
    """RFC-4180 quoting only when the text holds , " CR or LF; NULL -> ''."""
    s = c.cast("string")
    needs = s.rlike('[,"\r\n]')
    return F.coalesce(F.when(needs, F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')),
                                             F.lit('"'))).otherwise(s), F.lit(""))


def csv_row(df: DataFrame) -> Column:
    return F.concat_ws(",", *[csv_cell(F.col(f"`{c}`")) for c in df.columns])


def csv_header(columns: list[str]) -> str:
    def q(t: str) -> str:
        return '"' + t.replace('"', '""') + '"' if any(ch in t for ch in ',"\r\n') else t
    return ",".join(q(c) for c in columns)


def md_cell(c: Column) -> Column:
    """I4: NULL -> ``NULL``; longer than 50 chars -> first 47 + ``...``; ``|`` escaped, CR/LF -> space."""
    s = c.cast("string")
    cut = F.when(F.length(s) > MD_MAX, F.concat(F.substring(s, 1, MD_KEEP), F.lit(MD_ELLIPSIS))).otherwise(s)
    esc = F.regexp_replace(F.regexp_replace(cut, r"\|", r"\\|"), "[\r\n]", " ")
    return F.coalesce(esc, F.lit("NULL"))


def md_row(df: DataFrame) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[md_cell(F.col(f"`{c}`")) for c in df.columns]),
                    F.lit(" |"))
