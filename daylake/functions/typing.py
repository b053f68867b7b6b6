"""String cell -> typed value, as plain Catalyst expressions (no Python UDF).

Rules (bad cell -> NULL, the row and its neighbours stay):

* integers go through ``DECIMAL(38,0)`` first, so ``'5.7'`` -> 6 (half away
  from zero), ``'1e3'`` -> 1000 and ``' 5 '`` -> 5, then narrow with ``try_cast``;
  an out-of-range value is NULL;
* ``HUGEINT`` (UInt64 ids above 2^63) stays ``DECIMAL(38,0)``;
* DATE / TIMESTAMP need a leading ``YYYY-M-D`` (Spark alone would take ``'2026'``);
* arrays ``[a,b]``: ``[]`` -> empty list, text that is not a bracketed list -> NULL,
  a bad element -> NULL element; quoted elements may hold commas and ``\\'``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.sources.catalog import Catalog

# Fixed patterns of the text forms.
DATE_GUARD = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
LIST_BODY = r"(?s)^\s*\[(.*)\]\s*$"
# Possessive repeats: the matcher walks a quoted element in a loop, so its length costs no stack.
LIST_TOKEN = r"""(?s)\s*('[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,]*)\s*(?:,|$)"""
QUOTED = r"""(?s)^('.*'|".*")$"""
ESCAPED_CHAR = r"(?s)\\(.)"

_INT_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint"}


def typed_scalar(c: Column, working: str) -> Column:
    if working == "VARCHAR":
        return c
    if working == "HUGEINT":
        return c.try_cast("decimal(38,0)")
    if working in _INT_TYPES:
        return c.try_cast("decimal(38,0)").try_cast(_INT_TYPES[working])
    if working == "BOOLEAN":
        return c.try_cast("boolean")
    if working == "DOUBLE":
        return c.try_cast("double")
    if working == "DATE":
        return F.when(c.rlike(DATE_GUARD), c.try_cast("date"))
    if working == "TIMESTAMP":
        return F.when(c.rlike(DATE_GUARD), c.try_cast("timestamp_ntz"))
    raise ValueError(f"illegal working type {working!r}")


def list_elements(c: Column) -> Column:
    """``'[a, 'b,c', NULL]'`` -> ``array('a', 'b,c', NULL)``; not a list -> NULL."""
    body = F.rtrim(F.regexp_extract(c, LIST_BODY, 1))
    tokens = F.regexp_extract_all(body, F.lit(LIST_TOKEN), 1)
    # The scan always yields one empty match at the end; it is a real element
    # only when the body ends in a comma (``[a,]`` -> ``a, ''``).
    tokens = F.when(body.endswith(","), tokens).otherwise(
        F.slice(tokens, 1, F.array_size(tokens) - 1))

    def element(tok: Column) -> Column:
        t = F.trim(tok)
        inner = F.substring(t, F.lit(2), F.length(t) - 2)
        return (F.when(t.rlike(QUOTED) & (F.length(t) >= 2),
                       F.regexp_replace(inner, ESCAPED_CHAR, "$1"))
                .when(F.upper(t) == "NULL", F.lit(None).cast("string"))
                .otherwise(F.regexp_replace(t, ESCAPED_CHAR, "$1")))

    return F.when(c.rlike(LIST_BODY), F.transform(tokens, element))


def typed_array(c: Column, element_working: str) -> Column:
    elements = list_elements(c)
    if element_working == "VARCHAR":
        return elements
    return F.transform(elements, lambda x: typed_scalar(F.nullif(x, F.lit("")), element_working))


def typed(c: Column, working: str) -> Column:
    if working.endswith("[]"):
        return typed_array(c, working[:-2])
    return typed_scalar(c, working)


def filled(c: Column, working: str) -> Column:
    """The typed value of a scalar; of a list only a mark, NULL where the list would be (its elements are not made)."""
    if working.endswith("[]"):
        return F.when(c.rlike(LIST_BODY), F.lit(True))
    return typed_scalar(c, working)


def typed_projection(raw: DataFrame, catalog: Catalog, source: str,
                     keep: tuple[str, ...] = ("load_date",), lists: bool = True) -> DataFrame:
    """Every catalog column typed; ``keep`` columns pass through untouched.  ``lists=False``: lists as :func:`filled`."""
    cols = [(typed if lists else filled)(F.col(f"`{f.storage_name}`"), f.working_type).alias(f.storage_name)
            for f in catalog.fields_for(source)]
    cols += [F.col(k) for k in keep if k in raw.columns]
    return raw.select(*cols)


def array_text(elements: Column, quote: bool = False) -> Column:
    """Inverse helper: array column -> list text ``[a,b]`` (strings quoted and escaped)."""
    def one(x: Column) -> Column:
        s = x.cast("string")
        if quote:
            s = F.concat(F.lit("'"), F.regexp_replace(s, r"([\\'])", r"\\$1"), F.lit("'"))
        return F.coalesce(s, F.lit("NULL"))
    return F.concat(F.lit("["), F.array_join(F.transform(elements, one), ","), F.lit("]"))
