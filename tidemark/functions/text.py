"""Values as text, CSV quoting and templates."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells that begin with one of these would run as formulas in a spreadsheet.
FORMULA_START = r"^[=+\-@|\t\r]"
#: Fixed value: a template token.
TOKEN = r"\{\{([\w.]+)\}\}"


def _shortest(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else repr(v).removesuffix(".0") for v in values.to_pylist()], pa.string())


def double_text(value: Column) -> Column:
    """A double in the fewest digits that give it back, as SQL engines and Python write it (Spark's cast writes 12345678.9 as 1.23456789E7
    and, before Java 19, some digits too many): plain from 1e-4 to below 1e16, without a fraction if whole; zero keeps its sign."""
    return F.arrow_udf(_shortest, T.StringType())(value)


def as_text(value: Column, kind: T.DataType) -> Column:
    """A value as the text of a cell: null is empty, a whole double has no fraction, and zero no sign."""
    text = value.cast("string")
    if isinstance(kind, T.DoubleType):
        finite = F.abs(value) < float("inf")
        text = F.when(value == 0, "0").when(finite, double_text(value)).otherwise(text)
    elif isinstance(kind, T.FloatType):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        text = F.when(whole, F.floor(value).cast("string")).otherwise(text)
    return F.coalesce(text, F.lit(""))


def formula_guard(text: Column) -> Column:
    """A tab before cells that a spreadsheet would run."""
    return F.when(text.rlike(FORMULA_START), F.concat(F.lit("\t"), text)).otherwise(text)


def csv_quote(text: Column, guarded: Column | None = None) -> Column:
    """The quoted cell. ``guarded`` says which cells get the tab, for values whose text alone does not tell (minus zero)."""
    text = F.replace(text, F.lit('"'), F.lit('""'))
    text = formula_guard(text) if guarded is None else F.when(guarded, F.concat(F.lit("\t"), text)).otherwise(text)
    return F.concat(F.lit('"'), text, F.lit('"'))


def interpolate(template: Column, tokens: Mapping[str, Column]) -> Column:
    """Replace ``{{name}}`` by the column of that name; a name that is not known fails the job. Braces with spaces are left alone."""
    asked = F.regexp_extract_all(template, F.lit(TOKEN), F.lit(1))
    unknown = F.array_except(asked, F.array(*map(F.lit, tokens)))
    out = template
    for name, value in tokens.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    complaint = F.raise_error(F.concat(F.lit("unknown template token: "), F.array_join(unknown, ", ")))
    return F.when(F.size(unknown) > 0, complaint.cast("string")).otherwise(out)
