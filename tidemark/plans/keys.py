"""Keys of entries: one derivation for runs, which hold entries in Python, and for plans, which hold them as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a default mark key is made of, by kind; a part in quotes is a word, others are fields of the entry. Missing ones are left out.
PARTS = {"elf": ("source_org", "'elf'", "event_type", "interval"), "sobject": ("source_org", "'sobject'", "object"), "csv": ("'csv'", "csv_path")}


def mark_key(kind: str, name: str | None = None, **fields: str | None) -> str:
    """The key of an entry's mark: its name, or else what it reads. Its filter does not count."""
    found = [p.strip("'") if p.startswith("'") else fields.get(p) for p in PARTS[kind]]
    return name or ":".join(p for p in found if p is not None)


def mark_key_column() -> Column:
    """:func:`mark_key` over entries ``name, kind, source_org, object, event_type, interval, csv_path``; an unknown kind fails the job."""
    kind, cases = F.col("kind"), None
    for name, parts in PARTS.items():
        key = F.concat_ws(":", *[F.lit(p.strip("'")) if p.startswith("'") else F.col(p) for p in parts])
        cases = F.when(kind == name, key) if cases is None else cases.when(kind == name, key)
    unknown = F.raise_error(F.concat(F.lit("unknown kind of entry: "), F.coalesce(kind, F.lit("null")))).cast("string")
    return F.coalesce(F.nullif("name", F.lit("")), cases.otherwise(unknown))


class TableId:
    """The identity of a table: equal for DataFrames whose plans read the same sources in the same way."""

    def __init__(self, df: DataFrame):
        self.df, self.code = df, df.semanticHash()

    def __hash__(self) -> int:
        return self.code

    def __eq__(self, other: object) -> bool:
        return isinstance(other, TableId) and self.df.sameSemantics(other.df)
