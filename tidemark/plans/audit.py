"""Checks before a run: are sources readable, targets there, columns in line. One that throws is one failed row, and stops no other."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, schema
from tidemark.operators.sinks import Store
from tidemark.plans.run import Entry, one_source

FINDINGS = "target_key string, idx int, check string, status string, detail string"
LISTING = "owner int, position int, name string"


@dataclass(frozen=True)
class Check:
    """A named question about a target, or about one of its entries (``idx``). ``ask`` gives a status and a detail, or throws."""

    target: str
    name: str
    ask: Callable[[], tuple[str, str | None]]
    idx: int | None = None


def answered(asked: Sequence[Check], workers: int = 4) -> list[tuple]:
    """A row of ``FINDINGS`` for each check, in their order."""

    def answer(check: Check) -> tuple:
        try:
            status, detail = check.ask()
        except Exception as problem:  # a check that cannot be made has failed
            status, detail = "fail", (str(problem).strip() or type(problem).__name__).splitlines()[0][:500]
        return check.target, check.idx, check.name, status, detail

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(answer, asked))


def _readable(entries: Sequence[Entry], headers: dict[int, list[str]]) -> Iterator[Check]:
    """Each source's columns can be named; what is found is left in ``headers``."""

    def ask(i: int) -> tuple[str, str | None]:
        names = entries[i].names()
        if names is None:
            return "warn", "nothing to read yet"
        headers[i] = names
        return "pass", None

    for i, e in enumerate(entries):
        yield Check(e.target, "source readable", lambda i=i: ask(i), i)


def _ready(targets: Sequence[str], store: Store) -> Iterator[Check]:
    for t in targets:
        yield Check(t, "target ready", lambda t=t: ("pass", None) if (found := store.version(t)) and found[1]["folders"] else ("warn", "will be created"))


def _marks(entries: Sequence[Entry]) -> Iterator[Check]:
    def ask(key: str) -> tuple[str, str | None]:
        one_source([e for e in entries if e.watermark_key == key])
        return "pass", None

    for i, e in enumerate(entries):
        yield Check(e.target, "mark of one source", lambda key=e.watermark_key: ask(key), i)


def _aligned(spark: SparkSession, entries: Sequence[Entry], headers: dict[int, list[str]], store: Store) -> list[tuple]:
    """The columns of every readable entry, with its constants, against its target's, in one pass over all listings.

    A target that is not there, or whose metadata is overridden, takes the columns of its first readable entry. Order counts for files.
    """
    versions, first = {}, {}
    for i, e in enumerate(entries):
        if i in headers and e.target not in versions:
            versions[e.target] = None if any(o.override_metadata for o in entries if o.target == e.target) else store.version(e.target)
            first[e.target] = i

    def full(i: int) -> list[str]:
        """An entry's columns, with constants that overlap none of them."""
        names = {schema.plain_name(c) for c in headers[i]}
        return [n.replace(".", "_") for n in [*headers[i], *[n for n in entries[i].constants if schema.plain_name(n) not in names]]]

    own, provided, expected, constants = [], [], [], []
    for i in sorted(headers):
        held = versions[entries[i].target]
        for rows, names in (
            (own, headers[i]), (provided, full(i)), (expected, held[1]["columns"] if held else full(first[entries[i].target])), (constants, entries[i].constants),
        ):
            rows += [(i, at, n) for at, n in enumerate(names)]
    if not headers:
        return []
    listing = lambda rows: spark.createDataFrame(rows, LISTING)
    diff, clash = schema.column_diff(listing(provided), listing(expected)), schema.overlapping(listing(own), listing(constants))
    ordered = F.col("owner").isin([i for i in headers if entries[i].kind != "sobject"])
    found = checks.alignment(diff, spark.createDataFrame([(i,) for i in headers], "owner int"), ordered, clash)
    return [(entries[r["owner"]].target, r["owner"], "columns align", r["status"], r["detail"] or None) for r in found.collect()]


def audit(spark: SparkSession, entries: Sequence[Entry], store: Store, workers: int = 4, more: Sequence[Check] = ()) -> DataFrame:
    """``target_key, idx, check, status, detail``: every check of every entry (``idx``) and target, with ``more`` of the caller's own.

    Nothing is loaded and no table is read: tables are analysed, of files the first line is read. See
    :func:`tidemark.operators.checks.roll_up` for one status out of many.
    """
    headers: dict[int, list[str]] = {}
    targets = list(dict.fromkeys(e.target for e in entries))
    rows = answered([*_readable(entries, headers), *_ready(targets, store), *_marks(entries), *more], workers)
    try:
        rows += _aligned(spark, entries, headers, store)
    except Exception as problem:
        rows += [(entries[i].target, i, "columns align", "fail", str(problem).splitlines()[0][:500]) for i in sorted(headers)]
    return spark.createDataFrame(rows, FINDINGS)
