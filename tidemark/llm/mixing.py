"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws an exponential key, -ln(u) / w, where u comes from a hash of its id and w is its quality weight; within a source,
documents are taken in ascending key order until the source's token budget is reached. Whole epochs come first: a source whose target is
2.3 times its size is taken twice in full, and the keys decide the remaining 0.3.

The order within a source is never sorted as a whole. Keys fall into buckets that follow the key order; bucket totals are prefix-summed,
and only the one bucket of each source in which the budget runs out is sorted row by row. A source with a third of all rows therefore
costs one small sort like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import settle, small

WORD = r"[^\x20\x09-\x0D]+"
#: Rows for each bucket of a source, at most so many buckets for a source, and the most sources that are broadcast (about 100 bytes each).
BUCKET_ROWS, MAX_BUCKETS, MAX_SOURCES = 128, 65_536, 100_000

#: The largest key of a positive weight; without one, keys start at 1e20 times the smallest -ln(u), some 1e-16, of it.
LAST = 1e280


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """The default quality weight: 0.05 for no letters, 1 for nothing but letters."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.lit(0.05) + F.lit(0.95) * F.coalesce(letters / F.greatest(F.length(text), F.lit(1)), F.lit(0.0))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / w with u from the first 52 bits of a hash of the seed and the id, or without one of the text.

    Rows whose weight is null, not a number, zero or negative come after all others, at random among themselves. Positive weights keep keys
    up to ``LAST``, so that those below some 1e-279 are alike.
    """
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.coalesce(text, F.lit(""))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    w = weight.cast("double")
    return F.when((w > 0) & ~F.isnan(w), F.least(-F.log(u) / w, F.lit(LAST))).otherwise(-F.log(u) * F.lit(LAST * 1e20))


def _drawn(docs: DataFrame, doc_id: str, text: str, source: str, weight: Column | None, seed: int) -> dict[str, Column]:
    return {
        "doc_id": F.col(doc_id),
        "source": F.col(source),
        "size": n_words(F.col(text)),
        "key": sampling_key(F.col(doc_id), F.col(text), letter_share(F.col(text)) if weight is None else weight, seed),
    }


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size, n)``, which has one row for each source.

    Sources by code point, null last, take the weights in turn. They share ``share`` of all sizes by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again by weight. With sources in order of size over weight, those
    that stop come first, so one running sum finds the level at which the rest is shared.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    s = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("full_at", F.col("cap") / F.col("w"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    s = s.withColumn("level", left / w_left).withColumn("stops", F.col("level") >= F.col("full_at"))
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    return s.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(F.col("w") * level)).select("source", "source_size", "n", "target")


def _bucket() -> Column:
    return F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("buckets")), F.col("buckets") - 1)


def _chosen() -> Column:
    within = F.struct("key", "doc_id", "size") <= F.struct("last.key", "last.doc_id", "last.size")
    return F.coalesce((F.col("bucket") < F.col("stop")) | ((F.col("bucket") == F.col("stop")) & within), F.lit(False))


def _plan(drawn: DataFrame, weights, share, max_epochs) -> DataFrame:
    """One row for each source: its target, whole epochs, the bucket in which the rest runs out and the last row taken there."""
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = targets(sizes, weights, share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = settle(plan.withColumn("buckets", F.least(F.lit(MAX_BUCKETS), F.ceil(F.col("n") / BUCKET_ROWS)).cast("long")))

    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    rows = drawn.alias("d").join(small(plan, MAX_SOURCES).alias("p"), same).select("d.*", "p.buckets", "p.rest").withColumn("bucket", _bucket())
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    stops = totals.withColumn("upto", F.sum("size").over(upto)).alias("d").join(small(plan, MAX_SOURCES).alias("p"), same).where(
        "d.upto >= p.rest and p.rest > 0"
    ).groupBy("d.source").agg(F.min(F.struct("d.bucket", (F.col("upto") - F.col("size")).alias("before"))).alias("stop"))
    stops = settle(stops.select("source", "stop.bucket", "stop.before"))

    edge = rows.alias("d").join(small(stops, MAX_SOURCES).alias("p"), same & (F.col("d.bucket") == F.col("p.bucket"))).select("d.*", "p.before")
    alike = edge.where("bucket is not null").groupBy("source", "key", "doc_id", "size", "rest", "before").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("words").over(so_far) - F.col("words") / 2
    last = alike.withColumn("middle", middle).where("middle <= rest").groupBy("source").agg(
        F.max(F.struct("key", "doc_id", "size")).alias("last")
    )
    full = plan.alias("d").join(stops.alias("p"), same, "left").select("d.*", F.col("p.bucket").alias("stop"))
    full = full.alias("d").join(last.alias("p"), same, "left").select("d.*", "p.last")
    return settle(full)


def _joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    both = rows.alias("d").join(small(plan, MAX_SOURCES).alias("p"), same, "left")
    both = both.select("d.*", *[f"p.{c}" for c in ("source_size", "target", "epochs", "buckets", "stop", "last")])
    return both.withColumn("bucket", _bucket()).withColumn("times", F.col("epochs") + _chosen().cast("long"))


def mixture(
    docs: DataFrame, doc_id="doc_id", text="text", source="source", weight: Column | None = None, weights=(5.0, 2.0, 1.0), share=1.0, max_epochs=3, seed=17
) -> DataFrame:
    """What the mix takes of each document: ``doc_id, source, size, source_size, target, times, taken``.

    ``size`` counts words; ``times`` is how often the document is taken and ``taken`` its words with repeats. The last document of a
    source is taken if that ends nearer to the target than leaving it. Null texts have size 0 and take part without words; rows
    without an id draw their key by their text; rows whose ``weight`` is null, not a number, zero or negative are drawn only once all others
    of their source are taken; a null source is a source of its own, the last. Rows alike in key, id, source and size are one
    to the draw, and taken or left together. Other columns are ignored, whatever their names; no rows give no rows. Runs with one seed agree.
    """
    drawn = settle(docs.select(*[c.alias(k) for k, c in _drawn(docs, doc_id, text, source, weight, seed).items()]))
    full = _joined(drawn, _plan(drawn, weights, share, max_epochs))
    return full.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mix(
    docs: DataFrame, doc_id="doc_id", text="text", source="source", weight: Column | None = None, weights=(5.0, 2.0, 1.0), share=1.0, max_epochs=3, seed=17
) -> DataFrame:
    """The mixed corpus: rows of ``docs`` with all their columns, each as often as the mix takes it. Cases are as in :func:`mixture`.

    Whether a row is taken follows from its own key and its source's plan, so no text is shuffled.
    """
    columns = _drawn(docs, doc_id, text, source, weight, seed)
    drawn = settle(docs.select(*[c.alias(k) for k, c in columns.items()]))
    plan = _plan(drawn, weights, share, max_epochs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])
    taken = _joined(rows, plan).where("times > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("row.*")
