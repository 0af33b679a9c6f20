"""Mixing sources to target weights by a time-varying curriculum, with DataFrame functions only.

Every source has a share of all words (its target) and a schedule that says
when in training its words are wanted: from ``1 - slope`` at the start to
``1 + slope`` at the end.  The integral of the schedule, ``(1-s) t + s t**2``,
is the source's cumulative demand; a document that starts after ``u`` of its
source's target gets the training position ``t`` at which the demand reaches
``u``.  Range-sorting by that position gives the mixture.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.llm.common import WORD
from curata.storage import materialize

#: Relative demand of sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: How a source's demand moves over training, aligned with the weights: light sources early, heavy ones late.
SLOPES = (-0.8, 0.0, 0.8)
#: A source gives at most so many times its words.
CAP = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _before(*order: Column | str):
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES, cap: int = CAP) -> DataFrame:
    """One row per source: ``skey, source_size, target, slope`` from ``skey, source, source_size``.

    Sources in code-point order, null last, take the weights in turn and share
    all words by them.  No target passes ``cap`` times the source's size; the
    excess is shared again by weight.  In the order of size per weight the
    sources at their cap come first, so the common level of the others is the
    largest of ``(words left) / (weight left)`` over that order.  The windows
    without a key run over one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = totals.select(
        "skey",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1).alias("weight"),
        F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), turn.cast("int") + 1).alias("slope"),
        (F.col("source_size") * cap).cast("double").alias("most"),
    )
    whole = Window.partitionBy()
    order = _before(F.col("most") / F.col("weight"), "skey")
    left = F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("most").over(order), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    level = ranked.withColumn("level", left / weight_left)
    level = level.withColumn("level", F.max("level").over(whole))
    return level.select("skey", "source_size", "slope", F.least("most", F.col("level") * F.col("weight")).alias("target"))


def _schedule_time(done: Column, slope: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``done``: the root of ``s t**2 + (1-s) t = done``."""
    return 2 * done / ((1 - slope) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * done))


def assign(docs: DataFrame, weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES, cap: int = CAP, sizes: DataFrame | None = None) -> DataFrame:
    """Per row of ``doc_id, source, size, ...``: ``source_size, target, slope, goal, offset`` beside its own columns.

    ``goal`` is the target in whole words; ``offset`` counts the words of the
    source's documents before this one in the order of md5(doc_id), so that
    copy ``e`` starts at word ``e * source_size + offset`` and what lies below
    ``goal`` is taken: whole documents but for one part of the last.  A null
    or repeated id, a null source and empty texts are ordinary values; rows
    equal in id and size are interchangeable.

    ``sizes`` may give ``doc_id, source, size`` of the same rows as a written
    table, from which the totals are then taken instead of from ``docs``.
    Running totals have three levels (1024 parts of a source, 1024 parts of
    each, rows), so that no task holds a source: a hot one costs more parts.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def keyed(df: DataFrame) -> DataFrame:
        df = df.withColumns({"skey": F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")), "h": h})
        return df.withColumns({"part": F.conv(F.substring("h", 1, 5), 16, 10).cast("int")})

    rows = keyed(docs)
    coarse = F.shiftright(F.col("part"), 10).alias("coarse")
    fine = keyed(docs if sizes is None else sizes).groupBy("skey", "part").agg(F.sum("size").alias("part_size"), F.min("source").alias("source"))
    fine = fine.withColumn("coarse", coarse)
    big = fine.groupBy("skey", "coarse").agg(F.sum("part_size").alias("coarse_size"), F.min("source").alias("source"))
    totals = big.groupBy("skey").agg(F.sum("coarse_size").alias("source_size"), F.min("source").alias("source"))

    def running(value: str, keys: list[str], *order: str) -> Column:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(frame), F.lit(0))

    big = big.select("skey", "coarse", running("coarse_size", ["skey"], "coarse").alias("big_before"))
    big = big.join(source_targets(totals, weights, slopes, cap), "skey")
    fine = fine.select("skey", "coarse", "part", running("part_size", ["skey", "coarse"], "part").alias("fine_before"))
    fine = fine.join(big, ["skey", "coarse"]).withColumn("before", F.col("big_before") + F.col("fine_before"))
    fine = fine.select("skey", "part", "before", "source_size", "target", "slope")
    rows = rows.withColumn("here", running("size", ["skey", "part"], "h", "doc_id", "size"))
    out = rows.join(fine, ["skey", "part"])
    return out.select(
        *own,
        "source_size",
        "target",
        "slope",
        F.floor(F.col("target") + 0.5).alias("goal"),
        (F.col("before") + F.col("here")).alias("offset"),
    )


def taken_words(copy: int | Column) -> Column:
    """Words that copy number ``copy`` of a document gives."""
    start = F.lit(copy) * F.col("source_size") + F.col("offset") if isinstance(copy, int) else copy * F.col("source_size") + F.col("offset")
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - start)).cast("long")


def position(copy: int | Column) -> Column:
    start = (F.lit(copy) if isinstance(copy, int) else copy) * F.col("source_size") + F.col("offset")
    done = F.least(F.lit(1.0), start / F.greatest(F.col("goal"), F.lit(1)))
    return _schedule_time(done, F.col("slope"))


def mix(docs: DataFrame, text: str = "text", weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES, cap: int = CAP) -> DataFrame:
    """The mixture itself: the columns of ``docs``, one row per copy taken, range-sorted by training position.

    Whole texts are repeated up to ``cap`` times; the one document of a source
    where its target ends gives its first words, and ``n_chars`` follows where
    there is such a column.  Documents without words are kept once, at the
    position their place in the source gives.  An empty table stays empty.
    """
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", word_count(F.col(f"`{text}`")).alias("size"))
    sizes = materialize(inner.select("doc_id", "source", "size"), "sizes")
    placed = assign(inner, weights, slopes, cap, sizes)
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    copies = copies.withColumns({"words": taken_words(F.col("copy")), "position": position(F.col("copy"))})
    copies = copies.where("words > 0 or (size = 0 and copy = 0)")
    head = F.expr(r"regexp_extract(row.`" + text + r"`, concat('^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){', words, '}+'), 0)")
    cut = F.when(F.col("words") < F.col("size"), head).otherwise(F.col(f"row.`{text}`"))
    out = copies.withColumn("cut", cut).orderBy("position", "doc_id", "copy")
    fields = []
    for c in docs.columns:
        if c == text:
            fields.append(F.col("cut").alias(c))
        elif c == "n_chars":
            fields.append(F.when(F.col("words") < F.col("size"), F.length("cut").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            fields.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*fields)


def mixture_digest(docs: DataFrame) -> DataFrame:
    """Per document what the mix takes of it: ``doc_id, size, source_size, target, taken, first_position``, in training order.

    Nulls, ties, repeated rows and empty tables are as in ``assign``.
    """
    rows = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    placed = assign(rows)
    taken = sum((taken_words(e) for e in range(1, CAP)), taken_words(0))
    out = placed.select("doc_id", "size", F.col("source_size").cast("long"), "target", taken.alias("taken"), position(0).alias("first_position"))
    return out.orderBy("first_position", "doc_id")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
    (3 * source_size)::DOUBLE AS most FROM t),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER o, 0.0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS level FROM w
    WINDOW o AS (ORDER BY most / weight, coalesce('s' || source, 'n') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(most, max(level) OVER () * weight) AS target,
    (weight - 2.0) * 0.8 AS slope FROM l),
p AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.slope, floor(g.target + 0.5)::BIGINT AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, least(1.0, o::DOUBLE / greatest(goal, 1)::DOUBLE) AS u FROM p)
SELECT doc_id, size, source_size, target,
    (greatest(0, least(size, goal - o)) + greatest(0, least(size, goal - source_size - o))
        + greatest(0, least(size, goal - 2 * source_size - o)))::BIGINT AS taken,
    2 * u / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) AS first_position
FROM q
"""
