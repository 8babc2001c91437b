"""Mixing sources to target weights by a low-discrepancy schedule over equal-token blocks.

Every source is one stream of words: its documents in shuffled order, end to end, cut into blocks of equal
length. Points of a golden-ratio sequence are mapped through the cumulative weights of the sources; the k-th
point that falls on a source takes the k-th block of its stream, going round a second time where the target
asks for it. The schedule is therefore near the target shares at every moment, not only at its end.

Scale: sizes are summed per source with map-side combine. A source may hold any share of all rows: its stream
is numbered in two steps (totals per slice of the hash range, then inside a slice), slots likewise, and blocks
are joined on (source, block). The source table meets documents by an equi-join that Spark may broadcast after
checking its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.native import SPACED_WORD, count_words
from ratingloom.llm.registry import load, query
from ratingloom.operators.running import running_totals
from ratingloom.session import durable

CYCLE = (3, 1, 2)
GROWTH = 1.5
MAX_REPEAT = 2
BLOCK = 4096  # words per block
SEED = 17
SLICE_ROWS = 5_000  # documents per slice of a stream, slots per chunk of the schedule
GOLDEN = (math.sqrt(5) - 1) / 2


def source_table(sized: DataFrame, cycle=CYCLE) -> DataFrame:
    """(source, source_size, source_no, weight): one row per source, in code-point order, null last."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_totals(sizes, order, {"rank": F.lit(1).cast("long")}).drop("all_rank")
    weights = F.array(*[F.lit(w) for w in cycle])
    weight = F.get(weights, F.pmod(F.col("source_no"), F.lit(len(cycle))).cast("int"))
    return ranked.withColumnRenamed("before_rank", "source_no").withColumn("weight", weight)


def share_targets(sources: DataFrame, growth: float = GROWTH, most: int = MAX_REPEAT) -> DataFrame:
    """Add `target`: `growth` times all sizes shared by weight, no target above `most` times its source.

    What a capped source can't take is shared again among the others by weight. A round needs the totals of
    capped and free sources, three numbers; it ends when no further source is capped, after at most as many
    rounds as there are sources and in practice a few. With `growth` <= `most` there is always room.
    """
    if growth > most:
        raise ValueError("growth must not be above the cap")
    size, weight = F.col("source_size"), F.col("weight")
    level = (0.0, 1.0)  # target of a free source: weight * level[0] / level[1]
    capped_before = -1
    while True:
        full = size * most < weight * level[0] / level[1] if capped_before >= 0 else F.lit(False)
        row = sources.agg(
            F.sum(size).alias("all"),
            F.sum(F.when(full, size)).alias("full"),
            F.sum(F.when(~full, weight)).alias("free"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped_before:
            break
        capped_before = row["capped"]
        level = (growth * (row["all"] or 0) - most * (row["full"] or 0), float(row["free"] or 1))
    even = weight * F.lit(float(level[0])) / F.lit(level[1])
    return sources.withColumn("target", F.least(even, (size * most).cast("double")))


def _slices(rows: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / SLICE_ROWS)))


def lay_streams(sized: DataFrame, rows: int, seed: int = SEED) -> DataFrame:
    """Add `start`: the word at which the document begins in its source's shuffled stream.

    The order is by md5 of seed and id, then by id, size and text digest, so reruns agree; rows alike in all
    of these are interchangeable. A slice is a range of the md5, so a large source is spread over many.
    """
    shuffle = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    keyed = sized.withColumn("__order", shuffle)
    bits = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("__slice", F.floor(bits * F.lit(_slices(rows)) / F.lit(1 << 32)))
    slices = keyed.groupBy("source_no", "__slice").agg(F.sum("size").alias("__words"))
    before = Window.partitionBy("source_no").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "source_no", "__slice", F.coalesce(F.sum("__words").over(before), F.lit(0)).alias("__offset")
    )
    inside = (
        Window.partitionBy("source_no", "__slice")
        .orderBy("__order", "doc_id", "size", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        keyed.withColumn("__before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["source_no", "__slice"])
        .withColumn("start", F.col("__offset") + F.col("__before"))
        .drop("__slice", "__offset", "__before", "__order")
    )


def _blocks(size: Column, block: int) -> Column:
    return F.ceil(size / F.lit(block))


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots of the mix: slot, source_no, rank, block, words (how many words of that block the slot takes).

    A source needs ceil(target / block) slots or, where its stream ends in a short block, a few more. The n-th
    golden-ratio point picks the source whose interval of cumulative need it hits; intervals are cut into
    cells, so the lookup is an equi-join and no table is sent to every task without a check of its size.
    Points that fall on a source already served are passed over; the few slots by which the points fall short
    of a need (logarithmic in their number) close the schedule.
    """
    spark = sources.sparkSession
    goal = F.round("target").cast("long")
    size = F.col("source_size")
    rounds = F.floor(goal / size)
    per_round = _blocks(size, block)
    need = rounds * per_round + _blocks(goal - rounds * size, block)
    needed = sources.where((size > 0) & (F.col("target") > 0)).select(
        "source_no", size, goal.alias("goal"), per_round.alias("per_round"), need.alias("need")
    )
    bounds = durable(running_totals(needed, ["source_no"], {"need": F.col("need")}))
    total, count = bounds.agg(F.sum("need"), F.count(F.lit(1))).first()
    total = total or 0
    cells = max(1024, 4 * count)
    spans = bounds.withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("before_need") * cells / F.col("all_need")),
                F.floor((F.col("before_need") + F.col("need")) * cells / F.col("all_need")),
            )
        ),
    )
    # i * golden ratio modulo 1, in two parts so that large i keep their digits
    high, low = 1 << 20, (GOLDEN * (1 << 20)) % 1
    i = F.col("slot")
    turn = F.floor(i / high) * low + F.pmod(i, F.lit(high)) * GOLDEN
    points = spark.range(total).withColumnRenamed("id", "slot")
    points = points.withColumn("__at", turn - F.floor(turn)).withColumn("cell", F.floor(F.col("__at") * cells))
    at = F.col("__at") * F.col("all_need")
    hits = points.join(spans, "cell").where(
        (at >= F.col("before_need")) & (at < F.col("before_need") + F.col("need"))
    )
    hits = hits.select("slot", "source_no").withColumn("__chunk", F.floor(i / SLICE_ROWS))
    chunks = durable(hits.groupBy("source_no", "__chunk").agg(F.count(F.lit(1)).alias("__hits")))
    before = Window.partitionBy("source_no").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.withColumn("__offset", F.coalesce(F.sum("__hits").over(before), F.lit(0)))
    inside = Window.partitionBy("source_no", "__chunk").orderBy("slot")
    ranked = (
        hits.withColumn("__n", F.row_number().over(inside) - 1)
        .join(offsets, ["source_no", "__chunk"])
        .select("slot", "source_no", (F.col("__offset") + F.col("__n")).alias("rank"))
    )
    served = chunks.groupBy("source_no").agg(F.sum("__hits").alias("__served"))
    late = (
        bounds.join(served, "source_no", "left")
        .withColumn("__served", F.coalesce("__served", F.lit(0)))
        .where(F.col("__served") < F.col("need"))
        .select(
            "source_no", "before_need", F.explode(F.sequence("__served", F.col("need") - 1)).alias("rank")
        )
        .select((F.lit(total) + F.col("before_need") + F.col("rank")).alias("slot"), "source_no", "rank")
    )
    slots = ranked.unionByName(late).join(
        bounds.select("source_no", "source_size", "goal", "per_round", "need"), "source_no"
    )
    turns = F.floor(F.col("rank") / F.col("per_round"))
    in_round = F.col("rank") - turns * F.col("per_round")
    left = F.col("goal") - turns * size - in_round * block
    words = F.least(F.lit(block).cast("long"), size - in_round * block, left)
    return slots.where(F.col("rank") < F.col("need")).select(
        "slot", "source_no", "rank", in_round.alias("block"), words.alias("words")
    )


def mix(docs: DataFrame, block: int = BLOCK, cycle=CYCLE, growth: float = GROWTH, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot: how many words of each document are taken.

    Every row of `docs` (doc_id, text, source) comes back once. `taken` sums to round(target) per source, and no
    document is taken more than twice. Null or blank texts have size 0 and are never taken; a null source is a
    source of its own, after all others. Repeated rows count each on their own. `first_slot` is the place in
    the mix where the document first appears (null if it doesn't).
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    sized = durable(
        docs.select("doc_id", "source", count_words(F.col("text"), SPACED_WORD).alias("size"), digest.alias("digest"))
    )
    rows = sized.count()
    sources = durable(share_targets(durable(source_table(sized))))
    numbered = sized.join(
        sources.select(F.col("source").alias("__source"), "source_no"), F.col("source").eqNullSafe(F.col("__source"))
    ).drop("__source")
    laid = durable(lay_streams(numbered, rows, seed))
    end = F.col("start") + F.col("size")
    pieces = laid.where(F.col("size") > 0).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    )
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(end - F.col("block") * block, F.lit(block))
    pieces = pieces.select("source_no", "start", "block", low.alias("low"), high.alias("high"))
    slots = schedule(sources, block)
    part = F.greatest(F.least(F.col("high"), F.col("words")) - F.col("low"), F.lit(0))
    taken = (
        pieces.join(slots, ["source_no", "block"])
        .withColumn("part", part)
        .where("part > 0")
        .groupBy("source_no", "start")
        .agg(F.sum("part").alias("taken"), F.min("slot").alias("first_slot"))
    )
    # only documents with words begin at a place of their own
    place = F.when(F.col("size") > 0, F.col("start"))
    return (
        laid.withColumn("__place", place)
        .join(
            taken.select(F.col("source_no").alias("__no"), F.col("start").alias("__start"), "taken", "first_slot"),
            (F.col("source_no") == F.col("__no")) & (F.col("__place") == F.col("__start")),
            "left",
        )
        .join(sources.select("source_no", "source_size", "target"), "source_no")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            "first_slot",
            "digest",
        )
    )


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, source, text,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source),
-- by rising ratio of size to weight, a source is capped as long as the level over the rest is above its cap
ordered AS (
    SELECT *, sum(source_size) OVER ()::BIGINT AS all_size,
        coalesce(sum(source_size) OVER before, 0)::BIGINT AS full_size,
        sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS free_weight
    FROM sources
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
    SELECT *, (1.5::DOUBLE * all_size - 2 * full_size) AS rest,
        2 * source_size < weight * (1.5::DOUBLE * all_size - 2 * full_size) / free_weight::DOUBLE AS capped
    FROM ordered),
level AS (SELECT rest, free_weight FROM levels WHERE NOT capped ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
targets AS (
    SELECT source, source_size,
        least(weight * level.rest / level.free_weight::DOUBLE, (2 * source_size)::DOUBLE) AS target
    FROM sources, level),
laid AS (
    SELECT doc_id, source, size,
        coalesce(sum(size) OVER (PARTITION BY source
            ORDER BY md5('17|' || coalesce(doc_id::VARCHAR, 'null')), doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized),
goals AS (
    SELECT l.*, t.source_size, t.target, round(t.target)::BIGINT AS goal
    FROM laid l JOIN targets t ON l.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    (greatest(least(start + size, goal) - start, 0)
        + greatest(least(start + size, goal - source_size) - start, 0))::BIGINT AS taken
FROM goals
"""


@query("op1_mix_sources", ORACLE)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The mix over all documents: words taken from each, near its source's target."""
    docs = load(spark, folder, "documents", "doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(docs: DataFrame) -> DataFrame:
    """Documents with what the mix takes of them; those it takes nothing of are left out.

    Returns the columns of `docs`, then size, source_size, target, taken and first_slot. Columns of `docs` that
    bear one of these names are replaced.
    """
    added = ("size", "source_size", "target", "taken", "first_slot")
    mixed = mix(docs).where(F.col("taken") > 0)
    # rows alike in id, source and text are equal in all that the mix knows: each takes one share
    alike = Window.partitionBy("doc_id", "source", "digest")
    numbered = mixed.withColumn("__n", F.row_number().over(alike.orderBy("first_slot")))
    rows = docs.drop(*added).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("__n", F.row_number().over(alike.orderBy(F.lit(1))))
    left, right = rows.alias("l"), numbered.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "source", "digest", "__n")]
    kept = [F.col(f"l.{c}") for c in rows.columns if c not in ("digest", "__n")]
    return left.join(right, same).select(*kept, *[F.col(f"r.{c}") for c in added])
