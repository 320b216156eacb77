"""Mixing sources to target token counts by entropy balancing.

Sources share the size of the whole input by weight, none above ``CAP`` times its own size. Rates of documents are those nearest
to 1 in entropy, at most ``CAP``, whose sizes add up to each source's target; the convex dual has one multiplier per
source, and a document's rate is ``least(CAP, exp(multiplier * size / mean size))``. Newton steps on all
multipliers together are one aggregation each over the counts of (source, size); a step that leaves a source's bracket is
halved into it. Rates become copies by rounding: a document's fraction less a hash of its id is its place in line, and
as many of its source's line are rounded up as bring the copies' sizes nearest to the target; then up to ``EXCEPTIONS`` places change
sides, each if that closes more of the gap. The last place to round up is found by histograms, eight bits at a time.

Rows: a null text has size 0; a null source is a source, the last one. Repeated rows each count and get the same copies. A
source of size 0 has target 0 and keeps its documents once. ``mix`` leaves out all other input columns; ``mixed_documents``
keeps all, under positional names inside, so no name can clash. Results depend on the rows only, so reruns agree.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.operators.lookup import by_merge, by_size, small
from shopgrain.operators.ordinal import with_ordinal
from shopgrain.sources.scratch import Size, materialise, measured

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
WORD = r"[^\x20\x09-\x0D]+"
CLOSE = 1e-9  # of a target
STEPS = 100  # far above what bracketed Newton steps need
PLACE_BITS, DIGIT_BITS = 53, 8
EXCEPTIONS = 3  # of a source, to the order of its line


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, rank, source_size, documents, target for written rows of (source, size).

    Sources in code point order, null last, take the weights in turn. The level c, the tokens per unit of weight, rises until the
    sources that are not capped share what the capped ones leave; each step reads sums over the sources only.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    ordered = with_ordinal(
        materialise(totals.withColumn("no_source", F.col("source").isNull()), "sources"),
        ["no_source", "source"],
    )
    turn = F.pmod(F.col("ord") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    weighted = materialise(
        ordered.select("source", F.col("ord").alias("rank"), "source_size", "documents", weight.alias("weight")),
        "weights",
    )
    level, capped_before = 0.0, -1
    most = F.col("source_size") * CAP
    while True:
        capped = most < F.col("weight") * level
        row = weighted.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, most)).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("free"),
            F.count_if(capped).alias("capped"),
        ).first()
        if not row["total"] or row["capped"] == capped_before:
            break
        level = (row["total"] - (row["taken"] or 0.0)) / row["free"]
        capped_before = row["capped"]
    target = F.least(most, F.col("weight") * level)
    return weighted.withColumn("target", target).drop("weight")


def _rate(multiplier: str = "multiplier") -> Column:
    return F.least(F.lit(CAP), F.exp(F.col(multiplier) * F.col("size") / F.col("scale")))


def _exact_sum(x: Column) -> Column:
    """Sum of doubles, rounded one by one, that is the same in any order."""
    return F.sum(x.cast("decimal(32,6)")).cast("double")


def solved_multipliers(cells: DataFrame, targets: DataFrame) -> tuple[DataFrame, Size]:
    """rank, scale, multiplier: the dual's solution for written cells (rank, size, documents), and its size."""
    scale = F.col("source_size") / F.col("documents")
    ratio = F.ln(F.col("target") / F.col("source_size"))
    state = targets.where("source_size > 0").select(
        "rank",
        "target",
        scale.alias("scale"),
        F.lit(0.0).alias("multiplier"),
        F.least(F.lit(0.0), ratio * scale).alias("low"),
        (scale * (math.log(CAP) + CLOSE)).alias("high"),
        F.lit(False).alias("done"),
    )
    state, size = measured(state, "dual")
    most = targets.where("source_size > 0").select("rank", (F.col("source_size") * CAP).alias("most"))
    for _ in range(STEPS):
        tokens = F.col("documents") * F.col("size") * _rate()
        slope = F.when(_rate() < CAP, tokens * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (
            cells.join(by_size(state.where("not done").select("rank", "scale", "multiplier"), size), "rank")
            .groupBy("rank")
            .agg(_exact_sum(tokens).alias("tokens"), _exact_sum(slope).alias("slope"))
        )
        gap = F.col("tokens") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - F.col("gap") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("new_low")) & (newton < F.col("new_high"))
        middle = (F.col("new_low") + F.col("new_high")) / 2
        found = F.abs("gap") <= F.col("target") * CLOSE
        # a capped source's solution is the upper end, which the middle only comes near
        stuck = (middle <= F.col("new_low")) | (middle >= F.col("new_high"))
        at_cap = F.col("target") >= F.col("most") * (1 - CLOSE)
        stepped = (
            state.join(sums, "rank", "left")
            .join(by_size(most, size), "rank")
            .withColumns({"gap": gap, "new_low": low, "new_high": high})
            .select(
                "rank",
                "target",
                "scale",
                F.when(F.col("done") | found, F.col("multiplier"))
                .when(at_cap, F.col("high"))
                .when(inside, newton)
                .otherwise(middle)
                .alias("multiplier"),
                F.when(F.col("done"), F.col("low")).otherwise(F.col("new_low")).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(F.col("new_high")).alias("high"),
                (F.col("done") | found | at_cap | stuck).alias("done"),
            )
        )
        state, size = measured(stepped, "dual")
        if state.where("not done").isEmpty():
            break
    return state.select("rank", "scale", "multiplier"), size


def _place(fraction: Column, id_column: Column) -> Column:
    """Place in a source's line as a whole number of 53 bits, larger first."""
    share = F.shiftrightunsigned(F.xxhash64(id_column), 11).cast("double") * 2.0**-53
    place = F.floor((fraction - share + 1.0) * 2.0 ** (PLACE_BITS - 1))
    return F.greatest(F.lit(0), F.least(place, F.lit((1 << PLACE_BITS) - 1))).cast("bigint")


def _thresholds(line: DataFrame, needs: DataFrame) -> tuple[DataFrame, Size]:
    """rank, threshold, exceptions: rows (rank, place, size) from the threshold on, but for the places in ``exceptions``,
    which change sides, add up near to ``need`` (rank, need). With the size.
    """
    shift = PLACE_BITS
    state, size = measured(
        needs.select("rank", "need", F.lit(0).cast("bigint").alias("prefix"), F.lit(0.0).alias("above")),
        "line",
    )
    while True:
        step = min(DIGIT_BITS, shift)
        inside = line.join(by_size(state.select("rank", "prefix"), size), "rank").where(
            F.shiftright("place", shift) == F.col("prefix")
        )
        shift -= step
        bins = (
            inside.groupBy("rank", F.shiftright("place", shift).alias("bin"))
            .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
        )
        before = (
            Window.partitionBy("rank")
            .orderBy(F.desc("bin"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        ahead = F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead")
        # the first bin that reaches the need, or the last there is
        reached = bins.select("*", ahead).join(by_size(state.select("rank", "need", "above"), size), "rank")
        reached = reached.withColumn("over", F.col("above") + F.col("ahead") + F.col("size") >= F.col("need"))
        chosen = (
            reached.groupBy("rank", "need", "above")
            .agg(
                F.max(
                    F.struct(
                        "over",
                        F.when(F.col("over"), F.col("bin")).otherwise(-F.col("bin")).alias("order"),
                        "bin",
                        "ahead",
                        "size",
                        "rows",
                    )
                ).alias("at")
            )
            .select(
                "rank",
                "need",
                F.col("at.bin").alias("prefix"),
                (F.col("above") + F.col("at.ahead")).alias("above"),
                F.col("at.size").alias("size"),
                F.col("at.rows").alias("rows"),
            )
        )
        state, size = measured(chosen, "line")
        if shift == 0 or state.where("rows > 1").isEmpty():
            break
    take = (F.col("above") + F.col("size") - F.col("need")) <= (F.col("need") - F.col("above"))
    low = F.shiftleft(F.col("prefix"), shift)
    gap = F.col("need") - F.col("above")
    cut, size = measured(
        state.select(
            "rank",
            F.when(take, low).otherwise(low + F.lit(1 << shift)).alias("threshold"),
            F.when(take, gap - F.col("size")).otherwise(gap).alias("gap"),
            F.array().cast("array<bigint>").alias("exceptions"),
        ),
        "thresholds",
    )
    places = line.groupBy("rank", "place").agg(F.sum("size").alias("size"))
    for _ in range(EXCEPTIONS):
        # the place whose change of side closes most of the gap that is left
        below = (F.col("place") < F.col("threshold")) != F.array_contains("exceptions", F.col("place"))
        moved = F.when(below, F.col("size")).otherwise(-F.col("size"))
        left = F.col("gap") - moved
        best = (
            places.join(by_size(cut, size), "rank")
            .where(F.abs(left) < F.abs("gap"))
            .groupBy("rank")
            .agg(F.min(F.struct(F.abs(left), F.col("place").alias("place"), left.alias("left"))).alias("best"))
        )
        cut, size = measured(
            cut.join(best, "rank", "left").select(
                "rank",
                "threshold",
                F.coalesce("best.left", "gap").alias("gap"),
                F.when(F.col("best").isNull(), F.col("exceptions"))
                .when(
                    F.array_contains("exceptions", F.col("best.place")),
                    F.array_remove("exceptions", F.col("best.place")),
                )
                .otherwise(F.array_append("exceptions", F.col("best.place")))
                .alias("exceptions"),
            ),
            "thresholds",
        )
    return cut.drop("gap"), size


def copy_rules(docs: DataFrame, id_column: str, source_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The written sizes (id, source, size), and by (source, size): source_size, target, rate, threshold."""
    sizes = materialise(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            word_count(F.col(text_column)).alias("size"),
        ),
        "sizes",
    )
    targets, targets_size = measured(source_targets(sizes), "targets")
    counted = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("documents"))
    ranks = by_size(targets.select("rank", F.col("source").alias("of_source")), targets_size)
    cells = materialise(
        counted.join(ranks, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source"), "cells"
    )
    solved, solved_size = solved_multipliers(cells, targets)
    rated, rated_size = measured(
        cells.join(by_size(solved, solved_size), "rank", "left")
        .withColumn("rate", F.coalesce(_rate(), F.lit(1.0)))
        .select("source", "rank", "size", "documents", "rate"),
        "rates",
    )
    whole = rated.groupBy("rank").agg(
        F.sum(F.col("documents") * F.col("size") * F.floor("rate")).alias("whole")
    )
    of_source = by_size(targets.select("rank", "target"), targets_size)
    needs = whole.join(of_source, "rank").select("rank", (F.col("target") - F.col("whole")).alias("need"))
    fraction = F.col("rate") - F.floor("rate")
    by_cell = rated.select(F.col("source").alias("of_source"), F.col("size").alias("of_size"), "rank", "rate")
    line = materialise(
        sizes.join(
            by_size(by_cell, rated_size),
            F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size")),
        )
        .where((fraction > 0) & (F.col("size") > 0))
        .select("rank", _place(fraction, F.col("id")).alias("place"), "size"),
        "places",
    )
    rules = (
        rated.drop("documents")
        .join(by_size(*_thresholds(line, needs)), "rank", "left")
        .join(by_size(targets.select("rank", "source_size", "target"), targets_size), "rank")
        .drop("rank")
    )
    rules, size = measured(rules, "rules")
    # Measured to be small, they go to the documents; else the join shuffles both.
    return sizes, F.broadcast(rules) if small(size) else by_merge(rules)


def with_copies(sized: DataFrame, rules: DataFrame, id_column: str, source_column: str, size_column: str) -> DataFrame:
    """Adds ``mix``: source_size, target, rate, copies, for rows with their size."""
    fraction = F.col("rate") - F.floor("rate")
    place = _place(fraction, F.col(id_column))
    from_threshold = place >= F.col("threshold")
    sides = from_threshold != F.array_contains("exceptions", place)
    up = (fraction > 0) & (F.col(size_column) > 0) & sides
    copies = (F.floor("rate") + F.coalesce(up, F.lit(False)).cast("int")).cast("int")
    named = rules.select(
        F.col("source").alias("of_source"),
        F.col("size").alias("of_size"),
        "rate",
        "threshold",
        "exceptions",
        "source_size",
        "target",
    )
    joined = sized.join(
        named,
        F.col(source_column).eqNullSafe(F.col("of_source")) & (F.col(size_column) == F.col("of_size")),
    )
    mix = F.struct("source_size", "target", "rate", copies.alias("copies"))
    return joined.select(*[sized[c] for c in sized.columns], mix.alias("mix"))


def mix(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """id, size, source_size, target, taken, copies, rate of every document."""
    sizes, rules = copy_rules(docs, id_column, source_column, text_column)
    mixed = with_copies(sizes, rules, "id", "source", "size")
    return mixed.select(
        F.col("id").alias(id_column),
        "size",
        "mix.source_size",
        "mix.target",
        (F.col("size") * F.col("mix.copies")).alias("taken"),
        "mix.copies",
        "mix.rate",
    )


def mixed_documents(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """The documents, each as often as the mix takes it, with their columns."""
    _, rules = copy_rules(docs, id_column, source_column, text_column)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: f"c{docs.columns.index(name)}" for name in (id_column, source_column, text_column)}
    sized = renamed.withColumn("words", word_count(F.col(at[text_column])))
    mixed = with_copies(sized, rules, at[id_column], at[source_column], "words")
    repeated = mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("mix.copies"))))
    return repeated.select(*renamed.columns).toDF(*docs.columns)
