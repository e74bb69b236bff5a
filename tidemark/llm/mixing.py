"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources, in code point order with null last, weigh ``weights`` in turn and share the
words of the whole corpus; a target stops at ``most_copies`` times its source's words and the
excess is shared again by weight among the rest until none is above.

Within a source every document has an expected number of copies, proportional to its words to the
power ``size_exponent`` and at most ``most_copies``, such that expected words meet the target. The
whole copies are certain. What is left, a fraction per document, is an inclusion probability:
documents are ranked by their random odds divided by their inclusion odds (Pareto order) and taken
in that order while they fit into the words that remain; one more document, the one that closes
the gap best, ends the sample. The random numbers are hashes of seed, id and text, so reruns agree.

A null text has size 0 and is never taken. Null sources form one source. A null id counts like any
other id. Wholly repeated rows are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch, running_totals


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most_copies: int = 3
    size_exponent: float = 0.25
    seed: int = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(scratch: Scratch, sizes: DataFrame, p: Mix) -> DataFrame:
    """One row per source: source_size, target."""
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(scratch, named, [F.col("source").asc_nulls_last()], [], "sources")
    share = F.element_at(F.array(*map(F.lit, p.weights)), (F.col("position") % len(p.weights) + 1).cast("int"))
    table = scratch.keep(ranked.select("source", "source_size", share.alias("weight")), "weights")
    limit = F.col("source_size") * F.lit(p.most_copies)
    level, capped = 0.0, -1
    while True:  # every round caps one source more, or is the last
        full = F.lit(level) * F.col("weight") >= limit
        row = table.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, limit)).alias("capped"), F.count_if(full).alias("n"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if row["weight"] is None or row["n"] == capped:
            break
        level, capped = (row["all"] - (row["capped"] or 0)) / row["weight"], row["n"]
    target = F.least(F.lit(level) * F.col("weight"), limit.cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def expected_copies(scratch: Scratch, rows: DataFrame, targets: DataFrame, p: Mix) -> DataFrame:
    """Adds ``copies`` to every row: the expected number, at most ``most_copies``."""
    utility = F.pow(F.col("size").cast("double"), F.lit(p.size_exponent))
    at_most = F.coalesce("scale", F.lit(0.0)) * utility >= p.most_copies
    scales = targets.select("source", F.lit(0.0).alias("scale"), F.lit(-1).cast("long").alias("capped"))
    while True:  # a document that is at the limit stays there
        sums = joined(rows, scales).groupBy("source").agg(
            F.sum(F.when(at_most, F.col("size"))).alias("certain"), F.sum(F.when(~at_most, utility * F.col("size"))).alias("mass"),
            F.count_if(at_most).alias("now"), F.first("scale").alias("scale"), F.first("capped").alias("capped"))
        scale = (F.col("target") - p.most_copies * F.coalesce("certain", F.lit(0))) / F.nullif("mass", F.lit(0.0))
        scales = scratch.keep(joined(sums, targets).select(
            "source", F.greatest(F.coalesce(scale, "scale"), "scale").alias("scale"), F.col("now").alias("capped"),
            (F.col("now") > F.col("capped")).alias("moved")), "scales")
        if not scales.where("moved").limit(1).count():
            break
    return joined(rows, scales.select("source", "scale")).withColumn(
        "copies", F.least(F.col("scale") * utility, F.lit(float(p.most_copies)))).drop("scale")


def joined(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    other = by_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def row_key() -> Column:
    """128 bits of source, id and text, with nulls told from empty strings: equal for rows that the mix cannot tell apart."""
    parts = [F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-")) for c in ("source", F.col("doc_id").cast("string"), "text")]
    return F.unhex(F.md5(F.concat(*parts)))


def mix_sources(docs: DataFrame, p: Mix = Mix(), scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times (whole copies), taken (words)."""
    return _mixed(docs, p, scratch or Scratch(docs.sparkSession, "mixing")).drop("row_key")


def _mixed(docs: DataFrame, p: Mix, scratch: Scratch) -> DataFrame:
    random = F.abs(F.xxhash64(F.lit(p.seed), "doc_id", "text") % (1 << 52)) + 0.5
    rows = scratch.keep(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("row_key"), (random / float(1 << 52)).alias("random")), "sizes")
    targets = source_targets(scratch, rows, p)
    rows = expected_copies(scratch, rows, targets, p)
    certain = F.floor(F.col("copies") + 1e-9)
    odds = F.greatest(F.col("copies") - certain, F.lit(0.0))
    rows = rows.withColumns({
        "certain": certain, "order": F.when(odds > 1e-9, F.col("random") / (1 - F.col("random")) / (odds / (1 - odds)))})
    drawn = scratch.keep(rows.select(
        "doc_id", "source", "size", "row_key", "certain", F.coalesce("order", F.lit(float("inf"))).alias("order"),
        F.when(F.col("order").isNotNull(), F.col("size")).otherwise(F.lit(0)).cast("long").alias("drawable")), "drawn")
    order = [F.col("source").asc_nulls_last(), "order", "row_key"]
    ranked = scratch.keep(running_totals(scratch, drawn, order, ["drawable"], "pareto", stored=True), "ranked")
    starts = ranked.groupBy("source").agg(F.min("drawable_before").alias("start"), F.sum(F.col("certain") * F.col("size")).alias("sure"))
    sums = joined(starts, targets).withColumn("need", F.col("target") - F.col("sure"))
    left = F.col("need") - (F.col("drawable_before") - F.col("start"))
    taken_by_rank = (F.col("drawable") > 0) & (F.col("drawable") <= left)
    placed = joined(ranked, sums).withColumn("drawn", F.coalesce(taken_by_rank, F.lit(False)))
    gap = placed.groupBy("source").agg(F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0)).alias("filled"))
    open_ = joined(placed, gap).withColumn("gap", F.col("need") - F.col("filled")).where(~F.col("drawn") & (F.col("drawable") > 0))
    misses = F.abs(F.col("gap") - F.col("size"))
    last = open_.where(misses < F.abs(F.col("gap"))).groupBy("source").agg(
        F.min_by("position", F.struct(misses, "order", "position")).alias("last"))
    last = last.withColumnRenamed("source", "_source")
    times = F.col("certain") + (F.col("drawn") | F.coalesce(F.col("position") == F.col("last"), F.lit(False))).cast("long")
    return placed.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("times", times).select(
        "doc_id", "source", "size", "row_key", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def resample(docs: DataFrame, p: Mix = Mix(), scratch: Scratch | None = None) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns.

    Rows with one source, id and text share the copies of all of them: each comes as often as goes into
    the number of rows, and what is left comes from one of them. So rows out are ``times`` exactly.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    times = scratch.keep(_mixed(docs, p, scratch).groupBy("row_key").agg(
        F.sum("times").alias("all"), F.count(F.lit(1)).alias("rows")).where("all > 0").select(
        F.col("row_key").alias("_key"), F.expr("all div rows").cast("int").alias("each"), F.expr("all % rows").alias("left")), "times")
    rows = docs.select(row_key().alias("_row_key"), F.struct(*docs.columns).alias("row"))

    def repeated(frame: DataFrame, n: Column) -> DataFrame:
        return frame.withColumn("copy", F.explode(F.array_repeat(F.lit(0), n))).select("row.*")

    whole = rows.join(times.where("each > 0"), F.col("_row_key") == F.col("_key"))
    # One row of each such group, sent on in portions so that no task repeats it without bound.
    some = rows.join(times.where("left > 0"), F.col("_row_key") == F.col("_key")).groupBy("_key", "left").agg(F.first("row").alias("row"))
    portion = 1000
    parts = some.withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"(left - 1) div {portion}")))).withColumn(
        "n", F.least(F.lit(portion), F.col("left") - F.col("part") * portion).cast("int"))
    return repeated(whole, F.col("each")).unionByName(repeated(parts.repartition(F.col("_key"), F.col("part")), F.col("n")))
