"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: the total shared by source weights, where no
target exceeds ``max_copies`` times the source's own words and the excess is shared again by
weight (water-filling, one window over the table of sources). A document's expected number
of copies is target / words of its source. The whole part is certain; for the fraction f the
documents are ranked by

    (u / (1 - u)) / (f / (1 - f)),      u: a uniform number from a hash of the document id,

random odds over inclusion odds, and taken in this order while the words they add stay within
the target; then the next ones in order that are smaller than twice the gap fill it. The cuts
are found by a histogram over the rank (partial aggregation, no source in one task); only the
bin that holds a cut is ordered row by row.

Rows that share an id share its random number; they follow each other by size and by a hash of
the text, and the cuts fall between rows, not between ids. Only where a cut falls inside a group of
rows that are the same in all of these are its rows numbered (over their partitions, without a
shuffle) and the first so many taken.

Defined results: a null or blank text has size 0 and takes 0 words; a null source is a source of
its own, last in order; a null id hashes as the text 'null'; repeated rows count one by one; no rows
give no rows. Extra columns are kept as they are; the plan's column is called ``mix``, with
underscores added while the input has a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import free_name, written

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1): 52 bits of md5(seed:id)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The windows without a partition run over one pre-aggregated row per source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    index = (F.row_number().over(order) - 1) % len(weights)
    sums = sums.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), index + 1))
    sums = sums.withColumn("cap", F.lit(float(max_copies)) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    share = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    sums = sums.withColumn("level", share).withColumn("level", F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level")))
    level = F.coalesce(F.max("level").over(Window.partitionBy()), F.lit(0.0))
    return sums.select("source", "source_size", F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def joined(left: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` with the columns of a table of one row per source (null is a source)."""
    return left.join(sources.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), how).drop("__s")


def _before(bin_: Column, key: Column, cut_bin: Column, last: Column) -> Column:
    """Does a row stand before the cut? Without a last row the cut is the bin's beginning."""
    return F.coalesce((bin_ < cut_bin) | ((bin_ == cut_bin) & (key <= last)), F.lit(False))


def _cut(rows: DataFrame, limit: str, part: float) -> DataFrame:
    """(source, cut_bin, last, edge, added): how far down the ranking each source's rows go on while
    the words so far, less ``part`` of the row's own, are within ``limit``. ``last``: the last key
    whose rows are all taken; ``edge``: the key after it with how many of its rows are, if any;
    ``added``: the words of all these.

    ``rows``: source, the limit, bin, key (a struct of rank, id, size and text hash), size and n, how
    many rows it stands for (below zero: so many are gone)."""
    bins = rows.groupBy("source", limit, "bin").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    up_to = F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.withColumn("up_to", up_to).withColumn("over", F.col("up_to") > F.col(limit))
    start = F.struct("bin", (F.col("up_to") - F.col("words")).alias("added"))
    cut = bins.groupBy("source").agg(F.min(F.when(F.col("over"), start)).alias("at"), F.sum("words").alias("all"))
    cut = cut.select("source", F.coalesce("at.bin", F.lit(BINS)).alias("cut_bin"), F.coalesce("at.added", "all").alias("before"))
    cut = written(cut, "cut-bins")
    inside = joined(rows, cut).where("bin = cut_bin").groupBy("source", limit, "before", "key", "size").agg(F.sum("n").alias("n")).where("n > 0")
    words = F.col("size") * F.col("n")
    so_far = F.sum(words).over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("so_far", F.col("before") + so_far)
    room = F.col(limit) - (F.col("so_far") - words)
    whole = F.col("so_far") - F.lit(part) * F.col("size") <= F.col(limit)
    some = F.when(F.col("size") > 0, F.least(F.greatest(F.floor(room / F.col("size") + F.lit(part)), F.lit(0)), F.col("n") - 1)).otherwise(F.lit(0))
    inside = inside.withColumn("whole", whole).withColumn("edge", F.when(~whole, F.struct("key", some.cast("long").alias("rows"))))
    last = inside.groupBy("source").agg(F.max(F.when(F.col("whole"), F.col("key"))).alias("last"), F.max(F.when(F.col("whole"), F.col("so_far"))).alias("so_far"), F.min("edge").alias("edge"))
    last = last.withColumn("edge", F.when(F.col("edge.rows") > 0, F.col("edge")))
    added = F.coalesce("so_far", "before") + F.coalesce(F.col("edge.rows") * F.col("edge.key.size"), F.lit(0))
    return joined(cut, last, "left").select("source", "cut_bin", "last", "edge", added.alias("added"))


def _numbered(rows: DataFrame, group: list[Column]) -> DataFrame:
    """``rows`` with ``__place``, each row's number in its group from 1 on, in no particular order."""
    names = [f"__g{i}" for i in range(len(group))]
    rows = rows.withColumns(dict(zip(names, group, strict=True))).sortWithinPartitions(*names).withColumn("__at", F.monotonically_increasing_id())
    rows = written(rows, "cut-rows").withColumn("__part", F.shiftrightunsigned("__at", 33))
    parts = rows.groupBy("__part", *names).agg(F.min("__at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    parts = parts.select(F.col("__part").alias("p"), *[F.col(g).alias(f"p{g}") for g in names], "first", F.coalesce(before, F.lit(0)).alias("before"))
    same = F.col("__part") == F.col("p")
    for g in names:
        same = same & F.col(g).eqNullSafe(F.col(f"p{g}"))
    place = F.col("before") + F.col("__at") - F.col("first") + 1
    return rows.join(parts, same).withColumn("__place", place).drop("__at", "__part", "p", "first", "before", *names, *[f"p{g}" for g in names])


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 42,
) -> DataFrame:
    """``docs`` with one more column ``mix``, a struct (size, source_size, target, copies, taken).

    The texts are scanned twice and not shuffled: sizes first, then the decision, which needs
    the row and the small table of sources only.
    """
    m, p = free_name(docs.columns, "__m"), free_name(docs.columns, "__p")

    def measured(df: DataFrame, at: str) -> DataFrame:
        body = F.col(f"`{text}`").cast("string")
        fields = F.struct(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(body).alias("size"),
                          uniform(F.col(f"`{doc_id}`"), seed).alias("u"), F.xxhash64(body).alias("text"))
        return df.withColumn(at, fields)

    def rank(u: Column, fraction: Column) -> Column:
        return F.when(fraction > 0, (u / (1 - u)) / (fraction / (1 - fraction))).otherwise(F.lit(0.0))

    def bin_of(r: Column) -> Column:
        return F.least(F.lit(BINS - 1), F.floor(r / (1 + r) * BINS)).cast("int")

    sized = written(measured(docs.select(*{f"`{c}`" for c in (doc_id, text, source)}), "m").select("m.*"), "sizes")
    goal = targets(sized.select("source", "size"), weights, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(ratio).cast("long")).withColumn("fraction", ratio - F.floor(ratio))
    goal = written(goal.withColumn("open", F.col("fraction") * F.col("source_size")), "targets")  # words the sample adds

    ranked = joined(sized, goal.where("open > 0").select("source", "fraction", "open")).withColumn("rank", rank(F.col("u"), F.col("fraction")))
    ranked = ranked.withColumn("bin", bin_of(F.col("rank"))).withColumn("key", F.struct("rank", "id", "size", "text")).withColumn("n", F.lit(1).cast("long"))
    first = written(_cut(ranked, "open", 0.0), "cut")
    rest = joined(ranked, first.select("source", "cut_bin", "last", "added"))
    rest = rest.where(~_before(F.col("bin"), F.col("key"), F.col("cut_bin"), F.col("last"))).withColumn("gap", F.col("open") - F.col("added"))
    gone = joined(first.where("edge IS NOT NULL"), goal.select("source", "open")).select(
        "source", (F.col("open") - F.col("added")).alias("gap"), F.col("cut_bin").alias("bin"), "edge.key", F.col("edge.key.size").alias("size"), (-F.col("edge.rows")).alias("n"))
    rest = rest.select("source", "gap", "bin", "key", "size", "n").unionByName(gone).where("size < 2 * gap")
    second = _cut(rest, "gap", 0.5).select("source", F.struct("cut_bin", "last", "edge").alias("second"))
    plan = joined(goal, first.select("source", F.struct("cut_bin", "last", "edge", "added").alias("first")), "left")
    plan = joined(plan, second, "left")
    plan = written(plan.select(F.struct("source", "source_size", "target", "whole", "fraction", "open", "first", "second").alias(p)), "mix")

    out = measured(docs, m).join(plan, F.col(f"{m}.source").eqNullSafe(F.col(f"{p}.source")))
    r = rank(F.col(f"{m}.u"), F.col(f"{p}.fraction"))
    key = F.struct(r.alias("rank"), F.col(f"{m}.id").alias("id"), F.col(f"{m}.size").alias("size"), F.col(f"{m}.text").alias("text"))
    size, gap = F.col(f"{m}.size"), F.col(f"{p}.open") - F.col(f"{p}.first.added")

    def at_edge(cut: str) -> Column:
        return F.coalesce(F.col(f"{p}.{cut}.edge").isNotNull() & key.eqNullSafe(F.col(f"{p}.{cut}.edge.key")), F.lit(False))

    def planned(rows: DataFrame, place: Column) -> DataFrame:
        """``place``: a row's number among those of its key, where a cut falls inside them."""
        in_first = _before(bin_of(r), key, F.col(f"{p}.first.cut_bin"), F.col(f"{p}.first.last")) | (at_edge("first") & (place <= F.col(f"{p}.first.edge.rows")))
        left = place - F.when(at_edge("first"), F.col(f"{p}.first.edge.rows")).otherwise(F.lit(0))
        in_second = _before(bin_of(r), key, F.col(f"{p}.second.cut_bin"), F.col(f"{p}.second.last")) | (at_edge("second") & (left <= F.col(f"{p}.second.edge.rows")))
        more = (F.col(f"{p}.open") > 0) & (in_first | ((size < 2 * gap) & in_second))
        copies = F.col(f"{p}.whole") + F.coalesce(more, F.lit(False)).cast("long")
        result = F.struct(size.alias("size"), F.col(f"{p}.source_size").alias("source_size"), F.col(f"{p}.target").alias("target"), copies.alias("copies"), (copies * size).alias("taken"))
        return rows.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(free_name(docs.columns, "mix")))

    if plan.where(f"{p}.first.edge IS NOT NULL OR {p}.second.edge IS NOT NULL").isEmpty():
        return planned(out, F.lit(0))
    inside = at_edge("first") | at_edge("second")
    tied = _numbered(out.where(inside), [F.col(f"{m}.source"), key])
    return planned(out.where(~inside), F.lit(0)).unionByName(planned(tied, F.col("__place")))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix: each row as often as the plan takes it, columns unchanged."""
    mix = free_name(docs.columns, "mix")
    plan = mix_plan(docs, doc_id, text, source, **options).where(f"{mix}.copies > 0")
    return plan.withColumn(mix, F.explode(F.sequence(F.lit(1), F.col(f"{mix}.copies").cast("int")))).drop(mix)
