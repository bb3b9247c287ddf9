"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words.  Every document of it has the
same expected number of copies per unit of its weight: its whole part is
taken for certain, its fraction is the inclusion probability ``p`` of one
more copy.  The extra copies are a Pareto order sample: documents are ranked
by ``[U / (1 - U)] / [p / (1 - p)]`` with ``U`` from a hash of the id, and the
source's ranking is cut where the words come nearest to what its target
still lacks (the fixed size).

The cut is found without ranking a source as a whole: the rank is a number of
104 bits (52 of the Pareto rank, 52 of a tie-break hash), and a digit of 13
bits at a time a histogram per source tells in which digit the cut falls,
until few rows are left.  Histograms are partial sums, so a source with a
third of all rows is no heavier than others.  What comes out is one cut per
source; each row is then decided by itself, without a shuffle.

Only DataFrame functions are used.

Defined cases: null text has size 0 (taken 0); null sources are one source,
last in order; null and repeated ids and repeated rows are told apart by
the tie-break hash; an empty table gives no rows; other columns are kept by
``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import SPACE_WORD, attach_small, saved
from ladle.operators.positions import positions_within

SEED = 42
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
DIGIT = 13
FINAL_ROWS = 20_000
_TOP = (1 << 52) - 1


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``per_source`` (source, source_size) plus ``target``: water filling in closed form.

    In ascending order of cap over weight, a source is full when the level
    that remains for it and those after it reaches its cap; all others get
    the highest level times their weight.  One row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("double")
    s = (per_source.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
         .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(share)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("budget") - before) / left)
    full = F.col("level") * F.col("w") >= F.col("cap")
    level = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy())
    return s.select("source", "source_size", F.when(full, F.col("cap")).otherwise(level * F.col("w")).alias("target"))


def _copies(sized: DataFrame, goals: DataFrame, limit: float) -> DataFrame:
    """(source, weight, whole, p): copies of a document of that weight; expected words meet the target.

    Expected copies are proportional to the weight and at most ``limit``.
    A weight is a grade with few values per source.
    """
    g = sized.groupBy("source", "weight").agg(F.sum("size").alias("s"))
    g = attach_small(g, goals.select("source", "target"), ["source"])
    order = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before = F.coalesce(F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(F.col("s") * F.col("weight")).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    g = g.withColumn("c", F.when(left > 0, (F.col("target") - before * F.lit(float(limit))) / left).otherwise(F.lit(0.0)))
    full = F.col("c") * F.col("weight") >= limit
    level = F.max(F.when(~full, F.col("c"))).over(Window.partitionBy("source"))
    copies = F.when(full, F.lit(float(limit))).otherwise(F.greatest(level, F.lit(0.0)) * F.col("weight"))
    return (g.withColumn("copies", copies).withColumn("whole", F.floor("copies").cast("long"))
            .select("source", "weight", "s", "target", "whole", (F.col("copies") - F.col("whole")).alias("p")))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":mix:{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def pareto_rank(u: Column, p: Column) -> Column:
    """52 bits of q / (1 + q) for the Pareto rank q; null where there is nothing to sample."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 1e-12, F.least(F.floor(q / (1 + q) * F.lit(float(1 << 52))), F.lit(_TOP)).cast("long"))


def tie_break(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 12)


def cut(rows: DataFrame, need: DataFrame, key: str = "source") -> DataFrame:
    """(key, cut_a, cut_b): rows with (a, b) up to there have the sizes that sum nearest to ``need``.

    ``rows``: key, a, b (52-bit numbers), size; ``need``: key, need.
    """
    state = need.select(key, F.col("need").cast("double").alias("need"), F.lit(0).cast("long").alias("lo_a"),
                        F.lit(0).cast("long").alias("lo_b"))
    state = saved(state, "cut")
    levels = 52 // DIGIT

    def inside(depth: int) -> DataFrame:
        """Rows that share the digits fixed so far."""
        at = attach_small(rows, state, [key], how="inner")
        fixed_a, fixed_b = min(depth, levels), max(depth - levels, 0)
        tests = [F.shiftright(F.col(x), 52 - DIGIT * d) == F.shiftright(F.col(f"lo_{x}"), 52 - DIGIT * d)
                 for x, d in (("a", fixed_a), ("b", fixed_b)) if d]
        return at.where(reduce(lambda x, y: x & y, tests)) if tests else at

    for depth in range(2 * levels):
        x, d = ("a", depth + 1) if depth < levels else ("b", depth + 1 - levels)
        shift = 52 - DIGIT * d
        hist = (inside(depth).groupBy(key, "need", "lo_a", "lo_b", F.shiftright(F.col(x), shift).alias("digit"))
                .agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")))
        w = Window.partitionBy(key).orderBy("digit")
        hist = (hist.withColumn("upto", F.sum("s").over(w)).withColumn("last", F.lead("digit").over(w).isNull())
                .where((F.col("upto") >= F.col("need")) | F.col("last")))
        first = hist.groupBy(key).agg(F.min(F.struct("digit", (F.col("need") - F.col("upto") + F.col("s")).alias("need"),
                                                     "lo_a", "lo_b", "n")).alias("x"))
        low = F.shiftleft(F.col("x.digit"), shift)
        state = saved(first.select(key, "x.need", (low if x == "a" else F.col("x.lo_a")).alias("lo_a"),
                                   (low if x == "b" else F.col("x.lo_b")).alias("lo_b"), "x.n"), "cut")
        most = state.agg(F.max("n")).first()[0]
        state = state.drop("n")
        if (most or 0) <= FINAL_ROWS:
            break
    depth += 1
    w = Window.partitionBy(key).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    taken = saved(inside(depth).withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0)))
             .where(F.col("before") + F.col("size") / 2 <= F.col("need"))
             .groupBy(key).agg(F.max(F.struct("a", "b")).alias("t")), "cut")
    none_a = F.col("lo_a") - 1 if depth <= levels else F.col("lo_a")
    none_b = F.lit(_TOP) if depth <= levels else F.col("lo_b") - 1
    return saved(attach_small(state, taken, [key]).select(
        key, F.coalesce("t.a", none_a).alias("cut_a"), F.coalesce("t.b", none_b).alias("cut_b")), "cut")


def _numbered(docs: DataFrame, same: Column) -> DataFrame:
    """``docs``, written once, with ``__mix_at``: the number of a row among those that are the ``same``.

    Such rows are alike, so whichever of them gets which number, the same rows are taken however the input is split.
    """
    rows = saved(docs.withColumn("__mix_row", F.monotonically_increasing_id()), "numbered")
    groups = rows.select("__mix_row", same.alias("g"))
    many = saved(groups.groupBy("g").count().where("count > 1").select("g"), "repeated")
    at = saved(positions_within(attach_small(groups, many, ["g"], how="inner"), ["g"], [F.col("__mix_row")], "__mix_at"), "places")
    return saved(attach_small(rows, at.select("__mix_row", "__mix_at"), ["__mix_row"]).withColumn(
        "__mix_at", F.coalesce("__mix_at", F.lit(0).cast("long"))), "numbered")


def _decided(docs: DataFrame, seed: int, weights: tuple[int, ...], share: float, limit: float, key: str, text: str,
             source: str, weight: str | None, narrow: bool) -> DataFrame:
    own = {"source": F.col(source).cast("string"), "size": words(text), "id": F.col(key),
           "weight": F.col(weight).cast("double") if weight else F.lit(1.0), "u": uniform(F.col(key), seed),
           "b": tie_break(F.col(key), F.col(text))}
    columns = docs.columns
    sized = saved(docs.select(*[c.alias(k) for k, c in own.items()]), "sized")
    if sized.groupBy("b").count().where("count > 1").take(1):
        docs = _numbered(docs, tie_break(F.col(key), F.col(text), own["source"], own["weight"]))
        own["b"] = tie_break(F.col(key), F.col(text), F.col("__mix_at"))
        sized = saved(docs.select(*[c.alias(k) for k, c in own.items()]), "sized")
    goals = saved(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit), "targets")
    grades = saved(_copies(sized, goals, limit), "copies")
    need = grades.groupBy("source").agg((F.max("target") - F.sum(F.col("whole") * F.col("s"))).alias("need"))
    grade = grades.select("source", "weight", "whole", "p")
    ranked = attach_small(sized, grade, ["source", "weight"]).withColumn("a", pareto_rank(F.col("u"), F.col("p")))
    cuts = cut(ranked.where("a is not null").select("source", "a", "b", "size"), need)
    if narrow:
        big, names = ranked, {k: k for k in ("source", "weight", "a", "b")}
    else:  # the documents themselves: the same decisions, taken again row by row
        names = {k: f"__mix_{k}" for k in ("source", "weight", "a", "b", "u")}
        big = docs.select(*columns, *[own[k].alias(names[k]) for k in ("source", "weight", "b", "u")])
        grade = grade.toDF(names["source"], names["weight"], "__mix_whole", "__mix_p")
        big = attach_small(big, grade, [names["source"], names["weight"]])
        big = big.withColumn(names["a"], pareto_rank(F.col(names["u"]), F.col("__mix_p")))
        cuts = cuts.toDF(names["source"], "cut_a", "cut_b")
    whole = F.col("whole" if narrow else "__mix_whole")
    cuts = cuts.withColumnsRenamed({"cut_a": "__cut_a", "cut_b": "__cut_b"})
    out = attach_small(big, cuts, [names["source"]])
    extra = F.coalesce(F.struct(F.col(names["a"]), F.col(names["b"])) <= F.struct(
        F.col("__cut_a"), F.col("__cut_b")), F.lit(False)) & F.col(names["a"]).isNotNull()
    out = out.withColumn("__copies", (whole + extra.cast("long")).cast("int"))
    return attach_small(out, goals, ["source"]) if narrow else out


def plan(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
         key: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None) -> DataFrame:
    """Per document: id, size, source_size, target (of its source), copies, taken (words, repeats counted)."""
    d = _decided(docs, seed, weights, share, limit, key, text, source, weight, narrow=True)
    return d.select(F.col("id").alias(key), "size", "source_size", "target", F.col("__copies").alias("copies"),
                    (F.col("__copies") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        key: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None) -> DataFrame:
    """The mixture: ``docs`` rows, each as often as it is taken.

    ``docs`` is read twice, and written once more if rows repeat both id
    and text.
    """
    d = _decided(docs, seed, weights, share, limit, key, text, source, weight, narrow=False)
    return (d.where("__copies > 0").withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
            .select(*docs.columns))
