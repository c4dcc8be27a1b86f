"""Document fingerprints as threshold-scaled sketches, in DataFrame functions only.

A text's sketch keeps every word-shingle hash in the lowest fixed fraction of all hash values.
Because the bound is the same for all texts, sketches of different sizes stay comparable, the sketch
of joined texts is the union of their sketches, and containment of a short text in a long one is
estimated without bias. A text with few hashes below the bound keeps its ``least`` smallest instead
and remembers up to where it is complete; comparisons look no further than both are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.work import partitions

_TOP = 2**63 - 1
#: Boundaries in one group of the two-level search for a row's range.
_FAN = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """Hashes of all word shingles; fewer words are one shingle, no words give an empty array."""
    cut = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def combined(each: Column) -> Column:
        n = F.size(each)
        many = F.transform(
            F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*[F.get(each, i + j) for j in range(words)])
        )
        none = F.array().cast("array<bigint>")
        return F.when(n >= words, many).when(n > 0, F.array(F.xxhash64(each))).otherwise(none)

    return _let(F.transform(cut, lambda w: F.xxhash64(w)), combined)


def sketch(text: Column, words: int = 5, one_in: int = 8, least: int = 32) -> Column:
    """struct(hashes sorted, bound): all distinct shingle hashes up to ``bound`` are in ``hashes``."""
    limit = F.lit(-(2**63) + 2**64 // one_in)

    def kept(hashes: Column) -> Column:
        def choose(low: Column) -> Column:
            def few(every: Column) -> Column:
                first = F.slice(every, 1, least)
                bound = F.when(F.size(every) <= least, F.lit(_TOP)).otherwise(F.element_at(first, -1))
                return F.struct(first.alias("hashes"), bound.alias("bound"))

            return F.when(
                F.size(low) >= least, F.struct(F.array_sort(low).alias("hashes"), limit.alias("bound"))
            ).otherwise(_let(F.array_sort(F.array_distinct(hashes)), few))

        return _let(F.array_distinct(F.filter(hashes, lambda h: h <= limit)), choose)

    return _let(shingle_hashes(F.coalesce(text, F.lit("")), words), kept)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    bound = F.least(a["bound"], b["bound"])
    both = F.array_sort(F.array_union(a["hashes"], b["hashes"]))
    return F.struct(F.filter(both, lambda h: h <= bound).alias("hashes"), bound.alias("bound"))


def _compared(a: Column, b: Column, ratio: Callable[[Column, Column, Column], Column]) -> Column:
    """``ratio(shared, in a, in b)`` over the hashes up to the lower bound; 1 for two texts without words."""

    def up_to(bound: Column) -> Column:
        def counted(parts: Column) -> Column:
            x, y = parts["x"], parts["y"]
            shared = F.size(F.array_intersect(x, y))
            empty = (F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0)
            return F.when(empty, F.lit(1.0)).otherwise(F.coalesce(ratio(shared, F.size(x), F.size(y)), F.lit(0.0)))

        return _let(
            F.struct(
                F.filter(a["hashes"], lambda h: h <= bound).alias("x"), F.filter(b["hashes"], lambda h: h <= bound).alias("y")
            ), counted,
        )

    return _let(F.least(a["bound"], b["bound"]), up_to)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their sketches, 0 to 1."""
    return _compared(a, b, lambda shared, x, y: F.try_divide(shared, x + y - shared))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has, 0 to 1."""
    return _compared(a, b, lambda shared, x, y: F.try_divide(shared, x))


def written(value: Column) -> Column:
    """A sketch as text: its hashes in hex, then a dot and the bound."""
    hexed = F.transform(value["hashes"], lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.lower(F.concat(F.array_join(hexed, ""), F.lit("."), F.lpad(F.hex(value["bound"]), 16, "0")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with a column ``sketch``; a null text is empty."""
    return docs.withColumn("sketch", sketch(F.col(text_col), **options))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``value``, looked up in two levels."""
    groups = [bounds[i : i + _FAN] for i in range(0, len(bounds), _FAN)] or [[]]

    def at_most(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<bigint>")

    coarse = F.size(F.filter(at_most([g[0] for g in groups[1:]]), lambda b: b <= value))
    fine = F.size(F.filter(F.get(F.array(*map(at_most, groups)), coarse), lambda b: b <= value))
    return coarse * _FAN + fine


def with_next(docs: DataFrame, carried: list[str], id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``next``: a struct of the ``carried`` columns of the row that follows.

    Rows follow each other by descending id, ties by the carried columns, null ids last; the first
    follows the last. The order is cut into ranges at quantiles of the ids, so no task sorts more
    than a range; only the first row of each range, one per partition, is looked at together.
    """
    n = partitions(docs.sparkSession)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    order = [F.col(id_col).isNull(), F.bitwise_not(F.col(id_col).cast("long")), *carried]
    rows = docs.withColumn("__range", _range_of(key, sorted(set(cuts))))
    value = F.struct(*carried)
    within = Window.partitionBy("__range").orderBy(*order)
    heads = rows.groupBy("__range").agg(F.min_by(value, F.struct(*[
        part if isinstance(part, Column) else F.col(part) for part in order
    ])).alias("head"))
    # One row per range: the head of the next lower range that has rows, or of the highest.
    low = Window.orderBy("__range")
    whole = low.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        F.col("__range"), F.coalesce(F.lag("head").over(low), F.last("head").over(whole)).alias("__after")
    )
    rows = rows.withColumn("next", F.lead(value).over(within))
    return rows.join(heads, "__range").withColumn("next", F.coalesce("next", "__after")).drop("__range", "__after")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Each text's fingerprint, that of an edited copy, and their likeness.

    The edited text has its last third replaced by the first as many code points of the next text.
    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next); a null
    text is empty, repeated rows are kept.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("sketch", sketch(F.col("text"), **options)), ["text", "sketch"], "id")
    n, third = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    rows = rows.withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next.text"), F.lit(1), third))
    )
    rows = rows.withColumn("changed", sketch(F.col("edited"), **options))
    return rows.select(
        "id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("changed")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next.sketch")).alias("near_next"),
    )
