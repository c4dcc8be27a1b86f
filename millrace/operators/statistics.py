"""Column statistics: descriptive measures, correlations, histograms, clusters.

Every family reads only the selected columns. Descriptive measures and Pearson correlations follow
from the same states, which tasks make from their rows and which can be added up later; so do the
bins of histograms, once the limits are known. Ranks need all values of a column in order; clusters
are one KMeans and one PCA job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, types as T
from pyspark.sql import functions as F

from millrace.functions.scalars import bin_label
from millrace.functions.types import numeric_columns

# --- fixed values -------------------------------------------------------------------------------
METRICS = ("count", "mean", "stddev", "min", "max")
MAX_CORRELATION_COLUMNS = 50  # a matrix has fewer columns than this
HISTOGRAM_BINS = 20
CLUSTERS = 5
# ------------------------------------------------------------------------------------------------

#: Columns with up to so many distinct values have their ranks looked up in a broadcast table.
BROADCAST_RANKS = 1 << 16
_MEASURES = ("n", "mx", "my", "qx", "qy", "q", "bad")
_RANGE = ("lo", "hi", "total", "nan", "above", "below")


def check_matrix(columns: Sequence[str]) -> None:
    if len(columns) >= MAX_CORRELATION_COLUMNS:
        raise ValueError(
            f"a correlation matrix takes fewer than {MAX_CORRELATION_COLUMNS} columns, not {len(columns)}"
        )


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


# Moments ----------------------------------------------------------------------------------------

def moments(df: DataFrame, columns: Sequence[str], pairs: bool = True) -> DataFrame:
    """States (feature, other, n, mx, my, qx, qy, q, bad, lo, hi, total, nan, above, below), one per task and pair.

    A state is of the rows where both columns have a value: their number, means, sums of squares and
    products about the means, and the number of rows with a NaN or an infinity. That of a column with
    itself has its finite range and sum and counts of NaN and infinities, too. States are added by
    :func:`merged`; what follows from them does not depend on what other columns there are. Without
    ``pairs`` there are only the columns themselves. Batches are centred on their own means, so that
    large values with a small spread keep their digits.
    """
    names = list(columns)
    schema = "feature string, other string, " + ", ".join(f"{m} double" for m in (*_MEASURES, *_RANGE))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = extent = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part, own = _batch_moments(batch, pairs)
            total = part if total is None else _merged_moments(total, part)
            extent = own if extent is None else np.stack([
                np.fmin(extent[0], own[0]), np.fmax(extent[1], own[1]), *(extent[2:] + own[2:])
            ])
        if total is None:
            return
        width = len(names)
        i, j = np.triu_indices(width) if pairs else (np.arange(width),) * 2
        own = i == j
        sums = total[:, i, j] if pairs else total
        ranges = [pa.array(np.where(own, r[i], np.nan), mask=~own | np.isnan(r[i])) for r in extent]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in i]), pa.array([names[k] for k in j]), *map(pa.array, sums), *ranges],
            names=["feature", "other", *_MEASURES, *_RANGE],
        )

    return _doubles(df, columns).mapInArrow(run, schema)


def _batch_moments(batch, pairs: bool):
    import numpy as np

    values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
    if any(c.null_count for c in batch.columns):
        present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
    else:
        present = None
    finite = np.isfinite(values)
    rows, width = values.shape
    whole = present is None and bool(finite.all())
    good = finite if present is None else finite & present
    many = good.sum(axis=0)
    given = np.full(width, rows) if present is None else present.sum(axis=0)
    total = np.where(good, values, 0.0).sum(axis=0)
    centre = total / np.maximum(many, 1)
    odd = ~finite & (True if present is None else present)
    extent = np.stack([
        np.where(many > 0, np.where(good, values, np.inf).min(axis=0), np.nan),
        np.where(many > 0, np.where(good, values, -np.inf).max(axis=0), np.nan), total,
        (np.isnan(values) & odd).sum(axis=0), ((values == np.inf) & odd).sum(axis=0), ((values == -np.inf) & odd).sum(axis=0),
    ])
    values = np.where(good, values - centre, 0.0)
    sums, squares = values.sum(axis=0), (values * values).sum(axis=0)
    if not pairs:
        some = np.maximum(given, 1)
        mean, spread = centre + sums / some, squares - sums * sums / some
        return np.stack([given, mean, mean, spread, spread, spread, odd.sum(axis=0)]).astype(np.float64), extent
    products = values.T @ values
    if whole:
        ones = np.ones((width, width))
        n, x, y = rows * ones, sums[:, None] * ones, sums[None, :] * ones
        xx, yy, bad = squares[:, None] * ones, squares[None, :] * ones, 0 * ones
    else:
        mask = (np.ones_like(finite) if present is None else present).astype(np.float64)
        wrong = odd.astype(np.float64)
        n, x, y = mask.T @ mask, values.T @ mask, mask.T @ values
        xx, yy = (values * values).T @ mask, mask.T @ (values * values)
        bad = wrong.T @ mask + mask.T @ wrong
    some = np.maximum(n, 1)
    return np.stack([
        n, centre[:, None] + x / some, centre[None, :] + y / some, xx - x * x / some, yy - y * y / some,
        products - x * y / some, bad,
    ]), extent


def _merged_moments(a, b):
    """Counts, means and sums of products about the means of two sets of rows, as of their union."""
    import numpy as np

    n = a[0] + b[0]
    some = np.maximum(n, 1)
    dx, dy, weight = b[1] - a[1], b[2] - a[2], a[0] * b[0] / some
    return np.stack([
        n, (a[0] * a[1] + b[0] * b[1]) / some, (a[0] * a[2] + b[0] * b[2]) / some, a[3] + b[3] + weight * dx * dx,
        a[4] + b[4] + weight * dy * dy, a[5] + b[5] + weight * dx * dy, a[6] + b[6],
    ])


def merged(states: DataFrame) -> DataFrame:
    """One state per pair of columns, of all rows of the given ones."""
    def total_of(value):
        return F.aggregate("p", F.lit(0.0), lambda t, x: t + value(x))

    # One entry per task: the tasks' means differ little, so their spread is added without cancelling.
    sums = states.groupBy("feature", "other").agg(
        F.collect_list(F.struct(*_MEASURES)).alias("p"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in _RANGE[2:]],
    )
    sums = sums.withColumns({m: total_of(lambda x, m=m: x["n"] * x[m]) / F.greatest("n", F.lit(1.0)) for m in ("mx", "my")})
    a, b = F.col("mx"), F.col("my")
    return sums.withColumns({
        "qx": total_of(lambda x: x["qx"] + x["n"] * (x["mx"] - a) * (x["mx"] - a)),
        "qy": total_of(lambda x: x["qy"] + x["n"] * (x["my"] - b) * (x["my"] - b)),
        "q": total_of(lambda x: x["q"] + x["n"] * (x["mx"] - a) * (x["my"] - b)),
    }).select("feature", "other", *_MEASURES, *_RANGE)


# Descriptive measures ---------------------------------------------------------------------------

def measures_of(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, metric, value) of merged states: count, mean, sample deviation, minimum and maximum."""
    n, nan, above, below = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("n", "nan", "above", "below"))
    inf, no_number = F.lit(float("inf")), F.lit(float("nan"))
    values = {
        "count": n,
        "mean": F.when((nan > 0) | ((above > 0) & (below > 0)), no_number).when(above > 0, inf).when(below > 0, -inf).otherwise(F.col("total") / n),
        "stddev": F.when(n > 1, F.when(F.col("bad") > 0, no_number).otherwise(F.sqrt(F.greatest("qx", F.lit(0.0)) / (n - 1)))),
        "min": F.when(below > 0, -inf).otherwise(F.coalesce("lo", F.when(above > 0, inf).otherwise(no_number))),
        "max": F.when(nan > 0, no_number).when(above > 0, inf).otherwise(F.coalesce("hi", -inf)),
    }
    entries = [
        F.struct(
            F.col("feature"), F.lit(m).alias("metric"), (values[m] if m == "count" else F.when(n > 0, values[m])).alias("value")
        )
        for m in METRICS
    ]
    names = state.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    own = state.filter(F.col("feature") == F.col("other"))
    return names.join(own, "feature", "left").select(F.inline(F.array(*entries)))


def descriptive_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, in long form.

    All columns are taken as doubles and by the same arithmetic, whatever their number. Nulls do not
    count; NaN is larger than any number and makes mean and deviation NaN.
    """
    columns = numeric_columns(df, columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, metric string, value double")
    return measures_of(merged(moments(df, columns, pairs=False)), columns)


def descriptive_table(long_form: DataFrame) -> DataFrame:
    """One row per feature, one column per metric."""
    return long_form.groupBy("feature").pivot("metric", list(METRICS)).agg(F.first("value"))


# Correlations -----------------------------------------------------------------------------------

def correlations_of(state: DataFrame) -> DataFrame:
    """The full symmetric matrix (feature, other, correlation) of merged states; 1 for a column with itself."""
    value = F.when(F.col("bad") > 0, F.lit(float("nan"))).when(
        F.col("n") > 0,
        F.when(F.col("feature") == F.col("other"), F.lit(1.0)).otherwise(F.try_divide("q", F.sqrt("qx") * F.sqrt("qy"))),
    )
    one_way = F.struct("feature", "other", F.col("r").alias("correlation"))
    other_way = F.struct(F.col("other").alias("feature"), F.col("feature").alias("other"), F.col("r").alias("correlation"))
    both = F.when(F.col("feature") == F.col("other"), F.array(one_way)).otherwise(F.array(one_way, other_way))
    return state.withColumn("r", value).select(F.inline(both))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """Correlations of all pairs of columns, each as if there were no others.

    A pair leaves out the rows where either value is null, also when values are ranked. NaN or an
    infinity in a row of the pair makes Pearson's correlation NaN; for Spearman's NaN is the largest
    value.
    """
    columns = numeric_columns(df, columns)
    check_matrix(columns)
    if method not in ("pearson", "spearman"):
        raise ValueError(f"method must be pearson or spearman, not {method!r}")
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, other string, correlation double")
    if method == "pearson":
        return correlations_of(merged(moments(df, columns)))
    return _spearman(df, columns)


# Ranks ------------------------------------------------------------------------------------------

def _value_profile(numbers: DataFrame) -> dict:
    """Per column: rows with a value, roughly its distinct values, and cut points. One row reaches the driver.

    Cut points only even out the work; ranks are right for any.
    """
    parts = max(2, min(1000, int(numbers.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    shares = [i / parts for i in range(1, parts)]
    row = numbers.agg(F.count(F.lit(1)).alias("rows"), *[
        f.alias(f"{kind}_{c}") for c in numbers.columns for kind, f in (
            ("n", F.count(c)), ("distinct", F.approx_count_distinct(c)), ("cuts", F.percentile_approx(c, shares, 100)),
        )
    ]).first()
    return {
        "rows": row["rows"],
        **{c: (row[f"n_{c}"], row[f"distinct_{c}"], sorted(set(row[f"cuts_{c}"] or ()))) for c in numbers.columns},
    }


def _ranks(numbers: DataFrame, columns: Sequence[str], against: Sequence[str], profile: dict) -> DataFrame:
    """(column, value, ranks): mean ranks of the values of each column, among all rows and then among
    the rows where each column of ``against`` has a value.

    Values are counted first, so a frequent value is one row. Counts are added up inside the stretches
    between the cut points, and over the stretches before.
    """
    flags = [F.col(c).isNotNull().alias(f"has_{c}") for c in against]
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    long = numbers.select(*flags, F.explode(listed).alias("cell")).select("cell.*", *[f"has_{c}" for c in against])
    counts = ["n", *[f"n_{c}" for c in against]]
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(f"has_{c}").alias(f"n_{c}") for c in against]
    )
    cuts = F.create_map(*[x for c in columns for x in (F.lit(c), F.array(*[F.lit(float(v)) for v in profile[c][2]]).cast("array<double>"))])
    stretch = F.size(F.filter(F.element_at(cuts, F.col("column")), lambda cut: cut < F.col("value")))
    counted = counted.withColumn("stretch", stretch)
    totals = counted.groupBy("column", "stretch").agg(*[F.sum(c).alias(f"all_{c}") for c in counts])
    earlier = Window.partitionBy("column").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("column", "stretch", *[F.coalesce(F.sum(f"all_{c}").over(earlier), F.lit(0)).alias(f"before_{c}") for c in counts])
    upto = Window.partitionBy("column", "stretch").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inside = counted.withColumns({f"upto_{c}": F.sum(c).over(upto) for c in counts})
    mean = F.array(*[F.col(f"before_{c}") + F.col(f"upto_{c}") - (F.col(c) - 1) / 2 for c in counts])
    # The few rows of ``before``, a stretch and column each, meet every value of their stretch.
    return inside.join(F.broadcast(before), ["column", "stretch"]).select("column", "value", mean.alias("ranks"))


def average_ranks(rows: DataFrame, column: str) -> DataFrame:
    """(value, _rank) for the distinct values of a column; equal values share their mean rank."""
    numbers = _doubles(rows, [column])
    found = _ranks(numbers, ["c0"], [], _value_profile(numbers))
    return found.select(F.col("value").cast(rows.schema[column].dataType).alias(column), F.col("ranks")[0].alias("_rank"))


def _spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's correlation of mean ranks, each pair ranked among the rows where both have a value.

    Ranks of columns with few distinct values come from broadcast tables, whose size is checked. The
    cells of the others are shuffled once to their ranks and once back to their rows.
    """
    numbers = _doubles(df, columns)
    profile = _value_profile(numbers)
    gaps = [c for c in numbers.columns if profile[c][0] < profile["rows"]]
    small = [c for c in numbers.columns if profile[c][1] <= BROADCAST_RANKS]
    large = [c for c in numbers.columns if c not in small]
    ranked = numbers
    for c in small:
        own = _ranks(numbers, [c], gaps, profile).select(F.col("value").alias(f"{c}_"), F.col("ranks").alias(f"r{c}"))
        ranked = ranked.join(F.broadcast(own), F.col(c) == F.col(f"{c}_"), "left").drop(f"{c}_")
    ranked = ranked.select(*large, *[f"r{c}" for c in small])
    if large:
        ranked = _joined_ranks(ranked, large, [f"r{c}" for c in small], _ranks(numbers, large, gaps, profile))
    ranked = ranked.select(*[F.col(f"r{c}") for c in numbers.columns])
    return correlations_of(merged(_rank_moments(ranked, list(columns), [numbers.columns.index(c) for c in gaps])))


def _joined_ranks(rows: DataFrame, large: Sequence[str], others: Sequence[str], ranks: DataFrame) -> DataFrame:
    """Rows with the ranks of the ``large`` columns; the ``others`` travel with the first of them."""
    if len(large) == 1:
        own = ranks.select("value", F.col("ranks").alias(f"r{large[0]}"))
        return rows.join(own, F.col(large[0]) == F.col("value"), "left")
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("value"),
            *[(F.col(o) if i == 0 else F.lit(None).cast("array<double>")).alias(o) for o in others],
        )
        for i, c in enumerate(large)
    ])
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    long = numbered.select("row", F.explode(cells).alias("cell")).select("row", "cell.*")
    found = long.join(ranks, ["column", "value"], "left")
    return found.groupBy("row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("ranks"))).alias(f"r{c}") for c in large], *[F.max(o).alias(o) for o in others]
    )


def _rank_moments(ranked: DataFrame, names: list[str], gaps: list[int]) -> DataFrame:
    """States of all pairs, where a cell has its rank among all rows and one for each column with gaps."""
    place = {c: k + 1 for k, c in enumerate(gaps)}
    schema = "feature string, other string, " + ", ".join(f"{m} double" for m in (*_MEASURES, *_RANGE))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        width = len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            size, depth = batch.num_rows, len(gaps) + 1
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            cells = np.zeros((width, size, depth))
            for i, c in enumerate(batch.columns):
                cells[i, present[:, i]] = c.drop_null().flatten().to_numpy().reshape(-1, depth)
            part = np.zeros((len(_MEASURES), width, width))
            for i in range(width):
                for j in range(i, width):
                    both = present[:, i] & present[:, j]
                    x, y = cells[i, both, place.get(j, 0)], cells[j, both, place.get(i, 0)]
                    if len(x):
                        dx, dy = x - x.mean(), y - y.mean()
                        part[:, i, j] = len(x), x.mean(), y.mean(), dx @ dx, dy @ dy, dx @ dy, 0
            total = part if total is None else _merged_moments(total, part)
        if total is not None:
            i, j = np.triu_indices(width)
            none = pa.nulls(len(i), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in i]), pa.array([names[k] for k in j]), *map(pa.array, total[:, i, j]), *[none] * len(_RANGE)],
                names=["feature", "other", *_MEASURES, *_RANGE],
            )

    return ranked.mapInArrow(run, schema)


# Histograms -------------------------------------------------------------------------------------

def bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of each column that has finite data. One row reaches the driver."""
    def finite(c):
        value = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)

    row = df.agg(
        *[F.min(finite(c)).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(finite(c)).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(columns) if row[f"lo_{i}"] is not None}


def bin_counts(df: DataFrame, limits: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """(feature, bin, frequency) of the values inside the limits; a task hands on one row per bin that it met."""
    names = list(limits)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        counts = np.zeros((len(names), bins), np.int64)
        for batch in batches:
            for i, (low, high) in enumerate(limits.values()):
                value = batch.column(i).drop_null().to_numpy()
                value = value[(value >= low) & (value <= high)]
                width = (high - low) / float(bins)
                place = np.floor((value - low) / width) if width else np.zeros(len(value))
                counts[i] += np.bincount(np.minimum(place, bins - 1).astype(np.int64), minlength=bins)
        i, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in i], pa.string()), pa.array(b.astype(np.int32)), pa.array(counts[i, b])],
            names=["feature", "bin", "frequency"],
        )

    return _doubles(df, names).mapInArrow(run, "feature string, bin int, frequency long")


def binned(counts: DataFrame, limits: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """(feature, bin, bin_label, frequency) of all bins, the empty ones included, from added counts."""
    summed = counts.groupBy("feature", "bin").agg(F.sum("frequency").alias("frequency"))
    rows = [(c, float(low), float(high), 1 if low == high else bins) for c, (low, high) in limits.items()]
    grid = counts.sparkSession.createDataFrame(rows, "feature string, low double, high double, used int")
    grid = grid.select("feature", "low", "high", F.explode(F.sequence(F.lit(0), F.col("used") - 1)).alias("bin"))
    label = bin_label(F.col("bin"), F.col("low"), F.col("high"), bins)
    return grid.join(summed, ["feature", "bin"], "left").select(
        "feature", "bin", label.alias("bin_label"), F.coalesce("frequency", F.lit(0).cast("long")).alias("frequency")
    )


def histograms(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = HISTOGRAM_BINS,
    limits: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Equal-width histograms as (feature, bin, bin_label, frequency), empty bins included.

    A column with one distinct value has a single bin. Null, NaN and infinite values are left out.
    """
    columns = numeric_columns(df, columns)
    limits = bounds(df, columns) if limits is None else limits
    limits = {c: limits[c] for c in columns if c in limits}
    if not limits:
        return df.sparkSession.createDataFrame([], "feature string, bin int, bin_label double, frequency long")
    return binned(bin_counts(df, limits, bins), limits, bins)


def cluster_analysis(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    clusters: int = CLUSTERS,
    seed: int = 42,
    id_column: str | Sequence[str] | None = None,
    sample_points: int | None = None,
    max_iterations: int = 20,
) -> DataFrame:
    """Cluster and two-dimensional position of the data points.

    Clusters are fitted on all rows. ``columns`` may be numeric columns or one array column. A point
    is named by its ``id_column``, or by several with slashes between; these columns are no measures.
    ``sample_points`` keeps that many points for a chart, chosen by hash; by default all stay. Rows
    with a null are skipped. The result is (datapoint, cluster, first_dimension, second_dimension).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ids = [id_column] if isinstance(id_column, str) else list(id_column or ())
    name = F.concat_ws("/", *[F.col(f"`{c}`").cast("string") for c in ids]) if ids else F.monotonically_increasing_id()
    is_array = columns is not None and len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.ArrayType)
    if is_array:
        array = F.col(f"`{columns[0]}`").cast("array<double>")
        points = df.filter(array.isNotNull()).select(
            name.cast("string").alias("datapoint"), array_to_vector(array).alias("features")
        )
    else:
        columns = numeric_columns(df, [c for c in columns] if columns else None)
        columns = [c for c in columns if c not in ids] or columns
        numbers = df.select(
            name.cast("string").alias("datapoint"), *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]
        )
        points = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(
            numbers
        ).select("datapoint", "features")
    # A fixed order of rows in partitions is not assumed: the seed drives only the initial draw.
    model = KMeans(k=clusters, seed=seed, maxIter=max_iterations, featuresCol="features",
                   predictionCol="cluster").fit(points)
    width = len(model.clusterCenters()[0])
    assigned = model.transform(points)
    if sample_points is not None:
        assigned = assigned.orderBy(F.xxhash64("datapoint"), "datapoint").limit(sample_points)
    if width >= 2:
        plane = PCA(k=2, inputCol="features", outputCol="plane").fit(points).transform(assigned)
        position = vector_to_array("plane")
        return plane.select("datapoint", "cluster", position[0].alias("first_dimension"),
                            position[1].alias("second_dimension"))
    position = vector_to_array("features")
    return assigned.select("datapoint", "cluster", position[0].alias("first_dimension"),
                           F.lit(0.0).alias("second_dimension"))
