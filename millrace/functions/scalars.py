"""Scalar operators as column expressions. All run inside code generation, none in Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# Text that counts as a number: optional sign, digits with optional fraction, optional exponent.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Names of served models and feature groups.
NAME_PATTERN = "^[a-zA-Z0-9]+$"
NAME_MAX_LENGTH = 256
# Time stamps in metadata records.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_ZONED_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
# Scheme and authority in front of a path.
SCHEME_PATTERN = "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*"
# jdbc:redshift://<cluster>.<id>.<region>.<rest>/<database>?user=<user>
REDSHIFT_PATTERN = r"^jdbc:redshift://([^./?]+)\.([^./?]+)\.([^./?]+)[^/?]*/([^/?]+)"
REDSHIFT_USER_PATTERN = r"[?&]user=([^&]*)"
# ------------------------------------------------------------------------------------------------

_TWO_53 = 1 << 53


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Trials -----------------------------------------------------------------------------------------

def trial_key(names: Sequence[str]) -> Column:
    """``name=value`` pairs joined by ``&`` in the given order; a null value prints as ``null``."""
    pairs = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("null"))) for n in names]
    return F.concat_ws("&", *pairs)


def to_metric(value: str | Column) -> Column:
    """Number out of a number or numeric text, else null. NaN is not a metric."""
    text = _col(value).cast("string")
    number = F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(number), number)


def require_metric(value: str | Column) -> Column:
    """As :func:`to_metric`, but text that is no number fails the job."""
    value = _col(value)
    message = F.concat(F.lit("Metric is not a number: "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.coalesce(to_metric(value), F.raise_error(message).cast("double"))


def decode_outputs(text: str | Column) -> Column:
    """Stored trial output -> map. A bare number becomes ``{"metric": number}``."""
    text = _col(text)
    return F.when(
        text.rlike(NUMBER_PATTERN), F.create_map(F.lit("metric"), F.trim(text))
    ).otherwise(F.from_json(text, "map<string,string>"))


def run_metric(outputs: str | Column, metric_key: str | None = None) -> Column:
    """Metric of a run: the named key (which must exist), else ``metric`` of exactly {metric, log}."""
    outputs = _col(outputs)
    if metric_key:
        found = F.map_contains_key(outputs, metric_key)
        missing = F.raise_error(F.lit(f"metric_key {metric_key} is not in the returned values"))
        return F.when(found, outputs[metric_key]).otherwise(missing.cast("string"))
    return F.when(F.size(outputs) == 2, outputs["metric"])


# Durations, names, paths ------------------------------------------------------------------------

def duration_ms(seconds: str | Column) -> Column:
    """Seconds to whole milliseconds; halves go to the even neighbour."""
    return F.bround(_col(seconds) * 1000).cast("long")


def duration_text(millis: str | Column) -> Column:
    """``"H hours, M minutes, S seconds"``; hours restart after 24."""
    total = (_col(millis) / 1000).cast("long")
    hours = F.pmod(F.floor(total / 3600), F.lit(24)).cast("long")
    minutes = F.pmod(F.floor(total / 60), F.lit(60)).cast("long")
    return F.format_string("%d hours, %d minutes, %d seconds", hours, minutes, F.pmod(total, F.lit(60)))


def strip_scheme(path: str | Column) -> Column:
    """``hdfs://host:port/a/b`` -> ``/a/b``."""
    return F.regexp_replace(_col(path), SCHEME_PATTERN, "")


def expand_path(path: str | Column, scheme: str, project_root: str) -> Column:
    """Absolute URI: project paths get the scheme, relative ones the root; foreign schemes fail."""
    path = _col(path)
    foreign = F.raise_error(F.concat(F.lit("not a path of this file system: "), path)).cast("string")
    return (
        F.when(path.startswith(scheme), path)
        .when(path.contains("://"), foreign)
        .when(path.startswith("/"), F.concat(F.lit(scheme), path))
        .otherwise(F.concat(F.lit(f"{scheme}{project_root.rstrip('/')}/"), path))
    )


def project_of(user: str | Column) -> Column:
    """Project in a ``project__user`` name."""
    return F.split(_col(user), "__", 2)[0]


def index_name(project: str | Column, index: str | Column) -> Column:
    return F.lower(F.concat_ws("_", _col(project), _col(index)))


def versioned_name(name: str | Column, version: str | Column) -> Column:
    return F.concat_ws("_", _col(name), _col(version).cast("string"))


def is_valid_name(name: str | Column) -> Column:
    name = _col(name)
    return name.rlike(NAME_PATTERN) & (F.length(name) <= NAME_MAX_LENGTH)


def iso_timestamp(text: str | Column) -> Column:
    return F.to_timestamp(_col(text), ISO_ZONED_FORMAT)


# Connectors -------------------------------------------------------------------------------------

def parse_arguments(text: str | Column, separator: str = ",") -> Column:
    """``"k=v,k=v"`` -> map. A repeated key keeps its last value."""
    pairs = F.filter(F.split(_col(text), f"\\Q{separator}\\E"), lambda p: p.contains("="))
    entries = F.transform(
        pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"),
                                  F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("value"))
    )
    # Later pairs win: keep an entry only when no later one has its key.
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(last)


def redshift_parts(url: str | Column) -> Column:
    """Struct (region, cluster, database, user) of a Redshift JDBC URL; null for other URLs."""
    url = _col(url)
    part = lambda i: F.regexp_extract(url, REDSHIFT_PATTERN, i)
    return F.when(
        url.rlike(REDSHIFT_PATTERN),
        F.struct(
            part(3).alias("region"),
            part(1).alias("cluster"),
            part(4).alias("database"),
            F.nullif(F.regexp_extract(url, REDSHIFT_USER_PATTERN, 1), F.lit("")).alias("user"),
        ),
    )


# Parameter search -------------------------------------------------------------------------------

def draw(seed: int, *keys: str | Column) -> Column:
    """Uniform number in [0, 1) fixed by the seed and the keys, whatever the partitioning."""
    hashed = F.xxhash64(F.lit(seed).cast("long"), *[_col(k).cast("long") for k in keys])
    return F.pmod(hashed, F.lit(_TWO_53)) / F.lit(float(_TWO_53))


def uniform_between(low, high, unit: Column) -> Column:
    """Two ints give an inclusive integer, otherwise a real in [low, high)."""
    for bound in (low, high):
        if isinstance(bound, bool) or not isinstance(bound, (int, float)):
            raise ValueError(f"bounds must be int or float, not {bound!r}")
    if not low < high:
        raise AssertionError(f"lower bound {low} must be less than upper bound {high}")
    if isinstance(low, int) and isinstance(high, int):
        return (F.floor(unit * F.lit(high - low + 1)) + F.lit(low)).cast("long")
    return F.lit(float(low)) + unit * F.lit(float(high) - float(low))


def clamp(value: str | Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), _col(value)))


def clamp_whole(value: str | Column, low: float, high: float) -> Column:
    """Clip to the bounds, then round halves to even."""
    return F.bround(clamp(value, low, high))


def donor(base: Column, plus: Column, minus: Column, weight: float) -> Column:
    return base + F.lit(float(weight)) * (plus - minus)


def crossover(unit: Column, rate: float, donor_gene: Column, target_gene: Column) -> Column:
    """Gene of the donor when the draw is at most the rate, else of the target."""
    return F.when(unit <= F.lit(float(rate)), donor_gene).otherwise(target_gene)


def category(values: Sequence, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# Histograms -------------------------------------------------------------------------------------

def bin_index(value: Column, low, high, bins: int) -> Column:
    """Equal-width bin, 0-based: half-open bins, the last one closed."""
    value, low, high = value.cast("double"), F.lit(low).cast("double"), F.lit(high).cast("double")
    width = (high - low) / F.lit(float(bins))
    position = F.floor(F.try_divide(value - low, width)).cast("int")
    # A column with one value has no width; all of it is in the first bin.
    return F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))


def bin_label(index: Column, low, high, bins: int) -> Column:
    """Upper edge of a bin; the last edge is the maximum itself. Limits are numbers or columns."""
    low, high = F.lit(low).cast("double"), F.lit(high).cast("double")
    width = (high - low) / F.lit(float(bins))
    return F.when((index == bins - 1) | (low == high), high).otherwise(F.round(low + (index + 1) * width, 10))


# Metrics of models ------------------------------------------------------------------------------

def check_metrics(metrics: Mapping | None) -> dict[str, float]:
    """Metrics handed over by a caller: a dict of text to numbers (or numeric text)."""
    if metrics is None:
        return {}
    assert isinstance(metrics, Mapping), "metrics must be a dict"
    checked = {}
    for key, value in metrics.items():
        assert isinstance(key, str), f"metric name {key!r} is not a string"
        try:
            checked[key] = float(value)
        except (TypeError, ValueError):
            raise AssertionError(f"metric {key} is not a number: {value!r}") from None
    return checked


def invalid_metrics(metrics: str | Column) -> Column:
    """Names whose value in a ``map<string,string>`` column is no number."""
    bad = F.map_filter(_col(metrics), lambda _, value: to_metric(value).isNull())
    return F.map_keys(bad)
