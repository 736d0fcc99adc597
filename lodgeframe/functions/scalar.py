"""Scalar column functions (all native Catalyst expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
PSEUDONYM_SALT = "qbc12"
HIGH_DEMAND_LABEL = "high_demand_proxy"
NOT_HIGH_DEMAND_LABEL = "not_high_demand_proxy"
NORM_EPS = 1e-12


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int) -> Column:
    """``round(x::numeric, digits)`` of PostgreSQL: half away from zero.

    ``round`` on a DOUBLE differs between engines, so the value goes
    through DECIMAL(38,8) first (HALF_UP on decimals everywhere) and comes
    back as DOUBLE.
    """
    return F.round(_c(x).cast("decimal(38,8)"), digits).cast("double")


def exact_avg(x) -> Column:
    """Mean as one IEEE division of an exact sum by the count."""
    c = _c(x)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def pseudonymize(x, salt: str = PSEUDONYM_SALT) -> Column:
    """sha256 hex of ``str(value) + salt``; a null value stays null."""
    return F.sha2(F.concat(_c(x).cast("string"), F.lit(salt)), 256)


def parse_bathrooms(x) -> Column:
    """Bathrooms text to a number.

    null / blank -> null; any text containing ``half`` -> 0.5; otherwise the
    first decimal number in the text; no number -> null.
    """
    t = F.lower(F.trim(_c(x)))
    num = F.regexp_extract(t, r"([0-9]+(\.[0-9]+)?)", 1)
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("double"))
            .when(t.contains("half"), F.lit(0.5))
            .when(num != "", num.try_cast("double")))


def coerce_numeric(x, to: str = "double") -> Column:
    """``pd.to_numeric(errors='coerce')``: unparsable values become null."""
    return _c(x).try_cast(to)


def coerce_boolean(x) -> Column:
    return _c(x).try_cast("boolean")


def sigmoid(raw) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(raw)))


def threshold_label(p, threshold: float = 0.5) -> Column:
    return F.when(_c(p) >= F.lit(threshold), F.lit(HIGH_DEMAND_LABEL)) \
            .when(_c(p).isNotNull(), F.lit(NOT_HIGH_DEMAND_LABEL))


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays (float64 accumulation)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0),
                              lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a, b) -> Column:
    """Cosine similarity; 0.0 when either vector has zero norm."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def l2_normalize(a, eps: float = NORM_EPS) -> Column:
    n = F.greatest(l2_norm(a), F.lit(eps))
    return F.transform(_c(a), lambda v: v.cast("double") / n)


def sort_small(df, *cols):
    """Total order for a result whose size is bounded by a fixed dimension
    (neighbourhoods, thresholds, columns): its finished rows meet in one task
    and are sorted there; what computes them keeps its own partitions."""
    return df.repartition(1).sortWithinPartitions(*cols)


def sanitize_run_name(x) -> Column:
    """Run names as file-safe names: anything but letters, digits, ``._-`` -> ``_``."""
    return F.regexp_replace(_c(x), r"[^\p{L}\p{N}._-]", "_")
