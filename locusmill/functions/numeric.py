"""Numbers as Column expressions: frequencies, bins, normal scores, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the normal quantile (Wichura 1988, algorithm AS 241, PPND16). Fixed values.
CENTRE_NUM = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
CENTRE_DEN = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
MIDDLE_NUM = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
MIDDLE_DEN = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
TAIL_NUM = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
TAIL_DEN = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def _poly(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def qnorm(p: Column) -> Column:
    """Quantile of the standard normal; null outside (0, 1)."""
    q = p - F.lit(0.5)
    inner = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    centre = q * _poly(inner, CENTRE_NUM) / _poly(inner, CENTRE_DEN)
    middle = _poly(r - 1.6, MIDDLE_NUM) / _poly(r - 1.6, MIDDLE_DEN)
    tail = _poly(r - 5.0, TAIL_NUM) / _poly(r - 5.0, TAIL_DEN)
    outer = F.when(r <= 5.0, middle).otherwise(tail)
    value = F.when(F.abs(q) <= 0.425, centre).when(q < 0, -outer).otherwise(outer)
    return F.when((p > 0) & (p < 1), value)


def normal_score(rank: Column, n: Column) -> Column:
    """Inverse-normal score of a rank."""
    return qnorm((rank - 0.5) / n)


def blom_score(rank: Column, n: Column, k: float = 0.375) -> Column:
    """Rank-based inverse-normal score with offset k."""
    return qnorm((rank - F.lit(k)) / (n - 2 * k + 1))


def fold_maf(af: Column) -> Column:
    """Frequency of the rarer allele; null for null."""
    return F.when(af.isNotNull(), F.least(af, 1 - af))


def log10_bf(lbf: Column) -> Column:
    """log10 of a Bayes factor given as natural log, without overflow."""
    return lbf / F.log(F.lit(10.0))


def _label(value: Column) -> Column:
    """A number at three significant digits, as short as it goes."""
    digits = F.greatest(F.lit(0), F.lit(2) - F.floor(F.log10(F.greatest(F.abs(value), F.lit(1e-300)))).cast("int"))
    scale = F.pow(F.lit(10.0), digits)
    return F.regexp_replace((F.round(value * scale) / scale).cast("decimal(30,12)").cast("string"), r"\.?0+$", "")


def equal_width_bin(value: Column, low: Column, high: Column, bins: int = 5) -> Column:
    """Bin (a, b] of `bins` equal widths over [low, high], the outer edges moved out by a thousandth of the range.

    Labels have three significant digits. With low = high the range is taken as one thousandth of
    its size to either side, as a constant column has no width of its own.
    """
    span = F.when(high > low, high - low).otherwise(F.greatest(F.abs(low), F.lit(0.0)))
    start = F.when(high > low, low).otherwise(low - span / 1000)
    width = F.when(high > low, (high - low) / bins).otherwise(span / 500 / bins)
    edges = [start + width * i for i in range(bins + 1)]
    edges[0], edges[-1] = F.when(high > low, low - span / 1000).otherwise(start), F.when(high > low, high + span / 1000).otherwise(start + width * bins)
    out = F.lit(None).cast("string")
    for a, b in reversed(list(zip(edges, edges[1:]))):
        out = F.when((value > a) & (value <= b), F.concat(F.lit("("), _label(a), F.lit(","), _label(b), F.lit("]"))).otherwise(out)
    return out


def decile(value: Column) -> Column:
    """Tenth of [0, 1] as (a,b], the first closed on both sides; null outside."""
    out = F.lit(None).cast("string")
    for i in range(9, -1, -1):
        low, high = i * 0.1, (i + 1) * 0.1
        inside = (value >= 0.0) & (value <= high) if i == 0 else (value > low) & (value <= high)
        name = f"{'[' if i == 0 else '('}{i / 10:g},{(i + 1) / 10:g}]"
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def constraint_label(pli: Column) -> Column:
    return F.when(pli > 0.9, "Constrained").otherwise("Unconstrained")


def regulatory_label(enhancer: list[Column], promoter: list[Column]) -> Column:
    """Enhancer where any of its flags is set, else Promoter where any of its own is, else null."""
    either = lambda flags: reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])
    return F.when(either(enhancer), "Enhancer").when(either(promoter), "Promoter")


def transcription_start(strand: Column, start: Column, end: Column) -> Column:
    return F.when(strand == "+", start).otherwise(end)


def first_largest(values: dict[str, Column]) -> Column:
    """Name of the largest value, the first on ties; nulls do not count, null if there is no value."""
    largest = F.greatest(*values.values()) if len(values) > 1 else next(iter(values.values()))
    return reduce(lambda acc, kv: F.when(kv[1] == largest, kv[0]).otherwise(acc), reversed(list(values.items())), F.lit(None).cast("string"))
