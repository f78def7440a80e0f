"""Value scales of a measure: min-max, round-number bins, histograms and natural breaks."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

BINS = 2_048  # equal bins from which natural breaks are chosen, unless the caller says otherwise


def domain(df, col):
    """Lowest and highest value as scalar subqueries."""
    return df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()


def rescale(df, col, name="scaled", reverse=False):
    """Position of each value between the lowest (0) and the highest (1); the other way round if reversed."""
    lo, hi = domain(df, col)
    share = (F.col(col) - lo) / (hi - lo)
    return df.withColumn(name, 1 - share if reverse else share)


def histogram(df, col, bins=30):
    """Row count per bin of equal width between the lowest and the highest value; nulls left out."""
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    lo, hi = domain(df, col)
    width = (hi - lo) / F.lit(float(bins))
    value = F.col(col).cast("double")
    number = F.when(width == 0, F.lit(1)).otherwise(F.least(F.floor((value - lo) / width) + 1, F.lit(bins)))
    counts = df.where(F.col(col).isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    slots = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    slots = slots.select("bin", (F.col("lo") + (F.col("bin") - 1) * step).alias("low"), (F.col("lo") + F.col("bin") * step).alias("high"))
    return slots.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def pretty_step(lo, hi, bins=5):
    """Width of about `bins` intervals with round bounds: 1, 2, 5 or 10 times a power of ten."""
    cell = (hi - lo) / F.lit(float(bins))
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    bias, bias5 = 1.5, 0.5 + 1.5 * 1.5
    two = 2 * base - cell < bias * (cell - base)
    five = 5 * base - cell < bias5 * (cell - 2 * base)
    ten = 10 * base - cell < bias * (cell - 5 * base)
    return F.when(~two, base).when(~five, 2 * base).when(~ten, 5 * base).otherwise(10 * base)


def pretty_bins(df, col, bins=5, name="bin"):
    """Number each value's round-number bin from 0, lower bound included; the top value joins the last bin."""
    lo, hi = domain(df, col)
    step = pretty_step(lo, hi, bins)
    first, last = F.floor(lo / step + 1e-7), F.ceil(hi / step - 1e-7)
    number = F.least(F.floor(F.col(col) / step) - first, last - first - 1)
    return df.withColumns({name: number.cast("int"), "bin_low": (first + number) * step})


def _break_classes(k):
    def classes(pdf):
        pdf = pdf.sort_values("value")
        low, high = pdf["low"].to_numpy(float), pdf["high"].to_numpy(float)
        v, w = pdf["value"].to_numpy(float), pdf["n"].to_numpy(float)
        m = len(v)
        parts = min(k, m)
        cw, cs, cq = (np.concatenate([[0.0], np.cumsum(a)]) for a in (w, w * v, w * v * v))
        best, back = np.full((parts + 1, m + 1), math.inf), np.zeros((parts + 1, m + 1), int)
        best[0, 0] = 0.0
        for c in range(1, parts + 1):
            for j in range(c, m + 1):
                i = np.arange(c - 1, j)
                spread = (cq[j] - cq[i]) - (cs[j] - cs[i]) ** 2 / (cw[j] - cw[i])
                cost = best[c - 1, i] + spread
                at = int(np.argmin(cost))
                best[c, j], back[c, j] = cost[at], i[at]
        rows, j = [], m
        for c in range(parts, 0, -1):
            i = back[c, j]
            rows.append((c, low[i], high[j - 1], int(w[i:j].sum())))
            j = i
        return pd.DataFrame(rows[::-1], columns=["class", "low", "high", "n"])

    return classes


def natural_breaks(df, col, k=5, bins=BINS):
    """Classes with the least squared spread within them, as (class, low, high, n); every value lies in one class.

    Values are counted in `bins` equal bins at every size; only that histogram reaches the one task that picks the
    breaks. Classes end between bins, a bin stands at its mean, and the bounds are the values found in the bins.
    Values further apart than one bin are therefore classed exactly.
    """
    value = F.col(col).cast("double")
    values = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    lo, hi = values.agg(F.min("value")).scalar(), values.agg(F.max("value")).scalar()
    slot = F.when(hi > lo, F.least(F.floor((F.col("value") - lo) / ((hi - lo) / bins)), F.lit(bins - 1))).otherwise(0)
    small = values.groupBy(slot.alias("slot")).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"))
    return small.groupBy(F.lit(1).alias("all")).applyInPandas(
        lambda pdf: _break_classes(k)(pdf), "class int, low double, high double, n long"
    )
