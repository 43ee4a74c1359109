"""Rates, intervals and exact tests as Column expressions."""

import math

from pyspark.sql import functions as F

Z = 1.96


def expit(z):
    return 1 / (1 + F.exp(-z))


def conversion_rate(buyers, others, sample_size, population):
    """(rate, low, high): buyers against non-buyers scaled to their population, with a Woolf log-odds interval.
    Half a lead goes to both counts in the interval when either is zero; no leads gives null."""
    weight = population / sample_size
    zero = F.least(buyers, others) == 0
    b = F.when(zero, buyers + 0.5).otherwise(buyers.cast("double"))
    o = F.when(zero, others + 0.5).otherwise(others.cast("double"))
    centre = F.ln(b / (F.lit(weight) * o))
    half = Z * F.sqrt(1 / b + 1 / o)
    some = (buyers + others) > 0
    return (F.when(some, buyers / (buyers + F.lit(weight) * others)),
            F.when(some, expit(centre - half)), F.when(some, expit(centre + half)))


def odds_ratio(a, b, c, d):
    """(ratio, low, high) with half a lead added to every cell."""
    log_or = F.ln(((a + 0.5) * (d + 0.5)) / ((b + 0.5) * (c + 0.5)))
    half = Z * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (c + 0.5) + 1 / (d + 0.5))
    return F.exp(log_or), F.exp(log_or - half), F.exp(log_or + half)


def wilson(successes, n, z=Z):
    """(low, high) of the Wilson score interval; null when n is zero."""
    p = successes / F.nullif(n, F.lit(0))
    spread = z * z / F.nullif(n, F.lit(0))
    centre = (p + spread / 2) / (1 + spread)
    half = z * F.sqrt(p * (1 - p) / F.nullif(n, F.lit(0)) + spread / (4 * F.nullif(n, F.lit(0)))) / (1 + spread)
    return F.when(n > 0, F.greatest(F.lit(0.0), centre - half)), F.when(n > 0, F.least(F.lit(1.0), centre + half))


SMALL = 16


def stirling_rest(n):
    """ln(n!) less Stirling's formula: exact values below 16, the series above. Differences of these stay exact at any n, where
    differences of whole log factorials lose digits."""
    exact = F.array(F.lit(0.0), *[F.lit(math.lgamma(i + 1) - (i + 0.5) * math.log(i) + i - 0.5 * math.log(2 * math.pi)) for i in range(1, SMALL)])
    x = F.greatest(n, F.lit(SMALL)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5.0)) - 1 / (1680 * F.pow(x, 7.0))
    return F.when(n < SMALL, F.try_element_at(exact, (n + 1).cast("int"))).otherwise(series)


def deviance(x, mean):
    """x ln(x / mean) + mean - x, by its series where x is near the mean."""
    v = (x - mean) / (x + mean)
    near = (x - mean) * v + 2 * x * v * sum((F.pow(v, 2.0 * j) / (2 * j + 1) for j in range(1, 9)), F.lit(0.0))
    return F.when(F.abs(v) < 0.1, near).when(x == 0, mean).otherwise(x * F.ln(F.greatest(x, F.lit(1)) / mean) + mean - x)


def log_binomial(x, n, p, q):
    """Log probability of x out of n, where p + q = 1."""
    left, inside = n - x, (x > 0) & (x < n)
    size = F.lit(2 * math.pi) * x * (left / F.greatest(n, F.lit(1)))
    body = stirling_rest(n) - stirling_rest(x) - stirling_rest(left) - deviance(x, n * p) - deviance(left, n * q) - 0.5 * F.ln(F.greatest(size, F.lit(1e-300)))
    return F.when(inside, body).when(n == 0, F.lit(0.0)).when(x == 0, n * F.log1p(-p)).otherwise(n * F.log1p(-q))


def log_hypergeometric(k, row, col, size):
    """Log probability of the 2x2 table with k in its first cell, given its margins."""
    p = row.cast("double") / size
    q = (size - row).cast("double") / size
    value = log_binomial(k, col, p, q) + log_binomial(row - k, size - col, p, q) - log_binomial(row, size, p, q)
    return F.when((row == 0) | (row == size), F.lit(0.0)).otherwise(value)


def fisher_p(df, key, a, b, c, d, chunk=4096):
    """Two-sided Fisher exact p per row of `df` (one row per key): adds up every table no likelier than the observed.

    Probabilities fall on both sides of the mode, so these tables are two tails: from the observed table outwards, and from
    its mirror, the nearest table of the other side that is no likelier, found by bisection. Each tail is followed for 40 standard deviations and
    1,000 tables, beyond which its terms are below the smallest double relative to its first; tails are spread over tasks in
    chunks, so neither N nor one factor sets a task's size. A p too small for a double is 0."""
    a, b, c, d = (F.col(x).cast("bigint") for x in (a, b, c, d))
    base = df.select(key, a.alias("__a"), (a + b).alias("__row"), (a + c).alias("__col"), (a + b + c + d).alias("__n"))
    row, col, size, k = F.col("__row"), F.col("__col"), F.col("__n"), F.col("__a")
    n = size.cast("double")
    sd = F.sqrt(row / n * col * ((size - row) / n) * ((size - col) / F.greatest(n - 1, F.lit(1.0))))
    mode = F.floor((row + 1).cast("double") * (col + 1) / (size + 2)).cast("bigint")
    base = base.withColumns({"__lo": F.greatest(F.lit(0), row + col - size), "__hi": F.least(row, col), "__mode": mode, "__reach": F.ceil(40 * sd + 1000).cast("bigint"),
                             "__seen": log_hypergeometric(k, row, col, size) + math.log1p(1e-7)})
    upper = k > F.col("__mode")
    # Bisection outwards from the mode: inside is likelier than the observed table, outside (one past the end included) is not.
    ends = F.struct(F.col("__mode").alias("inside"), F.when(upper, F.col("__lo") - 1).otherwise(F.col("__hi") + 1).alias("outside"))

    def halve(found, _):
        middle = F.floor((found["inside"] + found["outside"]) / 2).cast("bigint")
        likelier = log_hypergeometric(middle, row, col, size) > F.col("__seen")
        apart = F.abs(found["outside"] - found["inside"]) > 1
        return F.struct(F.when(apart & likelier, middle).otherwise(found["inside"]).alias("inside"),
                        F.when(apart & ~likelier, middle).otherwise(found["outside"]).alias("outside"))

    mirror = F.aggregate(F.sequence(F.lit(1), F.lit(64)), ends, halve)["outside"]
    base = base.withColumns({"__mirror": mirror, "__all": log_hypergeometric(F.col("__mode"), row, col, size) <= F.col("__seen")})
    # As likely as the mode: every table counts, the lower tail ends at the mode and the upper one starts next to it.
    mid = F.col("__mode")
    below = F.when(F.col("__all"), mid).when(upper, F.col("__mirror")).otherwise(k)
    above = F.when(F.col("__all"), mid + 1).when(upper, k).otherwise(F.col("__mirror"))
    tails = F.array(F.struct(F.greatest(F.col("__lo"), below - F.col("__reach")).alias("from"), below.alias("to")),
                    F.struct(above.alias("from"), F.least(F.col("__hi"), above + F.col("__reach")).alias("to")))
    spans = base.select(key, "__row", "__col", "__n", F.inline(F.filter(tails, lambda t: t["from"] <= t["to"])))
    starts = spans.withColumn("__from", F.explode(F.sequence("from", "to", F.lit(chunk).cast("bigint")))).repartition(key, "__from")
    tables = starts.withColumn("__k", F.explode(F.sequence("__from", F.least(F.col("__from") + (chunk - 1), F.col("to")))))
    sums = tables.groupBy(key).agg(F.sum(F.exp(log_hypergeometric(F.col("__k"), row, col, size))).alias("p"))
    return df.select(key).join(sums, key, "left").select(key, F.least(F.lit(1.0), F.coalesce("p", F.lit(0.0))).alias("p"))
