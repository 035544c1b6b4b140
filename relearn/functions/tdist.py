"""Student t two-sided p-value as a Spark SQL expression.

No SciPy on the executors and no Python UDF: the tail probability of the t
distribution with an integer number of degrees of freedom has a finite series
(Abramowitz & Stegun 26.7.3 / 26.7.4).  With theta = atan(|t| / sqrt(df)):

    even df:  A = sin(theta) * sum_{k=0}^{(df-2)/2} b_k cos(theta)^(2k),
              b_0 = 1, b_k = b_{k-1} (2k - 1) / (2k)
    odd df:   A = 2/pi * (theta + sin(theta) cos(theta) * sum_{k=0}^{(df-3)/2} a_k cos(theta)^(2k)),
              a_0 = 1, a_k = a_{k-1} (2k) / (2k + 1)          (df = 1: A = 2 theta / pi)

and the two-sided p-value is 1 - A, clamped to [0, 1].  The series runs
inside ``aggregate`` over ``sequence``: JVM-side, one term per step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _series(m: Column, c2: Column, odd: bool) -> Column:
    """sum_{k=0}^{m} coef_k * c2^k with the recurrence of the even/odd case."""
    def step(acc, k):
        kd = k.cast("double")
        ratio = (2 * kd) / (2 * kd + 1) if odd else (2 * kd - 1) / (2 * kd)
        term = acc["term"] * ratio * c2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))
    init = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    body = F.aggregate(F.sequence(F.lit(1), m.cast("int")), init, step, lambda acc: acc["total"])
    # sequence(1, 0) would count down; no terms beyond k = 0 in that case.
    return F.when(m >= 1, body).otherwise(F.lit(1.0))


def t_two_sided_p(t: Column, dof: Column) -> Column:
    """P(|T_dof| >= |t|) for integer ``dof >= 1``; NULL when t or dof is NULL/NaN."""
    dof_i = dof.cast("int")
    theta = F.atan(F.abs(t) / F.sqrt(dof_i.cast("double")))
    s, c = F.sin(theta), F.cos(theta)
    c2 = c * c
    even = s * _series(F.floor((dof_i - 2) / 2), c2, odd=False)
    odd_many = (2 / math.pi) * (theta + s * c * _series(F.floor((dof_i - 3) / 2), c2, odd=True))
    odd_one = (2 / math.pi) * theta
    accept = (F.when(dof_i % 2 == 0, even)
              .when(dof_i == 1, odd_one)
              .otherwise(odd_many))
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - accept))
    return F.when(t.isNull() | F.isnan(t) | dof.isNull() | (dof_i < 1), F.lit(None).cast("double")) \
        .otherwise(p)
