"""Rows that any vector operator must take."""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    # names that the operators use themselves
    T.StructField("digest", T.StringType()), T.StructField("score", T.StringType()), T.StructField("vector", T.LongType()), T.StructField("is_anchor", T.LongType()),
])


def unit(r, d=24):
    x = r.standard_normal(d)
    return x / np.linalg.norm(x)


def rows(seed=3, n=120):
    r = np.random.default_rng(seed)
    base = [unit(r) for _ in range(6)]
    out = []
    for i in range(n):
        b = base[r.integers(0, 6)]
        x = b + r.standard_normal(24) * r.choice([0.0, 0.02, 0.05, 0.08]) if i % 3 else unit(r)
        out.append((i, [float(np.float32(v)) for v in x * r.choice([1.0, 0.5, 3.0])], int(r.integers(0, 3))))
    one = [1.0, *[0.0] * 23]
    out += [
        (200, one, 0), (201, one, 0), (202, [-0.0 if v == 0 else v for v in one], 0), (203, one, None), (204, None, 0), (205, [], 0), (206, [0.0] * 24, 0),
        (207, [float("nan"), *one[1:]], 0), (208, [float("inf"), *one[1:]], 0), (209, [None, *one[1:]], 0), (210, one[:8], 0), (211, one[:8], 0),
        (None, one, 0), (200, one, 0), (212, [1e30, *one[1:]], 0), (213, [1e-30, *one[1:]], 0), (300, base[0].tolist(), 1), (300, base[1].tolist(), 1), (301, base[0].tolist(), 1), (302, base[1].tolist(), 1),
    ]
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], lab) for i, v, lab in out]


def frame(spark, data):
    return spark.createDataFrame([(i, v, lab, "digest", "score", 7, 8) for i, v, lab in data], SCHEMA)
