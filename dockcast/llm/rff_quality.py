"""Quality scores: random Fourier features over document statistics, a ridge
fit by partition-summed normal equations, isotonic calibration.

A text becomes about twenty statistics (:func:`statistics`) of its whole
length. They are standardised and mapped to cos(Wx + b) with Gaussian W, which
approximates a Gaussian kernel. Each partition of the fitting rows sums its
own Z'Z and Z'y, the sums of at most ``parts`` partitions are added, and the
ridge weights solve the total. A second, disjoint part of the labelled rows
calibrates: pool-adjacent-violators turns raw scores into rates.

Learning uses at most ``max_fit`` labelled rows (lowest hash of the id; a
documented bound), so normal equations and calibration stay of fixed size;
scoring is one narrow pass over all rows and whole texts with a model of fixed
size.

Rules. A row is held out if crc32 of its id mod 5 is 0 (null id: of the empty
text); held-out rows are never learnt from, and id, language, source and
labels are never inputs of a score. Null text is an empty one and gets a score
like any other. Null labels are not learnt; an id labelled twice counts once,
with its lower label. Repeated rows each get their result. With no label at
all every score is 0.5, with one label value that value. Empty tables give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import append_arrow, crc_mod5, ship, staged, texts_of

_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = bytes(range(48, 58))
_MARKS = (b"#*$%&", b"|<>", b"!?", b".,;:", b"\"'()[]{}")


def statistics(text: bytes) -> list[float]:
    """Statistics of a whole text."""
    n = len(text) or 1
    words = text.split()
    m = len(words) or 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = len(lines) or 1
    size = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    share = lambda chars: (n - len(text.translate(None, chars))) / n
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:]))) / max(1, len(words) - 1)
    same = sum(map(bytes.__eq__, words, words[1:])) / m if len(words) > 1 else 0.0
    return [np.log1p(len(text)), np.log1p(len(words)), float(size.mean()), float(size.std()), share(_LETTERS), share(_UPPER), share(_DIGITS), share(_SYMBOLS),
            *[share(x) for x in _MARKS], sum(w.isupper() for w in words) / m, np.log1p(len(lines)), np.log1p(len(text) / k), len(set(lines)) / k,
            len(counts) / m, max(counts.values(), default=0) / m, pairs, same, len(zlib.compress(text, 1)) / n,
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / k]


class Features:
    """Standardised statistics to random Fourier features."""

    def __init__(self, mean, scale, n: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / width, (len(mean), n))
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.concatenate([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(z), 1))], 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and rising values."""
    order = np.argsort(x, kind="stable")
    x, first = np.unique(x[order], return_index=True)
    sums, ns = np.add.reduceat(y[order], first), np.diff(np.append(first, len(order)))
    blocks: list[list[float]] = []
    for a, s, n in zip(x, sums, ns):
        blocks.append([s, n, a, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, n2, _, hi = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += n2
            blocks[-1][3] = hi
    # half a row of either kind keeps rates off 0 and 1
    value = np.array([(s + 0.5) / (n + 1) for s, n, *_ in blocks])
    value = np.maximum.accumulate(value)
    return np.array([e for *_, a, b in blocks for e in (a, b)]), np.repeat(value, 2)


class Model:
    def __init__(self, features: Features | None, weights=None, knots=None, values=None, constant: float = 0.5):
        self.features, self.weights, self.knots, self.values, self.constant = features, weights, knots, values, constant

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.constant)
        return np.interp(self.raw(x), self.knots, self.values)


def fit(rows: DataFrame, n_features: int, width: float, ridge: float, parts: int, seed: int) -> Model:
    """From (x array<double>, y int, part) rows, a bounded number of them; rows
    of part 0 calibrate, the others fit."""
    train, held = rows.filter("part <> 0"), rows.filter("part = 0").collect()
    first = train.select("x").limit(1).collect()
    if not first:
        ys = [r["y"] for r in held]
        return Model(None, constant=float(np.mean(ys)) if ys else 0.5)
    k = len(first[0]["x"])
    stat = train.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *[f(F.get("x", i)).alias(f"{f.__name__}{i}") for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    mean, scale = np.array([stat[f"avg{i}"] for i in range(k)]), np.array([stat[f"stddev_pop{i}"] for i in range(k)])
    features = Features(mean, np.where(scale > 1e-9, scale, 1.0), n_features, width, seed)
    if stat["y"] in (0.0, 1.0):
        return Model(None, constant=stat["y"])

    def partial(batches):
        import pyarrow as pa
        a, c = np.zeros((n_features + 1, n_features + 1)), np.zeros(n_features + 1)
        for b in batches:
            z = features(np.array(b.column("x").to_pylist(), np.float64).reshape(b.num_rows, k))
            a += z.T @ z
            c += z.T @ np.array(b.column("y").to_pylist(), np.float64)
        yield pa.RecordBatch.from_pydict({"a": pa.array([a.tobytes()], pa.binary()), "c": pa.array([c.tobytes()], pa.binary())})

    sums = train.select("x", "y").coalesce(parts).mapInArrow(partial, "a binary, c binary").collect()
    a = sum(np.frombuffer(s["a"]).reshape(n_features + 1, n_features + 1) for s in sums)
    c = sum(np.frombuffer(s["c"]) for s in sums)
    penalty = ridge * np.eye(n_features + 1)
    penalty[-1, -1] = 1e-9
    model = Model(features, np.linalg.solve(a + penalty, c))
    if held:
        x, y = np.array([r["x"] for r in held], np.float64), np.array([r["y"] for r in held], np.float64)
        model.knots, model.values = isotonic(model.raw(x), y)
    else:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", max_fit: int = 6_000,
                  n_features: int = 256, width: float = 4.0, ridge: float = 1e-2, threshold: float = 0.3, parts: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of every row."""
    ship(__name__)
    d = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("held_out", crc_mod5(F.col("doc_id")) == 0)
    known = labels.select(F.col(id).alias("of"), F.col(label).cast("int").alias("y")).filter("of is not null and y is not null").groupBy("of").agg(F.min("y").alias("y"))
    known = known.filter(crc_mod5(F.col("of")) != 0).withColumn("h", F.xxhash64("of"))
    # the lowest hashes: a limit by hash keeps the sample bounded at any number of labels
    n = known.count()
    known = known.filter(F.col("h").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5) <= F.lit(max_fit / max(n, 1)))

    def measured(column):
        return [statistics(b) for b in texts_of(column)]

    # about max_fit rows of 24 bytes, whatever the number of labels: sent to the texts
    fitting = d.join(F.broadcast(known), F.col("doc_id") == F.col("of")).select("text", "y", F.pmod("h", F.lit(4)).alias("part"))
    rows = staged(append_arrow(fitting, ["text"], "x", "array<double>", measured, rows=256, drop=("text",)).select("x", "y", "part"), "quality-fit")
    model = fit(rows, n_features, width, ridge, parts, seed)  # some 100 KB, travels with the function

    def run(column):
        return model.score(np.array([statistics(b) for b in texts_of(column)], np.float64)).tolist() if len(column) else []

    return append_arrow(d, ["text"], "score", "double", run, rows=256, drop=("text",)).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
