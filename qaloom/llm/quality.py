"""Quality score by a sparse ensemble of rules over statistics of whole texts.

Boosted shallow trees are fitted to labelled texts, every path from a root to a node is read as a conjunction of
comparisons, and a logistic model with an L1 penalty keeps the few conjunctions that matter. The kept rules are compiled
to one Spark column over the statistics. Statistics come from bytes and word hashes of a text alone, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hashing, memory
from .columns import fresh

STATISTICS = (
    "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "non_ascii", "distinct_words", "distinct_lines", "lines_per_word", "again",
    "short_words", "long_words", "symbol_words",
)
#: Byte classes: other letters and bytes, white space, A-Z, 0-9, marks of prose, other ASCII symbols, non-ASCII.
CLASS = np.zeros(256, np.int64)
CLASS[hashing.SPACE] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3
CLASS[[x for x in range(33, 127) if not chr(x).isalnum()]] = 5
CLASS[[ord(x) for x in ".,;:?'-()\""]] = 4
CLASS[128:] = 6


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; an empty or null text has only zeros."""
    data, offsets = hashing.text_bytes(column)
    n = len(column)
    if n == 0:
        return np.zeros((0, len(STATISTICS)))
    kind = CLASS[data]
    doc = np.repeat(np.arange(n), np.diff(offsets))
    count = np.bincount(doc * 7 + kind, minlength=n * 7).reshape(n, 7).astype(float)
    ink = np.maximum(1, count.sum(axis=1) - count[:, 1])
    word, first = hashing.words(data, offsets)
    n_words = np.diff(first)
    per = np.maximum(1, n_words)
    owner = np.repeat(np.arange(n), n_words)
    letters = np.maximum(1, count[:, 0] + count[:, 2])
    # Lengths and last bytes of words, from the places where white space or a text's end follows.
    space = np.concatenate([hashing.SPACE[data], [True]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(~space[:-1] & (edge[:-1] | np.concatenate([[True], space[:-2]])))
    end = np.flatnonzero(~space[:-1] & (edge[1:] | space[1:]))
    length = end - start + 1
    share = lambda flag: np.bincount(owner, weights=flag, minlength=n) / per
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])]) if len(word) else np.zeros(0, bool)
    different = np.zeros(n)
    lines = np.ones(n)
    raw = data.tobytes()
    for i in range(n):
        different[i] = len(np.unique(word[first[i] : first[i + 1]]))
        part = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x]
        lines[i] = len(set(part)) / len(part) if part else 0
    newlines = np.bincount(doc[data == 10], minlength=n) if len(data) else np.zeros(n)
    return np.column_stack([
        np.log1p(n_words), (ink - (n_words == 0)) / per, count[:, 2] / letters, count[:, 3] / ink, count[:, 4] / ink, count[:, 5] / ink, count[:, 6] / ink,
        different / per, lines, newlines / per, share(again), share(length <= 2), share(length >= 12), share(CLASS[data[end]] == 5),
    ])


def with_statistics(docs: DataFrame, text: str, name: str) -> DataFrame:
    """All rows and columns with the statistics of a text as an array column; texts go through in small batches."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(hashing.text_bytes(batch.column(at))[1])
            i = 0
            while i < batch.num_rows:
                j, total = i + 1, size[i]
                while j < batch.num_rows and total + size[j] <= hashing.SEGMENT:
                    total += size[j]
                    j += 1
                part = batch.slice(i, j - i)
                values = statistics(part.column(at))
                lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, name])
                i = j

    return docs.mapInArrow(memory.over_batches(run), schema)


# --- fitting ------------------------------------------------------------------
Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound) for each comparison


def _tree(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, list[Rule]]:
    """One regression tree of Newton steps: its values for all rows, and the paths to all its nodes."""
    value, paths = np.zeros(len(x)), []
    todo = [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        if path:
            paths.append(path)
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None)
        if len(path) < depth:
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                bucket = np.searchsorted(cuts[f], x[rows, f], side="left")
                n = len(cuts[f]) + 1
                gs, hs, ns = (np.cumsum(np.bincount(bucket, weights=w, minlength=n))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(ns < least) | (len(rows) - ns < least)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, float(cuts[f][k])))
        if best[1] is None:
            value[rows] = -g / (h + 1)
            continue
        f, cut = best[1]
        above = x[rows, f] > cut
        todo += [((*path, (f, True, cut)), rows[above]), ((*path, (f, False, cut)), rows[~above])]
    return value, paths


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, bound in rule:
        out &= (x[:, f] > bound) if above else (x[:, f] <= bound)
    return out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all weights but the constant, by accelerated proximal steps."""
    a = np.column_stack([np.ones(len(r)), r])
    v = np.ones(a.shape[1])
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    rate = 4 * len(a) / max(1e-9, float(v @ (a.T @ (a @ v))))
    w = np.zeros(a.shape[1])
    z, t = w, 1.0
    for _ in range(steps):
        new = z - rate * (a.T @ (1 / (1 + np.exp(-(a @ z))) - y)) / len(a)
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - rate * penalty)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        w, z, t = new, new + (t - 1) / t2 * (new - w), t2
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, least: int = 10) -> tuple[float, list[tuple[Rule, float]]]:
    """A constant and weighted rules from labelled statistics; the same input always gives the same rules.

    A fifth of the rows chooses the penalty. Without rows the constant is 0, and with one class its smoothed log odds.
    """
    ones = float(y.sum())
    prior = float(np.log((ones + 1) / (len(y) - ones + 1)))
    if ones in (0, len(y)):
        return prior, []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 49))) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    score, found = np.full(len(y), prior), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        value, paths = _tree(x, cuts, p - y, p * (1 - p), depth, least)
        score += 0.3 * value
        for path in paths:
            key = holds(path, x).tobytes()
            if key not in found or len(path) < len(found[key]):
                found[key] = path
    rules = list(found.values())
    r = np.column_stack([holds(rule, x) for rule in rules]).astype(float)
    test = np.arange(len(y)) % 5 == 0
    best = (np.inf, 0.01)
    for penalty in (0.03, 0.01, 0.003, 0.001, 0.0003):
        c, w = _lasso(r[~test], y[~test], penalty)
        p = np.clip(1 / (1 + np.exp(-(c + r[test] @ w))), 1e-9, 1 - 1e-9)
        loss = -np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p))
        best = min(best, (loss * 1.0, penalty))
    c, w = _lasso(r, y, best[1])
    return c, [(rule, float(v)) for rule, v in zip(rules, w) if v]


def compile_rules(constant: float, rules: list[tuple[Rule, float]], stats: str) -> Column:
    """The score of a fitted ensemble as one column over the array of statistics."""
    total = F.lit(constant)
    for rule, weight in rules:
        test = F.lit(True)
        for f, above, bound in rule:
            value = F.col(stats)[f]
            test = test & ((value > bound) if above else (value <= bound))
        total = total + F.when(test, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from; a null key is not among them."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> tuple[float, list[tuple[Rule, float]]]:
    """Fit rules to ``labels`` (doc_id, label 0 or 1) of rows that are not held out.

    At most ``sample`` labelled documents, the first in the order of a hash of their number, are learned from: that
    bounds what the driver gets, ``sample`` rows of statistics. Their texts are read whole. Rows with a null number or
    label, and those with another label, take no part.
    """
    (stats,) = fresh(docs, "stats")
    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("k"), F.col("label").cast("double").alias("y"))
    texts = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("k"))
    got = with_statistics(texts.select("doc_id", "text", "y"), "text", stats).select("doc_id", "y", stats).collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], r[stats]))
    x = np.array([r[stats] for r in got]).reshape(-1, len(STATISTICS))
    return fit_rules(x, np.array([r["y"] for r in got]))


def score(docs: DataFrame, model: tuple[float, list[tuple[Rule, float]]], cut: float = 0.3) -> DataFrame:
    """All rows with ``score`` and ``predicted``; columns with these names must be renamed before."""
    (stats,) = fresh(docs, "stats")
    out = with_statistics(docs, "text", stats).withColumn("score", compile_rules(*model, stats)).drop(stats)
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
