"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` turns a text into a fixed vector (character classes, repeats,
line and word shapes); ``fit`` grows trees on binned statistics from gradient
histograms; the trees are flattened into arrays and every text of a batch walks
all trees at once in numpy.

Bound of the fit: at most ``Params.max_rows`` labelled documents, those with
the smallest hash of doc_id, so the sample is the same on every run and the
training set that reaches the driver is ``max_rows`` x ``len(NAMES)`` numbers.

Defined cases: a null or empty text has all-zero statistics and is scored like
any other; documents with conflicting or null labels do not train; a doc_id
labelled twice alike counts once; without any training label, or with one
class only, the score is that class's share (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches, utf8

NAMES = (
    "log_bytes", "log_words", "mean_word", "long_words", "short_words", "upper", "lower", "digit", "space",
    "newline", "high_byte", "comma_dot", "exclaim", "symbol", "pipe", "other_punct", "byte_entropy",
    "distinct_words", "top_word", "top5_words", "same_as_previous", "repeated_pairs", "repeated_fours",
    "words_per_line", "dup_lines", "lines_end_in_stop", "words_with_symbol", "capital_words", "words_per_stop",
)
_MASKS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (32, 9), "newline": (10,),
    "high_byte": range(128, 256), "comma_dot": b",.;:?", "exclaim": b"!", "symbol": b"#*$%&<>@^~\\{}[]=+_",
    "pipe": b"|", "other_punct": b"\"'()-/`",
}
_CLASS = np.zeros((256, len(_MASKS)))
for _i, _codes in enumerate(_MASKS.values()):
    _CLASS[list(_codes), _i] = 1.0
_STOP = (b".", b"?", b"!", b":", b'"')


@dataclass(frozen=True)
class Params:
    trees: int = 150
    depth: int = 4
    bins: int = 64
    rate: float = 0.1
    min_rows: int = 20
    l2: float = 1.0
    max_rows: int = 20_000
    seed: int = 11


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_STOP_BYTES = np.zeros(256, bool)
_STOP_BYTES[list(b".?!")] = True
_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(b"#*$%&|!")] = True


def _repeated(values: np.ndarray) -> float:
    """Share of the values that occur more than once."""
    if len(values) < 2:
        return 0.0
    v = np.sort(values)
    new = np.empty(len(v) + 1, bool)
    new[0] = new[-1] = True
    np.not_equal(v[1:], v[:-1], out=new[1:-1])
    return 1.0 - float((new[1:] & new[:-1]).sum()) / len(v)


def statistics(data: bytes) -> list[float]:
    """The vector named by ``NAMES`` for one text in UTF-8."""
    n = len(data)
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    codes = np.frombuffer(data, np.uint8)
    hist = np.bincount(codes, minlength=256)
    share = hist @ _CLASS / n
    p = hist[hist > 0] / n
    edge = np.diff(_SPACE[codes].astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    lengths, heads, tails = ends - starts, codes[starts], codes[ends - 1]
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    counts = np.sort(np.bincount(ids))[::-1]
    w = len(words)
    same = pairs = fours = 0.0
    if w > len(seen):
        same = float((ids[1:] == ids[:-1]).mean()) if w > 1 else 0.0
        two = ids[:-1] * (len(seen) + 1) + ids[1:]
        pairs = _repeated(two)
        if pairs:                       # products wrap; a clash only blurs a statistic
            fours = _repeated(two[:-2] * np.int64(0x9E3779B97F4A7C1 | 1) + two[2:])
    lines = [x for x in map(bytes.strip, data.split(b"\n")) if x]
    ends_in_stop = sum(x.endswith(_STOP) for x in lines)
    return [
        np.log1p(n), np.log1p(w), float(lengths.mean()), float((lengths > 12).mean()), float((lengths < 4).mean()),
        *share.tolist(), float(-(p * np.log2(p)).sum()),
        len(seen) / w, counts[0] / w, float(counts[:5].sum()) / w, same, pairs, fours,
        w / len(lines), 1 - len(set(lines)) / len(lines), ends_in_stop / len(lines),
        float(_SYMBOL_BYTES[tails].mean()), float(((heads >= 65) & (heads <= 90)).mean()),
        w / (1 + int(_STOP_BYTES[tails].sum())),
    ]


def fit(x: np.ndarray, y: np.ndarray, params: Params = Params()) -> dict[str, np.ndarray]:
    """Boosted trees for the log-odds of ``y``, flattened: node ``i`` of tree
    ``t`` sends a row to ``left`` if ``x[feature] <= threshold``, else to
    ``left + 1``; a leaf points to itself and holds ``value``."""
    nodes = 2 ** (params.depth + 1) - 1
    empty = {"feature": np.zeros((0, nodes), np.int32), "threshold": np.zeros((0, nodes)),
             "left": np.zeros((0, nodes), np.int32), "value": np.zeros((0, nodes)), "base": np.array(0.0)}
    if not len(y):
        return empty
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    empty["base"] = np.array(np.log(share / (1 - share)))
    if y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, params.bins + 1)[1:-1])) for j in range(x.shape[1])]
    width = params.bins
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    slots = binned + np.arange(x.shape[1]) * width          # one histogram slot per (feature, bin)
    n, f = x.shape
    model = {k: np.zeros((params.trees, *v.shape[1:]), v.dtype) for k, v in empty.items() if k != "base"}
    model["base"] = empty["base"]
    score = np.full(n, float(empty["base"]))
    for t in range(params.trees):
        prob = 1 / (1 + np.exp(-score))
        grad, hess = prob - y, prob * (1 - prob)
        at = np.zeros(n, np.int64)
        model["left"][t] = np.arange(nodes)
        level = [0]
        for depth in range(params.depth + 1):
            first, count = 2 ** depth - 1, 2 ** depth
            local = at - first
            live = local >= 0                                # rows not stopped at a leaf above
            g = np.bincount(local[live], grad[live], count)
            h = np.bincount(local[live], hess[live], count)
            model["value"][t, first:first + count] = -params.rate * g / (h + params.l2)
            if depth == params.depth or not level:
                break
            key = (local[live, None] * (f * width) + slots[live]).ravel()
            size = count * f * width

            def sums(v, key=key, size=size, count=count):
                return np.cumsum(np.bincount(key, v, size).reshape(count, f, width), 2)

            rows = int(live.sum())
            gl, hl = sums(np.repeat(grad[live], f)), sums(np.repeat(hess[live], f))
            cl = sums(np.ones(rows * f))
            total = cl[:, :1, -1:]
            gain = (gl ** 2 / (hl + params.l2) + (g[:, None, None] - gl) ** 2 / (h[:, None, None] - hl + params.l2)
                    - (g ** 2 / (h + params.l2))[:, None, None])
            gain[(cl < params.min_rows) | (total - cl < params.min_rows)] = -np.inf
            grown = []
            for node in level:
                flat = int(np.argmax(gain[node - first]))
                j, b = divmod(flat, width)
                if not gain[node - first].flat[flat] > 1e-6 or b >= len(cuts[j]):
                    continue
                child = 2 * node + 1
                model["feature"][t, node], model["threshold"][t, node] = j, cuts[j][b]
                model["left"][t, node] = child
                mine = at == node
                at[mine] = np.where(binned[mine, j] <= b, child, child + 1)
                grown += [child, child + 1]
            level = grown
        leaf = at
        score += model["value"][t][leaf]
    return model


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores in 0..1: all rows step through all trees together."""
    trees = len(model["feature"])
    total = np.full(len(x), float(model["base"]))
    if trees and len(x):
        t = np.arange(trees)
        at = np.zeros((len(x), trees), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(model["left"].shape[1] + 1)) - 1):
            left = model["left"][t, at]
            right = (left != at) & (x[rows, model["feature"][t, at]] > model["threshold"][t, at])
            at = left + right
        total = total + model["value"][t, at].sum(1)
    return 1 / (1 + np.exp(-total))


def with_statistics(df: DataFrame, text_col: str, out: str) -> DataFrame:
    bound_batches(df.sparkSession)

    @F.arrow_udf("array<double>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_buffer().to_pybytes()) for t in texts], pa.list_(pa.float64()))

    return df.withColumn(out, stats(utf8(F.col(text_col))))


def held_out(doc_id: Column) -> Column:
    """The fold that is only scored: crc32 of doc_id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> dict[str, np.ndarray]:
    """Fit on labelled documents outside the held-out fold."""
    one = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi"))
           .where("_lo = _hi"))
    picked = (one.select("doc_id", F.col("_hi").alias("_label"), F.xxhash64(F.lit(params.seed), "doc_id").alias("_pick"))
              .orderBy("_pick", "doc_id").limit(params.max_rows).drop("_pick"))
    # At most max_rows ids, so the broadcast is bounded by the parameter.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = with_statistics(rows, "text", "_x").select("_label", "_x", "doc_id")
    got = rows.orderBy(F.xxhash64(F.lit(params.seed), "doc_id"), "doc_id", "_x").limit(params.max_rows).collect()
    x = np.array([r["_x"] for r in got], float).reshape(len(got), len(NAMES))
    return fit(x, np.array([r["_label"] for r in got], float), params)


def score(df: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` (likelihood of label 1) and ``predicted``."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.array([statistics(t.as_buffer().to_pybytes()) for t in texts], float)
            yield pa.array(predict(model, x.reshape(len(texts), len(NAMES))))

    return (df.withColumn("score", run(utf8(F.col(text_col))))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
