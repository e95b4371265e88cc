"""Quality classifier: naive Bayes features, linear support vectors.

Features are indicators of n-grams: three neighbouring bytes of the text (hashed to
BUCKETS places), and how often words and lines come again (binned). Each is scaled by the
class log-count ratio. A linear hinge-loss model is fitted by dual coordinate descent. A
score is the logistic function of twice the margin.

The fit takes at most ``max_rows`` labelled rows, those with the smallest hash of their
id; it runs in one task that holds the features of these rows only. Scoring reads every
whole text, in Arrow batches, without a shuffle; the model is one array of BUCKETS numbers.

Null text counts as empty and gets a score from the bias alone. Labels that are null or
belong to no document are not used; without rows of both labels every score is 0.5. Rows
that repeat an id are scored one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, text_or_empty

BUCKETS = 1 << 18
_FLAGS = 64  # the last places hold the bins
MAX_ROWS = 8_000


def _bin(share: float) -> int:
    return min(15, int(share * 16))


def features(text: str) -> np.ndarray:
    """Sorted places of the features that a text has."""
    raw = text.encode("utf-8", "replace")
    codes = np.frombuffer(b" " + raw + b" ", dtype=np.uint8).astype(np.uint64)
    grams = (codes[:-2] << np.uint64(16)) | (codes[1:-1] << np.uint64(8)) | codes[2:]
    places = (np.unique(grams) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    words, lines = raw.split(), raw.split(b"\n")
    base = BUCKETS - _FLAGS
    bins = [base + _bin(1 - len(set(words)) / len(words)) if words else base + 16]
    bins.append(base + 17 + _bin(1 - len(set(lines)) / len(lines)))
    pairs = len(words) - 1
    bins.append(base + 34 + (_bin(1 - len(set(zip(words, words[1:]))) / pairs) if pairs > 0 else 0))
    return np.unique(np.concatenate([places % np.uint64(base), np.array(bins, dtype=np.uint64)])).astype(np.int64)


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """Weights by place, the bias last. ``labels`` are 0 and 1."""
    good = labels == 1
    weights = np.zeros(BUCKETS + 1)
    if not len(rows) or good.all() or not good.any():
        return weights
    yes = np.bincount(np.concatenate([r for r, g in zip(rows, good) if g]), minlength=BUCKETS) + 1.0
    no = np.bincount(np.concatenate([r for r, g in zip(rows, good) if not g]), minlength=BUCKETS) + 1.0
    ratio = np.log(yes / good.sum()) - np.log(no / (~good).sum())
    ratio[(yes + no) < 4] = 0.0  # seen in one text only
    values = [ratio[r] / max(1e-9, float(np.sqrt((ratio[r] ** 2).sum()))) for r in rows]
    sign = np.where(good, 1.0, -1.0)
    # Both classes weigh the same in total.
    bound = np.where(good, cost * len(rows) / (2 * good.sum()), cost * len(rows) / (2 * (~good).sum()))
    square = np.array([float((v * v).sum()) + 1.0 for v in values])
    alpha, draw = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            slope = sign[i] * (float(weights[rows[i]] @ values[i]) + weights[-1]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), bound[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                weights[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return np.concatenate([weights[:-1], ratio, weights[-1:]])


def margin(model: np.ndarray, places: np.ndarray) -> float:
    if len(model) != 2 * BUCKETS + 1:
        return 0.0
    scale = model[BUCKETS : 2 * BUCKETS][places]
    size = max(1e-9, float(np.sqrt((scale * scale).sum())))
    return float(model[places] @ scale) / size + float(model[-1])


def trained(docs: DataFrame, labels: DataFrame, learn: Column, *, label_col: str, id_col: str, text_col: str, max_rows: int) -> bytes:
    """The model as bytes; ``learn`` says which rows of ``labels`` may be used."""
    chosen = (
        labels.filter(learn & named(label_col).isin(0, 1) & named(id_col).isNotNull())
        .groupBy(named(id_col).alias("of"))
        .agg(F.min(named(label_col).cast("int")).alias("label"))  # of two labels of one id the smaller
        .orderBy(F.xxhash64("of"), "of")
        .limit(max_rows)
    )
    texts = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("id") == F.col("of")).select("id", "text", "label")
    # An id may have many rows: equal ones count once, and the bound holds after the join as well.
    sample = sample.dropDuplicates(["id", "text"]).orderBy(F.xxhash64("id", "text"), "id", "text").limit(max_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text.as_py()).astype("<i4").tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["id", "label", "places"])

    schema = T.StructType(
        [T.StructField("id", sample.schema["id"].dataType), T.StructField("label", T.IntegerType()), T.StructField("places", T.BinaryType())]
    )

    def learn_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3)))]
        held.sort(key=lambda row: (str(row[0]), row[2]))  # the fit does not depend on the order of arrival
        rows = [np.frombuffer(row[2], dtype="<i4").astype(np.int64) for row in held]
        model = fit(rows, np.array([row[1] for row in held]))
        yield pa.RecordBatch.from_arrays([pa.array([model.astype("<f4").tobytes()], pa.binary())], names=["model"])

    # At most max_rows rows of features meet in the one task that fits.
    fitted = sample.mapInArrow(extract, schema).repartition(1).mapInArrow(learn_model, "model binary").first()
    return fitted["model"] if fitted else b""


def scored(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per document: id, score, predicted."""
    model = trained(docs, labels, learn, label_col=label_col, id_col=id_col, text_col=text_col, max_rows=max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(named(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value, dtype="<f4").astype(np.float64)
        for batch in batches:
            found = np.array([margin(weights, features(text.as_py())) for text in batch.column(1)], dtype=np.float64)
            score = 1.0 / (1.0 + np.exp(-2.0 * np.clip(found, -300, 300)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["id", "score", "predicted"]
            )

    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return source.mapInArrow(run, schema)
