"""Document quality from a linear-chain conditional random field over its lines.

Every line has features of its own (shares of character classes, length, repeated words) and
those of its neighbours. The field gives each line the probability of being good, by
forward-backward over the whole document; the document's score is the mean of these,
weighted by line length.

Fitting: at most ``TRAIN_DOCS`` labelled documents that are not held out, and no more of them
than hold ``TRAIN_LINES`` lines together; they are read whole, and every line carries its
document's label. Only features reach the driver. Scoring reads whole texts. The score is a function of the text alone. A null or empty text is one empty line and gets a
score like any other. Without labels, or with one kind only, all scores are 0.5 or follow
that kind. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, packed, remainder, saved
from motorlake.llm.sampling import labelled_sample

TRAIN_DOCS = 4000
TRAIN_LINES = 400_000
THRESHOLD = 0.5
MODULUS, HELD = 3, 1
ROUNDS = 150
FEATURES = 13
_SLICE = 2 << 20  # characters of the texts that are scored together

# The character classes whose shares are features.
CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"#$%&*@^~<>{}[]\\/=+_`",
    b"!?",
    b"|",
    b".,;:'\"()-",
    b" \t\r\x0b\x0c",
    bytes(range(128, 256)),
]


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for number, members in enumerate(CLASSES, 1):
        table[list(members)] = number
    return table


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all texts, line lengths, and lines per text."""
    per_text = np.array([t.count("\n") + 1 for t in texts], dtype=np.int64)
    lines = "\n".join(texts).split("\n")
    raw = "\n".join(lines).encode() + b"\n"
    kinds = _class_table()[np.frombuffer(raw, dtype=np.uint8)]
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    length = (ends - starts).astype(np.float32)
    size = np.maximum(length, 1)
    out = np.zeros((len(lines), FEATURES), dtype=np.float32)
    for number in range(1, len(CLASSES) + 1):
        out[:, number - 1] = np.add.reduceat(kinds == number, starts, dtype=np.int32) / size
    at = len(CLASSES)
    out[:, at] = np.log1p(length) / 8
    out[:, at + 1] = length == 0
    for row, line in enumerate(lines):
        words = line.split()
        if words:
            count = len(words)
            out[row, at + 2] = 1 - len(set(words)) / count
            out[row, at + 3] = sum(map(str.__eq__, words, words[1:])) / count
            out[row, at + 4] = min(3.0, (len(line) - count + 1) / count / 10)
    return out, size, per_text


def with_neighbours(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after, and a constant."""
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    last = np.cumsum(per_text) - 1
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after, np.ones((len(own), 1), dtype=own.dtype)], axis=1)


# ---------------------------------------------------------------- the field

def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(good: np.ndarray, count: np.ndarray, step: np.ndarray):
    """Probabilities per line and summed per transition for a batch of padded documents.

    ``good`` (documents, lines) is the score of the state good over bad, ``count`` the lines
    of each document, ``step`` the scores of the transitions.
    """
    docs, lines = good.shape
    emit = np.stack([np.zeros_like(good), good], axis=2)
    ahead, back = np.empty((lines, docs, 2)), np.zeros((lines, docs, 2))
    ahead[0] = emit[:, 0]
    for t in range(1, lines):
        moved = emit[:, t] + _logsum(ahead[t - 1][:, :, None] + step, 1)
        ahead[t] = np.where((t < count)[:, None], moved, ahead[t - 1])
    total = _logsum(ahead[-1], 1)
    for t in range(lines - 2, -1, -1):
        moved = _logsum(step + (emit[:, t + 1] + back[t + 1])[:, None, :], 2)
        back[t] = np.where((t + 1 < count)[:, None], moved, 0)
    node = np.exp(ahead + back - total[:, None]).transpose(1, 0, 2)
    live = (np.arange(1, lines)[None, :] < count[:, None]).T
    pair = np.exp(
        ahead[:-1][:, :, :, None] + step + (emit.transpose(1, 0, 2)[1:] + back[1:])[:, :, None, :]
        - total[None, :, None, None]
    ) * live[:, :, None, None]
    return node[:, :, 1], pair.sum(axis=(0, 1))


def _batches(per_text: np.ndarray, cells: int = 60_000) -> Iterator[np.ndarray]:
    """Documents of like length together, as many as fit."""
    order, start = np.argsort(per_text, kind="stable"), 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * per_text[order[stop]] <= cells:
            stop += 1
        yield order[start:stop]
        start = stop


def _padded(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    at = np.arange(count.max())[None, :]
    return np.where(at < count[:, None], values[np.minimum(first[:, None] + at, len(values) - 1)], 0)


def fit(own: np.ndarray, per_text: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights that maximise the probability of the line labels, by Adam."""
    mean, spread = (own.mean(axis=0), own.std(axis=0) + 1e-3) if len(own) else (0, np.ones(FEATURES))
    weight, step = np.zeros(3 * FEATURES + 1), np.zeros((2, 2))
    if not len(own):
        return {"mean": np.zeros(FEATURES), "spread": np.ones(FEATURES), "weight": weight, "step": step}
    x = with_neighbours((own - mean) / spread, per_text)
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    y = np.repeat(label, per_text)
    told = np.zeros((2, 2))
    for kind in (0, 1):
        told[kind, kind] = (per_text[label == kind] - 1).sum()
    moments = [np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(step), np.zeros_like(step)]
    total = len(y)
    for turn in range(1, rounds + 1):
        score = x @ weight
        likely, seen = np.empty(total), np.zeros((2, 2))
        for docs in _batches(per_text):
            node, pair = forward_backward(_padded(score, first[docs], per_text[docs]), per_text[docs], step)
            seen += pair
            for row, doc in enumerate(docs):
                likely[first[doc] : first[doc] + per_text[doc]] = node[row, : per_text[doc]]
        slope = x.T @ (y - likely) / total - 1e-3 * weight
        turn_step = (told - seen) / total - 1e-3 * step
        for value, grad, m, v in ((weight, slope, *moments[:2]), (step, turn_step, *moments[2:])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            value += 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return {"mean": mean, "spread": spread, "weight": weight, "step": step}


def score_texts(texts: list[str], model: dict[str, np.ndarray]) -> np.ndarray:
    """Length-weighted mean probability of the lines of each text."""
    own, size, per_text = line_features(texts)
    score = with_neighbours((own - model["mean"]) / model["spread"], per_text) @ model["weight"]
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    out = np.empty(len(texts))
    for docs in _batches(per_text):
        count = per_text[docs]
        node, _ = forward_backward(_padded(score, first[docs], count), count, model["step"])
        weigh = _padded(size, first[docs], count)
        out[docs] = (node * weigh).sum(axis=1) / weigh.sum(axis=1)
    return np.clip(out, 0, 1)


# ---------------------------------------------------------------- on tables

def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_DOCS,
          lines: int = TRAIN_LINES) -> dict[str, np.ndarray]:
    """The model, learnt from whole documents: those of the sample in the order of their
    hashes, but for the ones with which the sample would exceed ``lines`` lines."""
    sample = labelled_sample(docs, labels, label, MODULUS, HELD, most)
    own_lines = (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).alias("lines")
    counted = saved(sample.select("*", own_lines, F.xxhash64("doc_id").alias("hash")), "quality-sample")
    before = Window.orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of at most ``most`` rows
    taken = counted.select("doc_id", F.sum("lines").over(before).alias("so_far")).filter(F.col("so_far") <= lines)
    sample = counted.join(F.broadcast(taken.select("doc_id")), "doc_id", "left_semi")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, kind in zip(batch["doc_id"], batch["text"], batch["label"]):
                rows.append((str(doc_id), kind, line_features([text])[0].tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "own"], dtype=object)

    rows = sorted(sample.select("doc_id", "text", "label").mapInPandas(measure, "doc_id string, label int, own binary").collect())
    own = [np.frombuffer(r.own, dtype=np.float32).reshape(-1, FEATURES) for r in rows]
    per_text = np.array([len(o) for o in own], dtype=np.int64)
    kinds = np.array([r.label for r in rows], dtype=np.int64)
    return fit(np.concatenate(own) if own else np.empty((0, FEATURES)), per_text, kinds)


def scores_of(text, model: dict[str, np.ndarray]):
    """Column of scores."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values, out, held, size = texts.tolist(), [], [], 0
            for value in values:
                held.append(value)
                size += len(value)
                if size >= _SLICE:
                    out.append(score_texts(held, model))
                    held, size = [], 0
            if held:
                out.append(score_texts(held, model))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return run(text)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    model = train(docs, labels)
    scored = docs.select(
        F.col(key).alias("doc_id"), (remainder(key, MODULUS) == HELD).alias("held_out"),
        scores_of(clean_text(text), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents the field calls good, with all their columns."""
    model = train(docs, labels)
    rows = packed(docs).withColumn("score", scores_of(clean_text(f"row.{text}"), model))
    return rows.filter(F.col("score") >= THRESHOLD).select("row.*")
