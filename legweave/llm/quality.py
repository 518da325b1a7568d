"""Quality classification by a convolutional network over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.llm.samples import bounded_sample, with_scores

# A filter sees so many bytes; a chunk is two neighbouring strides, so chunks overlap by half.
WIDTH, FILTERS, STRIDE = 5, 12, 256
# Bounds of the fit: labelled documents per label, and chunks drawn from each.
PER_LABEL, CHUNKS = 1_500, 6
STEPS, BATCH, RATE, SEED = 1_200, 64, 0.01, 11
# Places whose answers are held at a time, however long a document is.
PART_PLACES = 1 << 17
# So many of the chunks in training are cut to a random length, as documents may be a word long.
CUT_SHARE, CUT_BYTES = 0.4, 160


@dataclass
class ByteNetwork:
    """Filters as one table per byte offset, and a logistic unit over the pooled answers."""

    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float

    def answers(self, padded: np.ndarray) -> np.ndarray:
        """Every filter's answer at every place that has WIDTH bytes."""
        places = len(padded) - WIDTH + 1
        total = self.filters[0].take(padded[:places], axis=0)
        for k in range(1, WIDTH):
            total += self.filters[k].take(padded[k : k + places], axis=0)
        total += self.bias
        return total

    def highest(self, padded: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The highest answer of each filter from each cut to the next one, or to the end."""
        ends = np.append(cuts[1:], len(padded) - WIDTH + 1)
        out = np.empty((len(cuts), FILTERS), np.float32)
        lo = 0
        while lo < len(cuts):
            hi = max(lo + 1, int(np.searchsorted(ends, cuts[lo] + PART_PLACES, "right")))
            part = self.answers(padded[cuts[lo] : ends[hi - 1] + WIDTH - 1])
            out[lo:hi] = np.maximum.reduceat(part, cuts[lo:hi] - cuts[lo], axis=0)
            lo = hi
        return out

    def pooled(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest answer of each filter in each chunk, and each chunk's document.

        Documents are followed by zero bytes, so no answer mixes two of them;
        an empty document is one chunk of zero bytes.
        """
        rows = len(starts) - 1
        lengths = np.diff(starts)
        room = np.maximum(lengths, 1) + WIDTH
        at = np.append(0, np.cumsum(room))
        padded = np.zeros(at[-1], np.uint8)
        for r in range(rows):
            padded[at[r] : at[r] + lengths[r]] = data[starts[r] : starts[r + 1]]
        # A stride's places end with the document's bytes; what follows, up to the next document, is cut off.
        strides = np.maximum(1, -(-lengths // STRIDE))
        owner = np.repeat(np.arange(rows), strides + 1)
        first = np.cumsum(strides + 1) - (strides + 1)
        nth = np.arange(len(owner)) - first[owner]
        cuts = at[owner] + np.minimum(nth * STRIDE, np.maximum(lengths, 1)[owner])
        high = self.highest(padded, cuts)
        inside = nth < strides[owner]
        high, owner, nth = high[inside], owner[inside], nth[inside]
        paired = high.copy()
        follows = np.flatnonzero(owner[1:] == owner[:-1])
        paired[follows] = np.maximum(high[follows], high[follows + 1])
        # The last stride of a longer document has been seen in its pair.
        alone = np.append(owner[1:] != owner[:-1], True) & (nth > 0)
        return np.maximum(paired[~alone], 0), owner[~alone]

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One probability per document: the logistic of its chunks' mean answer."""
        pooled, owner = self.pooled(data, starts)
        logits = pooled @ self.out + self.shift
        rows = len(starts) - 1
        mean = np.bincount(owner, logits, rows) / np.maximum(np.bincount(owner, minlength=rows), 1)
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def train(chunks: np.ndarray, labels: np.ndarray) -> ByteNetwork:
    """A network fitted on chunks of equal length by Adam, each batch half of either label."""
    rng = np.random.default_rng(SEED)
    state = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.3, FILTERS).astype(np.float32),
        "shift": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in state.items()}
    second = {k: np.zeros_like(v) for k, v in state.items()}
    sides = [side for side in (np.flatnonzero(labels > 0), np.flatnonzero(labels <= 0)) if len(side)]
    places = chunks.shape[1] - WIDTH + 1 if len(chunks) else 0
    for step in range(1, STEPS + 1 if len(chunks) else 1):
        pick = np.concatenate([rng.choice(side, BATCH // len(sides)) for side in sides])
        x, y = chunks[pick], labels[pick]
        cut = np.where(rng.random(len(pick)) < CUT_SHARE, rng.integers(2, CUT_BYTES, len(pick)), x.shape[1])
        x = np.where(np.arange(x.shape[1]) < cut[:, None], x, 0)
        answers = sum(state["filters"][k].take(x[:, k : k + places], axis=0) for k in range(WIDTH)) + state["bias"]
        where = answers.argmax(1)
        top = np.take_along_axis(answers, where[:, None, :], 1)[:, 0]
        pooled = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(pooled @ state["out"] + state["shift"], -30, 30)))
        slope = ((p - y) / len(pick)).astype(np.float32)
        back = np.outer(slope, state["out"]) * (top > 0)
        filters = np.zeros_like(state["filters"])
        of = np.broadcast_to(np.arange(FILTERS), where.shape)
        for k in range(WIDTH):
            np.add.at(filters[k], (np.take_along_axis(x, where + k, 1), of), back)
        slopes = {"filters": filters, "bias": back.sum(0), "out": pooled.T @ slope, "shift": slope.sum(keepdims=True)}
        pace = RATE * (1 - step / (STEPS + 1))
        for k, g in slopes.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            state[k] = state[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return ByteNetwork(
        np.ascontiguousarray(state["filters"], np.float32), state["bias"], state["out"], float(state["shift"][0])
    )


def spread_chunks(data: np.ndarray, starts: np.ndarray, most: int = CHUNKS) -> list[list[bytes]]:
    """Up to ``most`` chunks of each document, evenly spread over all of it, filled up with zero bytes."""
    size = 2 * STRIDE
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        n = min(most, max(1, (b - a) // size))
        at = np.linspace(a, max(a, b - size), n).astype(np.int64)
        out.append([data[i : min(i + size, b)].tobytes().ljust(size + WIDTH - 1, b"\0") for i in at])
    return out


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_label: int = PER_LABEL,
    chunks: int = CHUNKS,
) -> ByteNetwork:
    """A network of a bounded sample: ``per_label`` documents of each label, ``chunks`` chunks of each document.

    ``labels`` has the id and ``quality`` (0 or 1; others are left out); an id
    with both labels counts as 1.  The documents are the first in the order of
    a hash of the id.  Without labelled documents every score is the same.
    """
    marked = (
        labels.filter(F.col("quality").isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    chosen = bounded_sample(marked, "quality", "id", per_label)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = rows.join(chosen, "id")

    def pieces(data, starts):
        return {"chunks": pa.array(spread_chunks(data, starts, chunks), pa.list_(pa.binary()))}

    field = T.StructField("chunks", T.ArrayType(T.BinaryType()))
    made = with_scores(sample, "text", pieces, [field]).drop("text")
    got = made.orderBy(F.xxhash64("id"), "id", F.xxhash64("chunks")).limit(2 * per_label).collect()
    drawn = [np.frombuffer(c, np.uint8) for r in got for c in r.chunks]
    marks = np.array([r.quality for r in got for _ in r.chunks], np.float32)
    return train(np.array(drawn, np.uint8).reshape(len(drawn), 2 * STRIDE + WIDTH - 1), marks)


def score_quality(docs: DataFrame, model: ByteNetwork, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of label 1, from the whole text alone.

    Null counts as empty; empty texts have a score too.  Rows are judged one by
    one, so repeated rows agree.  Of a long text PART_PLACES places are worked on
    at a time; 48 bytes stay of every STRIDE.  A column of ``docs`` named ``score`` is replaced.
    """

    def scores(data, starts):
        return {"score": pa.array(model.score(data, starts))}

    fields = [T.StructField("score", T.DoubleType())]
    return with_scores(docs.drop("score"), text_col, scores, fields)
