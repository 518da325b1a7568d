"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.llm.batches import ragged, utf8
from legweave.llm.language import squared_hinge
from legweave.llm.samples import bounded_sample
from legweave.llm.segments import byte_set, segments
from legweave.llm.shingles import WHITE
from legweave.scratch import settle

# The kernel counts common subsequences of three signs that span at most SPAN bytes; each byte spanned costs DECAY.
SPAN, DECAY = 6, 0.6
# A unit longer than WINDOW bytes is read in windows of so many bytes, one every STEP.
WINDOW, STEP = 32, 8
SIGNS = 64
# A sentence ends at one of these.
STOPS = byte_set(".!?\n\r")
# Margins beyond this say no more; the margin of a missing unit is as far on the clean side.
FAR = 1.25
# Evidence is what is left of a unit's log odds ratio after so many standard errors.
ERRORS = 1.5
# A text's parts overlap by so much where they are cut within a unit.
PART_BYTES, OVERLAP = 1_000_000, 2 * WINDOW


def _sign_table() -> np.ndarray:
    """Bytes as 64 signs: letters without case, digits that stand for letters as these, 0 for what is only a gap."""
    table = np.zeros(256, np.uint8)
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = np.arange(1, 27)
    table[ord("0") : ord("9") + 1] = np.arange(27, 37)
    for sign, letter in zip("013457@$", "oieastas", strict=True):
        table[ord(sign)] = ord(letter) - ord("a") + 1
    table[0x80:0xC0] = 37 + np.arange(64) % 24  # the last byte of an accented letter
    table[0xC0:] = 61 + np.arange(64) % 3
    return table


SIGN = _sign_table()
OFFSETS = [(first, last) for last in range(2, SPAN) for first in range(1, last)]


def units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and document of every unit: a run without white space, or single signs one blank apart."""
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first = np.flatnonzero(solid & (edge[:-1] | np.append(True, ~solid[:-1])))
    end = np.flatnonzero(solid & (edge[1:] | np.append(~solid[1:], True))) + 1
    document = np.searchsorted(starts[1:], first, "right")
    single = (end - first == 1) & (SIGN[data[first]] > 0)
    spaced = single[1:] & single[:-1] & (first[1:] - end[:-1] == 1) & (document[1:] == document[:-1])
    begins = np.append(True, ~spaced)[: len(first)]
    return first[begins], end[np.append(~spaced, True)[: len(first)]], document[begins]


def _windows(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units in windows of at most WINDOW bytes, and each window's unit."""
    number = 1 + np.maximum(0, -(-(end - first - WINDOW) // STEP))
    unit = np.repeat(np.arange(len(first)), number)
    nth = ragged(np.zeros(len(first), np.int64), number)
    begin = first[unit] + nth * STEP
    return begin, np.minimum(begin + WINDOW, end[unit]), unit


def _subsequences(data: np.ndarray, first: np.ndarray, end: np.ndarray):
    """The byte that each subsequence starts at, its code and its weight, one offset pair at a time."""
    last = np.zeros(len(data), np.int32)
    last[first] = end
    last = np.maximum.accumulate(last)  # of the unit that a byte is in, or a place before it
    signs = np.append(SIGN[data], np.zeros(SPAN, np.uint8)).astype(np.int32)
    place = np.arange(len(data), dtype=np.int32)
    shifted = [np.where(place + d < last, signs[d : d + len(data)], 0) for d in range(SPAN)]
    for middle, far in OFFSETS:
        code = (shifted[0] << 12) + (shifted[middle] << 6) + shifted[far]
        code[(shifted[0] == 0) | (shifted[middle] == 0) | (shifted[far] == 0)] = 0
        yield code, DECAY ** (far + 1)


def _norms(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Running sums over the bytes of the squared weights of the subsequences that start there."""
    total = np.zeros(len(data), np.float32)
    for code, weight in _subsequences(data, first, end):
        total += np.float32(weight * weight) * (code > 0)
    return np.append(0.0, np.cumsum(total, dtype=np.float64))


def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings end to end, a blank between them, and where each begins and ends."""
    size = np.array([len(s) for s in strings], np.int64)
    first = np.cumsum(size + 1) - (size + 1)
    return np.frombuffer(b" ".join(strings) + b" ", np.uint8), first, first + size


def features(strings: list[bytes], columns: np.ndarray) -> np.ndarray:
    """Rows of the strings' normalised subsequence weights, for the codes that have a column (0 for none)."""
    out = np.zeros((len(strings), int(columns.max(initial=0)) + 1), np.float32)
    if not strings:
        return out
    data, first, end = _flat(strings)
    owner = np.repeat(np.arange(len(strings)), end - first + 1)
    for code, weight in _subsequences(data, first, end):
        at = np.flatnonzero(code)
        np.add.at(out, (owner[at], columns[code[at]]), np.float32(weight))
    total = _norms(data, first, end)
    norm = np.sqrt(total[end] - total[first])
    out[:, 0] = 0
    return out / np.maximum(norm, 1e-6)[:, None].astype(np.float32)


def all_columns(strings: list[bytes]) -> np.ndarray:
    """A column for every code that occurs in the strings."""
    columns = np.zeros(SIGNS**3, np.int32)
    if strings:
        seen = np.unique(np.concatenate([np.unique(code) for code, _ in _subsequences(*_flat(strings))]))
        seen = seen[seen > 0]
        columns[seen] = np.arange(1, len(seen) + 1)
    return columns


@dataclass
class StringKernelMachine:
    """The machine's expansion over its landmarks, summed up per subsequence, and a logistic unit over margins."""

    weights: np.ndarray  # of every subsequence code
    shift: float
    slopes: np.ndarray  # of the two highest margins
    level: float = 0.0

    def margins(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The two highest margins among the units of each document; -FAR for want of units."""
        best = np.full((len(starts) - 1, 2), -FAR)
        for part, at, row in segments(data, starts, (WHITE,), _overlap, PART_BYTES, 4 * PART_BYTES):
            first, end, document = units(part, at)
            if not len(first):
                continue
            answer = np.zeros(len(part), np.float32)
            squares = np.zeros(len(part), np.float32)
            for code, weight in _subsequences(part, first, end):
                answer += np.float32(weight) * self.weights[code]
                squares += np.float32(weight * weight) * (code > 0)
            answer = np.append(0.0, np.cumsum(answer, dtype=np.float64))
            squares = np.append(0.0, np.cumsum(squares, dtype=np.float64))
            begin, stop, unit = _windows(first, end)
            norm = np.sqrt(np.maximum(squares[stop] - squares[begin], 0))
            margin = (answer[stop] - answer[begin]) / np.maximum(norm, 1e-4) + self.shift
            margin = np.where(norm > 1e-4, np.clip(margin, -FAR, FAR), -FAR)
            margin = np.maximum.reduceat(margin, np.flatnonzero(np.append(True, unit[1:] != unit[:-1])))
            opens = np.flatnonzero(np.append(True, document[1:] != document[:-1]))
            high = np.maximum.reduceat(margin, opens)
            of = np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(document))))
            top = np.flatnonzero(margin == high[of])
            margin[top[np.append(True, of[top][1:] != of[top][:-1])]] = -FAR
            found = np.stack([high, np.maximum.reduceat(margin, opens)], 1)
            rows = document[opens] + row
            best[rows] = -np.sort(-np.concatenate([best[rows], found], 1), axis=1)[:, :2]
        return best

    def score(self, margins: np.ndarray) -> np.ndarray:
        """The probability of a document with these margins."""
        return 1 / (1 + np.exp(-(margins @ self.slopes + self.level)))


def _overlap(part: np.ndarray, kind: int) -> int:
    """After a cut at white space, the single signs before it, which may go on; after one within a unit, OVERLAP."""
    if kind < 0:
        return OVERLAP
    tail = part[-OVERLAP:]
    solid = ~WHITE[tail]
    pairs = solid[1:] & solid[:-1] | ~solid[1:] & ~solid[:-1]
    at = np.flatnonzero(pairs)
    return min(len(tail) - int(at[-1]) - 1 if len(at) else len(tail), len(part) - 1)


def sentence_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, document and sentence of every unit with a letter or digit, gaps at its ends cut off."""
    first, end, document = units(data, starts)
    begin, stop, unit = _windows(first, end)
    place = np.arange(len(data))
    solid = SIGN[data] > 0
    ahead = np.minimum.accumulate(np.where(solid, place, len(data))[::-1])[::-1]
    behind = np.maximum.accumulate(np.where(solid, place, -1))
    begin, stop = ahead[begin], behind[stop - 1] + 1
    good = begin < stop
    sentence = np.cumsum(STOPS[data])[begin[good]]
    return begin[good], stop[good], document[unit[good]], sentence


def train(
    strings: list[bytes], documents: np.ndarray, toxic: np.ndarray, landmarks: list[bytes], rounds: int = 4
) -> StringKernelMachine:
    """A machine for sentences, each given by its most telling unit, of labelled documents.

    A toxic document has at least one toxic sentence, but not all are: in every
    round its sentences that the machine finds toxic are the positive ones, or
    else the most toxic one, unless that is far on the other side.
    """
    machine = StringKernelMachine(np.zeros(SIGNS**3, np.float32), -1.0, np.zeros(2))
    if not landmarks or not toxic.any() or toxic.all():
        return machine
    columns = all_columns(landmarks)
    own = features(landmarks, columns)
    values, vectors = np.linalg.eigh((own @ own.T).astype(np.float64))
    kept = values > 1e-4 * values.max()
    whiten = (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float32)
    x = np.concatenate([features(strings[i : i + 2_000], columns) @ own.T for i in range(0, len(strings), 2_000)])
    x = x @ whiten
    # The first guess is the first sentence of each document: the most telling one.
    order = np.lexsort((np.arange(len(strings)), documents))
    leads = np.zeros(len(strings), bool)
    leads[order[np.append(True, documents[order][1:] != documents[order][:-1])]] = True
    positive = leads & toxic
    for _ in range(rounds):
        used = positive | ~toxic
        w = squared_hinge(x[used], np.where(positive[used], 1, -1).astype(np.float32))
        margin = x @ w[:-1] + w[-1]
        best = np.full(documents.max() + 1, -np.inf)
        np.maximum.at(best, documents, margin)
        positive = toxic & ((margin > 0) | ((margin == best[documents]) & (margin > -0.5)))
        if not positive.any():
            positive = leads & toxic
    spread = own.T @ (whiten @ w[:-1])
    machine.weights = spread[columns].astype(np.float32)
    machine.weights[columns == 0] = 0
    machine.shift = float(w[-1])
    return machine


def calibrate(margins: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes (0 or more) and level of a logistic unit, by Newton steps on weighted documents, slightly held back."""
    if toxic.all() or not toxic.any():
        return np.zeros(margins.shape[1]), 0.0
    x = np.hstack([margins, np.ones((len(margins), 1))])
    w, pull = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 1e-3 * weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - toxic)) + pull @ w
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + pull, slope)
        w -= np.clip(step, -2, 2)
    return np.maximum(w[:-1], 0), float(w[-1])


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, toxic, text) to the units of each sentence, in small letters, and the unit before each."""
    for batch in batches:
        data, starts = utf8(batch["text"])
        for part, at, row in segments(data, starts, (WHITE,), _overlap, PART_BYTES, 4 * PART_BYTES):
            lower = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part)
            begin, stop, document, sentence = sentence_units(lower, at)
            raw = lower.tobytes()
            who = pa.array(document + row)
            found = [raw[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
            opens = np.append(True, document[1:] != document[:-1])[: len(found)]
            before = [b"" if new else unit for new, unit in zip(opens.tolist(), [b"", *found], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(who),
                    batch["toxic"].take(who),
                    pa.array(sentence.astype(np.int64)),
                    pa.array(before, pa.binary()),
                    pa.array(found, pa.binary()),
                ],
                ["id", "toxic", "sentence", "before", "unit"],
            )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_label: int = 1_500,
    per_document: int = 8,
    landmarks: int = 192,
) -> StringKernelMachine:
    """A machine of a bounded sample: ``per_label`` documents of each label.

    ``labels`` has the id and ``toxic`` (0 or 1; others are left out); an id
    with both counts as 1.  All sentences of the sampled documents are read.  A
    unit's evidence is the log odds ratio of its being in toxic documents, less
    ERRORS standard errors, where each unit before it counts once; a sentence's
    unit is the one of most evidence, and each document sends the
    ``per_document`` sentences whose units have most of it to the fit.
    Landmarks are the units of most evidence that are no near copies of one
    another, and for a third the most common units of clean documents.  The
    logistic unit is fitted on whole texts of the sample, weighted to the
    labels' true shares.  Without documents of both labels all scores are equal.
    """
    marked = (
        labels.filter(F.col("toxic").isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    marked = settle(marked.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi"), "marked")
    sizes = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    chosen = bounded_sample(marked, "toxic", "id", per_label)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = settle(rows.join(chosen, "id").select("id", "toxic", "text"), "texts")
    id_type = sample.schema["id"].dataType.simpleString()
    kind = f"id {id_type}, toxic int, sentence long, before binary, unit binary"
    found = settle(sample.mapInArrow(_unit_rows, kind).distinct(), "units")
    # Copies of a document, and lines it repeats, have the same unit after the same unit: they count once.
    told = settle(found.select("toxic", "before", "unit").distinct(), "told")
    total = {r.toxic: r["count"] for r in told.groupBy("toxic").count().collect()}  # two rows

    def odds(count, of: int):
        return F.log((count + 0.5) / (F.lit(of + 0.5) - count))

    bad, good = F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)
    counts = told.groupBy("unit").agg(bad.alias("bad"), good.alias("good"))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    evidence = odds(F.col("bad"), total.get(1, 0)) - odds(F.col("good"), total.get(0, 0)) - ERRORS * error
    counts = settle(counts.withColumn("evidence", evidence), "evidence")
    telling = F.max(F.struct("evidence", "unit")).alias("best")
    best = found.join(counts, "unit").groupBy("id", "toxic", "sentence").agg(telling)
    best = best.select("id", "toxic", "best").distinct()
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("best.evidence"), "best.unit"))
    best = best.withColumn("nth", nth).filter(F.col("nth") <= per_document)
    sent = best.orderBy("toxic", F.xxhash64("id"), "id", "nth").select("id", "toxic", "best.unit")
    sent = sent.limit(2 * per_label * per_document).collect()
    toxic_units = counts.filter("bad >= 2 AND evidence > 0").orderBy(F.desc("evidence"), "unit").limit(20 * landmarks)
    clean_units = counts.filter("evidence <= 0").orderBy(F.desc("good"), "unit").limit(landmarks // 3)
    of_toxic = _unlike([bytes(r.unit) for r in toxic_units.collect()], landmarks - landmarks // 3)
    machine = train(
        [bytes(r.unit) for r in sent],
        np.unique([str(r.id) for r in sent], return_inverse=True)[1].astype(np.int64) if sent else np.empty(0, np.int64),
        np.array([r.toxic == 1 for r in sent], bool),
        of_toxic + [bytes(r.unit) for r in clean_units.collect()],
    )
    fields = [T.StructField("first", T.DoubleType()), T.StructField("second", T.DoubleType())]
    judged = _with_margins(sample, "text", machine, lambda m: {"first": m[:, 0], "second": m[:, 1]}, fields)
    got = judged.select("toxic", "first", "second").orderBy("toxic", "first", "second").limit(2 * per_label).collect()
    toxic = np.array([r.toxic == 1 for r in got], bool)
    share = {k: sizes.get(k, 0) / max(1, int((toxic == bool(k)).sum())) for k in (0, 1)}
    margins = np.array([(r.first, r.second) for r in got]).reshape(-1, 2)
    machine.slopes, machine.level = calibrate(margins, toxic, np.where(toxic, share[1], share[0]))
    return machine


def _unlike(strings: list[bytes], most: int, alike: float = 0.9) -> list[bytes]:
    """The first strings, none of them as much as ``alike`` to one before it."""
    if not strings:
        return []
    x = features(strings, all_columns(strings))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
    chosen: list[int] = []
    for i in range(len(strings)):
        if len(chosen) < most and x[i].any() and (not chosen or (x[chosen] @ x[i]).max() < alike):
            chosen.append(i)
    return [strings[i] for i in chosen]


def _with_margins(df: DataFrame, text_col: str, machine: StringKernelMachine, made, fields: list[T.StructField]) -> DataFrame:
    """``df`` and the columns that ``made`` gives for the margins of whole texts; the row travels as one struct."""
    packed = df.select(F.struct("*").alias("row"))
    name = df.select(text_col).columns[0]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            columns = made(machine.margins(*utf8(rows.field(name))))
            yield pa.RecordBatch.from_arrays([rows, *[pa.array(columns[n]) for n in names]], ["row", *names])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *fields])).select("row.*", *names)


def score_toxicity(docs: DataFrame, model: StringKernelMachine, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of label 1, by the two most toxic units of the whole text.

    A unit is a run without white space, or single signs one blank apart.
    Subsequences may leave out signs between, so insults that are stretched,
    spaced out or broken by signs still resemble their landmarks.  Null counts
    as empty; empty texts have a score too, the lowest.  Rows are judged one by
    one, so repeated rows agree.  A column of ``docs`` named ``score`` is replaced.
    """

    fields = [T.StructField("score", T.DoubleType())]
    return _with_margins(docs.drop("score"), text_col, model, lambda m: {"score": model.score(m)}, fields)
