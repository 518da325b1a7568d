"""SentencePiece encoding and decoding by a batched Viterbi search over distinct words."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.llm.batches import gathered, list_column
from legweave.llm.samples import with_scores
from legweave.llm.shingles import FACTOR, SPAN, range_hashes

SPACE = "▁"
# The model file that the queries and the pipeline use; a parameter everywhere else.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed values of the model file's format: kinds of pieces and of models.
NORMAL, CONTROL, BYTE = 1, 3, 6
UNIGRAM, BPE = 1, 2
NO_PIECE, UNKNOWN = -1, -2
# Ids of words a worker remembers, words of one length searched at a time, and places of its two tables of answers.
REMEMBERED, ABREAST = 2_000_000, 20_000
WORD_SLOTS, PAIR_SLOTS = 19, 20
# Letters below this code point have their neighbours in a table; the others are looked up.
COMMON = 0x250


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message: number, and value or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or a longer copy of it that has room for n values."""
    if n <= len(array):
        return array
    out = np.zeros(n + n // 4, array.dtype)
    out[: len(array)] = array
    return out


@dataclass
class Vocabulary:
    """A model file: pieces with scores and kinds, and how text is prepared."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    model: int = UNIGRAM
    prefix: bool = True

    @classmethod
    def read(cls, data: bytes) -> Vocabulary:
        pieces, scores, kinds, model, prefix = [], [], [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(2) or rules.get(4, 1):
                    raise ValueError("only models that leave the text as it is are supported")
                prefix = bool(rules.get(3, 1))
        if any(SPACE in p.lstrip(SPACE) for p in pieces) or 4 in kinds:
            raise ValueError("pieces across words and user-defined pieces are not supported")
        return cls(pieces, np.array(scores), np.array(kinds), model, prefix)


@dataclass
class Codec:
    """Encodes and decodes; made once per worker from the model file."""

    vocabulary: Vocabulary

    def __post_init__(self) -> None:
        v = self.vocabulary
        usable = [i for i, p in enumerate(v.pieces) if v.kinds[i] == NORMAL and p]
        self.longest = max((len(v.pieces[i]) for i in usable), default=1)
        self.spelled = np.zeros((len(v.pieces), self.longest), np.uint32)
        for i in usable:
            self.spelled[i, : len(v.pieces[i])] = np.frombuffer(v.pieces[i].encode("utf-32-le"), np.uint32)
        lengths = np.array([len(v.pieces[i]) for i in usable], np.int64)
        hashes = np.zeros(len(usable), np.uint64)
        for k in range(self.longest):
            on = lengths > k
            hashes[on] = hashes[on] * FACTOR + self.spelled[np.array(usable)[on], k] + np.uint64(1)
        order = np.lexsort((hashes, lengths))
        self.keys = {n: hashes[order][lengths[order] == n] for n in range(1, self.longest + 1)}
        self.key_ids = {n: np.array(usable, np.int64)[order][lengths[order] == n] for n in range(1, self.longest + 1)}
        self.rank = {v.pieces[i]: (-v.scores[i], i) for i in usable}
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(SPACE, " ").encode()
            for p, k in zip(v.pieces, v.kinds.tolist(), strict=True)
        ]
        self.byte_ids = np.full(256, NO_PIECE, np.int64)
        for i in np.flatnonzero(v.kinds == BYTE).tolist():
            self.byte_ids[int(v.pieces[i][3:5], 16)] = i
        self.spells = bool((self.byte_ids >= 0).all())
        self.signs = np.unique(np.array([ord(a) for i in usable for a in v.pieces[i]], np.uint32))
        self.unknown = int(np.flatnonzero(v.kinds == 2)[0]) if (v.kinds == 2).any() else 0
        # Pairs of neighbouring pieces, and whether merging would have left them so; a later pair takes a place over.
        self.pair_keys = np.full(1 << PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_SLOTS, bool)
        self.near = np.zeros((COMMON, COMMON), bool)
        pairs = {(ord(a), ord(b)) for i in usable for a, b in zip(v.pieces[i], v.pieces[i][1:], strict=False)}
        for a, b in pairs:
            if a < COMMON and b < COMMON:
                self.near[a, b] = True
        self.far = np.array(sorted((a << 32) | b for a, b in pairs if a >= COMMON or b >= COMMON), np.uint64)
        # Whether merging a piece's own text gives the piece; filled as pieces turn up: 0 not asked, 1 yes, 2 no.
        self.stands = np.zeros(len(v.pieces), np.int8)
        self._forget()
        pools = [np.frombuffer(b, np.uint8) for b in self.bytes_of]
        self.piece_sizes = np.array([len(p) for p in pools], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.concatenate(pools) if pools else np.empty(0, np.uint8)

    def _forget(self) -> None:
        self.word_keys = np.zeros(1 << WORD_SLOTS, np.uint64)
        self.word_of = np.zeros(1 << WORD_SLOTS, np.int64)
        # The ids of known words end to end; memory is taken as the arrays fill.
        self.word_starts, self.word_ids = np.zeros(REMEMBERED, np.int64), np.empty(REMEMBERED, np.int32)
        self.known, self.held = 0, 0

    # Encoding

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start, and all ids end to end."""
        mark = SPACE if self.vocabulary.prefix else ""
        marked = [mark + t.replace(" ", SPACE) if t else "" for t in texts]
        points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.append(0, np.cumsum([len(t) for t in marked])).astype(np.int64)
        if not len(points):
            return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int32)
        cut = np.ones(len(points), bool)
        for lo in range(1, len(points), SPAN):
            hi = min(lo + SPAN, len(points))
            cut[lo:hi] = ~self._joins(points[lo - 1 : hi - 1], points[lo:hi])
        cut[starts[:-1][np.diff(starts) > 0]] = True
        words = np.flatnonzero(cut)
        ends = np.append(words[1:], len(points))
        index = self._looked_up(points, words, ends)
        sizes = self.word_starts[index + 1] - self.word_starts[index]
        ids = gathered(self.word_ids, self.word_starts[index], sizes)
        counted = np.append(0, np.cumsum(sizes))
        return counted[np.searchsorted(words, starts)], ids

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece holds the two signs side by side; where none does, a text can be cut."""
        common = (left < COMMON) & (right < COMMON)
        out = np.zeros(len(left), bool)
        out[common] = self.near[left[common], right[common]]
        rare = np.flatnonzero(~common)
        if len(rare) and len(self.far):
            keys = (left[rare].astype(np.uint64) << np.uint64(32)) | right[rare]
            at = np.minimum(np.searchsorted(self.far, keys), len(self.far) - 1)
            out[rare] = self.far[at] == keys
        if not self.spells:  # a run of unknown signs is one unknown piece
            lost = [~np.isin(side, self.signs) for side in (left, right)]
            out |= lost[0] & lost[1]
        return out

    def _looked_up(self, points: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word in this worker's memory, after learning those it lacks."""
        keys = range_hashes(points, words, ends)
        keys ^= keys >> np.uint64(29)
        keys = keys * FACTOR + (ends - words).astype(np.uint64)
        keys += keys == 0
        if self.held > REMEMBERED:
            self._forget()
        slot = (keys >> np.uint64(64 - WORD_SLOTS)).astype(np.int64)
        index = np.where(self.word_keys[slot] == keys, self.word_of[slot], -1)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            numbers = self._learn(points, words[missing[first]], ends[missing[first]])
            index[missing] = numbers[back]
            slot = (new >> np.uint64(64 - WORD_SLOTS)).astype(np.int64)
            self.word_keys[slot] = new
            # Of words that share a place the one written last stays, in both tables.
            self.word_of[slot] = numbers
        return index

    def _remember(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Adds words by their ids end to end, and returns their numbers."""
        known, held = self.known + len(sizes), self.held + len(ids)
        self.word_starts, self.word_ids = _room(self.word_starts, known + 1), _room(self.word_ids, held)
        self.word_starts[self.known + 1 : known + 1] = self.held + np.cumsum(sizes)
        self.word_ids[self.held : held] = ids
        numbers = np.arange(self.known, known)
        self.known, self.held = known, held
        return numbers

    def _learn(self, points: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Searches these words, equal lengths together, and returns their numbers."""
        lengths = ends - words
        numbers = np.zeros(len(words), np.int64)
        order = np.argsort(lengths, kind="stable")
        borders = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, borders):
            length = int(lengths[group[0]])
            step = max(1, ABREAST * 8 // (length + 8))
            for lo in range(0, len(group), step):
                some = group[lo : lo + step]
                sizes, ids = self._search(points[words[some][:, None] + np.arange(length)])
                numbers[some] = self._remember(sizes, ids)
        return numbers

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words of one length, as rows of code points.

        At each place the best piece that ends there is kept with its length,
        the back pointer.  Unigram models add up scores.  For merging models a
        piece fits if it stands beside the piece before it as merging would
        leave them; exactly one does.
        """
        rows, length = points.shape
        prefix = np.zeros((rows, length + 1), np.uint64)
        for j in range(length):
            prefix[:, j + 1] = prefix[:, j] * FACTOR + points[:, j] + np.uint64(1)
        powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(self.longest, FACTOR, np.uint64)))
        best = np.full((rows, length + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((rows, length + 1), NO_PIECE, np.int64)
        back = np.zeros((rows, length + 1), np.int64)
        merging = self.vocabulary.model == BPE
        worst = self.vocabulary.scores.min() - 10 if len(self.vocabulary.scores) else -10.0
        for j in range(1, length + 1):
            for n in range(min(j, self.longest), 0, -1):
                # In merging models one piece at most fits, so a row that has it is done.
                open_rows = (best[:, j - n] > -np.inf) & (best[:, j] == -np.inf) if merging else best[:, j - n] > -np.inf
                at = np.flatnonzero(open_rows)
                found = self._probe(prefix[at, j] - prefix[at, j - n] * powers[n], points[at, j - n : j], n)
                at, got = at[found >= 0], found[found >= 0]
                if not len(at):
                    continue
                if merging:
                    score = np.where(self._fits(piece[at, j - n], got), 0.0, -np.inf)
                else:
                    score = best[at, j - n] + self.vocabulary.scores[got]
                better = score > best[at, j]
                at, got, score = at[better], got[better], score[better]
                best[at, j], piece[at, j], back[at, j] = score, got, n
            lost = np.flatnonzero(best[:, j] == -np.inf)  # a sign no piece holds
            if merging:
                lost = lost[self._probe(prefix[lost, j] - prefix[lost, j - 1] * powers[1], points[lost, j - 1 : j], 1) < 0]
            best[lost, j] = best[lost, j - 1] + (0 if merging else worst)
            piece[lost, j], back[lost, j] = UNKNOWN, 1
        return self._walk_back(points, piece, back)

    def _probe(self, hashes: np.ndarray, signs: np.ndarray, n: int) -> np.ndarray:
        keys, ids = self.keys[n], self.key_ids[n]
        if not len(keys):
            return np.full(len(hashes), NO_PIECE, np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == hashes)
        hit = hit[(self.spelled[ids[at[hit]], :n] == signs[hit]).all(1)]
        out = np.full(len(hashes), NO_PIECE, np.int64)
        out[hit] = ids[at[hit]]
        return out

    def _walk_back(self, points: np.ndarray, piece: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, length = points.shape
        at = np.full(rows, length)
        every = np.arange(rows)
        path, places = [], []
        while (at > 0).any():
            path.append(np.where(at > 0, piece[every, at], NO_PIECE))
            places.append(at)
            at = np.where(at > 0, at - back[every, at], 0)
        ids = np.array(path[::-1]).T.reshape(rows, -1)
        ends = np.array(places[::-1]).T.reshape(rows, -1)
        taken = ids != NO_PIECE
        if not (ids == UNKNOWN).any():
            return taken.sum(1), ids[taken]
        sizes, out = [], []
        for r in range(rows):
            spelled: list[int] = []
            for i, end in zip(ids[r][taken[r]].tolist(), ends[r][taken[r]].tolist(), strict=True):
                spelled += [i] if i != UNKNOWN else self._spell(int(points[r, end - 1]), spelled)
            sizes.append(len(spelled))
            out += spelled
        return np.array(sizes), np.array(out, np.int64)

    def _spell(self, sign: int, before: list[int]) -> list[int]:
        """An unknown sign as byte pieces; without them, one unknown piece for a run of such signs."""
        if self.spells:
            return [int(self.byte_ids[b]) for b in chr(sign).encode("utf-8", "surrogatepass")]
        return [] if before and before[-1] == self.unknown else [self.unknown]

    # What merging leaves

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging ``left`` and ``right``'s joined text gives the two; no piece before: ``right`` alone."""
        fresh = np.unique(right[self.stands[right] == 0])
        for i in fresh.tolist():
            self.stands[i] = 1 if self._merge(self.vocabulary.pieces[i]) == [i] else 2
        out = self.stands[right] == 1
        ask = np.flatnonzero(out & (left >= 0))
        keys = (left[ask] << 32) | right[ask]
        slot = ((keys.view(np.uint64) * FACTOR) >> np.uint64(64 - PAIR_SLOTS)).astype(np.int64)
        known = self.pair_keys[slot] == keys
        fits = self.pair_fits[slot]
        if not known.all():
            new, back = np.unique(keys[~known], return_inverse=True)
            pieces = self.vocabulary.pieces
            answers = np.array(
                [self._merge(pieces[k >> 32] + pieces[k & 0xFFFFFFFF]) == [k >> 32, k & 0xFFFFFFFF] for k in new.tolist()]
            )
            fits[~known] = answers[back]
            self.pair_keys[slot[~known]] = keys[~known]
            self.pair_fits[slot[~known]] = fits[~known]
        out[ask] = fits
        return out

    def _merge(self, text: str) -> list[int]:
        """The text's pieces by merging the best-ranked pair of neighbours first, the leftmost of equals."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            ranked = [(rank[a + b][0], n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]
            if not ranked:
                break
            _, n = min(ranked)
            parts[n : n + 2] = [parts[n] + parts[n + 1]]
        return [rank[p][1] if p in rank else UNKNOWN for p in parts]

    # Decoding

    def decode(self, starts: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of ids end to end; ids outside the vocabulary raise, broken byte runs become U+FFFD."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.bytes_of)):
            raise ValueError("an id is outside the vocabulary")
        sizes = self.piece_sizes[ids]
        flat = gathered(self.piece_bytes, self.piece_starts[ids], sizes).tobytes()
        ends = np.append(0, np.cumsum(sizes))[starts].tolist()
        out = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if self.vocabulary.prefix and flat[a:a + 1] == b" ":
                a += 1
            out.append(flat[a:b].decode("utf-8", "replace"))
        return out


_CODECS: dict[int, Codec] = {}


def _codec(model: Broadcast) -> Codec:
    """This worker's codec of a broadcast model file."""
    key = hash(model.value)
    if key not in _CODECS:
        _CODECS[key] = Codec(Vocabulary.read(model.value))
    return _CODECS[key]


def _sent(spark: SparkSession, model_file: str) -> Broadcast:
    """The model file, of one size whatever the data; a file that can't be used fails here."""
    with open(model_file, "rb") as f:
        data = f.read()
    Vocabulary.read(data)
    return spark.sparkContext.broadcast(data)


def encode_texts(docs: DataFrame, model_file: str, text_col: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``ids`` and ``n_ids``, and with ``decode`` the text that the ids give back as ``decoded``.

    Null and empty texts have no ids.  The sign U+2581 stands for a space in
    the model, so it comes back as one; all else comes back as it was.  Rows
    are encoded one by one, so repeated rows agree.  Columns of ``docs`` named
    like the new ones are replaced.  A single word of n signs takes time in
    proportion to n, but is searched alone, so very long ones are slow.
    """
    model = _sent(docs.sparkSession, model_file)

    def coded(data, starts):
        codec = _codec(model)
        flat, at = data.tobytes(), starts.tolist()
        begins, ids = codec.encode([flat[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)])
        out = {"ids": _int_lists(begins, ids), "n_ids": pa.array(np.diff(begins).astype(np.int32))}
        if decode:
            out["decoded"] = pa.array(codec.decode(begins, ids), pa.string())
        return out

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.IntegerType())]
    if decode:
        fields.append(T.StructField("decoded", T.StringType()))
    return with_scores(docs.drop(*[f.name for f in fields]), text_col, coded, fields)


def _int_lists(begins: np.ndarray, ids: np.ndarray) -> pa.Array:
    return list_column(begins, pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32()))


def decode_ids(rows: DataFrame, model_file: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text of an array of ids; null gives null, no ids give empty text.

    An id outside the vocabulary, or null, fails; bytes that are no UTF-8 become
    U+FFFD.  A column of ``rows`` named ``decoded`` is replaced.
    """
    model = _sent(rows.sparkSession, model_file)
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            if lists.flatten().null_count:
                raise ValueError("an id is null")
            sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            begins = np.append(0, np.cumsum(sizes))
            texts = _codec(model).decode(begins, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            decoded = pa.array([t if x.is_valid else None for t, x in zip(texts, lists, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)
