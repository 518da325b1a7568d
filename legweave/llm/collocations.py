"""Collocations of every language, grown from prefixes whose counts bound the scores of what they grow into."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.llm.batches import ragged, utf8
from legweave.llm.bitsets import bit_set, contains, places
from legweave.llm.segments import byte_set, segments
from legweave.llm.shingles import FACTOR, LOWER, UNFACTOR, mixed
from legweave.scratch import settle

# What ends a piece, and what parts the words of one.
BREAK, BLANK = byte_set(".,;:!?\n\x0b\x0c\r"), byte_set(" \t")
MISSING = "und"
# Scores are parts of so many.
UNIT = 2_000_000
# Bytes of text that are counted at a time, and bytes of phrases sent on at a time.
PART_BYTES, SENT_BYTES = 2_000_000, 64_000_000
# The frontier is first expanded down to the score of this many times the phrases that are wanted.
MARGIN = 2
# A language's leading phrases are first found in so many parts, so that no task ranks a language alone.
PARTS = 64


@dataclass(frozen=True)
class Mark:
    """The phrase of ``size`` words, ``at`` words after a phrase's first, is in a set of phrases."""

    phrases: object  # a broadcast bitmap
    size: int
    at: int


# Powers of the hashes' factors, kept by this worker for the largest text so far.
_POWERS: dict[np.uint64, np.ndarray] = {}


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    if len(_POWERS.get(factor, ())) < n:
        steps = np.full(max(n, PART_BYTES), factor, np.uint64)
        steps[0] = 1
        _POWERS[factor] = np.multiply.accumulate(steps)
    return _POWERS[factor][:n]


class _Words:
    """The words of some texts: hashes, places in the lower-cased bytes, and which are followed in their piece."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, seeds: np.ndarray):
        rows, lengths = len(starts) - 1, np.diff(starts)
        # Every text is followed by a break.
        padded = np.full(len(data) + rows, ord("\n"), np.uint8)
        padded[np.arange(len(data)) + np.repeat(np.arange(rows), lengths)] = LOWER[data]
        ends_piece = BREAK[padded]
        inside = ~(ends_piece | BLANK[padded])
        after = np.append(False, inside[:-1])
        first = np.flatnonzero(inside & ~after)
        # One blank after each word, so that a phrase is one run of bytes.
        kept = inside | after
        self.bytes = np.where(inside, padded, np.uint8(32))[kept]
        ends = np.flatnonzero(after & ~inside)
        self.at = np.append(0, np.cumsum(ends + 1 - first))
        pieces = np.cumsum(ends_piece)[first]
        self.follows = pieces[1:] == pieces[:-1]
        self.text = np.searchsorted(starts[1:] + np.arange(1, rows + 1), first, "right")
        self.seeds = seeds[self.text] if len(first) else np.empty(0, np.uint64)
        total = np.append(np.uint64(0), np.cumsum((self.bytes + np.uint64(1)) * _powers(FACTOR, len(self.bytes))))
        back = _powers(UNFACTOR, len(self.bytes))[self.at[:-1]]
        self.hashes = mixed((total[self.at[1:]] - total[self.at[:-1]]) * back)
        self._phrases: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.hashes)

    def phrases(self, size: int) -> np.ndarray:
        """A hash of language and words of the phrase that starts at each word; those over an end mean nothing."""
        if size not in self._phrases:
            n = max(0, len(self) - size + 1)
            rolled = self.seeds[:n]
            for k in range(size):
                rolled = mixed(rolled * FACTOR + self.hashes[k : k + n])
            self._phrases[size] = rolled
        return self._phrases[size]

    def whole(self, size: int) -> np.ndarray:
        """Whether the phrase of ``size`` words that starts at each word lies in one piece."""
        n = max(0, len(self) - size + 1)
        ok = np.ones(n, bool)
        for k in range(size - 1):
            ok &= self.follows[k : k + n]
        return ok


def _seeds(langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each row's language as a number, and the hash that each number's language gives to phrases."""
    coded = langs.dictionary_encode()
    names = np.array([zlib.crc32(name.encode()) for name in coded.dictionary.to_pylist()] or [0], np.uint64)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), mixed(names + np.uint64(1))


def _grouped(hashes: np.ndarray, spans: np.ndarray, sizes: np.ndarray, data: np.ndarray):
    """The first place of each distinct phrase and its number; equal hashes are checked byte by byte."""
    _, first, member, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    model = first[member]
    odd = sizes != sizes[model]
    check = np.flatnonzero(~odd & (model != np.arange(len(model))))
    lengths = sizes[check]
    unlike = data[ragged(spans[check], lengths)] != data[ragged(spans[model[check]], lengths)]
    if unlike.any():
        odd[check[np.repeat(np.arange(len(check)), lengths)[unlike]]] = True
    if odd.any():  # another phrase under the same hash: rows of its own, which Spark adds up
        counts = counts - np.bincount(member[odd], minlength=len(counts))
        first, counts = np.append(first, np.flatnonzero(odd)), np.append(counts, np.ones(odd.sum(), np.int64))
    return first, counts


def _counter(size: int, every: Sequence[Mark], any_of: Sequence[Mark], limit: int):
    """Rows (lang, text) to rows (lang, phrase, f) of parts of the texts."""

    def back(part: np.ndarray, kind: int) -> int:
        """After a cut between two words of one piece, phrases over it start among the last words before it."""
        if kind == 0 or size == 1:
            return 0
        inside = ~(BREAK | BLANK)[part]
        begins = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        return len(part) - int(begins[-(size - 1) :][0]) if len(begins) else 0

    def hit(words: _Words, mark: Mark, n: int) -> np.ndarray:
        return contains(mark.phrases.value, words.phrases(mark.size)[mark.at : mark.at + n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, seeds = _seeds(batch["lang"])
            langs = batch["lang"]
            data, starts = utf8(batch["text"])
            for part, at, row in segments(data, starts, (BREAK, BLANK), back, limit):
                words = _Words(part, at, seeds[codes[row : row + len(at) - 1]])
                n = max(0, len(words) - size + 1)
                keep = words.whole(size)
                for mark in every:
                    keep = keep & hit(words, mark, n)
                if any_of:
                    keep = keep & np.logical_or.reduce([hit(words, mark, n) for mark in any_of])
                found = np.flatnonzero(keep)
                spans = words.at[found]
                sizes = words.at[found + size] - spans - 1
                first, counts = _grouped(words.phrases(size)[found], spans, sizes, words.bytes)
                spans, sizes, of = spans[first], sizes[first], words.text[found[first]] + row
                cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, SENT_BYTES), "right")
                for lo, hi in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
                    if hi == lo:
                        continue
                    flat = words.bytes[ragged(spans[lo:hi], sizes[lo:hi])]
                    ends = np.append(0, np.cumsum(sizes[lo:hi])).astype(np.int32)
                    text = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(ends), pa.py_buffer(flat.tobytes()))
                    lang = pc.take(langs, pa.array(of[lo:hi])).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [lang, text, pa.array(counts[lo:hi].astype(np.int64))], ["lang", "phrase", "f"]
                    )

    return run


def count_phrases(
    rows: DataFrame, size: int, every: Sequence[Mark] = (), any_of: Sequence[Mark] = (), limit: int = PART_BYTES
) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``size`` words in rows (lang, text).

    Only phrases are counted that meet all marks of ``every`` and one of
    ``any_of``.  Marks depend on the phrase alone, so whatever is counted is
    counted in full; a set may let a phrase through that isn't in it.
    """
    parts = rows.mapInArrow(_counter(size, every, any_of, limit), "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def phrase_set(phrases: DataFrame, size: int):
    """A broadcast set of the phrases (lang, phrase) of ``size`` words, of one size whatever their number."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, seeds = _seeds(batch["lang"])
            data, starts = utf8(batch["phrase"])
            words = _Words(data, starts, seeds[codes])
            at = places(words.phrases(size)[np.flatnonzero(words.whole(size))])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at))], ["at"])

    return bit_set(phrases.select("lang", "phrase").mapInArrow(spread, "at long"))


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(UNIT * a / (l + r)), exactly."""
    wide = "decimal(20,0)"
    return F.call_function("div", F.lit(UNIT).cast("decimal(7,0)") * a.cast(wide), l.cast(wide) + r.cast(wide))


def _first(phrase: str, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def _rest(phrase: str, k: int) -> Column:
    return F.substr(phrase, F.length(_first(phrase, k)) + F.lit(2))


def _named(table: DataFrame, phrase: str, f: str) -> DataFrame:
    return table.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))


def _bounded(counted: DataFrame, words: DataFrame) -> DataFrame:
    """``counted`` with ``bound``, which no longer phrase that starts with this one can pass.

    Such a phrase occurs f times at most.  Cut after its first word, which
    occurs w times, its rest occurs no less often than itself, so its lowest
    score is at most that of f against w + f.
    """
    heads = _named(words, "head", "w")
    rows = counted.withColumn("head", _first("phrase", 1)).join(heads, ["lang", "head"])
    return rows.withColumn("bound", _score(F.col("f"), F.col("w"), F.col("f"))).drop("head", "w")


def _scored(counted: DataFrame, size: int, *known: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the lowest cut of each phrase, ties to the shortest first part.

    ``known`` holds the counts (lang, phrase, f) of all phrases that may be
    parts; a phrase with a part that is not among them is left out.
    """
    parts = known[0]
    for more in known[1:]:
        parts = parts.unionByName(more)
    k = F.explode(F.sequence(F.lit(1), F.lit(size - 1)))
    cuts = counted.select("lang", "phrase", F.col("f").alias("a"), k.alias("k"))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = cuts.withColumn("left", first).withColumn("right", F.substr("phrase", F.length("left") + F.lit(2)))
    cuts = cuts.join(_named(parts, "left", "l"), ["lang", "left"]).join(_named(parts, "right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.count(F.lit(1)).alias("cuts"), lowest)
    best = best.filter(F.col("cuts") == size - 1)
    return best.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def _uncovered(scored: DataFrame, longer: DataFrame, cover: int) -> DataFrame:
    """Phrases not inside one of one word more that is nearly as frequent.

    Any longer phrase that covers one holds one of one word more, which is no
    rarer and so covers it too.
    """
    words = F.size(F.split("phrase", " "))
    inner = F.explode(F.array(F.expr("substring_index(phrase, ' ', size(split(phrase, ' ')) - 1)"), _rest("phrase", 1)))
    inside = longer.select("lang", inner.alias("phrase"), F.col("f").alias("longer_f"))
    most = inside.groupBy("lang", "phrase").agg(F.max("longer_f").alias("longer_f"))
    wide = "decimal(20,0)"
    covered = F.col("longer_f").cast(wide) * 100 >= F.col("a").cast(wide) * cover
    rows = scored.join(most, ["lang", "phrase"], "left")
    return rows.filter(~F.coalesce(covered, F.lit(False))).select(*scored.columns)


def _leading(rows: DataFrame, most: int, order: Sequence[Column], tie: str) -> DataFrame:
    """The first ``most`` rows of each language with ``rank``; each of PARTS parts of a language is cut down first."""
    part = F.pmod(F.xxhash64(tie), F.lit(PARTS))
    within = Window.partitionBy("lang", "part").orderBy(*order)
    cut = rows.withColumn("part", part).withColumn("nth", F.row_number().over(within)).filter(F.col("nth") <= most)
    over = Window.partitionBy("lang").orderBy(*order)
    return cut.drop("part", "nth").withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= most)


def mine_collocations(
    docs: DataFrame,
    per_language: int = 2_000,
    least: int = 30,
    cover: int = 80,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The best phrases of two to four words of every language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; a text is cut into pieces at ``.,;:!?`` and line ends,
    and a piece into words at blanks and tabs.  Per language, ``n`` counts all
    words and f a phrase within pieces, overlaps included.  Candidates are
    phrases with a = f >= ``least``.  Cutting one in two, with counts l and r of
    its parts, scores floor(2000000 * a / (l + r)); the lowest cut counts, then
    the one with the shortest first part.  Candidates that lie inside a longer
    candidate at least ``cover`` per cent as frequent are dropped, and the first
    ``per_language`` by score, a (both falling) and phrase stay.

    Words and pairs are counted first.  From then on the frontier of prefixes
    grows best-first: a prefix's count bounds the score of whatever it grows
    into, so prefixes whose bound reaches the level of a language are expanded,
    together with the extensions, to either side, of phrases at that level,
    which decide whether these are dropped.  Where at least ``per_language``
    phrases at that level survive, everything at or above it is known, ties
    included, and the language is settled; otherwise its level falls and its
    frontier grows on.  An expansion is one pass over the texts in Spark, so the
    frontier is taken in levels and not one prefix at a time.

    Null and empty texts have no words; a null language counts as ``und``;
    repeated rows count as often as they come; other columns are ignored; an
    empty table, or a language without candidates, gives no rows.  Texts longer
    than PART_BYTES are counted in parts, without losing a phrase.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit(MISSING)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    words = settle(count_phrases(rows, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    words = words.filter(F.col("f") >= least)
    common = phrase_set(words, 1)
    pairs = count_phrases(rows, 2, [Mark(common, 1, 0), Mark(common, 1, 1)]).filter(F.col("f") >= least)
    pairs = settle(_bounded(pairs, words), "pairs")
    known = pairs.select("lang", "phrase", "f")
    scored = settle(_scored(known, 2, words), "scored")
    common = phrase_set(pairs, 2)
    open_langs = settle(pairs.select("lang").distinct(), "open")
    wanted, settled = MARGIN * per_language, []
    while not open_langs.isEmpty():
        level = _level(scored, open_langs, wanted)
        found = _expanded(rows, level, words, pairs, scored, common, least, cover)
        survivors = found.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        level = level.join(survivors, "lang", "left").withColumn("found", F.coalesce("found", F.lit(0)))
        level = settle(level.withColumn("done", (F.col("level") == 0) | (F.col("found") >= per_language)), "level")
        settled.append(found.join(level.filter("done").select("lang"), "lang", "left_semi"))
        open_langs = level.filter("NOT done").select("lang")
        wanted *= 4
    kind = "lang string, phrase string, a long, l long, r long, score long"
    best = docs.sparkSession.createDataFrame([], kind)
    for part in settled:
        best = best.unionByName(part)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = _leading(best, per_language, order, "phrase").join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _level(scored: DataFrame, langs: DataFrame, wanted: int) -> DataFrame:
    """(lang, level): the score of the ``wanted``-th pair of each language, 0 if it has fewer."""
    rows = scored.join(langs, "lang", "left_semi").select("lang", "phrase", "score")
    leading = _leading(rows, wanted, [F.desc("score"), F.asc("phrase")], "phrase")
    last = leading.filter(F.col("rank") == wanted).select("lang", F.col("score").alias("level"))
    return settle(langs.join(last, "lang", "left").select("lang", F.coalesce("level", F.lit(0)).alias("level")), "level")


def _expanded(
    rows: DataFrame,
    level: DataFrame,
    words: DataFrame,
    pairs: DataFrame,
    scored: DataFrame,
    common,
    least: int,
    cover: int,
) -> DataFrame:
    """The surviving phrases of the languages of ``level`` whose score is at their level or above."""

    def at_level(table: DataFrame, column: str) -> DataFrame:
        return table.join(level, "lang").filter(F.col(column) >= F.col("level")).select(*table.columns)

    rows = rows.join(level.select("lang"), "lang", "left_semi")
    known_pairs = pairs.select("lang", "phrase", "f")
    best2 = at_level(scored, "score")
    grow = Mark(phrase_set(at_level(pairs, "bound"), 2), 2, 0)
    left = Mark(phrase_set(best2, 2), 2, 1)
    in_common = [Mark(common, 2, at) for at in range(3)]
    triples = count_phrases(rows, 3, in_common[:2], [grow, left]).filter(F.col("f") >= least)
    triples = settle(_bounded(triples, words), "triples")
    known_triples = triples.select("lang", "phrase", "f")
    scored3 = settle(_scored(known_triples, 3, words, known_pairs), "scored")
    best3 = at_level(scored3, "score")

    grow = Mark(phrase_set(at_level(triples, "bound"), 3), 3, 0)
    left = Mark(phrase_set(best3, 3), 3, 1)
    quads = count_phrases(rows, 4, in_common, [grow, left]).filter(F.col("f") >= least)
    quads = settle(quads, "quads")
    # The last three words of a phrase need not start with a prefix that was expanded: those are counted now.
    heads = _named(known_triples, "head", "head_f")
    tails = quads.withColumn("head", _first("phrase", 3)).join(heads, ["lang", "head"], "left_semi")
    tails = tails.select("lang", _rest("phrase", 1).alias("phrase")).distinct()
    tails = tails.join(known_triples, ["lang", "phrase"], "left_anti")
    tails = count_phrases(rows, 3, any_of=[Mark(phrase_set(tails, 3), 3, 0)])
    tails = tails.join(known_triples, ["lang", "phrase"], "left_anti")
    scored4 = _scored(quads, 4, words, known_pairs, known_triples, settle(tails, "tails"))

    kept = _uncovered(best2, known_triples, cover).unionByName(_uncovered(best3, quads, cover))
    return settle(kept.unionByName(at_level(scored4, "score")), "found")
