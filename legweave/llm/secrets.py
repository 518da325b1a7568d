"""Secret scans in SQL functions: fixed patterns, and character Markov models for what they miss."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.scratch import settle

# The kinds in their order, the pattern of each, the group whose length counts, and its least length.
PATTERNS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
MODEL_KIND = "model"
KINDS = (*(kind for kind, *_ in PATTERNS), MODEL_KIND)
# Signs the models know; a run of them long enough is judged as one string.
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = r"[A-Za-z0-9+/_-]{16,}"
WORD = r"[A-Za-z0-9+/_-]{4,}"
# Bounds of the fit: labelled random strings, and documents whose words stand for ordinary strings.
SAMPLE_STRINGS = 20_000
SAMPLE_DOCUMENTS = 1_000
# Average log-likelihood ratio per sign from which a run counts as random.
RATIO = 0.8
BACKOFF = 16.0
# Matches that are walked at a time.
CHUNK = 256
SPAN = "struct<start:int,kind:int,end:int,hit:string>"


@dataclass(frozen=True)
class MarkovRatio:
    """log P(random) - log P(ordinary) of each sign after another; row 0 is the start of a string."""

    steps: tuple[float, ...]

    def score(self, run: Column) -> Column:
        """The average ratio per sign of a run made of SIGNS."""
        table = F.split(F.lit(",".join(f"{w:.6f}" for w in self.steps)), ",").cast("array<double>")
        walked = F.aggregate(
            codes(run),
            F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("last")),
            lambda acc, code: F.struct(
                (acc["total"] + F.element_at(table, acc["last"] * len(SIGNS) + code)).alias("total"), code.alias("last")
            ),
        )
        return walked["total"] / F.length(run)


def codes(run: Column) -> Column:
    """The place of each sign in SIGNS, from 1."""
    signs = F.filter(F.split(run, ""), lambda c: c != "")
    return F.transform(signs, lambda c: F.instr(F.lit(SIGNS), c))


def spans_of(text: Column, hits: Column, good: Column, kind: int, pattern: str) -> Column:
    """The spans of a pattern's matches that are ``good``, in code points.

    What stands between the matches gives their places, as both come from the
    same leftmost, non-overlapping search.  Texts without a match aren't split.
    Adding to an array copies it, so matches are walked in chunks: a text of
    very many costs their number to the power of 1.5.
    """
    steps = F.arrays_zip(F.split(text, pattern).alias("gap"), hits.alias("hit"), good.alias("good"))
    none = F.array().cast(f"array<{SPAN}>")

    def add(acc, step):
        start = acc["at"] + F.length(step["gap"])
        end = start + F.coalesce(F.length(step["hit"]), F.lit(0))
        found = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), step["hit"].alias("hit"))
        return F.struct(
            end.alias("at"), F.when(step["good"], F.array_append(acc["out"], found)).otherwise(acc["out"]).alias("out")
        )

    def add_chunk(acc, chunk):
        def after(z):
            return F.struct(z["at"].alias("at"), F.concat(acc["out"], z["out"]).alias("out"))

        return F.aggregate(chunk, F.struct(acc["at"].alias("at"), none.alias("out")), add, after)

    number = F.floor((F.size(steps) - 1) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), number), lambda i: F.slice(steps, i * CHUNK + 1, CHUNK))
    walked = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), none.alias("out")), add_chunk)
    return F.when(F.exists(good, lambda g: g), walked["out"]).otherwise(none)


def _at_least(signs: int):
    return lambda part: F.length(part) >= signs


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``base`` (spans of the fixed patterns) and ``runs`` (spans of long runs) per document; one pass."""
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    patterns = (*PATTERNS, (MODEL_KIND, RUN, 0, 16))
    found = found.withColumns(
        {f"hits_{kind}": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) for kind, pattern, *_ in patterns}
    )
    good, spans = {}, {}
    for n, (kind, pattern, group, least) in enumerate(patterns):
        hits = F.col(f"hits_{kind}")
        judged = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else hits
        long_enough = F.transform(judged, _at_least(least))
        good[f"good_{kind}"] = F.when(F.size(hits) > 0, long_enough).otherwise(F.array().cast("array<boolean>"))
        spans[kind] = spans_of(F.col("text"), hits, F.col(f"good_{kind}"), n, pattern)
    return found.withColumns(good).select(
        "id", F.concat(*[spans[kind] for kind, *_ in PATTERNS]).alias("base"), spans[MODEL_KIND].alias("runs")
    )


def fit(labelled: DataFrame) -> MarkovRatio:
    """The ratios learned from rows (string, random)."""
    walk = F.concat(F.array(F.lit(0)), codes(F.col("string")))
    pairs = F.arrays_zip(F.slice(walk, 1, F.size(walk) - 1).alias("a"), F.slice(walk, 2, F.size(walk)).alias("b"))
    seen = (
        labelled.select("random", F.explode(pairs).alias("step"))
        .filter("step.b > 0")
        .groupBy("random", "step.a", "step.b")
        .count()
    )
    width = len(SIGNS)
    counts = {side: [0.0] * ((width + 1) * width) for side in (True, False)}
    for side, a, b, n in seen.collect():  # at most two rows per pair of signs
        counts[side][a * width + b - 1] += n
    logs = {side: _conditional(table, width) for side, table in counts.items()}
    return MarkovRatio(tuple(r - o for r, o in zip(logs[True], logs[False], strict=True)))


def _conditional(table: Sequence[float], width: int) -> list[float]:
    """log P(sign | sign before); BACKOFF counts of each row follow the shares of single signs, one added to each."""
    whole = sum(table) + width
    single = [(sum(table[b::width]) + 1) / whole for b in range(width)]
    out: list[float] = []
    for row in range(0, len(table), width):
        total = sum(table[row : row + width]) + BACKOFF
        out += [math.log((n + BACKOFF * p) / total) for n, p in zip(table[row : row + width], single, strict=True)]
    return out


def labelled_strings(
    found: DataFrame,
    docs: DataFrame,
    id_col: str,
    text_col: str,
    strings: int = SAMPLE_STRINGS,
    documents: int = SAMPLE_DOCUMENTS,
) -> DataFrame:
    """Random strings that the fixed patterns found, and the words of some documents, as rows (string, random).

    Both sides are bounded samples in the order of a hash: ``strings`` found
    strings, and ``strings`` words of ``documents`` documents.  A found
    string is the last run of its match, without the name before it.
    """
    hit = F.explode("base").alias("span")
    value = F.regexp_extract(F.col("span.hit"), r"([A-Za-z0-9+/_-]+)[.=]*$", 1)
    random = found.select(hit).select(value.alias("string")).filter(F.length("string") >= 12).distinct()
    random = random.orderBy(F.xxhash64("string"), "string").limit(strings).withColumn("random", F.lit(True))
    # The ids are drawn without their texts, so that no task gathers those of all others.
    ids = docs.select(F.col(id_col).alias("id")).orderBy(F.xxhash64("id"), "id").limit(documents).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    some = texts.join(settle(ids, "drawn"), "id", "left_semi")
    bare = F.col("text")
    for _, pattern, *_ in PATTERNS:
        bare = F.regexp_replace(bare, pattern, " ")
    words = some.select(F.explode(F.regexp_extract_all(bare, F.lit(WORD), F.lit(0))).alias("string")).distinct()
    words = words.orderBy(F.xxhash64("string"), "string").limit(strings).withColumn("random", F.lit(False))
    return random.unionByName(words)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: MarkovRatio | None = None
) -> DataFrame:
    """Each document's secrets as ``base`` and ``spans``: arrays of (start, kind, end, hit), sorted.

    ``base`` holds the matches of the fixed patterns; ``spans`` adds runs of 16
    signs and more that the Markov models call random (kind 3).  Places are code
    points, ends exclusive.  Without ``model`` one is fitted on the table's own
    labelled strings.

    Null and empty texts have no spans; a table without labelled strings gives
    ratios of 0, so nothing is added.  Each row is judged by itself, so repeated
    rows repeat their result; other columns are ignored.
    """
    found = settle(matches(docs, id_col, text_col), "matches")
    model = model or fit(labelled_strings(found, docs, id_col, text_col))
    random = F.filter("runs", lambda run: model.score(run["hit"]) >= RATIO)
    return found.select(
        F.col("id").alias(id_col),
        F.array_sort("base").alias("base"),
        F.array_sort(F.concat("base", random)).alias("spans"),
    )


def span_list(spans: Column) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
