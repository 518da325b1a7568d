"""Spelling variants: words one edit apart, found as prefix ranges of permuterm rotations."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.scratch import discard, settle

# What a run of letters is, and the mark at a word's end, which is no letter.
LETTERS = r"[A-Za-zÀ-ÿ]"
END = "$"
# A rotation longer than this is compared by its SHA-256, so that the rotations of a word of any length are bounded.
PLAIN = 64


def worn_runs(docs: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    """(word) for every run of ``least`` letters or more, A-Z in lower case, where one run in ``every`` lost a sign.

    Which runs lose one, and which sign, follows from the crc32 of id, colon and
    run; a null id counts as empty text.  Words that become too short go.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0)))
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    rows = rows.select("id", lower.alias("run"))
    rows = rows.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    worn = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + F.lit(2)))
    word = F.when(F.col("h") % F.lit(every) == 0, worn).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= least)


def _short(rotation: Column) -> Column:
    return F.when(F.length(rotation) <= PLAIN, rotation).otherwise(F.sha2(rotation, 256))


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation of the marked words, whole and without its last sign: (range, word, n, whole, fresh).

    ``word`` + END turned so that it starts after its i-th sign ends with that
    sign.  Without it, it is the prefix of the rotations of all words that have
    another sign there, and the whole rotation of the word that has none.
    ``fresh`` is false where the sign repeats the one before it: leaving out
    either of the two gives the same word, so one of them is enough.
    """
    word = F.col("word")

    def turned(i: Column) -> Column:
        """The rotation from the sign after the i-th on, up to the i-th."""
        return F.concat(F.substr(word, i + F.lit(1)), F.lit(END), F.substr(word, F.lit(1), i))

    def cut(i: Column) -> Column:
        before = F.concat(F.substr(word, i + F.lit(1)), F.lit(END), F.substr(word, F.lit(1), i - F.lit(1)))
        sign = F.substr(word, i, F.lit(1))
        fresh = (i == 1) | (sign != F.substr(word, F.greatest(i - F.lit(1), F.lit(1)), F.lit(1)))
        return F.struct(_short(before).alias("range"), F.lit(False).alias("whole"), fresh.alias("fresh"))

    def whole(i: Column) -> Column:
        return F.struct(_short(turned(i)).alias("range"), F.lit(True).alias("whole"), F.lit(True).alias("fresh"))

    length = F.length(word)
    both = F.concat(
        F.transform(F.sequence(F.lit(1), length), cut), F.transform(F.sequence(F.lit(0), length), whole)
    )
    return words.select("word", "n", F.explode(both).alias("r")).select("r.range", "word", "n", "r.whole", "r.fresh")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of all words with a near one: how many there are, and (-n, word) of the most frequent.

    The rows of one range agree but for one sign, so a range holds at most the
    one word without that sign and as many words as there are letters (90): it
    is scanned as one array, and every member takes from it the number and the
    best of the others.  Two near words meet in exactly one range.
    """
    member = F.struct("word", "n", "whole", "fresh")
    ranges = rotations(words).groupBy("range").agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)

    def near(one: Column) -> Column:
        def linked(other: Column) -> Column:
            # Words of one length differ by a replaced sign; the word without it is linked by the fresh ones.
            replaced = ~one["whole"] & ~other["whole"] & (one["word"] != other["word"])
            left_out = (one["whole"] != other["whole"]) & one["fresh"] & other["fresh"]
            return replaced | left_out

        others = F.filter("members", linked)
        best = F.array_min(F.transform(others, lambda o: F.struct((-o["n"]).alias("minus_n"), o["word"].alias("word"))))
        return F.struct(one["word"].alias("word"), F.size(others).cast("long").alias("near"), best.alias("best"))

    seen = ranges.select(F.explode(F.transform("members", near)).alias("m")).select("m.*").filter("near > 0")
    return seen.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of all rows (word, form): where following forms ends.

    A form is at least twice as frequent as its word, so a chain has at most 63
    steps; every round doubles the steps taken.
    """
    ways = settle(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = settle(
            ways.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "ways",
        )
        discard(ways)
        if longer.filter("moved").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")
        ways._settled_path = longer._settled_path


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    every: int = 97,
    times: int = 2,
) -> DataFrame:
    """The words of whole texts, the near word that each is taken for, and where that leads.

    Words are what :func:`worn_runs` gives, ``least_count`` times or more in
    all.  Two words are near if one inserted, deleted or replaced code point
    makes one of the other.  A word's ``form`` is its most frequent near word
    (ties: the smallest), if that is at least ``times`` as frequent.

    Columns: word, form, root (the last of the forms; the word itself without
    one), n, n_near, form_n.  Null texts have no words, a null id counts as
    empty text, repeated rows count as often as they come, and an empty table
    gives no rows; other columns are ignored.  Words of any length are handled;
    the work for one grows with the square of its length.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, so that forms lead to an end")
    runs = worn_runs(docs, id_col, text_col, least_length, every)
    counted = runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)
    words = settle(counted, "words")
    near = settle(near_words(words), "near")
    form_n = -F.col("best.minus_n")
    strong = form_n >= F.col("n") * F.lit(times)
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.word")).alias("form"),
        F.when(strong, form_n).alias("form_n"),
    )
    judged = settle(judged, "judged")
    discard(near)
    roots = last_forms(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
