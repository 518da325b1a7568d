"""Language identification: the family first, then linear support vector machines within it."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.llm.samples import bounded_sample, with_scores

UNDETERMINED = "und"
# Families of common languages by code; any other language is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "finnic": ("et", "fi"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
# Byte trigrams are hashed to so many buckets.
BUCKETS = 1 << 12
# Bounds of the fit: labelled documents per language, and in all.
PER_LANGUAGE, MOST_DOCUMENTS = 400, 4_000
# A text of so many letters is not one of the learned languages when its score is below the model's floor: SLACK of
# the lowest score of such a text in the sample, and FLOOR at most.
LEAST_LETTERS, SLACK, FLOOR = 200, 0.75, 0.6
STEPS, PENALTY = 150, 1e-3
SHARPNESS = 4.0

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
MIX = np.array([40503, 30011, 10007], np.uint32)


def trigram_profile(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per document, the square roots of the shares of its hashed byte trigrams (lower-case ASCII), as rows."""
    rows = len(starts) - 1
    counts = np.zeros((rows, BUCKETS), np.float32)
    if len(data) >= 3:
        low = LOWER[data].astype(np.uint32)
        code = (low[:-2] * MIX[0] + low[1:-1] * MIX[1] + low[2:] * MIX[2]) * np.uint32(2654435761)
        code = (code >> np.uint32(20)).astype(np.int32)
        for r in range(rows):  # one count per document; trigrams over a document's end are left out
            a, b = starts[r], starts[r + 1] - 2
            if b > a:
                counts[r] = np.bincount(code[a:b], minlength=BUCKETS)
    counts /= np.maximum(counts.sum(1, keepdims=True), 1)
    return np.sqrt(counts, out=counts)


def squared_hinge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine for labels 1 and -1, by accelerated descent.

    Both labels weigh alike, however many rows each has.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, rate = w.copy(), 1 / (4 + PENALTY)
    for step in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        slope = x.T @ (-2 * weight * y * slack) + PENALTY * ahead
        new = ahead - rate * slope
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class LanguageModel:
    """A one-versus-rest machine per family, and one per pair of languages within a family."""

    families: list[list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    floor: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> LanguageModel:
        groups: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            groups.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
        families = list(groups.values())
        rows = [squared_hinge(x, np.where(np.isin(langs, f), 1, -1).astype(np.float32)) for f in families]
        model = cls(families, np.array(rows) if rows else np.zeros((0, BUCKETS + 1), np.float32))
        for family in families:
            for a, b in combinations(family, 2):
                of = np.isin(langs, (a, b))
                model.pair_weights[a, b] = squared_hinge(x[of], np.where(langs[of] == a, 1, -1).astype(np.float32))
        return model

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's language, and a score from 0 to 1: the family's share times that of the language in it."""
        names = np.full(len(x), UNDETERMINED, object)
        scores = np.zeros(len(x))
        if not self.families or not len(x):
            return names, scores
        heat = _sigmoid(SHARPNESS * (x @ self.family_weights[:, :-1].T + self.family_weights[:, -1]))
        best = heat.argmax(1)
        share = heat[np.arange(len(x)), best] / heat.sum(1)
        for f, family in enumerate(self.families):
            own = np.flatnonzero(best == f)
            votes = np.zeros((len(own), len(family)))
            for (i, a), (j, b) in combinations(enumerate(family), 2):
                w = self.pair_weights[a, b]
                p = _sigmoid(SHARPNESS * (x[own] @ w[:-1] + w[-1]))
                votes[:, i] += p
                votes[:, j] += 1 - p
            pick = votes.argmax(1)
            names[own] = np.array(family, object)[pick]
            within = votes[np.arange(len(own)), pick] / max(len(family) - 1, 1) if len(family) > 1 else 1.0
            scores[own] = share[own] * within
        return names, scores


def fit_language_model(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    most_documents: int = MOST_DOCUMENTS,
) -> LanguageModel:
    """A model of a bounded sample: ``per_language`` documents of each language, ``most_documents`` in all.

    They are the first in the order of a hash of the id; of more languages than
    ``most_documents`` each has one document.  Only their profiles come to the
    driver, of one size whatever their length.  Rows without
    language or letters are left out.
    """
    usable = labelled.filter(F.col(lang_col).isNotNull() & has_letter(F.col(text_col)))
    rows = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    languages = rows.select("lang").distinct().count()
    per_language = max(1, min(per_language, most_documents // max(languages, 1)))
    chosen = bounded_sample(rows.select("id", "lang").distinct(), "lang", "id", per_language)
    sample = rows.join(chosen, ["id", "lang"], "left_semi").select("id", "lang", "text")

    def profiles(data, starts):
        return {"profile": pa.array([p.tobytes() for p in trigram_profile(data, starts)], pa.binary())}

    field = T.StructField("profile", T.BinaryType())
    made = with_scores(sample, "text", profiles, [field]).withColumn("letters", letters_in(F.col("text"))).drop("text")
    got = made.orderBy("lang", F.xxhash64("id"), "id").limit(max(most_documents, languages)).collect()
    x = np.array([np.frombuffer(r.profile, np.float32) for r in got]).reshape(len(got), BUCKETS)
    model = LanguageModel.fit(x, np.array([r.lang for r in got], object))
    scores = model.predict(x)[1][[r.letters >= LEAST_LETTERS for r in got]]
    model.floor = min(FLOOR, SLACK * float(scores.min())) if len(scores) else 0.0
    return model


def letters_in(text) -> Column:
    """How many letters of any script a text holds."""
    return F.regexp_count(text, F.lit(r"\p{L}"))


def in_some_language(text: Column, score: Column, model: LanguageModel) -> Column:
    """Whether a text may be in one of the model's languages, by its score.

    A text without a letter is in none, and one of LEAST_LETTERS letters is in
    none when its score is below the model's floor; shorter ones give too little
    evidence to be turned down.  A model that learned no language turns down
    nothing that has a letter.
    """
    foreign = F.when(score < model.floor, letters_in(text) >= LEAST_LETTERS).otherwise(F.lit(False))
    return has_letter(text) & ~foreign if model.families else has_letter(text)


def has_letter(text) -> Column:
    """Whether the text holds a letter of any script; null has none."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify_languages(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (or other ``names``), from whole texts alone.

    Texts that are null or hold no letter get ``und`` and score 0, as does every
    text under a model that learned no language.  Rows are judged one by one, so
    repeated rows agree; columns of ``docs`` named like the new ones are replaced.
    """

    def scores(data, starts):
        langs, score = model.predict(trigram_profile(data, starts))
        return {names[0]: pa.array(langs, pa.string()), names[1]: pa.array(score)}

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    judged = with_scores(docs.drop(*names), text_col, scores, fields)
    letters = has_letter(F.col(text_col))
    return judged.withColumns(
        {
            names[0]: F.when(letters, F.col(names[0])).otherwise(F.lit(UNDETERMINED)),
            names[1]: F.when(letters, F.col(names[1])).otherwise(F.lit(0.0)),
        }
    )
