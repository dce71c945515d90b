"""Toxicity: gradient-boosted trees over dense features of a text, calibrated
by isotonic regression.

* **Lexicon.** Words that labelled toxic texts hold more often, learned in two
  passes over a bounded sample: document counts choose candidates, then each
  candidate is weighed by the number of different neighbourhoods (the word
  before and after) it has in toxic and in other texts, so that a group of
  near copies counts once. The sample's rows are dealt into folds; a row's
  features use the words learned without its own fold.
* **Features** (``FEATURES``): lexicon densities, nearness to second-person
  words, capitals, punctuation, and how often words are disguised (digits and
  signs for letters, stars, stretched or spaced letters), with a count of those
  whose plain form is in the lexicon. Every text is read whole.
* **Trees** are fitted by Spark ML on all folds but the first; the first one
  calibrates their margin by isotonic regression, so the score is a
  probability of the label.

Defined results: a null text is scored as an empty one. Labels that are null,
or whose id is null, teach nothing; of several labels of an id the largest
holds. Where the sample lacks one of the labels, every score is the share of
toxic labels in it (0 without labels). Copies of a text teach once. Other
columns pass through; ``score`` and ``predicted`` are replaced if present.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

WORD = re.compile(r"[^\W_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\S)")  # i d i o t, i.d.i.o.t
MASKED = re.compile(r"[^\W\d_][0-9@$!|+*]+[^\W\d_]")  # a sign or digit between letters
STRETCHED = re.compile(r"(.)\1\1")
ENDS = "\"'`.,;:!?()[]{}<>#$%&*+-=_/\\|~^«»“”„’…"
PLAIN = str.maketrans("013457@$!|+", "oieastasilt")
# Second-person words of the languages that the corpus holds (en, de, fr, es), lower case.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinen ihr euch euer eure "
    "tu te toi ton tes vous votre vos tú ti contigo usted ustedes vosotros vuestro vuestra tus".split())
NEAR = 5  # words
FEATURES = ("log_words", "lexicon_share", "lexicon_weight_share", "lexicon_hits", "lexicon_distinct", "lexicon_largest",
            "disguised_hits", "second_person_share", "hits_near_second_person", "capital_share", "shouted_share",
            "exclamation_share", "question_share", "sign_share", "disguise_share", "stretched_share")


def plain_form(word: str) -> str:
    """Digits and signs read as the letters they stand for, other signs and repeated letters dropped."""
    out = ""
    for c in word.lower().translate(PLAIN):
        if c.isalpha() and not out.endswith(c):
            out += c
    return out


@dataclass
class Lexicon:
    """Word weights, and the same weights by plain form and by (length, first, last letter) for starred words."""

    weights: dict[str, float]
    plain: dict[str, float] = field(init=False)
    starred: dict[tuple, list[str]] = field(init=False)

    def __post_init__(self):
        self.plain, self.starred = {}, {}
        for w, x in self.weights.items():
            form = plain_form(w)
            if len(form) >= 4:
                self.plain[form] = max(x, self.plain.get(form, 0.0))
                self.starred.setdefault((len(w), w[0], w[-1]), []).append(w)

    def disguised(self, token: str) -> float:
        """Weight of the word that a disguised token stands for, 0 if none."""
        found = self.plain.get(plain_form(token), 0.0)
        if not found and "*" in token and token[0] != "*" != token[-1]:
            for w in self.starred.get((len(token), token[0], token[-1]), ()):
                if all(a in ("*", b) for a, b in zip(token, w)):
                    found = max(found, self.weights[w])
        return found


def measure(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES`` for one whole text."""
    text = text or ""
    low = text.lower()
    words = WORD.findall(low)
    n = max(1, len(words))
    weights = lexicon.weights
    hits = [i for i, w in enumerate(words) if w in weights]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    for i in hits if second else ():
        at = bisect_left(second, i - NEAR)
        near += at < len(second) and second[at] <= i + NEAR
    found = [weights[words[i]] for i in hits]

    disguised, masked = [], 0
    for token in text.split():
        if token.isalpha():
            continue
        core = token.strip(ENDS)
        if not core or core.isalpha() or not MASKED.search(core):
            continue
        masked += 1
        if core.lower() not in weights and (x := lexicon.disguised(core.lower())):
            disguised.append(x)
    runs = [m.group() for m in SPACED.finditer(low)]
    masked += len(runs)
    disguised += [x for r in runs if (x := lexicon.plain.get(plain_form(r), 0.0))]
    times = Counter(w for w in words if STRETCHED.search(w)) if STRETCHED.search(low) else {}
    stretched = sum(times.values())
    disguised += [x for w, m in times.items() if w not in weights and (x := lexicon.plain.get(plain_form(w), 0.0)) for _ in range(m)]

    letters = max(1, sum(map(len, words)))
    size = max(1, len(text))
    capitals = CAPITALS.findall(text)
    signs = sum(map(text.count, "#$%&*@"))
    all_hits = found + disguised
    return [math.log1p(len(words)), len(all_hits) / n, sum(all_hits) / n, math.log1p(len(all_hits)),
            float(len({words[i] for i in hits})), max(all_hits, default=0.0), math.log1p(len(disguised)),
            len(second) / n, near / n, sum(map(len, capitals)) / letters, sum(len(c) > 1 for c in capitals) / n,
            text.count("!") / size, text.count("?") / size, signs / size, masked / n, stretched / n]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, max_rows: int, folds: int) -> DataFrame:
    """(text, toxic, fold) of at most ``max_rows`` labelled documents, chosen by
    the hash of their id; a text once. The chosen ids meet the documents by a
    broadcast, so no text is shuffled but those of the sample."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    n = known.count()
    order = F.xxhash64("id", F.lit("toxicity"))
    if n > 2 * max_rows:  # about twice as many as wanted go to the exact choice
        known = known.filter(F.pmod(order, F.lit(1 << 30)) < math.ceil((1 << 31) * max_rows / n))
    chosen = known.orderBy(order, "id").limit(max_rows)
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    met = slim.join(F.broadcast(chosen), "id").select("text", "toxic", F.xxhash64("text").alias("h"))
    once = met.groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # a text once
    return shared_table(once.select("text", "toxic", F.pmod(F.xxhash64("h"), F.lit(folds)).cast("int").alias("fold")))


def _weight(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))


def learn_lexicons(sample: DataFrame, folds: int, max_words: int, min_support: int, min_weight: float) -> list[Lexicon]:
    """Lexicons learned without fold 0, 1, ..., and last the one learned from all."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counter()
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                counts.update((w, toxic) for w in set(WORD.findall(text.lower())))
        yield pd.DataFrame([(w, n * t, n * (1 - t)) for (w, t), n in counts.items()], columns=["word", "a", "b"])

    sizes = {(r.fold, r.toxic): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    total = [sum(n for (_, t), n in sizes.items() if t == toxic) for toxic in (0, 1)]
    counted = (sample.select("text", "toxic").mapInPandas(words, "word string, a long, b long")
               .groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter(F.col("a") >= min_support))
    gain = F.log((F.col("a") + 0.5) / (total[1] + 1)) - F.log((F.col("b") + 0.5) / (total[0] + 1))
    rows = counted.filter(gain >= min_weight).orderBy((F.col("a") * gain).desc(), "word").limit(max_words).collect()
    candidates = frozenset(r.word for r in rows)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = set()
            for text, toxic, fold in zip(pdf["text"], pdf["toxic"], pdf["fold"]):
                w = ["", *WORD.findall(text.lower()), ""]
                out.update((w[i], w[i - 1], w[i + 1], toxic, fold) for i in range(1, len(w) - 1) if w[i] in candidates)
            yield pd.DataFrame(sorted(out), columns=["word", "before", "after", "toxic", "fold"])

    met = sample.mapInPandas(places, "word string, before string, after string, toxic int, fold int").distinct()
    seen = {(r.word, r.fold, r.toxic): r["count"] for r in met.groupBy("word", "fold", "toxic").count().collect()}  # words x folds x 2
    out = []
    for left_out in [*range(folds), None]:
        used = [f for f in range(folds) if f != left_out]
        n = [sum(sizes.get((f, t), 0) for f in used) for t in (0, 1)]
        weights = {}
        for w in candidates:
            other, toxic = (sum(seen.get((w, f, t), 0) for f in used) for t in (0, 1))
            if toxic >= min_support and (x := _weight(toxic, other, n[1], n[0])) >= min_weight:
                weights[w] = x
        out.append(Lexicon(weights))
    return out


def dense_features(text: Column, fold: Column, lexicons: list[Lexicon]) -> Column:
    """array<double> of FEATURES; ``fold`` says which of the lexicons reads a text."""

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series([measure(t, lexicons[f]) for t, f in zip(texts, number)], dtype=object)

    return features(text, fold)


@dataclass
class ToxicityModel:
    """Lexicon, trees and calibration; ``share`` alone if one of the labels was missing."""

    share: float
    lexicon: Lexicon | None = None
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def score(self, docs: DataFrame, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
        """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold)."""
        ship_code(docs.sparkSession)
        kept = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
        if self.trees is None:
            scored = kept.withColumn("__score", F.lit(self.share))
        else:
            vector = array_to_vector(dense_features(F.col(text_col), F.lit(0), [self.lexicon]))
            margin = self.trees.transform(kept.withColumn("__features", vector)).withColumn("__margin", vector_to_array("__raw")[1])
            scored = self.calibration.transform(margin).withColumn("__score", F.least(F.greatest("__isotonic", F.lit(0.0)), F.lit(1.0)))
        return scored.select(*kept.columns, F.col("__score").alias("score"),
                             (F.col("__score") >= threshold).cast("int").alias("predicted"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = 20000, folds: int = 4, max_words: int = 2000, min_support: int = 3, min_weight: float = 1.5,
        trees: int = 20, depth: int = 4, seed: int = 7) -> ToxicityModel:
    """Learn from ``labels`` (id, label) of ``docs``: at most ``max_rows``
    labelled documents are used, the bound of everything learned."""
    spark = docs.sparkSession
    ship_code(spark)
    sample = labelled_sample(docs, labels, label, id_col, text_col, max_rows, folds)
    toxic = {(r.toxic, r.first): r["count"] for r in sample.groupBy("toxic", (F.col("fold") == 0).alias("first")).count().collect()}
    n, positive = sum(toxic.values()), sum(m for (t, _), m in toxic.items() if t)
    if {(t, first) for t in (0, 1) for first in (True, False)} - set(toxic):
        return ToxicityModel(positive / n if n else 0.0)
    lexicons = learn_lexicons(sample, folds, max_words, min_support, min_weight)
    measured = shared_table(sample.select(
        dense_features(F.col("text"), F.col("fold"), lexicons[:folds]).alias("f"), F.col("toxic").cast("double").alias("__label"), "fold"))
    rows = measured.coalesce(8).select(array_to_vector("f").alias("__features"), "__label", "fold")
    learner = GBTClassifier(featuresCol="__features", labelCol="__label", predictionCol="__class", maxIter=trees, maxDepth=depth,
                            stepSize=0.3, minInstancesPerNode=3, seed=seed, maxMemoryInMB=64)
    boosted = learner.setRawPredictionCol("__raw").setProbabilityCol("__probability").fit(rows.filter("fold <> 0"))
    held = boosted.transform(rows.filter("fold = 0")).withColumn("__margin", vector_to_array("__raw")[1])
    shares = held.groupBy("__margin").agg(F.avg("__label").alias("__label"), F.count(F.lit(1)).cast("double").alias("__rows"))
    calibration = IsotonicRegression(featuresCol="__margin", labelCol="__label", weightCol="__rows",
                                     predictionCol="__isotonic").fit(shares)  # a row for each margin
    return ToxicityModel(positive / n, lexicons[folds], boosted, calibration)
