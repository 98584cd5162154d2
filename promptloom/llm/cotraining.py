"""Quality classifier by co-training: a content view and a metadata view teach each other, then score together.

Each view is a logistic regression: one over statistics of the text, one over what is known about the page (source, language, length).
Both start from labelled rows. In every round each view names the unlabelled rows it is surest of, and these join the other's
training rows with the named label. At the end each view's logit is calibrated on labelled rows held back from training, and the
calibrated views are combined by weights fitted there too.

Fitting sees at most ``fit_rows`` labelled documents, as matrices on the driver. The pool is every unlabelled document, kept as a narrow table of
its features: each round a teacher's column expression scores all of it, a histogram of bounded size tells how sure the surest are, and only
those it names, ``per_round`` on average, reach the driver. Scoring is a column expression over built-in functions too, so all documents are
judged in one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import hold, label_sample, release, settle
from promptloom.llm.quality_rules import with_statistics
from promptloom.storage import stored

CONTENT = ("word_length", "symbol_share", "mark_share", "upper_share", "dup_line_share", "digit_share", "words_per_line", "n_words")
METADATA = ("_length", "_source_at", "_lang_at")
SEEN = (*[f"_c{k}" for k in range(len(CONTENT))], *METADATA)
# Source names share this many columns by hash, language names as many.
BUCKETS = 32
# How finely sureness is told apart, in steps a logit, and the largest logit that is told from larger ones.
STEPS, TOP = 64, 30


@dataclass(frozen=True)
class View:
    """A fitted view: weights of its scaled features and the calibration of its logit."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[1:] + self.weights[0]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.logit(x) + self.offset

    def column(self, features: list[Column]) -> Column:
        total = F.lit(float(self.weights[0]))
        for f, w, m, s in zip(features, self.weights[1:], self.mean, self.scale):
            total = total + F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (f - float(m)) / float(s))) * float(w)
        return total * float(self.slope) + float(self.offset)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights, bias first, by Newton's method on the penalised likelihood; the bias is free of the penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_view(x: np.ndarray, y: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    return View(fit_logistic(np.clip((x - mean) / scale, -8, 8), y), mean, scale)


def calibrate(view: View, x: np.ndarray, y: np.ndarray) -> View:
    offset, slope = fit_logistic(view.logit(x)[:, None], y, penalty=1e-2)
    if slope <= 0:
        # A view that knows nothing says how frequent good rows are; none may vote against itself.
        share = (y.sum() + 1) / (len(y) + 2)
        slope, offset = 0.0, np.log(share / (1 - share))
    return View(view.weights, view.mean, view.scale, float(slope), float(offset))


# Of each view as teacher: keys of the pool's rows it names, these rows as the other view sees them, and their labels.
Named = list[tuple[list[int], np.ndarray, np.ndarray]]


def train(views: list[np.ndarray], y: np.ndarray, held: np.ndarray, surest: Callable[[list[View], list[set[int]]], Named], rounds: int):
    """Two calibrated views and the weights (bias, content, metadata) that combine their logits.

    ``surest`` names rows of the pool by the views so far; the second argument holds the keys that each learner knows already.
    """
    rows = [v[~held] for v in views]
    labels = [y[~held].astype(float)] * 2
    known: list[set[int]] = [set(), set()]
    fitted = [calibrate(fit_view(r, l), v[held], y[held]) for r, l, v in zip(rows, labels, views)]
    for _ in range(rounds):
        named = surest(fitted, known)
        if not any(keys for keys, *_ in named):
            break
        for teacher, (keys, seen, given) in enumerate(named):
            learner = 1 - teacher
            known[learner].update(keys)
            rows[learner] = np.concatenate([rows[learner], seen])
            labels[learner] = np.concatenate([labels[learner], given])
        fitted = [calibrate(fit_view(r, l), v[held], y[held]) for r, l, v in zip(rows, labels, views)]
    both = np.column_stack([f.calibrated(v[held]) for f, v in zip(fitted, views)])
    weights = fit_logistic(both, y[held], penalty=1e-2)
    if weights[1] <= 0:
        weights = np.array([0.0, 1.0, 0.0])
    return fitted, np.array([weights[0], weights[1], max(0.0, weights[2])])


def _squashed(name: str) -> Column:
    value = F.col(name)
    return F.log1p(value * (1.0 if name in ("n_words", "words_per_line", "word_length") else 100.0))


def content_features() -> list[Column]:
    return [_squashed(f) for f in CONTENT]


def metadata_numbers(source: str, lang: str, n_chars: str) -> list[Column]:
    """The squashed length, and the numbers of the source's and the language's column."""
    at = lambda c: F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(BUCKETS)).cast("int")
    return [F.log1p(F.greatest(F.coalesce(F.col(n_chars).cast("double"), F.lit(0.0)), F.lit(0.0))), at(source), at(lang)]


def metadata_features(length: str, source: str, lang: str) -> list[Column]:
    return [F.col(length), *[(F.col(c) == k).cast("double") for c in (source, lang) for k in range(BUCKETS)]]


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", lang: str = "lang",
          n_chars: str = "n_chars", label: str = "quality", fit_rows: int = 10_000, rounds: int = 4,
          per_round: int = 1_000, sure: float = 0.95, threshold: float = 0.2) -> DataFrame:
    """All rows held in ``_row`` with content_score, metadata_score, score (probabilities of good quality) and kept (score >= ``threshold``).

    ``fit_rows`` bounds the labelled documents that models are fitted on; an id's first row by its features stands for the id. All other documents are the
    pool, in which rows with equal features count once; in a round each view names about ``per_round`` of them whose label is ``sure`` (above a half). Every document is
    scored by its whole text. Null texts count as empty, null sources and languages as one more name, a null length as 0. Repeated rows get equal scores; other columns of any name stay in ``_row``. Without
    labelled documents of both kinds nothing can be learned: scores are null and everything is kept. No documents give no rows.
    """
    held = hold(docs, _id=F.col(doc_id), _text=F.col(text), _source=F.col(source), _lang=F.col(lang), _n_chars=F.col(n_chars))
    fitted = _fit(held.drop("_row"), labels.select(F.col(doc_id).alias("_key"), F.col(label).alias("_quality")), fit_rows, rounds, per_round, sure)
    if fitted is None:
        nothing = F.lit(None).cast("double")
        return held.select("_row", nothing.alias("content_score"), nothing.alias("metadata_score"), nothing.alias("score"), F.lit(True).alias("kept"))
    (content, metadata), weights = fitted
    numbers = dict(zip(METADATA, metadata_numbers("_source", "_lang", "_n_chars")))
    scored = with_statistics(held, "_text").withColumns(numbers).withColumns({
        "_content": content.column(content_features()), "_metadata": metadata.column(metadata_features(*METADATA))})
    chance = lambda z: 1.0 / (1.0 + F.exp(-z))
    total = F.lit(float(weights[0])) + F.col("_content") * float(weights[1]) + F.col("_metadata") * float(weights[2])
    return settle(scored.select("_row", chance(F.col("_content")).alias("content_score"), chance(F.col("_metadata")).alias("metadata_score"),
                         chance(total).alias("score")).withColumn("kept", F.col("score") >= threshold))


def _features(rows: DataFrame, *carry: str) -> DataFrame:
    """What the views see of each row, in columns ``SEEN``."""
    values = [*content_features(), *metadata_numbers("_source", "_lang", "_n_chars")]
    return with_statistics(rows, "_text").select(*carry, *[v.alias(n) for v, n in zip(values, SEEN)])


def _matrices(found: list) -> list[np.ndarray]:
    """The rows as the content view and as the metadata view see them."""
    content = np.array([[r[f] for f in SEEN[: len(CONTENT)]] for r in found]).reshape(-1, len(CONTENT))
    length, source, lang = (np.array([r[f] for r in found]) for f in METADATA)
    hot = np.eye(BUCKETS)
    return [content, np.column_stack([length, hot[source.astype(int)], hot[lang.astype(int)]])]


def _fit(docs: DataFrame, labels: DataFrame, fit_rows, rounds, per_round, sure):
    sample = F.broadcast(label_sample(labels, fit_rows, "_quality", "_key"))
    one = _features(docs.join(sample, "_id"), "_id", "_label").groupBy("_id").agg(F.min("_label").alias("_label"), F.min(F.struct(*SEEN)).alias("_seen"))
    known = one.select("_label", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1 << 40)).alias("_h"), "_seen.*")
    found = sorted(known.collect(), key=lambda r: r["_h"])
    good = np.array([r["_label"] > 0 for r in found], bool)
    if len(set(good.tolist())) < 2:
        return None
    views, held = _matrices(found), np.array([r["_h"] % 10 < 3 for r in found])
    if any(len(set(good[part].tolist())) < 2 for part in (held, ~held)):
        # Too few of a kind to hold some back.
        views, good, held = [np.concatenate([v, v]) for v in views], np.concatenate([good, good]), np.repeat([True, False], len(good))
    rest = _features(docs, "_id").join(labels.select(F.col("_key").alias("_id")), "_id", "left_anti").select(*SEEN).distinct()
    with stored(rest.select(*SEEN, F.xxhash64(*SEEN).alias("_h")), "pool") as pool:
        return train(views, good, held, lambda fitted, taken: _surest(pool, fitted, taken, per_round, sure), rounds)


def _surest(pool: DataFrame, fitted: list[View], taken: list[set[int]], per_round: int, sure: float) -> Named:
    """The pool's rows that either view is surest of and that the other does not know yet.

    Both labels are named in the proportion of the teacher's own scores over the pool, so a frequent one does not swamp the other. Rows are
    taken from the surest step of a logit downward; of the last step, the share that is still wanted, by hash.
    """
    features = [[F.col(f) for f in SEEN[: len(CONTENT)]], metadata_features(*METADATA)]
    fresh = lambda keys: F.expr(f"_h not in ({','.join(map(str, sorted(keys)))})") if keys else F.lit(True)
    told = [F.struct(F.lit(t).alias("t"), F.greatest(F.lit(float(-TOP)), F.least(F.lit(float(TOP)), view.column(features[t]))).alias("z"),
                     fresh(taken[1 - t]).alias("fresh")) for t, view in enumerate(fitted)]
    scored = pool.withColumn("_told", F.explode(F.array(*told))).select(*SEEN, "_h", "_told.*")
    wanted = F.col("fresh") & (F.abs("z") >= float(np.log(sure / (1 - sure))))
    scored = scored.withColumns({"step": F.floor(F.abs("z") * STEPS).cast("int"), "good": F.col("z") > 0, "wanted": wanted})
    # At most two views, two labels and TOP * STEPS steps.
    bins = scored.groupBy("t", "good", "step").agg(
        F.sum(1 / (1 + F.exp(-F.col("z")))).alias("p"), F.count("*").alias("n"), F.count(F.when(F.col("wanted"), 1)).alias("free")).collect()
    named = F.lit(False)
    for t in (0, 1):
        mine = [b for b in bins if b["t"] == t]
        share = sum(b["p"] for b in sorted(mine, key=lambda b: (b["good"], b["step"]))) / max(1, sum(b["n"] for b in mine))
        for good, most in ((True, max(1, int(per_round * share))), (False, max(1, int(per_round * (1 - share))))):
            left = most
            for b in sorted((b for b in mine if b["good"] == good and b["free"]), key=lambda b: -b["step"]):
                # The part of this step's rows that is still wanted: all of them but in the last step.
                part = F.pmod("_h", F.lit(1 << 30)) < int(min(1.0, left / b["free"]) * (1 << 30))
                left -= b["free"]
                if left <= 0:
                    break
            else:
                b, part = {"step": -1}, F.lit(True)
            named = named | (F.col("t") == t) & (F.col("good") == good) & ((F.col("step") > b["step"]) | (F.col("step") == b["step"]) & part)
    found = sorted(scored.filter(F.col("wanted") & named).collect(), key=lambda r: (r["t"], r["_h"]))
    out = []
    for t in (0, 1):
        mine = [r for r in found if r["t"] == t]
        out.append(([r["_h"] for r in mine], _matrices(mine)[1 - t], np.array([float(r["good"]) for r in mine])))
    return out


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the combined views do not reject, with their columns."""
    return release(judge(docs, labels, **options).filter("kept"))
