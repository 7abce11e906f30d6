"""Operator 8, toxicity by weak supervision.

1. Lexicons: from a bounded sample of labelled training documents
   (``SAMPLE_PER_CLASS`` of each class) the words and word beginnings that mark
   toxic documents are counted and ranked by how surely they do.
2. Voters: ``LEXICONS`` lexicon voters share the ranked words and beginnings, and
   pattern voters look for shouting, runs of marks, masked words and mixed
   letters and digits.  Each fires or does not.
3. Label model: a generative two-class model of the votes.  All documents'
   votes, unlabelled, are counted per vote pattern (at most 2 ** voters rows), and
   expectation-maximisation estimates every voter's firing rate in both classes
   (its accuracy) and the correlations between voters inside a class; evidence of
   correlated voters is divided by their summed correlation.  The sampled labels
   anchor the classes.
4. Classifier: a logistic regression on the presence of the ranked words,
   beginnings and patterns, trained on the sample with the label model's
   posteriors as targets; a sampled row's own label counts as one more voter.  Its
   log odds are scaled and shifted to fit the sampled labels.

Labels are read only of rows whose ``crc32(id as text) mod 3`` is not 1.  Neither
labels nor id, language or source are inputs of a score; only the text is.

Nulls: a null text counts as empty; an empty text gets the classifier's prior.  A
null id has no label and is not held out.  Label rows with a null or a value other than
0 and 1 are left out; several rows of one id count once, as toxic if any says
so.  Without labels of both classes every score is 0.  Repeated rows each keep
their row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.llm.common import BLOCK_BYTES, fresh, in_slices, materialize, once_per_worker

SAMPLE_PER_CLASS = 4000     # labelled documents of each class that the models are fitted on
FEATURES = 2048             # ranked words and beginnings
MIN_DOCS = 4                # sampled toxic documents that a feature needs
LEXICONS = 8
BEGINNINGS = (4, 5)         # characters of a word beginning
LABEL_ACCURACY = 0.97       # of a row's own label, as a voter
THRESHOLD = 0.7             # a document is rejected from this score on
PRIOR_DOCS = 1.0            # smoothing of voter rates, in documents
TABLE_WORDS = 300_000       # words a worker keeps; then it starts anew
WORD_LENGTH = 64            # longer words are no features
FLUSH = 400_000             # counted features a task holds before it passes them on

WORD = re.compile(r"\w+")

# Pattern voters.  The first looks at the text as it is, the others at what stands
# between white space, lower-cased.
SHOUTING = re.compile(r"[A-Z]{3,}\W+[A-Z]{3,}\W+[A-Z]{3,}")
PATTERNS = {
    "!shouting": SHOUTING,
    "!marks": re.compile(r"[!?]{3,}"),
    "!masked": re.compile(r"\w[*#@$]{2,}"),
    "!mixed": re.compile(r"[^\W\d_][013457]+[^\W\d_]"),
}


def blocks(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``BLOCK_BYTES`` characters, cut at white space."""
    at = 0
    while at < len(text):
        end = at + BLOCK_BYTES
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def chunk_features(chunk: str) -> list[str]:
    """Features of what stands between white space: its words, their beginnings
    and the patterns."""
    out = [name for name, p in PATTERNS.items() if p is not SHOUTING and p.search(chunk)]
    for word in WORD.findall(chunk):
        if len(word) <= WORD_LENGTH:
            out.append(word)
            out += [word[:k] + "*" for k in BEGINNINGS if len(word) > k]
    return out


def text_chunks(text: str) -> set[str]:
    out: set[str] = set()
    for b in blocks(text):
        out.update(b.lower().split())
    return out


class _Index(dict):
    """Chunk to the numbers of its features, filled on demand."""

    def __init__(self, features: list[str]) -> None:
        self.known = {f: i for i, f in enumerate(features)}

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        got = tuple(self.known[f] for f in chunk_features(chunk) if f in self.known)
        if len(chunk) <= WORD_LENGTH:
            self[chunk] = got
        return got

    def of(self, text: str) -> list[int]:
        """The numbers of all features present in ``text``."""
        found: set[int] = set()
        found.update(*map(self.__getitem__, text_chunks(text)))
        if len(self) > TABLE_WORDS:
            self.clear()
        if any(SHOUTING.search(b) for b in blocks(text)):
            found.add(self.known["!shouting"])
        return sorted(found)


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``id, y``: labels that may be learned from, one per id."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))


def label_sample(train: DataFrame, sizes: dict[int, int], per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class, chosen by a hash of the id."""
    parts = []
    for y in (0, 1):
        share = min(1.0, 0.9 * per_class / max(1, sizes.get(y, 0)))
        draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30))
        parts.append(train.where((F.col("y") == y) & (draw < math.ceil(share * (1 << 30)))).limit(per_class))
    return materialize(parts[0].unionByName(parts[1]))


def sample_texts(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """``y, text`` of the sampled ids.  The ids are broadcast: they are at most
    ``2 * per_class`` numbers.  An id's rows beyond the first text are left out."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return materialize(d.join(F.broadcast(sample), "id").groupBy("id").agg(
        F.max("y").alias("y"), F.min("text").alias("text")).select("y", "text"))


def rank_features(sample: DataFrame, sizes: dict[int, int], top: int = FEATURES) -> list[str]:
    """Words and beginnings that mark toxic documents, surest first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(got)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([got[k] for k in keys], pa.int64())], names=["f", "y", "n"])
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = {f for c in text_chunks(text) for f in chunk_features(c) if f not in PATTERNS}
                got.update((f, y) for f in found)
                if len(got) > FLUSH:
                    yield out()
                    got.clear()
        if got:
            yield out()
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    tally = (sample.mapInArrow(count, "f string, y int, n bigint").groupBy("f")
             .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
                  F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
             .where(f"a >= {MIN_DOCS}"))
    a, b = F.col("a"), F.col("b")
    odds = F.ln((a + 0.5) / (n1 - a + 0.5)) - F.ln((b + 0.5) / (n0 - b + 0.5))
    sure = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    rows = (tally.withColumn("sure", F.round(sure, 6)).where("sure > 2")
            .orderBy(F.desc("sure"), "f").limit(top).collect())
    return [r["f"] for r in rows]


def make_voters(features: list[str]) -> np.ndarray:
    """The lexicon of each feature: words and beginnings are dealt out in turn."""
    return np.arange(len(features)) % LEXICONS


def votes_of(found: list[int], lexicon: np.ndarray, n_words: int) -> int:
    """The votes of a document as a bit mask."""
    mask = 0
    for f in found:
        mask |= 1 << (int(lexicon[f]) if f < n_words else LEXICONS + f - n_words)
    return mask


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, labelled: np.ndarray, prior: float,
                    rounds: int = 25) -> dict:
    """Expectation-maximisation over vote patterns (rows of 0 and 1).

    ``counts``: documents per pattern; ``labelled``: sampled documents per
    pattern and class.  Returns firing rates per class, correlations inside the
    classes, and the log odds of every pattern."""
    x = patterns.astype(float)
    m = x.shape[1]

    def rates(w: np.ndarray) -> np.ndarray:
        return np.array([(w[:, y] @ x + PRIOR_DOCS) / (w[:, y].sum() + 2 * PRIOR_DOCS) for y in (0, 1)])

    base = math.log(prior / (1 - prior))
    theta, corr = rates(labelled), np.zeros((m, m))
    logit = np.zeros(len(x))
    for _ in range(rounds):
        share = 1 / (1 + np.clip(corr, 0, None).sum(axis=1))
        fire = np.log(theta[1]) - np.log(theta[0])
        quiet = np.log1p(-theta[1]) - np.log1p(-theta[0])
        logit = base + (x * fire + (1 - x) * quiet) @ share
        p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        w = labelled + np.stack([counts * (1 - p), counts * p], axis=1)
        theta = rates(w)
        cov = np.zeros((m, m))
        var = np.zeros(m)
        for y in (0, 1):
            c = x - theta[y]
            cov += (c * w[:, y:y + 1]).T @ c
            var += (c * c * w[:, y:y + 1]).sum(axis=0)
        corr = cov / np.sqrt(np.outer(var, var) + 1e-12)
        np.fill_diagonal(corr, 0)
    return {"rates": theta, "correlations": corr, "logit": logit}


def fit_classifier(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, width: int,
                   l2: float = 1e-5, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on present features, by Adam over all rows."""
    size = np.array([len(r) for r in rows])
    col = np.array([c for r in rows for c in r], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    w, b = np.zeros(width + 1), 0.0
    weight = weight / weight.sum()
    b = math.log(max(1e-6, target @ weight) / max(1e-6, 1 - target @ weight))
    w[width] = b
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=len(rows)) + w[width]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        grad = np.append(np.bincount(col, g[row], minlength=width) + l2 * w[:width], g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        w -= 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-9)
    return w[:width], float(w[width])


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the classifier's log odds that fit the sampled labels
    best (a logistic fit by Newton steps, held in a sane range)."""
    a, b = 1.0, 0.0
    weight = weight / weight.sum()
    # Targets just off 0 and 1, so that separable classes have a finite fit.
    n1 = max(1, int(y.sum()))
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = (p - t) * weight, np.maximum(p * (1 - p), 1e-9) * weight
        hess = np.array([[h @ (z * z), h @ z], [h @ z, h.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, np.array([g @ z, g.sum()]))
        step *= min(1.0, 1 / max(1e-12, float(np.abs(step).max())))
        a, b = float(np.clip(a - step[0], 0.2, 5.0)), b - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    return a, b


class ToxicityModel:
    """The fitted classifier, with the label model's estimates beside it."""

    def __init__(self, features: list[str], weights: np.ndarray, bias: float, label_model: dict | None) -> None:
        self.features, self.weights, self.bias, self.label_model = features, weights, bias, label_model

    def score_column(self, text: str | Column) -> Column:
        """Probability that a text is toxic."""
        features, weights, bias = self.features, self.weights, self.bias
        key = "toxicity", hash(tuple(features))

        @F.arrow_udf(T.DoubleType())
        def f(col: pa.Array) -> pa.Array:
            index = once_per_worker(key, lambda: _Index(features))
            z = in_slices(col, lambda x: math.fsum(weights[index.of(x or "")]) + bias, pa.float64()).to_numpy()
            return pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())
        return f(F.col(text) if isinstance(text, str) else text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel | None:
    """The model of ``docs`` and ``labels``; None without labels of both classes."""
    train = training_labels(labels, "doc_id", label_col)
    sizes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    sample = sample_texts(docs, label_sample(train, sizes, per_class), id_col, text_col, per_class)
    words = rank_features(sample, sizes)
    features = words + list(PATTERNS)
    lexicon, n_words = make_voters(words), len(words)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(features)
        for b in batches:
            found = [index.of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], names=["y", "found"])
    rows = sample.mapInArrow(look, "y int, found array<int>").collect()
    y = np.array([r["y"] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    found = [r["found"] for r in rows]

    def vote(col: pa.Array) -> pa.Array:
        index = once_per_worker(key, lambda: _Index(features))
        return in_slices(col, lambda t: votes_of(index.of(t or ""), lexicon, n_words), pa.int32())
    key = "toxicity", hash(tuple(features))
    mask = F.arrow_udf(vote, T.IntegerType())
    tally = {r["v"]: r["n"] for r in docs.select(mask(F.col(f"`{text_col}`")).alias("v")).groupBy("v").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    own = [votes_of(f, lexicon, n_words) for f in found]
    masks = sorted(set(tally) | set(own))
    at = {v: i for i, v in enumerate(masks)}
    m = LEXICONS + len(PATTERNS)
    patterns = (np.array(masks, dtype=np.int64)[:, None] >> np.arange(m)) & 1
    labelled = np.zeros((len(masks), 2))
    # Sampled documents stand for all training documents of their class.
    stands = {c: sizes[c] / max(1, int((y == c).sum())) for c in (0, 1)}
    for v, c in zip(own, y.tolist()):
        labelled[at[v], c] += stands[c]
    prior = sizes[1] / (sizes[0] + sizes[1])
    model = fit_label_model(patterns, np.array([float(tally.get(v, 0)) for v in masks]), labelled, prior)
    sure = math.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    logit = np.array([model["logit"][at[v]] for v in own]) + np.where(y == 1, sure, -sure)
    target = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    weight = np.array([stands[c] for c in y.tolist()])
    weights, bias = fit_classifier(found, target, weight, len(features))
    a, b = calibrate(np.array([weights[f].sum() + bias for f in found]), y, weight)
    weights, bias = a * weights, a * bias + b
    return ToxicityModel(features, weights, bias, model)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = THRESHOLD, score_col: str = "score",
                    predicted_col: str = "predicted", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``docs`` with the score (0 to 1) and 1 if it reaches the threshold, else 0."""
    model = fit(docs, labels, id_col, text_col, label_col, per_class)
    score = F.lit(0.0) if model is None else model.score_column(F.col(f"`{text_col}`"))
    return docs.withColumn(score_col, score).withColumn(
        predicted_col, F.when(F.col(score_col) >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rejected rows; columns unchanged."""
    score, says = fresh(docs, "_toxicity"), fresh(docs, "_toxic")
    return (score_documents(docs, labels, id_col, text_col, label_col, threshold, score, says)
            .where(F.col(says) == 0).drop(score, says))
