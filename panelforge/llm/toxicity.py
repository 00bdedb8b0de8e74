"""Toxicity classifier that keeps its score when a text names another group.

Logistic regression on the words of a text and their first bytes. For every labelled
text that names a group, a twin names the next group of the same kind instead; the
square of the change in score between the two is part of the loss, so that the mention
of a group by itself moves no text over the line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import words as T
from panelforge.llm.common import crc_remainder, labelled_sample, one_text_each, query, rarely, table
from panelforge.session import reliable_checkpoint

# Terms that name groups, by kind; each list is a cycle of swaps.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("she", "he"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("africans", "europeans", "asians", "americans"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "natives", "locals"),
    ("old", "young"), ("disabled", "blind", "deaf"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs", "athées"), ("noirs", "blancs", "arabes"),
    ("frauen", "männer"), ("christen", "muslime", "juden", "atheisten"), ("schwarze", "weiße"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos", "ateos"), ("negros", "blancos"),
)

BITS = 18            # features: 2**18
PREFIXES = (4, 5, 6)  # bytes of a word's head that are features, too
SAMPLE = 20_000      # labelled texts that are learned from, at most
EVIDENCE = 20.0      # chi-square that a feature needs
PENALTY = 1.0        # of squared changes between twins
SHRINK = 1e-4
STEPS = 400


def _features(s: T.Slice) -> tuple[T.Words, np.ndarray]:
    """Words of a slice, and the feature numbers of each: the word and its heads."""
    w = T.split_words(s, "letters")
    kinds = [w.hashes, *(T.prefix_hashes(s, w, n) + T.U(n) for n in PREFIXES)]
    return w, np.stack([(T.mix(h) >> T.U(64 - BITS)).astype(np.int64) for h in kinds], 1)


def identity_swaps() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the terms, ordered; the features of each, and of the one to swap in."""
    terms = [t for kind in IDENTITY_TERMS for t in kind]
    after = [kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i in range(len(kind))]
    made = []
    for names in (terms, after):
        w, f = _features(next(T.slices(pa.array([" ".join(names)]))))
        made.append((w.hashes, f))
    order = np.argsort(made[0][0])
    return made[0][0][order], made[0][1][order], made[1][1][order]


def _distinct(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.unique((rows << BITS) | features)
    return codes >> BITS, codes & ((1 << BITS) - 1)


def _evidence(batches) -> Iterator[pa.RecordBatch]:
    """How many texts of either label have each feature."""
    count = np.zeros((2, 1 << BITS), np.int64)
    for batch in rarely(batches):
        label = batch["label"].to_numpy()
        for s in T.slices(batch["text"]):
            w, f = _features(s)
            rows, f = _distinct(np.repeat(w.rows(), f.shape[1]), f.ravel())
            for y in (0, 1):
                count[y] += np.bincount(f[label[s.first + rows] == y], minlength=1 << BITS)
    at = np.flatnonzero(count.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[0][at]), pa.array(count[1][at])], ["feature", "no", "yes"])


def _examples(batches, wanted: np.ndarray, swaps) -> Iterator[pa.RecordBatch]:
    """The wanted features of each text and of its twin (NULL where it names no group)."""
    place = np.full(1 << BITS, -1, np.int64)
    place[wanted] = np.arange(len(wanted))
    terms, _, other = swaps

    def lists(n, rows, f):
        f = place[f]
        rows, f = _distinct(rows[f >= 0], f[f >= 0])
        return np.split(f, np.searchsorted(rows, np.arange(1, n))) if n else []

    for batch in rarely(batches):
        for s in T.slices(batch["text"]):
            w, f = _features(s)
            rows = w.rows()
            at = np.minimum(np.searchsorted(terms, w.hashes), len(terms) - 1)
            named = terms[at] == w.hashes
            twin = np.where(named[:, None], other[at], f)
            wide = np.repeat(rows, f.shape[1])
            has = np.bincount(rows, named, len(w)) > 0
            a, b = lists(len(w), wide, f.ravel()), lists(len(w), wide, twin.ravel())
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["label"].slice(s.first, len(s)), pa.array(a, kind), pa.array([x if y else None for x, y in zip(b, has)], kind)], ["label", "own", "twin"]
            )


def train(labels: np.ndarray, own: list[np.ndarray], twins: list[np.ndarray | None], size: int, penalty: float = PENALTY) -> np.ndarray:
    """Weights of ``size`` features and, last, the constant. Loss: mean log-loss, plus
    ``penalty`` times the mean squared change of score between twins, plus ``SHRINK``
    times the squared weights. Full gradients, so the result doesn't hang on an order."""
    flat = lambda x: (np.repeat(np.arange(len(x)), [len(y) for y in x]), np.concatenate([*x, np.zeros(0)]).astype(np.int64))
    rows, f = flat(own)
    pairs = [i for i, t in enumerate(twins) if t is not None]
    _, ft = flat([twins[i] for i in pairs])
    rt = np.repeat(np.arange(len(pairs)), [len(twins[i]) for i in pairs])
    ro = np.repeat(np.arange(len(pairs)), [len(own[i]) for i in pairs])
    fo = flat([own[i] for i in pairs])[1]
    w, n = np.zeros(size + 1), max(len(labels), 1)
    rate = (labels.sum() + 0.5) / (n + 1)
    w[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[f], len(labels)) + w[-1], -50, 50)))
        err = (p - labels) / n
        g = np.append(np.bincount(f, err[rows], size), err.sum())
        if pairs:
            change = np.bincount(ro, w[fo], len(pairs)) - np.bincount(rt, w[ft], len(pairs))
            pull = 2 * penalty * change / len(pairs)
            g[:-1] += np.bincount(fo, pull[ro], size) - np.bincount(ft, pull[rt], size)
        g[:-1] += 2 * SHRINK * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.05 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w


class Scorer:
    """Scores text columns in tasks. Holds a weight for each of 2**18 features."""

    def __init__(self, weights: np.ndarray, constant: float):
        self.weights, self.constant = weights, constant

    def score(self, column) -> np.ndarray:
        out = np.full(len(column), self.constant)
        for s in T.slices(column):
            w, f = _features(s)
            used = self.weights[f] != 0
            rows, f = _distinct(np.broadcast_to(w.rows()[:, None], f.shape)[used], f[used])
            out[s.first : s.first + len(s)] += np.bincount(rows, self.weights[f], len(s))
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """Learn from ``sample`` labelled texts at most, one for each id, none of them held
    out."""
    chosen = labelled_sample(labels, label, sample, crc_remainder("id", 5) != 0)
    # Bounded by ``sample`` rows.
    texts = reliable_checkpoint(one_text_each(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), chosen), "labelled")
    found = (
        texts.select("label", "text").mapInArrow(_evidence, "feature int, no long, yes long")
        .groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toPandas()
    )
    swaps = identity_swaps()
    sizes = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    no, yes = sizes.get(0, 0), sizes.get(1, 0)
    a, b = found.yes.to_numpy(float), found.no.to_numpy(float)
    total, has = max(no + yes, 1), a + b
    expected = has * yes / total
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = total**3 * (a - expected) ** 2 / (has * (total - has) * float(yes) * no) if yes and no else np.zeros(len(a))
    wanted = np.unique(np.concatenate([found.feature.to_numpy()[np.nan_to_num(chi) >= EVIDENCE].astype(np.int64), swaps[1].ravel(), swaps[2].ravel()]))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _examples(batches, wanted, swaps)

    rows = texts.select("label", "text").mapInArrow(examples, "label int, own array<int>, twin array<int>").toPandas()
    twins = [None if t is None else np.asarray(t) for t in rows.twin]
    w = train(rows.label.to_numpy(float), [np.asarray(x) for x in rows.own], twins, len(wanted))
    weights = np.zeros(1 << BITS)
    weights[wanted] = w[:-1]
    return Scorer(weights, float(w[-1]))


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 if score >= 0.5).

    NULL and empty texts get the score of a text without features. Every row gives a
    row. Only the two columns are read. Without labels of both kinds, all texts get the
    same score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = scorer.score(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = crc_remainder(id_col, 5) == 0
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns stay."""
    scorer = fit(docs, labels, id_col, text_col)

    @F.arrow_udf("boolean")
    def clean(text: pa.Array) -> pa.Array:
        return pa.array(scorer.score(text) < 0.5)

    return docs.where(clean(F.col(text_col)))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
