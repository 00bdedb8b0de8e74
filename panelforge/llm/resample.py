"""Quality by importance resampling: keep texts in the proportions of a target.

Two generative models over hashed word n-grams, one of the good labelled texts and one
of all texts, give each text the log of its importance weight; every distinct text
counts once. Texts are dealt to four folds by their hash, and the models that score a text
are of the other three: they saw neither it nor a copy of it. Rows are drawn without replacement by Gumbel top-k: a row's key is its log
weight plus Gumbel noise that follows from its content, and the k largest keys stay. k
is how many good rows the table itself holds, by a cut between the labelled good and
bad texts in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import words as T
from panelforge.llm.common import labelled_sample, one_text_each, query, rarely, table
from panelforge.session import reliable_checkpoint

BITS = 16           # n-grams are counted in 2**16 cells
FOLDS = 4           # a text is scored by what the other folds hold
SAMPLE = 20_000     # good texts that the target model is learned from, at most
SMOOTH = 16.0       # grams added to a cell's target count and to what the raw count lets expect
BINS = 4096         # of each step towards the k-th key
COPIED = 22         # a bit table of 2**22 text hashes that occur twice


def _grams(s: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the one- and two-word grams of a slice, and their rows."""
    w = T.split_words(s, "runs")
    rows = w.rows()
    same = rows[1:] == rows[:-1]
    two = (w.hashes[:-1] * T.U(T._P) + w.hashes[1:])[same]
    # A word that stands twice in a row is a gram of its own kind.
    two = np.where((w.hashes[:-1] == w.hashes[1:])[same], T.U(0x5EED), two)
    cells = (T.mix(np.concatenate([w.hashes, two])) >> T.U(64 - BITS)).astype(np.int64)
    return cells, np.concatenate([rows, rows[1:][same]])


def _fold(hashes: pa.Array) -> np.ndarray:
    return T.mix(hashes.to_numpy().astype(np.int64).view(np.uint64)) % T.U(FOLDS)


def _count(batches) -> Iterator[pa.RecordBatch]:
    count = np.zeros((2, FOLDS << BITS), np.int64)
    for batch in rarely(batches):
        target, fold = batch["target"].to_numpy(zero_copy_only=False), _fold(batch["hash"]).astype(np.int64)
        for s in T.slices(batch["text"]):
            cells, rows = _grams(s)
            at = (fold[s.first + rows] << BITS) | cells
            count[0] += np.bincount(at, minlength=FOLDS << BITS)
            count[1] += np.bincount(at[target[s.first + rows]], minlength=FOLDS << BITS)
    at = np.flatnonzero(count[0])
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[0][at]), pa.array(count[1][at])], ["cell", "raw", "target"])


@dataclass
class Weights:
    """For each fold the log ratio of target to raw for each of 2**16 cells, by the counts
    of the other folds."""

    cells: np.ndarray

    @classmethod
    def from_counts(cls, raw: np.ndarray, target: np.ndarray) -> Weights:
        """Counts of each fold and cell."""
        raw, target = raw.sum(0) - raw, target.sum(0) - target
        # A cell's counts say how much likelier it is in the target than in the raw texts;
        # the fewer there are, the nearer to 1. Cells that no other fold has say nothing.
        share = target.sum(1, keepdims=True) / np.maximum(raw.sum(1, keepdims=True), 1)
        ratio = (target + SMOOTH) / (share * raw + SMOOTH)
        whole = (raw * ratio).sum(1, keepdims=True) / np.maximum(raw.sum(1, keepdims=True), 1)
        return cls(np.log(ratio / np.where(whole > 0, whole, 1.0)).astype(np.float32))

    def of(self, column, hashes: pa.Array) -> np.ndarray:
        """The log weight of each text; ``hashes`` are those of the texts."""
        out, fold = np.zeros(len(column)), _fold(hashes).astype(np.int64)
        for s in T.slices(column):
            cells, rows = _grams(s)
            out[s.first : s.first + len(s)] = np.bincount(rows, self.cells[fold[s.first + rows], cells], len(s))
        return out

    def keys(self, column, hashes: pa.Array, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log weights, and with Gumbel noise from 64 random bits each."""
        u = ((noise.astype(np.int64).view(np.uint64) >> T.U(11)).astype(float) + 0.5) / 2.0**53
        log = self.of(column, hashes)
        return log, log - np.log(-np.log(u))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))


def _distinct(rows: DataFrame) -> DataFrame:
    """``hash``, ``text``: every text once. Only texts that a table of bits calls copied
    are sent; it lets no copy escape."""
    word, bit = f"pmod(hash, {1 << COPIED}) div 64", f"cast(pmod(hash, {1 << COPIED}) % 64 as int)"
    # 2**16 words whatever the input. Read by a join: a function would need a process of its
    # own beside that of what follows in the same task.
    marks = (
        rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
        .groupBy(F.expr(word).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"))
    )
    copied = F.expr(f"coalesce((shiftright(bits, {bit}) & 1) = 1, false)")
    marked = rows.select("hash", "text", F.expr(word).alias("word")).join(F.broadcast(marks), "word", "left").select("hash", "text", copied.alias("copied"))
    return marked.where(~F.col("copied")).select("hash", "text").unionByName(marked.where("copied").groupBy("hash").agg(F.first("text").alias("text")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE) -> Weights:
    """Both models in one pass over the distinct texts: the raw one counts each, the
    target one those labelled 1, of ``sample`` ids at most and one for each id."""
    rows = _texts(docs, id_col, text_col)
    good = labelled_sample(labels, label, sample, F.col("label") == 1)
    # Bounded by ``sample`` rows.
    good = one_text_each(rows, good).select(F.xxhash64("text").alias("hash"), F.lit(True).alias("good")).distinct()
    found = (
        _distinct(rows).join(F.broadcast(good), "hash", "left")
        .select(F.coalesce("good", F.lit(False)).alias("target"), "hash", "text").mapInArrow(_count, "cell int, raw long, target long")
        .groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    )
    raw, target = np.zeros(FOLDS << BITS), np.zeros(FOLDS << BITS)
    raw[found.cell], target[found.cell] = found.raw, found.target
    return Weights.from_counts(raw.reshape(FOLDS, -1), target.reshape(FOLDS, -1))


@dataclass
class Cut:
    """Texts with a log weight of ``limit`` or more pass: ``hit`` of the good ones,
    ``slip`` of the bad ones. Of the ``good`` and ``bad`` labelled
    texts, ``passed`` pass."""

    limit: float
    hit: float
    slip: float
    good: int
    bad: int
    passed: int

    def good_rows(self, rows: int, passed: int, texts: int, passed_texts: int) -> int:
        """How many rows are good, of the number of rows and of distinct texts in all and
        of those that pass: the rows that pass, and the texts misjudged either way."""
        other = texts - self.good - self.bad
        found = (passed_texts - self.passed - self.slip * other) / (self.hit - self.slip) if self.hit > self.slip else other
        good = self.good + min(max(found, 0), other)
        return int(min(max(passed + good - passed_texts, 0), rows) + 0.5)


def cut_between(good: np.ndarray, bad: np.ndarray) -> tuple[float, float, float] | None:
    """The limit that parts good from bad log weights best (each kind counts alike), at
    the middle of the gap, and the shares of either kind at or above it. It is never
    above 0: a text that the target makes likelier isn't bad. Below all, where none parts
    them; None, where one kind is missing."""
    if not len(good) or not len(bad):
        return None
    good, bad = np.sort(good), np.sort(bad)
    at = np.unique(np.concatenate([good, bad]))
    limits = np.append(np.minimum((at[1:] + at[:-1]) / 2, 0), min(at[0], 0))
    hit = 1 - np.searchsorted(good, limits) / len(good)
    slip = 1 - np.searchsorted(bad, limits) / len(bad)
    best = int(np.argmax(hit - slip))
    return (float(limits[best]), float(hit[best]), float(slip[best])) if hit[best] > slip[best] else (float("-inf"), 1.0, 1.0)


def find_cut(
    docs: DataFrame, labels: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Cut | None:
    """The cut between labelled good and bad texts that ``docs`` holds; one text for each
    of at most ``sample`` ids of a kind, a text once. None if it can't be told."""
    kinds = [labelled_sample(labels, label, sample, F.col("label") == y) for y in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["label"], batch["hash"], pa.array(weights.of(batch["text"], batch["hash"]))], ["label", "hash", "log"])

    rows = one_text_each(_texts(docs, id_col, text_col), kinds[0].unionByName(kinds[1])).select("label", F.xxhash64("text").alias("hash"), "text")
    # Bounded by twice ``sample`` rows of numbers.
    found = rows.mapInArrow(run, "label int, hash long, log double").toPandas().sort_values("label").drop_duplicates("hash", keep="last")
    good, bad = found[found.label == 1], found[found.label == 0]
    cut = cut_between(good.log.to_numpy(), bad.log.to_numpy())
    return cut and Cut(*cut, len(good), len(bad), int((found.log >= cut[0]).sum()))


def least_key(keys: DataFrame, k: int) -> float:
    """The k-th largest of ``keys.key``, exactly. Each step counts the keys in equal
    steps between two bounds and goes on inside the one that holds the k-th."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    while low < high:
        width = (high - low) / BINS
        if not width > 0:
            break
        bin_ = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        counts = sorted(
            keys.where((F.col("key") >= low) & (F.col("key") <= high)).groupBy(bin_.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect(),
            key=lambda r: -r["bin"],
        )
        for r in counts:
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
        else:
            break
    return low


def _noise(id_col: str, text_col: str, seed: int):
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def resample(
    docs: DataFrame, weights: Weights, share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, cut: Cut | None = None
) -> DataFrame:
    """The rows drawn: ``doc_id``, ``log_weight``, ``gumbel_key``, ``kept`` (true).

    As many rows stay as ``cut`` calls good; without a cut, ``floor(share * rows + 0.5)``.
    The noise follows from id and text: a repeated row has the same key as its twin and
    stays or goes with it. NULL and empty texts have the log weight 0. Only the two
    columns are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            log, key = weights.keys(batch["text"], batch["hash"], batch["noise"].to_numpy())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["hash"], pa.array(log), pa.array(key)], ["doc_id", "hash", "log_weight", "gumbel_key"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"), _noise(id_col, text_col, seed).alias("noise"))
    keys = reliable_checkpoint(rows.mapInArrow(run, "doc_id long, hash long, log_weight double, gumbel_key double"), "keys")
    if cut is None:
        k = int(share * keys.count() + 0.5)
    else:
        texts = keys.groupBy("hash").agg(F.count("*").alias("n"), F.max("log_weight").alias("log"))
        passes = F.col("log") >= F.lit(cut.limit)
        k = cut.good_rows(*(x or 0 for x in texts.agg(F.sum("n"), F.sum(F.when(passes, F.col("n"))), F.count("*"), F.count_if(passes)).first()))
    least = least_key(keys.select(F.col("gumbel_key").alias("key")), k)
    return keys.where(F.col("gumbel_key") >= F.lit(least)).drop("hash").withColumn("kept", F.lit(True))


def keep_drawn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """``docs`` without the rows that aren't drawn; all columns stay. As many stay as are
    good by the labelled texts among them, all where those are of one kind. Keys are made
    again rather than joined, so texts aren't shuffled."""
    weights = fit(docs, labels, id_col, text_col)
    cut = find_cut(docs, labels, weights, id_col, text_col)
    least = resample(docs, weights, 1.0, id_col, text_col, seed, cut).agg(F.min("gumbel_key")).first()[0]
    least = float("inf") if least is None else least

    @F.arrow_udf("boolean")
    def drawn(text: pa.Array, hashes: pa.Array, noise: pa.Array) -> pa.Array:
        return pa.array(weights.keys(text, hashes, noise.to_numpy())[1] >= least)

    return docs.where(drawn(F.col(text_col), F.xxhash64(text_col), _noise(id_col, text_col, seed)))


@query("op2_resample")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = fit(docs, labels)
    return resample(docs, weights, cut=find_cut(docs, labels, weights))
