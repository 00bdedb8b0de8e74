"""Class-based language model: words in classes found by exchange clustering.

``P(w | before) = P0(w) * ((1 - weight) + weight * (1 - u) * T(class of w | class of
before) / P0(class of w))`` for known words and ``u = P0(unknown)`` for unknown ones,
where P0 is the smoothed unigram model. So a word's emission within its class is
``P0(w) / P0(class)``, and the probabilities of all words add up to 1.

Every word has a class. The ``single`` most frequent words are clustered one by one;
all others by their spelling (last bytes), which is clustered as if it were a word.
The statistics that clustering needs, how often one item follows another, count every
token of every text that is learned from; they form a table of a fixed number of cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import words as T
from panelforge.llm.common import crc_remainder, longs, query, rarely, table
from panelforge.session import reliable_checkpoint

END = np.uint64(0xE0D0E0D0E0D0E0D1)   # stands for the end of a text
SMOOTH = 0.1
HELD = 2_000_000                      # tokens that a task holds before it adds them up
STEPS_AN_OCTAVE = 16


@dataclass(frozen=True)
class Settings:
    classes: int = 64       # with the end's own
    single: int = 4096      # words that are clustered one by one
    shapes: int = 1024      # spellings that stand for all other words
    hot: int = 1 << 18      # words whose counts each task holds; the rest are joined
    sweeps: int = 12
    weight: float = 0.9     # of the class model against the unigram model
    prior: float = 64.0     # transitions added to each class


def _tokens(s: T.Slice, shapes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of a slice's tokens, the ends included, and row ends."""
    w = T.split_words(s)
    low = T._LOWER[s.raw]
    shape = T._hashes(low, np.maximum(w.start, w.stop - 3), w.stop) % T.U(shapes)
    at = w.ends[1:]
    return np.insert(w.hashes, at, END), np.insert(shape.astype(np.int64), at, 0), w.ends + np.arange(len(w.ends))


def _runs(keys: np.ndarray):
    """Distinct keys, the place of one of each, and counts."""
    order = np.argsort(keys)
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], order[first], np.diff(np.append(first, len(k)))


def _count_words(batches, shapes: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out():
        h, shape = (np.concatenate(x) for x in zip(*held))
        words, place, n = _runs(h)
        return pa.RecordBatch.from_arrays([longs(words), longs(n), pa.array(shape[place].astype(np.int32))], ["word", "n", "shape"])

    for batch in rarely(batches):
        for s in T.slices(batch["text"]):
            h, shape, _ = _tokens(s, shapes)
            held.append((h, shape))
            size += len(h)
            if size >= HELD:
                yield out()
                held, size = [], 0
    if held:
        yield out()


class Items:
    """From words to items: single words, then shapes, then the end."""

    def __init__(self, single: np.ndarray, shapes: int):
        self.order = np.argsort(single)
        self.sorted = single[self.order]
        self.shapes = shapes
        self.count = len(single) + shapes + 1

    def of(self, h: np.ndarray, shape: np.ndarray) -> np.ndarray:
        k = len(self.sorted)
        out = k + shape
        if k:
            at = np.minimum(np.searchsorted(self.sorted, h), k - 1)
            out = np.where(self.sorted[at] == h, self.order[at], out)
        out[h == END] = self.count - 1
        return out


def _before(items: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """The item before each; ``start`` at the head of a row."""
    out = np.empty_like(items)
    out[1:] = items[:-1]
    out[ends[:-1]] = start
    return out


def _count_pairs(batches, items: Items) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out():
        codes, _, n = _runs(np.concatenate(held))
        return pa.RecordBatch.from_arrays(
            [pa.array((codes // items.count).astype(np.int32)), pa.array((codes % items.count).astype(np.int32)), longs(n)], ["a", "b", "n"]
        )

    for batch in rarely(batches):
        for s in T.slices(batch["text"]):
            h, shape, ends = _tokens(s, items.shapes)
            i = items.of(h, shape)
            held.append(_before(i, ends, items.count - 1) * items.count + i)
            size += len(i)
            if size >= HELD:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _vectors(batch: pa.RecordBatch, side: str, classes: np.ndarray, count: int) -> np.ndarray:
    """For each item of a batch, how often each class stands on that side of it."""
    lists, n = batch[side], batch[f"{side}_n"]
    ends = np.append(lists.offsets.to_numpy()[:-1], lists.offsets.to_numpy()[-1])
    base = ends[0]
    row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    others = classes[lists.flatten().to_numpy()]
    return np.bincount(row * count + others, n.flatten().to_numpy(), batch.num_rows * count).reshape(-1, count) if len(ends) and base >= 0 else np.zeros((0, count))


def _transitions(batches, classes: np.ndarray, count: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((count, count))
    for batch in batches:
        np.add.at(total, classes[batch["item"].to_numpy()], _vectors(batch, "right", classes, count))
    a, b = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), longs(total[a, b])], ["a", "b", "n"])


def likelihood(m: np.ndarray) -> float:
    """What exchange raises: log-likelihood of class transitions, but for a constant."""
    phi = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return phi(m) - phi(m.sum(0)) - phi(m.sum(1))


def _moves(batches, classes: np.ndarray, m: np.ndarray, turn: int, turns: int) -> Iterator[pa.RecordBatch]:
    """The best class for each item whose turn it is, all others staying."""
    count = len(m)
    phi = lambda x: x * np.log(np.maximum(x, 1e-300))
    out, pad, of = m.sum(1), m.sum(0), []
    for batch in batches:
        item = batch["item"].to_numpy()
        left, right = _vectors(batch, "left", classes, count), _vectors(batch, "right", classes, count)
        own = np.array([dict(zip(a.as_py(), b.as_py())).get(i, 0) for i, a, b in zip(item, batch["right"], batch["right_n"])], float)
        for k, i in enumerate(item):
            if i * 7919 % turns != turn or i == len(classes) - 1:
                continue
            a, s = classes[i], own[k]
            r, l = right[k].copy(), left[k].copy()
            r[a] -= s
            l[a] -= s
            rest = m.copy()
            rest[a] -= r
            rest[:, a] -= l
            rest[a, a] -= s
            rest = np.maximum(rest, 0)
            o, p = out.copy(), pad.copy()
            o[a] -= r.sum() + s
            p[a] -= l.sum() + s
            d = np.arange(count)
            gain = (phi(rest + r) - phi(rest)).sum(1) + (phi(rest + l[:, None]) - phi(rest)).sum(0)
            same = rest[d, d]
            gain += phi(same + r + l + s) + phi(same) - phi(same + r) - phi(same + l)
            gain -= phi(o + r.sum() + s) - phi(np.maximum(o, 0)) + phi(p + l.sum() + s) - phi(np.maximum(p, 0))
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if best != a and gain[best] > gain[a] + 1e-6:
                of.append((int(i), best))
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in of], pa.int32()), pa.array([x for _, x in of], pa.int32())], ["item", "cls"])


def cluster(pairs: DataFrame, items: Items, sizes: np.ndarray, set_: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all items by exchange, and how often class follows class.

    Each sweep is a Spark job over the items: those whose turn it is take the class that
    raises the likelihood of class transitions most. Items that move at once may hinder
    each other; a sweep that lowers the likelihood is undone, and from then on fewer
    move at a time. The driver holds the classes of a fixed number of items and a
    class-by-class matrix."""
    c = set_.classes
    classes = np.zeros(items.count, np.int64)
    order = np.argsort(-sizes[:-1], kind="stable")
    classes[order] = 1 + np.arange(items.count - 1) % (c - 1)
    side = lambda me, other: F.struct(F.col(other).alias("o"), F.col("n"))
    # An item's lists hold an entry for each other item at most.
    right = pairs.groupBy(F.col("a").alias("item")).agg(F.collect_list(side("a", "b")).alias("r"))
    left = pairs.groupBy(F.col("b").alias("item")).agg(F.collect_list(side("b", "a")).alias("l"))
    empty = F.from_json(F.lit("[]"), "array<struct<o:int,n:bigint>>")
    about = reliable_checkpoint(
        right.join(left, "item", "full").select(
            "item", *(F.coalesce(x, empty)[y].alias(z) for x, y, z in (("r", "o", "right"), ("r", "n", "right_n"), ("l", "o", "left"), ("l", "n", "left_n")))
        ).repartition(24, "item"),
        "items",
    )

    def matrix() -> np.ndarray:
        held = classes.copy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _transitions(batches, held, c)

        m = np.zeros((c, c))
        for r in about.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
            m[r["a"], r["b"]] = r["n"]
        return m

    m, turns = matrix(), 4
    for sweep in range(set_.sweeps):
        held, turn = (classes.copy(), m), sweep % turns

        def run(batches: Iterator[pa.RecordBatch], held=held, turn=turn, turns=turns) -> Iterator[pa.RecordBatch]:
            return _moves(batches, *held, turn, turns)

        for r in about.mapInArrow(run, "item int, cls int").collect():
            classes[r["item"]] = r["cls"]
        m = matrix()
        if likelihood(m) < likelihood(held[1]):
            classes, m = held
            turns *= 2
    return classes, m


def _score(batches, items: Items, classes, gains, hot: np.ndarray, hot_log: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each text (word NULL), and one for each of its words that is not hot."""
    names = ["uid", "doc_id", "held_out", "word", "k", "known", "base", "gain"]
    for batch in rarely(batches):
        for s in T.slices(batch["text"]):
            h, shape, ends = _tokens(s, items.shapes)
            rows = np.repeat(np.arange(len(s)), np.diff(ends))
            i = items.of(h, shape)
            gain = gains[classes[_before(i, ends, items.count - 1)], classes[i]]
            if len(hot):
                at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                known = hot[at] == h
                base = np.where(known, hot_log[at], 0.0)
            else:
                known, base = np.zeros(len(h), bool), np.zeros(len(h))
            add = lambda x: np.bincount(rows, x, len(s))
            uid, own = batch["uid"].slice(s.first, len(s)), slice(s.first, s.first + len(s))
            k = len(s)
            yield pa.RecordBatch.from_arrays(
                [uid, batch["doc_id"][own], batch["held_out"][own], pa.nulls(k, pa.int64()), longs(np.diff(ends)), longs(add(known)), pa.array(add(base)), pa.array(add(gain * known))],
                names,
            )
            r, g, word = rows[~known], gain[~known], h[~known]
            order = np.lexsort((word, r))
            r, g, word = r[order], g[order], word[order]
            first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (word[1:] != word[:-1])])) if len(r) else np.zeros(0, np.int64)
            k = len(first)
            yield pa.RecordBatch.from_arrays(
                [uid.take(pa.array(r[first])), pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), longs(word[first]), longs(np.diff(np.append(first, len(r)))), pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.array(np.add.reduceat(g, first) if k else g)],
                names,
            )


def class_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Scores of whole texts by a class model learned from the rows not ``held_out``.

    Returns a row for each row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigrams), score (the model's log10 probability), perplexity (per
    token, of the score).

    * NULL and empty texts have the end as their only token.
    * Rows with a NULL id are scored; repeated rows count as often as they stand.
    * With nothing to learn from, every token is unknown and both scores are 0.
    * Words are told apart by 64-bit hashes."""
    c = settings
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    learned = docs.where(~F.col("held_out")).select("text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_words(batches, c.shapes)

    vocabulary = reliable_checkpoint(
        learned.mapInArrow(count_words, "word long, n long, shape int").groupBy("word").agg(F.sum("n").alias("n"), F.min("shape").alias("shape")),
        "vocabulary",
    )
    step = F.floor(F.log2("n") * STEPS_AN_OCTAVE)
    steps = sorted(vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect(), key=lambda r: -r["step"])
    total, distinct = sum(r["n"] for r in steps), sum(r["v"] for r in steps)
    held, least = 0, 64 * STEPS_AN_OCTAVE
    for r in steps:
        if (held := held + r["v"]) > c.hot:
            break
        least = r["step"]
    hot = vocabulary.where(step >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    end = int(np.array([END]).view(np.int64)[0])
    single = hot[hot.word != end].word.to_numpy().view(np.uint64)[: c.single]
    items = Items(single, c.shapes)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_pairs(batches, items)

    pairs = reliable_checkpoint(learned.mapInArrow(count_pairs, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    # How many words and tokens each item stands for.
    kinds, sizes = np.zeros(items.count), np.zeros(items.count)
    for r in pairs.groupBy("b").agg(F.sum("n").alias("n")).collect():
        sizes[r["b"]] = r["n"]
    for r in vocabulary.groupBy("shape").agg(F.count("*").alias("v")).collect():
        kinds[len(single) + r["shape"]] = r["v"]
    shapes = hot.set_index("word")["shape"]
    for i, word in enumerate(single.view(np.int64)):
        kinds[i] = 1
        kinds[len(single) + shapes[word]] -= 1
    if distinct:
        kinds[-1] = 1
        kinds[len(single)] -= 1   # the end was counted with shape 0
    classes, m = cluster(pairs, items, sizes, c)
    room = total + SMOOTH * (distinct + 1)
    mass = np.bincount(classes, sizes + SMOOTH * kinds, c.classes) / room
    share = np.bincount(classes, sizes, c.classes) / max(total, 1)
    follows = (m + c.prior * share) / (m.sum(1, keepdims=True) + c.prior)
    unknown = SMOOTH / room
    gains = np.log10((1 - c.weight) + c.weight * (1 - unknown) * follows / np.maximum(mass, 1e-300)) if total else np.zeros((c.classes, c.classes))
    by_hash = hot.word.to_numpy().view(np.uint64)
    order = np.argsort(by_hash)
    words_, logs = by_hash[order], np.log10((hot.n.to_numpy()[order] + SMOOTH) / room)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score(batches, items, classes, gains, words_, logs)

    parts = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", "text").mapInArrow(
        score, "uid long, doc_id long, held_out boolean, word long, k long, known long, base double, gain double"
    )
    # A text's own row meets no word: its key is as good as random.
    cold = vocabulary.where(step < least).select("word", F.col("n").alias("c"))
    whole = F.col("held_out").isNotNull()
    p0 = F.log10((F.coalesce("c", F.lit(0)) + SMOOTH) / F.lit(room))
    joined = parts.withColumn("word", F.coalesce("word", F.xxhash64("uid"))).join(cold, "word", "left").select(
        "uid", "doc_id", "held_out",
        F.when(whole, F.col("k")).alias("n_tokens"),
        F.when(whole, F.col("known")).otherwise(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("n_known"),
        F.when(whole, F.col("base")).otherwise(F.col("k") * p0).alias("base"),
        F.when(whole | (F.col("c") > 0), F.col("gain")).otherwise(0.0).alias("gain"),
    )
    base = F.col("base_score")
    return (
        joined.groupBy("uid").agg(
            F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"), F.sum("gain").alias("gain"),
        )
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), base, (base + F.col("gain")).alias("score"),
            F.pow(F.lit(10.0), -(base + F.col("gain")) / F.col("n_tokens")).alias("perplexity"),
        )
    )


@query("op4_class_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_scores(table(spark, sf_dir, "documents"), crc_remainder("doc_id", 10) == 0)
