"""Benchmark decontamination by spaced seeds.

A mask lays over a window of words and leaves some of them out; the hash of the others
stays the same when a word that is left out was replaced. Windows of test items and of
texts meet by the hashes of a few fixed masks. Around every hit the two word sequences
are laid side by side, and the stretch that agrees best is measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import words as T
from panelforge.llm.common import bits_of, in_bits, long_lists, longs, query, rarely, table
from panelforge.session import reliable_checkpoint

# The words of a window that count.
MASKS = ("110101100111", "111001101011", "101111001101", "110110011101")
SPAN = 12         # words of a window
CONTEXT = 32      # words that are kept on both sides of a hit
LEAST = 12        # agreeing words that make an overlap (all, of a shorter item)
SHORTEST = 5      # words of an item that is searched
MISMATCH = 3      # agreeing words that outweigh a replaced one: three of four agree
BITS = 22


def _windows(h: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash of each window of consecutive words."""
    n = max(0, len(h) - len(mask) + 1)
    out = np.full(n, T.U(int(mask, 2) * 2 + 1))
    for k, used in enumerate(mask):
        if used == "1":
            out = out * T.U(T._P) + h[k : k + n]
    return T.mix(out)


def _masks(lengths: list[int]) -> list[str]:
    """The masks; for items shorter than a window, all of their words."""
    return [*MASKS, *("1" * n for n in sorted(lengths))]


def _seeds(batches) -> Iterator[pa.RecordBatch]:
    """The windows of test items, and each item's words (a row with position -1)."""
    for batch in rarely(batches):
        ids = batch["item_id"].to_numpy(zero_copy_only=False)
        for w in T.words(batch["text"], "letters"):
            for i in range(len(w)):
                h = w.hashes[w.ends[i] : w.ends[i + 1]]
                if len(h) < SHORTEST:
                    continue
                found = [_windows(h, m) for m in (MASKS if len(h) >= SPAN else ("1" * len(h),))]
                seeds = np.concatenate(found)
                at = np.concatenate([np.arange(len(f)) for f in found])
                k = len(seeds)
                item = pa.array([int(ids[w.first + i])] * (k + 1), pa.int64())
                empty = [None] * k
                yield pa.RecordBatch.from_arrays(
                    [
                        item, pa.concat_arrays([longs(seeds), pa.array([0], pa.int64())]), pa.array(np.append(at, -1).astype(np.int32)),
                        pa.array([*empty, h.view(np.int64).tolist()], pa.list_(pa.int64())),
                    ],
                    ["item_id", "seed", "at", "words"],
                )


def _regions(batches, masks: list[str], bits: bytes) -> Iterator[pa.RecordBatch]:
    """Stretches of texts around windows whose hash may be a test item's."""
    for batch in rarely(batches):
        for w in T.words(batch["text"], "letters"):
            rows = w.rows()
            seeds, places = [], []
            for mask in masks:
                h = _windows(w.hashes, mask)
                low = np.flatnonzero(in_bits(bits, (h & T.U((1 << BITS) - 1)).astype(np.int64)))
                at = low[in_bits(bits, (h[low] >> T.U(64 - BITS)).astype(np.int64))]
                at = at[rows[at] == rows[at + len(mask) - 1]]
                seeds.append(h[at])
                places.append(at)
            seeds, places = np.concatenate(seeds), np.concatenate(places)
            if not len(seeds):
                continue
            order = np.argsort(places, kind="stable")
            seeds, places = seeds[order], places[order]
            row = rows[places]
            new = np.ones(len(places), bool)
            new[1:] = (np.diff(places) > CONTEXT) | (row[1:] != row[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(places)) - 1
            r = row[head]
            start = np.maximum(places[head] - CONTEXT, w.ends[r])
            stop = np.minimum(places[tail] + SPAN + CONTEXT, w.ends[r + 1])
            region = np.cumsum(new) - 1
            size = stop - start
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            take = pa.array(w.first + r)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["uid"].take(take), batch["doc_id"].take(take), pa.array((start - w.ends[r]).astype(np.int32)),
                    long_lists(w.hashes[at], np.append(0, np.cumsum(size))),
                    long_lists(seeds, np.append(head, len(seeds))),
                    pa.ListArray.from_arrays(pa.array(np.append(head, len(seeds)).astype(np.int32)), pa.array((places - start[region]).astype(np.int32))),
                ],
                ["uid", "doc_id", "start", "words", "seeds", "places"],
            )


def best_overlap(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """The stretch where ``text[i + shift]`` and ``item[i]`` agree best: its start in the
    text, its length, and how many words agree. Replaced words are bridged, each by
    ``MISMATCH`` agreeing ones."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    if high <= low:
        return 0, 0, 0
    same = text[low + shift : high + shift] == item[low:high]
    total = np.append(0, np.cumsum(np.where(same, 1, -MISMATCH)))
    below = np.minimum.accumulate(total)
    end = int(np.argmax(total - below))
    begin = int(np.argmin(total[: end + 1]))
    return low + shift + begin, end - begin, int(same[begin:end].sum())


def _measure(batches) -> Iterator[pa.RecordBatch]:
    for batch in rarely(batches):
        text, item = batch["words"], batch["item_words"]
        found = [
            best_overlap(a.values.to_numpy(), b.values.to_numpy(), s)
            for a, b, s in zip(text, item, batch["shift"].to_pylist())
        ]
        at, size, same = (np.array(x, np.int32) for x in zip(*found)) if found else (np.zeros(0, np.int32),) * 3
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["item_id"], pa.array(at + batch["start"].to_numpy()), pa.array(size), pa.array(same), pa.array(np.array([len(b.values) for b in item], np.int32))],
            ["doc_id", "item_id", "first_word", "aligned", "matched", "item_words"],
        )


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Texts that hold passages of test items: one row for each pair with its best
    overlap: doc_id, item_id, first_word, aligned, matched, item_words (all in words).

    Words are runs of letters and digits in lower case, so marks don't count. An overlap
    has ``LEAST`` agreeing words or all of a shorter item, three of four aligned words
    agree, and some window of ``SPAN`` words agrees in all places that one of the masks
    counts. Items under ``SHORTEST`` words are not searched.

    * NULL and empty texts and items match nothing; empty tables give no rows.
    * Repeated rows and rows of one id give one row for each item.
    * Items with equal texts are all returned. NULL item ids are left out."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null")
    found = reliable_checkpoint(items.mapInArrow(_seeds, "item_id long, seed long, at int, words array<long>"), "seeds")
    seeds, whole = found.where("at >= 0").select("item_id", "seed", "at"), found.where("at < 0").select("item_id", F.col("words").alias("item_words"))
    short = [r[0] for r in whole.where(F.size("item_words") < SPAN).select(F.size("item_words")).distinct().collect()]
    masks = _masks(short)
    # Each hash sets two bits, so a window of a text passes by chance once in thousands.
    low, high = F.col("seed").bitwiseAND(F.lit((1 << BITS) - 1)), F.shiftrightunsigned("seed", 64 - BITS)
    bits = bits_of(seeds.select(F.explode(F.array(low, high)).alias("at")), BITS)

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _regions(batches, masks, bits)

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    near = reliable_checkpoint(rows.mapInArrow(regions, "uid long, doc_id long, start int, words array<long>, seeds array<long>, places array<int>"), "regions")
    hits = near.select("uid", "start", F.explode(F.arrays_zip("seeds", "places")).alias("h")).select("uid", "start", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    pairs = hits.join(seeds, "seed").select("uid", "start", "item_id", (F.col("place") - F.col("at")).alias("shift")).distinct()
    sides = pairs.join(near.select("uid", "start", "doc_id", "words"), ["uid", "start"]).join(whole, "item_id")
    measured = sides.select("doc_id", "item_id", "start", "shift", "words", "item_words").mapInArrow(
        _measure, "doc_id long, item_id long, first_word int, aligned int, matched int, item_words int"
    )
    best = F.max(F.struct("matched", (-F.col("aligned")).alias("less"), (-F.col("first_word")).alias("early"), "item_words")).alias("b")
    return (
        measured.where(F.col("matched") >= F.least(F.lit(LEAST), F.col("item_words")))
        .groupBy("doc_id", "item_id").agg(best)
        .select("doc_id", "item_id", (-F.col("b.early")).alias("first_word"), (-F.col("b.less")).alias("aligned"), "b.matched", "b.item_words")
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id holds a test passage; all columns stay."""
    bad = overlaps(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["_leaked"]), "left_anti")


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
