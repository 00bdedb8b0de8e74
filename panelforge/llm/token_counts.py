"""Token counts that follow edits without encoding whole texts again.

A text is cut in segments of some hundred characters. Cuts lie where a mark or letter
is followed by a space: the pattern always starts a new pre-token there, whatever
stands further away, so the tokens of a text are those of its segments. A tree over the
segments holds the characters and tokens below each node. An edit finds its segments
by descending the tree, encodes only these again, and adds up the sums on their paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.byte_bpe import public_vocabulary, ranks_of
from panelforge.llm.common import query, rarely, table

SEGMENT = 512   # characters of a segment, at least
_counters: dict = {}


def counter(ranks: bytes, pattern: str):
    """Number of tokens of a string; made once in each Python worker."""
    import tiktoken

    key = (hash(ranks), pattern)
    if key not in _counters:
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks_of(ranks), special_tokens={})
        _counters[key] = lambda s: len(encoding.encode_ordinary(s))
    return _counters[key]


def cut(text: str, size: int = SEGMENT) -> list[str]:
    """Segments of ``size`` characters and what belongs to the last word."""
    out, start = [], 0
    while True:
        stop = text.find(" ", start + size)
        while stop > 0 and text[stop - 1].isspace():
            stop = text.find(" ", stop + 1)
        if stop < 0:
            break
        out.append(text[start:stop])
        start = stop
    if start < len(text):
        out.append(text[start:])
    return out


class Tree:
    """Sums of characters and tokens over a text's segments: a binary tree in an array,
    node i above nodes 2i and 2i + 1."""

    def __init__(self, chars, tokens):
        self.set(np.array(chars, np.int64), np.array(tokens, np.int64))

    def set(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = len(chars)
        self.width = 1 << max(0, (self.leaves - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + self.leaves, 0] = chars
        self.sums[self.width : self.width + self.leaves, 1] = tokens
        low = self.width
        while low > 1:
            self.sums[low // 2 : low] = self.sums[low : 2 * low].reshape(-1, 2, 2).sum(1)
            low //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0]) if self.leaves else 0

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1]) if self.leaves else 0

    def find(self, at: int) -> tuple[int, int]:
        """The segment that holds character ``at``, and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at - start >= self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """New segments for those from ``first`` to ``last``. Where their number stays,
        only the nodes above them change."""
        if len(chars) == last - first + 1:
            for i, (c, t) in enumerate(zip(chars, tokens)):
                node = self.width + first + i
                change = np.array([c, t]) - self.sums[node]
                while node:
                    self.sums[node] += change
                    node //= 2
            return
        leaf = self.sums[self.width : self.width + self.leaves]
        both = np.concatenate([leaf[:first], np.array([chars, tokens], np.int64).T.reshape(-1, 2), leaf[last + 1 :]])
        self.set(both[:, 0], both[:, 1])


def build(text: str, count, size: int = SEGMENT) -> Tree:
    parts = cut(text, size)
    return Tree([len(p) for p in parts], [count(p) for p in parts])


def edit(text: str, tree: Tree, at: int, removed: int, added: str, count, size: int = SEGMENT) -> tuple[str, int]:
    """The text with ``removed`` characters from ``at`` on replaced by ``added``, and
    how many characters were encoded again; ``tree`` follows. Places beyond the text
    mean its end.

    Both ends of what is encoded are cuts whose two characters the edit leaves alone."""
    at = min(max(at, 0), len(text))
    stop = min(at + max(removed, 0), len(text))
    if tree.leaves:
        first, start = tree.find(max(at - 1, 0))
        last, begin = tree.find(min(stop + 1, len(text) - 1))
        if begin == stop + 1 and last > first:   # a cut right there: its characters stay
            last -= 1
            end = begin
        else:
            end = begin + int(tree.sums[tree.width + last, 0])
    else:
        first, last, start, end = 0, -1, 0, 0
    region = text[start:at] + added + text[stop:end]
    parts = cut(region, size)
    tree.replace(first, last, [len(p) for p in parts], [count(p) for p in parts])
    return text[:at] + added + text[stop:], len(region)


def recount(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", texts: bool = False, size: int = SEGMENT) -> DataFrame:
    """Applies each row's ``edits``, an array of structs (at, removed, added) in the
    order of application, and keeps count: doc_id, n_edits, tokens_before, tokens_after,
    chars_after, chars_encoded (by the edits, not the first count), segments; on demand
    ``text``, and the tree's leaves as ``leaf_chars`` and ``leaf_tokens``.

    * NULL and empty texts have no tokens and can be edited. NULL edits, or NULL in an
      edit's parts, count as none, 0 and the empty string.
    * Repeated rows are counted each by itself. Other columns aren't read.
    * A text's edits depend on each other, so one task applies them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks, pattern)
        for batch in rarely(batches, 64):
            rows = []
            for i, text, edits in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["edits"].to_pylist()):
                text = text or ""
                tree = build(text, count, size)
                before, again = tree.tokens, 0
                for e in edits or []:
                    text, n = edit(text, tree, e["at"] or 0, e["removed"] or 0, e["added"] or "", count, size)
                    again += n
                leaf = tree.sums[tree.width : tree.width + tree.leaves]
                rows.append((i, len(edits or []), before, tree.tokens, tree.chars, again, tree.leaves, text, leaf[:, 0], leaf[:, 1]))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            keep = len(kinds) if texts else 7
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(keep)], NAMES[:keep])

    kind = "doc_id long, n_edits int, tokens_before long, tokens_after long, chars_after long, chars_encoded long, segments int"
    kind += ", text string, leaf_chars array<long>, leaf_tokens array<long>" if texts else ""
    edits = F.transform(F.col(edits_col), lambda e: F.struct(e["at"].cast("long").alias("at"), e["removed"].cast("long").alias("removed"), e["added"].cast("string").alias("added")))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), edits.alias("edits")).mapInArrow(run, kind)


NAMES = ["doc_id", "n_edits", "tokens_before", "tokens_after", "chars_after", "chars_encoded", "segments", "text", "leaf_chars", "leaf_tokens"]


def derived_edits(id_col: str, text_col: str):
    """One to three edits that follow from a row's id: at a place in the text, up to 40
    characters go and up to 60 from another place of it come."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.length(text) + 1
    n = F.pmod(F.xxhash64(F.lit(0), F.col(id_col)), F.lit(3)) + 1
    draw = lambda i, k, m: F.pmod(F.xxhash64(F.lit(k), i, F.col(id_col)), m)
    one = lambda i: F.struct(
        draw(i, 1, size).alias("at"), draw(i, 2, F.lit(41)).alias("removed"),
        F.substring(text, draw(i, 3, size).cast("int") + 1, draw(i, 4, F.lit(61)).cast("int")).alias("added"),
    )
    return F.transform(F.sequence(F.lit(1).cast("long"), n), one)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return recount(docs.withColumn("edits", derived_edits("doc_id", "text")), *public_vocabulary())
