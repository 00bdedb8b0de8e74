"""Byte-level BPE by the tokenizers library over Arrow batches.

A rank file lists the tokens' bytes in the order in which they were learned. The model
gets a merge for each way in which two earlier tokens make a later one, in that order,
so that it merges what the ranks say. Texts are cut by the pattern of the vocabulary and
each match is encoded by itself.

Most of a text repeats. Its bytes are first cut before every space that follows a mark or
letter, where no match goes on; the pieces of a batch are numbered by Arrow's dictionary
encoding, each different piece is encoded once, or looked up if it was met before, and the
ids of all are put together by index.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import query, rarely, table
from panelforge.llm.words import slices

KNOWN_BYTES = 32 << 20   # of pieces and their ids that a worker remembers, twice at most
BATCH_ROWS = 256         # texts that go to a worker at a time, where it shares its machine's memory with much else
LONGEST = 64             # bytes of a piece that is remembered


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable
    in Latin-1, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


def ranks_of(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


def build_model(ranks: dict[bytes, int]):
    from tokenizers import Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    said = lambda x: "".join(chars[b] for b in x)
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
        cuts = [(a, b) for a, b in cuts if ranks.get(a, rank) < rank and ranks.get(b, rank) < rank]
        merges += [(said(a), said(b)) for a, b in sorted(cuts, key=lambda x: (ranks[x[0]], ranks[x[1]]))]
    model = Tokenizer(models.BPE(vocab={said(k): v for k, v in ranks.items()}, merges=merges, ignore_merges=True))
    model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return model


class Memory:
    """What was computed for keys met before, bounded in bytes. When it is full, only what
    was asked for since the last time stays. Long keys hardly repeat and aren't kept."""

    EACH = 200   # bytes of an entry beside its key and value, about

    def __init__(self, most: int = KNOWN_BYTES):
        self.most, self.size = most, 0
        self.now: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, key: bytes, compute) -> bytes:
        value = self.now.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = compute(key)
            if len(key) <= LONGEST:
                self.size += len(key) + len(value) + self.EACH
                if self.size > self.most:
                    self.old, self.now, self.size = self.now, {}, 0
                self.now[key] = value
        return value


def cut_before_spaces(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces of UTF-8 texts start: at each text (they lie end to end, ``at`` are
    their ends), and at each space after a character that isn't white space."""
    cut = np.zeros(len(raw), bool)
    before = raw[:-1]
    cut[1:] = (raw[1:] == 32) & (before > 32)
    # The white space beyond ASCII: U+0085, A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000.
    wide = np.flatnonzero(cut[1:] & (before >= 128)) + 1
    if len(wide):
        one, two, three = raw[wide - 1], raw[wide - 2], raw[np.maximum(wide - 3, 0)]
        general = (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)) | (two == 0x81) & (one == 0x9F)
        white = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE2) & general
        white |= (two == 0x9A) & (three == 0xE1) & (one == 0x80) | (two == 0x80) & (three == 0xE3) & (one == 0x80)
        cut[wide[white]] = False
    cut[at[:-1][at[:-1] < len(raw)]] = True
    return np.flatnonzero(cut)


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions begin[0], begin[0] + 1, ..., size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes and decodes texts; made once in each Python worker."""

    _made: dict[str, Encoder] = {}

    def __init__(self, lines: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = ranks_of(lines)
        self.chars = byte_characters()
        self.model = build_model(ranks)
        self.cut = regex.compile(pattern)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            table[i] = token
        self.sizes = np.array([len(x) for x in table], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.known = Memory()

    @classmethod
    def of(cls, lines: bytes, pattern: str) -> Encoder:
        key = hashlib.sha256(lines + pattern.encode()).hexdigest()
        if key not in cls._made:
            cls._made[key] = cls(lines, pattern)
        return cls._made[key]

    def _match(self, match: bytes) -> bytes:
        said = "".join(map(self.chars.__getitem__, match))
        ids = [t.id for t in self.model.model.tokenize(said)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8")
        found = self.cut.findall(text)
        if found == [text]:
            return self._match(piece)
        # A match that is one by itself, too, is remembered like any piece, and only once.
        return b"".join([self.known.of(m.encode(), self._match) if self.cut.findall(m) == [m] else self._match(m.encode()) for m in found])

    def encode(self, column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of rows of a text column: ids of all, and where each row's end."""
        for s in slices(column):
            starts = cut_before_spaces(s.raw, s.at) if len(s.raw) else np.zeros(0, np.int64)
            ends = np.append(starts, len(s.raw)).astype(np.int64)
            pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(s.raw))])
            coded = pieces.dictionary_encode()
            made = [self.known.of(x, self._piece) for x in coded.dictionary.to_pylist()]
            size = np.array([len(x) // 4 for x in made], np.int64)
            every, at = np.frombuffer(b"".join(made), "<u4"), coded.indices.to_numpy()
            ids = every[spread((np.cumsum(size) - size)[at], size[at])]
            done = np.append(0, np.cumsum(size[at]))
            yield ids, done[np.searchsorted(starts, s.at)]

    def spans(self, text: str) -> tuple[list[int], list[int]]:
        """The characters of the text that each id belongs to. Ids that hold parts of
        one character all have that character's span."""
        start, stop = [], []
        for m in self.cut.finditer(text):
            for a, b in self.model.encode(m.group(), add_special_tokens=False).offsets:
                start.append(m.start() + a)
                stop.append(m.start() + b)
        return start, stop

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids. A character that several ids share is whole again once
        all of its bytes stand together."""
        return self.bytes[spread(self.begin[ids], self.sizes[ids])].tobytes()


def tokenizer_file(path: str) -> bytes:
    """A rank file, read on the driver; vocabularies are of a fixed size."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """``doc_id``, ``ids array<int>`` and, on demand, ``starts`` and ``stops``: the
    characters of each id. No special tokens.

    NULL and empty texts have no ids. Every row gives a row; other columns aren't read.
    Characters outside the pattern's matches have no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder.of(ranks, pattern)
        for batch in rarely(batches, 64):
            runs = [(ids, ends) for ids, ends in coder.encode(batch["text"])]
            lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))) for ids, ends in runs]
            cols, names = [batch["doc_id"], pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))], ["doc_id", "ids"]
            if offsets:
                both = [coder.spans(x or "") for x in batch["text"].to_pylist()]
                cols += [pa.array([x[i] for x in both], pa.list_(pa.int32())) for i in (0, 1)]
                names += ["starts", "stops"]
            yield pa.RecordBatch.from_arrays(cols, names)

    more = ", starts array<int>, stops array<int>" if offsets else ""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>" + more)


def decode(rows: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``bytes binary``, ``text string``: the ids' bytes, and as UTF-8, where
    bytes that make no character (an id list may be cut anywhere) become U+FFFD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder.of(ranks, pattern)
        for batch in rarely(batches, 64):
            raw = [coder.decode(np.array(x or [], np.int64)) for x in batch["ids"].to_pylist()]
            texts = pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raw, pa.binary()), texts], ["doc_id", "bytes", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, bytes binary, text string")


def digests(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The round trip of each text in one pass: doc_id, n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (the decoded bytes).

    NULL counts as empty. Every row gives a row; other columns aren't read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder.of(ranks, pattern)
        for batch in batches:
            first = 0
            for ids, ends in coder.encode(batch["text"]):
                rows = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(rows)), pa.array(np.diff(ends), pa.int64()),
                        pa.array([hashlib.sha256(np.ascontiguousarray(x)).hexdigest() for x in rows], pa.string()),
                        pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in rows], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                first += len(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """Ranks and pattern of an installed public vocabulary."""
    import public_tokenizers

    return tokenizer_file(public_tokenizers.path(name)), public_tokenizers.PATTERN


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), *public_vocabulary())
