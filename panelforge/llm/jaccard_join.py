"""N-gram Jaccard join: links between texts by signatures of one or two shingles.

Shingles are ordered by how common they are, the rarest first. Two sets that reach
the wanted similarity share, among the first ``|x| - need + k`` shingles of that
order, at least k, here about a twelfth of the set. This is used twice:

1. to leave out texts that have no partner:
   those that share too few of these shingles with any different text;
2. to index the rest: a shingle of few texts alone, shingles of many texts in
   combinations of two, dealt to so many groups that two shared ones meet in one; so a
   text has about two combinations for each such shingle, however long it is.

Found pairs are verified on the whole sets. No group of texts is expanded into all
its pairs: each text is compared with one that shares most signatures with it, and what
then hangs together needs no further comparison. Texts of signatures that are still
open are dealt in blocks of a fixed size to tasks, which compare two blocks at a time
and return no more links than connect what is similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import words as T
from panelforge.llm.common import components, free_name, in_bits, key_bits, long_lists, longs, query, rarely, table
from panelforge.session import reliable_checkpoint

RANK_BITS = 20         # how common shingles are is counted in 2**20 cells
CELLS_A_ROW = 4096
BATCH_ROWS = 1024      # texts or sets that go to a function at a time
CHUNK = 1_000_000      # shingles that a task holds before it sends them
FIRST_NAMES = ["bucket", "hashes", "nodes", "repeated", "share", "counted", "counts"]
SHARE = 500_000        # sets whose counts one task adds up, about
BUCKET = 500_000       # shingles that a bucket of the first exchange holds, about
FREQUENT = 32          # a shingle of more texts is indexed in combinations of two
GOES_ON = 0.5          # rounds of hubs go on while at most so many of the open sets stay open
BLOCK = 4_000_000      # shingles of the sets that are compared at a time, with as many others


def may_miss(n, percent: int):
    """How many shingles of a set of n a partner may lack."""
    return n - (n * percent + 99) // 100


def extension(n):
    """k of step 1 for a set of n."""
    return 2 + n // 12


def _measure(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row for each text; at the end, the cells of the rarity table."""
    cells = np.zeros(1 << RANK_BITS, np.uint32)
    none = lambda n, kind: pa.nulls(n, kind)
    names = ["doc_id", "node", "n", "cell", "counts"]
    for batch in rarely(batches):
        for w in T.words(batch["text"]):
            h, ends = T.distinct_sets(w, width)
            n = np.diff(ends)
            cells += np.bincount((h >> T.U(64 - RANK_BITS)).astype(np.int64), minlength=1 << RANK_BITS).astype(np.uint32)
            ids = batch["doc_id"].slice(w.first, len(w))
            k = len(w)
            yield pa.RecordBatch.from_arrays(
                [ids, longs(set_keys(h, ends)), pa.array(n.astype(np.int32)), none(k, pa.int32()), none(k, pa.binary())], names
            )
    parts = cells.reshape(-1, CELLS_A_ROW)
    full = np.flatnonzero(parts.any(1))
    small = [p.astype(np.uint16) if p.max() < 65536 else p for p in parts[full]]
    k = len(full)
    yield pa.RecordBatch.from_arrays(
        [none(k, pa.int64()), none(k, pa.int64()), none(k, pa.int32()), pa.array(full.astype(np.int32)), pa.array([p.tobytes() for p in small], pa.binary())],
        names,
    )


def set_keys(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set."""
    total = np.zeros(len(h) + 1, T.U)
    np.cumsum(T.mix(h ^ T.U(0xA5A5A5A5A5A5A5A5)), out=total[1:])
    return T.mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(T.U))


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, cell = np.zeros(CELLS_A_ROW, np.int64), None
    for batch in batches:
        for c, x in zip(batch["cell"], batch["counts"]):
            cell, raw = c.as_py(), x.as_py()
            total += np.frombuffer(raw, np.uint16 if len(raw) == 2 * CELLS_A_ROW else np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["cell", "counts"])


def rarity(cells: DataFrame) -> bytes:
    """A byte for each cell: how much fuller than the mean it is, in half powers of
    two. 2**20 bytes, whatever the input."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add_cells(batches)

    count = np.zeros((1 << RANK_BITS) // CELLS_A_ROW * CELLS_A_ROW, np.int64).reshape(-1, CELLS_A_ROW)
    for r in cells.groupBy("cell").applyInArrow(add, "cell int, counts binary").collect():
        count[r["cell"]] = np.frombuffer(r["counts"], np.int64)
    flat = count.ravel().astype(float)
    mean = max(flat.mean(), 1.0)
    return np.clip(np.floor(2 * np.log2(np.maximum(flat, 1) / mean)), 0, 255).astype(np.uint8).tobytes()


def ordered_prefix(h, ends, ranks: np.ndarray, take: np.ndarray):
    """The first ``take`` shingles of each set by rank, then hash; row ends."""
    at = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((h, ranks[(h >> T.U(64 - RANK_BITS)).astype(np.int64)], at))
    place = np.arange(len(h)) - ends[:-1][at]
    keep = place < take[at]
    h, at = h[order][keep], at[keep]
    return h, at


def _first_shingles(batches, width: int, percent: int, ranks: bytes, buckets: int, shares: int) -> Iterator[pa.RecordBatch]:
    """Step 1, before the exchange. Shingles met in two texts here are settled here."""
    ranks = np.frombuffer(ranks, np.uint8)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in rarely(batches):
        for w in T.words(batch["text"]):
            h, ends = T.distinct_sets(w, width)
            n, nodes = np.diff(ends), set_keys(h, ends)
            h, at = ordered_prefix(h, ends, ranks, may_miss(n, percent) + extension(n))
            held.append((h, nodes[at]))
            size += len(h)
            if size >= CHUNK:
                yield from _send(held, buckets, shares)
                held, size = [], 0
    if held:
        yield from _send(held, buckets, shares)


def _distinct_pairs(h: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (shingle, set) once, ordered by shingle; and whether the shingle has one set."""
    order = np.lexsort((nodes, h))
    h, nodes = h[order], nodes[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (nodes[1:] != nodes[:-1])
    h, nodes = h[keep], nodes[keep]
    new = np.ones(len(h) + 1, bool)
    new[1:-1] = h[1:] != h[:-1]
    return h, nodes, new[:-1] & new[1:]


def _send(held, buckets: int, shares: int) -> Iterator[pa.RecordBatch]:
    h, nodes, alone = _distinct_pairs(*(np.concatenate(x) for x in zip(*held)))
    keys, counts = np.unique(nodes[~alone], return_counts=True)
    # Hashes are ordered, so each bucket is a run of them.
    edge = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)
    one, one_nodes, many = h[alone], nodes[alone], np.unique(h[~alone])
    a = np.append(np.searchsorted(one, edge), len(one))
    b = np.append(np.searchsorted(many, edge), len(many))
    rows = [(i, one[a[i] : a[i + 1]].tobytes(), one_nodes[a[i] : a[i + 1]].tobytes(), many[b[i] : b[i + 1]].tobytes()) for i in range(buckets)]
    cols = list(zip(*rows))
    packed = _by_share(keys, counts, shares)
    k, m = len(rows), len(packed)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:]), pa.nulls(k, pa.int32()), *(pa.nulls(k, pa.binary()) for _ in range(2))], FIRST_NAMES
    )
    if m:
        cols = list(zip(*packed))
        at = pa.array([x % buckets for x in cols[0]], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [at, *(pa.nulls(m, pa.binary()) for _ in range(3)), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], FIRST_NAMES
        )


def _by_share(keys: np.ndarray, counts: np.ndarray, shares: int) -> list[tuple[int, bytes, bytes]]:
    """Sets and their counts, packed for each share of the sets that occurs."""
    share = (keys % T.U(shares)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    share, keys, counts = share[order], keys[order], counts[order].astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) if len(share) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(share))
    return [(int(share[i]), keys[i:j].tobytes(), counts[i:j].tobytes()) for i, j in zip(first, ends)]


def _settle(batches: Iterator[pa.RecordBatch], shares: int) -> Iterator[pa.RecordBatch]:
    """Step 1, after the exchange: which shingles of a bucket two sets have, counted for
    each set and packed by share of the sets."""
    parts: list[list[np.ndarray]] = [[], [], []]
    names = ["share", "counted", "counts"]
    for batch in batches:
        said = batch.filter(batch["share"].is_valid())
        if said.num_rows:
            yield pa.RecordBatch.from_arrays([said[n] for n in names], names)
        sent = batch.filter(batch["hashes"].is_valid())
        for part, name in zip(parts, ("hashes", "nodes", "repeated")):
            part += [np.frombuffer(v.as_buffer(), np.uint64) for v in sent[name]]
    if not parts[0]:
        return
    one, nodes, many = (np.concatenate(part) for part in parts)
    h, nodes, alone = _distinct_pairs(one, nodes)
    shared = ~alone | np.isin(h, np.unique(many))
    packed = _by_share(*np.unique(nodes[shared], return_counts=True), shares)
    if packed:
        cols = list(zip(*packed))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names)


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a share's sets, added up."""
    nodes, counts = [], []
    for batch in batches:
        nodes += [np.frombuffer(v.as_buffer(), np.uint64) for v in batch["counted"]]
        counts += [np.frombuffer(v.as_buffer(), np.uint32) for v in batch["counts"]]
    keys, at = np.unique(np.concatenate(nodes), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts).astype(float), len(keys))
    yield pa.RecordBatch.from_arrays([longs(keys), pa.array(total.astype(np.int32))], ["node", "shared"])


def _sets(batches, width: int, percent: int, ranks: bytes, bits: bytes) -> Iterator[pa.RecordBatch]:
    """Whole sets, and the shingles to index, of the texts that are left."""
    ranks = np.frombuffer(ranks, np.uint8)
    for batch in rarely(batches):
        batch = batch.filter(pa.array(in_bits(bits, batch["at"].to_numpy())))
        for w in T.words(batch["text"]):
            h, ends = T.distinct_sets(w, width)
            n = np.diff(ends)
            first, at = ordered_prefix(h, ends, ranks, may_miss(n, percent) + extension(n))
            yield pa.RecordBatch.from_arrays(
                [longs(set_keys(h, ends)), pa.array(n.astype(np.int32)), long_lists(h, ends), long_lists(first, np.searchsorted(at, np.arange(len(n) + 1)))],
                ["node", "n", "members", "signs"],
            )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("members").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("members").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(F.lit(100) * common >= F.lit(percent) * (F.col("na") + F.col("nb") - common))
        .select("a", "b")
    )


def _roots(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the root of each node."""
    found = components(links)
    return rows.drop("root").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _unsettled(rows: DataFrame) -> DataFrame:
    """Rows of the signatures whose texts don't yet hang together."""
    open_ = rows.groupBy("sign").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("sign")
    return rows.join(open_, "sign", "left_semi")


def similar_size(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def set_links(sets: DataFrame, percent: int, ranks: bytes) -> DataFrame:
    """Enough links (a, b) between similar sets to connect all that can reach each
    other. ``sets``: node, n, members, signs."""
    rows = sets.where("n > 2").select("node", "n", F.col("node").alias("root"), F.explode("signs").alias("sign"))
    group = rows.groupBy("sign").agg(F.count("*").alias("df")).where("df > 1")
    rows = reliable_checkpoint(rows.join(group, "sign"), "signs")
    own = F.least(F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 2 + F.floor(F.col("n") / 12), F.col("n"))
    links, open_ = None, rows.select("node").distinct().count()
    while open_:
        # The set that shares most of its signs is nearest to the others of a sign: what
        # they were copied from shares more with each than they do with each other.
        known = rows.groupBy("node").agg(F.count("*").alias("k"))
        rows = rows.drop("k").join(known, "node")
        hub = rows.groupBy("sign").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("n").alias("hn"), F.col("root").alias("hr")), F.struct("k", "node")).alias("h"))
        # Each set meets the hub with which it shares most signs, if these are half of its own.
        best = (
            rows.join(hub.select("sign", "h.*"), "sign").where((F.col("root") != F.col("hr")) & similar_size("n", "hn", percent))
            .groupBy("node", "hub", "n").agg(F.count("*").alias("c")).where(F.col("c") * 2 >= own)
            .groupBy("node").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
            .select(F.col("node").alias("a"), F.col("hub").alias("b"))
        )
        found = reliable_checkpoint(verified(best, sets, percent), "pairs")
        links = found if links is None else links.unionByName(found)
        rows = reliable_checkpoint(_unsettled(_roots(rows.drop("k"), links)), "signs")
        before, open_ = open_, rows.select("node").distinct().count()
        if open_ > before * GOES_ON:
            break
    if links is None:
        return sets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    # Sizes of linked sets are at most a class apart: each set is indexed in its class and
    # the next, and only sets of a class are compared. Frequent signs count in combinations
    # of two. Linked sets share as many signs as the smaller one's k; dealt to k - 1 groups,
    # two of them meet in one.
    class_ = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    classed = rows.withColumn("class", F.explode(F.array(class_, class_ + 1)))
    groups = F.greatest(F.lit(1), F.floor(F.pow(F.lit(100.0 / percent), F.col("class") - 1) / 12) + 1)
    two = F.expr("flatten(transform(s, (x, i) -> transform(slice(s, i + 2, size(s)), y -> xxhash64(class, part, x, y))))")
    pairs = (
        classed.where(F.col("df") > FREQUENT).withColumn("part", F.pmod(F.col("sign"), groups))
        .groupBy("node", "root", "class", "part").agg(F.array_sort(F.collect_list("sign")).alias("s")).where(F.size("s") > 1)
        .select(F.explode(two).alias("sign"), "node", "root", "class")
    )
    index = classed.where(F.col("df") <= FREQUENT).select(F.xxhash64("class", "sign").alias("sign"), "node", "root", "class").unionByName(pairs)
    index = _unsettled(index).select("sign", "node", "class", F.xxhash64("class", "node").alias("place"))
    index = reliable_checkpoint(index, "index")
    low = index.groupBy("sign").agg(F.min("place").alias("low"))
    near = components(index.join(low, "sign").select(F.col("place").alias("a"), F.col("low").alias("b")))
    left = index.select("place", "node").distinct().join(near.select(F.col("node").alias("place"), F.col("root").alias("cluster")), "place").select("node", "cluster")
    sizes = left.join(sets.select("node", "n"), "node").groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        left.join(sizes, "cluster").withColumn("block", own).join(rows.select("node", "root").distinct(), "node").join(sets.select("node", "members"), "node")
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, percent, ranks)

    found = dealt.groupBy("cluster", "lo", "hi").applyInArrow(compare, "a long, b long")
    return links.unionByName(reliable_checkpoint(found, "compared", BATCH_ROWS))


class _Sets:
    """Some rows' sets, and the shingles that each is indexed by."""

    def __init__(self, percent: int, ranks: np.ndarray):
        self.percent, self.ranks, self.size = percent, ranks, 0
        self.parts: dict[str, list[np.ndarray]] = {k: [] for k in ("node", "root", "members", "n", "signs", "of")}

    def __len__(self) -> int:
        return self.size

    def add(self, batch: pa.RecordBatch) -> None:
        """A few rows more. They are ordered at once, so that what this takes stays small."""
        lists = batch["members"]
        members = lists.flatten().to_numpy().view(np.uint64).copy()
        n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        signs, of = ordered_prefix(members, np.append(0, np.cumsum(n)), self.ranks, may_miss(n, self.percent) + extension(n))
        own = {"node": batch["node"].to_numpy().copy(), "root": batch["root"].to_numpy().copy(), "members": members, "n": n, "signs": signs, "of": of + self.size}
        for k, v in own.items():
            self.parts[k].append(v)
        self.size += batch.num_rows

    def close(self) -> None:
        self.node, self.root, self.members, self.n, self.signs, self.of = (np.concatenate(self.parts.pop(k)) for k in list(self.parts))
        self.ends = np.append(0, np.cumsum(self.n))
        self.sign_ends = np.searchsorted(self.of, np.arange(len(self.n) + 1))
        self.beyond = self.n - np.diff(self.sign_ends)   # shingles that aren't signs


def _compare(batches: Iterator[pa.RecordBatch], percent: int, ranks: bytes) -> Iterator[pa.RecordBatch]:
    """Links between the rows of two blocks that share enough signs and don't hang
    together yet; enough of them to connect what is similar."""
    rank = np.frombuffer(ranks, np.uint8)
    x, y = _Sets(percent, rank), _Sets(percent, rank)
    for batch in rarely(batches):
        lo, hi = batch["lo"][0].as_py(), batch["hi"][0].as_py()
        low = batch["block"].to_numpy() == lo
        for part, rows in ((x, low), (y, ~low)):
            if rows.any():
                part.add(batch.filter(pa.array(rows)))
    if not len(x) or not len(y) and lo != hi:
        return
    x.close()
    if lo == hi:
        y = x
    else:
        y.close()
    tokens = np.unique(y.members)
    ids = np.searchsorted(tokens, y.members).astype(np.int32)
    order = np.argsort(y.signs, kind="stable")
    signs, owners = y.signs[order], y.of[order]
    if y is not x:
        del y.members, y.signs, y.of   # held as ids and in order
    del order
    mark = np.zeros(len(tokens), bool)
    up: dict[int, int] = {}

    def root(v: int) -> int:
        while v in up:
            v = up[v]
        return v

    links = []
    for i in range(len(x)):
        own = x.signs[x.sign_ends[i] : x.sign_ends[i + 1]]
        a, b = np.searchsorted(signs, own), np.searchsorted(signs, own, "right")
        at = np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())
        shared = np.bincount(owners[at], minlength=len(y))
        # Of the common shingles no more are lacking among the signs than either set has beyond.
        least = -(-percent * (y.n + x.n[i]) // (100 + percent)) - np.maximum(y.beyond, x.beyond[i])
        ok = (shared >= np.maximum(least, 1)) & (y.n * 100 >= x.n[i] * percent) & (x.n[i] * 100 >= y.n * percent) & (y.root != x.root[i])
        if x is y:
            ok[: i + 1] = False
        which = np.flatnonzero(ok)
        if not len(which):
            continue
        mine = x.members[x.ends[i] : x.ends[i + 1]]
        at = np.minimum(np.searchsorted(tokens, mine), len(tokens) - 1)
        at = at[tokens[at] == mine]
        mark[at] = True
        size = y.n[which]
        where = np.repeat(y.ends[which] - np.cumsum(size) + size, size) + np.arange(size.sum())
        common = np.add.reduceat(mark[ids[where]].astype(np.int64), np.cumsum(size) - size)
        mark[at] = False
        for j in which[100 * common >= percent * (x.n[i] + size - common)]:
            a, b = root(int(x.root[i])), root(int(y.root[j]))
            if a != b:
                up[max(a, b)] = min(a, b)
                links.append((int(x.node[i]), int(y.node[j])))
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """Sets of word shingles and the components of their similarity links.

    Words are runs without ASCII white space, A-Z in lower case; a set holds the
    distinct shingles of ``width`` words, or the whole sequence of a shorter text.
    Texts link when ``100 * common >= percent * union``. Returns one row for each row
    of ``docs``: doc_id, n_shingles long, component_id (smallest doc_id reachable), node
    and root (numbers of its set and of its component; NULL without words).

    * NULL or empty texts and texts of white space: n_shingles 0, linked with nothing.
    * Repeated rows and equal texts are linked, each has its row.
    * Rows with a NULL id take part; the smallest id of a component is that of the
      others (NULL if there is none).
    * Only the two columns are read; others may have any name."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _measure(batches, width)

    found = reliable_checkpoint(docs.mapInArrow(measure, "doc_id long, node long, n int, cell int, counts binary"), "sets", BATCH_ROWS)
    texts = found.where("cell is null").select("doc_id", "node", "n")
    ranks = rarity(found.where("cell is not null").select("cell", "counts"))
    sizes = texts.where("n > 0")
    wanted = F.sum((F.col("n") - F.floor((F.col("n") * percent + 99) / 100)) + F.floor(F.col("n") / 12) + 2)
    total, count = sizes.agg(wanted, F.count("*")).first()
    buckets, shares = max(8, int(total or 0) // BUCKET), max(8, count // SHARE)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _first_shingles(batches, width, percent, ranks, buckets, shares)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _settle(batches, shares)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add_counts(batches)

    shared = (
        docs.mapInArrow(first, "bucket int, hashes binary, nodes binary, repeated binary, share int, counted binary, counts binary")
        .groupBy("bucket").applyInArrow(settle, "share int, counted binary, counts binary")
        .groupBy("share").applyInArrow(add, "node long, shared int")
    )
    need = F.floor((F.col("n") * percent + 99) / 100)
    least = F.least(F.lit(2) + F.floor(need / 12), F.col("n") - need + F.lit(2) + F.floor(F.col("n") / 12), F.col("n"))
    left = (
        sizes.where("n > 2").groupBy("node").agg(F.min("n").alias("n"), F.coalesce(F.min("doc_id"), F.lit(-1)).alias("doc_id"))
        .join(shared, "node").where(F.col("shared") >= least).select("node", "doc_id")
    )
    left = reliable_checkpoint(left, "left", BATCH_ROWS)
    bits = key_bits(left, "doc_id")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sets(batches, width, percent, ranks, bits)

    at = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("long"))), F.lit(1 << 22))
    sets = (
        docs.select(at.alias("at"), "text").mapInArrow(sets_of, "node long, n int, members array<long>, signs array<long>")
        .join(left.select("node"), "node", "left_semi").dropDuplicates(["node"])
    )
    sets = reliable_checkpoint(sets, "sets", BATCH_ROWS)
    links = set_links(sets, percent, ranks)
    own = sizes.groupBy("node").agg(F.min("doc_id").alias("low"))
    nodes = _roots(own, links)
    low = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = nodes.join(low, "root").select("node", "root", "component_id")
    return (
        texts.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(ids, "node", "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "node", "root")
    )


def keep_first(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """``docs`` with one row of each component of ``found`` (made from the same rows by
    ``jaccard_components``): one with the smallest id, NULL only where there is no other.
    Of rows with equal ids and equal word sets any one stays. Texts without words stay.
    All columns stay. Only rows whose id is decided about are shuffled with their texts:
    others pass by a table of bits, which never misses one of the former."""
    sets = found.where("n_shingles > 0").groupBy("doc_id", "node", "root").agg(F.count("*").alias("rows"))
    least = F.min_by("node", F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first")
    sets = sets.join(sets.groupBy("root").agg(least, F.min("doc_id").alias("least")), "root").select(
        F.col("doc_id").alias("_id"), F.col("node").alias("_set"), "rows", ((F.col("node") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("least"))).alias("_first")
    )
    decided = reliable_checkpoint(sets.where(~F.col("_first") | (F.col("rows") > 1)).drop("rows"), "decided")
    bits = key_bits(decided, "_id")

    @F.arrow_udf("long")
    def set_of(at: pa.Array, text: pa.Array) -> pa.Array:
        sets, has = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        hit = np.flatnonzero(in_bits(bits, at.to_numpy()))
        for i in range(0, len(hit), 256):
            some = hit[i : i + 256]
            for w in T.words(text.take(pa.array(some))):
                h, ends = T.distinct_sets(w, width)
                rows = some[w.first : w.first + len(w)]
                sets[rows], has[rows] = set_keys(h, ends).view(np.int64), np.diff(ends) > 0
        return pa.array(sets, mask=~has)

    # One function does both, as each needs a process of its own in every task; and it isn't
    # called once for the filter and once for the column.
    once = set_of.asNondeterministic()
    own = free_name(docs, "_own_set")
    marked = docs.withColumn(own, once(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << 22)), F.col(text_col)))
    some = marked.where(F.col(own).isNotNull())
    same = some[id_col].cast("long").eqNullSafe(decided["_id"]) & (some[own] == decided["_set"])
    kept = some.join(decided, same, "left").where(F.coalesce("_first", F.lit(True)))
    one = kept.dropDuplicates([id_col, own]).select(*(some[c] for c in docs.columns))
    return marked.where(F.col(own).isNull()).select(*docs.columns).unionAll(one)


@query("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
