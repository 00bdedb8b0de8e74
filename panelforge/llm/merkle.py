"""A Merkle manifest of a table, and octopus multiproofs of its rows.

Rows are leaves of one tree for each value of a column; the trees' roots are the leaves of
a top tree. Eight nodes side by side make one above. A tree is folded three levels at a
time, in blocks of 512 nodes, so that a large tree is no more than many blocks.

To prove many leaves at once, each partition of leaves (a block of one tree) works out the
union of the nodes that it lacks: siblings that are neither among its leaves nor above
them. They are fetched by one join; what its leaves share above them is derived once in
the partition, and every leaf's own proof is read off there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import numbered, query, table
from panelforge.session import reliable_checkpoint

FAN = 8
STEPS = 3            # levels that a block is folded at a time
BLOCK = FAN**STEPS   # leaves of a partition, nodes of a block
TOP = 0              # the number of the top tree; others count from 1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def said(column: str | Column) -> Column:
    """A value with its length in bytes before it, ``-`` for NULL: no two rows say the same."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[str | Column]) -> Column:
    """The 32 bytes of a row's sha256."""
    return F.unhex(F.sha2(F.concat(*(said(c) for c in columns)).cast("binary"), 256))


def node_hash(digests: bytes) -> bytes:
    """The sha256 of digests written out in hex, in hex itself."""
    return hashlib.sha256(digests).hexdigest().encode()


def up(size: int) -> int:
    return -(-size // FAN)


def missing(places: np.ndarray, size: int) -> list[np.ndarray]:
    """For each level of a tree of ``size`` leaves the places of nodes that are needed
    beside those that the leaves at ``places`` (ascending) give by themselves."""
    out = []
    while size > 1:
        runs = np.unique(places // FAN)
        every = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        out.append(np.setdiff1d(every[every < size], places))
        places, size = runs, up(size)
    return out


def derive(own: dict[int, bytes], fetched: dict[int, dict[int, bytes]], size: int) -> tuple[list[dict[int, bytes]], bytes]:
    """The nodes of all runs above and beside ``own``, level by level, and the root."""
    levels = []
    while size > 1:
        known = {**fetched.get(len(levels), {}), **own}
        levels.append(known)
        runs = {p // FAN for p in own}
        own = {q: node_hash(b"".join(known[p] for p in range(q * FAN, min(q * FAN + FAN, size)))) for q in runs}
        size = up(size)
    return levels, own[0]


class Paths:
    """Individual proofs out of the nodes that a partition knows. Whatever leaves have in
    common is put together once."""

    def __init__(self, levels: list[dict[int, bytes]], above: tuple = ()):
        self.levels, self.above = levels, above
        self.seen: dict[tuple[int, int], tuple] = {}

    def of(self, place: int, level: int = 0) -> tuple:
        """For each level upwards what stands left and right of the path in its run."""
        if level == len(self.levels):
            return self.above
        if (level, place) not in self.seen:
            known, q = self.levels[level], place // FAN * FAN
            left = b"".join(known[p] for p in range(q, place))
            right = b"".join(known[p] for p in range(place + 1, q + FAN) if p in known)
            self.seen[level, place] = ((left, right), *self.of(place // FAN, level + 1))
        return self.seen[level, place]


def fold(leaf: bytes, path: tuple) -> bytes:
    for left, right in path:
        leaf = node_hash(left + leaf + right)
    return leaf


@dataclass
class Manifest:
    """``trees``: value, tree, size; ``leaves``: tree, place, doc_id, leaf and the columns
    that were kept; ``nodes``: all above the leaves and the top tree: tree, level, place,
    size (nodes of that level), digest. ``root`` is None for a table without rows."""

    trees: DataFrame
    leaves: DataFrame
    nodes: DataFrame
    root: str | None
    count: int


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that a block (tree, level, size, first, digests) makes above it."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("tree", "level", "place", "size", "digest")}
        for tree, level, size, first, digests in zip(*(batch[c].to_pylist() for c in ("tree", "level", "size", "first", "digests"))):
            here = [d.hex().encode() for d in digests]
            for _ in range(STEPS):
                if size == 1:
                    break
                here = [node_hash(b"".join(here[i : i + FAN])) for i in range(0, len(here), FAN)]
                level, size, first = level + 1, up(size), first // FAN
                for i, digest in enumerate(here):
                    for name, value in zip(out, (tree, level, first + i, size, bytes.fromhex(digest.decode()))):
                        out[name].append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _above(nodes: DataFrame) -> DataFrame:
    """All nodes above ``nodes`` (tree, level, place, size, digest), the lowest of their trees."""
    size, level, made = nodes.agg(F.max("size")).first()[0] or 0, 0, []
    while size > 1:
        # At most 512 in a list.
        blocks = nodes.where("size > 1").groupBy("tree", "level", "size", F.expr(f"place div {BLOCK}").alias("block")).agg(
            F.min("place").alias("first"), F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"]).alias("digests")
        )
        made.append(reliable_checkpoint(blocks.mapInArrow(_fold_blocks, "tree long, level int, place long, size long, digest binary"), "nodes"))
        for _ in range(STEPS):
            size, level = up(size), level + 1
        nodes = made[-1].where(F.col("level") == level)
    out = nodes.where("false").select("tree", "level", "place", "size", "digest")
    for m in made:
        out = out.unionByName(m)
    return out


def build(rows: DataFrame) -> Manifest:
    """A manifest of ``rows``: value (of the column that parts the trees), doc_id, leaf
    (32 bytes), any others. Leaves ascend by doc_id, then leaf; trees by value, NULL
    first, as bytes."""
    spark = rows.sparkSession
    # A number of its own for each row, so that no range holds more rows than others.
    rows = reliable_checkpoint(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    rows = numbered(rows, ["value", "doc_id", "leaf", "_row"], "_all").drop("_row")
    trees = rows.groupBy("value").agg(F.min("_all").alias("_first"), F.count("*").alias("size"))
    trees = reliable_checkpoint(numbered(trees, ["value"], "tree").withColumn("tree", F.col("tree") + 1), "trees")
    count = trees.count()
    by = trees.withColumnRenamed("value", "_value")
    leaves = rows.join(by, F.col("value").eqNullSafe(F.col("_value"))).withColumn("place", F.col("_all") - F.col("_first"))
    leaves = reliable_checkpoint(leaves.drop("_all", "_first", "_value"), "leaves")
    lowest = leaves.select("tree", F.lit(0).alias("level"), "place", "size", F.col("leaf").alias("digest"))
    nodes = _above(lowest)
    subroots = nodes.unionByName(lowest).where("size = 1")
    top = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), (F.col("tree") - 1).alias("place"), F.lit(count).cast("long").alias("size"), "digest"
    )
    top = reliable_checkpoint(top, "top")
    top = top.unionByName(_above(top))
    found = top.where("size = 1").orderBy(F.desc("level")).select(F.hex("digest")).head()
    return Manifest(trees.drop("_first"), leaves, nodes.unionByName(top), found and found[0].lower(), count)


def prove(manifest: Manifest, wanted: DataFrame | None = None, changed: str | None = None, whole: bool = False) -> DataFrame:
    """One row for each of the ``wanted`` rows of ``manifest.leaves`` (all of them where
    it is None): value, doc_id, leaf, subroot, root, proof_sha256, folded_root, verified;
    digests in hex.

    ``proof_sha256`` is the sha256 of the proof: siblings from the leaf to the root, left
    to right. ``folded_root`` starts from the leaf in the column ``changed`` (bytes) where
    that is not NULL, ``verified`` says whether it is the root. ``whole`` adds the proof
    itself, ``proof array<struct<left, right>>`` with what stands beside the path."""
    wanted = manifest.leaves if wanted is None else wanted
    root, count = manifest.root, manifest.count
    other = F.col(changed) if changed else F.lit(None).cast("binary")
    # No more than a block's leaves in a list.
    parts = wanted.groupBy("tree", "size", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "doc_id", "leaf", other.alias("changed")))).alias("rows")
    )
    parts = reliable_checkpoint(parts, "parts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tree, size, block, places in zip(*(batch[c].to_pylist() for c in ("tree", "size", "block", "places"))):
                for of, lacking in ((tree, missing(np.array(places), size)), (TOP, missing(np.array([tree - 1]), count))):
                    out += [(tree, block, of, level, p) for level, ps in enumerate(lacking) for p in ps.tolist()]
            columns = zip(*out) if out else [()] * 5
            names = ["tree", "block", "of", "level", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "level" else pa.int64()) for n, c in zip(names, columns)], names)

    asked = parts.select("tree", "size", "block", F.col("rows.place").alias("places")).mapInArrow(ask, "tree long, block long, of long, level int, place long")
    asked = reliable_checkpoint(asked, "asked")
    high = manifest.nodes.select(F.col("tree").alias("of"), "level", "place", "digest")
    low = manifest.leaves.select(F.col("tree").alias("of"), F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"))
    # Leaves are read only for partitions that lack some.
    found = asked.join(high, ["of", "level", "place"]).unionByName(asked.where(f"level = 0 AND of > {TOP}").join(low, ["of", "level", "place"]))
    fetched = found.groupBy("tree", "block").agg(F.collect_list(F.struct("of", "level", "place", "digest")).alias("fetched"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _expand(batch.slice(i, 1), root, count, whole)

    kind = "tree long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    kind += ", proof array<struct<left:string,right:string>>" if whole else ""
    done = parts.join(fetched, ["tree", "block"], "left").mapInArrow(expand, kind)
    return done.join(manifest.trees.select("tree", "value"), "tree").drop("tree")


def _expand(part: pa.RecordBatch, root: str, count: int, whole: bool) -> Iterator[pa.RecordBatch]:
    tree, size = part["tree"][0].as_py(), part["size"][0].as_py()
    rows, known = part["rows"][0].as_py(), {tree: {}, TOP: {}}
    for x in part["fetched"][0].as_py() or []:
        known[x["of"]].setdefault(x["level"], {})[x["place"]] = x["digest"].hex().encode()
    levels, subroot = derive({r["place"]: r["leaf"].hex().encode() for r in rows}, known[tree], size)
    above, _ = derive({tree - 1: subroot}, known[TOP], count)
    paths = Paths(levels, Paths(above).of(tree - 1))
    out: dict[str, list] = {"doc_id": [], "leaf": [], "proof_sha256": [], "folded_root": []}
    proofs = []
    for r in rows:
        path = paths.of(r["place"])
        out["doc_id"].append(r["doc_id"])
        out["leaf"].append(r["leaf"].hex())
        out["proof_sha256"].append(hashlib.sha256(b"".join(x for pair in path for x in pair)).hexdigest())
        start = r["leaf"] if r["changed"] is None else r["changed"]
        out["folded_root"].append(fold(start.hex().encode(), path).decode())
        if whole:
            proofs.append([{"left": a.decode(), "right": b.decode()} for a, b in path])
    n = len(rows)
    columns = [
        pa.array([tree] * n, pa.int64()), pa.array(out["doc_id"], pa.int64()), pa.array(out["leaf"]), pa.array([subroot.decode()] * n),
        pa.array([root] * n), pa.array(out["proof_sha256"]), pa.array(out["folded_root"]), pa.array([x == root for x in out["folded_root"]]),
    ]
    names = ["tree", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    if whole:
        columns.append(pa.array(proofs, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))))
        names.append("proof")
    yield pa.RecordBatch.from_arrays(columns, names)


def lowered(column: str) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(F.col(column), UPPER, LOWER)


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents (doc_id, source, lang, n_chars, text; a tree for each
    lang), and every row's proof held against a copy in which texts are lower-cased where 3
    divides the crc32 of the id.

    * NULL values have a leaf like any other; a NULL id comes first and is never tampered
      with; rows without a lang are a tree of their own, the first.
    * Repeated rows are leaves side by side, each with its own proof.
    * Empty and very long texts are hashed like any other. A table without rows gives none.
    * Other columns aren't read."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("value"),
        F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"),
    )
    fields = ["doc_id", "source", "value", "n_chars"]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = plain.select(
        "value", "doc_id", leaf_hash([*fields, "text"]).alias("leaf"), F.when(touched, leaf_hash([*fields, lowered("text")])).alias("changed")
    )
    return prove(build(rows), changed="changed").drop("value")


ORACLE = f"""
WITH RECURSIVE facts AS (
  SELECT doc_id, lang, coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS middle,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS front, text,
         translate(text, '{UPPER}', '{LOWER}') AS low,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, i:
             CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)) AS register
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(front || middle || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(register, 4294967295) % 3 = 0
              THEN sha256(front || middle || coalesce(strlen(low) || ':' || low, '-')) END AS changed
  FROM facts),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS size,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, place, size, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY tree, level, place // 8, size),
subroots AS (SELECT tree, digest FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, tree AS place, (SELECT count(*) FROM subroots) AS size, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE size > 1 GROUP BY level, place // 8, size),
runs AS (
  SELECT tree, level, place // 8 AS run, list(digest ORDER BY place) AS d FROM nodes WHERE size > 1 GROUP BY 1, 2, 3
  UNION ALL
  SELECT -1, level, place // 8, list(digest ORDER BY place) FROM tops WHERE size > 1 GROUP BY 2, 3),
climb AS (
  SELECT tree, place, 0 AS level, place AS spot, '' AS proof, coalesce(changed, leaf) AS folded FROM leaves
  UNION ALL
  SELECT c.tree, c.place, c.level + 1, spot // 8,
         proof || array_to_string(d[:spot % 8], '') || array_to_string(d[spot % 8 + 2:], ''),
         sha256(array_to_string(d[:spot % 8], '') || folded || array_to_string(d[spot % 8 + 2:], ''))
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = spot // 8),
climbed AS (SELECT tree, place, arg_max(proof, level) AS proof, arg_max(folded, level) AS folded FROM climb GROUP BY 1, 2),
rise AS (
  SELECT tree, place, 0 AS level, tree AS spot, proof, folded FROM climbed
  UNION ALL
  SELECT c.tree, c.place, c.level + 1, spot // 8,
         proof || array_to_string(d[:spot % 8], '') || array_to_string(d[spot % 8 + 2:], ''),
         sha256(array_to_string(d[:spot % 8], '') || folded || array_to_string(d[spot % 8 + 2:], ''))
  FROM rise c JOIN runs r ON r.tree = -1 AND r.level = c.level AND r.run = spot // 8),
risen AS (SELECT tree, place, arg_max(proof, level) AS proof, arg_max(folded, level) AS folded FROM rise GROUP BY 1, 2),
roots AS (SELECT arg_max(digest, level) AS root FROM tops)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN subroots s USING (tree) JOIN risen USING (tree, place), roots"""


@query("op11_merkle_manifest", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(table(spark, sf_dir, "documents"))
