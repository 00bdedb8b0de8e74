"""The manifest against a plain tree, sparse multiproofs, and rows that invite crashes."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import merkle
from panelforge.llm.common import numbered


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def say(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        q = at // 8 * 8
        out.append(("".join(level[q:at]), "".join(level[at + 1 : q + 8])))
        at //= 8
    return out


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha("".join(map(say, r)))
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, levels([leaf(r) for r in own])
    top = levels([trees[x][1][-1][0] for x in langs])
    out = []
    for i, lang in enumerate(langs):
        own, tree = trees[lang]
        for at, r in enumerate(own):
            way = path(tree, at) + path(top, i)
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf((*r[:4], low)) if touched else leaf(r)
            for a, b in way:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], sha("".join(a + b for a, b in way)), h, h == top[-1][0]))
    return sorted(out, key=str)


ORDER = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
KIND = "doc_id long, source string, lang string, n_chars long, text string"



@pytest.mark.parametrize("sizes", [[], [1], [1, 1], [9, 1, 8], [700, 3, 64, 65]])
def test_equals_a_plain_tree(spark, sizes):
    names = [None, "Zz", "aa", "ä"]
    rows, i = [], 0
    for n, lang in zip(sizes, names):
        for _ in range(n):
            i += 1
            rows.append((i, f"s{i % 3}" if i % 5 else None, lang, None if i % 7 == 0 else i, ["Text É", "", None, "low"][i % 4]))
    df = spark.createDataFrame(rows, KIND).select("*", *(F.lit("?").alias(c) for c in ("tree", "place", "value", "level", "_row", "leaf")))
    got = sorted(map(tuple, merkle.tampered_manifest(df.repartition(5)).select(*ORDER).collect()), key=str)
    assert got == plain(rows)


def test_nulls_repeated_rows_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, "s", "en", 4, "Copy")] * 20 + [(7, "s", "en", 4, "A b " * 200_000)]
    df = spark.createDataFrame(rows, KIND)
    got = sorted(map(tuple, merkle.tampered_manifest(df).select(*ORDER).collect()), key=str)
    assert got == plain(rows)


def test_multiproofs_of_few_leaves(spark):
    """Leaves here and there: each partition fetches what its own don't give."""
    digests = [sha(str(i)) for i in range(3000)]
    df = spark.createDataFrame([("x", i, bytes.fromhex(d)) for i, d in enumerate(digests)], "value string, doc_id long, leaf binary")
    made = merkle.build(df)
    tree = levels(digests)
    assert made.root == tree[-1][0]
    few = [0, 1, 7, 8, 600, 1234, 2999]
    out = {r.doc_id: r for r in merkle.prove(made, made.leaves.where(F.col("doc_id").isin(few)), whole=True).collect()}
    assert sorted(out) == few and all(r.verified for r in out.values())
    for i in few:
        assert [(p.left, p.right) for p in out[i].proof] == path(tree, i)
    assert merkle.prove(made, made.leaves.limit(0)).count() == 0


def test_missing_is_the_least_that_is_needed():
    need = merkle.missing(np.arange(8), 20)
    assert [x.tolist() for x in need] == [[], [1, 2]]
    assert [x.tolist() for x in merkle.missing(np.array([3, 17]), 20)] == [[0, 1, 2, 4, 5, 6, 7, 16, 18, 19], [1]]
    assert merkle.missing(np.array([0]), 1) == []


def test_numbered_counts_over_all_tasks(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("k"), "id").repartition(13)
    rows = numbered(df, ["k", "id"]).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
