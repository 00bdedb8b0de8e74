"""Each operator against a plain version, and on rows that invite crashes."""

import base64
import hashlib
import math
import re
import sys
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute

from panelforge.llm import (
    binary_codes,
    byte_bpe,
    class_lm,
    decontaminate,
    jaccard_join,
    resample,
    sharding,
    token_counts,
    toxicity,
    warc,
    words,
)
from panelforge.llm.common import components, crc_remainder

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
ODD = [
    (1, LONG), (2, LONG), (2, LONG), (3, LONG.replace("pi", "PI")), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, "One  two"),
    (None, LONG), (None, None), (9, "word " * 3000), (10, "é" * 5000), (11, LONG + " " + " ".join(f"w{i}" for i in range(40))), (12, "x"),
]


def frame(spark, rows):
    """Rows with columns whose names clash with inner ones."""
    kind = "doc_id long, text string"
    return spark.createDataFrame(rows, kind).select("*", *(F.lit("?").alias(c) for c in ("node", "n", "uid", "score", "at", "label")))


def documents():
    t = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    return dict(zip(t.doc_id, t.text))


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_words_are_those_of_the_pattern():
    texts = ["", None, "a", "Ab  cD\te", "  x ", "é É", "x" * 70, "a\x0bb\x1cc"]
    seen = {}
    w = next(words.words(pa.array(texts)))
    for i, t in enumerate(texts):
        said = [brute.lower(x) for x in brute.WORD.findall(t or "")]
        got = w.hashes[w.ends[i] : w.ends[i + 1]].tolist()
        assert len(said) == len(got)
        for a, b in zip(said, got):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_slices_do_not_change_words():
    texts = pa.array([f"w{i} " * (i % 40) for i in range(500)])
    whole = np.concatenate([w.hashes for w in words.words(texts)])
    parts = np.concatenate([words.split_words(s).hashes for s in words.slices(texts, 100)])
    assert (whole == parts).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(40, 41), (41, 41), (50, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components(got, links) and got[30] == 1 and got[50] == 40


def test_components_stop_once_all_links_lead_to_the_smallest(spark):
    """Longer ways, several smallest neighbours, repeated links; and few jobs where nothing is left to do."""
    links = [(i, i + 1) for i in range(40)] + [(100, 103), (101, 103), (101, 104), (102, 104), (104, 104), (103, 100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 105)}}
    context = spark.sparkContext
    context.setJobGroup("stars", "links to the smallest node")
    rows = components(spark.range(1, 2000).selectExpr("id a", "id % 3 * 10000 - 20000 b"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("stars")) <= 12
    assert sorted({r.root for r in rows.collect()}) == [-20000, -10000, 0]


@pytest.mark.parametrize("rows", ["odd", "documents", "crowd"])
def test_jaccard_components(spark, rows):
    if rows == "documents":
        texts = documents()
        data = list(texts.items())
    elif rows == "crowd":
        rng = np.random.default_rng(1)
        base = [f"w{i}" for i in range(80)]
        data = []
        for i in range(120):
            own = [f"r{i}-{k}" if rng.random() < 0.03 else x for k, x in enumerate(base)]
            data.append((i, " ".join(own) + f" {i}"))
    else:
        data = ODD
    out = jaccard_join.jaccard_components(frame(spark, data)).collect()
    assert len(out) == len(data)
    ids = [i if i is not None else 10**9 + k for k, (i, _) in enumerate(data)]
    rowsets = {k: brute.shingle_set(t) for k, (_, t) in enumerate(data)}
    roots = brute.components(rowsets, brute.similar_pairs(rowsets))
    least = {}
    for k, r in roots.items():
        least[r] = min(least.get(r, 10**12), ids[k])
    want = Counter((i, len(rowsets[k]), least[roots[k]] if least[roots[k]] < 10**9 else None) for k, (i, _) in enumerate(data))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == want


def test_jaccard_join_keeps_one_of_each(spark):
    docs = frame(spark, ODD)
    kept = jaccard_join.keep_first(docs, jaccard_join.jaccard_components(docs))
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:8]) for r in kept.collect())
    ids = [i for none, i, _ in got if not none]
    assert ids == [1, 4, 5, 6, 7, 9, 10, 11, 12]
    assert sum(none for none, *_ in got) == 1   # the row without id and text


def test_copies_are_left_out_by_one_function_a_task(spark, capsys):
    """Each function for a row has a process of its own beside it."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    kept = jaccard_join.keep_first(docs, jaccard_join.jaccard_components(docs))
    capsys.readouterr()
    kept.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") <= 2


def test_copies_are_left_out_all_over_a_batch(spark):
    """Rows that pass by themselves lie between copies, in one batch of many rows."""
    words_ = "concat_ws(' ', transform(sequence(1, 12), x -> concat('w', xxhash64(k, x))))"
    docs = spark.range(0, 3000, 1, 1).selectExpr("id doc_id", "if(id % 3 = 0, id, id div 9) k").selectExpr("doc_id", f"{words_} text", "k").coalesce(1)
    found = jaccard_join.jaccard_components(docs)
    kept = [r.doc_id for r in jaccard_join.keep_first(docs, found).collect()]
    first = {}
    for r in docs.collect():
        first.setdefault(r.k, r.doc_id)
    assert sorted(kept) == sorted(first.values())


@pytest.mark.parametrize("blocks", [1, 2])
def test_compared_blocks_are_held_once(blocks):
    """500 sets of 500 shingles and a near copy of each, in one block or in two."""
    rng = np.random.default_rng(1)
    half, n = 500, 500
    sets = np.tile(rng.integers(0, 1 << 62, (half, n)), (2, 1))
    sets[half:, :20] = rng.integers(0, 1 << 62, (half, 20))
    sets.sort(axis=1)
    ids, at = np.arange(2 * half), np.arange(2 * half) // half * (blocks - 1)
    small = lambda x: pa.array(np.broadcast_to(x, 2 * half).astype(np.int32))
    lists = pa.ListArray.from_arrays(pa.array((np.arange(2 * half + 1) * n).astype(np.int32)), pa.array(sets.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), lists, small(at), small(0), small(blocks - 1)], ["node", "root", "members", "block", "lo", "hi"])
    ranks = bytes(1 << jaccard_join.RANK_BITS)
    tracemalloc.start()
    (found,) = jaccard_join._compare(iter([batch]), 75, ranks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(zip(found["a"].to_pylist(), found["b"].to_pylist())) == {(i, i + half) for i in range(half)}
    assert peak < (32 if blocks == 1 else 26) * sets.size


def test_empty_tables(spark):
    docs = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    ranks, pattern = byte_bpe.public_vocabulary()
    made = [
        jaccard_join.jaccard_components(docs), class_lm.class_scores(docs, F.lit(False)), toxicity.score(docs, toxicity.fit(docs, labels)),
        resample.resample(docs, resample.fit(docs, labels), 1.0), decontaminate.overlaps(docs, bench), sharding.shard(docs), byte_bpe.digests(docs, ranks, pattern),
        token_counts.recount(docs.withColumn("edits", token_counts.derived_edits("doc_id", "text")), ranks, pattern),
        warc.derivatives(warc.responses_of(spark.createDataFrame([], "page_id long, url string, html string"))),
        binary_codes.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ]
    assert [m.count() for m in made] == [0] * len(made)


@pytest.mark.parametrize("rows", ["odd", "documents"])
def test_class_scores(spark, rows):
    data = ODD if rows == "odd" else list(documents().items())
    out = class_lm.class_scores(frame(spark, data), crc_remainder("doc_id", 10) == 0, settings=class_lm.Settings(hot=64, single=32, sweeps=4)).collect()
    token = lambda t: [*brute.WORD.findall(brute.lower(t)), None]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c = Counter(x for i, t in data if not held(i) for x in token(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in data:
        w = token(t)
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(base, 4))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    assert all(r.score <= 0 for r in out)
    if rows == "documents":
        assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


def test_class_model_adds_up_to_one(spark):
    train = [(i, "a b c a b d") for i in (1, 2, 3, 5)] + [(6, "b a c c")]
    known = ["a", "b", "c", "d", ""]
    ask = [(100 + k, ("a b " + x).strip()) for k, x in enumerate([*known, "zz"])]
    docs = spark.createDataFrame(train + ask, "doc_id long, text string")
    out = {r.doc_id: r for r in class_lm.class_scores(docs, F.col("doc_id") >= 100, settings=class_lm.Settings(classes=4, hot=2, single=3, sweeps=2)).collect()}
    # "a b" + end is one continuation; the others have the end after them.
    start = {k: 10 ** out[100 + k].score for k in range(6)}
    assert 0 < sum(start[k] for k in (0, 1, 2, 3, 5)) + start[4] < 1


def test_toxicity(spark):
    rng = np.random.default_rng(0)
    plain = [f"p{i}" for i in range(300)]
    data, labels = [], []
    for i in range(400):
        text = list(rng.choice(plain, 40))
        bad = i % 4 == 0
        if bad:
            text.insert(5, rng.choice(["idiot", "idiotically", "moron"]))
        if i % 3 == 0 or bad:
            text.insert(9, rng.choice(["women", "men"], p=[0.9, 0.1] if bad else [0.5, 0.5]))
        data.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, data + [(None, None), (900, ""), (901, "women " * 5), (902, "IDIOT!")])
    scorer = toxicity.fit(docs, lab)
    out = {r.doc_id: r for r in toxicity.score(docs, scorer).collect()}
    held = [i for i in range(400) if out[i].held_out]
    assert held and all(out[i].predicted == (i % 4 == 0) for i in held)
    assert out[901].predicted == 0 and out[902].predicted == 1 and 0 <= out[900].score <= 1 and out[None].score == out[900].score
    assert toxicity.keep_clean(docs, lab).columns == docs.columns
    women, men = (float(scorer.score(pa.array([t]))[0]) for t in ("women", "men"))
    assert abs(women - men) < 0.05


def test_toxicity_learns_one_text_of_each_id(spark, monkeypatch):
    seen, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda labels, *rest: seen.append(sorted(labels)) or train(labels, *rest))
    data = [(i, f"text {i}") for i in (2, 3, 4)] + [(4, f"copy {k // 2}") for k in range(300)]
    toxicity.fit(frame(spark, data), spark.createDataFrame([(2, 0), (3, 0), (4, 1)], "doc_id long, toxic int"))
    ids = [i for i in (2, 3, 4) if zlib.crc32(str(i).encode()) % 5]
    assert 4 in ids and seen == [[float(i == 4) for i in ids]]


def test_twins_pull_scores_together():
    labels = np.array([1.0, 0.0] * 20)
    own, twins = [np.array([0]), np.array([1])] * 20, [np.array([1]), np.array([0])] * 20
    free, tied = (toxicity.train(labels, own, twins, 2, p) for p in (0.0, 5.0))
    assert abs(tied[0] - tied[1]) < 0.2 * abs(free[0] - free[1])


def test_resample(spark):
    data = list(documents().items())
    labels = read(spark, "labels")
    docs = frame(spark, data + [(None, None), (7_000, ""), (7_001, None)] + data[:1])
    weights = resample.fit(docs, labels)
    every = resample.resample(docs, weights, 1.0).toPandas()
    assert len(every) == len(data) + 4
    half = resample.resample(docs, weights, 0.5).toPandas()
    keys = np.sort(every.gumbel_key)[::-1]
    k = int(0.5 * len(every) + 0.5)
    assert k <= len(half) <= k + 1 and half.gumbel_key.min() == keys[k - 1]
    assert resample.resample(docs, weights, 0.0).count() == 0
    good = set(labels.where("quality = 1").toPandas().doc_id)
    bad = set(labels.where("quality = 0").toPandas().doc_id)
    kept = {r.doc_id for r in resample.keep_drawn(docs, labels).select("doc_id").collect()}
    assert len(kept & good) > 0.95 * len(good) and len(kept & bad) < len(bad)


@pytest.mark.parametrize("mix", ["labels", "few_bad", "copies", "unlabelled"])
def test_as_many_rows_stay_as_are_good(spark, mix):
    rng = np.random.default_rng(5)
    text = lambda kind: " ".join(f"{kind}{k}" for k in rng.integers(0, 200, 60))
    good, bad = [(i, text("g")) for i in range(300)], [(1000 + i, text("b")) for i in range(100)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good[::2]] + [(i, 0) for i, _ in bad[::2]], "doc_id long, quality int")
    if mix == "few_bad":
        bad = bad[:10]
    if mix == "copies":
        good += [(2000 + i, good[1][1]) for i in range(200)]
    if mix == "unlabelled":
        good = good[::2] + [(3000 + i, text("g")) for i in range(400)]
    kept = {r.doc_id for r in resample.keep_drawn(frame(spark, good + bad), labels).select("doc_id").collect()}
    assert len({i for i, _ in good} - kept) <= 2 and len(kept & {i for i, _ in bad}) <= 2


def test_copied_texts_are_told_without_a_process_more(spark, capsys):
    rows = spark.range(300).selectExpr("concat('text ', least(id, 250)) text").selectExpr("xxhash64(text) hash", "text")
    one = resample._distinct(rows)
    one.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
    assert sorted(r.text for r in one.collect()) == sorted(f"text {i}" for i in range(251))


def test_cut_counts_misjudged_texts():
    assert resample.cut_between(np.array([1.0, 2.0]), np.array([])) is None
    assert resample.cut_between(np.array([5.0, -2.0]), np.array([-8.0, -6.0])) == (-4.0, 1.0, 0.0)
    cut = resample.Cut(0.0, 0.8, 0.1, 0, 0, 0)
    # 700 good and 300 bad texts: 560 + 30 pass; a copied one that passes has 500 rows more.
    assert cut.good_rows(1000, 590, 1000, 590) == 700 and cut.good_rows(1500, 1090, 1000, 590) == 1200
    assert cut.good_rows(100, 80, 100, 80) == 100 and resample.Cut(0.0, 0.8, 0.1, 0, 5, 0).good_rows(105, 80, 105, 80) == 100


def test_least_key(spark):
    keys = [1.0, 2.0, 2.0, 3.0, -5.0, 1e9, 2.0]
    df = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in range(1, 8):
        assert resample.least_key(df, k) == sorted(keys, reverse=True)[k - 1]


def test_decontaminate(spark):
    item = " ".join(f"t{i}" for i in range(24))
    swapped = item.split()
    swapped[5] = swapped[13] = "other"
    filler = " ".join(f"f{i}" for i in range(300))
    data = [
        (1, f"{filler} {item} {filler}"), (2, f"{filler} {' '.join(swapped).upper()}, {filler}"), (3, filler), (4, None), (5, ""), (6, "t0 t1 t2 t3 t4 t5 t6 t7 " + filler),
        (7, "say short item of six words now"), (1, item), (None, item), (8, " ".join(x if i % 2 else "no" for i, x in enumerate(item.split()))),
    ]
    bench = spark.createDataFrame([(10, item), (11, "Short item of SIX words."), (12, None), (13, ""), (14, "tiny one"), (None, item), (15, item)], "item_id long, text string")
    out = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(frame(spark, data), bench).collect()}
    assert set(out) == {(i, k) for i in (1, 2, None) for k in (10, 15)} | {(7, 11)}
    assert out[(2, 10)].matched == 22 and out[(2, 10)].aligned == 24 and out[(2, 10)].first_word == 300
    kept = decontaminate.keep_uncontaminated(frame(spark, data), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]


def test_decontaminate_finds_whole_items(spark):
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    want = {(i, k) for i, t in documents().items() for k, x in zip(items.item_id, items.text) if x in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(read(spark, "documents"), read(spark, "benchmark")).collect()}
    assert want and want <= got


def test_binary_codes(spark):
    rng = np.random.default_rng(3)
    near = rng.normal(size=(6, 16))
    x = np.concatenate([rng.normal(size=(300, 16)), *(v + rng.normal(size=(40, 16)) * 0.05 for v in near)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, rows[0][1]), (1000, rows[0][1]), (1001, None), (1002, []), (1003, [0.0] * 16), (1004, [float("nan")] * 16), (1005, [1.0] * 5), (1006, [None] + [1.0] * 15), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("label", F.lit(2))
    out = binary_codes.near_duplicates(docs).toPandas()
    assert len(out) == len(rows)
    data = [(i, v) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    m = np.array([v for _, v in data], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    link = m @ m.T >= 0.95
    np.fill_diagonal(link, False)
    got = dict(zip(out.vec_id, out.n_links))
    want = dict(zip([i for i, _ in data], link.sum(1)))
    assert sum(got[i] for i in range(540)) >= 0.95 * sum(want[i] for i in range(540)) and all(got[i] <= want[i] for i in range(540))
    assert got[0] == want[0] == 2 and all(got[i] == 0 for i in range(1001, 1007))
    odd = out[out.vec_id >= 1001]
    assert (odd.component_id == odd.vec_id).all() and odd.kept.all()
    assert not out[out.vec_id.isna()].kept.any()


@pytest.mark.parametrize("vectors", [10_000, 1_000_000])
@pytest.mark.parametrize(("dim", "mean"), [(32, 0.0), (64, 0.7), (96, 0.0)])
def test_tables_find_pairs_at_the_limit(vectors, dim, mean):
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(mean * np.eye(dim)[0] + math.sqrt(1 - mean**2) * unit(rng.normal(size=(9000, dim))))
    codes = binary_codes.learn_codes(x[3000:], vectors, 0.95)
    assert codes.width == max(8, math.ceil(math.log2(vectors / binary_codes.PLACE + 1)))
    u = rng.normal(size=(3000, dim))
    u = unit(u - (u * x[:3000]).sum(1, keepdims=True) * x[:3000])
    y = 0.95 * x[:3000] + math.sqrt(1 - 0.95**2) * u
    assert (codes.places(x[:3000]) != codes.places(y)).all(1).mean() <= 3 * binary_codes.MISS


def test_vectors_of_each_length_link(spark, monkeypatch):
    monkeypatch.setattr(binary_codes, "BLOCK", 100)
    rng = np.random.default_rng(2)
    rows = [(d * 1000 + i, rng.normal(size=d).tolist()) for d, n in ((16, 300), (20, 200), (7, 3)) for i in range(n)]
    rows += [(i + 500, [x + 0.001 for x in v]) for i, v in rows if i % 1000 < 2]
    out = {r.vec_id: r for r in binary_codes.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert all(out[d * 1000 + 500 + i].component_id == d * 1000 + i for d in (16, 20, 7) for i in (0, 1))


@pytest.mark.parametrize("rows", ["odd", "hot", "documents"])
def test_shards(spark, rows):
    data = {"odd": ODD, "hot": [(i, "same text" * 20) for i in range(3000)] + [(i, f"text {i} " * 10) for i in range(6000)], "documents": list(documents().items())}[rows]
    out = sharding.shard(frame(spark, data)).toPandas()
    assert len(out) == len(data) and set(out.law) == {"bytes"} and out.grown_shard.isna().all() and out.shard.between(0, 15).all()
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    raw = [(t or "").encode() for _, t in data]
    assert Counter(zip(out["size"], out.text_crc32)) == Counter((len(b) + 1, zlib.crc32(b)) for b in raw)
    if rows == "hot":
        by = out.groupby("shard")["size"].sum()
        assert len(by) == 16 and by.max() < 1.15 * by.mean() and by.min() > 0.85 * by.mean()


def test_byte_bpe_equals_tiktoken(spark):
    import tiktoken

    ranks, pattern = byte_bpe.public_vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.ranks_of(ranks), special_tokens={})
    data = [*ODD, *documents().items(), (900, "a  b   c \n\n d  e\t\tf  "), (901, "'s 'll don't 日本語 😀   १२"), (902, "<|endoftext|>")]
    out = byte_bpe.digests(frame(spark, data), ranks, pattern).collect()
    want = Counter()
    for i, t in data:
        ids = enc.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, out)) == want


def test_byte_bpe_remembers_a_text_once():
    coder = byte_bpe.Encoder(*byte_bpe.public_vocabulary())
    list(coder.encode(pa.array([" ".join(f"word{chr(97 + i % 26) * (1 + i // 26)}, again" for i in range(1000))])))
    memories = [m for m in vars(coder).values() if isinstance(m, byte_bpe.Memory)]
    held = [k for m in memories for k in {*m.now, *m.old}]
    assert len(held) == len(set(held)) > 1000
    assert sum(2 * m.most for m in memories) <= 64 << 20


def test_byte_bpe_matches_that_depend_on_what_stands_around():
    """``ab`` is one match after ``x``, and two by itself; neither is taken for the other."""
    ranks = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([b"a", b"b", b"x", b" ", b"ab"]))
    for texts in (["ab", "xab"], ["xab", "ab"], ["xab ab", "ab"]):
        coder = byte_bpe.Encoder(ranks, "(?<=x)ab|.")
        for _ in range(2):
            got = [ids.tolist() for t in texts for ids, _ends in coder.encode(pa.array([t]))]
            assert got == [{"ab": [0, 1], "xab": [2, 4], "xab ab": [2, 4, 3, 0, 1]}[t] for t in texts]


def test_byte_bpe_offsets_and_split_characters(spark):
    ranks, pattern = byte_bpe.public_vocabulary()
    text = "Héllo 😀 wörld"
    rows = byte_bpe.encode(frame(spark, [(1, text), (2, None)]), ranks, pattern, offsets=True)
    one, two = sorted(rows.collect(), key=lambda r: r.doc_id)
    assert two.ids == [] and two.starts == []
    assert len(one.ids) == len(one.starts) and one.starts[0] == 0 and one.stops[-1] == len(text)
    back = byte_bpe.decode(rows, ranks, pattern).where("doc_id = 1").first()
    assert back.text == text and bytes(back.bytes) == text.encode()
    cut = spark.createDataFrame([(1, one.ids[:k]) for k in range(len(one.ids) + 1)], "doc_id long, ids array<int>")
    for r in byte_bpe.decode(cut, ranks, pattern).collect():
        assert text.encode().startswith(bytes(r.bytes))


def test_token_counts(spark):
    ranks, pattern = byte_bpe.public_vocabulary()
    count = token_counts.counter(ranks, pattern)
    data = [*ODD, *documents().items()]
    docs = frame(spark, data).withColumn("edits", token_counts.derived_edits("doc_id", "text"))
    edits = [r.edits for r in docs.select("edits").collect()]
    rows = token_counts.recount(docs, ranks, pattern, texts=True, size=64).collect()
    assert len(rows) == len(data)
    for (i, t), es, r in zip(data, edits, rows):
        assert (r.doc_id, r.tokens_before) == (i, count(t or ""))
        text = t or ""
        for e in es:
            at = min(e["at"], len(text))
            text = text[:at] + e["added"] + text[at + e["removed"] :]
        assert r.text == text and r.tokens_after == count(text) and r.chars_after == len(text)
    odd = spark.createDataFrame([(1, "a b", None), (2, "a b", [(None, None, None)]), (3, None, [(5, 5, "new words")])], "doc_id long, text string, edits array<struct<at:long,removed:long,added:string>>")
    assert [r.tokens_after for r in token_counts.recount(odd, ranks, pattern).orderBy("doc_id").collect()] == [count("a b"), count("a b"), count("new words")]


def test_long_texts_encode_only_what_an_edit_touches():
    ranks, pattern = byte_bpe.public_vocabulary()
    count = token_counts.counter(ranks, pattern)
    text = LONG * 500
    tree = token_counts.build(text, count)
    new, encoded = token_counts.edit(text, tree, 30_000, 5, "xyz abc", count)
    assert encoded < 2_000 and tree.tokens == count(new) and tree.chars == len(new)


def test_warc_derivatives(spark):
    page = "<html><head><title>A &amp; B</title><script>x<y</script></head><body><p>One<b>two</b></p><!-- no --><a href='/z?a=1&amp;b'>three  four</a><style>p{</style></body>"
    pages = spark.createDataFrame([(1, "http://e.x/1", page), (2, None, None), (3, "u", ""), (None, "v", "<p>t"), (1, "http://e.x/1", page), (4, "w", "<script>never ends")], "page_id long, url string, html string").withColumn("block", F.lit(0))
    sources = {r.page_id: r for r in warc.responses_of(pages).collect()}
    out = warc.derivatives(warc.responses_of(pages)).collect()
    assert len(out) == 12 and {r.warc_type for r in out} == {"metadata", "conversion"}
    mine = [r for r in out if r.page_id == 1]
    text = next(r for r in mine if r.warc_type == "conversion")
    assert text.block == "Onetwo\nthree four" and text.refers_to == sources[1].record_id and text.source_digest == warc.digest(page.encode())
    assert text.block_digest == warc.digest(text.block.encode()) and text.content_length == len(text.block.encode())
    facts = next(r.block for r in mine if r.warc_type == "metadata")
    assert '"A & B"' in facts and '"/z?a=1&b"' in facts and "text/html" in facts
    assert len({r.record_id for r in mine}) == 2
    raw = warc.record_bytes(text.asDict())
    head, _, rest = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: conversion") and rest == text.block.encode() + b"\r\n\r\n"


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>T</title><body><p>text", "text"),
    ("<head><meta charset=utf-8><title>T</title><style>p{}</style><!-- c --> <p>one", "one"),
    ("<head><title>T</title>\n<script>if (a<b) '<p>'</script>bare <b>words</b>", "bare words"),
    ("<p>one</p><svg /><p>two</p>", "one\ntwo"),
    ('<p>one</p><iframe src="x"/><p>two</p><script src=\'y\' /><p>three', "one\ntwo\nthree"),
    ("<p>one<svg width=5/>no</svg><p>two", "one\ntwo"),
    *[(f"<p>one<{n} a=b>two<p>three", "onetwo\nthree") for n in ("svg", "object", "iframe", "noscript", "template")],
    *[(f"<p>one<{n}>no<p>no", "one") for n in ("script", "style")],
    ("<p>one<!-- no<p>no", "one"), ("<header>one</header><script>no</script >two<head>no</head>", "one\ntwo"),
])
def test_warc_keeps_text_after_what_nothing_ends(page, text):
    assert warc.plain_text(page) == text
    assert '"/after"' in warc.derive(1, "r", "u", "d", (page + "<a href='/after'>").encode())[0][-1] or page.endswith("no<p>no")


def test_warc_charset():
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9"
    meta, text = warc.derive(1, "r", "u", "d", message)
    assert text[-1] == "café" and re.search("latin-1", meta[-1])
    assert warc.derive(1, None, None, None, b"\xff no header")[1][-1] == "� no header"


@pytest.mark.parametrize("unit", ["<a ", "<a href=\"", "<title>", "<head><title>", "<script ", "</script ", "<svg =", "<div ", "<!--", "<head>", "<svg>"])
def test_pages_of_openings_take_linear_time(unit):
    import time

    page = unit * (1_000_000 // len(unit))
    begin = time.process_time()
    warc.derive(1, "r", "u", "d", page.encode())
    assert time.process_time() - begin < 4


def test_links_and_titles_of_odd_tags():
    assert warc.links("<a x><a href='q>r' y><A\nHREF = z/><a href=\"o><a href=end") == ["q>r", "z/", "end"]
    assert warc.page_title("<title>a</title x><TITLE y>b &amp; c</title >") == "a</title x><TITLE y>b & c"
    assert warc.page_title("<title>open") is None and warc.page_title("") is None
    assert [warc.closes_itself(t) for t in ("<svg/>", "<svg a=b />", "<svg a=b/>", "<svg a='b'/>", "<svg a= b/>", "<svg>")] == [True, True, False, True, False, False]
