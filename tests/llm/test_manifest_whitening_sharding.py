"""Merkle manifest, whitening and sharding against plain Python, and on null, empty, repeated and foreign rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.llm import slot_sharding
from tripmart.llm.embedding_whitening import components, grid, polar_factor, unpack, whiten
from tripmart.llm.merkle_manifest import build_manifest, check_manifest, fold, prove
from tripmart.llm.positions import sorted_rows, with_positions

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank long, digest string, slot long, shard int, size long"
LONG = "Ein langer Satz. " * 20000


def edge_rows():
    texts = [None, "", "Same Text", "Same Text", LONG, "é 日本語 😀 ABC"]
    rows = [(i, texts[i % 6], None if i % 5 == 0 else ["en", "", "Ä", "z"][i % 4], None if i % 3 else "s", None if i % 2 else i, "t", 1, "d", 2, 3, 4) for i in range(90)]
    return rows + [rows[4], rows[4], (None, "Null Id", "en", None, 1, *[None] * 6), (7, "Other text of seven", "en", None, 1, *[None] * 6), (1, "alone", "lone", "s", 2, *[None] * 6)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# -- positions ------------------------------------------------------------------------------


def test_positions_are_gapless_and_spread(spark):
    """A group of nine rows in ten, all equal in the order, is spread over the partitions."""
    rows = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("g"),
                                     F.when(F.col("id") % 10 == 0, F.col("id")).alias("o"))
    got = with_positions(rows, "g", ["o"], "at", "test_positions")
    per = got.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("at").alias("d"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    assert all(r.n == r.d and r.lo == 0 and r.hi == r.n - 1 for r in per) and len(per) == 8
    ordered = [r.o for r in got.where("g = 'g0'").orderBy("at").collect()]
    assert ordered == sorted(ordered)
    at = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(at)
    spark.conf.set(at, "false")
    try:
        sizes = [r.n for r in sorted_rows(rows, "g", ["o"], "test_rows").groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set(at, before)
    assert max(sizes) < 2 * np.median(sizes)


# -- Merkle manifest ------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tower(nodes):
    """Root and, for each node, its siblings' digests from its run upwards."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            run = at[i] // 8 * 8
            p.append((nodes[run:at[i]], nodes[at[i] + 1:run + 8]))
            at[i] //= 8
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def manifest_of(rows):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    out, roots = [], []
    for lang in langs:
        own = sorted(((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r) for r in rows if r.lang == lang), key=lambda x: x[:3])
        root, paths = tower([x[2] for x in own])
        roots.append(root)
        out.append([(x[3], x[2], p) for x, p in zip(own, paths)])
    root, above = tower(roots)
    want = []
    for subroot, own, top in zip(roots, out, above):
        for r, leaf, path in own:
            path = path + top
            node = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None:
                node = leaf_of(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text))
            for left, right in path:
                node = sha("".join(left + [node] + right))
            proof = sha("".join("".join(left + right) for left, right in path))
            want.append((r.doc_id, leaf, subroot, root, proof, node, node == root))
    return want


@pytest.mark.parametrize("table", ["docs", "edge"])
def test_manifest(table, request):
    df = request.getfixturevalue(table)
    want = manifest_of(df.collect())
    got = [tuple(r) for r in check_manifest(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_row_and_none(spark, docs, empty):
    assert check_manifest(empty).count() == 0
    row = check_manifest(docs.limit(1)).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


def test_manifest_proves_only_what_is_asked(docs):
    manifest = build_manifest(docs)
    asked = manifest.leaves.where("doc_id % 17 = 3").select("tree", "rank", "doc_id")
    got = prove(manifest, asked)
    assert got.count() == asked.count() > 0
    whole = {r.doc_id: (r.digest, r.proof) for r in prove(manifest).collect()}
    assert all(whole[r.doc_id] == (r.digest, r.proof) for r in got.collect())
    assert got.where(fold(F.col("digest"), F.col("proof")) != F.col("root")).count() == 0


def test_manifest_shares_records_of_equal_subtrees(spark):
    """A row that stands in thousands of rows: equal runs have one record, and each row its proof."""
    df = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("T").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    manifest = build_manifest(df)
    assert manifest.records[0].count() == 375 and manifest.records[0].distinct().count() == 1
    got = Counter(tuple(r) for r in check_manifest(df).collect())
    assert got == Counter(manifest_of(df.collect()))


# -- whitening ------------------------------------------------------------------------------


def symmetric(kind, rng):
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    values = {"random": rng.random(40), "cluster": np.r_[np.full(15, 5.0), np.full(15, 2.0), rng.random(10)],
              "low rank": np.r_[rng.random(6), np.zeros(34)], "wide": np.logspace(8, -6, 40), "unit": np.full(40, 3.0)}[kind]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", ["random", "cluster", "low rank", "wide", "unit"])
def test_divide_and_conquer_finds_the_components(kind):
    a = symmetric(kind, np.random.default_rng(3))
    values, vectors = components(a)
    want = np.linalg.eigvalsh(a)[::-1]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * np.linalg.norm(a)


def test_polar_factor_is_the_matrix_sign():
    a = symmetric("random", np.random.default_rng(5)) - 0.5 * np.eye(40)
    values, q = np.linalg.eigh(a)
    assert np.abs(polar_factor(a) - (q * np.sign(values)) @ q.T).max() < 1e-12


def test_whitening(spark):
    """Every row of the table against numpy's own eigenvectors."""
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = table.collect()
    x = {r.vec_id: tuple(int(v) + 1_000_000 for v in np.floor(64 * np.array(r.embedding, np.float64))) for r in rows}
    fit = np.array(sorted(set(x.values())), np.float64)
    n, mean = len(fit), fit.mean(axis=0)
    v = (fit - mean).T @ (fit - mean) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    got = whiten(table).collect()
    assert len(got) == 16 * len(rows)
    z = np.zeros((len(rows), 16))
    at = {r.vec_id: i for i, r in enumerate(rows)}
    sums = [sum(int(f[j]) for f in fit) for j in range(len(mean))]
    for r in got:
        z[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained - e[r.component - 1] / v.trace()) < 1e-12 and r.identity_error < 1e-9
        if r.component == 1:
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
    want = (np.array([x[r.vec_id] for r in rows]) - mean) @ q[:, :16] / np.sqrt(e[:16])
    signs = np.sign((z * want).sum(axis=0))
    assert np.abs(z * signs - want).max() < 1e-8


def test_whitening_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, x binary, dim int, component int, n long"
    make = lambda rows: spark.createDataFrame([(i, e, b"", 1, 1, 1) for i, e in rows], schema)
    good = [(i, [float(i % 7), float(i * i % 11), 0.5]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0])]
    rounded = lambda df: sorted((*r[:4], *(round(v, 9) for v in r[4:])) for r in df.collect())
    plain = rounded(whiten(make(good)))
    assert len(plain) == 80  # the third entry never varies
    assert rounded(whiten(make(bad + good))) == plain
    again = whiten(make(good + good + [(None, good[0][1])])).collect()
    assert len(again) == 2 * 80 + 2 and sum(r.vec_id is None for r in again) == 2
    assert {round(r.whitened, 9) for r in again} == {r[4] for r in plain}
    assert whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten(make([])).count() == 0
    wide = whiten(make([(i, [1e16 * (i % 5), 1.0 * i]) for i in range(20)])).collect()  # (n x - S)^2 is beyond a long
    x = {i: (64 * int(np.float32(1e16 * (i % 5))), 64 * i) for i in range(20)}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    exact = {i: sum((20 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    assert {r.vec_id: r.deviation for r in wide} == {i: v if v < 2**63 else None for i, v in exact.items()}
    assert max(r.identity_error for r in wide) < 1e-4


def test_packed_rows_round_trip():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    rows = [(rng.standard_normal(9) * 10.0**k).tolist() for k in range(16)]
    packed = grid(pa.array(rows, pa.list_(pa.float64())))
    assert (unpack(packed) == np.floor(64 * np.array(rows)).astype(np.int64)).all()
    assert {p[0] for p in packed} >= {2, 4, 8}


# -- sharding -------------------------------------------------------------------------------


def test_sharding(docs, edge):
    for df in (docs, edge):
        rows = df.collect()
        got = slot_sharding.shard(df).collect()
        plain = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        assert sorted(((r.doc_id, *plain(r.text)) for r in rows), key=str) == sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str)
        for s in range(8):
            slots = sorted(r.slot for r in got if r.shard == s)
            assert slots == list(range(len(slots)))
        assert all(0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None for r in got)
        key = lambda r: f"{'-' if r.doc_id is None else r.doc_id}:{r.text_crc32}"
        assert all(r.virtual_slot == int(hashlib.md5(key(r).encode()).hexdigest()[:8], 16) % slot_sharding.SLOTS for r in got)
    assert slot_sharding.shard(df.limit(0)).count() == 0


def greedy(old, weights, shards):
    """The map's edit in plain Python."""
    total = sum(weights.values())
    to, loads, pool = {}, [0] * shards, []
    for s in sorted(set(old.values())):
        run = 0
        for slot in sorted((k for k, v in old.items() if v == s), key=lambda k: (-weights.get(k, 0), k)):
            run += weights.get(slot, 0)
            if s < shards and run * shards <= total:
                to[slot], loads[s] = s, run
            else:
                pool.append(slot)
    for slot in sorted(pool, key=lambda k: (-weights.get(k, 0), -k)):
        s = loads.index(min(loads))
        to[slot] = s
        loads[s] += weights.get(slot, 0)
    return to, loads


def test_map_edits(spark, scratch):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.pow(F.col("id") % 101, 2) / 9).cast("int")).alias("text"))
    weights = slot_sharding.slot_weights(slot_sharding.records(rows))
    plain = {r.virtual_slot: r.bytes for r in weights.collect()}
    first = slot_sharding.save_map(slot_sharding.first_map(spark), scratch, 0)
    second = slot_sharding.save_map(slot_sharding.edit_map(first, weights), scratch, 1)
    want, loads = greedy({s: s % 8 for s in range(slot_sharding.SLOTS)}, plain, 8)
    assert {r.virtual_slot: r.shard for r in second.collect()} == want
    assert max(loads) - min(loads) < 0.001 * sum(loads)
    # one shard more: what moves is what it needs, and the law still holds
    third = slot_sharding.save_map(slot_sharding.edit_map(second, weights, 9), scratch, 2)
    grown = {r.virtual_slot: r.shard for r in third.collect()}
    bytes_of = Counter()
    for slot, s in grown.items():
        bytes_of[s] += plain.get(slot, 0)
    assert max(bytes_of.values()) - min(bytes_of.values()) < 0.001 * sum(loads)
    moved = sum(plain.get(s, 0) for s in grown if grown[s] != want[s])
    assert moved < 1.3 * sum(loads) / 9
    # fewer shards: the last one's slots go to the others
    assert {r.shard for r in slot_sharding.edit_map(third, weights, 5).collect()} == set(range(5))
    assert {r.virtual_slot: r.shard for r in slot_sharding.read_map(spark, scratch, 1).collect()} == want
    with pytest.raises(Exception, match="exist"):
        slot_sharding.save_map(first, scratch, 1)


def test_one_record_in_many_rows_is_split(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("the same text").alias("text"))
    per = {r.shard: r.b for r in slot_sharding.shard(rows).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    assert len(per) == 8 and max(per.values()) < 1.02 * min(per.values())


def test_sharding_stays_in_the_jvm(docs):
    plan = slot_sharding.shard(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
