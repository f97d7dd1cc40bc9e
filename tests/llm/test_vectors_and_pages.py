"""Embedding near-duplicates, WARC bundles, links in hot buckets, the pipeline."""

import hashlib
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from blotter.llm import components, nndescent, warc
from blotter.llm.alignment import banded_distance
from blotter.session import scratch_path


# ------------------------------------------------------------------- 6 vectors

def test_vectors_against_brute_force(spark):
    """Groups of 2 to 300 near vectors (larger than any list), two labels that
    share vectors, and vectors that can link to nothing."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for size in [2] * 40 + [5] * 10 + [40, 300]:
        centre = rng.standard_normal(32)
        for _ in range(size):
            rows.append((centre + 0.15 * rng.standard_normal(32)).tolist())
            labels.append(int(size % 3))
    rows += rng.standard_normal((300, 32)).tolist()
    labels += [1] * 300
    rows += [rows[0], rows[0], None, [0.0] * 32, [float("nan")] * 32, [None] + [1.0] * 31, [], [float("inf")] * 32, rows[0][:16]]
    labels += [99, None, 1, 1, 1, 1, 1, 1, labels[0]]
    table = spark.createDataFrame([(1000 + i, v, l, "clash", 7) for i, (v, l) in enumerate(zip(rows, labels))],
                                  "vec_id long, embedding array<double>, label int, bin string, tile int").repartition(3)
    got = {r.vec_id: r for r in nndescent.near_duplicates(spark, table).collect()}
    good = [i for i, v in enumerate(rows) if v is not None and len(v) == 32 and labels[i] is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([rows[i] for i in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    l = np.array([labels[i] for i in good])
    near = (x @ x.T >= 0.93) & (l[:, None] == l[None, :])
    np.fill_diagonal(near, False)
    group = np.arange(len(good))
    while True:
        new = np.minimum(group, np.where(near, group[None, :], len(good)).min(axis=1))
        if (new == group).all():
            break
        group = new
    assert len(got) == len(rows)
    for k, i in enumerate(good):
        r = got[1000 + i]
        assert (r.n_links, r.component_id, r.kept) == (near[k].sum(), 1000 + good[group[k]], group[k] == k), i
    for i in set(range(len(rows))) - set(good):
        assert (got[1000 + i].n_links, got[1000 + i].component_id) == (0, 1000 + i)


@pytest.mark.parametrize("noise", [0.0, 0.002])
def test_links_between_dense_groups_are_not_lost(spark, noise):
    """Groups of 60, larger than any list, whose vectors all link with those of the next group
    (cosine 0.94) and with no other: every list is full of its own group."""
    rng = np.random.default_rng(8)
    steps = [rng.standard_normal(64) for _ in range(4)]
    rows, truth = [], []
    for pair in range(2):
        a = steps[2 * pair] / np.linalg.norm(steps[2 * pair])
        b = steps[2 * pair + 1] - (steps[2 * pair + 1] @ a) * a
        b = 0.94 * a + np.sqrt(1 - 0.94 ** 2) * b / np.linalg.norm(b)
        for centre in (a, b):
            rows += [centre + noise * rng.standard_normal(64) / 8 for _ in range(60)]
            truth += [pair] * 60
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int").repartition(3)
    x = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    n = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert set(n) == {119}
    got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(spark, table).collect()}
    assert got == {i: (119, 120 * truth[i]) for i in range(240)}


def test_vectors_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nndescent.near_duplicates(spark, table).count() == 0


# --------------------------------------------------------------------- 9 WARC

def page_rows():
    rnd = random.Random(6)
    big = "<p>" + "same payload " * 200 + "</p>"
    rows = [(i, f"http://x/{i}", "".join(rnd.choice("abc <>é") for _ in range(rnd.randint(0, 4000)))) for i in range(60)]
    rows += [(100, "u\r\nX: y", big), (103, None, big), (101, "u", big), (104, "u", "tiny"), (105, "u", "tiny"),
             (None, "u", big), (106, "u", None), (107, "u", ""), (108, "u", "long " * 400_000), (103, "again", big)]
    return rows


def test_bundles_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write_bundles(spark, pages, path, frame_bytes=4000, bundle_bytes=30_000)
    got = warc.read_bundles(spark, path).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, []).append(r)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        r = by_id[page_id][0]
        assert r.payload_bytes == len(raw) and r.payload_digest == hashlib.sha1(raw).hexdigest()
        if r.record_type == "response":
            assert bytes(r.payload) == raw and r.refers_to is None
        else:
            assert r.payload is None
    kinds = {k: {(r.record_type, r.refers_to) for r in v} for k, v in by_id.items()}
    assert kinds[100] == kinds[101] == {("revisit", 103)} and kinds[103] == kinds[None] == {("response", None)}
    assert kinds[104] == kinds[105] == {("response", None)}
    some = warc.read_bundles(spark, path, ids=[5, 108]).collect()
    assert sorted(r.page_id for r in some) == [5, 108] and len(bytes(max(some, key=lambda r: r.page_id).payload)) == 2_000_000


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc-plain")
    warc.write_bundles(spark, pages, path, frame_bytes=4000)
    bodies = [bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()]
    streamed = b"".join(zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(b) for b in bodies)
    assert streamed.count(b"WARC/1.1\r\n") == len(page_rows())
    reader = warc.BundleReader(bodies[0])
    assert len(reader.starts) > 3 and all(reader.frame(f)[o:o + n].startswith(b"WARC/1.1") for _, f, o, n in reader.index)
    with pytest.raises(ValueError):
        warc.BundleReader(bodies[0][:-1])


def test_bundles_of_an_empty_table(spark):
    path = scratch_path(spark, "warc-empty")
    warc.write_bundles(spark, spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_bundles(spark, path).count() == 0


# ------------------------------------------------------- links and components

@pytest.mark.parametrize("spread", [0.02, 0.15, 0.5])
def test_hot_bucket_loses_no_component(spark, spread):
    """One bucket with everything in it: same components as all pairs, though far
    fewer pairs are made.  Chains: each text is a changed copy of an earlier one."""
    rnd = random.Random(int(spread * 100))
    texts = ["".join(chr(0x800 + rnd.randrange(300)) for _ in range(60))]
    while len(texts) < 150:
        t = list(rnd.choice(texts))
        for _ in range(max(1, int(spread * len(t) * rnd.random()))):
            t[rnd.randrange(len(t))] = chr(0x800 + rnd.randrange(300))
        texts.append("".join(t))
    texts = list(dict.fromkeys(texts))
    members = spark.createDataFrame([(1, i, -1, len(t)) for i, t in enumerate(texts)], "bucket long, id long, prior long, size int")
    table = spark.createDataFrame(list(enumerate(texts)), "id long, seq string")
    groups = components.connected(spark, components.bucket_links(spark, members, table, 0.2))
    got = {r.node: r.component for r in groups.collect()}
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if banded_distance(texts[i], texts[j], 12) >= 0:
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert [got.get(i, i) for i in range(len(texts))] == parent


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.component for r in components.connected(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: p for x, p in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert components.connected(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_never_loses_a_key(spark):
    keys = [0, -1, 5, 2 ** 62, -2 ** 63, 12345678901]
    bits = components.wanted_filter(spark, spark.createDataFrame([(k,) for k in keys], "h long"), "h")
    assert components.maybe_wanted(bits.value, np.array(keys)).all()
    assert components.maybe_wanted(bits.value, np.arange(10 ** 6, 10 ** 6 + 1000)).mean() < 0.1


# ------------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, sf_dir)
        path = scratch_path(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() > 0
        assert name == "mixing" or docs.count() <= before
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert sum(r.length for r in rows if r.start == 0) > 0


def test_registered_names(spark):
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
