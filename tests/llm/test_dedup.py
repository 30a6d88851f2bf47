"""Repeated passages, near-duplicates by fingerprint and by embedding, against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from feedloom.llm import components, lattice, simhash
from feedloom.llm import repeats as repeats_module
from feedloom.llm.repeats import repeats, without_repeats
from llm import odd

VECTOR = "vec_id long, embedding array<float>, label int"


def test_repeated_words_equal_those_of_brute_force(spark):
    docs = odd.documents(spark)
    got = odd.as_counter(repeats(docs, ("lang",)), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter(odd.repeats([row[:2] for row in odd.odd_rows()]))


def test_repeats_within_and_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats_module, "CHUNK_BYTES", 2000)
    docs = odd.documents(spark).repartition(3)
    got = odd.as_counter(repeats(docs), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter(odd.repeats([row[:2] for row in odd.odd_rows()]))


def test_spans_are_maximal_and_stand_for_the_removed_words(spark):
    rows = repeats(odd.documents(spark)).collect()
    for row in rows:
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        assert all(a.end < b.start for a, b in zip(row.spans, row.spans[1:]))


def test_repeats_of_no_documents(spark):
    assert repeats(odd.documents(spark, [])).collect() == []


def test_texts_without_repeats_stay_as_they_are(spark):
    docs = odd.documents(spark)
    out = without_repeats(docs)
    assert out.columns == docs.columns
    kept = {(i, n): text for i, _, n, text in odd.repeats([r[:2] for r in odd.odd_rows()])}
    before = Counter((r.doc_id, r.text) for r in docs.collect())
    for row in out.collect():
        assert before[(row.doc_id, row.text)] or any(
            n and text == row.text for (i, n), text in kept.items() if i == row.doc_id)


def _groups(rows):
    prints = [(i, odd.simhash(text)) for i, text in rows]
    distinct = sorted({p for _, p in prints})
    links = [(a, b) for n, a in enumerate(distinct) for b in distinct[n:]
             if (a ^ b).bit_count() <= 4]
    group = odd.components(distinct, links)
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[group[p]] = min(smallest.get(group[p], i), i)
    return Counter((i, f"{p:016x}", smallest.get(group[p])) for i, p in prints)


def test_fingerprint_groups_equal_those_of_brute_force(spark):
    got = odd.as_counter(simhash.simhash_groups(odd.documents(spark)),
                         "doc_id", "fingerprint", "component_id")
    assert got == _groups([row[:2] for row in odd.odd_rows()])


@pytest.mark.parametrize("shard", [4, 1 << 14])
def test_links_across_shards(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "LEAF", 3)
    pick, base = random.Random(5), []
    for _ in range(12):
        seed = pick.getrandbits(64)
        base += [seed]
        for _ in range(6):
            near = seed
            for bit in pick.sample(range(64), pick.randint(1, 6)):
                near ^= 1 << bit
            base.append(near)
    keys = sorted(set(base))
    frame = spark.createDataFrame([(int(np.uint64(k).view(np.int64)),) for k in keys], "fp long")
    found = components.connected_components(simhash.links(frame))
    got = {int(np.int64(r.node).view(np.uint64)): r.component for r in found.collect()}
    links = [(a, b) for a in keys for b in keys if a < b and (a ^ b).bit_count() <= 4]
    want = odd.components(keys, links)
    linked = {k for pair in links for k in pair}
    assert set(got) == linked
    for a in linked:
        for b in linked:
            assert (got[a] == got[b]) == (want[a] == want[b])


def test_one_document_of_each_group_stays(spark):
    rows = odd.odd_rows()
    docs = odd.documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {(i, g) for i, _, g in _groups([row[:2] for row in rows])}
    want = sorted({g for i, g in groups if i == g and i is not None})
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_no_document_of_none_stays(spark):
    assert simhash.keep_first(odd.documents(spark, [])).collect() == []


def test_fingerprints_of_no_documents(spark):
    assert simhash.simhash_groups(odd.documents(spark, [])).collect() == []


def test_one_row_of_each_group_stays_where_ids_repeat_or_are_missing(spark):
    a, b, c, d = (odd.prose(300 + n, 60) for n in range(4))
    rows = [(1, a), (1, b), (2, c), (2, a), (None, b), (None, d), (None, d), (None, f"{d} tail"),
            (None, None), (3, c), (2, c), (None, "")]
    docs = odd.documents(spark, [(i, t, "en", f"s{n}", 0) for n, (i, t) in enumerate(rows)])
    kept = [(r.doc_id, r.text) for r in simhash.keep_first(docs).collect()]
    assert {(1, a), (1, b), (2, c)} < set(kept)
    assert sum(i is None and t in (d, f"{d} tail") for i, t in kept) == 1
    assert sum(not t for _, t in kept) == 1
    assert len(kept) == 5


def test_components_of_long_chains_and_repeated_links(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(400, 400), (500, 501), (501, 500), (0, 1)]
    frame = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(frame).collect()}
    want = odd.components({n for link in links for n in link}, links)
    assert {n: c for n, c in got.items() if n != 400} == {
        n: c for n, c in want.items() if n != 400}


def test_stars_connect_what_pairs_connect():
    pick = np.random.default_rng(3)
    a, b = pick.integers(0, 200, 150), pick.integers(0, 200, 150)
    x, y = components.forest(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert odd.components(nodes, zip(a.tolist(), b.tolist())) == odd.components(
        nodes, zip(x.tolist(), y.tolist()))


def _vectors():
    pick = np.random.default_rng(7)
    rows, number = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            seed = pick.normal(size=24)
            for spread in (0, 0, 0.05, 0.2, 0.3):
                one = (seed + spread * pick.normal(size=24) * 1.2) * pick.uniform(0.5, 2)
                rows.append((number, [float(np.float32(v)) for v in one], label))
                number += 1
    rows += [(900, None, 0), (901, [0.0] * 24, 0), (902, [1.0, None] + [0.0] * 22, 0),
             (903, [float("nan")] * 24, 0), (904, [float("inf")] + [0.0] * 23, 0), (905, [], 0),
             (906, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (None, [1.0, 2.0], 0),
             (908, [1.0], 0), (-5, [2.0, 4.0], 0)]
    return rows


def _vector_groups(rows):
    def usable(v, label):
        return label is not None and bool(v) and all(
            x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(v, w):
        v, w = np.array(v, float), np.array(w, float)
        return float(v @ w / math.sqrt(v @ v) / math.sqrt(w @ w))

    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i + 1, n)
             if usable(*rows[i][1:]) and usable(*rows[j][1:]) and rows[i][2] == rows[j][2]
             and len(rows[i][1]) == len(rows[j][1])
             and cosine(rows[i][1], rows[j][1]) >= 0.93]
    group = odd.components(range(n), links)
    degree = Counter(k for link in links for k in link)
    out = Counter()
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None]
        smallest = min(ids, default=None)
        out[(rows[i][0], degree[i], smallest, smallest is not None and rows[i][0] == smallest)] += 1
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_embedding_groups_equal_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rows = _vectors()
    frame = spark.createDataFrame(rows, VECTOR).selectExpr("*", "'x' as node", "1 as size")
    got = odd.as_counter(lattice.embedding_groups(frame),
                         "vec_id", "n_links", "component_id", "kept")
    assert got == _vector_groups(rows)


def test_no_vectors(spark):
    assert lattice.embedding_groups(spark.createDataFrame([], VECTOR)).collect() == []


def test_e8_points_are_nearest():
    pick = np.random.default_rng(1)
    at = pick.normal(size=(200, 8)) * 2
    point = lattice.nearest_e8(at)
    doubled = np.rint(2 * point).astype(int)
    assert (np.abs(2 * point - doubled) == 0).all()
    assert (((doubled % 2).sum(axis=1) % 8) == 0).all() and ((point.sum(axis=1) % 2) == 0).all()
    around = point[:, None, :] + lattice.neighbours()[None]
    own = ((at - point) ** 2).sum(axis=1)
    assert (own[:, None] <= ((at[:, None, :] - around) ** 2).sum(axis=2) + 1e-9).all()


def test_recall_at_the_threshold():
    pick = np.random.default_rng(2)
    a = pick.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = pick.normal(size=(2000, 64))
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.931 * a + math.sqrt(1 - 0.931 ** 2) * z
    (own_a, near_a), (own_b, near_b) = lattice.cells(a), lattice.cells(b)
    found = ((own_a == own_b) | (near_a == own_b[:, :, None]).any(axis=2)
             | (near_b == own_a[:, :, None]).any(axis=2)).any(axis=1)
    assert found.mean() >= 0.97
