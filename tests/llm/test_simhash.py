import random

import numpy as np
import pytest
import xxhash

from tests.llm.cases import AWKWARD, documents, prose
from tillgrain.llm import simhash


def slow_fingerprint(text):
    """Bit by bit, from the contract."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, ids):
    """Smallest id reachable over fingerprints at most four bits apart."""
    label = list(range(len(fps)))
    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4)
        low = {label[j] for j in near}
        target = min(low)
        label = [target if x in low else x for x in label]
    least = {}
    for i, x in enumerate(label):
        least[x] = min(least.get(x, ids[i]), ids[i])
    return [least[x] for x in label]


def near_copies(seed, n, words=80):
    rng, base = random.Random(seed), prose(seed, words).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = "changed" + str(rng.randrange(99))
        out.append(" ".join(own))
    return out


def test_fingerprint_equals_the_definition():
    for text in [*AWKWARD[:9], prose(5, 300), "One two", "One two three four", "One\ttwo\nthree four five"]:
        assert simhash.fingerprint(None if text is None else text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("parts", [None, 2, 3, 4])
def test_components_equal_all_pairs(spark, monkeypatch, parts):
    if parts:
        monkeypatch.setattr(simhash, "number_of_parts", lambda total: parts)
    texts = [*AWKWARD, *(prose(i, 1 + i % 40) for i in range(200))]
    for seed in range(4):
        texts += near_copies(seed, 60)
    texts += [texts[20]] * 5
    found = {r.doc_id: r for r in simhash.digests(documents(spark, texts)).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    wanted = slow_components(fps, list(range(len(texts))))
    assert [found[i].fingerprint for i in range(len(texts))] == [f"{fp:016x}" for fp in fps]
    assert [found[i].component_id for i in range(len(texts))] == wanted


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 20)
    texts = near_copies(3, 150) + near_copies(4, 50)
    found = {r.doc_id: r.component_id for r in simhash.digests(documents(spark, texts)).collect()}
    wanted = slow_components([slow_fingerprint(t) for t in texts], list(range(len(texts))))
    assert [found[i] for i in range(len(texts))] == wanted


def test_thresholds_cover_the_distance():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    parts = simhash.correlated_parts(simhash.pair_counts(fps), len(fps), 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    chunks = [c for p in parts for c in simhash.chunks_of(p)]
    histograms = [np.bincount(v, minlength=256) for v in simhash.part_values(fps, chunks)]
    plan = simhash.Plan(parts, histograms, len(fps))
    assert (plan.units(fps).sum(axis=0) == simhash.DISTANCE + 1).all()


def test_links_of_large_and_small_buckets_agree():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 6).astype(np.uint64)
    fps = np.unique(rng.choice(base, 300) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    roles = rng.integers(1, 4, len(fps)).astype(np.int8)
    a, b = simhash.small_links(fps, roles, np.full(len(fps), len(fps)))
    small = simhash.spanning(a, b, len(fps))
    large = simhash.spanning(*simhash.large_links(fps, roles), len(fps))
    assert [x.tolist() for x in small] == [x.tolist() for x in large]


def test_empty_table_and_null_ids(spark):
    assert simhash.digests(documents(spark, [])).count() == 0
    rows = [(None, "one two three four"), (7, "one two three four"), (None, "zz")]
    found = simhash.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(None, 7), (7, 7), (None, None)}
