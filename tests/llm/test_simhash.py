"""SimHash links against plain versions."""

import random

import numpy as np
import pytest
import xxhash

from tests.llm import brute
from tests.llm.conftest import ODD
from tripflow.llm import simhash
from tripflow.llm.simhash import Plan, class_links, fingerprint, flips, group_bits, near_groups


def plain_fingerprint(text, size=3):
    w = brute.WORDS.findall((text or "").translate(brute.LOWER))
    shingles = [w] if 0 < len(w) < size else [w[k : k + size] for k in range(len(w) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Smallest fingerprint of each one's component."""
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = sorted(parent)
    for i, x in enumerate(some):
        for y in some[:i]:
            if (x ^ y).bit_count() <= 3:
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in some}


def plain_components(docs):
    fps = [plain_fingerprint(t) for _, t in docs]
    root = plain_groups(fps)
    least = {}
    for (d, _), f in zip(docs, fps, strict=True):
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return sorted(((d, f"{f:016x}", least.get(root[f])) for (d, _), f in zip(docs, fps, strict=True)), key=str)


@pytest.fixture
def texts(words):
    rng = words.rng
    base = [words(rng.randint(1, 60), rng.randint(1, 2)) for _ in range(60)]
    near = []
    for t in [words(120) for _ in range(8)]:
        for _ in range(12):
            w = t.split()
            w[rng.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    return [*base, *near, *base[:10], *[base[0]] * 40, *ODD, "Ünïcode Wörter ÄÖ", "ABC Def gHI", "abc def ghi", "x" * 70_000]


def collected(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_near_groups(make_docs, texts):
    docs = list(enumerate(texts))
    got = near_groups(make_docs(texts).repartition(3))
    assert collected(got) == plain_components(docs)


def test_ids_and_empty(make_docs, words):
    a, b = words(40), words(50)
    ids = [5, 5, None, 3, None, 9]
    texts = [a, b, b, a, "a text of its own for no id", None]
    got = near_groups(make_docs(texts, ids))
    assert collected(got) == plain_components(list(zip(ids, texts, strict=True)))
    none = near_groups(make_docs(texts, ids).limit(0))
    assert none.count() == 0 and none.columns == got.columns
    alone = near_groups(make_docs([None, "", " \n"], [8, 2, 4])).collect()
    assert {(r.fingerprint, r.component_id, r.group_size) for r in alone} == {("0" * 16, 2, 3)}


def test_long_texts_in_slices(monkeypatch, words):
    text = words(500)
    want = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "WORDS", 7)
    assert fingerprint(text) == want and fingerprint("two words") == plain_fingerprint("two words")


def clustered(n_balls, per_ball, singles, seed=11):
    """Fingerprints in dense balls, and some with correlated bits around them."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n_balls):
        centre = rng.getrandbits(64)
        for _ in range(per_ball):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
            out.add(f)
    for _ in range(singles):
        f = rng.getrandbits(64)
        out.add(f & ~0xFFFF | (0xABCD if rng.random() < 0.6 else f & 0xFFFF))
    return sorted(out)


@pytest.mark.parametrize("layout", [None, 0, 1, 2])
@pytest.mark.parametrize("cell", [2048, 16])
def test_links_join_as_all_links_would(spark, monkeypatch, layout, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    if layout is not None:
        monkeypatch.setattr(simhash, "LAYOUTS", simhash.LAYOUTS[layout : layout + 1])
    fps = clustered(6, 60, 200)
    rows = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    links = class_links(spark.createDataFrame(rows, "fp long").repartition(3)).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = r.a % 2**64, r.b % 2**64
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {f: find(f) for f in fps} == plain_groups(fps)
    if cell == 2048:
        assert len(links) < 8 * len(fps)


def test_thresholds_are_lossless_and_uneven():
    fps = np.array(clustered(3, 80, 400), dtype=np.uint64)
    bits = simhash.bits_of(fps).astype(np.int64)
    blocks = group_bits(bits.T @ bits, len(fps))
    assert sorted(b for block in blocks for b in block) == list(range(64))
    values = simhash.block_values(fps, blocks).astype(np.int64)
    counts = np.stack([np.bincount(values[:, b], minlength=1 << 16) for b in range(4)])
    near = simhash.within(counts[0])
    v = int(values[0, 0])
    distance = np.bitwise_count(values[:, 0].astype(np.uint64) ^ np.uint64(v))
    assert near[v].tolist() == [int((distance == d).sum()) for d in range(4)]
    plan = Plan(blocks, counts, len(fps))
    uneven = 0
    for layout in simhash.LAYOUTS:
        t, _ = plan.thresholds(fps, layout)
        assert ((t + 1).sum(axis=1) == 4).all() and t.min() >= -1
        uneven += len(np.unique(t, axis=0)) > 1
    assert uneven
    assert len(flips(16, 2)) == 1 + 16 + 120


def test_correlated_bits_share_a_block():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    tied = [3, 9, 20, 33, 41, 60]
    bits[:, tied] = bits[:, [3]] ^ (rng.random((4000, len(tied))) < 0.05)
    blocks = group_bits(bits.T @ bits, len(bits))
    assert any(set(tied) <= set(b) for b in blocks)


def test_many_near_copies_make_linear_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 64)
    sizes = {}
    for n in (500, 1000):
        fps = clustered(1, n, 0)
        rows = [(int(np.uint64(f).view(np.int64)),) for f in fps]
        sizes[n] = class_links(spark.createDataFrame(rows, "fp long")).count() / len(fps)
    assert sizes[1000] < 1.6 * sizes[500]
