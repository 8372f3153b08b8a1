"""Exact, substring, line and near-duplicate removal against plain versions."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.conftest import ODD
from tripflow.llm import line_dedup, ngram_join, substring_dedup, textnp
from tripflow.llm.components import components
from tripflow.llm.exact_dedup import drop_copies, exact_dedup


@pytest.fixture
def corpus(words):
    rng = words.rng
    base = [words(rng.randint(1, 60), rng.randint(1, 3)) for _ in range(60)]
    near = []
    for t in base[:30]:
        w = t.split(" ")
        for _ in range(rng.randint(1, 4)):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            near.append(" ".join(v))
    passage = words(30)
    shared = [f"{words(5)} {passage} {words(5)}" for _ in range(12)]
    return [*base, *near, *shared, *base[:10], *[base[0]] * 40, *ODD, None, "", "Word"]


def test_exact_dedup(make_docs, corpus):
    texts = [*corpus, "a  b", "a b", " a\tb\n"]
    got = {r.doc_id: r for r in exact_dedup(make_docs(texts)).collect()}
    groups = {}
    for d, t in enumerate(texts):
        bare = "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(bare, []).append((-len(t or ""), d))
    for bare, rows in groups.items():
        keep = min(rows)[1]
        for _, d in rows:
            r = got[d]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(rows), d == keep)
            assert r.text_sha256 == brute.sha(bare)
    assert len(got) == len(texts)


def test_exact_dedup_small_filter_and_repeated_rows(make_docs):
    docs = make_docs(["x", "x", "y", None, "z", "z"], ids=[1, 1, 2, None, None, None])
    for bits in (1 << 16, 1 << 10):
        rows = exact_dedup(docs, max_bits=bits).collect()
        assert sorted((r.text_sha256, r.group_size) for r in rows if r.kept) == sorted(
            [(brute.sha("x"), 2), (brute.sha("y"), 1), (brute.sha(""), 1), (brute.sha("z"), 2)]
        )
    assert exact_dedup(docs.limit(0)).count() == 0
    assert {r.doc_id for r in drop_copies(make_docs(["a", "b", "a"])).collect()} == {0, 1}


@pytest.mark.parametrize("size", [1, 4, 20])
def test_substring_dedup(make_docs, corpus, size):
    docs = make_docs(corpus)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs, size).collect()}
    want = brute.repeats(list(enumerate(corpus)), size)
    assert {d: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for d, r in got.items()} == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got.values())


def test_substring_dedup_small_parts(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART", 200)
    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", 50)
    got = substring_dedup.remove_repeats(make_docs(corpus).repartition(3), 4).collect()
    want = brute.repeats(list(enumerate(corpus)), 4)
    assert {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got} == want


def test_substring_dedup_null_and_repeated_ids(make_docs, words):
    text = " ".join("abcdefgh")
    got = substring_dedup.remove_repeats(make_docs([text, text, text], ids=[3, 3, None]), 4).collect()
    # the null id comes first; fully repeated rows are one document, and both lose what the null row has
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 8), (False, 8), (True, 0)]
    assert substring_dedup.remove_repeats(make_docs([text]).limit(0), 4).count() == 0
    # rows of one id, or of none, with other texts lose nothing of their own
    long, own = words(100), [f"u{k}" for k in range(100)]
    texts = [long, long, "short text here", " ".join(own), None, "", f"{' '.join(own[:50])} {long}", " ".join(own[60:])]
    ids = [1, 2, 2, 2, 2, None, None, None]
    got = {(r.doc_id, r.n_words): (r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(make_docs(texts, ids), 20).collect()}
    assert got[1, 100][0] == 100 and (2, 3) in got and got[2, 3] == (0, "short text here")
    assert got[None, 150] == (0, texts[6]) and got[None, 40] == (0, texts[7]) and got[None, 0] == (0, "")
    kept = [r.kept_text for r in substring_dedup.remove_repeats(make_docs(texts, ids), 20).filter("doc_id = 2 AND n_words = 100").collect()]
    assert sorted(kept) == sorted(["", " ".join(own[50:60])])


def test_substring_dedup_of_many_repeated_ids(make_docs, corpus):
    """Documents of one id are ordered by a hash of their text; against the plain version with ids in that order."""
    ids = [k // 3 for k in range(len(corpus))]
    docs = make_docs(corpus, ids)
    tie = {(r.doc_id, r.text): r.tie for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS tie").collect()}
    distinct = sorted({(d, tie[d, t], t) for d, t in zip(ids, corpus, strict=True)}, key=lambda x: x[:2])
    want = brute.repeats([(k, t) for k, (_, _, t) in enumerate(distinct)], 4)
    by_doc = {(d, t): want[k] for k, (d, _, t) in enumerate(distinct)}
    got = substring_dedup.remove_repeats(docs.repartition(3), 4).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got) == sorted(
        (d, *by_doc[d, t]) for d, t in zip(ids, corpus, strict=True)
    )


@pytest.mark.parametrize(("small", "side"), [(24, 1024), (2, 3)])
def test_line_dedup(make_docs, corpus, monkeypatch, small, side):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup, "SIDE", side)
    got = {r.doc_id: r for r in line_dedup.remove_lines(make_docs(corpus).repartition(3)).collect()}
    want = brute.lines_gone(list(enumerate(corpus)), 8, 10, 1)
    assert {d: r.removed_lines for d, r in got.items()} == want
    for d, t in enumerate(corpus):
        lines = [] if t is None else t.split("\n")
        assert got[d].n_lines == len(lines)
        kept = "\n".join(x for k, x in enumerate(lines) if k not in want[d])
        assert got[d].kept_text == (None if t is None else kept)


@pytest.mark.parametrize("least", [1, 3])
def test_line_dedup_of_short_lines(make_docs, corpus, least):
    texts = [*corpus, "w1", "w1 w1", "w1 w2", "w2\nw1 w2 w1", "w1 w2 w3", "Les.", "les.\n", "Les."]
    docs = make_docs(texts).repartition(3)
    got = {r.doc_id: r.removed_lines for r in line_dedup.remove_lines(docs, min_words=least).collect()}
    assert got == brute.lines_gone(list(enumerate(texts)), 8, 10, least)


def test_line_dedup_null_ids_and_empty(make_docs):
    docs = make_docs(["one two three", "one two three", "a b\none two three"], ids=[5, None, 5])
    got = sorted((r.doc_id or -1, r.removed_lines) for r in line_dedup.remove_lines(docs).collect())
    assert got == [(-1, []), (5, [0]), (5, [1])]
    assert line_dedup.remove_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_repeated_ids(make_docs, corpus):
    """Documents of one id are ordered by a hash of their text; against the plain version with ids in that order."""
    texts = ["one two three four five", "one two three four five", "quite another text of mine", *corpus, "short", None]
    ids = [1, 3, 3, *[k // 3 if k % 7 else None for k in range(len(corpus) + 2)]]
    docs = make_docs(texts, ids)
    tie = {(r.doc_id, r.text): r.tie for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS tie").collect()}
    count = {i: ids.count(i) for i in ids}
    key = lambda d, t: (d is not None, d or 0, tie[d, t] if count[d] > 1 else 0)
    distinct = sorted({(*key(d, t), d, t) for d, t in zip(ids, texts, strict=True)}, key=lambda x: x[:3])
    want = brute.lines_gone([(k, x[4]) for k, x in enumerate(distinct)], 8, 10, 1)
    by_doc = {(x[3], x[4]): want[k] for k, x in enumerate(distinct)}
    got = line_dedup.remove_lines(docs.repartition(3)).collect()
    assert sorted(((r.doc_id, r.removed_lines, r.kept_text) for r in got), key=str) == sorted(
        (
            (d, by_doc[d, t], None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in by_doc[d, t]))
            for d, t in zip(ids, texts, strict=True)
        ),
        key=str,
    )


@pytest.mark.parametrize(("block", "small"), [(4096, 24), (3, 2)])
@pytest.mark.parametrize(("size", "num", "den"), [(3, 9, 10), (5, 8, 10), (1, 1, 2), (2, 1, 1)])
def test_ngram_join(make_docs, corpus, monkeypatch, block, small, size, num, den):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "WARM", 48 if small > 4 else 1)
    got = ngram_join.linked_groups(make_docs(corpus), size, num, den).collect()
    want = brute.groups(list(enumerate(corpus)), size, num, den)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_ngram_join_ids_and_empty(make_docs, words):
    docs = make_docs(["a b c d", "a b c d", "x y z", "x y z", ""], ids=[4, 2, None, 9, 7])
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked_groups(docs).collect()}
    assert got == {(4, 2, 2), (2, 2, 2), (None, 1, None), (9, 1, None), (7, 0, 7)}
    assert ngram_join.linked_groups(docs.limit(0)).count() == 0
    # rows of one id with different texts are documents of their own
    a, b, c = words(30), words(31), words(32)
    docs = make_docs([a, b, a, b, b, c, None], ids=[1, 3, 5, 5, 6, 5, 5])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked_groups(docs).collect())
    assert got == sorted([(1, 28, 1), (3, 29, 3), (5, 28, 1), (5, 29, 3), (6, 29, 3), (5, 30, 5), (5, 0, 5)])
    kept = sorted((r.doc_id, r.text or "") for r in ngram_join.one_of_each_group(docs, 3, 9, 10).collect())
    assert kept == sorted([(1, a), (3, b), (5, c), (5, "")])


def passage_corpus(words):
    """Texts that share a passage: with own words, with few changes, with none."""
    rng = words.rng
    passage = words(22).split()
    texts = [" ".join([*passage, f"o{k}", f"p{k}"]) for k in range(60)]
    texts += [" ".join([f"q{k % 9}", *passage, f"r{k % 4}"]) for k in range(60)]
    other = [f"x{k}" for k in range(60)]
    for k in range(80):
        w = list(other)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = f"y{k % 30}"
        texts.append(" ".join(w))
    texts += [" ".join(passage[:n]) for n in range(10, 23)] + [" ".join(passage + passage[:n]) for n in range(5)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("block", "small"), [(4096, 24), (8, 4)])
@pytest.mark.parametrize(("num", "den"), [(9, 10), (8, 10), (1, 2)])
def test_ngram_join_of_passages(make_docs, words, monkeypatch, block, small, num, den):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "WARM", 48 if small > 4 else 1)
    texts = passage_corpus(words)
    got = ngram_join.linked_groups(make_docs(texts).repartition(3), 3, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.groups(list(enumerate(texts)), 3, num, den)


def test_one_of_each_group(make_docs, words):
    text = words(50)
    docs = make_docs([text, text + " more", words(50), words(40), text], ids=[3, 1, 8, 8, 1])
    got = ngram_join.one_of_each_group(docs).collect()
    assert sorted(r.doc_id for r in got) == [1, 8, 8]
    assert ngram_join.one_of_each_group(docs).columns == docs.columns


def test_components(spark, words):
    rng = words.rng
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 360)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(x, find(x)) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_pairs_many_words_at_once(monkeypatch):
    """Words of a few dozen lines are paired together, not one after the other; the lines are those of single steps."""
    texts = [f"rare{k} " + " ".join(f"a{k}b{v}x{p}" for p in range(9)) for k in range(60) for v in range(30)]
    ids = np.arange(len(texts), dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([ids, 0 * ids, pa.array(texts)], names=["id", "tie", "text"])
    held = SimpleNamespace(value=np.zeros(line_dedup.WIDTH, dtype=np.uint8))
    packed = pa.Table.from_batches(line_dedup._pack(1, 1, 20, 1, held, None)(iter([batch])))
    calls, possible = [], line_dedup.Met.possible

    def counted(met, i, j):
        calls.append(len(i))
        return possible(met, i, j)

    monkeypatch.setattr(line_dedup.Met, "possible", counted)
    found = line_dedup._partners(1, 20)(packed)
    assert len(calls) <= 3 and sum(calls) >= 60 * 30 * 29 // 2
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    alone = line_dedup._partners(1, 20)(packed)
    key = [(c, "ascending") for c in ("y_id", "x_id")]
    assert found.num_rows and found.sort_by(key).equals(alone.sort_by(key))


def test_line_dedup_hashes_words_by_eight_bytes(words):
    rng = words.rng
    texts = ["".join(rng.choice("aAbBzZ@[é \n\t") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [f"{'x' * n} {'X' * n} {'x' * (n - 1)}y" for n in (1, 7, 8, 9, 255, 256, 257, 264, 5000)]
    data, offsets = textnp.text_bytes(pa.array(texts))
    begin, end, _ = textnp.word_spans(data, offsets)
    want = [w for t in texts for w in t.encode().lower().split()]
    assert [bytes(data[a:b]).lower() for a, b in zip(begin, end, strict=True)] == want
    hashes = textnp.word_hashes(data, begin, end).tolist()
    assert len({*zip(want, hashes, strict=True)}) == len({*want}) == len({*hashes})
