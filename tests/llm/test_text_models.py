"""Language, toxicity, decontamination, BPE, sharding and chat formatting."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import ODD
from tripflow.llm import bpe, chat_format, decontaminate, language_id, sharding, toxicity
from tripflow.llm.common import vocabulary_path
from tripflow.llm.queries import queries

SENTENCES = {
    "en": "the house of the king was on the hill and the river ran with a sound that they heard",
    "de": "das haus des königs stand auf dem hügel und der fluss lief mit einem klang den sie hörten",
    "fr": "la maison du roi était sur la colline et la rivière coulait avec un bruit que nous entendions",
}


def test_language_id(make_docs):
    rng = random.Random(1)
    texts, langs = [], []
    for k in range(60):
        lang = ("en", "de", "fr")[k % 3]
        w = SENTENCES[lang].split()
        texts.append(" ".join(rng.choice(w) for _ in range(12)).capitalize() + ".")
        langs.append(lang)
    docs = make_docs(texts, langs=langs)
    profiles = language_id.train_profiles(docs)
    assert set(profiles) == {"en", "de", "fr"}
    test = make_docs([*texts, *ODD], langs=[*langs, *[None] * len(ODD)])
    got = {r.doc_id: r for r in language_id.identify(test, profiles, keep=["doc_id", "lang"]).collect()}
    assert sum(got[k].lang_pred == langs[k] for k in range(60)) >= 59
    assert [got[60 + k].lang_pred for k in range(4)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.train_profiles(docs.limit(0)) == {}
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}
    kept = language_id.accepted(test)
    assert kept.columns == test.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(60))
    assert {r.doc_id for r in kept.collect()}.isdisjoint({60, 61, 62, 63})


def test_accepted_drops_what_resembles_no_language(spark, sf_small, make_docs):
    """Unlearned scripts and random letters go, also with a language as label; the real texts and short ones stay."""
    rng = random.Random(3)
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").filter("lang IS NOT NULL").collect()
    real = [(r.text, r.lang) for r in rows if r.text and any(c.isalpha() for c in r.text)]
    alphabets = ["".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz"]
    junk = []
    for alphabet, blanks in itertools.product(alphabets, (0, 1)):
        for n in (150, 400, 3000):
            text = "".join(" " if blanks and rng.random() < 0.17 else rng.choice(alphabet) for _ in range(n))
            junk += [(text, None), (text[::-1], "en")]
    short = [("Yes.", None), ("Да", None), ("word", "en")]
    listed = [*real, *short, *junk]
    docs = make_docs([t for t, _ in listed], langs=[lang for _, lang in listed])
    kept = {r.doc_id for r in language_id.accepted(docs).collect()}
    assert kept == set(range(len(real) + len(short)))


def test_language_id_bundles_letter_by_letter(monkeypatch):
    """Bundles by counts and matrices equal the sum of bound n-grams, also over pieces."""
    text = "Déjà vu, 12 naïve Straße!"
    plain = language_id.Bundler(64, 3)
    codes = plain.letters(text)
    vectors = {c: language_id.letter_vectors(np.array([c]), 64)[0] for c in codes.tolist()}
    want = np.zeros(64)
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        want += np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
    assert np.array_equal(plain.bundles([text])[0][0], want)
    monkeypatch.setattr(language_id, "PIECE", 5)
    monkeypatch.setattr(language_id, "CELLS", 7)
    got, n = language_id.Bundler(64, 3).bundles(["x", text, None, text])
    assert np.array_equal(got[1], want) and np.array_equal(got[3], want) and n[2] == 0


def test_language_query_held_out(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang")
    rows = queries()["op2_language_id"](spark, sf_small).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_toxicity(spark, make_docs, words):
    rng = words.rng
    texts, labels = [], []
    for k in range(400):
        t = words(40).split()
        if k % 8 == 0:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(["zorgal", "zorgaff", "idiot", "blurpo"]))
            labels.append((k, 1))
        elif k % 2:
            labels.append((k, 0))
        texts.append(" ".join(t))
    docs = make_docs([*texts, *ODD])
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, marks)
    assert len(model.labels.accuracy) == toxicity.VOTERS
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(texts) + len(ODD)
    assert all((got[k] >= 0.5) == (k % 8 == 0) for k in range(400))
    assert got[401] < 0.5


def test_toxicity_without_labels_or_rows(spark, make_docs):
    docs = make_docs(["you idiot", "fine day", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for training in (docs, docs.limit(0)):
        model = toxicity.train_toxicity(training, none)
        scores = [r.score for r in toxicity.score_toxicity(docs, model).collect()]
        assert len(scores) == 3 and all(0 <= s <= 1 for s in scores)


def test_label_model_finds_accuracies_and_correlations():
    """Votes drawn from known rates; two voters copy each other."""
    rng = np.random.default_rng(3)
    counts = {}
    for _ in range(6000):
        y = rng.random() < 0.2
        votes = [rng.random() < (0.8 if y else 0.05) for _ in range(6)]
        bits = sum(int(v) << k for k, v in enumerate(votes))
        copied = rng.random() < (0.6 if y else 0.1)
        bits |= int(copied) << 6 | int(copied) << 7 | int(not any(votes)) << 12
        key = (bits, int(y) if rng.random() < 0.1 else -1)
        counts[key] = counts.get(key, 0) + 1
    model = toxicity.fit_label_model(counts)
    assert abs(model.prior - 0.2) < 0.04
    assert all(abs(a - 0.8) < 0.1 for a in model.accuracy[:6])
    assert (6, 7) in [(a, b) for a, b, _ in model.correlations]


def test_label_model_against_the_enumerated_joint():
    """Four voters of known rates: posteriors equal Bayes' rule over the whole joint distribution."""
    prior, one, zero = 0.3, (0.9, 0.7, 0.6, 0.8), (0.1, 0.2, 0.05, 0.3)
    counts, joint = {}, {}
    for bits in range(16):
        fired = [bits >> v & 1 for v in range(4)]
        for y, rates, share in ((1, one, prior), (0, zero, 1 - prior)):
            joint[bits, y] = share * np.prod([r if f else 1 - r for r, f in zip(rates, fired, strict=True)])
        for y in (0, 1):  # a tenth has labels, of which a fifth is wrong
            for label, right in ((y, 0.8), (1 - y, 0.2)):
                key = (bits, label)
                counts[key] = counts.get(key, 0) + 1e5 * 0.1 * right * joint[bits, y]
            counts[bits, -1] = counts.get((bits, -1), 0) + 1e5 * 0.9 * joint[bits, y]
    model = toxicity.fit_label_model(counts, rounds=200)
    for bits in range(16):
        want = joint[bits, 1] / (joint[bits, 0] + joint[bits, 1])
        assert abs(model.posterior[bits] - want) < 0.03
        for label, (a, b) in ((1, (0.8, 0.2)), (0, (0.2, 0.8))):
            both = want * a / (want * a + (1 - want) * b)
            assert abs(model.target(bits, label) - both) < 0.05
    assert abs(model.prior - prior) < 0.02 and abs(model.marks[0] - 0.2) < 0.03 and abs(model.marks[1] - 0.8) < 0.03


def test_toxicity_outvotes_wrong_labels(spark, make_docs, words):
    """All rows labelled, a fifth of the labels wrong: the classifier is fitted to posteriors, not to labels."""
    rng = words.rng
    texts, labels = [], []
    for k in range(600):
        t = words(30).split()
        if k % 3 == 0:
            for w in ("idiot", "zorgal", "zorgaff", "blurpo"):
                t.insert(rng.randrange(len(t)), w)
        texts.append(" ".join(t))
        labels.append((k, int((k % 3 == 0) != (k % 5 == 0))))
    model = toxicity.train_toxicity(make_docs(texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    strong = max(range(1 << toxicity.VOTERS), key=lambda p: model.labels.posterior[p])
    assert model.labels.target(strong, 0) > 0.9 and 0.1 < 1 - model.labels.marks[1] < 0.35
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(make_docs(texts), model).collect()}
    assert sum((got[k] >= 0.5) == (k % 3 == 0) for k in got) >= 0.98 * len(got)


def test_toxicity_score_by_hand(make_docs):
    """Repeated rows, ties and a whole score."""
    lexicon = toxicity.Lexicon({"=idiot": 0, "4idio": 1, "=fool": 2, "5stupi": 3}, {0: 0})
    model = toxicity.ToxicityModel(lexicon, np.array([1.5, 0.25, -2.0, 1.0]), -0.5, None)
    texts = ["You IDIOT, idiot!", "idiotic fool", "a stupid day", "", None, "You IDIOT, idiot!"]
    sums = [1.5 + 0.25, 0.25 - 2.0, 1.0, 0, 0, 1.75]
    got = sorted((r.doc_id, round(r.score, 12)) for r in toxicity.score_toxicity(make_docs(texts, [0, 1, 2, 3, 4, 0]), model).collect())
    want = [round(1 / (1 + np.exp(0.5 - x)), 12) for x in sums]
    assert got == sorted(zip([0, 1, 2, 3, 4, 0], want, strict=True))


def test_toxicity_query_held_out(spark, sf_small):
    rows = queries()["op1_toxicity"](spark, sf_small).collect()
    assert {"doc_id", "held_out", "score", "predicted"} <= set(rows[0].asDict())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)


def test_decontamination(spark, make_docs, words):
    rng = words.rng
    items = [words(rng.randint(8, 40)) for _ in range(25)]
    bench = spark.createDataFrame(
        [(k, t) for k, t in enumerate(items)] + [(90, "too short"), (91, None), (None, items[0]), (92, items[0]), (93, "")],
        "item_id long, text string",
    )
    texts = []
    for k in range(120):
        w = items[k % 25].split()
        for _ in range(rng.randint(0, max(1, len(w) // 4))):
            kind, at = rng.randrange(3), rng.randrange(len(w))
            if kind == 0:
                w[at] = f"x{rng.randrange(99)}"
            elif kind == 1:
                w.insert(at, f"y{rng.randrange(99)}")
            elif len(w) > 5:
                del w[at]
        before, after = words(rng.randint(0, 12)).split(), words(rng.randint(0, 12)).split()
        texts.append(" ".join([*before, *w, *after]).upper().replace(" ", ", ", 2))
    texts += [words(60) for _ in range(40)] + ODD
    docs = make_docs(texts)
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, bench).collect()}
    want = {}
    for d, t in enumerate(texts[:160]):
        w = decontaminate.normal_words(t)
        for k, item in [*enumerate(items), (92, items[0])]:
            best = brute.leaks(w, item.split(), 0.2)
            if best is not None:
                want[d, k] = best
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert all(got[key] >= want[key] for key in got)
    assert all(key in got for key, far in want.items() if far == 0)
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in got}


def test_decontamination_blocks_and_empty(spark, make_docs, words):
    items = [words(12) for _ in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = make_docs([*items, items[0] + " " + items[1]], ids=[*range(9), None])
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    cut = {tuple(r) for r in decontaminate.contaminated(docs, bench, block_words=20).collect()}
    assert whole == cut and len({(r[0], r[1]) for r in whole}) >= 11
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == 10


def edited(item, rng):
    """The words of an item after as many substitutions, insertions and deletions as it may have."""
    w, edits = list(item), len(item) // 5
    for k in range(edits // 3):
        w[rng.randrange(len(w))] = f"x{k}"
        w.insert(rng.randrange(len(w)), f"y{k}")
        del w[rng.randrange(len(w))]
    return w


def test_decontamination_walks_by_length(words):
    """Few long items among many short ones get the walks that they need themselves."""
    rng = words.rng
    listed = [(k, words(15).split()) for k in range(200)] + [(900 + k, words(120).split()) for k in range(2)]
    items = decontaminate.Items(listed, 0.2)
    items.plan(0.97, 48)
    finder = decontaminate.Finder(items)
    long_ = dict(listed[200:])
    texts = [(k, " ".join(edited(w, rng))) for k, w in long_.items() for _ in range(100)]
    got = {(text, item) for text, item, *_ in finder.search([t for _, t in texts])}
    assert sum((row, k) in got for row, (k, _) in enumerate(texts)) >= 0.94 * len(texts)
    assert items.repeats[decontaminate.length_class(120)] > items.repeats[decontaminate.length_class(15)]


@pytest.mark.parametrize("first", [True, False])
def test_decontamination_at_the_start_of_texts(words, first):
    """Lengths mixed in one class, passages at the very start, in the first text of a batch or a later one."""
    rng = words.rng
    listed = [(k, words(n).split()) for k, n in enumerate([44, 50] * 6)]
    assert decontaminate.length_class(44) == decontaminate.length_class(50)
    items = decontaminate.Items(listed, 0.2)
    items.plan(0.97, 48)
    finder = decontaminate.Finder(items)
    hits = tried = 0
    for k, w in listed:
        for _ in range(25):
            near = " ".join(edited(w, rng))
            texts = [near, "other words"] if first else ["other words", near]
            hits += (0 if first else 1, k) in {(t, i) for t, i, *_ in finder.search(texts)}
            tried += 1
    assert hits >= 0.95 * tried


def test_decontamination_exact_beyond_the_walks(spark, make_docs, words):
    """Classes of lengths that ``max_repeats`` walks don't bring to the recall are searched exactly."""
    rng = words.rng
    items = [words(n).split() for n in (5, 9, 10, 14, 31, 80, 80, 150)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    texts = []
    for k in range(48):
        w = edited(items[k % len(items)], rng)
        at = rng.randrange(len(w))
        w = w[1:] if k % 5 == 0 else w[:at] + ["z"] + w[at:] if k % 5 == 1 else w
        texts.append(" ".join([*words(rng.randint(0, 9)).split(), *w, *words(rng.randint(0, 9)).split()]))
    texts += [words(60), *ODD]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(make_docs(texts), bench, max_repeats=1).collect()}
    want = {}
    for d, t in enumerate(texts[:49]):
        for k, item in enumerate(items):
            best = brute.leaks(decontaminate.normal_words(t), item, 0.2)
            if best is not None:
                want[d, k] = best
    assert got == want


def test_edit_distances():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 4, (60, 9)), rng.integers(0, 4, (60, 9))
    assert decontaminate.edit_distances(a, b).tolist() == [
        brute.edit_distance(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)
    ]


def random_texts(n):
    rng = random.Random(5)
    letters = "  \n\t'sstreveldm éß中1a A!!　\x1c\x85aaa--==\U0001f600́٣"
    out = []
    for _ in range(n):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.2:
            t = t[:9] + "<|endoftext|>" + t[9:]
        if rng.random() < 0.2:
            t += rng.choice(["'s", "'ll", "'re's", "''s", " 's", "\n's", "a'd "])
        if rng.random() < 0.2:
            t += "".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(15))
        if rng.random() < 0.1:
            t += rng.choice("ab -=\n!.") * rng.randint(1, 300)
        out.append(t)
    return out


def test_bpe_equals_the_library(make_docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    texts = [*random_texts(1500), *ODD]
    coded = bpe.encode_texts(make_docs(texts), vocabulary_path(), decoded=True)
    got = {r.doc_id: r for r in coded.collect()}
    for d, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[d].ids, "<u4").tolist() == ids
        assert got[d].decoded == library.decode(ids, skip_special_tokens=False)
    back = bpe.decode_texts(coded.select("doc_id", "ids"), vocabulary_path()).collect()
    assert all(r.decoded == (texts[r.doc_id] or "") for r in back)


def test_bpe_pieces(monkeypatch):
    texts = [t * 5 for t in random_texts(60)]
    whole = bpe.Encoder(bpe.load_tables(vocabulary_path())).encode(texts)
    monkeypatch.setattr(bpe, "PIECE", 17)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    assert bpe.Encoder(bpe.load_tables(vocabulary_path())).encode(texts) == whole


def test_bpe_query(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in queries()["op5_bpe"](spark, sf_small).collect():
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("load", [None, 1.2])
def test_sharding(make_docs, words, load):
    texts = [words(words.rng.randint(0, 30)) for _ in range(500)] + ODD
    rows = sharding.shard_rows(make_docs(texts), 7, load=load).collect()
    assert len(rows) == len(texts)
    shards = {}
    for r in rows:
        t = texts[r.doc_id] or ""
        assert r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode())
        shards.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    if load is None:
        assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1 and len(shards) == 7
    else:
        assert max(map(len, shards.values())) <= -(-load * len(texts) // 7)


def test_sharding_against_a_plain_walk(make_docs, words):
    """Row by row: each goes clockwise from its arc to the first shard with room that it hasn't seen."""
    texts = [words(words.rng.randint(0, 9)) for _ in range(400)]
    docs = make_docs(texts).selectExpr("*", "pmod(xxhash64(doc_id), 4096) AS point")
    points = {r.doc_id: r.point for r in docs.collect()}
    lanes = {
        r.doc_id: r.lane
        for r in sharding.shard_rows(make_docs(texts), 5, vnodes=8)
        .selectExpr("doc_id", "pmod(xxhash64(doc_id, text_crc32, size), 16) AS lane")
        .collect()
    }
    nodes = sharding.ring(5, 8)
    arcs = [[] for _ in nodes]
    for d in sorted(points, key=lambda d: (points[d], lanes[d], d)):
        arcs[next((k for k, (p, _) in enumerate(nodes) if p >= points[d]), 0)].append(d)
    room, slots, want = sharding.capacities(len(texts), 5, None), [0] * 5, {}
    for hop in range(5):
        for a, waiting in enumerate(arcs):
            order = list(dict.fromkeys(nodes[(a + k) % len(nodes)][1] for k in range(len(nodes))))
            while waiting and slots[order[hop]] < room[order[hop]]:
                want[waiting.pop(0)] = (order[hop], slots[order[hop]])
                slots[order[hop]] += 1
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(make_docs(texts), 5, vnodes=8).collect()}
    assert got == want


def test_sharding_moves_little(make_docs):
    docs = make_docs([f"t{k}" for k in range(3000)])
    before, after = (
        {r.doc_id: r.shard for r in sharding.shard_rows(docs, n, load=1.25).collect()} for n in (10, 11)
    )
    assert sum(before[d] != after[d] for d in before) < 3000 * 0.3
    assert sharding.shard_rows(docs.limit(0), 4).count() == 0


def test_sharding_null_and_repeated_ids(make_docs):
    rows = sharding.shard_rows(make_docs(["a", "a", None, "b", "b"], ids=[None, None, None, 1, 1]), 2).collect()
    assert sorted(r.shard for r in rows).count(0) in (2, 3)
    assert len({(r.shard, r.slot) for r in rows}) == 5


def cheapest(roles, costs):
    best = None
    for path in itertools.product(*[[(to, merge) for to in range(3) for merge in (False, True)] for _ in roles]):
        state, cost = chat_format.START, 0
        for role, (to, merge) in zip(roles, path, strict=True):
            gaps = chat_format.insertions(state, to)
            if merge and state != to or not merge and gaps is None:
                break
            cost += costs.merge if merge else costs.insert * len(gaps)
            cost += costs.relabel * (role != to)
            state = to
        else:
            cost += costs.insert * len(chat_format.endings(state))
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("costs", [chat_format.Costs(), chat_format.Costs(5, 2, 3)])
def test_chat_format(spark, costs):
    rng = random.Random(2)
    names = ["system", "user", "assistant", "tool", None, " User "]
    convs = {k: [rng.choice(names) for _ in range(rng.randint(1, 5))] for k in range(60)}
    long = [rng.choice(names) for _ in range(400)]
    rows = [(k, i, r, f"t{i}", "x", 1) for k, c in convs.items() for i, r in enumerate(c)]
    rows += [(5000, i, r, f"b{i}", "x", 1) for i, r in enumerate(long)] + [(None, None, "user", None, "x", 1)]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, fragment string, position int"
    ).repartition(5)
    price = {"keep": 0, "merge": costs.merge, "relabel": costs.relabel, "merge_relabel": costs.merge + costs.relabel}
    seen = []
    for parts in (1, 4, 50):
        fixed = chat_format.format_chats(turns, costs, parts=parts).collect()
        assert len(fixed) == len(rows)
        seen.append(sorted(map(str, fixed)))
        total = {}
        for r in fixed:
            total[r.conv_id] = total.get(r.conv_id, 0) + price[r.action] + costs.insert * r.inserted
        for k, c in convs.items():
            assert total[k] == cheapest([chat_format._role(r) for r in c], costs)
    assert seen[0] == seen[1] == seen[2]
    rendered = {r.conv_id: r.rendered for r in chat_format.render_conversations(spark.createDataFrame(fixed)).collect()}
    for text in rendered.values():
        order = [m.split("\n")[0] for m in text.split("<|im_start|>")[1:]]
        order = order[1:] if order[0] == "system" else order
        assert order == ["user", "assistant"] * (len(order) // 2) and order
        assert text.count("<|im_start|>") == text.count("<|im_end|>")
    assert chat_format.format_chats(turns.limit(0), costs).count() == 0
