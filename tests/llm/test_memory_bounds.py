"""Cases that once needed much memory: many near copies of one line, and many windows between texts."""

from tests.llm import brute
from tripflow.llm import line_dedup
from tripflow.llm.decontaminate import contaminated


def test_many_variants_of_one_line(make_docs, words):
    rng = words.rng
    base = words(30).split()
    texts = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"v{k}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.removed_lines for r in line_dedup.remove_lines(make_docs(texts)).collect()}
    assert got == brute.lines_gone(list(enumerate(texts)), 8, 10, 1)


def test_variants_that_match_nothing_come_out_once_a_word(make_docs, words, monkeypatch):
    """Lines that resemble many others without matching any: what is sent on grows with the lines, not their pairs."""
    rng = words.rng
    sent = {}
    seen = line_dedup.settle

    def counted(df, name):
        out = seen(df, name)
        sent[name] = sent.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "settle", counted)
    monkeypatch.setattr(line_dedup, "SIDE", 32)
    monkeypatch.setattr(line_dedup, "FIRST", 1)
    base = words(20).split()
    rows = {}
    for n in (300, 600):
        texts = []
        for k in range(n):
            w = list(base)
            for p in rng.sample(range(20), 3):
                w[p] = f"v{k}x{p}"
            texts.append(" ".join(w))
        sent.clear()
        got = {r.doc_id: r.removed_lines for r in line_dedup.remove_lines(make_docs(texts)).collect()}
        assert got == brute.lines_gone(list(enumerate(texts)), 8, 10, 1)
        rows[n] = sum(sent.values())
    assert rows[600] < 2.4 * rows[300]


def test_windows_begin_in_their_text(spark, make_docs, words):
    """An item without its first words belongs to its own document, not to the one before."""
    item = words(30)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    cut = " ".join(item.split()[2:])
    docs = make_docs(["clean text", f"{cut} {words(5)}", "other clean text"])
    assert {r.doc_id for r in contaminated(docs.coalesce(1), bench).collect()} <= {1}
