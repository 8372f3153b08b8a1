"""The registered text queries against DuckDB, and the pipeline against plain stages."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import ODD
from tripflow.llm import oracle
from tripflow.llm.decontaminate import normal_words
from tripflow.llm.queries import queries


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_sql(spark, duck, sf_small, name):
    got = queries()[name](spark, sf_small)
    want = duck.execute(E.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(str, want.fetchall()))


def test_all_registered():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names}
    assert "pipeline" in names and names <= set(E.queries())


def write(spark, folder, docs, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_against_plain_stages(spark, make_docs, words, tmp_path):
    rng = words.rng
    item = words(25)
    base = [words(rng.randint(8, 40), rng.randint(1, 3)) for _ in range(40)]
    near = [t + " more" for t in base[:8]]
    texts = [*base, *near, f"{words(9)}\n{words(9)} {item} {words(9)}", *ODD[:-1], "w1 w2 " * 20_000, base[3]]
    folder = write(spark, tmp_path, make_docs(texts), [(1, item), (2, None)])
    docs = list(enumerate(texts))
    kept = [(d, t) for d, t in docs if t and any(c.isalpha() for c in t)]
    gone = brute.lines_gone(kept, 8, 10, 3)
    after = []
    for d, t in kept:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d])
        if not gone[d] or left.strip():
            after.append((d, left))
    roots = brute.groups(after, 5, 8, 10)
    after = [(d, t) for d, t in after if roots[d][1] == d]
    after = [(d, t) for d, t in after if brute.leaks(normal_words(t), item.split(), 0.2) is None]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert {d: r.text for d, r in got.items()} == dict(after)
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(corpus_pipeline.vocabulary_path())
    for r in got.values():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.n_chars == len(r.text)


def test_line_stage_removes_short_lines(spark, make_docs, words):
    """Lines of one or two distinct words, and lines without blanks, go like any others."""
    han = "山中有水水中有月"
    texts = ["Les.", f"{words(9)}\nLes.", "And ornd.\nno no no no", f"And ornd.\n\n{words(9)}\nNO no", han, f"{han}\n{words(5)}", "\n\n"]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, make_docs(texts).repartition(3), "").collect()}
    gone = brute.lines_gone(list(enumerate(texts)), 8, 10, 1)
    assert gone == {0: [], 1: [1], 2: [], 3: [0, 3], 4: [], 5: [0], 6: []}
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in enumerate(texts)}
    assert got == want


def test_stages_on_an_empty_table(spark, make_docs, tmp_path):
    folder = write(spark, tmp_path, make_docs(["x"]).limit(0), [(1, "one two three four five six")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
