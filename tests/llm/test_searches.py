"""Benchmark passages (8), token counts (10), the registered queries and the pipeline."""

import random

import duckdb
import pytest

import corpus_pipeline as C
from flowlens.llm import decontaminate as D
from flowlens.llm import token_counts as K
from flowlens.llm.queries import ORACLE, QUERIES
from tests.llm.cases import EDGE_ROWS, prose, words


def test_token_counts_are_longest_matches(spark, small, edge_docs, no_docs):
    pieces = set(K.read_vocabulary())
    longest = max(map(len, pieces))

    def brute(text):
        w, n = words(text, low=False), 0
        for word in w:
            word, i = b" " + word, 0
            while i < len(word):
                size = next((k for k in range(min(longest, len(word) - i), 1, -1) if word[i : i + k] in pieces), 1)
                i, n = i + size, n + 1
        return len(w), n

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in K.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: brute(t) for i, t in rows}
    edges = [(r.n_words, r.n_tokens) for r in K.token_counts(edge_docs).collect()]
    assert edges == [brute(t) for _, t, _ in EDGE_ROWS]
    assert K.token_counts(no_docs).count() == 0


def test_automaton_with_deep_failure_links():
    import numpy as np

    pieces = [b"abcde", b"bcx", b"ab", b"cd", b"abcd", b" a"]
    a = K.Automaton(pieces)
    known = set(pieces)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdex") for _ in range(rng.randint(1, 14))).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    last = np.cumsum([len(t) for t in texts])
    got = a.lengths(data, last - [len(t) for t in texts], last)
    for t, n in zip(texts, got):
        t, want = b" " + t, 0
        while t:
            t, want = t[next((k for k in range(5, 1, -1) if t[:k] in known), 1) :], want + 1
        assert n == want


def brute_overlaps(docs, items):
    """Every alignment of every item with every document."""
    found = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            own = words(x)
            if len(own) < D.LEAST_WORDS:
                continue
            run = min(D.RUN, len(own))
            for shift in range(-len(own) + run, len(w) - run + 1):
                a, b = max(0, -shift), min(len(own), len(w) - shift)
                equal = [w[k + shift] == own[k] for k in range(a, b)]
                least = run if len(own) < 12 else D.SHARE * run
                if any(sum(equal[k : k + run]) >= least for k in range(len(equal) - run + 1)):
                    found[d, i] = max(found.get((d, i), (0,)), (sum(equal), -(a + shift), b - a))
    return {(d, i, -at, n, e) for (d, i), (e, at, n) in found.items()}


def passages():
    rng = random.Random(8)
    items = [(k, prose(50 + k, n)) for k, n in enumerate((30, 45, 18, 13, 9, 8, 5))] + [(7, None), (8, ""), (None, prose(1, 30))]
    docs = [(0, prose(200, 80)), (1, None), (2, "")]
    for k, (_, text) in enumerate(items[:7]):
        w = text.split()
        docs.append((10 + k, prose(300 + k, 20) + " " + "".join(c.upper() if c.isascii() else c for c in text) + " " + prose(400 + k, 15)))
        if len(w) >= 18:  # a substitution in seven words
            docs.append((20 + k, prose(310 + k, 9) + " " + " ".join("zz" if j % 7 == 3 else x for j, x in enumerate(w))))
            docs.append((30 + k, " ".join(w[-24:]) + " " + prose(320 + k, 30)))
        docs.append((40 + k, " ".join(w[: len(w) // 3]) + " " + prose(330 + k, 60)))
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("block", [100, D.BLOCK_WORDS])
def test_substituted_passages(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_WORDS", block)
    docs, items = passages()
    got = D.benchmark_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute_overlaps(docs, [x for x in items if x[0] is not None])
    assert {tuple(r) for r in got.collect()} == want
    assert {d for d, *_ in want} >= {10, 11, 12, 13, 14, 15, 20, 21, 22, 30, 31}


def overlaps(text, item):
    """What the index finds of one item in one text, without Spark."""
    import pyarrow as pa

    from flowlens.llm import arrays as A

    _, _, h, starts = A.words(*A.bytes_of(pa.array([text])))
    return D.Index(pa.table({"item_id": pa.array([1], pa.int64()), "text": [item]})).overlaps(h, starts)


def test_every_accepted_substitution_is_seeded():
    rng = random.Random(5)
    around = prose(500, 25)
    for n in (12, 13, 20, 26, 45):
        item = prose(510 + n, n)
        w = item.split()
        runs = [[j for j in range(n) if j % period == phase] for period in range(2, 13) for phase in range(period)]
        runs += [rng.sample(range(n), rng.randint(3, 3 * n // 10 + 1)) for _ in range(60)]
        for gone in runs:
            text = around + " " + " ".join("zz" if j in gone else x for j, x in enumerate(w)) + " " + around
            got = {(0, *x[1:]) for x in overlaps(text, item)}
            assert got == brute_overlaps([(0, text)], [(1, item)]), (n, gone)


def test_items_cut_at_document_ends():
    item, around = prose(520, 40), prose(521, 30)
    w = item.split()
    for k, found in ((13, False), (14, True), (17, True), (19, True)):
        assert bool(overlaps(" ".join(w[-k:]) + " " + around, item)) == found
        assert bool(overlaps(around + " " + " ".join(w[:k]), item)) == found


def test_decontamination_on_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, " ".join(EDGE_ROWS[0][1].split()[10:60])), (2, None)], "item_id long, text string")
    got = D.benchmark_overlaps(edge_docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (3, 1), (None, 1)}
    assert D.benchmark_overlaps(edge_docs, items.limit(0)).count() == 0
    assert D.benchmark_overlaps(no_docs, items).count() == 0
    kept = D.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _ in EDGE_ROWS} - {1, 2, 3}


def test_queries_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    got = QUERIES[name](spark, small)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_pipeline_stages_chain(spark, small):
    """The result is what the operators' own tables say, stage by stage."""
    from flowlens.llm.exact_dedup import exact_dedup
    from flowlens.llm.parity_join import near_copies
    from flowlens.llm.quality import quality

    docs, labels, benchmark = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mixing"]
    keep = {r.doc_id for r in quality(docs, labels).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(keep))
    keep = {r.doc_id for r in exact_dedup(left).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(keep))
    keep = {r.doc_id for r in near_copies(left).where("doc_id = component_id").collect()}
    items = [tuple(r) for r in benchmark.collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    keep -= {d for d, *_ in brute_overlaps([(i, rows[i]) for i in keep], items)}
    got = C.run(spark, small)
    assert got.columns == [*docs.columns, "mix_rate"]
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= keep and len(ids) >= 0.9 * len(keep)
