"""Exact copies (6), near copies (9) and repeated passages (7) against brute force."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flowlens.llm import paragraphs as P
from flowlens.llm import parity_join as J
from flowlens.llm.components import components
from flowlens.llm.exact_dedup import exact_dedup, keep_one_copy
from tests.llm.cases import EDGE_ROWS, prose, words


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[bare])[3]
        out.append((i, keep, len(groups[bare]), i == keep, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups_on_edges(edge_docs, no_docs):
    got = sorted(map(tuple, exact_dedup(edge_docs).collect()), key=str)
    assert got == brute_exact([(i, t) for i, t, _ in EDGE_ROWS])
    assert exact_dedup(no_docs).count() == 0


def test_one_copy_stays_with_its_columns(edge_docs):
    kept = keep_one_copy(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    # 2 has more code points than 1; 6 is the longest blank text; 12 is there twice; 10 is no copy of 9
    assert sorted(ids, key=str) == sorted([2, 3, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16], key=str)


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_copies_of_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_copies(docs).collect()}
    assert got == brute_near([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_near_copies_on_edges(edge_docs, no_docs):
    got = J.near_copies(edge_docs).collect()
    want = brute_near([(i, t) for i, t, _ in EDGE_ROWS if i is not None])
    assert len(got) == len(EDGE_ROWS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(116, 1), (0, None)}
    assert J.near_copies(no_docs).count() == 0
    kept = J.keep_one_of_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {None} | {c for _, c in want.values()}


@pytest.mark.parametrize("block_rows", [4, 256])
def test_chains_of_near_copies(spark, monkeypatch, block_rows):
    """Chains whose ends are far apart, around shared passages: links must not hang on a bucket's least node."""
    monkeypatch.setattr(J, "BLOCK_ROWS", block_rows)
    rows = []
    for c in range(3):
        base = prose(100 + c, 90).split()
        for k in range(12):
            rows.append((100 * c + (7 * k) % 12, " ".join(base[: 90 - 4 * k] + prose(500 + c, 60).split()[: 4 * k])))
    shared = prose(900, 60)
    rows += [(1000 + k, shared + " " + prose(901 + k, 25)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_copies(docs).collect()}
    assert got == brute_near(rows)


def test_sketch_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 5, 60, 700):
        a = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 1 << 48, n, dtype=np.uint64))))
        x, y = (np.frombuffer(J.parity_sketch(s), np.uint8) for s in (a, b))
        short = min(len(x), len(y))
        apart = np.bitwise_count(J.fold_sketch(x, short) ^ J.fold_sketch(y, short)).sum()
        assert apart <= len(np.setxor1d(a, b))
        packed = J.set_batch(np.zeros(1, np.int64), a, np.array([0, len(a)])).column(3)[0].as_py()
        assert (J.elements_of(packed) == a).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(40)] + [(5, 5), (None, 3), (7, 6)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, **{200 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_reach_the_recall():
    b = P.bands_for(0.8, 0.999, 3)
    assert 1 - (1 - 0.8**3) ** b >= 0.999 > 1 - (1 - 0.8**3) ** (b - 1)


def test_repeated_passages_on_edges(edge_docs, no_docs):
    spans = collections.defaultdict(list)
    for r in P.repeated_spans(edge_docs).collect():
        spans[r.doc_id].append((r.first_word, r.first_word + r.n_words, r.keep_id))
    # 15 has the second line of 14 as its own second line; 16 has it inside a line
    assert (30, 90, 14) in spans[15]
    assert any(a < 100 and b > 40 and keep == 14 for a, b, keep in spans[16])
    assert 14 not in spans and 1 not in spans
    assert spans[3] and all(keep == 1 for _, _, keep in spans[3])
    assert not {4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None} & set(spans)
    assert P.repeated_spans(no_docs).count() == 0


def test_every_shared_run_of_50_words_is_found(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = collections.defaultdict(set)
    for r in docs.select("doc_id", "text").collect():
        n = 0
        for line in r.text.split("\n"):
            w = words(line)
            for k in range(len(w) - 49):
                seen[tuple(w[k : k + 50])].add((r.doc_id, n + k))
            n += len(w)
    spans = collections.defaultdict(list)
    for r in P.repeated_spans(docs).collect():
        spans[r.doc_id].append((r.first_word, r.first_word + r.n_words))
    shared = [v for v in seen.values() if len({i for i, _ in v}) > 1]
    assert shared
    for v in shared:
        left = {i for i, k in v if not any(a < k + 50 and b > k for a, b in spans[i])}
        assert len(left) <= 1


def wrapped(text, n, first=0):
    """The text's words in lines of n words, the first line of ``first``."""
    w = text.split()
    ends = [0, *range(first or n, len(w), n), len(w)]
    return "\n".join(" ".join(w[a:b]) for a, b in zip(ends, ends[1:]))


def test_passages_with_line_breaks(spark):
    short, across, other = prose(60, 60), prose(61, 51), prose(62, 46)
    rows = [
        (0, prose(70, 30) + "\n" + wrapped(short, 12)),
        (1, wrapped(short, 12) + "\n" + prose(71, 25)),
        (2, prose(72, 7) + " " + wrapped(short, 19, 5)),  # other line breaks
        (3, prose(73, 70) + " " + wrapped(across, 26) + " " + prose(74, 70)),  # from one long line into the next
        (4, prose(75, 60) + " " + wrapped(across, 30) + " " + prose(76, 60)),
        (5, None),
        (6, prose(77, 60) + " " + other),
        (7, prose(78, 40) + " " + " ".join(other.split()[:23])),  # the passage ends with one document
        (8, " ".join(other.split()[23:]) + " " + prose(79, 40)),  # and goes on in the next
    ]
    seen = collections.defaultdict(set)
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 48):
            seen[tuple(w[k : k + 49])].add((i, k))
    shared = [v for v in seen.values() if len({i for i, _ in v}) > 1]
    assert {i for v in shared for i, _ in v} == {0, 1, 2, 3, 4}
    spans = collections.defaultdict(list)
    for r in P.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(1)).collect():
        spans[r.doc_id].append((r.first_word, r.first_word + r.n_words, r.keep_id))
    assert set(spans) == {1, 2, 4}
    for v in shared:
        keep = min(v)[0]
        for i, k in v:
            assert i == keep or any(a < k + 49 and b > k and of == keep for a, b, of in spans[i])


def test_near_paragraphs_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    units = []
    for i, t in rows:
        n = 0
        for line in t.split("\n"):
            w = words(line)
            if len(w) >= P.LEAST_WORDS:
                units.append((i, n, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}))
            n += len(w)
    linked = set()
    for x, (i, a, s) in enumerate(units):
        for j, b, t in units[x + 1 :]:
            if 100 * len(s & t) >= 80 * len(s | t):
                linked |= {(i, a), (j, b)}
    got = P.repeats(docs).where(~F.col("is_part")).collect()
    found = {(r.doc_id, r.first_word) for r in got} | {(r.keep_id, r.keep_word) for r in got}
    assert found == linked


def test_repeated_rows_with_partners(spark):
    """Two near-equal texts, each in 2,000 rows of the same id, and a third id that holds both texts."""
    a = prose(40, 120)
    b = " ".join([*a.split()[:117], "another", "end"])
    rows = [(1, a)] * 2000 + [(2, b)] * 2000 + [(3, a), (3, b), (4, prose(41, 50)), (4, prose(41, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = J.near_copies(docs).groupBy("doc_id", "component_id").count().collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2000), (2, 1, 2000), (3, 1, 2), (4, 4, 2)]
    spans = [tuple(r) for r in P.repeated_spans(docs).select("doc_id", "keep_id").collect()]
    assert sorted(set(spans)) == [(2, 1), (3, 1)]
    assert J.keep_one_of_near_copies(docs).select("doc_id").distinct().count() == 2


def test_batches_are_bounded_in_bytes(spark):
    from flowlens.llm import common as C

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    C.package_reachable(spark)
    assert int(spark.conf.get(bound).rstrip("b")) == C.BATCH_BYTES
    spark.conf.set(bound, "1000")
    C.package_reachable(spark)
    assert int(spark.conf.get(bound).rstrip("b")) == 1000
    spark.conf.unset(bound)
    rows = C.package_reachable(spark).range(300).selectExpr("repeat('x', 100000) AS text")
    sizes = rows.mapInArrow(lambda bs: (__import__("pyarrow").RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
    assert max(r.n for r in sizes) <= 2 * C.BATCH_BYTES // 100_000


@pytest.mark.parametrize("most", [0, 250_000])
def test_one_copy_of_repeated_rows(spark, monkeypatch, most):
    """By broadcast and by shuffle: repeated rows, one id with two texts, null ids and texts."""
    from flowlens.llm import exact_dedup as E

    monkeypatch.setattr(E, "BROADCAST_KEYS", most)
    rows = [(1, "a b")] * 50 + [(1, "c"), (2, "ab"), (3, "a  b"), (4, "c"), (None, "d"), (None, "d"), (5, "d"), (None, None), (6, ""), (None, "only"), (None, "only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, keep_one_copy(docs).collect()), key=str)
    assert got == sorted([(3, "a  b"), (1, "c"), (5, "d"), (6, ""), (None, "only")], key=str)
