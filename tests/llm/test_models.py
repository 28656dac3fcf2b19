"""Quality (1), scoring (2), mixing (3), toxicity (4) and language (5) against brute force and held-out rows."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm import language as L
from flowlens.llm import lm_score as S
from flowlens.llm import mixing as M
from flowlens.llm import quality as Q
from flowlens.llm import toxicity as T
from tests.conftest import SF_MID
from tests.llm.cases import EDGE_ROWS, words

N_EDGE = len(EDGE_ROWS)


class KneserNey:
    """The quality model over plain dictionaries."""

    def __init__(self, texts):
        tri = collections.Counter()
        for t in texts:
            w = ["<s>", "<s>", *t]
            tri.update(zip(w, w[1:], w[2:]))
        bi = collections.Counter(k[1:] for k in tri)
        uni = collections.Counter(k[1] for k in bi)
        self.orders = [self._order(c) for c in (tri, bi)]
        d = self._discounts(uni)
        total = sum(uni.values())
        self.unseen = sum(d[min(n, 3) - 1] for n in uni.values()) / total / (len(uni) + 1)
        self.uni = {w: (n - d[min(n, 3) - 1]) / total + self.unseen for w, n in uni.items()}

    @staticmethod
    def _discounts(counts):
        n1, n2, n3, n4 = (sum(1 for c in counts.values() if c == i) for i in (1, 2, 3, 4))
        if not n1 or not n2:
            return 0.5, 0.75, 0.9
        y = n1 / (n1 + 2 * n2)
        d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9
        return [min(max(v, 0.05), i + 0.95) for i, v in enumerate(d)]

    def _order(self, counts):
        d = self._discounts(counts)
        total, freed = collections.Counter(), collections.Counter()
        for k, n in counts.items():
            total[k[:-1]] += n
            freed[k[:-1]] += d[min(n, 3) - 1]
        return counts, d, total, freed

    def p(self, gram):
        if len(gram) == 1:
            return self.uni.get(gram[0], self.unseen)
        counts, d, total, freed = self.orders[3 - len(gram)]
        lower = self.p(gram[1:])
        context = gram[:-1]
        if context not in total:
            return lower
        n = counts.get(gram, 0)
        return (n - d[min(n, 3) - 1] if n else 0.0) / total[context] + freed[context] / total[context] * lower

    def bits(self, w):
        w = ["<s>", "<s>", *w]
        return -sum(math.log2(self.p(tuple(w[k : k + 3]))) for k in range(len(w) - 2))


def test_kneser_ney_losses(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: words(r.text) for r in docs.select("doc_id", "text").collect()}
    train = [i for i in rows if i % 3 == 0]
    brute = KneserNey([rows[i] for i in train])
    model = Q.train(docs.where("doc_id % 3 = 0").select("doc_id", "text"))
    got = Q.with_loss(docs.select("doc_id", "text"), model).collect()
    for r in got:
        assert r.n_words == len(rows[r.doc_id])
        assert r.bits == pytest.approx(brute.bits(rows[r.doc_id]), rel=1e-4)


def test_losses_with_frequent_and_unnumbered_words(spark, small, monkeypatch):
    """Few words numbered and small slots: frequent words spread over several, other words told by hash."""
    monkeypatch.setattr(Q, "VOCABULARY", 60)
    monkeypatch.setattr(Q, "SLOT_BYTES", 10_000)
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 150").select("doc_id", "text")
    docs = docs.union(docs.select(F.col("doc_id") + 1000, F.concat(F.lit("of the " * 20), F.substring("text", 1, 60))))
    rows = {r.doc_id: words(r.text) for r in docs.collect()}
    brute = KneserNey([rows[i] for i in rows if i % 3 == 0])
    model = Q.train(docs.where("doc_id % 3 = 0"), Q._text_bytes(docs))
    assert model.slots > 8 and not model.names.closed and 0 < len(model.names.hashes) <= 60 and len(model.names.hot) >= 2
    got = Q.with_loss(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.bits == pytest.approx(brute.bits(rows[r.doc_id]), rel=1e-4)


def test_quality_deals_little(spark, small):
    """What is dealt to slots: each place of a text once, in few bytes (each n-gram's key, counts and documents took over 15 a word)."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    model = Q.train(docs.where("doc_id % 7 = 0"), Q._text_bytes(docs))
    names = spark.sparkContext.broadcast(model.names)
    dealt = docs.mapInArrow(Q._chunks(names, model.slots, "text"), Q._CHUNK_SCHEMA).agg(F.sum(F.octet_length("data"))).first()[0]
    n = docs.select(F.sum(F.size(F.split("text", r"\s+")))).first()[0]
    assert dealt < 7 * n


def test_probabilities_sum_to_one():
    texts = [[w.encode() for w in t.split()] for t in ("a b a c", "b a b", "c c a b a", "d a b c")]
    brute = KneserNey(texts)
    for context in (("<s>", "<s>"), (b"a", b"b"), (b"zz", b"a")):
        total = sum(brute.p((*context, w)) for w in brute.uni)
        assert total + brute.p((*context, b"unseen")) == pytest.approx(1.0)


def test_quality_keeps_trusted_and_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] >= 0.98 and kept[0] <= 0.45


def test_quality_counts_all_trusted_text(spark):
    """1,600 trusted documents of one language, each of one word of its own: all of the training half are in the model."""
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    judge, _ = Q.fit(docs, labels)
    trained = Q.trusted_ids(labels, 0).count()
    assert trained > 700
    assert judge.model.entries == 5 * trained  # a trigram, and a bigram and a word in and at the end of a document


def test_quality_on_edges(edge_docs, edge_labels, no_docs, no_labels):
    got = Q.quality(edge_docs, edge_labels).collect()
    assert len(got) == N_EDGE
    assert all(r.kept and r.perplexity is None for r in got if r.n_words == 0)
    assert Q.quality(edge_docs, no_labels).where("kept").count() == N_EDGE
    assert Q.quality(no_docs, edge_labels).count() == 0
    kept = Q.keep_good(edge_docs, edge_labels)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def brute_difference(rows, targets, vocabulary=None):
    docs = [(i, words(t)) for i, t in rows]
    uni, bi = ([collections.Counter(), collections.Counter()] for _ in range(2))
    for i, w in docs:
        for k in (0, 1) if i in targets else (0,):
            v = ["<s>", *w] if w else []
            uni[k].update(v)
            bi[k].update(zip(v, v[1:]))
    size = len(set(uni[0]) - {"<s>"}) + 2
    total = [sum(u.values()) + size for u in uni]
    out = []
    for i, w in docs:
        v, bits = ["<s>", *w], [0.0, 0.0]
        own, own_first = collections.Counter(zip(v, v[1:])), collections.Counter(v[:-1])
        for k in (0, 1):
            held = k == 0 or i in targets
            for a, b in zip(v, v[1:]):
                p = (uni[k][b] + 1) / total[k]
                bits[k] -= math.log2((bi[k][a, b] - held * own[a, b] + S.MU * p) / (uni[k][a] - held * own_first[a] + S.MU))
        out.append((i, len(w), bits[1] / len(w) if w else None, bits[0] / len(w) if w else None))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), str(r[1]))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert (g[2] is None) == (w[2] is None)
        if w[2] is not None:
            assert g[2] == pytest.approx(w[2], rel=1e-4) and g[3] == pytest.approx(w[3], rel=1e-4)
            assert g[4] == pytest.approx(g[2] - g[3], abs=1e-9)


def test_cross_entropy_difference(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    trusted = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1")
    rows, targets = [tuple(r) for r in docs.select("doc_id", "text").collect()], {r.doc_id for r in trusted.collect()}
    same(S.cross_entropy_difference(docs, trusted).collect(), brute_difference(rows, targets))


def test_cross_entropy_on_edges(edge_docs, edge_labels, no_docs, no_labels):
    trusted = edge_labels.where("quality = 1")
    want = brute_difference([(i, t) for i, t, _ in EDGE_ROWS], {1, 2, 5, 7})
    same(S.cross_entropy_difference(edge_docs, trusted).collect(), want)
    assert S.cross_entropy_difference(edge_docs, no_labels).count() == N_EDGE
    assert S.cross_entropy_difference(no_docs, trusted).count() == 0


def test_every_trusted_document_is_in_the_target_model(spark):
    """More trusted documents than the 20,000 of the former sample: the losses are those of a model of them all."""
    rows = [(i, f"w{i % 11} w{i % 7} w{i % 3}") for i in range(21_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.cross_entropy_difference(docs, docs.select("doc_id").where("doc_id < 20800"))
    want = {w[0]: w for w in brute_difference(rows, set(range(20_800)))}
    for r in got.where("doc_id % 300 = 0 or doc_id >= 20800").collect():
        assert r.target_bits == pytest.approx(want[r.doc_id][2], rel=1e-5)


def test_rates_reach_the_targets(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    rows = M.mix(docs, labels).toPandas()
    assert len(rows) == docs.count() and (rows["rate"] >= 0).all()
    total = rows["n_tokens"].sum()
    for d, share in M.TARGETS.items():
        assert (rows["rate"] * rows["n_tokens"] * rows[f"p_{d}"]).sum() / total == pytest.approx(share, abs=1e-3)


def test_rates_are_the_least_squares_solution(spark):
    rng = np.random.default_rng(1)
    n, p = rng.integers(1, 50, 60), rng.dirichlet([0.4, 0.4, 0.4], 60)
    rows = [(int(a), [float(v) for v in q]) for a, q in zip(n, p)]
    members = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    target = np.array([0.7, 0.25, 0.05])
    steps, scale = M.fit_rates(members, target)
    rate = np.array([r[0] for r in members.select(M.rate(steps, scale)).collect()])
    have = np.array([r[1] for r in members.select(M.rate(steps, scale), F.struct("n_tokens", "posterior")).collect()], dtype=object)
    total = sum(r * m[0] * np.array(m[1]) for r, m in zip(rate, have)) / n.sum()
    assert np.abs(total - target).max() < 1e-3 and (rate >= 0).all()


def test_classifier_learns_from_all_labelled_documents(spark):
    """4,000 documents of each domain, each told by one of 2,000 words of its domain: a part of them would leave words unknown."""
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.concat_ws("-", F.lit("w"), F.col("id") % 4000).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4000 < 2000, "clean").otherwise("junk").alias("domain"))
    model = M.fit_classifier(docs, labels)
    assert model.domains == ["clean", "junk"]
    got = M.memberships(docs, model).join(labels, "doc_id").select(F.avg((F.col("posterior")[0] > 0.5).eqNullSafe(F.col("domain") == "clean").cast("int"))).first()[0]
    assert got > 0.95  # words may share a bucket


def test_mixing_on_edges(edge_docs, edge_labels, no_docs, no_labels):
    rows = M.mix(edge_docs, edge_labels)
    assert rows.count() == N_EDGE and rows.where("n_tokens = 0 and rate != 1").count() == 0
    assert M.mix(edge_docs, no_labels).count() == N_EDGE
    assert M.mix(no_docs, edge_labels).count() == 0
    out = M.with_rates(edge_docs, edge_labels)
    assert out.columns == [*edge_docs.columns, "mix_rate"] and out.where("mix_rate <= 0").count() == 0


def test_toxicity_of_held_out_rows(spark):
    """At this size (about 300 toxic texts) the ranking of held-out rows must already be good."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = T.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.7)).all()
    rank = rows["score"].rank()
    pos = rows["toxic"] == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.9
    assert (rows["predicted"][~pos] == 1).mean() < 0.03


def test_gradients_of_the_network():
    texts = pa.array(["a b c d e f", "b c x y z", "q a b"])
    w = T.words_of(*A.bytes_of(texts))
    at, _, _ = T.windows(w.starts)
    number = np.where(at >= 0, w.number[at], len(w.hashes))
    y = np.array([1, 0, 1], np.float32)
    net = T.Network(w.hashes)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    def loss():
        p = T.sigmoid(net.logits(net.inputs(w), number))
        return -np.log(np.where(y > 0, p, 1 - p)).mean()
    before = {k: v.copy() for k, v in net.p.items()}
    g2 = {k: np.full_like(v, 1e12) for k, v in net.p.items()}  # so large that a step is the gradient, scaled
    drop, T.DROP = T.DROP, 0.0
    try:
        net.step(w, number, y, np.random.default_rng(0), g2)
    finally:
        T.DROP = drop
    moved = {k: (before[k] - net.p[k]) * 1e6 / T.RATE for k in before}
    net.p = before
    for name, cell in (("w", 3), ("a", 2), ("Uf", (1, 4)), ("Wb", (2, 9)), ("cf", 5)):
        old = net.p[name][cell]
        net.p[name][cell] = old + 1e-2
        up = loss()
        net.p[name][cell] = old - 1e-2
        down = loss()
        net.p[name][cell] = old
        assert moved[name][cell] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4)


def test_windows_cover_texts_and_overlap():
    starts = np.array([0, 0, 5, 5 + 24, 29 + 25, 54 + 100])
    at, row, first = T.windows(starts)
    assert np.diff(first).tolist() == [0, 1, 1, 2, 8]
    for i in range(5):
        assert set(at[row == i].ravel()) - {-1} == set(range(starts[i], starts[i + 1]))


def test_toxicity_on_edges(edge_docs, edge_labels, no_docs, no_labels):
    rows = T.toxicity(edge_docs, edge_labels)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == N_EDGE and rows.where("score is null or score < 0 or score > 1").count() == 0
    assert T.toxicity(edge_docs, no_labels).where("score = 0 and predicted = 0").count() == N_EDGE
    assert T.toxicity(no_docs, edge_labels).count() == 0


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = L.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(rows) > 100
    assert (rows["lang_pred"] == rows["lang"]).mean() > 0.97
    assert rows["score"].between(0, 1).all()


def test_language_on_edges(edge_docs, no_docs):
    rows = L.language_id(edge_docs).collect()
    assert len(rows) == N_EDGE
    by_text = {t: r for (i, t, _), r in zip(EDGE_ROWS, rows)}
    for t in (None, "", " \t\n\x0b\x0c\r ", "12 34 -- !!"):
        assert all(r.lang_pred == "und" and r.score == 0 for (_, x, _), r in zip(EDGE_ROWS, rows) if x == t), by_text
    assert all(r.lang_pred in {"en", "de", "fr", "es"} for (_, x, _), r in zip(EDGE_ROWS, rows) if x and any(c.isalpha() for c in x))
    assert L.language_id(no_docs).count() == 0


def test_characters_are_lower_case_letters():
    text = "AÉ漢😀ß1 Ñİ"
    data, offsets = A.bytes_of(pa.array([text, "b"]))
    cp, starts = L.characters(data, offsets)
    assert starts.tolist() == [0, len(text), len(text) + 1]
    assert "".join(map(chr, cp)).startswith("aé漢 ß  ñ")


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 400)
    logits = np.eye(3)[np.where(rng.random(400) < 0.7, y, rng.integers(0, 3, 400))] * 20
    loss = lambda t: -np.log(L.softmax(logits / t)[np.arange(400), y]).mean()
    t = L.temperature(logits, y)
    assert t > 1 and loss(t) <= min(loss(t * 1.05), loss(t / 1.05)) + 1e-9
