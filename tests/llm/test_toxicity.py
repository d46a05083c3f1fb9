import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobmart.llm import toxicity
from jobmart.llm.toxicity import _index, fit, monotone, terms_of, toxicity_of
from tests.llm.conftest import prose


def test_terms():
    assert terms_of("(Idiots!)") == ["idiots", "idi*", "idio*", "idiot*"]
    assert terms_of("...") == [] and terms_of("ab") == ["ab"]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for k in range(400):
        bad = k % 5 == 0
        text = prose(k, 40) + (f" you zork{k % 3} and blarg" if bad else " fine day")
        rows.append((k, text, int(bad)))
    rows += [(1000, None, 1), (1001, "", 0), (1002, "no label", None), (None, "zork1 blarg", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def random_index(seed: int, n: int = 700, n_terms: int = 30):
    rng = np.random.default_rng(seed)
    terms = [np.sort(rng.choice(n_terms, rng.integers(1, 6), replace=False)) for _ in range(n)]
    counts = [rng.integers(1, 4, len(t)) for t in terms]
    label = (rng.random(n) < 0.4).astype(int)
    weights = rng.uniform(0.1, 4, n_terms)
    names = pa.array([str(t) for t in range(n_terms)], pa.large_string())
    return _index(terms, counts, label, list(range(n)), names, weights, np.array([2.0, 1.0]), 0.2, 0.05), terms, counts, label


def dense_vector(at, counts, weights):
    out = np.zeros(len(weights))
    out[at] = (1 + np.log(counts)) * weights[at]
    return out / np.linalg.norm(out)


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_and_votes_are_exact(seed):
    index, terms, counts, label = random_index(seed)
    rng = np.random.default_rng(seed + 50)
    dense = np.array([dense_vector(t, c, index.weights) for t, c in zip(terms, counts)])
    for k in range(60):
        left_out = int(rng.integers(len(terms))) if k % 2 else None
        at = np.sort(rng.choice(30, rng.integers(1, 7), replace=False))
        n = rng.integers(1, 4, len(at))
        cosine = dense @ dense_vector(at, n, index.weights)
        if left_out is not None:
            cosine[index.ids[left_out]] = 0
        least = np.sort(cosine)[-toxicity.NEIGHBOURS]
        want = {e for e in range(len(terms)) if cosine[e] > 0 and cosine[e] >= least - 1e-9}
        near, found = index.nearest(at, index.vector(at, n), left_out)
        assert {index.ids[e] for e in near} == want
        assert found == pytest.approx(sorted(cosine[list(want)], reverse=True))
        vote = sum(cosine[e] ** 2 * (label[e] == 1) for e in want) + 0.5 * 0.2
        assert index.votes(near, found) == pytest.approx(vote / (0.5 + sum(cosine[e] ** 2 * (1 if label[e] else 2) for e in want)))


def plain_terms(text):
    out = Counter()
    for word in (text or "").split():
        core = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower()
        out.update([core] * bool(core) + [f"{core[:k]}*" for k in range(3, 9) if k < len(core)])
    return out


def test_score_same_as_brute_force(spark, labelled):
    """Vocabulary, frequencies, factors, vectors, neighbours and votes once more, in plain Python."""
    rows = [r for r in labelled.collect() if r.toxic is not None and r.doc_id is not None]
    own = [plain_terms(r.text) for r in rows]
    df = Counter(t for r in labelled.collect() for t in plain_terms(r.text))
    pos = Counter(t for r, o in zip(rows, own) if r.toxic for t in o)
    n = Counter(t for o in own for t in o)
    total, positive = len(rows), sum(r.toxic for r in rows)
    p, weight, texts = positive / total, {}, labelled.count()
    for t in n:
        a, b = pos[t], n[t] - pos[t]
        ratio = 2 * ((a * math.log(a / (n[t] * p)) if a else 0) + (b * math.log(b / (n[t] * (1 - p))) if b else 0))
        lean = min(1, max(0, ratio / (2 * math.log(len(n))))) if a > n[t] * p else 0
        weight[t] = (math.log((1 + texts) / (1 + df[t])) + 1) * (toxicity.FLOOR + (1 - toxicity.FLOOR) * lean**6)

    def vector(counts):
        v = {t: (1 + math.log(c)) * weight[t] for t, c in counts.items() if t in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    index = fit(labelled)
    vectors = [vector(o) for o in own]
    for text in (prose(77, 30) + " blarg", prose(78, 60), "zork7 " + prose(79, 10)):
        v = vector(plain_terms(text))
        cosine = sorted(((sum(x * e.get(t, 0) for t, x in v.items()), r.toxic, r.doc_id) for e, r in zip(vectors, rows)), reverse=True)
        near = [c for c in cosine if c[0] > 0 and c[0] >= cosine[14][0] - 1e-9]
        vote = (0.5 * p + sum(c * c * y for c, y, _ in near)) / (0.5 + sum(c * c for c, _, _ in near))
        row, at, counts = toxicity.term_counts(pa.array([text]), index.vocabulary)
        found, nearness = index.nearest(at, index.vector(at, counts))
        assert sorted(index.ids[e] for e in found) == sorted(d for _, _, d in near)
        assert index.votes(found, nearness) == pytest.approx(vote)
        got = spark.createDataFrame([(text,)], "text string").select(toxicity_of(spark, index)("text").alias("f")).first().f
        assert got.score == pytest.approx(np.interp(vote, *index.knots))


def test_repeated_ids_and_labels(spark):
    rows = [(k, f"clean words {prose(k, 20)}") for k in range(150)] + [(500 + k, f"blarg {prose(k, 20)}") for k in range(50)]
    rows += [(500, "another text of 500"), (500, "and a third"), (0, rows[0][1]), (None, "blarg")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, int(k >= 500)) for k, _ in rows if k is not None] + [(1, 1), (2, 7), (None, 1), (3, None)], "doc_id long, toxic int")
    index = fit(labels, texts=docs)
    assert (index.toxic > 0).sum() == 52 and (index.other > 0).sum() == 149  # 1 carries both labels
    assert index.prior == pytest.approx(52 / 201)


def test_monotone():
    x, y = monotone(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert (np.diff(x) >= 0).all() and y.tolist() == [0.0, 0.0, 0.5, 1.0, 1.0]


def test_held_out(spark, labelled):
    index = fit(labelled)
    assert {"blarg", "zor*"} <= set(index.vocabulary.to_pylist())
    texts = [(1, prose(900, 50) + " BLARG!"), (2, prose(901, 50)), (3, None), (4, ""), (5, "a zork2 here " + prose(902, 30_000))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.f for r in docs.select("doc_id", toxicity_of(spark, index)(F.col("text")).alias("f")).collect()}
    assert got[1].score > 0.8 and got[5].score > 0.8 and len(got[1].evidence) > 0
    assert got[2].score < 0.1 and got[3].score == got[4].score < 0.5  # one of the two empty examples is toxic
    assert got[3].evidence == []


def test_sampled_classes_keep_their_shares(labelled, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 60)
    index = fit(labelled)
    assert index.prior == pytest.approx(81 / 402)  # rows without an id are not used
    assert index.toxic.sum() <= 82


def test_without_examples(spark, labelled, odd_docs, clashing_docs):
    for index in (fit(labelled.limit(0)), fit(labelled.where("toxic = 0"))):
        for docs in (odd_docs, clashing_docs):
            got = docs.select(toxicity_of(spark, index)(F.col("text")).alias("f")).collect()
            assert all(r.f.score == 0 for r in got) and len(got) == docs.count()


def test_query_on_held_out_rows(spark):
    from jobmart.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op8_toxicity"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    rows = [(r.score, r.toxic, r.predicted) for r in got.select("score", "toxic", "predicted").collect()]
    toxic, clean = [s for s, y, _ in rows if y], [s for s, y, _ in rows if not y]
    above = np.mean([[(a > b) + 0.5 * math.isclose(a, b) for b in clean] for a in toxic])
    assert above > 0.75
    assert sum(p and not y for _, y, p in rows) <= 0.03 * len(clean)


def test_no_documents(spark, labelled, no_docs):
    assert no_docs.select(toxicity_of(spark, fit(labelled))(F.col("text"))).count() == 0
    assert fit(spark.createDataFrame([], "doc_id long, toxic int"), texts=no_docs).prior == 0
