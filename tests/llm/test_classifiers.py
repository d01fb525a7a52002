"""The line field and the label model against enumeration, and their held-out accuracy."""

import itertools

import numpy as np
import pytest

from motorlake.llm import quality, sampling, toxicity

DOCS = "doc_id long, text string, score string, label string"


def test_marginals_by_enumeration():
    rng = np.random.default_rng(2)
    count = np.array([1, 3, 5])
    good, step = rng.normal(size=(3, 5)) * 2, rng.normal(size=(2, 2))
    node, pair = quality.forward_backward(good, count, step)
    pairs = np.zeros((2, 2))
    for d, n in enumerate(count):
        weights, lit, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            value = np.exp(sum(good[d, t] * path[t] for t in range(n)) + sum(step[a, b] for a, b in zip(path, path[1:])))
            weights += value
            lit += value * np.array(path)
            for a, b in zip(path, path[1:]):
                moves[a, b] += value
        assert np.allclose(node[d, :n], lit / weights)
        pairs += moves / weights
    assert np.allclose(pair, pairs)


def test_features_know_lines_and_neighbours():
    own, size, lines = quality.line_features(["Ab!\n\n| 1", "", "é é"])
    assert lines.tolist() == [3, 1, 1] and len(own) == 5 and size.tolist() == [3, 1, 3, 1, 5]
    joined = quality.with_neighbours(own, lines)
    assert (joined[0, 13:26] == 0).all() and (joined[1, 13:26] == own[0]).all() and (joined[2, 26:39] == 0).all()


def scored(spark, sf, operator, labels, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "'clash' score", "'clash' label")
    more = spark.createDataFrame([(1_000_000 + i, t, "", "") for i, t in enumerate(texts)] + [(None, "null id", "", "")], DOCS)
    return operator(docs.unionByName(more), labels).collect()


def accuracy(rows, truth, held=True):
    pairs = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out == held and r.doc_id in truth]
    return sum(a == b for a, b in pairs) / len(pairs)


SF = "/root/testdata/sf0.01"
TEXTS = [None, "", "\n" * 5000, "word " * 60_000, "a\nb" * 3000]


def test_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored(spark, SF, quality.score, labels, TEXTS)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert accuracy(rows, truth) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1_000_000].score == by_id[1_000_001].score
    again = scored(spark, SF, quality.score, labels.repartition(5), TEXTS)
    assert {r.doc_id: round(r.score, 6) for r in again} == {r.doc_id: round(r.score, 6) for r in rows}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = [i for i, q in truth.items() if q == 1]
    assert len({r.doc_id for r in kept.select("doc_id").collect()} & set(good)) > 0.99 * len(good)


def test_toxicity(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored(spark, SF, toxicity.score, labels, [*TEXTS, "You are an 1d10t and a mooooron"])
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert accuracy(rows, truth) > 0.92
    clean = [r.predicted for r in rows if truth.get(r.doc_id) == 0]
    assert sum(clean) / len(clean) < 0.02
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1_000_000].score == by_id[1_000_001].score == min(r.score for r in rows)
    assert by_id[1_000_005].predicted == 1


@pytest.mark.parametrize("operator", [quality.score, toxicity.score])
def test_no_labels_or_documents(spark, operator):
    docs = spark.createDataFrame([(1, "plain words", "", ""), (2, "you idiot", "", "")], DOCS)
    labels = spark.createDataFrame([(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in operator(docs, labels).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 2
    assert operator(docs.limit(0), labels).collect() == []
    if operator is toxicity.score:
        assert got[2] > 0.5 > got[1]


def test_label_model_finds_the_good_voters():
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.2
    rates = [(0.01, 0.6), (0.02, 0.5), (0.3, 0.3), (0.01, 0.6)]
    fires = np.array([np.where(truth, rng.random(4000) < b, rng.random(4000) < a) for a, b in rates]).T.astype(float)
    fires[:, 3] = fires[:, 0]  # a voter that repeats another
    label = np.where(rng.random(4000) < 0.2, np.where(rng.random(4000) < 0.05, ~truth, truth), -1)
    posterior, found = toxicity.label_model(fires, label)
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert found["together"][0, 3] > 0.9 and found["share"][0] < 0.6 < found["share"][2]
    assert abs(found["rate"][1, 1] - 0.5) < 0.1


def test_copies_do_not_make_terms(spark):
    words = " ".join(f"copied{i}" for i in range(30))
    rows = [(words + f" tail{i % 3}", 1) for i in range(30)] + [(f"insultx plain{i} text", 1) for i in range(30)]
    rows += [(f"clean{i} plain{i + 1} text", 0) for i in range(200)]
    sample = spark.createDataFrame(rows, "text string, label int")
    from pyspark.sql import functions as F

    terms = toxicity.mine(sample.withColumn("least_hash", toxicity._least_hash(F.col("text"))))
    assert "insultx" in terms and not any(t.startswith("copied") for t in terms)


def test_sample_is_bounded_in_rows(spark):
    """One id with a third of all rows, and labels that repeat or contradict each other."""
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 6, id) as doc_id", "concat('text ', id) as text", "id as label")
    labels = spark.range(400).selectExpr("if(id < 200, 6, id) as doc_id", "cast(id % 2 as int) as toxic")
    found = sampling.labelled_sample(docs.repartition(5), labels, "toxic", 4, 2, 10_000).collect()
    assert len(found) == len({r.doc_id for r in found}) > 50
    again = sampling.labelled_sample(docs.repartition(3), labels, "toxic", 4, 2, 10_000).collect()
    assert sorted(again) == sorted(found)
    assert [r.label for r in found if r.doc_id == 6] == [0]
    few = sampling.labelled_sample(docs, labels, "toxic", 4, 2, 10).collect()
    assert 0 < len(few) <= 10 and set(few) <= set(found)  # a chosen id need not be in the table


def test_quality_learns_from_whole_documents(spark):
    """What sets the classes apart stands in the last of 600 lines only."""
    rows = [(i, "plain words here\n" * 600 + ("##### 99999 #####\n" * 300 if i % 2 else "more words there\n" * 300)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    assert min(got[i] for i in range(0, 60, 2)) > max(got[i] for i in range(1, 60, 2))
    bounded = quality.train(docs, labels, lines=901 * 4)  # four whole documents, and not all of a kind
    assert np.isfinite(np.concatenate([np.ravel(v) for v in bounded.values()])).all()


def test_posterior_by_enumeration():
    """Both classes written out, factor by factor, with the estimates of the last round."""
    rng = np.random.default_rng(9)
    truth = rng.random(300) < 0.3
    fires = np.array([np.where(truth, rng.random(300) < b, rng.random(300) < a) for a, b in [(0.05, 0.7), (0.1, 0.5), (0.3, 0.35)]])
    fires = np.concatenate([fires, fires[:1]]).T.astype(float)  # the last voter repeats the first
    label = np.where(rng.random(300) < 0.5, truth, -1).astype(int)
    posterior, found = toxicity.label_model(fires, label)
    rate, share, right, size = (found[k] for k in ("rate", "share", "label", "size"))
    for row in range(300):
        joint = []
        for kind in (0, 1):
            p = size[kind] + 1
            for v in range(4):
                p *= (rate[kind, v] if fires[row, v] else 1 - rate[kind, v]) ** share[v]
            if label[row] >= 0:
                p *= right[kind] if label[row] == kind else 1 - right[kind]
            joint.append(p)
        assert posterior[row] == pytest.approx(joint[1] / sum(joint), abs=1e-4)
    weight = np.stack([1 - posterior, posterior])
    for kind in (0, 1):  # settled: the estimates follow from the posterior they give
        for v in range(4):
            plain = (sum(weight[kind] * fires[:, v]) + (0.02, 0.1)[kind]) / (sum(weight[kind]) + 1)
            assert rate[kind, v] == pytest.approx(plain, abs=0.01)


def test_mined_terms_by_plain_counts(spark):
    import math
    import random

    rng = random.Random(12)
    words = [f"w{i}ord" for i in range(40)]
    rows = []
    for n in range(600):
        toxic = n % 3 == 0
        text = [rng.choice(words) for _ in range(12)] + [f"doc{n}"] + ([f"nasty{rng.randint(0, 2)}"] if toxic and rng.random() < 0.8 else [])
        rows.append((" ".join(text), int(toxic)))
    from pyspark.sql import functions as F

    sample = spark.createDataFrame(rows, "text string, label int").withColumn("least_hash", toxicity._least_hash(F.col("text")))
    kept = [(r.text, r.label) for r in sample.dropDuplicates(["label", "least_hash"]).collect()]
    counts = {}
    total = [sum(1 for _, k in kept if k == kind) for kind in (0, 1)]
    for text, kind in kept:
        own = set(text.split())
        for term in own | {f"{w[:n]}*" for w in own for n in (4, 5, 6) if len(w) > n}:
            counts.setdefault(term, [0, 0])[kind] += 1
    want = set()
    for term, (clean, toxic) in counts.items():
        if toxic < max(toxicity.SUPPORT, toxicity.SHARE * total[1]) or toxic / total[1] <= toxicity.RATIO * clean / total[0]:
            continue
        cells = [[toxic, clean], [total[1] - toxic, total[0] - clean]]
        gain = 0.0
        for i in (0, 1):
            for j in (0, 1):
                expected = sum(cells[i]) * (cells[0][j] + cells[1][j]) / sum(total)
                gain += 2 * cells[i][j] * math.log(cells[i][j] / expected) if cells[i][j] else 0
        if gain >= toxicity.LEAST_GAIN:
            want.add(term)
    assert set(toxicity.mine(sample)) == want and {"nasty0", "nasty*"} <= want


def test_every_lexicon_word_and_pattern_votes():
    voters = toxicity.Voters(["mined"])
    assert len(voters.names) == 1 + len(set(toxicity.LEXICON)) + 2
    name = lambda text: {voters.names[i] for i in voters.marks(text)[0]}
    assert name("You moron, you IDIOT") == {"<moron>", "<idiot>"}
    assert name("1d10t") == {"<idiot>", "<digits>"} and name("mooooron") == {"<moron>", "<stretched>"}
    assert name("a mined word") == {"mined"} and name("nothing here") == set()


def test_label_model_without_labels(spark):
    """Fitted on unlabelled documents alone: what voters mark together stands apart."""
    rng = np.random.default_rng(1)
    rows = []
    for n in range(400):
        bad = n % 5 == 0
        rows.append((n, f"text {n} " + ("you idiot and moron " if bad else "") + ("jerk " if rng.random() < 0.03 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.doc_id for r in got if r.predicted} == set(range(0, 400, 5))
    assert np.mean([r.score for r in got if r.doc_id % 5]) < 0.2
