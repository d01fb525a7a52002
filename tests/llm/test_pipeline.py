"""The pipeline stage by stage against brute force, and its edge cases."""

from collections import Counter

import pytest
from conftest import SF

import __spark_entry__ as contract
import corpus_pipeline
from motorlake.llm import decontaminate, mixing, quality, simhash
from motorlake.llm.common import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = saved(stage(spark, docs, SF), "stage")
    return [*out, docs]


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]
    assert all(frame.columns == COLUMNS for frame in stages[:-1])


def test_quality_stage(spark, stages):
    scores = {r.doc_id: r.score for r in quality.score(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if scores[r[0]] >= 0.5]
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r[0] for r in rows(stages[1])}
    assert sum(i in kept for i, q in truth.items() if q == 1) > 0.97 * sum(truth.values())


def test_near_dedup_stage(stages):
    before = rows(stages[1])
    prints = [simhash.fingerprint(r[1] or "") % 2**64 for r in before]
    group = list(range(len(before)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if group[j] > group[i] and (a ^ b).bit_count() <= 4:
                    group[j], changed = group[i], True
    assert rows(stages[2]) == [r for i, r in enumerate(before) if group[i] == i]


def test_decontamination_stage(spark, stages):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bags = [(Counter(decontaminate.shingles(w, 5)), len(w)) for w in (decontaminate.words_of(t) for _, t in bench)]

    def leaks(text):
        words = decontaminate.words_of(text or "")
        for bag, size in bags:
            span = min(size, len(words))
            for s in range(len(words) - span + 1):
                parts = decontaminate.shingles(words[s : s + span], 5)
                if parts and parts[0] in bag and decontaminate.similarity(Counter(parts), bag) >= 0.8:
                    return True
        return False

    assert rows(stages[3]) == [r for r in rows(stages[2]) if not leaks(r[1])]


def test_mixing_stage(stages):
    copies = {r.doc_id: r.copies for r in mixing.copies(stages[3]).collect()}
    assert rows(stages[4]) == sorted(r for r in rows(stages[3]) for _ in range(copies[r[0]]))


def test_token_stage(stages):
    found = stages[5].collect()
    assert sorted(r.slot for r in found) == list(range(len(found))) and all(r.stored for r in found)
    ends = Counter()
    for r in found:
        ends.update({(i, f + n) for i, f, n in zip(r.doc_ids, r.first_tokens, r.token_counts) if f == 0})
    assert {i for i, _ in ends} == {r[0] for r in rows(stages[4])}


def test_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    numbers = {int(name[2:].split("_")[0]) for name in contract.queries() if name.startswith("op")}
    assert numbers == set(range(1, 14))


def test_edges(spark):
    """Nulls, empty texts, repeated rows and extra columns pass every stage; so does no row."""
    body = " ".join(f"Plain{i} words, and more of them." for i in range(40))
    rows_ = [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "y"), (2, body, "en", "a", 5, "z"),
             (2, body, "en", "a", 5, "z"), (3, body + " tail", "en", None, 5, None)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long, row_id string")
    for frame in (docs, docs.limit(0)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            after = saved(stage(spark, frame, SF), "edge")
            if number < 4:
                assert after.columns == docs.columns
                frame = after
        after.collect()
