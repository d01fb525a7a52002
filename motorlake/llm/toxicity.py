"""Toxicity by weak supervision.

Voters: every word of a fixed lexicon, the patterns that hide one (digits for letters,
stretched letters), and words and word beginnings mined from labelled documents, each of
which speaks for toxic or abstains, and the document's own label where it has one. A
generative label model with two classes estimates by expectation maximisation how often every
voter fires in each class (its accuracy) and how voters go together inside a class (their
correlations); a voter's word counts for less the more of it others repeat. The posterior
labels of that model train a linear classifier on what the voters saw, and it scores every
text.

Fitting uses at most ``TRAIN_DOCS`` labelled documents and ``UNLABELLED`` ones without a
label, none of them held out; counts of terms are made by Spark, and only the chosen terms
and the voters' marks reach the driver. Scores are a function of the text alone. A null or
empty text has no voter and gets the lowest score. Without labels the model is fitted on
unlabelled documents alone; where no voter fires in the sample at all, any that fires later
decides. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import clean_text, remainder, saved
from motorlake.llm.sampling import labelled_sample, unlabelled_sample

TRAIN_DOCS = 12_000
UNLABELLED = 4_000  # documents without a label that the label model also sees
THRESHOLD = 0.3
MODULUS, HELD = 4, 2
SUPPORT = 4  # toxic documents a mined term needs,
SHARE = 0.01  # and their share of all toxic ones
RATIO = 200  # times a mined term is likelier in toxic documents than in others
LEAST_GAIN = 20.0  # likelihood ratio statistic a mined term needs
STEMS = (4, 5, 6)  # lengths of word beginnings
REPEATS = 0.4  # correlation inside a class from which a voter repeats another
_SLICE = 500  # documents whose terms are counted together
_WORDS = re.compile(r"\w+")
_STRETCHED, _REPEATED = re.compile(r"(.)\1\1"), re.compile(r"(.)\1+")

# Insults in the languages of the corpus.
LEXICON = (
    "idiot idiots moron morons stupid loser losers scum trash clown worthless pathetic disgusting imbecile "
    "dumb dumbass bastard bitch asshole fool jerk retard filth vermin "
    "dummkopf trottel arschloch abschaum vollidiot versager widerlich wertlos "
    "imbécile crétin connard salaud abruti pathétique dégoûtant minable ordure "
    "idiota imbécil estúpido estúpida basura patético asqueroso escoria payaso perdedor"
).split()
DIGITS = str.maketrans("013457@$", "oieastas")


def mined_terms(words: set[str]) -> set[str]:
    """Words and their beginnings (written with a star)."""
    stems = {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}
    return words | stems


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _least_hash(text):
    """Column with the least hash of a text's three-word shingles: equal for most near
    copies, and for hardly any other texts."""

    def least(value: str) -> int:
        words = words_of(value)
        shingles = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
        return min(zlib.crc32(" ".join(s).encode()) for s in shingles)

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([least(t) for t in texts], dtype="int64")

    return run(text)


def _count_terms(docs: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, n): documents that hold each term, counted per slice before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _SLICE):
                seen: Counter = Counter()
                for text in batch["text"].iloc[start : start + _SLICE]:
                    terms = mined_terms(set(words_of(text)))
                    seen.update(terms if wanted is None else terms & wanted)
                yield pd.DataFrame({"term": list(seen), "n": list(seen.values())}, dtype=object)

    return docs.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def gain(with_toxic, toxic, with_clean, clean):
    """Likelihood ratio statistic of a term against the classes."""
    cells = np.array([[with_toxic, with_clean], [toxic - with_toxic, clean - with_clean]], dtype=float)
    expected = cells.sum(1, keepdims=True) * cells.sum(0, keepdims=True) / max(1.0, cells.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(cells > 0, cells * np.log(cells / expected), 0)
    return 2 * parts.sum()


def mine(sample: DataFrame) -> list[str]:
    """All terms that speak for toxic, the strongest first. Copies of a document, near ones
    included, count once: their words would all look alike."""
    sample = sample.dropDuplicates(["label", "least_hash"])
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    often = _count_terms(sample.filter("label = 1"), None).filter(F.col("n") >= max(SUPPORT, SHARE * toxic))
    # As many rows as the bounded sample has repeated terms.
    candidates = {r.term: r.n for r in often.collect()}
    counted = _count_terms(sample.filter("label = 0"), set(candidates)).collect()
    elsewhere = {r.term: r.n for r in counted}
    found = []
    for term, n in candidates.items():
        other = elsewhere.get(term, 0)
        if n / toxic > RATIO * other / clean and (value := gain(n, toxic, other, clean)) >= LEAST_GAIN:
            found.append((-value, term))
    return [term for _, term in sorted(found)]


class Voters:
    """What fires in a text: mined terms, then every word of the lexicon, then the patterns
    that hide one: digits for letters, stretched letters."""

    def __init__(self, terms: list[str]):
        self.place = {t: i for i, t in enumerate(terms)}
        self.stems = {t[:-1]: i for t, i in self.place.items() if t.endswith("*")}
        own = list(dict.fromkeys(LEXICON))
        self.lexicon = {w: len(terms) + i for i, w in enumerate(own)}
        self.names = [*terms, *(f"<{w}>" for w in own), "<digits>", "<stretched>"]

    def _hidden(self, word: str) -> tuple[int, int] | None:
        """Voters of the lexicon word and the pattern, where one hides the other."""
        if not word.isalpha() and (plain := word.translate(DIGITS)) in self.lexicon:
            return self.lexicon[plain], len(self.names) - 2
        if _STRETCHED.search(word) and (plain := _REPEATED.sub(r"\1", word)) in self.lexicon:
            return self.lexicon[plain], len(self.names) - 1
        return None

    def marks(self, text: str) -> tuple[list[int], int, int]:
        """Voters that fire, hits in all, words in all."""
        words = words_of(text)
        counts = Counter(words)
        fired, hits = set(), 0
        place, stems, lexicon = self.place, self.stems, self.lexicon
        for word, n in counts.items():
            hit = False
            if word in place:
                fired.add(place[word])
                hit = True
            for size in STEMS:
                if len(word) > size and (at := stems.get(word[:size])) is not None:
                    fired.add(at)
                    hit = True
            if (at := lexicon.get(word)) is not None:
                fired.add(at)
                hit = True
            elif both := self._hidden(word):  # a lexicon word all the same
                fired.update(both)
                hit = True
            hits += n * hit
        return sorted(fired), hits, len(words)


SUMS = 4  # features besides the voters


def features(marks: tuple[list[int], int, int], voters: int) -> np.ndarray:
    """One row for the linear classifier: the voters, how many fired, how often and how densely."""
    fired, hits, words = marks
    row = np.zeros(voters + SUMS)
    row[fired] = 1
    row[voters:] = min(1, len(fired)), np.log1p(len(fired)), np.log1p(hits), min(1.0, 10 * hits / max(1, words))
    return row


def beliefs(voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Rows and targets that stand for what the rules mean, beside those of any sample: a
    text without a voter is clean, one with a word of the lexicon, plain or hidden, is toxic.
    They decide on voters the sample hardly has."""
    count = len(voters.names)
    own = list(voters.lexicon.values())
    marks = [([i], 1, 20) for i in own] + [([i, count - 2 + i % 2], 1, 20) for i in own]
    rows = [features(m, count) for m in marks] + [features(([], 0, 20), count)] * len(own)
    return np.array(rows), np.array([0.9] * len(marks) + [0.01] * len(own))


# ---------------------------------------------------------------- label model

def label_model(fires: np.ndarray, label: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, dict]:
    """Posterior probability of toxic for each row, and the estimates behind it.

    ``fires`` (rows, voters) is 0 or 1; ``label`` is 0, 1 or -1 (unknown) and is one more
    voter, which may be wrong. Rows without a label start from whether any voter fires.
    """
    rows, voters = fires.shape
    known = label >= 0
    posterior = np.where(known, 0.1 + 0.8 * (label == 1), 0.02 + 0.7 * (fires.sum(axis=1) > 0))
    estimates: dict = {}
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior])  # (2, rows)
        size = weight.sum(axis=1)
        rate = (weight @ fires + [[0.02], [0.1]]) / (size[:, None] + 1)
        rate = np.clip(rate, 1e-5, 1 - 1e-5)
        rate[1] = np.maximum(rate[1], rate[0])  # a voter speaks for toxic or says nothing
        right = np.clip((weight[:, known] * np.stack([label[known] == 0, label[known] == 1])).sum(axis=1) + 4.5,
                        1e-6, None) / (weight[:, known].sum(axis=1) + 5)
        # Correlation inside the classes: how much of a voter others repeat.
        together = np.zeros((voters, voters))
        for kind in (0, 1):
            centred = fires - rate[kind]
            cover = (centred * weight[kind][:, None]).T @ centred / max(size[kind], 1)
            spread = np.sqrt(np.maximum(np.diag(cover), 1e-6))
            together = np.maximum(together, cover / spread[:, None] / spread[None, :])
        np.fill_diagonal(together, 0)
        share = 1 / (1 + np.where(together > REPEATS, together, 0).sum(axis=1))
        odds_fire = np.log(rate[1] / rate[0])
        odds_not = np.log((1 - rate[1]) / (1 - rate[0]))
        logit = np.log(size[1] + 1) - np.log(size[0] + 1)
        logit = logit + fires @ (share * odds_fire) + (1 - fires) @ (share * odds_not)
        tell = np.where(label == 1, np.log(right[1] / (1 - right[0] + 1e-6)),
                        np.log((1 - right[1] + 1e-6) / right[0]))
        logit = logit + np.where(known, tell, 0)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        estimates = {"size": size, "rate": rate, "share": share, "label": right, "together": together}
    return posterior, estimates


def fit_linear(x: np.ndarray, target: np.ndarray, rounds: int = 40, ridge: float = 0.3) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (target - p) - penalty * weight
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        weight += move * min(1.0, 5 / (np.abs(move).max() + 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return weight


# ---------------------------------------------------------------- on tables

def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Mined terms and the weights of the linear classifier.

    Terms come from the labelled sample; the label model sees it and an unlabelled one, or the
    unlabelled one alone. Where no voter fires at all, any that fires later says toxic.
    """
    marked = labelled_sample(docs, labels, label, MODULUS, HELD, most)
    plain = unlabelled_sample(docs, labels, label, MODULUS, HELD, UNLABELLED)
    sample = marked.unionByName(plain.withColumn("label", F.lit(-1)))
    sample = saved(sample.withColumn("least_hash", _least_hash(F.col("text"))), "toxic-sample")
    terms = mine(sample.filter("label >= 0"))
    voters = Voters(terms)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [voters.marks(t) for t in batch["text"]]
            yield pd.DataFrame(
                [(str(i), k, *r) for i, k, r in zip(batch["doc_id"], batch["label"], rows)],
                columns=["doc_id", "label", "fired", "hits", "words"], dtype=object,
            )

    schema = "doc_id string, label int, fired array<int>, hits long, words long"
    rows = sorted(sample.mapInPandas(mark, schema).collect(), key=lambda r: (r.doc_id, r.label, r.words, r.hits))
    count = len(voters.names)
    if not any(r.fired for r in rows):
        weight = np.zeros(count + SUMS + 1)
        weight[count], weight[-1] = 6.0, -4.0  # any voter fires or none
        return terms, weight
    x = np.array([features((r.fired, r.hits, r.words), count) for r in rows])
    posterior, _ = label_model(x[:, :count], np.array([r.label for r in rows]))
    believed, target = beliefs(voters)
    return terms, fit_linear(np.concatenate([x, believed]), np.concatenate([posterior, target]))


def scores_of(text, terms: list[str], weight: np.ndarray):
    """Column of scores."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        voters = Voters(terms)
        count = len(voters.names)
        for texts in batches:
            logit = np.array([features(voters.marks(t), count) @ weight[:-1] + weight[-1] for t in texts])
            yield pd.Series(1 / (1 + np.exp(-np.clip(logit, -30, 30))), dtype="float64")

    return run(text)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    terms, weight = train(docs, labels)
    scored = docs.select(
        F.col(key).alias("doc_id"), (remainder(key, MODULUS) == HELD).alias("held_out"),
        scores_of(clean_text(text), terms, weight).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
