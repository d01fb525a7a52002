"""Packing: library ids, gapless sequences, and bins against exhaustive search."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from motorlake.llm import packing, word_tokens

SCHEMA = "doc_id long, text string, row_id string, piece string, length int, sequence_id int"
TEXTS = [
    "The quick brown fox", "", None, "two  spaces and\n new lines \n\tand tabs ", "é ñ ß 漢字 🙂 ​", " leading", "trailing ",
    "x" * 3000, "a\r\nb", "it's 12,345 o'clock!!! 'sabc ''s", "İstanbul ΣΑΣ Σ. ﬁ é é é ́x", "a\x1cb\x1fc\x85d\xa0e",
    "<|endoftext|> x<|startoftext|>y <| endoftext|>", "½ ² ª º ¡¿ soft\xadhyphen ­", "word " * 3000, "wörter und Ägypten " * 900,
    " line　wide", "<|\nendoftext|>", "ab" * 40 + " " + "Ab" * 40,
]


def library():
    return Tokenizer.from_str(word_tokens.read_vocabulary())


def test_ids_are_the_library_s():
    words, plain = word_tokens.Words(word_tokens.read_vocabulary(), parts=30), library()  # forgets often
    texts = [t or "" for t in TEXTS]
    for _ in range(2):  # new words, then known ones
        for text, ids in zip(texts, words(texts)):
            assert ids.dtype == words.kind and ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:50]
    rng = random.Random(1)
    alphabet = "aB'sé İΣ<|>1²\t\n .,!漢\xa0ñ́"
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert words([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_very_long_texts_are_read_in_sections(monkeypatch):
    monkeypatch.setattr(word_tokens, "_SECTION", 50)
    words, plain = word_tokens.Words(word_tokens.read_vocabulary()), library()
    texts = [t or "" for t in TEXTS]
    for text, ids in zip(texts, words(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def documents(spark):
    rows = [(i, t, "clash", "clash", 1, 2) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, None, None), (3, "again", None, None, None, None), (2**53 + 1, "large id", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("length, group", [(64, 5), (16, 1000), (2048, 2048)])
def test_round_trip(spark, length, group):
    docs, given = documents(spark)
    packed = packing.pack(docs.repartition(3), length=length, group=group)
    rows = packed.collect()
    plain = library()
    expected = sorted(
        (str(r[0]), number, start, len(ids[start : start + length]),
         zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()))
        for r in given for ids in [plain.encode(r[1] or "", add_special_tokens=False).ids + [0]]
        for number, start in enumerate(range(0, len(ids), length))
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for parts in bins.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    assert len(bins) <= -(-sum(r.length for r in rows) // length) + 2
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert joined == {s: b"".join(p[2] for p in sorted(parts)) for s, parts in bins.items()}


def fewest(lengths, cap):
    """The least number of bins, by trying everything."""
    lengths = sorted(lengths, reverse=True)

    def fits(i, frees):
        if i == len(lengths):
            return True
        for f in sorted({f for f in frees if f >= lengths[i]}):
            rest = list(frees)
            rest.remove(f)
            if fits(i + 1, [*rest, f - lengths[i]]):
                return True
        return False

    n = -(-sum(lengths) // cap)
    while not fits(0, [cap] * n):
        n += 1
    return n


def test_bins_against_every_packing():
    rng = random.Random(5)
    more = 0
    for _ in range(150):
        cap = rng.choice([10, 30, 100])
        lengths = [rng.randint(1, cap - 1) for _ in range(rng.randint(0, 11))]
        bins = packing.pack_group(lengths, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= cap for b in bins)
        more += len(bins) - fewest(lengths, cap)
    assert more <= 2


def test_search_empties_bins_that_best_fit_leaves():
    rng = random.Random(2)
    lengths = [rng.randint(300, 700) for _ in range(400)]
    before, after = len(packing.best_fit(lengths, 2048)), len(packing.pack_group(lengths))
    assert after <= -(-sum(lengths) // 2048) + 2 < before


def test_each_exchange_raises_the_squares():
    rng = random.Random(3)
    lengths = [rng.randint(1, 1500) for _ in range(120)]
    search = packing.Search(lengths, [[i] for i in range(120)], 2048)
    for _ in range(60):
        before = sum(f * f for f in search.fill.values())
        if not search.exchange(min(search.fill, key=search.fill.get)):
            break
        assert sum(f * f for f in search.fill.values()) > before
        assert search.fill == {b: sum(lengths[i] for i in x) for b, x in search.bins.items()}
        assert all(f <= 2048 for f in search.fill.values())


def test_one_length_only(spark):
    assert len(packing.pack_group([1100] * 500)) == 500
    assert len(packing.pack_group([1] * 5000)) == 3


def test_no_documents(spark):
    docs, _ = documents(spark)
    assert packing.pack(docs.limit(0)).collect() == []
