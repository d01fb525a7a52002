"""Token shards: an exact round trip in a permuted order."""

import random

import numpy as np
import pytest

from motorlake.llm import token_shards, tokens
from motorlake.session import new_folder

SCHEMA = "doc_id long, text string, slot string, parts string"
TEXTS = [
    "The quick brown fox", "", None, "two  spaces and\n new lines \n\tand tabs ", "é ñ ß 漢字 🙂 ​", " leading", "trailing ",
    "word " * 5000, "x" * 3000, "a\r\nb", "it's 12,345 o'clock!!!",
]


def documents(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", None, None), (3, "again", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None] + [" ", "  ", " a  b", "a \n b", "\n\n x"])
def test_pieces_are_exact(text):
    file = tokens.read_vocabulary()
    encoding = tokens.encoder(file)
    ids = np.frombuffer(tokens.Pieces(file)(text), dtype="<u2").tolist()
    assert encoding.decode_bytes(ids).decode() == text
    assert ids == encoding.encode_ordinary(text)


def test_cut_texts_have_the_ids_of_the_library():
    """White space of every kind beside words, alone and in runs, and texts of one section."""
    file, draw = tokens.read_vocabulary(), random.Random(4)
    encode, pieces = tokens.encoder(file).encode_ordinary, tokens.Pieces(file)
    signs = [" "] * 5 + list("ab'1$é漢s\n\n\t\r\x01\x0b\x1c\x85\xa0\u2028\u3000")
    texts = ["".join(draw.choices(signs, k=draw.randrange(14))) for _ in range(8000)]
    texts += [" ".join(draw.choices(["so", "on's", "12,5", "x\ny", "und\tso"], k=40)) for _ in range(300)]
    assert [ids.tolist() for ids in pieces.texts(texts)] == [encode(text) for text in texts]


def test_words_forgotten_are_looked_up_again(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHED", 3)
    monkeypatch.setattr(tokens, "_SECTION", 20)
    monkeypatch.setattr(tokens, "_AT_ONCE", 2)
    file = tokens.read_vocabulary()
    texts = [f"the w{i % 7} and w{i % 11}\nof\t{i} " for i in range(60)]
    encode = tokens.encoder(file).encode_ordinary
    assert [ids.tolist() for ids in tokens.Pieces(file).texts(texts)] == [encode(text) for text in texts]


def test_ids_that_are_text_stay_text(spark):
    docs = spark.createDataFrame([("a-1", "one text"), (None, "no id"), ("9" * 30, None)], "doc_id string, text string")
    rows = token_shards.slots(docs).collect()
    assert sorted(str(i) for r in rows for i in r.doc_ids) == ["9" * 30, "None", "a-1"] and all(r.stored for r in rows)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation_is_one_to_one(size):
    slots = token_shards.permute(np.arange(size), size)
    assert sorted(slots) == list(range(size))
    if size > 100:
        assert (slots != np.arange(size)).mean() > 0.9
        assert (slots != token_shards.permute(np.arange(size), size, "other key")).mean() > 0.9


def test_round_trip_and_resume(spark):
    folder = new_folder(spark, "shards")
    docs = documents(spark).repartition(3)
    table = token_shards.write(docs, folder, length=64, slots=16)
    rows = sorted(table.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows))) and len(rows) > 100
    assert all((r.shard, r.start) == (r.slot // 16, r.slot % 16 * 128) for r in rows)
    assert all(r.stored for r in token_shards.verify(table, folder, length=64, slots=16).collect())
    stored = list(token_shards.read_slots(folder, 0, len(rows), length=64, slots=16))
    resumed = list(token_shards.read_slots(folder, 37, len(rows), length=64, slots=16))
    assert all((a == b).all() for a, b in zip(stored[37:], resumed))
    pieces = {}
    for row, ids in zip(rows, stored):
        at = 0
        for part in row.parts:
            pieces.setdefault((part.doc_id, part.first), []).append((part.n, ids[at : at + part.n]))
            at += part.n
        assert at == row.n_tokens and (ids[at:] == tokens.END).all()
    encoding = tokens.encoder(tokens.read_vocabulary())
    for i, text in enumerate(TEXTS):
        if i == 3:  # two rows share this id
            continue
        ids = np.concatenate([v[0][1] for k, v in sorted((k, v) for k, v in pieces.items() if k[0] == i)])
        assert ids[-1] == tokens.END and encoding.decode_bytes(ids[:-1].tolist()).decode() == (text or "")
    assert len([k for k in pieces if k[0] is None]) == 1 and len(pieces[3, 0]) == 2


def test_no_documents_no_shards(spark):
    assert token_shards.slots(documents(spark).limit(0)).collect() == []
