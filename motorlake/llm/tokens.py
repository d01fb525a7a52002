"""Byte-level tokens of a public vocabulary file, word by word."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

from motorlake.llm.word_tokens import Memory

# Fixed value: the pattern that splits text before the merges of this kind of vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50_256  # free in the vocabulary: ends a text
_CACHED = 400_000  # words a task learns before it forgets the older ones
_AT_ONCE = 5_000  # words encoded together
_SECTION = 8_000_000  # characters whose words are looked up together
_CUT = "\x01"
_SPACE = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]"  # of any kind, as Arrow's expressions name it
_ODD = re.compile(r"(?s)^\s?$|.\s")  # words with more white space than a space before them
_ODD_WORDS = re.compile(r"[^\n]\s(?<!\n)|\n\s?\n")


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file; its size is that of the vocabulary, and it travels with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encoder(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Words:
    """Token ids of distinct words, each with the space that may stand before it.

    Words without other white space are encoded together, a line break between them: the
    pattern always splits there, so the ids between two line breaks are those of one word.
    """

    def __init__(self, vocabulary: bytes):
        self.encode = encoder(vocabulary).encode_ordinary
        (self.mark,) = self.encode("\n")
        self.known = Memory(_CACHED)

    def ids(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u2").tobytes()

    def look_up(self, words: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each word."""
        missing, known = self.known.missing(words), self.known.new
        for start in range(0, len(missing), _AT_ONCE):
            part = missing[start : start + _AT_ONCE]
            if _ODD_WORDS.search("\n".join(["", *part, ""])):
                known.update((word, self.ids(word)) for word in part if _ODD.search(word))
                part = [word for word in part if not _ODD.search(word)]
            ids = np.array(self.encode("\n".join([*part, ""])), dtype="<u2")
            ends, raw = (np.flatnonzero(ids == self.mark) * 2).tolist(), ids.tobytes()
            known.update((word, raw[a:b]) for word, a, b in zip(part, [0, *(end + 2 for end in ends)], ends))
        return list(map(known.__getitem__, words))

    def spread(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and where each word's end."""
        coded = words.dictionary_encode()
        found = self.look_up(coded.dictionary.to_pylist())
        blob = np.frombuffer(b"".join(found), dtype="<u2")
        lengths = np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // 2
        starts = np.cumsum(lengths, dtype=np.int32) - lengths
        codes = coded.indices.to_numpy()
        counts = lengths[codes]
        ends = np.cumsum(counts, dtype=np.int32)
        at = np.repeat(starts[codes] - (ends - counts), counts)
        at += np.arange(len(at), dtype=np.int32)
        return blob.take(at), ends


class Pieces:
    """Token ids of texts as little-endian 16-bit numbers, the library's own.

    The pattern splits before a space and on both sides of a line break, unless three
    characters of white space stand together or two end the text. Other texts can be cut
    there, and each distinct word of a section is looked up once and copied to its places.
    """

    def __init__(self, vocabulary: bytes):
        self.words = Words(vocabulary)

    def __call__(self, text: str) -> bytes:
        return self.texts([text])[0].tobytes()

    def texts(self, bodies: list[str]) -> list[np.ndarray]:
        out, held, size = [], [], 0
        for body in bodies:
            held.append(body)
            size += len(body)
            if size >= _SECTION:
                out += self._section(held)
                held, size = [], 0
        return out + self._section(held) if held else out

    def _section(self, bodies: list[str]) -> list[np.ndarray]:
        texts = pa.array(bodies, pa.string())
        uncut = pc.match_substring_regex(texts, f"{_SPACE}{{3}}|{_SPACE}{{2}}\\z|{_CUT}")
        whole, cut = uncut.to_pylist(), pc.if_else(uncut, None, texts)
        cut = pc.replace_substring(pc.replace_substring(cut, " ", f"{_CUT} "), "\n", f"{_CUT}\n{_CUT}")
        split = pc.split_pattern(cut, _CUT)
        ids, ends = self.words.spread(split.values)
        stops = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        return [
            np.frombuffer(self.words.ids(body), dtype="<u2") if w else ids[a:b]
            for w, body, a, b in zip(whole, bodies, stops, stops[1:])
        ]
