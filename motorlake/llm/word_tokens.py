"""Token ids of a public word-level BPE file, from the library, word by word.

The vocabulary drops white space and merges only inside words, so a text's ids are those of
its words one after the other. Texts are read in sections; each distinct word of a section is
looked up once and its ids are copied to all its places. Words of plain Latin letters are cut
by the vocabulary's own pattern into parts, which repeat far more often than words do and are
remembered; every other word is given to the library as it is.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the pattern in the vocabulary file; a line break then stands between words.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
# Characters whose small letters and classes do not depend on their neighbours or on normal
# forms: printable ASCII and Latin letters with marks, but for the dotted capital I.
_PLAIN = r"^[\x21-\x7e\x{a1}-\x{12f}\x{131}-\x{24f}]+$"
_PARTS = 600_000  # parts that a worker learns before it forgets the older ones
_LONG = 64  # longer parts are not remembered
_SECTION = 8_000_000  # characters whose words are looked up together


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str | None = None) -> str:
    """The vocabulary file; its size is fixed, and it travels with the tasks."""
    with open(path or default_path(), encoding="utf-8") as file:
        return file.read()


@functools.lru_cache(maxsize=1)
def words_of(vocabulary: str) -> Words:
    """One per worker process: what it has learnt serves its later tasks too."""
    return Words(vocabulary)


def _sections(text: str) -> Iterator[str]:
    """The text, cut at spaces into sections of bounded length where it has any."""
    start = 0
    while len(text) - start > _SECTION:
        stop = text.rfind(" ", start, start + _SECTION)
        if stop <= start:
            break
        yield text[start:stop]
        start = stop + 1
    yield text[start:]


class Memory:
    """Ids by text. After ``size`` new entries the older half is forgotten, but for what was
    asked for since."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, texts: Iterable[str]) -> list[str]:
        """Those not known; ``new`` then holds the others."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old, unknown = self.new, self.old, []
        for text in texts:
            if text not in new:
                if text in old:
                    new[text] = old[text]
                else:
                    unknown.append(text)
        return unknown


class Words:
    """Ids of texts, the same as the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, vocabulary: str, parts: int = _PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(vocabulary)
        self.bare = Tokenizer(self.library.model)  # for parts that are cut and small already
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() < 1 << 16 else "<u4")
        self.mark = np.iinfo(self.kind).max  # no id: stands between words
        self.parts = Memory(parts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian numbers of ``kind``."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0
        for number, text in enumerate(texts):
            for part in _sections(text):
                held.append((number, part))
                size += len(part)
                if size >= _SECTION:
                    self._add(held, out)
                    held, size = [], 0
        self._add(held, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def _add(self, held: list[tuple[int, str]], out: list[list[np.ndarray]]) -> None:
        if not held:
            return
        lines = pc.replace_substring(pa.array([part for _, part in held]), "\n", " ")
        split = pc.split_pattern(lines, " ")
        coded = split.values.dictionary_encode()
        blob, starts, lengths = self._ids(coded.dictionary)
        codes = coded.indices.to_numpy()
        counts = lengths[codes]
        ends = np.cumsum(counts)
        ids = blob[np.repeat(starts[codes] - (ends - counts), counts) + np.arange(ends[-1])]
        stops = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        for (number, _), a, b in zip(held, stops, stops[1:]):
            out[number].append(ids[a:b])

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the words in one array, where each word's begin, and how many they are."""
        safe = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(pc.match_substring(words, "<|")))
        safe = safe.to_numpy(zero_copy_only=False)
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        blob = np.zeros(0, self.kind)
        if safe.any():
            blob = self._cut(words.filter(pa.array(safe)).to_pylist())
            marks = np.flatnonzero(blob == self.mark)
            starts[safe] = marks[:-1] + 1
            lengths[safe] = np.diff(marks) - 1
        others = [
            np.array(self.library.encode(word, add_special_tokens=False).ids, self.kind)
            for word in words.filter(pa.array(~safe)).to_pylist()
        ]
        lengths[~safe] = sizes = np.array([len(x) for x in others], np.int64)
        starts[~safe] = len(blob) + np.cumsum(sizes) - sizes
        return np.concatenate([blob, *others]), starts, lengths

    def _cut(self, words: list[str]) -> np.ndarray:
        """Ids of plain words, with a mark before, between and after them."""
        cut = PATTERN.findall("\n" + "\n".join(words).lower() + "\n")
        missing = self.parts.missing(set(cut) - {"\n"})
        parts = self.parts.new
        if missing:
            found = self.bare.encode(missing, is_pretokenized=True, add_special_tokens=False)
            raw, size = np.array(found.ids, self.kind).tobytes(), self.kind.itemsize
            ends = (np.searchsorted(np.array(found.word_ids), np.arange(len(missing) + 1)) * size).tolist()
            parts.update((part, raw[a:b]) for part, a, b in zip(missing, ends, ends[1:]))
        parts["\n"] = self.mark.to_bytes(self.kind.itemsize, "little")
        blob = np.frombuffer(b"".join(map(parts.__getitem__, cut)), self.kind)
        for part in missing:
            if len(part) > _LONG:
                del parts[part]
        return blob
