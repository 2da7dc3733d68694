"""Token ids of whole texts with the public tokenizers, at the cost of the distinct words.

Both tokenizers cut a text into words before any merge, and no merge crosses a
word. A single space between two other characters is always such a border, so a
text is split there, each distinct word is encoded once per worker process (a
bounded cache), and the ids of a text are the ids of its words in order. Words
share the ids of their parts (letters, marks) the same way. Texts with runs of
white space are cut by pattern instead; texts with control characters that
Python and the tokenizers class differently, or with a special token's string,
are encoded whole.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 250_000  # words and parts kept per task, about 60 MB; beyond it the cache starts anew

# Latin letters, and marks that may directly follow a word.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_MARKS = re.escape(".,;:!?#*$%&|")
_PART = re.compile(
    rf"\s+(?!\S)| ?[{_LATIN}]++(?=[\s{_MARKS}]|\Z)| ?[{_MARKS}]+(?=\s|\Z)| ?\S+|\s")
_SIMPLE = re.compile(rf" ?(?:[{_LATIN}]+|[{_MARKS}]+)")
_WHOLE = r"[\x00\x1c-\x1f]|<\|"
_FIRST = "\x00"  # marks the first word of a text, which has no space before it


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """Character -> the letters that byte-level models write for its UTF-8 bytes.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in (*range(0x20, 0x7F), *range(0xC0, 0x250))}


class _Parts(dict):
    """Part -> its ids as bytes, learnt when first asked for."""

    def __init__(self, encoder: "WordEncoder"):
        super().__init__()
        self.tokenize, self.ids = encoder.tokenizer.model.tokenize, encoder._ids
        self.form = encoder.prepare

    def __missing__(self, part: str) -> bytes:
        core = part[1:] if part[0] == " " else part
        if self.form and (core.isalpha() and core.isascii() or _SIMPLE.fullmatch(part)):
            own = [t.id for t in self.tokenize(self.form(part, core))]
        else:
            own = self.ids(part)
        self[part] = got = array("I", own).tobytes()
        return got


def _with_space(part: str, core: str) -> str:
    """The bytes of a part and its space, as byte-level models write them."""
    table = _byte_letters()
    core = core if core.isascii() else core.translate(table)
    return table[32] + core if part[0] == " " else core


def _lower(part: str, core: str) -> str:
    """The bytes of a part in lower case, without its space."""
    core = core.lower()
    return core if core.isascii() else core.translate(_byte_letters())


class WordEncoder:
    """Ids of texts from the tokenizer file ``path``, without special tokens added."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.prepare = self._find_preparation()
        self._reset()

    def _reset(self) -> None:
        self.parts = _Parts(self)
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lens = np.zeros(0, dtype=np.int64)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _find_preparation(self):
        """How a part of letters or marks alone reaches the model.

        Such a part is one word to the tokenizer, so its ids are the model's own; None if neither form fits."""
        probes = [" the", "Word", " école", "###", " Ünï", ",", " Straße", "ÉÀÇ", " ǅ", " |", " Ÿþ", "...", " a"]
        for form in (_with_space, _lower):
            if all([t.id for t in self.tokenizer.model.tokenize(form(p, p.lstrip(" ")))] == self._ids(p) for p in probes):
                return form
        return None

    def _by_parts(self, text: str) -> bytes:
        """Ids of a text, as 32-bit integers, from the ids of its parts."""
        return b"".join(map(self.parts.__getitem__, _PART.findall(text)))

    def _letters(self, word: str) -> bytes:
        """Ids of a word of ASCII letters and the space before it: one part, which need not be kept beside the word."""
        got = self.parts.get(" " + word)
        if got is None:
            got = array("I", [t.id for t in self.parts.tokenize(self.prepare(" " + word, word))]).tobytes()
        return got

    def _add(self, made: list[bytes]) -> range:
        """Append ids; their places."""
        at = len(self.lens)
        lens = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(made), dtype=np.uint32)])
        return range(at, at + len(made))

    def _places(self, words: list[str]) -> np.ndarray:
        """Place of each word; -1 beside more white space, where the border is not certain."""
        known, part, cut, join = self.places, self.parts.__getitem__, _PART.findall, b"".join
        letters = self._letters if self.prepare else lambda w: part(" " + w)
        safe, made = [], []
        for w in [w for w in words if w not in known]:
            if w.isalpha() and w.isascii():
                safe.append(w)
                made.append(letters(w))
                continue
            if w[:1] == _FIRST:
                text = w[1:]
                if text and text[-1].isspace():
                    known[w] = -1
                    continue
            elif not w or w[0].isspace() or w[-1].isspace():
                known[w] = -1
                continue
            else:
                text = " " + w
            safe.append(w)
            made.append(join(map(part, cut(text))))
        known.update(zip(safe, self._add(made)))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._ids(text), dtype=np.uint32)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, number of ids of each text); null counts as empty."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(column):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        if len(self.places) + len(self.parts) > self.cache_words:
            self._reset()
        words = pc.split_pattern(column, " ")
        count = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(count) - count
        coded = words.flatten().dictionary_encode()
        at = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin = pc.list_element(words, 0)
        at[first] = self._places(list(dict.fromkeys(_FIRST + w for w in begin.to_pylist())))[
            begin.dictionary_encode().indices.to_numpy()]
        whole = set(np.flatnonzero(pc.match_substring_regex(column, _WHOLE).to_numpy(zero_copy_only=False)).tolist())
        special = sorted(whole.union((np.searchsorted(first, np.flatnonzero(at < 0), side="right") - 1).tolist()))
        if special:
            kept = len(self.flat), len(self.lens)
            made = [array("I", self._ids(column[k].as_py())).tobytes() if k in whole else self._by_parts(column[k].as_py())
                    for k in special]
            pieces, lo = [], 0
            for k, place in zip(special, self._add(made)):
                pieces += [at[lo:first[k]], np.array([place])]
                lo = first[k] + count[k]
            at = np.concatenate([*pieces, at[lo:]])
            count[special] = 1
            first = np.cumsum(count) - count
        n = self.lens[at]
        ends = np.cumsum(n)
        total = int(ends[-1])
        kind = np.int32 if total + len(self.flat) < 1 << 31 else np.int64  # half the memory where it fits
        place = np.repeat((self.starts[at] - ends + n).astype(kind), n)
        place += np.arange(total, dtype=kind)
        ids = self.flat[place]
        per_text = np.add.reduceat(n, first)
        if special:  # whole texts are no words to remember
            self.flat, self.lens, self.starts = self.flat[:kept[0]], self.lens[:kept[1]], self.starts[:kept[1]]
        return ids, per_text


def worker_encoder(path: str) -> WordEncoder:
    """A task's encoder; it ends with the task, so that idle workers hold no tokenizer and no cache."""
    return WordEncoder(path)


def slices_of(texts: pa.Array, max_bytes: int = 1 << 22) -> list[slice]:
    """Slices of ``texts`` of about ``max_bytes`` bytes, so that memory follows the slice."""
    if not len(texts):
        return []
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = (ends - 1) // max_bytes
    cuts = np.flatnonzero(np.diff(part)) + 1
    return [slice(int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(texts)])]


def batches_of(texts: list[str | None], max_chars: int = 1 << 22) -> list[slice]:
    """The same for a list of strings, by characters."""
    out, lo, n = [], 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= max_chars:
            out.append(slice(lo, i + 1))
            lo, n = i + 1, 0
    if lo < len(texts):
        out.append(slice(lo, len(texts)))
    return out


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
