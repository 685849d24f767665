"""Token ids of whole texts, with each distinct unit encoded once per worker.

Both tokenizers cut a text before they merge anything, and never merge over such a cut. So a text is
cut where a cut is certain, every distinct unit is encoded once by the tokenizers library and its ids are
remembered, and a text is the ids of its units. The memory is bounded: it is emptied when it is full.

A vocabulary's special tokens, such as ``<|endoftext|>``, may stand in a text literally. Read as ``markers`` they have
their own id, as the library has it by default, and a text with one is encoded whole; else they are text like any other.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa

from tripgrain.llm.words import Words, split_words, text_slices, word_hashes

#: Units that a worker remembers, at most.
REMEMBER = 800_000
#: Characters of new words that are encoded in one call.
JOINED = 1 << 16
#: Texts whose new units are encoded in one call.
TOGETHER = 64
_SPACED = re.compile(r" (?=\s|$)")
_WHITE = re.compile(r"[ \n\r\t]+")
#: First bytes of characters that may be white space outside 0x20 and 0x09-0x0D.
_MAY_BE_SPACE = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3])


def _byte_units(text: str) -> list[str]:
    """Units of a byte-level vocabulary: a space belongs to what follows, unless that is space or nothing."""
    parts = text.split(" ")
    if not _SPACED.search(text):
        return [parts[0], *map(" ".__add__, parts[1:])]
    out = [parts[0]]
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return out


def _word_units(text: str) -> list[str]:
    """Units of a vocabulary that drops white space."""
    return _WHITE.split(text)


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, units: Callable[[str], list[str]], markers: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not markers
        special = [re.escape(x.content) for x in self._tokenizer.get_added_tokens_decoder().values()] if markers else []
        self._marked = re.compile("|".join(special)).search if special else lambda text: None
        self._units = units
        self._new: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}

    def _learn(self, missing: list[str]) -> None:
        for at in range(0, len(missing), 4096):
            part = missing[at : at + 4096]
            ids = [found.ids for found in self._tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            together = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            ends = accumulate(4 * len(one) for one in ids)
            begin = 0
            for unit, end in zip(part, ends):
                self._new[unit] = together[begin:end]
                begin = end

    def _ids(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """The ids of each text in order; what several texts have new is learned in one call."""
        for at in range(0, len(texts), TOGETHER):
            part = [text or "" for text in texts[at : at + TOGETHER]]
            whole = [self._marked(text) is not None for text in part]
            several = [[] if one else self._units(text) for one, text in zip(whole, part)]
            known, old = self._new, self._old
            unseen = set().union(*several).difference(known)
            again = [unit for unit in unseen if unit in old]
            known.update((unit, old[unit]) for unit in again)
            self._learn(list(unseen.difference(again)))
            for one, text, units in zip(whole, part, several):
                yield self._ids(text) if one else b"".join(map(known.__getitem__, units))
            if len(known) > REMEMBER // 2:
                self._old, self._new = known, {"": b""}


class WordEncoder:
    """As :class:`Encoder`, for vocabularies that drop white space: words are found and told apart as arrays.

    Each distinct word of a slice of texts, by its 64-bit hash, is looked up once; those that the worker does not
    know are encoded together, separated by spaces, and cut apart by where their tokens begin. Ids are then
    gathered for all words at once, so no step is taken per word.
    """

    _split = staticmethod(split_words)

    def __init__(self, path: str, markers: bool = False):
        one = Encoder(path, _word_units, markers)
        self._tokenizer, self._marked, self._whole = one._tokenizer, one._marked, one._ids
        self._forget()

    def _forget(self) -> None:
        self._hash, self._at = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted; number of each
        self._flat, self._ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        size = np.array([len(unit) + 1 for unit in units], np.int64)
        batches = np.cumsum(size) // JOINED
        ids, counts = [self._flat], []
        for a, b in zip(*(lambda e: (e, [*e[1:], len(units)]))(np.flatnonzero(np.diff(batches, prepend=-1)).tolist())):
            found = self._tokenizer.encode(" ".join(units[a:b]), add_special_tokens=False)
            begins = np.cumsum(size[a:b]) - size[a:b]
            of = np.searchsorted(begins, np.array([start for start, _ in found.offsets], np.int64), "right") - 1
            ids.append(np.array(found.ids, "<u4"))
            counts.append(np.bincount(of, minlength=b - a))
        self._flat = np.concatenate(ids)
        self._ends = np.r_[self._ends, self._ends[-1] + np.cumsum(np.concatenate(counts))]

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        words = self._split(texts)
        distinct, first, back = np.unique(word_hashes(words), return_index=True, return_inverse=True)
        if len(self._at) > REMEMBER:
            self._forget()
        place = np.minimum(np.searchsorted(self._hash, distinct), max(len(self._hash) - 1, 0))
        new = self._hash[place] != distinct if len(self._hash) else np.ones(len(distinct), bool)
        if new.any():
            number = len(self._at) + np.arange(int(new.sum()))
            self._learn([words.bytes_of(i).decode() for i in first[new]])
            order = np.argsort(np.r_[self._hash, distinct[new]], kind="stable")
            self._hash, self._at = np.r_[self._hash, distinct[new]][order], np.r_[self._at, number][order]
        number = self._at[np.searchsorted(self._hash, distinct)][back] if len(distinct) else np.zeros(0, np.int64)
        begin, n = self._ends[number], self._ends[number + 1] - self._ends[number]
        ends = np.r_[0, np.cumsum(n)]
        ids = self._flat[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])]
        cuts = ends[words.first]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield ids[a:b].tobytes()

    def encode(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """The ids of each text in order."""
        whole = {i for i, text in enumerate(texts) if text and self._marked(text) is not None}
        plain = pa.array([None if i in whole else text for i, text in enumerate(texts)], pa.large_string())
        for first, some in text_slices(plain):
            for i, raw in enumerate(self._slice(some), first):
                yield self._whole(texts[i]) if i in whole else raw


def byte_units(texts: pa.Array) -> Words:
    """Units of a byte-level vocabulary: a space begins the word after it; all other white space stays where it is.

    No cut is made before bytes that may begin white space outside ASCII, where a space need not belong to what follows.
    """
    words = split_words(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets - offsets[0]
    inside = words.starts[words.starts > offsets[words.row]]
    cuts = inside[(words.data[inside - 1] == 0x20) & ~_MAY_BE_SPACE[words.data[inside]]] - 1
    begins = np.zeros(len(words.data), bool)
    begins[cuts] = begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    return Words(words.data, starts, np.r_[starts[1:], offsets[-1:]][: len(starts)],
                 np.repeat(np.arange(len(texts)), np.diff(first)), first)


class ByteEncoder(WordEncoder):
    """As :class:`WordEncoder`, for byte-level vocabularies, which keep white space: new units are encoded one by one."""

    _split = staticmethod(byte_units)

    def _learn(self, units: list[str]) -> None:
        ids, counts = [self._flat], []
        for at in range(0, len(units), 4096):
            found = [one.ids for one in self._tokenizer.encode_batch_fast(units[at : at + 4096], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), "<u4", int(counts[-1].sum())))
        self._flat = np.concatenate(ids)
        self._ends = np.r_[self._ends, self._ends[-1] + np.cumsum(np.concatenate(counts))]


_encoders: dict[tuple[str, bool, bool], WordEncoder] = {}


def encoder(path: str, word_level: bool, markers: bool = False) -> WordEncoder:
    """This worker's encoder for a vocabulary file; ``word_level`` for those that drop white space."""
    key = (path, word_level, markers)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, markers) if word_level else ByteEncoder(path, markers)
    return _encoders[key]
