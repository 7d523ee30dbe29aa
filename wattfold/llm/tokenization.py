"""Token ids of whole texts by the ``tokenizers`` library, with a cache of words.

Both kinds of tokenizer files cut a text into words before they merge, so a text may be cut at
places that no word spans, each different part be encoded once, and the ids be put together again.
The cuts hold whatever Unicode tables a regular expression has:

* byte-level BPE keeps one space before a word. A single space or line feed between two characters
  that are not white space is such a place: the space goes with what follows, the line feed stands
  alone. Texts with any other white space are cut at single spaces only.
* BPE with word ends drops white space, so every run of ASCII blanks is such a place.

A part of letters and ASCII marks after them is cut once more between the two. Words of letters are
encoded many at a time, in one text; the marks that word starts or word ends carry in the vocabulary
tell whose ids are whose. Arrow cuts texts and finds the different parts of a block, so Python looks
up each of those once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wattfold.llm.common import KEPT

# Parts whose ids a worker keeps, each about 150 bytes; beyond that it forgets those met only once.
CACHED_PARTS = 700_000
# Parts that it keeps between tasks, when other work needs the memory.
KEPT_PARTS = 350_000

# Bytes of text that are cut into parts at once.
ENCODED_BYTES = 1 << 20

_SPACE = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = re.compile(r"[^ \t\n\r]+")
_BLOCK = 512
# Patterns of Arrow's kernels. Texts that cannot be cut at every single blank: white space other than space and
# line feed (or the mark that cuts are made with), a blank at either end, two blanks in a row.
_OTHER = (
    r"[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|\A[ \n]|[ \n]\z|[ \n][ \n]"
)
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_CUT = rf"\A(?P<word> ?{_LETTERS})(?P<marks>[!-/:-@\[-`{{-~]+)\z"


def _strings(texts: pa.Array) -> list[str]:
    """``to_pylist`` without a scalar object for each; the array must have no nulls."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class _Known(dict):
    """Number of each part; an unknown one gets the next number and waits to be learned."""

    def __init__(self) -> None:
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.waiting.append(part)
        return number


class Encoder:
    """Ids of texts under one tokenizer file; special tokens' strings count as ordinary text."""

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.word_ends = any(token.endswith("</w>") for token in vocabulary)
        self.marked = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.marked[number] = token.endswith("</w>") if self.word_ends else token.startswith("Ġ")
        self.most = CACHED_PARTS
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int64)
        self.used = 0

    def trim(self, most: int = KEPT_PARTS) -> None:
        """Keep at most so many parts: those met more than once, or more often if those are too many."""
        if len(self.known) <= most:
            return
        met = self.met[: len(self.known)]
        least = 2
        while (met >= least).sum() > most:
            least *= 2
        keep = np.flatnonzero(met >= least)
        chosen = set(keep.tolist())
        parts = [part for number, part in enumerate(self.known) if number in chosen]
        ids, sizes = self._gather(keep)
        self._forget()
        self.known.update(zip(parts, range(len(parts)), strict=True))
        self._make_room()
        self._store(np.arange(len(parts)), ids, sizes)

    def _make_room(self) -> None:
        """A place for every part that has a number."""
        while len(self.known) > len(self.starts):
            for name in ("starts", "sizes", "met"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All parts of all texts in a row, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if self.word_ends:
            odd = pc.or_(pc.match_substring(texts, "\x0b"), pc.match_substring(texts, "\x0c"))
        else:
            odd = pc.match_substring_regex(texts, _OTHER)
        odd = odd.to_numpy(zero_copy_only=False)
        some = texts.filter(pa.array(~odd)) if odd.any() else texts
        if self.word_ends:
            lists = pc.ascii_split_whitespace(some)
        else:
            marked = pc.replace_substring(pc.replace_substring(some, " ", "\0 "), "\n", "\0\n\0")
            lists = pc.split_pattern(marked, "\0")
        if odd.any():
            rest = [self._odd_parts(text) for text in texts.filter(pa.array(odd)).to_pylist()]
            order = np.empty(len(texts), np.int64)
            order[np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])] = np.arange(len(texts))
            lists = pa.concat_arrays([lists, pa.array(rest, lists.type)]).take(pa.array(order))
        return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)

    def _odd_parts(self, text: str) -> list[str]:
        if self.word_ends:
            return _BLANKS.findall(text)
        first, *rest = _SPACE.split(text)
        return [first, *[" " + part for part in rest]]

    def _store(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep the ids of the parts of these numbers."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _learn_any(self, parts: list[str], numbers: np.ndarray) -> None:
        for start in range(0, len(parts), _BLOCK):
            block = parts[start : start + _BLOCK]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(block, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
            self._store(numbers[start : start + _BLOCK], ids, sizes)

    def _learn_words(self, words: list[str], numbers: np.ndarray) -> None:
        """Words of letters; under byte-level BPE each begins with a space."""
        for start in range(0, len(words), _BLOCK):
            block = words[start : start + _BLOCK]
            joined = (" " if self.word_ends else "").join(block)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(self.marked[ids])
            if len(marks) != len(block):
                self._learn_any(block, numbers[start : start + _BLOCK])
                continue
            bounds = np.concatenate([[0], marks + 1]) if self.word_ends else np.concatenate([marks, [len(ids)]])
            self._store(numbers[start : start + _BLOCK], ids, np.diff(bounds))

    def _numbers(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def _learn(self) -> None:
        """Encode the parts that wait; their numbers follow each other."""
        known = self.known
        waiting, known.waiting = pa.array(known.waiting, pa.string()), []
        numbers = np.arange(len(known) - len(waiting), len(known))
        halves = pc.extract_regex(waiting, _CUT)
        cut = halves.is_valid()
        halves, cut_numbers = halves.filter(cut), numbers[cut.to_numpy(zero_copy_only=False)]
        pairs = np.stack([self._numbers(_strings(halves.field(i))) for i in (0, 1)], axis=1).ravel()
        # Words and marks met only together so far.
        more, known.waiting = pa.array(known.waiting, pa.string()), []
        parts = pa.concat_arrays([waiting.filter(pc.invert(cut)), more])
        whole = numbers[~cut.to_numpy(zero_copy_only=False)]
        numbers = np.concatenate([whole, np.arange(len(known) - len(more), len(known))])
        self._make_room()
        words = pc.match_substring_regex(parts, rf"\A{'' if self.word_ends else ' '}{_LETTERS}\z")
        mask = words.to_numpy(zero_copy_only=False)
        self._learn_words(_strings(parts.filter(words)), numbers[mask])
        self._learn_any(_strings(parts.filter(pc.invert(words))), numbers[~mask])
        ids, sizes = self._gather(pairs)
        self._store(cut_numbers, ids, sizes.reshape(-1, 2).sum(axis=1))

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[numbers]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.ids[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)], sizes

    def encode(self, texts: pa.Array | Sequence[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin (one more than there are texts).

        A null text has the ids of an empty one; ``end_id`` follows each text's ids.
        """
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if len(self.known) > self.most:
            self.trim(self.most // 2)
        flat, counts = self.parts(texts)
        flat = flat.dictionary_encode()
        different = self._numbers(_strings(flat.dictionary))
        if self.known.waiting:
            self._learn()
        places = flat.indices.to_numpy(zero_copy_only=False)
        self.met[different] += np.bincount(places, minlength=len(different))
        flat, sizes = self._gather(different[places])
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        if end_id is not None:
            flat = np.insert(flat, at[1:], end_id)
            at = at + np.arange(len(at))
        return flat, at


_ENCODERS: dict[str, Encoder] = {}
KEPT.append(_ENCODERS)


def encoder(file: str, most: int = CACHED_PARTS) -> Encoder:
    """The worker's encoder for a file, which keeps the ids of at most so many parts.

    It stays in the worker until work that needs the memory drops it.
    """
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    _ENCODERS[file].most = most
    return _ENCODERS[file]
