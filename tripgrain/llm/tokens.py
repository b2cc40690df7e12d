"""Token ids with a public tokenizer file, inside tasks. Ids travel as little-endian unsigned 32-bit integers.

Words repeat: a stretch of texts is cut into pieces and each distinct piece is looked up once, all in Arrow. The ids of pieces
met before are remembered; the words that a stretch brings anew are encoded together, and what that took is given back. A piece starts where a space or line
break follows another character: both tokenizers in use end a pre-token there, so pieces can be encoded one by one. Texts
with other white space are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripgrain.llm.common import give_back

MEMO_BYTES = 24 << 20  # of remembered pieces; then a worker starts anew, and keeps those met again until it does so again
MEMO_CHARS = 48  # longer pieces are not remembered
GROUP_BYTES = 8 << 20  # of texts whose ids are handed on together
STRETCH_BYTES = 2 << 20  # of a group's texts that are encoded together; their pieces and places take many times their size
AT_ONCE = 1 << 13  # pieces given to the tokenizer at once; what it returns takes far more memory than the ids

OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85᠎​-‍⁠﻿]")
# A word and the marks after it: both tokenizers end a pre-token between the two, and before the next word's space.
# Latin-1 letters keep their number of bytes in lower case.
WORD = "^[ \\n]?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?#*$%&|]*$"
MARKS = re.compile(r"([.,;:!?#*$%&|]+)")
KEYS, IDS = pa.large_string(), pa.large_binary()
EMPTY = pa.scalar("", KEYS)
ASCII = {chr(c) for c in range(128)}
PROBES = ["The", " quick", "\nstraße", " ÀÉÿ", " x,;", " Zz#", "\nq."]


def _bytes_array(data: np.ndarray | bytes, ends: np.ndarray) -> pa.Array:
    """Binary values that follow each other in `data`, the first from 0; `ends` in bytes."""
    return pa.Array.from_buffers(IDS, len(ends), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64)), pa.py_buffer(data)])


def _parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a string or binary array without nulls, and where each begins and the last one ends."""
    places = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return np.frombuffer(array.buffers()[2] or b"", np.uint8)[places[0] : places[-1]], places - places[0]


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, and the place of each text's first one; at the end, their number. A null has none."""
    raw, edges = _parts(pc.fill_null(texts.cast(KEYS), EMPTY))
    space = (raw == ord(" ")) | (raw == ord("\n"))  # no other character holds these bytes
    begins = np.zeros(len(raw), bool)
    begins[1:] = space[1:] & ~space[:-1]
    begins[edges[edges < len(raw)]] = True
    starts = np.flatnonzero(begins)
    return pa.Array.from_buffers(KEYS, len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw)]), np.searchsorted(starts, edges)


class Pieces:
    """Remembered pieces: keys, their ids, and whether a piece was met more than once."""

    def __init__(self, keys: pa.Array | None = None, ids: pa.Array | None = None, again: np.ndarray | None = None):
        self.keys, self.ids = pa.array([], KEYS) if keys is None else keys, pa.array([], IDS) if ids is None else ids
        self.again = np.zeros(0, bool) if again is None else again

    def __len__(self) -> int:
        return len(self.keys)

    def __iter__(self) -> Iterator[str]:
        return iter(self.keys.to_pylist())

    def held(self) -> int:
        return self.keys.nbytes + self.ids.nbytes

    def find(self, keys: pa.Array) -> np.ndarray:
        """The place of each of these different keys, or -1."""
        if not len(self) or not len(keys):
            return np.full(len(keys), -1)
        # the hash table, made anew each time, is that of a stretch's keys, which are fewer
        found = pc.fill_null(pc.index_in(self.keys, value_set=keys), -1).to_numpy(zero_copy_only=False)
        held, at = np.flatnonzero(found >= 0), np.full(len(keys), -1)
        at[found[held]] = held
        return at

    def met_again(self) -> Pieces:
        return Pieces(self.keys.filter(pa.array(self.again)), self.ids.filter(pa.array(self.again)), np.zeros(self.again.sum(), bool))

    def add(self, keys: pa.Array, ids: pa.Array, again: np.ndarray) -> None:
        self.keys, self.ids = pa.concat_arrays([self.keys, keys]), pa.concat_arrays([self.ids, ids])
        self.again = np.concatenate((self.again, again))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.memo, self.older = Tokenizer.from_file(path), Pieces(), Pieces()
        plan = json.loads(self.tokenizer.to_str())
        suffix = plan["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # characters that an id stands for
        for token, k in vocabulary.items():
            self.sizes[k] = len(token.removesuffix(suffix))
        # words of Latin letters are written as the pre-tokenizer would, and go to the model alone
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {chr(c): written.pre_tokenize_str(chr(c))[0][0] for c in range(192, 256) if chr(c).isalpha()}
        self.lower = "Lowercase" in json.dumps(plan["normalizer"])
        self.space = "" if suffix else written.pre_tokenize_str(" ")[0][0]
        self.whole = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        self.alone = (normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit())
        # another kind of tokenizer: words go through all of it
        self.line = written.pre_tokenize_str("\n")[0][0] if self._plain(["\n"])[0] else ""
        self.direct = True
        found = self._words(pa.array(PROBES, KEYS))
        self.direct = found is not None and b"".join(found.to_pylist()) == self._plain(["".join(PROBES)])[0]

    def _model_ids(self, forms: str) -> list[int]:
        """Ids of written words between spaces; a second tokenizer without the first steps would hold its tables twice."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.alone
        try:
            return self.tokenizer.encode_batch_fast([forms], add_special_tokens=False)[0].ids
        finally:
            if self.whole[0] is not None:
                self.tokenizer.normalizer = self.whole[0]
            self.tokenizer.pre_tokenizer = self.whole[1]

    def _plain(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False)
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        return out

    def _words(self, keys: pa.Array) -> pa.Array | None:
        """Words of Latin letters with the marks after them: encoded as one text, then cut by the characters that ids stand
        for. None if that doesn't come out even."""
        whole = "\x02" + "\x02".join(keys.to_pylist())
        whole = whole.lower() if self.lower else whole
        # some passes at memory speed; what a letter becomes holds no other letter but the first one taken
        for letter in sorted(set(whole) - ASCII, key=lambda c: c != "Ã"):
            whole = whole.replace(letter, self.letters[letter])
        whole = MARKS.sub(r" \1", whole)
        # a line a piece, spaces between its pre-tokens
        whole = whole.replace("\x02\n", f"\x03{self.line} ").replace("\x02 ", "\x03" + self.space).replace("\x02", "\x03").replace("\x03", "\n")
        ids = np.array(self._model_ids(whole), "<u4")
        chars = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        lines = chars == ord("\n")
        counted = np.cumsum(~lines & (chars != ord(" ")))
        wanted = np.append(counted[np.flatnonzero(lines)[1:]], counted[-1])  # characters up to the end of each key
        ends = np.cumsum(self.sizes[ids])
        last = np.searchsorted(ends, wanted)
        if not len(ends) or last[-1] != len(ends) - 1 or not np.array_equal(ends[last], wanted):
            return None
        return _bytes_array(ids, 4 * (last + 1))

    def _new(self, keys: pa.Array) -> pa.Array:
        """Ids of pieces that are not remembered."""
        if not self.direct:
            return pa.array(self._plain(keys.to_pylist()), IDS)
        latin = pc.match_substring_regex(keys, WORD)
        words, others = keys.filter(latin), keys.filter(pc.invert(latin))
        parts = [pa.array(self._plain(others.to_pylist()), IDS)]
        for k in range(0, len(words), AT_ONCE):
            some = words.slice(k, AT_ONCE)
            found = self._words(some)
            parts.insert(-1, pa.array(self._plain(some.to_pylist()), IDS) if found is None else found)
        found = pa.concat_arrays(parts)
        if not len(others):
            return found
        at, own = np.empty(len(keys), np.int64), latin.to_numpy(zero_copy_only=False)
        at[own], at[~own] = np.arange(len(words)), np.arange(len(words), len(keys))
        return found.take(pa.array(at))

    def _look_up(self, keys: pa.Array, again: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Ids of each of these different pieces, and which of them take their whole text with them. again: pieces that
        these texts hold more than once."""
        if self.memo.held() > MEMO_BYTES:  # start anew, but for what is met again
            self.older, self.memo = self.memo.met_again(), Pieces()
        at = self.memo.find(keys)
        self.memo.again[at[at >= 0]] = True
        odd, gaps = np.zeros(len(keys), bool), np.flatnonzero(at < 0)
        if not len(gaps):
            return self.memo.ids.take(pa.array(at)), odd
        missing = keys.take(pa.array(gaps))
        before = self.older.find(missing)
        fresh = missing.filter(pa.array(before < 0))
        if OTHER_SPACE.search("".join(fresh.to_pylist())):
            odd[gaps[before < 0]] = [bool(OTHER_SPACE.search(k)) for k in fresh.to_pylist()]
        place = before.copy()
        place[before < 0] = len(self.older) + np.arange(len(fresh))
        found = pa.concat_arrays([self.older.ids, self._new(fresh)]).take(pa.array(place))
        ids_at = at.copy()
        ids_at[gaps] = len(self.memo) + np.arange(len(gaps))
        ids = pa.concat_arrays([self.memo.ids, found]).take(pa.array(ids_at))
        kept = ~odd[gaps] & (pc.utf8_length(missing).to_numpy(zero_copy_only=False) <= MEMO_CHARS)
        self.memo.add(missing.filter(pa.array(kept)), found.filter(pa.array(kept)), (again[gaps] | (before >= 0))[kept])
        return ids, odd

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, null and empty ones included."""
        flat, edges = _pieces(texts)
        coded = flat.dictionary_encode()
        if not len(coded):
            return [b""] * len(texts)
        which = coded.indices.to_numpy()
        ids, odd = self._look_up(coded.dictionary, np.bincount(which, minlength=len(coded.dictionary)) > 1)
        raw, places = _parts(ids.take(coded.indices))
        cuts, raw = places[edges].tolist(), memoryview(raw)
        out = [bytes(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if odd.any():
            met = np.concatenate(([0], np.cumsum(odd[which])))
            for n in np.flatnonzero(np.diff(met[edges])).tolist():
                out[n] = self._plain([texts[n].as_py()])[0]
        return out

    def encode_group(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_array(pa.array(texts, KEYS))

    def encode(self, text: str) -> bytes:
        return self.encode_group([text])[0]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per Python worker and file; reused by later tasks of the worker."""
    made = Encoder(path)
    give_back()
    return made


def _stretches(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about `size` bytes together; a longer text is not cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end: bytes) -> Iterator[tuple[list, list[bytes]]]:
    """Keys (first column) and ids of the texts (second column), each with `end` after it, some texts at a time."""
    coder = encoder(path)
    for batch in batches:
        texts = batch.column(1)
        for a, b in _stretches(texts, GROUP_BYTES):
            group, ids = texts.slice(a, b - a), []
            for c, d in _stretches(group, STRETCH_BYTES):
                ids += [x + end for x in coder.encode_array(group.slice(c, d - c))]
                give_back()
            yield batch.column(0).slice(a, b - a).to_pylist(), ids
