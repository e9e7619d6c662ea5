"""Encoding whole texts with a public tokenizer inside tasks.

A text is cut before each white-space run that follows other characters, and between a letter
or digit and a full stop or comma at the end of such a run.  Both vocabularies pre-split texts there, so the ids
of a text are the ids of its pieces one after the other.  The pieces of a slice of texts are
found by their bytes and coded by spelling; the distinct ones are looked up or encoded, and
their ids are taken by code.  A task encodes a frequent piece once.  Texts with white space beyond ``[\\x20\\x09-\\x0D]`` (where the libraries' rules
differ), and texts that may hold the string of an added token, are encoded in one piece.
"""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

import numpy as np
import public_tokenizers
import pyarrow as pa

from .common import KEPT

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
END_ID = 1
CACHED = 48 << 20  # bytes, about, of segments, and as many of other pieces, that a task remembers; others are encoded again
_ENTRY = 160       # bytes that a remembered one takes besides its characters and ids

_SPACES = " \t\n\v\f\r"
_IS_SPACE = np.isin(np.arange(256), list(_SPACES.encode()))
_IS_STOP = np.isin(np.arange(256), list(b".,"))
_IS_ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])
_IS_LATIN = np.array([i >= 128 and chr(i + 64).isalpha() for i in range(256)])  # second byte of a letter whose first is C3
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_PLAIN_WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")  # one pre-token each, and kept as it is


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        t = self._tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        # an added token's string in a text gives its id; these begin it, whatever the case of the rest
        self._marks = {x.content[:2] for x in t.get_added_tokens_decoder().values()}
        self.size = t.get_vocab_size()
        self._drops_space = vocabulary == WORD_BPE
        names = [t.id_to_token(i) or "" for i in range(self.size)]
        self._ends = np.array([x.endswith("</w>") for x in names])
        self._bytes = np.array([len(x) for x in names])  # byte-level: a character a byte
        self._segments_known: dict[str, bytes] = {}
        self._pieces_known: dict[str, bytes] = {}
        self._room = {id(self._segments_known): cached, id(self._pieces_known): cached}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def _apart(self, piece: str) -> bool:
        """Whether the piece stays apart when it is joined to others like it: these are encoded in one call."""
        if self._drops_space:
            return bool(_PLAIN_WORD.fullmatch(piece))
        return piece[0] in _SPACES and piece[-1] not in _SPACES

    def _encode_joined(self, pieces: list[str]) -> list[bytes]:
        text = (" " if self._drops_space else "").join(pieces)
        ids = np.frombuffer(self._ids([text])[0], "<u4")
        if self._drops_space:  # the last id of each word says so
            cuts = np.flatnonzero(self._ends[ids]) + 1
        else:  # ids keep all bytes
            cuts = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum([len(p.encode()) for p in pieces])) + 1
        if len(cuts) != len(pieces) or cuts[-1] != len(ids):
            raise ValueError("pieces do not stay apart")
        raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, cache: dict[str, bytes], missing: list[str], encode) -> list[str]:
        """Adds all that is missing to ``cache``; what goes beyond the limit is to be forgotten after use."""
        if missing:
            found = encode(missing)
            cache.update(zip(missing, found))
            taken = sum(map(len, missing)) + sum(map(len, found)) + _ENTRY * len(missing)
            if taken > self._room[id(cache)]:
                return missing
            self._room[id(cache)] -= taken
        return []

    def _whole(self, text: str) -> bool:
        return bool(_ODD_SPACE.search(text)) or any(m in text for m in self._marks)

    def _lowered(self, text: str) -> str:
        """This vocabulary is of lower case; beyond these characters the library itself lowers."""
        try:
            text.encode("latin-1")
            return text.lower()
        except UnicodeEncodeError:
            return text

    def _pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All pieces of the texts in order, and where each text's begin among them, and all end."""
        raw = [t.encode() for t in texts]
        ends = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        del raw
        edge = np.zeros(len(data) + 1, bool)  # a text begins here or all end
        edge[ends] = True
        space = _IS_SPACE[data]
        follows = np.concatenate([[True], space])[:len(data)]  # space before this byte
        begins = ~space & (edge[:-1] | follows) if self._drops_space else edge[:-1] | (space & ~follows)
        # a stop or comma at the end of a segment, after a letter or digit
        stops = np.flatnonzero(_IS_STOP[data] & ~edge[:-1])
        stops = stops[edge[stops + 1] | space[np.minimum(stops + 1, len(data) - 1)]]
        before = data[stops - 1]
        begins[stops[_IS_ALNUM[before] | (_IS_LATIN[before] & (data[stops - 2] == 0xC3))]] = True
        places = np.concatenate([[0], np.cumsum(begins)])[ends]
        if self._drops_space:
            data, begins = data[~space], begins[~space]
        offsets = np.append(np.flatnonzero(begins), len(data))
        pieces = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        return pieces, places

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        segments, others = self._segments_known, self._pieces_known
        found = [segments.get(p) for p in pieces]
        places = [i for i, x in enumerate(found) if x is None]
        missing = [p for p in map(pieces.__getitem__, places) if p not in others]
        apart = [self._apart(p) for p in missing]
        lost = self._learn(segments, [p for p, x in zip(missing, apart) if x], self._encode_joined)
        left = self._learn(others, [p for p, x in zip(missing, apart) if not x], self._ids)
        for i in places:
            found[i] = segments[p] if (p := pieces[i]) in segments else others[p]
        for cache, forget in ((segments, lost), (others, left)):
            for p in forget:
                del cache[p]
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        odd = [self._whole(t) for t in texts]
        plain = ["" if o else self._lowered(t) if self._drops_space else t for t, o in zip(texts, odd)]
        pieces, places = self._pieces(plain)
        coded = pieces.dictionary_encode()
        ids = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[places].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        whole = iter(self._ids([t for t, o in zip(texts, odd) if o]))
        return [next(whole) if o else bytes(raw[a:b]) for o, a, b in zip(odd, at, at[1:])]


@contextmanager
def encoder(vocabulary: str):
    """An encoder for one task.  The worker keeps it for the stage's next task, until a stage of another kind lets it go."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    if vocabulary not in KEPT:
        KEPT.clear()
        KEPT[vocabulary] = Encoder(vocabulary)
    try:
        yield KEPT[vocabulary]
    finally:
        pa.default_memory_pool().release_unused()
