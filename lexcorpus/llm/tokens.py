"""Token ids of whole texts, a piece of text of every kind encoded once."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from lexcorpus.llm import texts as T

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CACHED = 1_000_000

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
#: Second bytes of the Latin letters U+00C0 to U+00FF; the first is 0xC3.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: Signs that end a run of letters and are not part of a contraction.
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in ".,;:!?"]] = True
#: What a byte can end: 1 a letter, 2 a sign.
_ENDS = _ASCII_LETTER.astype(np.uint8) + 2 * _SIGN.astype(np.uint8)
#: Bytes of the chunks that the rank file encodes: printable ASCII, line feeds and those letters.
_USUAL = np.zeros(256, bool)
_USUAL[32:127] = _USUAL[10] = _USUAL[0xC3] = True


class Encoder:
    """Ids of byte_bpe_50k.json, special tokens found in a text included, none added.

    A space between two letters, or a sign and a letter, always begins a token; so does a sign after
    a letter; and a lone line feed in such places is one. Texts are cut there, and each distinct
    chunk is encoded once for a batch and kept for later ones. Chunks of ASCII and Latin
    letters go through the rank file of the same vocabulary, which is faster; all others, and those
    that could hold a special token, through the tokenizer file itself.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        self.exact = Tokenizer.from_file(vocabulary)
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.first = np.zeros(0, np.int64)  # of their ids
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, chunk: bytes, usual: bool) -> list[int]:
        text = chunk.decode("utf-8", "replace")
        if usual and "<|" not in text:
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids

    def batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the bounds of the texts in them."""
        data, starts, ends = T.joined(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        before = np.zeros(len(data) + 1, np.uint8)
        before[1:] = _ENDS[data]
        latin = np.flatnonzero(data == 0xC3)
        latin = latin[latin + 1 < len(data)]
        latin = latin[_LATIN[data[latin + 1]]]
        before[latin + 2] = 1
        after = np.append(_ASCII_LETTER[data], False)
        after[latin] = True
        spaces = np.flatnonzero((data == 32) | (data == 10))
        spaces = spaces[(before[spaces] > 0) & after[spaces + 1]]
        signs = np.flatnonzero(_SIGN[data] & (before[:-1] == 1))
        cuts = np.concatenate([spaces, spaces[data[spaces] == 10] + 1, signs, starts])
        cuts.sort()
        place = np.searchsorted(starts, cuts, "right")  # texts begun up to a cut
        stops = np.concatenate([cuts[1:], [len(data)]])
        stops = np.minimum(stops, ends[place - 1])
        full = stops > cuts
        cuts, stops, place = cuts[full], stops[full], place[full] - 1
        hashes = T.mixed(T.RangeHashes(data).of(cuts, stops) ^ (stops - cuts).astype(np.uint64))
        distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHED:
            self._forget()
        spot = np.searchsorted(self.known, distinct)
        spot[spot == len(self.known)] = 0
        new = self.known[spot] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            at, to = cuts[index[new]], stops[index[new]]
            odd = np.concatenate([[0], np.cumsum(~_USUAL[data] & ~(_LATIN[data] & (np.concatenate([[0], data[:-1]]) == 0xC3)))])
            usual = (odd[to] - odd[at] == 0).tolist()
            raw = data.tobytes()
            found = [self._encode(raw[i:j], u) for i, j, u in zip(at.tolist(), to.tolist(), usual, strict=True)]
            self._learn(distinct[new], found)
            spot = np.searchsorted(self.known, distinct)
        first, count = self.first[spot][inverse], self.count[spot][inverse]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.arange(upto[-1]) + np.repeat(first - upto[:-1], count)]
        return ids, upto[np.searchsorted(place, np.arange(len(texts) + 1))]

    def _learn(self, hashes: np.ndarray, found: list[list[int]]) -> None:
        count = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for ids in found for i in ids), np.uint32, int(count.sum()))
        first = len(self.ids) + np.cumsum(count) - count
        at = np.searchsorted(self.known, hashes)  # both are sorted
        self.known, self.count = np.insert(self.known, at, hashes), np.insert(self.count, at, count)
        self.first = np.insert(self.first, at, first)
        self.ids = np.concatenate([self.ids, ids])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """The encoder of this worker; it keeps what it knows for later tasks."""
    if (vocabulary, ranks) not in _encoders:
        _encoders[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _encoders[vocabulary, ranks]


def token_ids(texts: list[str | None], vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Iterator[np.ndarray]:
    """The ids of each text; none for null and empty ones."""
    enc = encoder(vocabulary, ranks)
    for _, group in T.groups(texts):
        ids, cuts = enc.batch(group)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[a:b]
