"""Token ids of whole columns, one encoding per distinct word."""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tradeflow.llm import words as W

#: Distinct words an encoder remembers before it starts anew.
MOST_WORDS = 1 << 19
#: Bytes of text whose words are told apart before they are looked up, and words
#: whose ids are copied at once: little enough for a core's cache.
PIECE_BYTES, COPY_WORDS = 1 << 18, 1 << 16
# Lower-case letters of ASCII and Latin-1, and the latter's two UTF-8 bytes as
# byte-level vocabularies write them: a printable byte as the character of that
# number, the others as the characters from U+0100 on, in their order.
_PLAIN = "".join(chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)] if c != 0xF7)
_PRINTABLE = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTES = {ord(c): "".join(_ALPHABET[b] for b in c.encode()) for c in _PLAIN if ord(c) > 127}


_MARK, _LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LETTER[[b for b in range(128) if chr(b).isalpha()]] = True
_SIGN[[0x97, 0xB7]] = True


class WordEncoder:
    """Ids of texts under a tokenizer file of the word-level BPE kind: white
    space only separates, letters and marks are separate tokens, A-Z count as
    a-z. Then a text's ids are its words' ids in a row, each distinct word is
    encoded once, and words may be compared after lowering A-Z and after
    setting off the marks that follow a letter. It travels as its path; as a
    broadcast, the tasks of a stage that share a Python worker share its words."""

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None
        self._forget()

    def __reduce__(self):
        return type(self), (self.path,)

    def _open(self) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(self.path)
        self.merges = self.tokenizer.model

    def _encode(self, word: str) -> list[int]:
        # Normalising and splitting leave a word of plain letters as it is: only
        # the merges are left, on its bytes in the vocabulary's alphabet.
        if not (word.isascii() and word.isalpha() and word.islower()):
            if word.strip(_PLAIN):
                return self.tokenizer.encode(word, add_special_tokens=False).ids
            word = word.translate(_BYTES)
        return [t.id for t in self.merges.tokenize(word)]

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint16)
        self.ends = np.zeros(1, np.int64)

    def _set_off(self, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts with A-Z lowered and a space between each letter and an
        ASCII mark after it; as they are where special tokens may occur."""
        if len(data) > 1 and b"<|" not in data.tobytes():
            at = np.flatnonzero(_MARK[data])
            at = at[at > 0]
            one, two = data[at - 1], np.where(at > 1, data[at - 2], 0)
            # The second byte of U+00C0 to U+024F but for the two signs there and
            # U+0130, which gets a combining mark when it is lowered.
            wide = (two >= 0xC3) & (two <= 0xC9) & ~((two == 0xC3) & _SIGN[one]) & ~((two == 0xC4) & (one == 0xB0))
            at = at[_LETTER[one] | wide]
            # A letter before a non-ASCII byte may carry a combining mark, which
            # composes with some letters in one case only.
            low, before = W.lower_ascii(data), np.flatnonzero(data[1:] >= 128)
            low[before] = data[before]
            data = np.insert(low, at, 32)  # at a text's start it changes nothing
            offsets = offsets + np.searchsorted(at, offsets)
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); null has none."""
        if self.tokenizer is None:
            self._open()
        if len(self.known) > MOST_WORDS:
            self._forget()
        split = [pc.ascii_split_whitespace(self._set_off(data, offsets)) for *_, data, offsets in W.pieces(texts, PIECE_BYTES)]
        distinct = [own.flatten().dictionary_encode() for own in split]
        # The known words come first, so they keep their numbers.
        words = pa.concat_arrays([self.known, *(own.dictionary for own in distinct)]).dictionary_encode()
        new = words.dictionary[len(self.known):].to_numpy(zero_copy_only=False).tolist()
        number = words.indices.to_numpy()[len(self.known):]
        first = np.cumsum([0, *(len(own.dictionary) for own in distinct)])
        at = np.concatenate([number[:0], *(number[k:][own.indices.to_numpy()] for k, own in zip(first, distinct))])
        if new:
            encoded, lengths = array("H"), np.zeros(len(new), np.int64)
            for k, word in enumerate(new):
                own = self._encode(word)
                encoded.extend(own)
                lengths[k] = len(own)
            self.known = words.dictionary
            self.ids = np.concatenate([self.ids, np.frombuffer(encoded, np.uint16)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        copied, counts = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for lo in range(0, len(at), COPY_WORDS):
            own = at[lo:lo + COPY_WORDS]
            begin, n = self.ends[own], self.ends[own + 1] - self.ends[own]
            after = np.cumsum(n)
            copied.append(self.ids[np.repeat(begin - after + n, n) + np.arange(after[-1])])
            counts.append(n)
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        bounds = np.cumsum(np.concatenate([[0], *(np.diff(own.offsets.to_numpy()) for own in split)]))
        return np.concatenate(copied), np.diff(total[bounds])
