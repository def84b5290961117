"""Secret scans: credential patterns, and strings that compression finds new.

Method: dictionary-primed zstandard novelty. A string near a sensitive word is
measured by the bytes it adds when the text around it is compressed with a
dictionary of the corpus's own identifiers: names, words and repeats cost
little, a random key costs about what it is long. What stays incompressible is
reported beside the spans that fixed patterns find.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.words import utf8

#: Kinds in the order that spans of one start are listed in.
KINDS = ("assign", "access", "hex", "novel")
#: Least lengths: the value of an assignment, an access key, a hex string.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: A candidate begins so many bytes after a sensitive word at most, on its line.
REACH = 64
#: Text around a candidate that it is compressed with, in bytes.
BEFORE, AFTER = 512, 128
#: Share of its length from which on a candidate counts as incompressible.
NOVEL = 0.6
#: Identifiers that prime the compressor: at most so many, of at most so many bytes together.
DICTIONARY_WORDS, DICTIONARY_BYTES = 4096, 1 << 15
#: Bytes of a text whose hex runs are looked for at once.
BLOCK_BYTES = 1 << 20
LEVEL = 3

# The patterns that the contract of the scan names.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = np.zeros(256, bool)
_HEX[0x30:0x3A] = _HEX[0x61:0x67] = True

#: Words that make what follows them sensitive, lower case.
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key",
             "private_key", "credential", "authorization", "bearer")
_STEMS = (b"passw", b"pwd", b"secret", b"token", b"api", b"access_key", b"private_key", b"credential",
          b"authorization", b"bearer")
_NEAR = re.compile(rb"(?i:" + "|".join(SENSITIVE).encode() + rb")")
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{12,}={0,2}")
_IDENTIFIER = re.compile(rb"[A-Z]?[a-z]{2,31}|[A-Z]{3,32}")

Span = tuple[int, int, int]  # start, index of kind, end; in bytes


def hex_runs(raw: np.ndarray, least: int = LEAST_HEX) -> list[tuple[int, int]]:
    """Runs of ``least`` or more of 0-9a-f, a block at a time."""
    out, last = [], -1
    for lo in range(0, len(raw) + 1, BLOCK_BYTES):
        block = raw[lo:lo + BLOCK_BYTES]
        other = np.flatnonzero(~_HEX[block]) + lo
        if lo + BLOCK_BYTES > len(raw):
            other = np.append(other, len(raw))
        stops = np.concatenate([[last], other])
        wide = np.flatnonzero(np.diff(stops) > least)
        out += [(int(stops[k]) + 1, int(stops[k + 1])) for k in wide]
        last = int(stops[-1])
    return out


def base_spans(text: bytes, lowered: bytes, raw: np.ndarray) -> list[Span]:
    """Spans of the fixed patterns (whole matches), by start, then kind."""
    found: list[Span] = []
    if any(stem in lowered for stem in (b"passw", b"secret", b"token", b"api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(a, 2, b) for a, b in hex_runs(raw)]
    return sorted(found)


def candidates(text: bytes, lowered: bytes, base: list[Span]) -> list[tuple[int, int]]:
    """Strings near a sensitive word that no base span touches: letters, digits
    and +/_- with at least a digit and a letter."""
    if not any(stem in lowered for stem in _STEMS):
        return []
    ends = np.array([b for _, _, b in base], np.int64)
    starts = np.array([a for a, _, _ in base], np.int64)
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    out, done = [], 0
    for word in _NEAR.finditer(text):
        line = text.find(b"\n", word.end(), word.end() + REACH)
        stop = word.end() + REACH if line < 0 else line
        at = max(word.end(), done)
        while at < stop:
            m = _CANDIDATE.search(text, at)
            if m is None or m.start() >= stop:
                break
            at = done = m.end()
            a, b = m.span()
            before = int(np.searchsorted(starts, b, "left"))
            if before and reach[before - 1] > a:
                continue
            if re.search(rb"[0-9]", m[0]) and re.search(rb"[A-Za-z]", m[0]):
                out.append((a, b))
    return out


def surroundings(text: bytes, a: int, b: int) -> tuple[bytes, bytes]:
    return text[max(0, a - BEFORE):a], text[b:b + AFTER]


def _texts(column: pa.Array) -> Iterator[tuple[bytes, bytes, np.ndarray]]:
    data, offsets = utf8(column)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        raw = data[lo:hi]
        text = raw.tobytes()
        yield text, text.lower(), raw


def identifiers(docs: DataFrame) -> DataFrame:
    """(word, n): identifier parts around candidates of the whole corpus, by the
    number of candidates they stand around. Candidates and base spans themselves
    are left out, so a repeated secret primes nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text, lowered, raw in _texts(batch.column("text")):
                if not any(stem in lowered for stem in _STEMS):
                    continue
                base = base_spans(text, lowered, raw)
                found = candidates(text, lowered, base)
                if not found:
                    continue
                secret = sorted([(a, b) for a, _, b in base] + found)
                first = 0
                for a, b in found:
                    lo, hi = max(0, a - BEFORE), min(len(text), b + AFTER)
                    while first < len(secret) and secret[first][1] <= lo:
                        first += 1
                    window, at = [], lo
                    for s, e in secret[first:]:
                        if s >= hi:
                            break
                        window.append(text[at:max(at, s)])
                        at = max(at, e)
                    window.append(text[at:max(at, hi)])
                    for word in set(_IDENTIFIER.findall(b"\n".join(window))):
                        seen[word] = seen.get(word, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS, size: int = DICTIONARY_BYTES) -> bytes:
    """The most frequent identifiers (at least two candidates), the commonest last."""
    top = identifiers(docs).filter("n >= 2").orderBy(F.desc("n"), "word").limit(words).collect()
    out, length = [], 0
    for row in top:
        word = row["word"].encode()
        if length + len(word) + 1 > size:
            break
        out.append(word)
        length += len(word) + 1
    return b" ".join(reversed(out))


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, primer: bytes):
        options = {}
        if len(primer) >= 8:
            options["dict_data"] = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            options["dict_data"].precompute_compress(level=LEVEL)
        self._zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, **options)

    def share(self, text: bytes, a: int, b: int) -> float:
        """The bytes that text[a:b] adds, as a share of its length."""
        before, after = surroundings(text, a, b)
        alone = len(self._zstd.compress(before + after))
        return (len(self._zstd.compress(before + text[a:b] + after)) - alone) / (b - a)


def scan(docs: DataFrame, novel: float = NOVEL) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Base spans are the whole matches of the fixed patterns, leftmost and not
    overlapping per kind; an assignment whose value, an access key or hex string
    that is too short is dropped. ``spans`` lists them and the strings whose
    novelty is ``novel`` or more as kind:start:end, in code points, by start and
    then kind, joined by commas; base_sha256 is the hash of such a list of base
    spans alone. Whole texts of any length are read; null and empty texts have
    no spans, repeated rows are scanned alike, an empty table gives an empty
    result, other columns are not read.

    The texts are read twice: once for the identifiers of the whole corpus (the
    dictionary, of bounded size, goes to every task), once for the spans.
    """
    primer = dictionary(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(primer)
        for batch in batches:
            counts: tuple[list[int], ...] = ([], [], [])
            digests, lists = [], []
            for text, lowered, raw in _texts(batch.column("text")):
                base = base_spans(text, lowered, raw)
                new = [(a, 3, b) for a, b in candidates(text, lowered, base) if measure.share(text, a, b) >= novel]
                own = _code_points(raw, sorted(base + new))
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in own]
                digests.append(hashlib.sha256(",".join(
                    x for x, (_, k, _) in zip(listed, own) if k < 3).encode()).hexdigest())
                lists.append(",".join(listed))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(lists, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _code_points(raw: np.ndarray, found: list[Span]) -> list[Span]:
    """Byte offsets as code points."""
    if not found:
        return []
    at = np.unique([x for a, _, b in found for x in (a, b)])
    begins = (raw & 0xC0) != 0x80
    counts = np.add.reduceat(np.append(begins, False), np.concatenate([[0], at]), dtype=np.int64)[:-1]
    if at[0] == 0:
        counts[0] = 0
    point = dict(zip(at.tolist(), np.cumsum(counts).tolist()))
    return [(point[a], k, point[b]) for a, k, b in found]
