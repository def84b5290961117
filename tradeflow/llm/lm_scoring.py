"""Stupid-backoff bigram scores, joined by hash and summed per document.

Every position (context word, word) is dealt to a hash bucket of its context;
there the bigram counts and the context counts of the whole corpus meet the
positions that ask for them. Positions whose bigram was not seen back off: they
are dealt anew by their word, where they meet the unigram counts. Scores come
back as one sum per document and bucket.

Every bucket has something for every other one, so what is dealt comes in rows
as large as memory allows: positions in pieces of PACK_BYTES of text, sums by
groups of pieces, and the second deal has as many buckets as rare words fill.

Contexts and bigrams that make up 1/HOT or more of the corpus, at most HOT of
each, and words that make up 1/HOT_WORDS, are counted beforehand and sent to
every task (a megabyte): positions of a hot bigram are scored where they lie,
those of a hot context are dealt by the bigram, and a hot word needs no second
deal. So no bucket is large because of one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import words as W
from tradeflow.llm.common import scratch, text_or_empty

BACKOFF = 0.4
HOT, HOT_WORDS = 1024, 1 << 16
CHUNK = 1 << 22
#: Bytes of text per bucket; sets how many buckets there are.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 16
#: First buckets to a group of pieces.
GROUPED = 2
#: Texts of one piece, of which a bucket gets one row, and texts read at once.
PACK_BYTES, READ_BYTES = 16 << 20, 4 << 20
#: Packed rows sent at once.
SEND_BYTES, SEND_ROWS = 1 << 20, 4096
START = np.uint64(0x5354415254)  # context of a text's first word
LOW = np.uint64((1 << 48) - 1)   # of a word's hash, 48 bits go along

_PACK = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), *((c, pa.binary()) for c in (
    "piece", "context", "context_n", "word", "doc", "keys", "value"))])
_PACK_SQL = "bucket long, kind int, piece binary, context binary, context_n binary, word binary, doc binary, keys binary, value binary"
#: Kinds of packed rows. The bucket of sums is a group of pieces: the documents of
#: one with their words and what is known at once (DOCUMENTS), more for some of
#: the group's (SUMS).
POSITIONS, MISSES, COUNTS, DOCUMENTS, SUMS = range(5)
COLD = 0xFFFF  # the rank of words that are not hot, and of hot ones beyond


def _row(bucket: int, kind: int, **parts: bytes) -> dict:
    return {"bucket": int(bucket), "kind": kind, **parts}


def _packed(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about SEND_BYTES: one a row would cost more than its work."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c.name: pa.array([r.get(c.name) for r in held], c.type) for c in _PACK}, _PACK)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(part) for part in row.values() if isinstance(part, bytes))
        if size >= SEND_BYTES or len(held) >= SEND_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        columns = list(zip(batch.schema.names, batch.columns))
        for i in range(len(batch)):
            yield {name: column[i].as_py() for name, column in columns}


def _put(values: np.ndarray) -> bytes:
    """Numbers, compressed: the first bytes of all, the second ones and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _get(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * size, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def _six(words: np.ndarray) -> bytes:
    """The low 48 bits of each number as six bytes."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


class Ranked:
    """Words as bytes: the hot ones by their rank."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.by_rank = keys, np.append(keys[np.argsort(-counts, kind="stable")][:COLD], np.uint64(0))
        self.rank = np.full(len(keys), COLD, np.uint16)
        self.rank[np.argsort(-counts, kind="stable")[:COLD]] = np.arange(min(len(keys), COLD))

    def put(self, words: np.ndarray) -> bytes:
        code = np.full(len(words), COLD, np.uint16)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
            code = np.where(self.keys[at] == words, self.rank[at], code)
        ranks = _put(code)
        return len(ranks).to_bytes(8, "little") + ranks + _six(words[code == COLD])

    def get(self, data: bytes) -> np.ndarray:
        end = 8 + int.from_bytes(data[:8], "little")
        code = _get(data[8:end], np.uint16)
        out = self.by_rank[np.minimum(code, len(self.by_rank) - 1)]
        out[code == COLD] = _from_six(data[end:])
        return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where runs of equal values begin, how long each is, at most 255)."""
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))
    n = np.diff(begin, append=len(values))
    parts = -(-n // 255)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(begin, parts) + 255 * nth, np.minimum(np.repeat(n, parts) - 255 * nth, 255).astype(np.uint8)


def _piece(keys: np.ndarray) -> int:
    """The number of a piece: a hash of its documents' keys."""
    own = np.ascontiguousarray(keys).view(np.uint64).ravel()
    return int(W.mix(W.mix(own.copy()) + np.arange(1, len(own) + 1, dtype=np.uint64) * START).sum().view(np.int64))


def _positions(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, text) of each position; words are A-Z lowered."""
    data = W.lower_ascii(data)
    words = W.split_words(data, offsets)
    word = W.hash_words(data, words) & LOW
    context = np.concatenate([[START], word[:-1]]) if len(word) else word
    begin = words.first[:-1][np.diff(words.first) > 0]
    context[begin] = START
    return word, context, words.rows()


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.join_hashes(context, word)


def _lookup(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The count of each wanted key, 0 where absent; keys are sorted."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def _sums(group: int, pieces: np.ndarray, doc: np.ndarray, value: np.ndarray) -> dict:
    """Sums of documents that ascend: the number of the piece and the place there."""
    return _row(group, SUMS, piece=pieces.tobytes(), doc=_put(np.diff(doc, prepend=0)), value=_pack_values(value))


def _sums_of(row: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(piece, places, sums) of each piece in a row of sums."""
    doc, value = np.cumsum(_get(row["doc"], np.int64)), _unpack_values(row["value"])
    pieces = np.frombuffer(row["piece"], np.int64).tolist()
    cuts = np.searchsorted(doc, np.arange(len(pieces) + 1) << 16).tolist()
    for piece, a, b in zip(pieces, cuts, cuts[1:]):
        if a < b:
            yield piece, doc[a:b] & 0xFFFF, value[a:b]


def _add(sums: np.ndarray | None, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sums by place with more added; places ascend."""
    lacks = place[-1] + 1 - (0 if sums is None else len(sums))
    if lacks > 0:
        sums = np.concatenate([*([] if sums is None else [sums]), np.zeros(lacks)])
    sums[place] += value
    return sums


def _pack_values(value: np.ndarray) -> bytes:
    """Sums, compressed: those of single positions are of few values."""
    return len(value).to_bytes(8, "little") + pa.compress(value.tobytes(), "zstd", asbytes=True)


def _unpack_values(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], 8 * int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.float64)


def _hot(corpus: DataFrame) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """(positions in the corpus, [(keys, exact counts)] of the hot words,
    contexts and bigrams)."""
    most = [HOT_WORDS, HOT, HOT]
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for _, _, data, offsets in W.pieces(batch.column("text")):
                word, context, _ = _positions(data, offsets)
                yield [word, context, _pair(context, word)]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for keys in each(batches):
            held.append(keys)
            if sum(len(h[0]) for h in held) >= CHUNK:
                yield chunk(held)
                held = []
        if held:
            yield chunk(held)

    def chunk(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        out: list[list] = [[], [], []]
        for kind in range(3):
            keys, n = np.unique(np.concatenate([h[kind] for h in held]), return_counts=True)
            often = n >= n.sum() / (2 * most[kind])
            out[0].append(np.full(often.sum() + 1, kind))
            out[1].append(np.append(keys[often].view(np.int64), -1))  # -1: all of the chunk
            out[2].append(np.append(n[often], n.sum()))
        kinds, keys, n = map(np.concatenate, out)
        return pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.int32()), "key": pa.array(keys, pa.int64()),
                                           "n": pa.array(n, pa.int64())})

    # What a key lacks in the chunks that do not report it is less than half of
    # what makes it hot, so every hot key keeps the other half.
    found = scratch(corpus.select("text").mapInArrow(report, "kind int, key long, n long")
                    .groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-candidates")
    total = found.filter("kind = 0 AND key = -1").agg(F.sum("n")).first()[0] or 0
    limit = F.get(F.array(*map(F.lit, most)), F.col("kind"))
    # Of each kind at most twice its number of hot keys.
    rows = found.filter((F.col("key") != -1) & (F.col("n") * 2 * limit >= total)).collect()
    wanted = [np.sort(np.array([r["key"] for r in rows if r["kind"] == k], np.int64).view(np.uint64)) for k in range(3)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(w) + 1, np.int64) for w in wanted]
        for keys in each(batches):
            for own, known, got in zip(sums, wanted, keys):
                at = np.minimum(np.searchsorted(known, got), max(0, len(known) - 1))
                own[:-1] += np.bincount(at[known[at] == got], minlength=len(known)) if len(known) else 0
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(np.repeat(np.arange(3), [len(w) for w in wanted]), pa.int32()),
            "key": pa.array(np.concatenate(wanted).view(np.int64)), "n": pa.array(np.concatenate([s[:-1] for s in sums]))})

    exact = (corpus.select("text").mapInArrow(count, "kind int, key long, n long")
             .groupBy("kind", "key").agg(F.sum("n").alias("n")).filter(F.col("n") * limit >= total).collect())
    hot = []
    for kind in range(3):
        own = sorted((np.int64(r["key"]).view(np.uint64), r["n"]) for r in exact if r["kind"] == kind)
        hot.append((np.array([k for k, _ in own], np.uint64), np.array([n for _, n in own], np.int64)))
    return total, hot


def lm_scores(docs: DataFrame, corpus: DataFrame | None = None, backoff: float = BACKOFF) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_words and log_score, the sum
    over its words of the natural logarithm of their stupid-backoff score.

    The score of word w after context v (the start of the text for its first
    word) is c(v w) / c(v), and where that is zero ``backoff`` times c(w) over
    the words of the corpus, an unseen word counting one half. Counts are those
    of ``corpus`` (a column text). Without one they are those of ``docs``, all
    but the position that is scored itself: what a text says only once tells
    nothing about it. Null and empty texts have no words and log_score 0; so
    has every text when nothing is counted at all. Repeated rows count each
    and get equal scores. Other columns are not read.
    """
    spark = docs.sparkSession
    leave_out = 1 if corpus is None else 0
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns(
        {"text_hash": F.xxhash64("text"), "key": F.xxhash64("doc_id", "text")})
    source = rows if corpus is None else corpus.select(text_or_empty().alias("text"))
    total, (hot_words, hot_contexts, hot_pairs) = _hot(source)
    ranked = Ranked(*hot_words)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    groups = max(LEAST_BUCKETS, buckets // GROUPED)
    # Only words that are not hot are dealt again; another corpus does not tell how many.
    rare = 1 - hot_words[1].sum() / total if corpus is None and total else 1
    word_buckets = max(LEAST_BUCKETS, int(np.ceil(buckets * rare)))
    if total <= leave_out:
        return rows.select("doc_id", "text_hash", F.size(F.array_remove(F.split(F.trim("text"), "[ \t\n\x0b\f\r]+"), ""))
                           .cast("long").alias("n_words"), F.lit(0.0).alias("log_score"))

    def _group(piece):
        """The group of a piece, or of each."""
        return piece % groups

    def low(count: np.ndarray) -> np.ndarray:
        """Log score of words by their counts, own position left out."""
        return np.log(backoff) + np.log(np.maximum(count - leave_out, 0.5)) - np.log(total - leave_out)

    def deal(scored: bool, counted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _packed(pieces(batches))

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            held, texts, size = [], 0, 0
            for batch in batches:
                for lo, hi, data, offsets in W.pieces(batch.column("text"), READ_BYTES):
                    for a in range(lo, hi, 1 << 16):
                        b = min(hi, a + (1 << 16))
                        begin, end = offsets[a - lo], offsets[b - lo]
                        if held and (texts + b - a > 1 << 16 or size + end - begin > PACK_BYTES):
                            yield from dealt(held)
                            held, texts, size = [], 0, 0
                        keys = np.stack([batch.column(c)[a:b].to_numpy() for c in ("key", "text_hash")], 1) if scored else None
                        held.append(read(data[begin:end], offsets[a - lo:b - lo + 1] - begin, keys, texts))
                        texts, size = texts + b - a, size + end - begin
            if held:
                yield from dealt(held)

        def read(data, offsets, keys, base: int) -> tuple:
            """(keys, words and known sums of texts; word, context, text and bucket
            of positions to deal); ``base`` texts of the piece come before."""
            word, context, doc = _positions(data, offsets)
            pair = _pair(context, word)
            n = value = None
            if scored:
                # Sums known here: hot bigrams; every text has a row, with its words.
                both, one = _lookup(*hot_pairs, pair), _lookup(*hot_contexts, context)
                hot, done = one > 0, both > leave_out
                value = np.zeros(len(word))
                value[done] = np.log((both[done] - leave_out) / (one[done] - leave_out))
                n, value = np.bincount(doc, minlength=len(keys)), np.bincount(doc, value, len(keys))
            else:
                # Hot bigrams are counted, so they need not be dealt.
                hot, done = _lookup(*hot_contexts, context) > 0, _lookup(*hot_pairs, pair) > 0
            # A hot bigram that only its own position has (of a corpus of at
            # most HOT words) is dealt like others, to back off.
            word, context, doc, pair, hot = (x[~done] for x in (word, context, doc, pair, hot))
            bucket = np.where(hot, pair, W.mix(context.copy())) % np.uint64(buckets)
            # Numbers of 16 bits are the quickest to sort.
            return keys, n, value, word, context, (doc + base).astype(np.uint16), bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)

        def dealt(held: list[tuple]) -> Iterator[dict]:
            parts = list(zip(*held))
            if scored:
                keys = np.concatenate(parts[0])
                piece = _piece(keys)
                yield _row(_group(piece), DOCUMENTS, piece=np.int64(piece).tobytes(), keys=keys.tobytes(),
                           context_n=_put(np.concatenate(parts[1])), value=np.concatenate(parts[2]).tobytes())
            word, context, doc, bucket = map(np.concatenate, parts[3:])
            held.clear()
            del parts
            # Texts ascend, and stay so among equals.
            order = np.lexsort((context, bucket))
            word, context, doc, bucket = (x[order] for x in (word, context, doc, bucket))
            cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
                begin, n = _runs(context[a:b])
                yield _row(bucket[a], POSITIONS, context=ranked.put(context[a:b][begin]), context_n=_put(n), word=ranked.put(word[a:b]),
                           **({"piece": np.int64(piece).tobytes(), "doc": _put(doc[a:b])} if scored else {}),
                           **({} if counted else {"value": b"-"}))
        return run

    def by_bucket(batches: Iterator[pa.RecordBatch], work) -> Iterator[dict]:
        # Rows come sorted by bucket, sums last; one bucket's are held at a time,
        # sums are added as they come.
        now, held, added = None, [], {}
        for row in _unpacked(batches):
            group = row["kind"] >= DOCUMENTS, row["bucket"]
            if group != now and now is not None:
                yield from merged(now[1], added) if now[0] else work(held)
                held, added = [], {}
            now = group
            if row["kind"] == DOCUMENTS:
                yield row
            elif row["kind"] == SUMS:
                for piece, place, value in _sums_of(row):
                    added[piece] = _add(added.get(piece), place, value)
            else:
                held.append(row)
        if now is not None:
            yield from merged(now[1], added) if now[0] else work(held)

    def merged(group: int, added: dict[int, np.ndarray]) -> Iterator[dict]:
        if added:
            places = [np.flatnonzero(own) for own in added.values()]
            yield _sums(group, np.fromiter(added, np.int64), np.concatenate([(k << 16) + at for k, at in enumerate(places)]),
                        np.concatenate([own[at] for own, at in zip(added.values(), places)]))

    def documents(held: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pieces, the document of each position, -1 if it is not scored, which
        positions count); a document is the number of its piece and its place."""
        pieces, doc, counts = [], [], []
        for row in held:
            n = int(_get(row["context_n"], np.uint8).sum())
            counts.append(np.full(n, row["value"] is None))
            if row["doc"] is None:
                doc.append(np.full(n, -1, np.int64))
            else:
                doc.append(_get(row["doc"], np.uint16) + np.int64(len(pieces) << 16))
                pieces.append(row["piece"])
        return np.frombuffer(b"".join(pieces), np.int64), np.concatenate(doc), np.concatenate(counts)

    def sums(pieces: np.ndarray, doc: np.ndarray, value: np.ndarray) -> Iterator[dict]:
        """A row for each group of pieces, a number for each document."""
        if not len(doc):
            return
        group = _group(pieces)
        order = np.argsort(group, kind="stable")
        nth = np.empty(len(pieces), np.int64)
        nth[order] = np.arange(len(pieces))
        pieces, group, doc = pieces[order], group[order], (nth[doc >> 16] << 16) + (doc & 0xFFFF)
        order = np.argsort(doc)
        doc, value = doc[order], value[order]
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        doc, value = doc[begin], np.add.reduceat(value, begin)
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        ends = [*cuts[1:], len(pieces)]
        for p, q, a, b in zip(cuts, ends, np.searchsorted(doc, cuts << 16), np.searchsorted(doc, np.array(ends) << 16)):
            if a < b:
                yield _sums(group[p], pieces[p:q], doc[a:b] - (p << 16), value[a:b])

    def join_pairs(held: list[dict]) -> Iterator[dict]:
        context = np.concatenate([np.repeat(ranked.get(r["context"]), _get(r["context_n"], np.uint8)) for r in held])
        word = np.concatenate([ranked.get(r["word"]) for r in held])
        pieces, doc, counted = documents(held)
        held.clear()  # a bucket's arrays are most of what a task holds
        both = _count(_pair(context, word), counted)
        one = _lookup(*hot_contexts, context).astype(np.int64)
        cold = one == 0
        one[cold] = _count(context[cold], counted[cold])
        del context, cold
        scored = doc >= 0
        hit = scored & (both > leave_out)
        value = np.zeros(len(word))
        value[hit] = np.log((both[hit] - leave_out) / (one[hit] - leave_out))
        del both, one
        miss = scored & ~hit
        known = _lookup(*hot_words, word)
        at = miss & (known > 0)
        value[at] = low(known[at])
        miss &= known == 0
        done = scored & ~miss
        del scored, hit, at
        yield from sums(pieces, doc[done], value[done])
        del value, done
        # Counts of hot words are known everywhere.
        own, n = np.unique(word[counted & (known == 0)], return_counts=True)
        for b, i in _by((own % np.uint64(word_buckets)).astype(np.int64)):
            yield _row(b, COUNTS, word=_six(own[i]), context_n=_put(n[i].astype(np.int64)))
        del known, counted, own, n
        word, doc = word[miss], doc[miss]
        order = np.lexsort((doc, word))
        word, doc = word[order], doc[order]
        for b, i in _by((word % np.uint64(word_buckets)).astype(np.int64)):
            begin, n = _runs(word[i])
            asked, at = np.unique(doc[i] >> 16, return_inverse=True)
            yield _row(b, MISSES, word=_six(word[i][begin]), context_n=_put(n), piece=pieces[asked].tobytes(),
                       keys=_put(at.astype(np.uint32)), doc=_put((doc[i] & 0xFFFF).astype(np.uint16)))

    def join_words(held: list[dict]) -> Iterator[dict]:
        counts = [r for r in held if r["kind"] == COUNTS]
        if counts:
            own, at = np.unique(np.concatenate([_from_six(r["word"]) for r in counts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([_get(r["context_n"], np.int64) for r in counts]))
        else:
            own, n = np.zeros(0, np.uint64), np.zeros(0)
        misses = [r for r in held if r["kind"] == MISSES]
        held.clear()
        if misses:
            pieces, at = np.unique(np.frombuffer(b"".join(r["piece"] for r in misses), np.int64), return_inverse=True)
            base = np.cumsum([0, *(len(r["piece"]) // 8 for r in misses)])
            doc = np.concatenate([(at[a + _get(r["keys"], np.uint32).astype(np.int64)] << 16) + _get(r["doc"], np.uint16)
                                  for a, r in zip(base, misses)])
            value = np.concatenate([np.repeat(low(_lookup(own, n, _from_six(r["word"]))), _get(r["context_n"], np.uint8))
                                    for r in misses])
            yield from sums(pieces, doc, value)

    def _count(keys: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """How many counted positions each position's key has."""
        order = np.argsort(keys)
        begin = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
        out = np.empty(len(keys), np.int64)
        if len(keys):
            out[order] = np.repeat(np.add.reduceat(counted[order].astype(np.int64), begin), np.diff(begin, append=len(keys)))
        return out

    def _by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0])) if len(bucket) else []
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            yield int(bucket[order[a]]), order[a:b]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A group's documents come first, then what is to be added to them. A
        # piece that occurs again adds its own.
        def added() -> Iterator[pa.RecordBatch]:
            for keys, n, value, rows in found.values():
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys[:, 0]), "text_hash": pa.array(keys[:, 1]), "n_words": pa.array(n),
                                                  "value": pa.array(value), "rows": pa.array(np.full(len(keys), rows))})

        now, found = None, {}
        for row in _unpacked(batches):
            if row["bucket"] != now:
                yield from added()
                found = {}
            now = row["bucket"]
            if row["kind"] == DOCUMENTS:
                piece, keys = int.from_bytes(row["piece"], "little", signed=True), np.frombuffer(row["keys"], np.int64).reshape(-1, 2)
                _, n, value, rows = found.get(piece, (keys, 0, 0.0, 0))
                found[piece] = keys, n + _get(row["context_n"], np.int64), value + np.frombuffer(row["value"], np.float64), rows + 1
            else:
                for piece, place, own in _sums_of(row):
                    found[piece][2][place] += own  # a document once a row
        yield from added()

    def meet(df: DataFrame, work) -> DataFrame:
        sums = F.col("kind") >= DOCUMENTS
        return (df.repartition(F.when(sums, F.xxhash64("bucket")).otherwise(F.col("bucket"))).sortWithinPartitions(sums, "bucket")
                .mapInArrow(lambda batches: _packed(by_bucket(batches, work)), _PACK_SQL))

    placed = rows.mapInArrow(deal(True, corpus is None), _PACK_SQL)
    if corpus is not None:
        placed = placed.unionByName(source.mapInArrow(deal(False, True), _PACK_SQL))
    scored = (meet(meet(placed, join_pairs), join_words).repartition("bucket").sortWithinPartitions("bucket", "kind")
              .mapInArrow(unpack, "key long, text_hash long, n_words long, value double, rows long")
              .groupBy("key", "text_hash").agg(F.sum("n_words").alias("n_words"), F.sum("value").alias("value"),
                                               F.sum("rows").alias("rows")))
    # Repeated rows share a key: each has its share of the sum.
    return (rows.select("doc_id", "text_hash", "key").join(scored, ["key", "text_hash"])
            .select("doc_id", "text_hash", F.expr("n_words div rows").alias("n_words"),
                    (F.col("value") / F.col("rows")).alias("log_score")))
