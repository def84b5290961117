"""Packing documents into sequences by lexical retrieval.

Term counts and lengths are taken over the whole corpus. Documents are dealt to
shards by a min-hash of their heaviest terms that are common enough to fill half
a shard, so that texts of one subject share a shard; only larger groups are
spread over several. In a shard, a BM25
inverted index over all token ids answers for each seed document which unused documents are
nearest; they fill the seed's sequence greedily, the last one cut to fit, and
what was cut off stays in the index. Only the shard's remainder could leave a
gap; it is cut into power-of-two sequences, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradeflow.llm import words as W
from tradeflow.llm.common import give_back, lean, release, scratch, text_or_empty
from tradeflow.llm.tokens import WordEncoder

SEQUENCE = 4096
END_ID = 2
#: Bytes of text per shard (some two million ids); sets how many shards there are.
SHARD_BYTES = 8 << 20
#: Terms of a seed's query (all), and the parameters of BM25.
QUERY_TERMS, K1, B = None, 1.2, 0.75
#: Heavy terms that tell a document's subject.
TOP = 4
#: Documents whose terms are weighed at once.
GROUP = 64
#: Cells of a first term's documents by their second one. Larger ones than this
#: share of a shard are spread evenly over the shards that they touch.
CELLS, CELL_SHARE = 16, 4
#: Neighbours sorted at once. The index is cleared of used documents whenever
#: this share of what it holds is used.
AT_ONCE, USED_SHARE = 32, 0.2


class Corpus(NamedTuple):
    """Documents, mean length, and documents by term."""

    n: int
    mean: float
    df: np.ndarray

    def idf(self) -> np.ndarray:
        return np.log(1 + (self.n - self.df + 0.5) / (self.df + 0.5))

    def subjects(self, ids: list[np.ndarray], idf: np.ndarray, least: float) -> np.ndarray:
        """Of each document's TOP heaviest terms, those in at least ``least``
        documents before others, the two with the smallest hashes: documents
        that share most of these terms mostly agree."""
        out = [np.zeros((0, 2), np.int64)]
        for lo in range(0, len(ids), GROUP):
            own = ids[lo:lo + GROUP]
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            pair = np.repeat(np.arange(len(own), dtype=np.uint32) << np.uint32(16), lengths) | np.concatenate(own)
            pair.sort()
            begin = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            doc, term = (pair[begin] >> np.uint32(16)).astype(np.int64), pair[begin] & np.uint32(0xFFFF)
            tf = np.diff(begin, append=len(pair))
            weight = idf[term] * tf / (tf + (K1 * (1 - B + B * lengths / max(1.0, self.mean)))[doc])
            weight -= 1e6 * (self.df[term] < least)
            # The heaviest terms one after the other, of equal weights the smaller term.
            first = np.searchsorted(doc, np.arange(len(own)))
            top = np.full((len(own), TOP), -1)
            for k in range(TOP):
                best = np.maximum.reduceat(weight, first)
                at = np.flatnonzero(weight == best[doc])
                at = at[np.append(True, doc[at[1:]] != doc[at[:-1]])]
                at = at[weight[at] > -np.inf]
                top[doc[at], k] = term[at]
                weight[at] = -np.inf
            hashes = W.mix(top.astype(np.uint64))
            hashes[top < 0] = np.iinfo(np.uint64).max
            top = np.take_along_axis(top, np.argsort(hashes, axis=1, kind="stable"), 1)
            out.append(np.where(top[:, :2] < 0, top[:, :1], top[:, :2]))
        return np.concatenate(out)


class Index:
    """BM25 inverted index of one shard's pieces, weighed by the counts of the
    whole corpus (of the pieces themselves without one)."""

    def __init__(self, ids: list[np.ndarray], corpus: Corpus | None = None):
        n = len(ids)
        lengths = np.fromiter(map(len, ids), np.int64, n)
        pair = np.concatenate([np.zeros(0, np.int64), *(a.astype(np.int64) * n + d for d, a in enumerate(ids))])
        pair, tf = np.unique(pair, return_counts=True)
        term, self.doc = pair // n, pair % n
        self.begin = np.searchsorted(term, np.arange(1 << 16))
        self.end = np.searchsorted(term, np.arange(1 << 16), "right")
        if corpus is None:
            corpus = Corpus(n, lengths.mean() if n else 0.0, self.end - self.begin)
        idf = corpus.idf()
        norm = K1 * (1 - B + B * lengths[self.doc] / max(1.0, corpus.mean))
        # Rounded to 32 bits, held as what their sums are made in.
        self.weight = (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32).astype(np.float64)
        # Each document's terms, heaviest first: its query.
        order = np.lexsort((term, -self.weight, self.doc))
        self.term = term[order]
        self.own = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """Each document's score for the seed's terms, 0 for those without any."""
        query = self.term[self.own[seed]:self.own[seed + 1]][:QUERY_TERMS]
        if not len(query):
            return np.zeros(self.n)
        spans = list(zip(self.begin[query].tolist(), self.end[query].tolist()))
        return np.bincount(np.concatenate([self.doc[a:b] for a, b in spans]),
                           np.concatenate([self.weight[a:b] for a, b in spans]), self.n)

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents that share query terms with the seed, best first."""
        return np.concatenate([*best_first(self.scores(seed)), np.zeros(0, np.int64)])

    def keep(self, docs: np.ndarray) -> None:
        """Forget the other documents (a mask), which will not be found any more."""
        stay = docs[self.doc]
        before = np.concatenate([[0], np.cumsum(stay)])
        self.begin, self.end = before[self.begin], before[self.end]
        self.doc, self.weight = self.doc[stay], self.weight[stay]


def best_first(score: np.ndarray) -> Iterator[np.ndarray]:
    """Documents with a score in the order of score and number: the best AT_ONCE
    (with all that equal the last of them), then the others."""
    found = np.flatnonzero(score)
    if len(found) > 2 * AT_ONCE:
        own = score[found]
        first = own >= np.partition(own, -AT_ONCE)[-AT_ONCE]
        parts = [found[first], found[~first]]
    else:
        parts = [found]
    for part in parts:
        yield part[np.argsort(-score[part], kind="stable")]


def fill(ids: list[np.ndarray], sequence: int = SEQUENCE, corpus: Corpus | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of one shard: lists of pieces (document, start, length)."""
    start = np.zeros(len(ids), np.int64)
    length = np.fromiter(map(len, ids), np.int64, len(ids))
    for d in np.flatnonzero(length >= sequence):
        for _ in range(length[d] // sequence):
            yield [(int(d), int(start[d]), sequence)]
            start[d] += sequence
    rest = length - start
    index = Index([a[s:] for a, s in zip(ids, start)], corpus)
    unused, after = rest > 0, 0
    held = left = int(unused.sum())
    while True:
        while after < len(ids) and not unused[after]:
            after += 1
        if after == len(ids):
            return
        pieces, room = [], sequence

        def place(d: int) -> int:
            nonlocal left
            n = int(min(rest[d], room))
            pieces.append((int(d), int(start[d]), n))
            start[d] += n
            rest[d] -= n
            if not rest[d]:
                unused[d] = False
                left -= 1
            return room - n

        room = place(after)
        if room:
            if left < (1 - USED_SHARE) * held:
                index.keep(unused)
                held = left
            score = index.scores(after)
            score[~unused] = 0
            for d in chain.from_iterable(best_first(score)):
                room = place(d)
                if not room:
                    break
        # Without any that shares a term, whatever comes next in the shard.
        d = after
        while room and d < len(ids):
            if unused[d]:
                room = place(d)
            else:
                d += 1
        yield pieces


def document_counts(ids: list[np.ndarray]) -> np.ndarray:
    """In how many documents each id occurs."""
    ordered = [np.sort(own) for own in ids]
    first = [own[np.append(True, own[1:] != own[:-1])] for own in ordered if len(own)]
    return np.bincount(np.concatenate([np.zeros(0, np.uint16), *first]), minlength=1 << 16)


def _ids(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in table.column("ids").to_pylist()]


def powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A short sequence as sequences whose lengths are powers of two."""
    left = sum(n for *_, n in pieces)
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            d, start, n = pieces.pop()
            take = min(n, room)
            out.append((d, start, take))
            room -= take
            if take < n:
                pieces.append((d, start + take, n - take))
        yield out


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         shard_bytes: int = SHARD_BYTES, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and ids (unless ``with_ids`` is false).

    ``docs`` has doc_id and text; a null text is empty and has the end id
    alone. Each document's ids, ``end_id`` last, lie in exactly one piece each;
    repeated rows are packed once for each row. Sequences are full or a power
    of two long, so none needs padding. A table without rows gives none. Other
    columns are not read.
    """
    if sequence & (sequence - 1):
        raise ValueError("sequence must be a power of two")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("size", pa.int64()), ("spread", pa.int64()),
                        ("ids", pa.binary()), ("sums", pa.binary())])
    words = docs.sparkSession.sparkContext.broadcast(WordEncoder(tokenizer_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = words.value
        # After the terms' entries: documents, ids and bytes of text.
        sums = np.zeros((1 << 16) + 3, np.int64)
        for batch in batches:
            for lo, hi, *_ in W.pieces(batch.column("text"), 8 * W.PIECE_BYTES):
                ids, n = encoder(batch.column("text")[lo:hi])
                bounds = np.concatenate([[0], np.cumsum(n)])
                end = np.array([end_id], np.uint16).tobytes()
                bodies = [ids[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:])]
                size = batch.column("size")[lo:hi]
                sums[:1 << 16] += document_counts([np.frombuffer(body, np.uint16) for body in bodies])
                sums[1 << 16:] += [hi - lo, len(ids) + hi - lo, size.to_numpy().sum()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], size, batch.column("spread")[lo:hi],
                     pa.array(bodies, pa.binary()), pa.nulls(hi - lo, pa.binary())], schema)
        # One row more, of the task's sums.
        yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in schema][:-1] + [pa.array([sums.tobytes()], pa.binary())], schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((1 << 16) + 3, np.int64)
        for batch in batches:
            for own in batch.column("sums").to_pylist():
                sums += np.frombuffer(own, np.int64)
        term = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": pa.array(term, pa.int64()), "n": pa.array(sums[term])})

    encoded = scratch(rows.select("doc_id", "text", (F.octet_length("text") + 1).cast("long").alias("size"),
                                  F.xxhash64("doc_id", "text", F.lit(3)).alias("spread"))
                      .mapInArrow(lean(encode), f"doc_id {kind}, size long, spread long, ids binary, sums binary"), "packing-ids")
    sums = np.zeros((1 << 16) + 3, np.int64)
    counted = encoded.filter("sums IS NOT NULL").select("sums").mapInArrow(count, "term long, n long")
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        sums[r["term"]] = r["n"]
    n, tokens, size = (int(x) for x in sums[1 << 16:])
    least = n / max(1, -(-size // shard_bytes)) / 2
    corpus = docs.sparkSession.sparkContext.broadcast(Corpus(n, tokens / max(1, n), sums[:1 << 16]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, idf = corpus.value, corpus.value.idf()
        for batch in batches:
            terms = whole.subjects(_ids(batch), idf, least)
            cell = terms[:, 0] * CELLS + (W.mix(terms[:, 1].astype(np.uint64)) % np.uint64(CELLS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", *batch.schema.names])

    placed = scratch(encoded.filter("sums IS NULL").drop("sums").mapInArrow(lean(place), f"cell long, doc_id {kind}, size long, spread long, ids binary"), "packing-cells")
    release(encoded)
    # At most 65,536 terms times CELLS rows.
    cells = placed.groupBy("cell").agg(F.sum("size").alias("size")).orderBy("cell").toArrow()
    cell, size = (cells.column(c).to_numpy() for c in ("cell", "size"))
    dealer = docs.sparkSession.sparkContext.broadcast((cell, size, np.cumsum(size) - size))

    @F.arrow_udf("long")
    def deal(cells: pa.Array, spread: pa.Array) -> pa.Array:
        cell, size, begin = dealer.value
        at = np.searchsorted(cell, cells.to_numpy())
        part = (spread.to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
        inside = np.where(size[at] > shard_bytes / CELL_SHARE, part * size[at], 0.0)
        return pa.array(((begin[at] + inside) // shard_bytes).astype(np.int64))

    def pack_shard(key: tuple, table: pa.Table) -> pa.Table:
        try:
            return packed(key, table)
        finally:
            give_back()

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.combine_chunks()
        # The same order whenever the shard is computed again.
        table = table.take(order(table))
        doc_ids = table.column("doc_id")
        ids = _ids(table)
        out: dict[str, list] = {k: [] for k in ("d", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
        number = 0
        for pieces in fill(ids, sequence, corpus.value):
            whole = sum(n for *_, n in pieces)
            for own in [pieces] if whole == sequence else powers(pieces):
                offset = 0
                for d, start, n in own:
                    piece = ids[d][start:start + n].astype("<u4")
                    for k, v in (("d", d), ("start", start), ("length", n), ("ids_crc32", zlib.crc32(piece.tobytes())),
                                 ("doc_tokens", len(ids[d])), ("sequence_id", (shard << 32) + number), ("offset", offset)):
                        out[k].append(v)
                    if with_ids:
                        out["ids"].append(piece.astype(np.int32))
                    offset += n
                number += 1
        own = pa.array(out.pop("d"), pa.int64())
        made = {"doc_id": doc_ids.take(own)} | {k: pa.array(v, pa.int64()) for k, v in out.items() if k != "ids"}
        return pa.table(made | ({"ids": pa.array(out["ids"], pa.list_(pa.int32()))} if with_ids else {}))

    def order(table: pa.Table) -> pa.Array:
        ids, bodies = table.column("doc_id").to_pylist(), table.column("ids").to_pylist()
        return pa.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0,
                                                               zlib.crc32(bodies[i]))), pa.int64())

    return (placed.select(deal("cell", "spread").alias("shard"), "doc_id", "ids").groupBy("shard")
            .applyInArrow(pack_shard, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                      "sequence_id long, offset long" + (", ids array<int>" if with_ids else "")))
