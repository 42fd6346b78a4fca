"""Lexical retrieval packing: documents fill windows together with their nearest neighbours by BM25.

Every document is its token ids and one end id. Full windows are cut off its start at once; the rest, shorter than a window, is
packed. Rests are sorted by their key over the whole corpus and cut into shards of bounded size: the key is the ids
that add much to a BM25 score and that many documents have, so that rests about the same things lie side
by side and a key shared by more rests than a shard holds is split by its next ids. A neighbour beyond the shard is not seen. In a
shard an inverted index over the token ids is built; document
frequencies and the average length are those of the whole corpus, from the pass that makes the ids. The longest unused rest seeds a
window, all its ids are the query, and the unused neighbours with the best BM25 scores fill the window greedily;
the last one is cut so that the window is exactly full and its other part stays in the pool as a later seed. What is left at
the end of a shard is cut into powers of two, which need no padding. Padding is thus nothing at all.

The ids come from one pass and are stored, so the shuffle of rests repeats no work and survives lost executors.

Defined cases: a null or empty text is the end id alone. Rows that repeat an id, or have none, are packed like any other. An empty
table gives no rows. Other columns are not looked at. Ids of special tokens in a text are kept as the tokenizer gives them.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import arrow_bytes, quoted, stored, text_of

WINDOW = 1024
END = 0
#: Rests in a shard, give or take a half: what is searched at once, at most WINDOW - 1 ids each.
SHARD = 2048
#: A term that one of so many rests of a shard has is a row of a matrix.
MANY = 32
#: Ids of a key, and the usual constants of the score.
KEY, K1, B = 16, 1.2, 0.75
SPECIAL = {"<|endoftext|>": 50256}
#: Texts are encoded in pieces so that a task's memory does not depend on how many rows a batch has.
PIECE = 256


def encoder(ranks_path: str, pattern: str):
    """The byte-level vocabulary as ranks; it gives the ids of the same vocabulary in the tokenizers library, in less time."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)


def ids_of(encoding, text: str) -> np.ndarray:
    ids = encoding.encode(text, allowed_special="all") if "<|" in text else encoding.encode_ordinary(text)
    return np.array(ids + [END], dtype=np.uint32)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


ROW = "doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, place bigint, term int, n bigint"


def tokenised(docs: DataFrame, ranks_path: str, pattern: str, window: int) -> DataFrame:
    """Full windows (ids null), rests (with ids, 16 bits each, and a place in the input) and per task the document frequency of each term."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        encoding = encoder(ranks_path, pattern)
        frequency = np.zeros(1 << 16, dtype=np.int64)
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, batch.num_rows, PIECE):
                part = batch.slice(lo, PIECE)
                out = {c: [] for c in ("doc", "start", "length", "crc", "tokens", "ids", "place")}
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = ids_of(encoding, text)
                    frequency[np.unique(ids)] += 1
                    cut = len(ids) // window * window
                    for start in [*range(0, cut, window), *([cut] if cut < len(ids) else [])]:
                        own = ids[start:start + window]
                        rest = len(own) < window
                        out["doc"].append(doc)
                        out["start"].append(start)
                        out["length"].append(len(own))
                        out["crc"].append(None if rest else crc(own))
                        out["tokens"].append(len(ids))
                        out["ids"].append(own.astype("<u2").tobytes() if rest else None)
                        out["place"].append(place)
                        place += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc"], part.column(0).type), pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()),
                     pa.array(out["crc"], pa.int64()), pa.array(out["tokens"], pa.int64()), pa.array(out["ids"], pa.binary()),
                     pa.array(out["place"], pa.int64()), pa.nulls(len(out["doc"]), pa.int32()), pa.nulls(len(out["doc"]), pa.int64())],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "place", "term", "n"])
        terms = np.flatnonzero(frequency)
        none = lambda t: pa.nulls(len(terms), t)
        if len(terms):
            yield pa.RecordBatch.from_arrays(
                [none(part.column(0).type), *[none(pa.int64())] * 4, none(pa.binary()), none(pa.int64()),
                 pa.array(terms.astype(np.int32)), pa.array(frequency[terms])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "place", "term", "n"])

    with arrow_bytes(docs.sparkSession):
        return stored(docs.mapInArrow(run, ROW.format(kind=kind)), "tokens")


def parts_of(ids: np.ndarray, weight: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a rest and what each adds to a BM25 score."""
    own, n = np.unique(ids, return_counts=True)
    return own, weight[own] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ids) / mean))


def keyed(rests: DataFrame, weight, common, mean: float) -> DataFrame:
    """The rests with their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ends = [], [0]
            for ids in batch.column("ids"):
                own, parts = parts_of(np.frombuffer(ids.as_buffer(), dtype="<u2"), weight.value, mean)
                keys.append(own[np.argsort(-parts * common.value[own], kind="stable")[:KEY]])
                ends.append(ends[-1] + len(keys[-1]))
            key = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*keys, []]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, key], [*batch.schema.names, "key"])

    kind = rests.schema["doc_id"].dataType.simpleString()
    return stored(rests.mapInArrow(run, f"doc_id {kind}, start bigint, doc_tokens bigint, ids binary, place bigint, key array<int>"), "keys")


class Index:
    """BM25 over the rests of a shard: per term the rests that have it, with their part of the score."""

    def __init__(self, rests: list[np.ndarray], weight: np.ndarray, mean: float):
        own = [parts_of(ids, weight, mean) for ids in rests]
        self.queries = [t for t, _ in own]
        terms, parts = np.concatenate(self.queries), np.concatenate([p for _, p in own]).astype(np.float32)
        rows = np.repeat(np.arange(len(rests)), [len(t) for t in self.queries])
        order = np.argsort(terms, kind="stable")
        self.rows, self.parts, self.size = rows[order], parts[order], len(rests)
        self.begin = np.searchsorted(terms[order], np.arange(1 << 16 | 1))
        # terms of many rests are rows of a matrix, whose product with itself adds faster than their postings
        self.many = np.diff(self.begin) > max(4, len(rests) // MANY)
        self.common = np.zeros((self.size, self.size), np.float32)
        many = np.flatnonzero(self.many)
        for lo in range(0, len(many), 1024):
            dense = np.zeros((len(many[lo:lo + 1024]), self.size), np.float32)
            for k, t in enumerate(many[lo:lo + 1024]):
                at = slice(self.begin[t], self.begin[t + 1])
                dense[k, self.rows[at]] = self.parts[at]
            self.common += (dense > 0).astype(np.float32).T @ dense

    def scores(self, i: int) -> np.ndarray:
        out = self.common[i].astype(np.float64)
        query = self.queries[i]
        query = query[~self.many[query]]
        few = [slice(a, b) for a, b in zip(self.begin[query].tolist(), self.begin[query.astype(np.int64) + 1].tolist(), strict=True)]
        if few:
            rows, parts = np.concatenate([self.rows[at] for at in few]), np.concatenate([self.parts[at] for at in few])
            out += np.bincount(rows, weights=parts, minlength=self.size)
        return out


def packed(rests: list[np.ndarray], index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (rest, from, to). All but the last few are full, those are powers of two long."""
    at = np.zeros(len(rests), dtype=np.int64)
    size = np.array([len(r) for r in rests])
    unused = np.ones(len(rests), dtype=bool)
    seeds = np.argsort(-size, kind="stable").tolist()[::-1]
    while seeds:
        seed = seeds.pop()
        if not unused[seed]:
            continue
        unused[seed] = False
        pieces = [(seed, int(at[seed]), int(size[seed]))]
        room = window - (size[seed] - at[seed])
        if room > 0:
            scores = np.where(unused, index.scores(seed), -1.0)
            k = min(len(scores), 64)
            near = np.argpartition(-scores, k - 1)[:k] if k < len(scores) else np.arange(len(scores))
            near = near[np.lexsort((near, -scores[near]))].tolist()
            while room > 0:
                if not near:
                    scores = np.where(unused, scores, -1.0)
                    near = np.lexsort((np.arange(len(scores)), -scores)).tolist()
                other = near.pop(0)
                if not unused[other]:
                    if not unused.any():
                        break
                    continue
                take = int(min(room, size[other] - at[other]))
                pieces.append((other, int(at[other]), int(at[other]) + take))
                at[other] += take
                room -= take
                if at[other] == size[other]:
                    unused[other] = False
                else:
                    seeds.append(other)
        if room == 0:
            yield pieces
        else:
            yield from _powers(pieces)


def _powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    total = sum(b - a for _, a, b in pieces)
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        out = []
        while room:
            rest, a, b = pieces.pop()
            take = min(room, b - a)
            out.append((rest, a, a + take))
            if a + take < b:
                pieces.append((rest, a + take, b))
            room -= take
        if out:
            yield out


def pack(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, shard: int = SHARD,
) -> DataFrame:
    """Per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    told = tokenised(docs.select(F.col(quoted(id_column)).alias("id"), text_of(text)), ranks_path, pattern, window)
    frequency = told.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per id of the vocabulary at most
    totals = told.where("start = 0").agg(F.count("*").alias("docs"), F.avg("doc_tokens").alias("mean")).first()
    n = np.zeros(1 << 16 | 1)
    for r in frequency:
        n[r["term"]] = r["n"]
    weight = spark.sparkContext.broadcast(np.log(1 + ((totals["docs"] or 0) - n + 0.5) / (n + 0.5)).astype(np.float32))
    mean = min(float(totals["mean"] or 1), float(window))

    full = told.where("ids_crc32 IS NOT NULL")
    rests = told.where("ids IS NOT NULL").select("doc_id", "start", "doc_tokens", "ids", "place")
    shards = max(1, -(-rests.count() // shard))
    common = spark.sparkContext.broadcast(np.log(np.maximum(n, 1)) ** 2)
    if shards > 1:  # sorted by key; equal keys are told apart by their place, so no range is too large
        rests = keyed(rests, weight, common, mean).repartitionByRange(shards, "key", "place").sortWithinPartitions("key", "place").drop("key")
    else:
        rests = rests.repartition(1)

    def sequences(rests: pa.Table, number: int) -> tuple[pa.RecordBatch, int]:
        rests = rests.sort_by("place").combine_chunks()
        tokens = [np.frombuffer(b.as_buffer(), dtype="<u2") for b in rests.column("ids")]
        index = Index(tokens, weight.value, mean)
        rows = []
        for pieces in packed(tokens, index, window):
            offset = 0
            for rest, a, b in pieces:
                rows.append((rest, a, b - a, crc(tokens[rest][a:b]), number, offset))
                offset += b - a
            number += 1
        rest, a, length, code, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
        own = rests.select(["doc_id", "start", "doc_tokens"]).take(pa.array(rest)).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [own.column(0), pa.array(own.column(1).to_numpy() + a), pa.array(length), pa.array(code), own.column(2),
             pa.array(sequence), pa.array(offset)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]), number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() + 1) << 33
        left = None
        for batch in batches:
            left = pa.concat_tables([*([] if left is None else [left]), pa.Table.from_batches([batch])])
            while left.num_rows >= 3 * shard:
                out, number = sequences(left.slice(0, shard), number)
                left = left.slice(shard)
                yield out
        if left is not None and left.num_rows:
            parts = max(1, round(left.num_rows / shard))
            cuts = [left.num_rows * k // parts for k in range(parts + 1)]
            for lo, hi in zip(cuts, cuts[1:]):
                out, number = sequences(left.slice(lo, hi - lo), number)
                yield out

    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    shared = rests.mapInArrow(run, schema)
    # a full window is the sequence of its own place, counted from below zero so that no shard has its number
    alone = full.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (-F.col("place") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return alone.unionByName(shared).withColumnRenamed("doc_id", id_column)
