"""Alignment of two tokenizers' ids over the same texts.

Both tokenizers encode the whole text. Wherever both have a token that ends at the same byte and is followed by one that begins with a blank,
the text is cut: these anchors are looked up in both lists of ends, so a cut is never assumed. Between two anchors lies a window of ids of
either tokenizer, usually a word. A window is aligned by the ends its tokens share, and as the same windows come again and
again, a task remembers the alignment of a pair of id tuples.

Counts: every task sums the links of its documents by pair of ids before they are shuffled. Pairs of ids with the highest counts
(a bounded number) are sent to all tasks; links of all other pairs, none of which is frequent then, are joined with their counts.

Defined cases: null and empty texts, and texts that the tokens of either tokenizer do not spell (texts that hold U+2581, for one), have no
tokens: all numbers are 0 and the groups are the empty text. Strings of special tokens are plain text. Rows that repeat an id, or have
none, are documents of their own. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import quoted, stored, text_of
from cellflow.llm.packing import encoder

SPACE = "▁"
#: Bytes of remembered windows, with what Python adds to each; then a task starts anew.
REMEMBERED, OVERHEAD = 192 << 20, 400
#: Texts encoded together.
PIECE = 128
#: Pairs of ids whose counts are sent to all tasks: 17 bytes each.
FREQUENT = 1 << 18
#: Pairs of ids that a task sums before it hands them on.
SUMMED = 1 << 21
#: A pair of ids is one number: A's times this, plus B's.
PAIR = 1 << 32


class Tables:
    """Bytes, lengths and blank marks of the tokens of both vocabularies."""

    def __init__(self, ranks_path: str, pattern: str, model_path: str):
        import sentencepiece

        self.first = encoder(ranks_path, pattern)
        self.second = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.bytes_a = self.first.token_byte_values()
        ids = [self.first.encode_single_token(t) for t in self.bytes_a]
        table = [b""] * (max(ids) + 1)
        for i, token in zip(ids, self.bytes_a, strict=True):
            table[i] = token
        self.bytes_a = table
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b))
        self.blank_a, self.blank_b = (np.array([t[:1] == b" " for t in table]) for table in (self.bytes_a, self.bytes_b))

    def _piece(self, i: int) -> bytes:
        name = self.second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.second.is_byte(i) else name.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for every text; none where they do not spell the text."""
        none = np.zeros(0, dtype=np.int32)
        for text, b in zip(texts, self.second.encode(texts, num_threads=1), strict=True):
            if text:
                a, spelled = self.first.encode_to_numpy(" " + text, disallowed_special=()), (" " + text).encode()
                # A's tokens are parts of these very bytes, so that their length tells; B's are compared
                if self.size_a[a].sum() == len(spelled) and b"".join(map(self.bytes_b.__getitem__, b)) == spelled:
                    yield a, np.array(b, dtype=np.int32)
                    continue
            yield none, none


class Aligner:
    """Cuts documents at anchors and aligns windows, remembered by their ids."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.kind = np.dtype("<u2" if max(len(tables.bytes_a), len(tables.bytes_b)) < 1 << 16 else "<u4")
        self.known: dict[bytes, tuple[str, bytes]] = {}  # by A's ids, a mark, B's ids
        self.mark = np.iinfo(self.kind).max
        self.held = 0
        # a token as it stands in the groups: inside, and as the last of its kind
        self.inside = [np.array([f"{i}," for i in range(len(t))], dtype=object) for t in (tables.bytes_a, tables.bytes_b)]
        self.last = [np.array([f"{i}{end}" for i in range(len(t))], dtype=object) for t, end in ((tables.bytes_a, "|"), (tables.bytes_b, ";"))]

    def anchors(self, a: np.ndarray, b: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin in either, and where the last one ends. a and b: ids of documents one after the other, which end at ends."""
        places, at = [], []
        for ids, size, blank, end in zip((a, b), (self.t.size_a, self.t.size_b), (self.t.blank_a, self.t.blank_b), ends, strict=True):
            before = np.append(blank[ids[1:]], True)
            before[end - 1] = True
            at.append(np.flatnonzero(before))
            places.append(np.cumsum(size[ids])[at[-1]])
        _, in_a, in_b = np.intersect1d(*places, assume_unique=True, return_indices=True)
        return np.append(0, at[0][in_a] + 1), np.append(0, at[1][in_b] + 1)

    def learn(self, windows: list[bytes]) -> None:
        """Align windows: groups as text, each with its end mark, and the pairs of ids of links."""
        flat = np.frombuffer(b"".join(windows), dtype=self.kind)
        upto = np.cumsum([len(w) for w in windows]) // self.kind.itemsize  # ids and mark of a window and those before
        mark = np.flatnonzero(flat == self.mark)
        first = np.arange(len(flat)) < np.repeat(mark, np.diff(upto, prepend=0))
        ids = [flat[first], np.delete(flat, mark)[~np.delete(first, mark)]]
        # a window spans the same bytes in both, so windows may stand one after the other
        shared, in_a, in_b = np.intersect1d(
            np.cumsum(self.t.size_a[ids[0]]), np.cumsum(self.t.size_b[ids[1]]), assume_unique=True, return_indices=True)
        # no token is without bytes, so one token of either ends at a shared end
        pairs = ids[0][in_a].astype(np.int64) * PAIR + ids[1][in_b]
        ends = [in_a + 1, in_b + 1]
        shown = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
        for side in (0, 1):
            own = self.inside[side][ids[side]]
            own[ends[side] - 1] = self.last[side][ids[side][ends[side] - 1]]
            group = np.repeat(np.arange(len(shared)), np.diff(ends[side], prepend=0))
            # before a token of B stand A's of its own group too
            other = ends[1 - side] if side else np.append(0, ends[1])[:-1]
            shown[np.arange(len(own)) + other[group]] = own
        shown = shown.tolist()
        groups = np.searchsorted(ends[0], np.cumsum(mark - np.append(0, upto[:-1])), side="right")
        to = [0, *(ends[0] + ends[1])[groups - 1].tolist()]
        texts = map("".join, [shown[i:j] for i, j in zip(to, to[1:], strict=False)])
        flat, at = pairs.tobytes(), [0, *(8 * groups).tolist()]
        links = [flat[i:j] for i, j in zip(at, at[1:], strict=False)]
        self.known.update(zip(windows, zip(texts, links, strict=True), strict=True))
        self.held += OVERHEAD * len(windows) + 10 * len(shown) + len(flat)

    def align(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[str, np.ndarray]]:
        """Groups as text and the pairs of ids of all links, of documents with tokens."""
        if not documents:
            return
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        a, b = (np.concatenate([d[side] for d in documents]).astype(self.kind) for side in (0, 1))
        ends = tuple(np.cumsum([len(d[side]) for d in documents]) for side in (0, 1))
        cut_a, cut_b = self.anchors(a, b, ends)
        # the ids of windows one after the other: A's, a mark, B's
        window = np.arange(len(cut_a) - 1)
        flat = np.full(len(a) + len(b) + len(window), self.mark, dtype=self.kind)
        flat[np.arange(len(a)) + np.repeat(window + cut_b[:-1], np.diff(cut_a))] = a
        flat[np.arange(len(b)) + np.repeat(window + cut_a[1:], np.diff(cut_b)) + 1] = b
        at, flat = ((cut_a + cut_b + np.arange(len(cut_a))) * self.kind.itemsize).tolist(), flat.tobytes()
        windows = [flat[i:j] for i, j in zip(at, at[1:], strict=False)]
        if new := set(windows) - self.known.keys():
            self.learn(list(new))
        found = list(map(self.known.__getitem__, windows))
        begin = 0
        for end in np.searchsorted(cut_a, ends[0]).tolist():
            own = found[begin:end]
            yield "".join([f[0] for f in own])[:-1], np.frombuffer(b"".join([f[1] for f in own]), dtype=np.int64)
            begin = end


ROW = "row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<int>"


def token_groups(
    docs: DataFrame, ranks_path: str, pattern: str, model_path: str, id_column: str = "doc_id", text: str = "text", hashed: bool = False,
) -> DataFrame:
    """Per document: ``row`` (a number of its own), ``id``, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links``, ``groups``
    (``a1,a2|b1;a3|b2,b3``, or its SHA-256) and its linked ``pairs`` of ids with their ``times``."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(ranks_path, pattern, model_path)
        aligner, row = Aligner(tables), TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, batch.num_rows, PIECE):
                part = batch.slice(lo, PIECE)
                numbers, groups, pairs, times = [], [], [], []
                encoded = list(tables.encode(part.column(1).to_pylist()))
                alignments = aligner.align([ids for ids in encoded if len(ids[0])])
                for a, b in encoded:
                    shown, links = next(alignments) if len(a) else ("", np.zeros(0, np.int64))
                    groups.append(hashlib.sha256(shown.encode()).hexdigest() if hashed and len(a) else shown)
                    own, n = np.unique(links, return_counts=True)
                    pairs.append(own)
                    times.append(n.astype(np.int32))
                    numbers.append((row, len(a), len(b), len(links), len(links)))
                    row += 1
                counts = np.array(numbers, dtype=np.int64).reshape(-1, 5)
                ends = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts[:, 0]), part.column(0), *[pa.array(counts[:, c]) for c in range(1, 5)], pa.array(groups, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*pairs, np.zeros(0, np.int64)]))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*times, np.zeros(0, np.int32)])))],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    rows = docs.select(F.col(quoted(id_column)).alias("id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, ROW.format(kind=kind))


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, back = np.unique(pairs, return_inverse=True)
    return own, np.bincount(back, counts, minlength=len(own)).astype(np.int64)


def summed_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs, times) of documents to (pair, count), summed in the task."""
    held, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def reduced():
        return _summed(np.concatenate([p for p, _ in held]), np.concatenate([c for _, c in held]))

    for batch in batches:
        held.append(_summed(*(batch.column(c).flatten().to_numpy() for c in (0, 1))))
        size += len(held[-1][0])
        if size > SUMMED:
            pairs, counts = reduced()
            if len(pairs) > SUMMED // 2:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "count"])
                pairs, counts = pairs[:0], counts[:0]
            held, size = [(pairs, counts)], len(pairs)
    pairs, counts = reduced()
    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "count"])


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best) over all documents, a stored table; best: the count is the highest of the pair's B id."""
    counts = stored(rows.select("pairs", "times").mapInArrow(summed_links, "pair bigint, count bigint").groupBy("pair").agg(
        F.sum("count").alias("count")), "pairs")
    second = F.col("pair").bitwiseAND(PAIR - 1)
    highest = counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest"))  # a row for each id of B's vocabulary
    return stored(counts.withColumn("b", second).join(F.broadcast(highest), "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")), "counts")


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with the highest counts, at most so many, sorted; their counts, and whether they are best."""
    scale = F.floor(F.log2("count")).cast("int")
    bins = {r["scale"]: r["n"] for r in counts.groupBy(scale.alias("scale")).agg(F.count("*").alias("n")).collect()}  # 64 rows at most
    least, n = None, 0
    for s in sorted(bins, reverse=True):
        if n + bins[s] > most:
            break
        least, n = s, n + bins[s]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    chosen = counts.where(scale >= least).toArrow().sort_by("pair")
    return tuple(chosen.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "count", "best"))


def aligned(
    docs: DataFrame, ranks_path: str, pattern: str, model_path: str, id_column: str = "doc_id", text: str = "text", hashed: bool = False,
    most: int = FREQUENT,
) -> DataFrame:
    """Per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``."""
    rows = stored(token_groups(docs, ranks_path, pattern, model_path, id_column, text, hashed), "alignments")
    counts = link_counts(rows)
    sent = docs.sparkSession.sparkContext.broadcast(frequent(counts, most))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, n_best, count_sum) over frequent pairs, and (row, pair, times) of the others."""
        known, count, best = sent.value
        for batch in batches:
            row, lists = batch.column(0).to_numpy(), batch.column(1)
            of = np.repeat(np.arange(len(row)), lists.value_lengths().to_numpy())
            pair, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            # integers are added one by one: a sum of doubles would be rounded
            sums, n_best = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            if len(known):
                np.add.at(sums, of[hit], times[hit] * count[at[hit]])
                np.add.at(n_best, of[hit], times[hit] * best[at[hit]])
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(n_best), pa.array(sums), none, none], ["row", "n_best", "count_sum", "pair", "times"])
            rest = ~hit
            none = pa.nulls(int(rest.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[of[rest]]), none, none, pa.array(pair[rest]), pa.array(times[rest])], ["row", "n_best", "count_sum", "pair", "times"])

    parts = stored(rows.select("row", "pairs", "times").mapInArrow(
        weighed, "row bigint, n_best bigint, count_sum bigint, pair bigint, times bigint"), "weighed")
    rare = parts.where("pair IS NOT NULL").select("row", "pair", "times").join(counts, "pair").select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("count")).alias("count_sum"))
    sums = parts.where("pair IS NULL").select("row", "n_best", "count_sum").unionByName(rare).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").select(
        F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
