"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A text with every blank as U+2581, and one more before it, is cut before each run of U+2581; no piece reaches over such a
cut, so words are encoded apart, and a word met before in the task is looked up. New words of a batch lie in one flat numpy array of symbols. A
round ranks all neighbouring pairs, takes the minimum per word, merges all its occurrences from the left that do not overlap, and compacts
the array. If a merge makes a pair that is due no later than the one just merged, the word merges its leftmost occurrence alone
in that round, so the order of merges is that of the library. A word leaves when no pair remains. Characters without a piece become
their UTF-8 bytes.

Only vocabularies without text normalisation and with byte fallback are accepted (``Vocabulary`` checks it).

Defined cases: a null or empty text has no ids and decodes to the empty text. Repeated rows, ids and other columns do not matter.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import quoted, text_of

SPACE = "▁"
#: Words a task remembers; then it starts anew.
REMEMBERED = 200_000
#: Texts encoded together.
PIECE = 512
NONE = np.iinfo(np.int32).max

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Vocabulary:
    """The tables of a model file, in numpy."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "".join(model.encode(" ﬁ  a ", out_type=str))
        if probe != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}" or not model.is_byte(model.encode("\n")[-1]):
            raise ValueError("only vocabularies without normalisation and with byte fallback")
        count = model.get_piece_size()
        plain = [i for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = {model.id_to_piece(i): i for i in plain}
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("a piece reaches over the start of a word")
        self.bytes = np.full(256, -1, dtype=np.int32)
        self.written: list[bytes] = [b""] * count
        for i in range(count):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes[value] = i
                self.written[i] = bytes([value])
            elif model.is_unknown(i):
                self.written[i] = " ⁇ ".encode()
        for name, i in names.items():
            self.written[i] = name.replace(SPACE, " ").encode()
        self.blank = {i for name, i in names.items() if name.startswith(SPACE)}
        # symbols: pieces, then characters that occur in pieces without being one
        self.symbols = [*names, *sorted({c for name in names for c in name} - set(names))]
        number = {s: k for k, s in enumerate(self.symbols)}
        self.ids = np.array([names.get(s, -1) for s in self.symbols], dtype=np.int32)
        scores = np.array([model.get_score(i) for i in names.values()])
        order = np.unique(-scores, return_inverse=True)[1]
        self.characters = -np.arange(0x110000, dtype=np.int32) - 1
        for s, k in number.items():
            if len(s) == 1:
                self.characters[ord(s)] = k
        pairs = {}
        for k, name in enumerate(names):
            for cut in range(1, len(name)):
                a, b = number.get(name[:cut]), number.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a * len(self.symbols) + b] = (int(order[k]), k)
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys, found = keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int32).reshape(-1, 2)
        self.rank, self.made = found[:, 0], found[:, 1]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of pairs in the table, -1 for none."""
        key = left.astype(np.int64) * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "each_byte")
        first = next((i for i in ids if self.written[i]), None)
        return text[1:] if first in self.blank else text


def _pair_ranks(v: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and table number of the pair that starts at each symbol."""
    number = np.full(len(symbols), -1, dtype=np.int64)
    if len(symbols) > 1:
        number[:-1] = np.where(word[:-1] == word[1:], v.look_up(symbols[:-1], symbols[1:]), -1)
    return np.where(number >= 0, v.rank[number], NONE), number


def _merged(v: Vocabulary, symbols: np.ndarray, word: np.ndarray, number: np.ndarray, take: np.ndarray):
    out = symbols.copy()
    out[take] = v.made[number[take]]
    keep = np.ones(len(symbols), dtype=bool)
    keep[1:][take[:-1]] = False
    return out[keep], word[keep], take[keep]


def merge_rounds(v: Vocabulary, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """All merges of words 0 .. words - 1 given as symbols with their sorted word numbers."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank, number = _pair_ranks(v, symbols, word)
    while len(symbols):
        least = np.full(words, NONE, dtype=rank.dtype)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least[word[first]] = np.minimum.reduceat(rank, first)
        active = least[word] < NONE
        if not active.all():
            done.append((symbols[~active], word[~active]))
            symbols, word, rank, number = symbols[active], word[active], rank[active], number[active]
            if not len(symbols):
                break
        hit = rank == least[word]
        at = np.flatnonzero(hit)
        run = np.append(True, np.diff(at) != 1)  # a run of hits: every second one from its start
        begin = at[np.flatnonzero(run)[np.cumsum(run) - 1]]
        take = np.zeros(len(symbols), dtype=bool)
        take[at[(at - begin) % 2 == 0]] = True
        new, new_word, made = _merged(v, symbols, word, number, take)
        new_rank, new_number = _pair_ranks(v, new, new_word)
        near = made.copy()
        near[:-1] |= made[1:]  # pairs with a new symbol on either side
        early = near & (new_rank <= least[new_word]) & (np.bincount(word[take], minlength=words)[new_word] > 1)
        if early.any():
            bad = np.zeros(words, dtype=bool)
            bad[new_word[early]] = True
            taken = np.flatnonzero(take)
            leftmost = np.append(True, word[taken][1:] != word[taken][:-1])
            take[taken[bad[word[taken]] & ~leftmost]] = False
            new, new_word, made = _merged(v, symbols, word, number, take)
            new_rank, new_number = _pair_ranks(v, new, new_word)
        symbols, word, rank, number = new, new_word, new_rank, new_number
    if not done:
        return symbols, word
    symbols, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


class Encoder:
    """Encodes batches of texts; remembers words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """words: without the U+2581 each begins with."""
        v = self.v
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        size = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join([SPACE + w for w in words]).encode("utf-32-le"), dtype=np.uint32)
        symbols, word = merge_rounds(v, v.characters[codes], np.repeat(np.arange(len(words)), size), len(words))
        ids = np.where(symbols >= 0, v.ids[np.maximum(symbols, 0)], -1).astype(np.int32)
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            strings = [chr(-s - 1) if s < 0 else v.symbols[s] for s in symbols[lost].tolist()]
            pieces = [v.bytes[np.frombuffer(c.encode(), dtype=np.uint8)] for c in strings]
            many = np.ones(len(ids), dtype=np.int64)
            many[lost] = [len(p) for p in pieces]
            inside = np.repeat(ids < 0, many)
            ids, word = np.repeat(ids, many), np.repeat(word, many)
            ids[inside] = np.concatenate(pieces)
        ends = np.searchsorted(word, np.arange(1, len(words) + 1)) * 4
        flat, begin = ids.tobytes(), 0
        for w, end in zip(words, ends.tolist(), strict=True):
            self.known[w] = flat[begin:end]
            begin = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = []
        for text in texts:
            text = text.replace(" ", SPACE)
            if not text:
                cut.append([])
            elif SPACE + SPACE in text or text.startswith(SPACE):
                cut.append([w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text)])
            else:
                cut.append(text.split(SPACE))
        new = {w for words in cut for w in words} - self.known.keys()
        if new:
            before = len(self.known)
            self._learn(sorted(new))
            if len(self.known) < before + len(new):  # it started anew: what this batch knew before is missing
                rest = {w for words in cut for w in words} - self.known.keys()
                if rest:
                    self._learn_more(sorted(rest))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32) for words in cut]

    def _learn_more(self, words: list[str]) -> None:
        kept = self.known
        self.known = {}
        self._learn(words)
        self.known.update(kept)


def encode_decode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``ids`` (array<int>) and ``decoded``, the text that the ids decode to."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_path)
        encoder = Encoder(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, PIECE):
                part = batch.slice(lo, PIECE)
                ids = encoder.encode(part.column(1).to_pylist())
                decoded = [vocabulary.decode(own.tolist()) if len(own) else "" for own in ids]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(quoted(id_column)).alias("id"), text_of(text))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_column)
