"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads windows of 64 bytes in both directions and labels every position; the label probabilities of all positions of a
text are averaged, the largest average is its score. It is trained here, in numpy, by backpropagation through time
with Adam, on a bounded sample of labelled rows (``SAMPLE`` rows in all, equally many for each label and one at least, chosen by a hash of
the id, one stretch of each). No label is left out. Every byte of every text is labelled; long texts are read a bounded piece at a time.

Only texts and labels of rows outside the held-out fold are learned from; a prediction sees the text alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Rows without a label or an id are not learned from; a row with a
null id is not held out. If nothing can be learned every text is ``und``. Ties go to the label that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import arrow_bytes, quoted, stored

UNKNOWN = "und"
#: Rows of the training sample. Every label is learned: with more labels than this, from one row each.
SAMPLE = 4096
#: Characters of a sampled row; its place in the text depends on a hash.
STRETCH = 400
HIDDEN, WINDOW, STEPS, BATCH = 8, 64, 320, 256
#: Windows labelled at a time.
LANES = 2048
#: A text is rejected by the filter if no language reaches this average probability.
MIN_SCORE = 0.35


@dataclass
class Model:
    """Weights of both directions (first axis), gates stacked as reset, update, candidate."""

    labels: list[str]
    inputs: np.ndarray  # (2, 3H, 256) with biases
    recurrent: np.ndarray  # (2, 3H, H)
    outputs: np.ndarray  # (2, C, H)
    bias: np.ndarray  # (C, 1)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.outputs, self.bias]


def fresh(labels: list[str], seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    h, c = HIDDEN, len(labels)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Model(labels, draw(2, 3 * h, 256, scale=0.5), draw(2, 3 * h, h, scale=h ** -0.5), draw(2, c, h, scale=0.3), np.zeros((c, 1), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    """In place."""
    x -= x.max(axis=axis, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=axis, keepdims=True)
    return x


def gradients(model: Model, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients for full windows, codes (T, B) and their labels (B,)."""
    steps, lanes = codes.shape
    h, both = HIDDEN, np.stack([codes, codes[::-1]], axis=1)  # (T, 2, B)
    state = np.zeros((2, h, lanes), np.float32)
    kept = []
    states = np.empty((steps, 2, h, lanes), np.float32)
    for t in range(steps):
        x = np.stack([model.inputs[k][:, both[t, k]] for k in (0, 1)])
        g = model.recurrent @ state
        gates = _sigmoid(x[:, :2 * h] + g[:, :2 * h])
        r, z = gates[:, :h], gates[:, h:]
        inner = g[:, 2 * h:]
        n = np.tanh(x[:, 2 * h:] + r * inner)
        kept.append((state, r, z, inner, n))
        state = n + z * (state - n)
        states[t] = state
    forward = np.einsum("ch,thb->tcb", model.outputs[0], states[:, 0], optimize=True)
    backward = np.einsum("ch,thb->tcb", model.outputs[1], states[::-1, 1], optimize=True)
    p = _softmax(forward + backward + model.bias, 1)
    hit = p[:, target, np.arange(lanes)]
    loss = float(-np.log(np.maximum(hit, 1e-9)).mean())
    p[:, target, np.arange(lanes)] -= 1
    p /= steps * lanes
    d_out = np.stack([np.einsum("tcb,thb->ch", p, states[:, 0], optimize=True), np.einsum("tcb,thb->ch", p[::-1], states[:, 1], optimize=True)])
    d_bias = p.sum(axis=(0, 2))[:, None]
    d_in, d_rec = np.zeros_like(model.inputs), np.zeros_like(model.recurrent)
    carried = np.zeros((2, h, lanes), np.float32)
    back = np.swapaxes(model.recurrent, 1, 2)
    for t in range(steps - 1, -1, -1):
        before, r, z, inner, n = kept[t]
        d = carried + np.stack([model.outputs[0].T @ p[t], model.outputs[1].T @ p[steps - 1 - t]])
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * inner * r * (1 - r)
        dg = np.concatenate([dr, dz, dn * r], axis=1)
        d_rec += dg @ np.swapaxes(before, 1, 2)
        carried = d * z + back @ dg
        dx = np.concatenate([dr, dz, dn], axis=1)
        for k in (0, 1):
            one_hot = np.zeros((lanes, 256), np.float32)
            one_hot[np.arange(lanes), both[t, k]] = 1
            d_in[k] += dx[k] @ one_hot
    return loss, [d_in, d_rec, d_out, d_bias]


def trained(texts: list[str], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model | None:
    """Adam on windows drawn from the sampled texts."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    model = fresh(names, seed)
    codes = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
    codes = [np.resize(c, max(WINDOW, len(c))) if len(c) else np.full(WINDOW, 32, np.uint8) for c in codes]
    of = np.array([names.index(x) for x in labels])
    by_label = [np.flatnonzero(of == k) for k in range(len(names))]
    first = [np.zeros_like(p) for p in model.parameters]
    second = [np.zeros_like(p) for p in model.parameters]
    for step in range(1, steps + 1):
        label = rng.integers(0, len(names), BATCH)
        rows = [by_label[k][rng.integers(0, len(by_label[k]))] for k in label]
        cuts = [codes[i][(at := rng.integers(0, len(codes[i]) - WINDOW + 1)):at + WINDOW] for i in rows]
        _, grads = gradients(model, np.stack(cuts, axis=1).astype(np.int64), label)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 1.2 - step / steps)
        for p, g, m, v in zip(model.parameters, grads, first, second, strict=True):
            g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def _window_sums(model: Model, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of the label probabilities over the positions of each window, (C, windows)."""
    h, lanes, steps = HIDDEN, len(starts), int(lengths.max())
    at = np.arange(steps)[:, None]
    inside = at < lengths
    ahead = np.where(inside, data[np.minimum(starts + at, len(data) - 1)], 0)
    behind = np.where(inside, data[np.maximum(starts + lengths - 1 - at, 0)], 0)
    scores = []
    for k, codes in enumerate((ahead, behind)):
        state = np.zeros((h, lanes), np.float32)
        out = np.empty((steps, len(model.labels), lanes), np.float32)
        table = model.inputs[k]
        for t in range(steps):
            x = table.take(codes[t], axis=1)
            g = model.recurrent[k] @ state
            gates = g[:2 * h]
            gates += x[:2 * h]
            _sigmoid(gates)
            n = g[2 * h:]
            n *= gates[:h]
            n += x[2 * h:]
            np.tanh(n, out=n)
            state -= n
            state *= gates[h:]
            state += n
            out[t] = model.outputs[k] @ state
        scores.append(out)
    turn = np.maximum(lengths - 1 - at, 0)
    full = lengths == steps
    backward = scores[1][::-1].copy() if full.all() else np.take_along_axis(scores[1], turn[:, None, :], axis=0)
    p = _softmax(np.add(scores[0], backward, out=backward) + model.bias, 1)
    if not full.all():
        p *= inside[:, None, :]
    return p.sum(axis=0)


def probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    """(texts, C) average label probabilities; zeros for an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(1, np.uint8)
    size = np.diff(offsets)
    windows = -(-size // WINDOW)
    ends = np.cumsum(windows)
    out = np.zeros((len(texts), len(model.labels)))
    total = int(ends[-1]) if len(ends) else 0
    for lo in range(0, total, LANES):
        number = np.arange(lo, min(lo + LANES, total))
        row = np.searchsorted(ends, number, side="right")
        start = offsets[row] + (number - (ends[row] - windows[row])) * WINDOW
        length = np.minimum(WINDOW, offsets[row + 1] - start)
        sums = _window_sums(model, data, start, length)
        cut = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[cut]] += np.add.reduceat(sums, cut, axis=1).T
    return out / np.maximum(size, 1)[:, None]


def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(quoted(id_column)).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Train on a bounded sample of the rows outside the held-out fold."""
    known = docs.select(
        F.col(quoted(id_column)).cast("string").alias("id"), F.col(quoted(text)).alias("text"), F.col(quoted(lang)).alias("lang"),
        held_out(id_column).alias("held")).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL AND NOT held")
    known = known.where(F.col("text").rlike(r"\p{L}")).withColumn("place", F.xxhash64("id", F.lit(99)))
    counts = known.groupBy("lang").count().collect()  # a row for each label, as the network has an output for each
    if not counts:
        return None
    each = max(1, SAMPLE // len(counts))
    # a share of the hash range in which about twice the wanted rows lie, and never so few that a label might be missed
    shares = [(r["lang"], min(1.0, max(2.0 * each, each + 20.0) / r["count"])) for r in counts]
    shared = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    near = known.withColumn("lang", F.col("lang").cast("string")).join(F.broadcast(shared), "lang").where(
        F.pmod(F.col("place"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    start = F.pmod(F.xxhash64("id", F.lit(5)), F.greatest(F.lit(1), F.length("text") - STRETCH))
    near = near.select("id", "lang", F.substring("text", (start + 1).cast("int"), F.lit(STRETCH)).alias("text"))
    # rows of a hash share: their number follows the sample, not the table
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit(3)), "id", "text")
    by_lang: dict[str, list] = {}
    for r in near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each).orderBy("lang", "nth").collect():
        by_lang.setdefault(r["lang"], []).append(r["text"])
    rows = [(t, k) for k in sorted(by_lang) for t in by_lang[k]]
    return trained([t for t, _ in rows], [k for _, k in rows])


def _predicted(model: Model | None, texts: pa.Array, letters: pa.Array) -> tuple[list[str], np.ndarray]:
    letter = np.array(letters.fill_null(False).to_pylist(), dtype=bool)
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    p = probabilities(model, texts)
    best = p.argmax(axis=1)
    names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, letter, strict=True)]
    return names, np.where(letter, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = _predicted(model, batch.column(2), batch.column(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)], ["id", "held_out", "lang_pred", "score"])

    own = F.col(quoted(text))
    rows = docs.select(F.col(quoted(id_column)).alias("id"), held_out(id_column).alias("held_out"), own.cast("string"), own.rlike(r"\p{L}"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_column)


def keep_known(docs: DataFrame, model: Model | None, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, with all their columns, of which a language is recognised; stored, so that batches are small however it is used."""
    schema, names_of, at = docs.schema, docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = _predicted(model, batch.column(at), batch.column(batch.num_columns - 1))
            keep = pa.array([n != UNKNOWN and s >= min_score for n, s in zip(names, score, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:-1]], names=names_of)

    with arrow_bytes(docs.sparkSession):
        return stored(docs.select("*", F.col(quoted(text)).rlike(r"\p{L}")).mapInArrow(run, schema), "known")
