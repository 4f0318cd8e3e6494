"""Language identification with a bidirectional gated recurrent network over bytes.

Two gated recurrent layers of numpy read the bytes forwards and backwards; every byte gets a probability of
each language, and a document's probabilities are the mean over all its bytes.  The
network is trained here by backpropagation through time on a bounded sample of labelled texts.

A text is read in windows with some bytes of context on either side; each byte is labelled in exactly one
window, so texts of any length are read whole and in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.text import buffers, slices
from clickloom.session import pin

HIDDEN = 8
WINDOW, CONTEXT = 208, 16
AT_ONCE = 2048          # windows in a matrix
SNIPPET = 240           # characters of a training text
PER_LABEL = 300         # most training texts of a label
TEXTS = 19_200          # most training texts in all: the labels share them
STEPS, BATCH, LENGTH = 500, 128, 64
SHORT_EVERY = 3         # one training piece in so many is short, as texts can be
RATE = 0.02


@dataclass
class Network:
    """Per direction: gate inputs of each byte (256 x 3H; update, reset, candidate) and recurrent weights (H x 3H); output weights."""

    inputs: list
    recurrent: list
    out: np.ndarray
    bias: np.ndarray
    labels: list

    @classmethod
    def fresh(cls, labels: list, hidden: int = HIDDEN, seed: int = 5) -> Network:
        draw = np.random.default_rng(seed)

        def normal(*shape, scale):
            return draw.normal(0, scale, shape).astype(np.float32)

        return cls([normal(256, 3 * hidden, scale=0.5) for _ in range(2)],
                   [normal(hidden, 3 * hidden, scale=hidden ** -0.5) for _ in range(2)],
                   normal(2 * hidden, len(labels), scale=0.3), np.zeros(len(labels), dtype=np.float32), labels)

    def parts(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.out, self.bias]


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


# --- training ---------------------------------------------------------------------------

def _forward(net: Network, side: int, x: np.ndarray) -> tuple[np.ndarray, list]:
    """States (T, B, H) of one direction, and what going back needs."""
    hidden = net.recurrent[side].shape[0]
    steps = range(len(x)) if side == 0 else range(len(x) - 1, -1, -1)
    h = np.zeros((x.shape[1], hidden), dtype=np.float32)
    states, kept = np.zeros((*x.shape, hidden), dtype=np.float32), []
    for t in steps:
        a = h @ net.recurrent[side]
        g = net.inputs[side][x[t]]
        gates = sigmoid(g[:, :2 * hidden] + a[:, :2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(g[:, 2 * hidden:] + r * a[:, 2 * hidden:])
        kept.append((t, h, z, r, n, a[:, 2 * hidden:]))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def _backward(net: Network, side: int, x: np.ndarray, kept: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input table and recurrent weights, through time; ``given``: gradient of each state."""
    hidden = net.recurrent[side].shape[0]
    d_in, d_rec = np.zeros_like(net.inputs[side]), np.zeros_like(net.recurrent[side])
    carry = np.zeros((x.shape[1], hidden), dtype=np.float32)
    for t, h, z, r, n, a_n in reversed(kept):
        d = given[t] + carry
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (h - n) * z * (1 - z)
        d_r = d_n * a_n * r * (1 - r)
        d_g = np.concatenate((d_z, d_r, d_n), axis=1)
        d_a = np.concatenate((d_z, d_r, d_n * r), axis=1)
        d_rec += h.T @ d_a
        np.add.at(d_in, x[t], d_g)
        carry = d * z + d_a @ net.recurrent[side].T
    return d_in, d_rec


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all bytes of ``x`` (T, B) with labels ``y`` (B), and its gradients."""
    (fore, kept_f), (back, kept_b) = _forward(net, 0, x), _forward(net, 1, x)
    both = np.concatenate((fore, back), axis=2)
    p = softmax(both @ net.out + net.bias)
    n = x.size
    loss = float(-np.log(np.maximum(p[:, np.arange(len(y)), y], 1e-9)).mean())
    p[:, np.arange(len(y)), y] -= 1
    p /= n
    d_out = np.einsum("tbh,tbc->hc", both, p)
    d_both = p @ net.out.T
    hidden = fore.shape[2]
    in_f, rec_f = _backward(net, 0, x, kept_f, d_both[:, :, :hidden])
    in_b, rec_b = _backward(net, 1, x, kept_b, d_both[:, :, hidden:])
    return loss, [in_f, in_b, rec_f, rec_b, d_out, p.sum(axis=(0, 1))]


def train(samples: list[tuple[str, bytes]], steps: int | None = None, hidden: int | None = None, seed: int = 5) -> Network:
    """Fit on (label, bytes); labels weigh the same and take turns in the batches.  The same samples give the same network.

    From 32 labels on the layers grow, and beyond a batch of labels the steps.
    """
    labels = sorted({label for label, data in samples if data})
    hidden = hidden or HIDDEN * max(1, (len(labels).bit_length() - 2) // 2)
    steps = steps or STEPS * max(1, -(-len(labels) // BATCH))
    net = Network.fresh(labels, hidden, seed)
    if len(labels) < 2:
        return net
    draw = np.random.default_rng(seed + 1)
    by_label = [[np.frombuffer(data, dtype=np.uint8) for label, data in samples if label == want and data] for want in labels]
    moment = [np.zeros_like(p) for p in net.parts()]
    square = [np.zeros_like(p) for p in net.parts()]
    for step in range(1, steps + 1):
        y = (np.arange(BATCH) + (step - 1) * BATCH) % len(labels)
        x = np.zeros((LENGTH, BATCH), dtype=np.uint8)
        for b in range(BATCH):
            data = by_label[y[b]][draw.integers(len(by_label[y[b]]))]
            size = LENGTH if b % SHORT_EVERY else int(draw.integers(8, LENGTH))
            at = draw.integers(max(1, len(data) - size + 1))
            piece = data[at:at + size]
            x[:len(piece), b] = piece
        _, grads = gradients(net, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * (1 - 0.9 * step / steps)
        for p, g, m, s in zip(net.parts(), grads, moment, square):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


# --- reading ------------------------------------------------------------------------------

def _states(net: Network, side: int, x: np.ndarray, h: np.ndarray, each) -> None:
    """Run one direction over (T, B) bytes; ``each(t, h)`` gets every state."""
    hidden = h.shape[1]
    # by gate (3, 256, H) and (3, H, H), so that numpy works on whole pieces of memory; the halves are those of the sigmoid
    table, weights = (np.stack(np.split(p, 3, axis=1)) for p in (net.inputs[side], net.recurrent[side]))
    table[:2] *= 0.5
    weights[:2] *= 0.5
    a, g = (np.empty((3, *h.shape), dtype=np.float32) for _ in range(2))
    gates, n, last = g[:2], g[2], a[2]
    steps = range(len(x)) if side == 0 else range(len(x) - 1, -1, -1)
    for t in steps:
        np.matmul(h, weights, out=a)
        np.take(table, x[t], axis=1, out=g, mode="clip")
        gates += a[:2]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        last *= gates[1]
        last += n
        np.tanh(last, out=last)
        h -= last
        h *= gates[0]
        h += last
        each(t, h)


def window_sums(net: Network, x: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Summed label probabilities (B, labels) over the counted bytes of each window; ``x``, ``counted``: (T, B)."""
    many = x.shape[1]
    hidden, classes = net.recurrent[0].shape[0], len(net.labels)
    # read forwards, no counted byte sees what follows the last one; read backwards, none sees what precedes the first
    some = np.flatnonzero(counted.any(axis=1))
    lo, hi = (int(some[0]), int(some[-1]) + 1) if len(some) else (0, 0)
    logits = np.empty((hi - lo, classes, many), dtype=np.float32)
    out = [np.ascontiguousarray(net.out[s * hidden:(s + 1) * hidden].T) for s in range(2)]
    bias = net.bias[:, None]

    def fore(t: int, h: np.ndarray) -> None:
        if t < lo:
            return
        np.matmul(out[0], h.T, out=logits[t - lo])

    total = np.zeros((classes, many), dtype=np.float64)
    part = np.empty((classes, many), dtype=np.float32)

    def back(t: int, h: np.ndarray) -> None:
        if t >= hi - lo:
            return
        np.matmul(out[1], h.T, out=part)
        p = logits[t]
        p += part
        p += bias
        np.clip(p, -30, 30, out=p)
        np.exp(p, out=p)
        p *= counted[lo + t] / p.sum(axis=0)
        np.add(total, p, out=total)

    for side, each, read in ((0, fore, x[:hi]), (1, back, x[lo:])):
        _states(net, side, read, np.zeros((many, hidden), dtype=np.float32), each)
    return total.T


def byte_labels(net: Network, text: bytes) -> list[str]:
    """The label of every byte of a text, as one window."""
    x = np.frombuffer(text, dtype=np.uint8)[:, None]
    hidden = net.recurrent[0].shape[0]
    logits = np.zeros((len(x), len(net.labels)), dtype=np.float32)
    for side in range(2):
        weights = net.out[side * hidden:(side + 1) * hidden]

        def each(t: int, h: np.ndarray, weights=weights) -> None:
            logits[t] += (h @ weights)[0]

        _states(net, side, x, np.zeros((1, hidden), dtype=np.float32), each)
    return [net.labels[i] for i in (logits + net.bias).argmax(axis=1)]


def document_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities over all bytes of each row (0 for empty rows)."""
    lengths = np.diff(offsets)
    per_doc = -(-lengths // WINDOW)
    doc = np.repeat(np.arange(len(lengths)), per_doc)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)) * WINDOW
    sums = np.zeros((len(lengths), len(net.labels)))
    steps = np.arange(-CONTEXT, WINDOW + CONTEXT)
    # windows of like length together, so that short texts do not wait for long ones
    filled = np.minimum(lengths[doc] - begin, WINDOW)
    order = np.argsort(filled, kind="stable")
    for lo in range(0, len(order), AT_ONCE):
        some = order[lo:lo + AT_ONCE]
        most = int(filled[some[-1]])
        place = steps[:most + 2 * CONTEXT, None] + begin[some][None, :]
        size = lengths[doc[some]][None, :]
        inside = (place >= 0) & (place < size)
        x = data[np.where(inside, place + offsets[doc[some]][None, :], 0)]
        x[~inside] = 0
        counted = inside.copy()
        counted[:CONTEXT] = False
        counted[CONTEXT + most:] = False
        np.add.at(sums, doc[some], window_sums(net, x, counted.astype(np.float32)))
    return sums / np.maximum(lengths, 1)[:, None]


# --- over tables ------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, key: str, text: str, label: str, per_label: int = PER_LABEL,
                    texts: int = TEXTS) -> list[tuple[str, bytes]]:
    """At most ``per_label`` snippets of each label, and ``texts`` in all: every label gets its share, one at least.

    Chosen are the least hashes of key and text, each once, so rows that repeat a key or have none are sampled like others and
    copies of one row count as one.  Beyond ``texts`` labels the most frequent are learned.  What reaches the driver is
    bounded by ``texts`` times ``SNIPPET`` characters, whatever the number of rows; snippets begin at a place given by the hash.
    """
    rows = docs.select(F.col(label).cast("string").alias("_label"), F.col(text).alias("_text"),
                       F.xxhash64(F.lit("sample"), F.col(key).cast("string"), F.col(text)).alias("_hash"))
    rows = rows.filter(F.col("_label").isNotNull() & (F.col("_text") != ""))
    once = pin(rows.groupBy("_label", "_hash").agg(F.count("*").alias("_n")), "language-rows")
    labels = pin(once.groupBy("_label").agg(F.sum("_n").alias("_n")).orderBy(F.desc("_n"), "_label").limit(texts)
                 .select(F.col("_label").alias("_of")), "language-labels")
    share = max(1, min(per_label, texts // max(1, labels.count())))
    nth = F.row_number().over(Window.partitionBy("_label").orderBy("_hash"))
    first = once.withColumn("_nth", nth).filter(F.col("_nth") <= share).join(labels, F.col("_label") == F.col("_of"))
    chosen = pin(first.select(F.col("_label").alias("_of"), F.col("_hash").alias("_at")), "language-chosen")   # at most ``texts`` rows
    at = F.pmod("_hash", F.greatest(F.length("_text") - SNIPPET + 1, F.lit(1))).cast("int") + 1
    found = (rows.join(F.broadcast(chosen), (F.col("_label") == F.col("_of")) & (F.col("_hash") == F.col("_at")))
             .groupBy("_label", "_hash").agg(F.min(F.substr("_text", at, F.lit(SNIPPET))).alias("_part")))
    return sorted({(r._label, r._part.encode()) for r in found.collect() if r._part})


def predict(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row: the label with the highest mean probability over all bytes of the whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.  Ties go to the first label.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), letters.alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 2 << 20):
                data, offsets = buffers(batch.column(1).slice(lo, hi - lo))
                known = batch.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                if len(net.labels):
                    p = document_probabilities(net, data, offsets)
                    best = p.argmax(axis=1)
                    label = np.array(net.labels, dtype=object)[best]
                    score = np.minimum(p[np.arange(len(best)), best], 1.0)
                else:
                    known = np.zeros(hi - lo, dtype=bool)
                    label, score = np.full(hi - lo, "und", dtype=object), np.zeros(hi - lo)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(np.where(known, label, "und"), type=pa.string()),
                    pa.array(np.where(known, score, 0.0), type=pa.float64())], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Train on the rows that are not held out, predict all: doc_id, held_out, lang_pred, score."""
    net = train(labelled_sample(docs.filter(~held_out(F.col(key))), key, text, label))
    return predict(docs, net, key, text).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
