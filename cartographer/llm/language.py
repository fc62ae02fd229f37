"""Language of a document by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in windows; a GRU runs over each window from
either end, and both states together give every position a distribution over
the languages. A document's probabilities are the mean over all its bytes; the
most probable language is its label and that probability its score. The whole
text is read, whatever its length.

The network is trained here in numpy by backpropagation through time, from a
bounded sample of labelled documents: at most ``SAMPLE_DOCS`` for each
language, chosen by a hash of the id, ``SAMPLE_WINDOWS`` windows of each.
Every position of a window carries the document's language as its target.

Null texts and texts without a letter are ``und`` with score 0; so is every
text if there is nothing to learn from. Null languages are never learned.
Rows with a null id are labelled but not learned from. Repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, slices, string_bytes, texts

#: Bound of the training sample: documents of a language, windows of a document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 500, 6
TRAIN_BYTES, WINDOW_BYTES = 64, 128
STATE = 8
STEPS, BATCH, RATE, SEED = 150, 512, 0.012, 7
#: Windows that go through the network together.
WINDOWS_AT_ONCE = 4096
PLACES = 1 << 30
UNKNOWN = "und"
#: Least score of a document that a filter keeps.
MIN_SCORE = 0.4
LETTER = regex.compile(r"\p{L}")

Params = dict[str, np.ndarray]


def new_params(languages: int, rng: np.random.Generator) -> Params:
    draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    out: Params = {"c": np.zeros((languages, 1), np.float32)}
    for way in "fb":
        out["W" + way] = draw(3 * STATE, 256, scale=0.4)  # a byte's input to update gate, reset gate and candidate
        out["U" + way] = draw(3 * STATE, STATE, scale=STATE ** -0.5)
        out["V" + way] = draw(languages, STATE, scale=STATE ** -0.5)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def gru_step(p: Params, way: str, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Next state (features by rows, windows by columns) and what the backward step needs."""
    a, g = np.take(p["W" + way], x, axis=1), p["U" + way] @ h
    gates = _sigmoid(a[:2 * STATE] + g[:2 * STATE])
    z, r = gates[:STATE], gates[STATE:]
    n = np.tanh(a[2 * STATE:] + r * g[2 * STATE:])
    return n + z * (h - n), (x, h, gates, n, g[2 * STATE:])


def gru_back(p: Params, way: str, kept: tuple, dh: np.ndarray, grads: Params) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the previous state and of the byte inputs."""
    _, h, gates, n, gn = kept
    z, r = gates[:STATE], gates[STATE:]
    dn = dh * (1 - z) * (1 - n * n)
    dgates = np.concatenate((dh * (h - n), dn * gn)) * gates * (1 - gates)
    dg = np.concatenate((dgates, dn * r))
    grads["U" + way] += dg @ h.T
    return dh * z + p["U" + way].T @ dg, np.concatenate((dgates, dn))


def loss_and_grads(p: Params, data: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, Params]:
    """Mean cross-entropy over all positions and its gradients.

    ``data`` and ``mask`` have a row per position and a column per window.
    """
    steps, n = data.shape
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    states, kept = {}, {}
    for way, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h = np.zeros((STATE, n), np.float32)
        states[way], kept[way] = [None] * steps, [None] * steps
        for t in order:
            h, kept[way][t] = gru_step(p, way, data[t], h)
            states[way][t] = h
    hf, hb = np.stack(states["f"], 1).reshape(STATE, -1), np.stack(states["b"], 1).reshape(STATE, -1)
    logits = p["Vf"] @ hf + p["Vb"] @ hb + p["c"]
    logits -= logits.max(0)
    prob = np.exp(logits)
    prob /= prob.sum(0)
    goal = np.tile(target, steps)
    weight = mask.reshape(-1).astype(np.float32) / max(1, int(mask.sum()))
    at = np.arange(len(goal))
    loss = float(-(np.log(prob[goal, at] + 1e-9) * weight).sum())
    prob[goal, at] -= 1
    d = prob * weight
    grads["c"] += d.sum(1, keepdims=True)
    for way, h, order in (("f", hf, range(steps - 1, -1, -1)), ("b", hb, range(steps))):
        grads["V" + way] += d @ h.T
        out = (p["V" + way].T @ d).reshape(STATE, steps, n)
        dh, inputs = np.zeros((STATE, n), np.float32), np.empty((steps, 3 * STATE, n), np.float32)
        for t in order:
            dh, inputs[t] = gru_back(p, way, kept[way][t], dh + out[:, t], grads)
        inputs = inputs.transpose(1, 0, 2).reshape(3 * STATE, -1)
        flat = data.reshape(-1)
        for row in range(3 * STATE):
            grads["W" + way][row] += np.bincount(flat, inputs[row], 256).astype(np.float32)
    return loss, grads


def window_matrix(chunks: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (0 behind the end) and mask, a row per position and a column per chunk."""
    data = np.zeros((len(chunks), size), np.uint8)
    mask = np.zeros((len(chunks), size), bool)
    for i, c in enumerate(chunks):
        data[i, :len(c)] = np.frombuffer(c, np.uint8)
        mask[i, :len(c)] = True
    return np.ascontiguousarray(data.T).astype(np.intp), np.ascontiguousarray(mask.T)


def train(chunks: list[bytes], target: np.ndarray, languages: int) -> Params:
    """Adam on batches of windows drawn in equal parts from each language."""
    rng = np.random.default_rng(SEED)
    p = new_params(languages, rng)
    data, mask = window_matrix(chunks, TRAIN_BYTES)
    of = [np.flatnonzero(target == k) for k in range(languages)]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(ix, max(1, BATCH // languages)) for ix in of])
        _, grads = loss_and_grads(p, data[:, pick], mask[:, pick], target[pick])
        norm = float(np.sqrt(sum((g * g).sum() for g in grads.values())))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, g in grads.items():
            g *= min(1.0, 1.0 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return p


def _run(p: Params, way: str, x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``gru_step`` without what training keeps."""
    a, g = np.take(p["W" + way], x, axis=1), p["U" + way] @ h
    gates = a[:2 * STATE]
    gates += g[:2 * STATE]
    _sigmoid(gates)
    n = g[2 * STATE:]
    n *= gates[STATE:]
    n += a[2 * STATE:]
    np.tanh(n, out=n)
    h = h - n
    h *= gates[:STATE]
    h += n
    return h


def label_positions(p: Params, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each position with its distribution over languages (languages by rows, windows by columns)."""
    steps, n = data.shape
    behind = np.empty((steps, len(p["c"]), n), np.float32)
    h = np.zeros((STATE, n), np.float32)
    for t in range(steps - 1, -1, -1):
        h = _run(p, "b", data[t], h)
        np.matmul(p["Vb"], h, out=behind[t])
    h = np.zeros((STATE, n), np.float32)
    for t in range(steps):
        h = _run(p, "f", data[t], h)
        logits = behind[t]
        logits += p["Vf"] @ h
        logits += p["c"]
        logits -= logits.max(0)
        np.exp(logits, out=logits)
        logits /= logits.sum(0)
        yield t, logits


def pool(p: Params, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean distribution of each document (rows) over all its bytes."""
    lengths = np.diff(offsets)
    windows = -(-lengths // WINDOW_BYTES)
    doc = np.repeat(np.arange(len(lengths)), windows)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = offsets[:-1][doc] + nth * WINDOW_BYTES
    size = np.minimum(WINDOW_BYTES, offsets[1:][doc] - begin)
    sums = np.zeros((len(lengths), len(p["c"])))
    padded = np.concatenate((data, np.zeros(WINDOW_BYTES, np.uint8)))
    for at in range(0, len(doc), WINDOWS_AT_ONCE):
        s, n = begin[at:at + WINDOWS_AT_ONCE], size[at:at + WINDOWS_AT_ONCE]
        total = np.zeros((len(p["c"]), len(s)))
        for t, prob in label_positions(p, np.where(
                np.arange(WINDOW_BYTES)[:, None] < n, padded[s + np.arange(WINDOW_BYTES)[:, None]], 0)):
            prob *= t < n
            total += prob
        np.add.at(sums, doc[at:at + WINDOWS_AT_ONCE], total.T)
    return sums / np.maximum(lengths, 1)[:, None]


def remainder(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_windows(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(language, window) of the sample, in a fixed order; never of held-out documents."""
    eligible = docs.select("doc_id", "lang").where((remainder(F.col("doc_id")) != 1) & F.col("lang").isNotNull())
    # far more than the sample lies below twice its share of the hash range: the window sees few rows
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    sizes = eligible.groupBy("lang").agg(F.count("*").alias("n"))  # a row per language
    near = (eligible.withColumn("place", place).join(F.broadcast(sizes), "lang")
            .where(F.col("place") * F.col("n") <= F.lit(2 * SAMPLE_DOCS * PLACES)))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = (near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS)
              .select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang")).distinct())
    n = F.octet_length("text")
    room = F.greatest(n - TRAIN_BYTES, F.lit(0)) + 1
    body = F.col("text").cast("binary")
    cut = [F.substring(body, F.pmod(F.xxhash64("doc_id", F.lit(k)), room).cast("int") + 1, F.lit(TRAIN_BYTES)) for k in range(SAMPLE_WINDOWS)]
    # the sample's ids are few, by its bounds
    rows = (docs.where("text is not null and text <> ''").join(F.broadcast(chosen), (F.col("doc_id") == F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang")))
            .select("lang", "doc_id", F.array_distinct(F.array(*cut)).alias("windows")).collect())  # bounded by the sample
    return sorted((r["lang"], bytes(w)) for r in rows for w in r["windows"])


def fit(docs: DataFrame) -> tuple[list[str], Params | None]:
    """Languages and network learned from ``docs`` (doc_id, text, lang)."""
    sample = training_windows(docs)
    languages = sorted({k for k, _ in sample})
    if not languages:
        return [], None
    index = {k: i for i, k in enumerate(languages)}
    return languages, train([w for _, w in sample], np.array([index[k] for k, _ in sample]), len(languages))


def label(texts: pa.Array, languages: list[str], p: Params | None) -> tuple[list[str], np.ndarray]:
    """Label and score of each text (no nulls)."""
    labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if p is not None:
        pooled = pool(p, *string_bytes(texts))
        best = pooled.argmax(1)
        for i, t in enumerate(texts.to_pylist()):
            if LETTER.search(t):
                labels[i], scores[i] = languages[best[i]], min(1.0, float(pooled[i, best[i]]))
    return labels, scores


def predict(docs: DataFrame, languages: list[str], p: Params | None) -> DataFrame:
    """doc_id, lang_pred and score of every document; reads doc_id and text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            yield [b.column(0), *label(b.column(1), languages, p)]

    return map_arrow(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learns from ``docs`` and labels all of them: doc_id, held_out, lang_pred, score."""
    found = predict(docs, *fit(docs))
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is found with ``min_score`` or more; a null lang is filled with it."""
    languages, p = fit(docs)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            labels, scores = label(b.column(1).fill_null(""), languages, p)
            good = pa.array([x != UNKNOWN and s >= min_score for x, s in zip(labels, scores, strict=True)], pa.bool_())
            filled = [x if x is not None else y for x, y in zip(b.column(2).to_pylist(), labels, strict=True)]
            yield [c.filter(good) for c in (b.column(0), b.column(1), pa.array(filled, pa.string()), b.column(3), b.column(4))]

    return map_arrow(docs.select(*columns), run, ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns))
