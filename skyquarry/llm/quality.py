"""A quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, and filters of WIDTH bytes slide over the whole text in steps of STRIDE. The text is covered by
overlapping chunks; each filter's response is max-pooled over a chunk, and the chunks' pooled vectors are combined by
their mean and their maximum into one probability. All of it is learned from labels by gradient descent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import byte_buffer, map_arrow

#: Labelled rows that train the network at most (a bounded sample by hash).
TRAIN_ROWS = 2400
EMBED, WIDTH, STRIDE, FILTERS = 6, 12, 4, 24
#: Bytes of a long text whose responses are held at once (a multiple of a chunk step's bytes), and of one that teaches in a step.
PART, LESSON = 1 << 18, 40_000
#: Filter positions of a chunk, and those from one chunk to the next: chunks overlap by half.
CHUNK, STEP = 64, 32
EPOCHS, BATCH, RATE = 12, 32, 0.01


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        "embed": rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "out": np.zeros(1, np.float32),
    }


def windows(text: np.ndarray) -> np.ndarray:
    """The bytes under each filter position, (positions, WIDTH); what is beyond the text is symbol 256."""
    n = max(1, -(-len(text) // STRIDE))
    padded = np.full(n * STRIDE + WIDTH, 256, np.int16)
    padded[: len(text)] = text
    return np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[: n * STRIDE : STRIDE]


def pooled(responses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of each filter in each chunk, and its position: both (chunks, filters)."""
    n = len(responses)
    starts = np.arange(0, max(1, n - (CHUNK - STEP)), STEP)
    pad = starts[-1] + CHUNK - n
    if pad > 0:
        responses = np.concatenate([responses, np.full((pad, responses.shape[1]), -np.inf, responses.dtype)])
    half = responses.reshape(-1, STEP, responses.shape[1])  # CHUNK is two steps
    best = half.max(1)
    left, right = best[:-1], best[1:]
    return np.maximum(left, right), starts


def positions_of(responses: np.ndarray, best: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Position of each chunk's maximum, for training."""
    out = np.empty(best.shape, np.int64)
    for c, s in enumerate(starts):
        out[c] = s + responses[s : s + CHUNK].argmax(0)
    return out


def features(text: np.ndarray, net: dict) -> tuple:
    w = windows(text)
    under = net["embed"][w].reshape(len(w), -1)
    responses = under @ net["filters"]
    best, starts = pooled(responses)
    best = np.tanh(best + net["bias"])
    return w, under, responses, best, starts, np.concatenate([best.mean(0), best.max(0)])


def whole_features(text: np.ndarray, net: dict) -> np.ndarray:
    """What features gives of any text, part by part: a part ends where a chunk begins, and the next repeats that half chunk."""
    if len(text) <= PART + CHUNK * STRIDE:
        return features(text, net)[-1]
    n = -(-len(text) // STRIDE)
    chunks = -(-max(1, n - (CHUNK - STEP)) // STEP)
    total, top = np.zeros(FILTERS), np.full(FILTERS, -np.inf, np.float32)
    each = PART // (STEP * STRIDE)
    for c in range(0, chunks, each):
        use = min(each, chunks - c)
        begin, end = c * STEP * STRIDE, ((c + use - 1) * STEP + CHUNK) * STRIDE
        w = windows(text[begin : end + WIDTH])[: (use - 1) * STEP + CHUNK]
        w = w[: min(len(w), n - c * STEP)]
        best = pooled(net["embed"][w].reshape(len(w), -1) @ net["filters"])[0][:use]
        best = np.tanh(best + net["bias"])
        total += best.sum(0, dtype=float)
        top = np.maximum(top, best.max(0))
    return np.concatenate([total / chunks, top])


def probability(text: np.ndarray, net: dict) -> float:
    z = float(whole_features(text, net) @ net["dense"] + net["out"][0])
    return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def gradients(text: np.ndarray, label: float, weight: float, net: dict, into: dict) -> None:
    w, under, responses, best, starts, f = features(text, net)
    z = float(f @ net["dense"] + net["out"][0])
    dz = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - label)
    into["dense"] += dz * f
    into["out"] += dz
    mean, top = net["dense"][:FILTERS], net["dense"][FILTERS:]
    d = np.repeat(dz * mean[None, :] / len(best), len(best), 0)
    d[best.argmax(0), np.arange(FILTERS)] += dz * top
    d *= 1 - best**2
    into["bias"] += d.sum(0)
    at = positions_of(responses, best, starts)
    flat, cols = at.ravel(), np.tile(np.arange(FILTERS), len(best))
    d = d.ravel()
    use, inverse = np.unique(flat, return_inverse=True)
    dense = np.zeros((len(use), FILTERS), np.float32)
    np.add.at(dense, (inverse, cols), d)
    into["filters"] += under[use].T @ dense
    back = (dense @ net["filters"].T).reshape(-1, EMBED)
    np.add.at(into["embed"], w[use].ravel(), back)


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 11) -> dict[str, np.ndarray]:
    """A network that tells label 1 from 0; both classes weigh the same. Without both classes its answer is their share."""
    net = initial(seed)
    y = np.array(labels, float)
    share = y.mean() if len(y) else 0.5
    if not 0 < share < 1:
        net["dense"][:] = 0
        net["out"][:] = np.log((share + 0.01) / (1.01 - share))
        return net
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    rng, step = np.random.default_rng(seed), 0
    arrays = [np.frombuffer(t, np.uint8) for t in texts]
    for epoch in range(epochs):
        order = rng.permutation(len(arrays))
        rate = RATE * (1 - epoch / epochs) + RATE / 20
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            into = {k: np.zeros_like(v) for k, v in net.items()}
            for j in part:
                # another offset each time: what the filters learn holds at every position
                text = arrays[j][rng.integers(0, STRIDE) :]
                if len(text) > LESSON:  # of a very long text another stretch each time
                    at = rng.integers(0, len(text) - LESSON)
                    text = text[at : at + LESSON]
                gradients(text, y[j], 0.5 / (share if y[j] else 1 - share), net, into)
            step += 1
            for k, g in into.items():
                g /= len(part)
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    # the classes weighed the same; the answer is for their shares in the sample
    net["out"] += np.float32(np.log(share / (1 - share)))
    return net


def trained(docs: DataFrame, labels: DataFrame, may_learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """A network fitted on at most `most` labelled ids for which may_learn holds: those of the least hashes. An id labelled twice has its greater label; of several texts of an id one teaches."""
    named = F.col(id_col).isNotNull()
    chosen = labels.where(may_learn & F.col(label_col).isin(0, 1) & named).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(most)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # of a very long text as many stretches travel, spread evenly, as there are lessons from it
    size = F.length(text)
    stretches = F.concat(*[F.substring(text, F.floor((size - LESSON) * i / (EPOCHS - 1)).cast("int") + 1, F.lit(LESSON)) for i in range(EPOCHS)])
    texts = docs.where(named).select(id_col, F.when(size > EPOCHS * LESSON, stretches).otherwise(text).alias("text"))
    least = texts.join(F.broadcast(chosen), id_col).groupBy(id_col).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("row"))
    rows = sorted(least.select("row.text", "row.label").collect())
    return fit([r["text"].encode() for r in rows], [r["label"] for r in rows])


def scored(docs: DataFrame, net: dict, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score_col, the probability of label 1, over the whole text; null counts as empty, and an empty text is scored like any other. A column of that name is replaced."""
    fields = [f for f in docs.schema.fields if f.name != score_col]
    at = [f.name for f in fields].index(text_col)
    types = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in fields), (score_col, pa.float64())])

    def kernel(it):
        for b in it:
            data, offsets = byte_buffer(b.column(at))
            got = [probability(data[s:e], net) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], schema=types)

    return map_arrow(docs.select([F.col(f"`{f.name}`") for f in fields]), kernel, T.StructType([*fields, T.StructField(score_col, T.DoubleType())]))
