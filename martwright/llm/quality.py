"""Text quality by a byte-level convolutional network, trained and run in numpy.

Filters four bytes wide slide over the whole text; their activations are averaged in chunks of 96
bytes that overlap by half; a dense layer looks at every chunk; the largest response of each of its
units over all chunks of the document gives, combined, one probability. Nothing but the text's bytes
goes into a score.

Training takes a bounded sample of labelled documents, evenly from both labels, and like scoring it
reads every byte of them: each step looks at all chunks of its documents, and as a unit's largest
response comes from one chunk, the gradient goes through that chunk only.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

WIDTH = 4
FILTERS = 16
UNITS = 32
STRIDE = 48
CHUNK = 2 * STRIDE
# The bounds of the training sample, per label: documents, and bytes of whole documents.
SAMPLE_DOCUMENTS = 2000
SAMPLE_BYTES = 1 << 24
EPOCHS = 10
BATCH = 32
THRESHOLD = 0.7
# Blocks convolved at once, which should fit the processor's cache, and chunks pooled at once.
BLOCKS_AT_ONCE = 1 << 9
SEGMENT_CHUNKS = 1 << 14

Model = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learnt from: a quarter of all ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def initial(rng: np.random.Generator) -> Model:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "filters": normal(WIDTH, 256, FILTERS, scale=0.3),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": normal(FILTERS + 1, UNITS, scale=0.5),
        "dense_bias": normal(UNITS, scale=0.1),
        "out": normal(UNITS, scale=0.2),
        "out_bias": np.zeros(1, np.float32),
    }


def training_blocks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All blocks of a text: bytes (with the filters' overhang) and how many positions of each are
    text. A chunk is a block and the next one, if there is one."""
    at = np.arange(max(1, -(-len(data) // STRIDE))) * STRIDE
    padded = np.zeros(len(data) + STRIDE + WIDTH, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(padded, STRIDE + WIDTH - 1)[at]
    return windows, np.minimum(len(data) - at, STRIDE).astype(np.int32)


def train(
    blocks: np.ndarray, filled: np.ndarray, owner: np.ndarray, label: np.ndarray, seed: int = 7
) -> Model:
    """Adam on the cross entropy. ``owner`` gives, ascending, the document of each block."""
    rng = np.random.default_rng(seed)
    model = initial(rng)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    bounds = np.searchsorted(owner, np.arange(len(label) + 1))
    step, steps = 0, EPOCHS * -(-len(label) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), BATCH):
            docs = order[k : k + BATCH]
            rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            sizes = bounds[docs + 1] - bounds[docs]
            gradient = _gradient(model, blocks[rows], filled[rows], sizes, label[docs])
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in gradient.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                mean = first[name] / (1 - 0.9**step)
                spread = second[name] / (1 - 0.99**step)
                model[name] -= (rate * mean / (np.sqrt(spread) + 1e-6)).astype(np.float32)
    return model


def _activations(model: Model, windows: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """The filters' activations at each position of the text, 0 elsewhere."""
    width = windows.shape[1] - WIDTH + 1
    raw = model["filters"][0][windows[:, :width]] + model["bias"]
    for j in range(1, WIDTH):
        raw += model["filters"][j][windows[:, j : j + width]]
    np.maximum(raw, 0, out=raw)
    raw *= (np.arange(width)[None, :] < filled[:, None])[:, :, None]
    return raw


def _gradient(
    model: Model, blocks: np.ndarray, filled: np.ndarray, sizes: np.ndarray, label: np.ndarray
) -> Model:
    """``sizes`` are the numbers of blocks of each document."""
    sums = np.empty((len(blocks), FILTERS), np.float32)
    for k in range(0, len(blocks), BLOCKS_AT_ONCE):
        part = slice(k, k + BLOCKS_AT_ONCE)
        sums[part] = _activations(model, blocks[part], filled[part]).sum(axis=1)
    chunks = np.maximum(sizes - 1, 1)
    starts = np.cumsum(chunks) - chunks
    left = np.arange(int(chunks.sum())) + np.repeat(np.cumsum(sizes) - sizes - starts, chunks)
    paired = np.repeat(sizes > 1, chunks)
    right = np.where(paired, left + 1, left)
    length = filled[left] + np.where(paired, filled[right], 0)
    count = np.maximum(length, 1).astype(np.float32)[:, None]
    chunk = np.concatenate([(sums[left] + sums[right] * paired[:, None]) / count, count / CHUNK], axis=1)
    hidden = np.maximum(chunk @ model["dense"] + model["dense_bias"], 0)
    pooled = np.maximum.reduceat(hidden, starts, axis=0)
    score = _sigmoid(pooled @ model["out"] + model["out_bias"])
    d_score = (score - label).astype(np.float32) / len(label)
    d_pooled = d_score[:, None] * model["out"] * (pooled > 0)
    # The gradient goes to the chunk that holds a unit's maximum, the first of equal ones.
    is_top = hidden == np.repeat(pooled, chunks, axis=0)
    places = np.where(is_top, np.arange(len(hidden))[:, None], len(hidden))
    top, spot = np.unique(np.minimum.reduceat(places, starts, axis=0), return_inverse=True)
    d_hidden = np.zeros((len(top), UNITS), np.float32)
    np.add.at(d_hidden, (spot.reshape(pooled.shape), np.arange(UNITS)[None, :]), d_pooled)
    d_chunk = d_hidden @ model["dense"][:FILTERS].T / count[top]
    after = blocks[right[top]] * paired[top][:, None]
    windows = np.concatenate([blocks[left[top]][:, :STRIDE], after], axis=1)
    on = _activations(model, windows, length[top]) > 0
    d_raw = (d_chunk[:, None, :] * on).reshape(-1, FILTERS)
    d_filters = np.zeros_like(model["filters"])
    for j in range(WIDTH):
        at = windows[:, j : j + CHUNK].reshape(-1)
        order = np.argsort(at, kind="stable")
        values, begins = np.unique(at[order], return_index=True)
        d_filters[j][values] = np.add.reduceat(d_raw[order], begins, axis=0)
    return {
        "filters": d_filters,
        "bias": d_raw.sum(axis=0),
        "dense": chunk[top].T @ d_hidden,
        "dense_bias": d_hidden.sum(axis=0),
        "out": pooled.T @ d_score,
        "out_bias": d_score.sum(keepdims=True),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Scorer:
    """A trained model with its filters as two tables over pairs of bytes."""

    def __init__(self, model: Model):
        t = model["filters"]
        self.model = model
        self.low = (t[0][None, :, :] + t[1][:, None, :] + model["bias"]).reshape(-1, FILTERS)
        self.high = (t[2][None, :, :] + t[3][:, None, :]).reshape(-1, FILTERS)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """One probability per text; a null text is empty.

        Texts are taken in segments of bounded size, cut between chunks, and a text's largest
        responses are put together from its segments: memory does not grow with the texts.
        """
        binary = pc.fill_null(texts.cast(pa.large_binary()), b"")
        at = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
        data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
        chunks = np.maximum(1, -(-np.diff(at) // STRIDE) - 1)
        pieces = -(-chunks // SEGMENT_CHUNKS)
        text = np.repeat(np.arange(len(chunks)), pieces)
        piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = at[text] + piece * SEGMENT_CHUNKS * STRIDE
        own = np.minimum(chunks[text] - piece * SEGMENT_CHUNKS, SEGMENT_CHUNKS)
        pooled = np.zeros((len(chunks), UNITS), np.float32)
        cuts = np.flatnonzero(np.diff(np.cumsum(own) // SEGMENT_CHUNKS)) + 1
        bounds = [0, *cuts.tolist(), len(own)]
        for first, last in zip(bounds, bounds[1:]):
            if last > first:
                part = slice(first, last)
                most = self._pooled(data, begin[part], at[text[part] + 1], own[part])
                np.maximum.at(pooled, text[part], most)
        logits = (pooled * self.model["out"]).sum(axis=1, dtype=np.float64)
        return _sigmoid(logits + float(self.model["out_bias"][0]))

    def _pooled(
        self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, chunks: np.ndarray
    ) -> np.ndarray:
        """The largest responses of segments: of ``chunks`` chunks from ``begin`` on, in texts that
        stop at ``end``. A chunk is a block of ``STRIDE`` bytes and the next one, if there is one."""
        paired = end - begin > STRIDE
        blocks = chunks + paired
        first = np.cumsum(blocks) - blocks
        inside = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        block_begin = np.repeat(begin, blocks) + inside * STRIDE
        block_end = np.repeat(end, blocks)
        sums = self._block_sums(data, block_begin, block_end)
        filled = np.clip(block_end - block_begin, 0, STRIDE).astype(np.float32)
        start = np.cumsum(chunks) - chunks
        left = np.repeat(first, chunks) + (np.arange(int(chunks.sum())) - np.repeat(start, chunks))
        has_next = np.repeat(paired, chunks)
        right = np.where(has_next, left + 1, left)
        count = np.maximum(filled[left] + np.where(has_next, filled[right], 0), 1)[:, None]
        chunk = np.concatenate([(sums[left] + sums[right] * has_next[:, None]) / count, count / CHUNK], axis=1)
        hidden = np.maximum(chunk @ self.model["dense"] + self.model["dense_bias"], 0)
        return np.maximum.reduceat(hidden, start, axis=0)

    def _block_sums(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The filters' activations, summed over the text of each block."""
        sums = np.empty((len(begin), FILTERS), np.float32)
        for k in range(0, len(begin), BLOCKS_AT_ONCE):
            part = slice(k, k + BLOCKS_AT_ONCE)
            sums[part] = self._convolved(data, begin[part], end[part])
        return sums

    def _convolved(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        spots = begin[:, None] + np.arange(STRIDE + WIDTH - 1)
        inside = spots < end[:, None]
        if len(data):
            window = data[np.minimum(spots, len(data) - 1)] * inside
        else:
            window = np.zeros(spots.shape, np.uint8)
        pairs = window[:, :-1].astype(np.uint16) | (window[:, 1:].astype(np.uint16) << 8)
        raw = self.low[pairs[:, :STRIDE]]
        raw += self.high[pairs[:, 2 : STRIDE + 2]]
        np.maximum(raw, 0, out=raw)
        raw *= inside[:, :STRIDE, None]
        return raw.sum(axis=1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> Model | float:
    """Train on the labelled documents that are not held out.

    At most ``sample_documents`` of each label are taken, the first by a hash of their ids; the sampled
    ids are few enough to be broadcast. Of texts that share an id one counts, the same one each time.
    Where the texts have more than ``SAMPLE_BYTES`` of a label, fewer documents are taken, but each as a
    whole; a single text above that bound teaches nothing. Both bounds are kept before anything comes to
    the driver. Documents with contradicting labels are left out. With one
    label only, or none, there is nothing to tell apart: the result is the constant score 1.0, or 0.0
    where every label is 0.
    """
    known = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(label_column).cast("int").alias("label"),
        )
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    )
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return 0.0 if 0 in counts else 1.0
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    agreed = (
        known.groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter(F.col("label") == F.col("other"))
        .select(F.col("doc_id").alias("of"), "label", draw.alias("draw"))
    )
    of_label = [agreed.filter(F.col("label") == v).orderBy("draw", "of").limit(sample_documents) for v in (0, 1)]
    sample = keep(of_label[0].unionByName(of_label[1]), "sampled")
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("data"),
    ).join(F.broadcast(sample), F.col("doc_id") == F.col("of"))
    drawn = keep(texts.groupBy("doc_id", "label", "draw").agg(F.min("data").alias("data")), "sample")
    # Running sums over as many rows as the sample has ids.
    until = Window.partitionBy("label").orderBy("draw", "of").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        drawn.select(F.col("doc_id").alias("of"), "label", "draw", F.octet_length("data").alias("bytes"))
        .filter(F.col("bytes") <= SAMPLE_BYTES)
        .withColumn("so_far", F.sum("bytes").over(until))
        .filter(F.col("so_far") <= SAMPLE_BYTES)
        .select("of")
    )
    whole = drawn.join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    found = whole.select("doc_id", "label", "data").toArrow()
    rows = sorted(zip(*(found.column(c).to_pylist() for c in found.column_names)))
    label = np.array([r[1] for r in rows], np.float32)
    if len(set(label.tolist())) < 2:
        return float(label[0]) if len(label) else 1.0
    blocks, filled = zip(*(training_blocks(r[2]) for r in rows))
    owner = np.repeat(np.arange(len(rows)), [len(b) for b in blocks])
    return train(np.concatenate(blocks), np.concatenate(filled), owner, label)


def score(
    docs: DataFrame, model: Model | float, text_column: str = "text", name: str = "score"
) -> DataFrame:
    """Add the probability (double) that a document's text is good. Empty and null texts are scored
    like any other; columns of the same name are replaced."""
    plain = docs.drop(name)
    if isinstance(model, float):
        return plain.withColumn(name, F.lit(model))

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(_scorer(model).scores(texts), pa.float64())

    return plain.withColumn(name, probability(F.col(text_column)))


_scorers: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One scorer per model and Python worker."""
    key = zlib.crc32(b"".join(model[k].tobytes() for k in sorted(model)))
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``. An empty table gives an empty
    result; a null id is not held out."""
    model = fit(docs, labels, id_column, text_column, label_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    scored = score(rows, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
