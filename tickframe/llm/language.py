"""Language identification by a convolutional network over bytes.

Filters of three widths slide over a window of byte classes, each keeps its largest response,
and a softmax layer reads them. A one-hot input makes a filter a sum of table entries, so for
prediction the tables of neighbouring bytes are added up once per pair of classes: the response
at a position is two lookups for all filters together. A document's distribution is the mean
over all its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickframe.llm.rows import id_and_text, map_texts
from tickframe.llm.spans import text_batches
from tickframe.llm.workers import tidy

SAMPLE = 4_000  # documents the network is fitted on, at most
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
TAIL = max(WIDTHS) - 1  # bytes a window reads beyond its end
CLASSES = 64
WINDOWS_PER_TEXT = 6
EPOCHS = 8
BATCH = 64
RATE = 0.01
UNKNOWN = "und"


def _byte_classes() -> np.ndarray:
    """Blank, digit, mark, each letter without case, lead bytes, and low bits of what follows."""
    t = np.zeros(256, np.uint8)
    t[[*range(9, 14), 32]] = 1
    t[48:58] = 2
    t[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3
    for k in range(26):
        t[65 + k] = t[97 + k] = 4 + k
    t[0xC0:] = 31
    t[0xC3] = 30
    t[0x80:0xC0] = 32 + (np.arange(64) & 31)
    return t


BYTE_CLASSES = _byte_classes()


def classes_of(text: str) -> np.ndarray:
    return BYTE_CLASSES[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def windows_of(classes: np.ndarray) -> np.ndarray:
    """All windows, one after the other, the last one padded; each with its tail."""
    n = max(1, -(-len(classes) // WINDOW))
    padded = np.zeros(n * WINDOW + TAIL, np.uint8)
    padded[: len(classes)] = classes
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + TAIL)[::WINDOW]


@dataclass
class ByteNet:
    names: list
    filters: list  # per width: (width, CLASSES, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Lookups by the class pair at a position, and by the pair two bytes later."""
        w2, w3, w4 = self.filters
        first = np.concatenate([w[0][:, None, :] + w[1][None, :, :] for w in (w2, w3, w4)], axis=2)
        third = np.broadcast_to(w3[2][:, None, :], (CLASSES, CLASSES, FILTERS))
        second = np.concatenate([third, w4[2][:, None, :] + w4[3][None, :, :]], axis=2)
        flat = lambda a: np.ascontiguousarray(a.reshape(CLASSES * CLASSES, -1), np.float32)
        return flat(first), flat(second)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.dense + self.dense_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit_net(windows: np.ndarray, target: np.ndarray, names: list, seed: int = 1) -> ByteNet:
    """Adam on the cross entropy; only the position of a filter's maximum gets its gradient."""
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = ByteNet(
        names, [rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32), rng.normal(0, 0.2, (total, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    weights = [*net.filters, net.bias, net.dense, net.dense_bias]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, pooled, where = windows[rows], [], []
            for w, table in zip(WIDTHS, net.filters):
                response = sum(table[o][x[:, o : o + WINDOW]] for o in range(w))
                where.append(response.argmax(axis=1))
                pooled.append(np.take_along_axis(response, where[-1][:, None, :], 1)[:, 0])
            hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
            p = net.probabilities(np.concatenate(pooled, axis=1))
            p[np.arange(len(rows)), target[rows]] -= 1
            p /= len(rows)
            back = (p @ net.dense.T) * (hidden > 0)
            grads = []
            for k, (w, table) in enumerate(zip(WIDTHS, net.filters)):
                g = np.zeros_like(table)
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                for o in range(w):
                    seen = np.take_along_axis(x, where[k] + o, 1)
                    np.add.at(g[o], (seen, np.arange(FILTERS)[None, :]), part)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for w, g, a, b in zip(weights, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def fit_language(
    docs: DataFrame, learn: Column | None = None, sample: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> ByteNet:
    """Fit on at most ``sample`` documents, chosen by a hash of the identifier.

    ``learn`` says which documents may be used; rows without language or text are left out. Of
    every chosen text, windows spread evenly over its whole length are used. Without such rows
    the network knows no language and predicts ``und``.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        usable = usable.where(learn)
    chosen = usable.select(F.col(id_col).alias("row_id")).orderBy(F.xxhash64("row_id"), "row_id").limit(sample)
    rows = usable.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = rows.join(F.broadcast(chosen), "row_id", "left_semi").select("row_id", "t", "l")

    def run(batches):
        for b in batches:
            ids, langs, cut = [], [], []
            for i, text, lang in zip(*(b.column(k).to_pylist() for k in range(3))):
                if has_letter(text):
                    w = windows_of(classes_of(text))
                    pick = np.unique(np.linspace(0, len(w) - 1, min(len(w), WINDOWS_PER_TEXT)).astype(int))
                    cut.extend(w[k].tobytes() for k in pick)
                    ids.extend([i] * len(pick))
                    langs.extend([lang] * len(pick))
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(langs, pa.string()), pa.array(cut, pa.binary())], names=["row_id", "l", "w"])

    schema = T.StructType([rows.schema["row_id"], T.StructField("l", T.StringType()), T.StructField("w", T.BinaryType())])
    got = rows.mapInArrow(tidy(run), schema).toPandas().sort_values(["row_id", "l", "w"])
    names = sorted(got["l"].unique())
    if not names:
        return ByteNet([], [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    windows = np.frombuffer(b"".join(got["w"]), np.uint8).reshape(len(got), WINDOW + TAIL)
    target = np.array([names.index(x) for x in got["l"]])
    return fit_net(windows, target, names)


def languages(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``) of every document, from all windows of its text.

    A null text or one without a letter is ``und`` with score 0. Repeated rows give repeated
    results; other columns are not read.
    """

    def start():
        first, second = net.pair_tables() if net.names else (None, None)

        def compute(texts: list):
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for at, part in text_batches(texts if net.names else [], 1 << 15):
                known = [k for k, t in enumerate(part) if has_letter(t)]
                if not known:
                    continue
                coded = [classes_of(part[k]) for k in known]
                counts = [-(-len(c) // WINDOW) for c in coded]
                flat = np.zeros(sum(counts) * WINDOW + 2, np.int32)
                ends = np.cumsum(counts) * WINDOW
                for c, e, n in zip(coded, ends, counts):
                    flat[e - n * WINDOW : e - n * WINDOW + len(c)] = c
                means = document_means(net, first, second, flat, np.array(counts))
                best = means.argmax(axis=1)
                for k, b, p in zip(known, best.tolist(), means.max(axis=1).tolist()):
                    names[at + k], scores[at + k] = net.names[b], p
            return [pa.array(names, pa.string()), np.clip(scores, 0, 1)]

        return compute

    return map_texts(docs, id_col, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], start)


def document_means(net: ByteNet, first, second, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean class probabilities per document; ``flat`` holds its windows one after the other.

    Worked through in slices of some windows, so a very long text needs no more memory than
    its classes.
    """
    pairs = flat[:-1] * CLASSES + flat[1:]
    pairs = np.append(pairs, np.int32(0))
    n, out = int(counts.sum()), []
    for a in range(0, n, 256):
        b = min(n, a + 256)
        here = first[pairs[a * WINDOW : b * WINDOW]]
        here[:, FILTERS:] += second[pairs[a * WINDOW + 2 : b * WINDOW + 2]]
        out.append(net.probabilities(here.reshape(b - a, WINDOW, -1).max(axis=1)))
    begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.add.reduceat(np.concatenate(out), begins, axis=0) / counts[:, None]
