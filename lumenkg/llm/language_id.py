"""Language identification by a small byte convolutional network.

Bytes fall into ``CLASSES`` symbols; filters of several widths slide over
fixed-length windows, each filter keeps its largest response (max pooling) and
a softmax layer turns the pooled responses into language probabilities. A
text's probabilities are the mean over all windows of the whole text. The
network is trained in numpy on a bounded sample of labelled text.

Since the input is one symbol per place, a filter of width w is w lookups added
up; at prediction pairs of places are looked up at once.

Defined results: null text and text without a letter get ``und`` with score 0,
as does everything when there is nothing to learn from; repeated rows get equal
predictions; an empty table gives an empty result; other columns pass through
(added columns start with ``__li_``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenkg.llm.text import utf8_buffer
from lumenkg.llm.tokenization import release_encoders
from lumenkg.llm.workspace import bound_batches

P = "__li_"
UND = "und"
CLASSES = 158
WIDTHS = (2, 3, 4)
#: Groups of tasks that the labelled rows are ranked in before they are ranked by language alone.
RANK_GROUPS = 16


def _symbols() -> np.ndarray:
    """Symbol of each byte: 0 pads; ASCII letters without case; space, digit, other ASCII; every byte beyond ASCII its own."""
    out = np.full(256, 29, dtype=np.int16)
    out[[0x20, *range(0x09, 0x0E)]] = 27
    out[0x30:0x3A] = 28
    for k in range(26):
        out[0x41 + k] = out[0x61 + k] = k + 1
    out[0x80:] = 30 + np.arange(128)
    return out


SYMBOL = _symbols()


@dataclass(frozen=True)
class TrainingBounds:
    """The sample that training may see: texts per language, and windows per text; every language is learned."""

    texts_per_language: int = 400
    windows_per_text: int = 6
    window: int = 256
    filters: int = 8
    epochs: int = 6
    batch: int = 128
    rate: float = 0.01
    seed: int = 17


@dataclass
class ByteConvNet:
    """``tables[w]`` is (w, CLASSES, filters): the response a symbol adds at each place of a filter of width w."""

    languages: list[str]
    window: int
    tables: dict[int, np.ndarray]
    dense: np.ndarray
    bias: np.ndarray
    _pairs: dict[int, list[tuple[int, np.ndarray]]] = field(default_factory=dict, repr=False)

    def _lookups(self, width: int) -> list[tuple[int, np.ndarray]]:
        """(place, table over pairs of symbols) for each two places of a filter; an odd last place pairs with the one before."""
        if width not in self._pairs:
            t, found = self.tables[width], []
            for k in range(0, width - 1, 2):
                found.append((k, (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(CLASSES * CLASSES, -1)))
            if width % 2:
                found.append((width - 2, np.tile(t[width - 1], (CLASSES, 1, 1)).reshape(CLASSES * CLASSES, -1)))
            self._pairs[width] = [(k, np.ascontiguousarray(x, dtype=np.float32)) for k, x in found]
        return self._pairs[width]

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every window of symbols."""
        pairs, out = x[:, :-1].astype(np.int32) * CLASSES + x[:, 1:], []
        for w in self.tables:
            n, total = x.shape[1] - w + 1, None
            for k, table in self._lookups(w):
                part = table[pairs[:, k : k + n]]
                total = part if total is None else np.add(total, part, out=total)
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x) @ self.dense + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], bounds: TrainingBounds) -> ByteConvNet:
    """Adam on cross-entropy; gradients flow through the pooled places only."""
    rng, f, n_out = np.random.default_rng(bounds.seed), bounds.filters, len(languages)
    net = ByteConvNet(
        languages,
        bounds.window,
        {w: rng.normal(0, 0.3 / np.sqrt(w), (w, CLASSES, f)) for w in WIDTHS},
        rng.normal(0, 0.3, (f * len(WIDTHS), n_out)),
        np.zeros(n_out),
    )
    weights = [*net.tables.values(), net.dense, net.bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(bounds.epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), bounds.batch):
            pick = order[at : at + bounds.batch]
            x, y = windows[pick], labels[pick]
            pooled, places = [], []
            for w, t in net.tables.items():
                n = x.shape[1] - w + 1
                a = t[0][x[:, :n]]
                for k in range(1, w):
                    a = a + t[k][x[:, k : k + n]]
                best = a.argmax(axis=1)
                places.append(best)
                pooled.append(np.take_along_axis(a, best[:, None, :], axis=1)[:, 0, :])
            h = np.concatenate(pooled, axis=1)
            r = np.maximum(h, 0)
            z = r @ net.dense + net.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            grads = []
            down = (p @ net.dense.T) * (h > 0)
            for i, (w, t) in enumerate(net.tables.items()):
                g, d = np.zeros_like(t), down[:, i * f : (i + 1) * f]
                for k in range(w):
                    seen = np.take_along_axis(x, places[i] + k, axis=1)
                    np.add.at(g[k], (seen, np.broadcast_to(np.arange(f), seen.shape)), d)
                grads.append(g)
            grads += [r.T @ p, p.sum(axis=0)]
            step += 1
            for j, g in enumerate(grads):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                weights[j] -= bounds.rate * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return net


def cut_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Symbols of the windows that begin at ``starts``; places from ``ends`` on are padding."""
    places = starts[:, None] + np.arange(window)
    x = SYMBOL[data[np.minimum(places, max(len(data) - 1, 0))]] if len(data) else np.zeros(places.shape, np.int16)
    x[places >= ends[:, None]] = 0
    return x


def _sample_rows(window: int, per_text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, key, out = b.column(1).to_pylist(), b.column(2).to_pylist(), []
            data, offsets = utf8_buffer(b.column(0))
            for i, (lo, hi) in enumerate(zip(offsets, offsets[1:])):
                n = -(-int(hi - lo) // window)
                for k in sorted({round(j * (n - 1) / max(per_text - 1, 1)) for j in range(min(per_text, n))}):
                    at = int(lo) + k * window
                    out.append((lang[i], key[i], k, data[at : min(at + window, int(hi))].tobytes()))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["lang", "key", "nth", "bytes"])

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bounds: TrainingBounds = TrainingBounds()) -> ByteConvNet | None:
    """Train on rows of ``labelled`` with a text and a language.

    The ``texts_per_language`` texts of each language with the least hash of
    their id and text reach the driver, as a few windows each. So ids may be
    null or shared: they decide nothing alone. The hash of the last text that is
    taken is found first, on hashes only; then texts up to it are read.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit(bounds.seed)).alias("key")
    )
    # a language is ranked in groups of tasks first, each of which hands on so many rows at most, whatever the number of tasks
    ranked = lambda df, *by: df.withColumn("nth", F.row_number().over(Window.partitionBy("lang", *by).orderBy("key"))).filter(F.col("nth") <= bounds.texts_per_language)
    first = lambda df: ranked(ranked(df.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(RANK_GROUPS))), "part"))
    last = {r["lang"]: r["key"] for r in first(rows.select("lang", "key")).groupBy("lang").agg(F.max("key").alias("key")).collect()}  # a row per output of the network
    if not last:
        return None
    bound = F.create_map(*[x for k, v in last.items() for x in (F.lit(k), F.lit(v))])[F.col("lang")]
    picked = first(rows.filter(F.col("key") <= bound)).select("text", "lang", "key")
    got = picked.mapInArrow(_sample_rows(bounds.window, bounds.windows_per_text), "lang string, key long, nth int, bytes binary").collect()
    languages = sorted({r["lang"] for r in got})
    got = sorted(got, key=lambda r: (r["key"], r["nth"], r["lang"], r["bytes"]))
    if not got:
        return None
    x = np.zeros((len(got), bounds.window), dtype=np.int16)
    for i, r in enumerate(got):
        x[i, : len(r["bytes"])] = SYMBOL[np.frombuffer(r["bytes"], np.uint8)]
    return train(x, np.array([languages.index(r["lang"]) for r in got]), languages, bounds)


def _predicted(net: ByteConvNet, column: pa.Array) -> tuple[list[str], np.ndarray]:
    data, offsets = utf8_buffer(column)
    lengths = np.diff(offsets)
    n_windows = -(-lengths // net.window)
    owner = np.repeat(np.arange(len(lengths)), n_windows)
    first = np.concatenate([[0], np.cumsum(n_windows)])
    starts = offsets[:-1][owner] + (np.arange(len(owner)) - first[:-1][owner]) * net.window
    total = np.zeros((len(lengths), len(net.languages)))
    for at in range(0, len(owner), 64):
        pick = slice(at, at + 64)
        x = cut_windows(data, starts[pick], offsets[1:][owner[pick]], net.window)
        weight = (x > 0).sum(axis=1)[:, None]
        np.add.at(total, owner[pick], net.probabilities(x) * weight)
    total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
    best = total.argmax(axis=1)
    return [net.languages[k] for k in best], total[np.arange(len(best)), best]


def predict(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """Add ``__li_lang`` and ``__li_score`` to every row."""
    bound_batches(docs.sparkSession)
    marked = docs.withColumn(P + "letters", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    if net is None:
        return marked.withColumns({P + "lang": F.lit(UND), P + "score": F.lit(0.0)}).drop(P + "letters")
    at, names = docs.columns.index(text_col), [*docs.columns, P + "lang", P + "score"]
    schema = T.StructType([*docs.schema.fields, T.StructField(P + "lang", T.StringType()), T.StructField(P + "score", T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                lang, score = _predicted(model.value, b.column(at))
                letters = b.column(b.num_columns - 1).to_pylist()
                lang = [k if ok else UND for k, ok in zip(lang, letters)]
                score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names)

    return marked.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, min_score: float = 0.4, bounds: TrainingBounds = TrainingBounds()) -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_score``, with their own columns."""
    net = fit(docs, bounds=bounds)
    found = predict(docs, net).filter((F.col(P + "lang") != UND) & (F.col(P + "score") >= min_score))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
