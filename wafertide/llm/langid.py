"""Language identification with a byte-level convolutional network.

Network: bytes are embedded, convolved by filters of several widths, max-pooled over a fixed-length window and
classified by a softmax layer.  It is trained in numpy on a bounded sample of labelled rows and applied to every
window of every text; a document's distribution is the length-weighted mean over its windows.

At prediction a filter of width w is a sum of w table rows (one per byte), and neighbouring bytes share one table
over byte pairs, so a batch of windows needs only gathers, additions and a maximum.

Defined results: a null text or one without a letter gets ``und`` and score 0.  Repeated rows are predicted alike.
Without any usable labelled row every text gets ``und`` and score 0.  Equal probabilities fall to the language that
sorts first.  Very long texts are read whole, window by window.  Other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, utf8

UNKNOWN = "und"
RESULT = "lang_pred string, score double"


@dataclass(frozen=True)
class Settings:
    """Every label is learned.  About ``per_lang`` rows are sampled for each, fewer where the labels are so many that the
    sample would pass ``most_rows``; a row gives up to ``excerpts`` excerpts of one window.  These bound what training
    gathers on the driver.  A column of more than ``most_langs`` labels is refused as no column of languages."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    per_lang: int = 700
    most_rows: int = 44_800
    most_langs: int = 5_000
    excerpts: int = 3
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    embed: np.ndarray
    kernels: tuple[np.ndarray, ...]  # (width, embedding, filters)
    biases: tuple[np.ndarray, ...]
    weight: np.ndarray
    bias: np.ndarray
    window: int


def held_out(doc_id: Column) -> Column:
    """One fifth of the documents by CRC-32 of the id's text, which training never sees; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame, cfg: Settings) -> list[tuple[str, str]]:
    """Labelled excerpts of all languages, chosen by a hash of the id."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = labelled.groupBy("lang").count().orderBy("lang").limit(cfg.most_langs + 1).collect()
    if not counts:
        return []
    if len(counts) > cfg.most_langs:
        raise ValueError(f"more than {cfg.most_langs} labels")
    per_lang = max(8, min(cfg.per_lang, cfg.most_rows // len(counts)))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.2 * per_lang / r["count"]))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)
    picked = labelled.where((draw < F.try_element_at(share, F.col("lang"))) & has_letter(F.col("text")))
    room = F.greatest(F.length("text") - F.lit(cfg.window), F.lit(1))
    cuts = [
        F.substring(
            F.col("text"),
            F.lit(1) + F.pmod(F.xxhash64("doc_id", F.lit(i)), room.cast("bigint")).cast("int") if i else F.lit(1),
            F.lit(cfg.window),
        )
        for i in range(cfg.excerpts)
    ]
    rows = picked.select("lang", F.array(*cuts).alias("cuts"), draw.alias("draw"))
    rows = rows.orderBy("draw", "lang", "cuts").limit(int(1.5 * per_lang) * len(counts))
    return sorted({(r["lang"], c) for r in rows.collect() for c in r["cuts"]})


def windows(flat: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut each row's bytes into windows: zero-padded windows, the row of each, and its number of real bytes."""
    lengths = np.diff(offsets)
    per = -(-lengths // width)
    row = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[:-1][row] + nth * width
    real = np.minimum(width, offsets[1:][row] - start)
    padded = np.concatenate([flat, np.zeros(width, np.uint8)])
    out = padded[start[:, None] + np.arange(width)]
    out[np.arange(width) >= real[:, None]] = 0
    return out, row, real


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray, cfg: Settings) -> list[np.ndarray]:
    """Of the mean of the windows' cross entropies, each times its label's weight, by parameter."""
    n, f, b = len(cfg.widths), cfg.filters, np.arange(len(y))[:, None]
    grads = [np.zeros_like(p) for p in params]
    seen, pooled, tops = params[0][x], [], []  # (batch, window, embedding)
    for j, w in enumerate(cfg.widths):
        span = cfg.window - w + 1
        conv = sum(seen[:, i : i + span] @ params[1 + j][i] for i in range(w))
        top = conv.argmax(axis=1)
        pooled.append(np.take_along_axis(conv, top[:, None], axis=1)[:, 0] + params[1 + n + j])
        tops.append(top)
    h = np.tanh(np.concatenate(pooled, axis=1))
    p = softmax(h @ params[-2] + params[-1])
    p[np.arange(len(y)), y] -= 1
    p *= weight[y][:, None] / len(y)
    grads[-2], grads[-1] = h.T @ p, p.sum(axis=0)
    dz = (p @ params[-2].T) * (1 - h * h)
    for j, w in enumerate(cfg.widths):
        g = dz[:, j * f : (j + 1) * f]
        grads[1 + n + j] = g.sum(axis=0)
        for i in range(w):
            chars = x[b, tops[j] + i]
            vec = params[0][chars]  # (batch, filters, embedding)
            grads[1 + j][i] = np.einsum("bfd,bf->df", vec, g)
            np.add.at(grads[0], chars, g[:, :, None] * params[1 + j][i].T[None])
    return grads


def fit(pairs: list[tuple[str, str]], cfg: Settings) -> Model | None:
    """Train on (language, excerpt) pairs with Adam; the same pairs give the same model."""
    if not pairs:
        return None
    langs = tuple(sorted({lang for lang, _ in pairs}))
    texts = pa.array([text for _, text in pairs])
    x, row, real = windows(*utf8(texts), cfg.window)
    y = np.array([langs.index(lang) for lang, _ in pairs])[row]
    keep = real >= min(32, cfg.window)
    x, y = (x[keep], y[keep]) if keep.any() else (x, y)
    rng = np.random.default_rng(cfg.seed)
    k, d, f = len(langs), cfg.embedding, cfg.filters
    params = [rng.normal(0, 0.5, (256, d))]
    params += [rng.normal(0, 1 / np.sqrt(w * d), (w, d, f)) for w in cfg.widths]
    params += [np.zeros(f) for _ in cfg.widths]
    params += [rng.normal(0, 0.1, (f * len(cfg.widths), k)), np.zeros(k)]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n, step, weight = len(cfg.widths), 0, 1.0 / np.maximum(1, np.bincount(y, minlength=k))
    weight = (weight / weight[y].mean()).astype(np.float32)
    for _ in range(cfg.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), cfg.batch):
            rows = order[at : at + cfg.batch]
            bx, by = x[rows], y[rows]
            grads = gradients(params, bx, by, weight, cfg)
            step += 1
            rate = cfg.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return Model(langs, params[0], tuple(params[1 : 1 + n]), tuple(params[1 + n : 1 + 2 * n]), params[-2], params[-1], cfg.window)


class Scorer:
    """The model as tables over bytes and byte pairs."""

    def __init__(self, model: Model, chunk: int = 96):
        self.model, self.chunk = model, chunk
        self.parts = []  # per width: [(offset, table, by pair)]
        for kernel in model.kernels:
            single = [model.embed @ kernel[i] for i in range(len(kernel))]
            steps = []
            for i in range(0, len(kernel) - 1, 2):
                pair = (single[i][:, None] + single[i + 1][None]).reshape(65536, -1)
                steps.append((i, np.ascontiguousarray(pair, np.float32), True))
            if len(kernel) % 2:
                steps.append((len(kernel) - 1, np.ascontiguousarray(single[-1], np.float32), False))
            self.parts.append((len(kernel), steps))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of zero-padded windows."""
        out = np.empty((len(x), len(self.model.langs)))
        for at in range(0, len(x), self.chunk):
            one = x[at : at + self.chunk].astype(np.intp)
            two = one[:, :-1] * 256 + one[:, 1:]
            pooled = []
            for (w, steps), bias in zip(self.parts, self.model.biases, strict=True):
                span, conv = self.model.window - w + 1, None
                for i, table, pair in steps:
                    got = table[(two if pair else one)[:, i : i + span]]
                    conv = got if conv is None else np.add(conv, got, out=conv)
                pooled.append(conv.max(axis=1) + bias)
            out[at : at + self.chunk] = softmax(np.tanh(np.concatenate(pooled, axis=1)) @ self.model.weight + self.model.bias)
        return out

    def texts(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of whole texts; rows without bytes get zeros.  Windows are made a slab at a time."""
        total = np.zeros((len(offsets) - 1, len(self.model.langs)))
        size, row = self.model.window * 4096, 0
        while row < len(offsets) - 1:
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
            x, owner, real = windows(flat[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], self.model.window)
            for at in range(0, len(x), 4096):
                p = self.windows(x[at : at + 4096]) * real[at : at + 4096, None]
                np.add.at(total, row + owner[at : at + 4096], p)
            row = last
        return total / np.maximum(1, np.diff(offsets))[:, None]


def predict(docs: DataFrame, model: Model | None, keep: tuple[str | Column, ...] = ("doc_id",), out: str = "lang") -> DataFrame:
    """``keep`` columns of ``docs`` and a struct ``out`` with ``lang_pred`` and ``score`` for every row."""
    if model is None:
        return docs.select(*keep, F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")).alias(out))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def classify(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        names = pa.array([UNKNOWN, *scorer.model.langs])
        for texts, letters in batches:
            p = scorer.texts(*utf8(texts))
            known = np.asarray(letters.fill_null(False).to_numpy(zero_copy_only=False), bool)
            best = np.where(known, p.argmax(axis=1) + 1, 0)
            score = np.where(known, np.clip(p.max(axis=1), 0.0, 1.0), 0.0)
            yield pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(score)], ["lang_pred", "score"])

    return docs.select(*keep, classify(F.col("text"), has_letter(F.col("text"))).alias(out))


def identify(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    model = fit(sample(docs, cfg), cfg)
    got = predict(docs, model, ("doc_id", held_out(F.col("doc_id")).alias("held_out")), "r")
    return got.select("doc_id", "held_out", "r.lang_pred", "r.score")


def keep_identified(docs: DataFrame, lift: float = 1.2, cfg: Settings = Settings()) -> DataFrame:
    """The documents, all columns, whose language is known: not ``und``, and with a score of at least ``lift`` times that
    of a blind guess, which falls with the number of languages."""
    model = fit(sample(docs, cfg), cfg)
    least = min(1.0, lift / len(model.langs)) if model and len(model.langs) > 1 else 0.0
    (name,) = fresh(docs, "__lang")
    got = predict(docs, model, tuple(F.col(f"`{c}`") for c in docs.columns), name)
    return got.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)).drop(name)
