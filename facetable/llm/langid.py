"""Language identification by a convolutional network over bytes.

Each text is cut into windows of a fixed number of bytes, all of it.  A window goes
through an embedding of bytes, filters of several widths, the maximum of each filter
over the window, and a softmax.  A text's probabilities are the mean over its windows,
weighted by their bytes.  Embedding and filters together are one table per byte value, so
applying a filter is looking up rows and adding them, shifted.

The network is trained in numpy on a bounded sample: ``PER_LANG`` documents of each
language, chosen by a hash of their ids (rows that repeat an id count once), and
``WINDOWS`` windows of each, spread over the text.  Its few thousand weights travel with the function that reads Arrow batches; scoring
shuffles nothing and looks at whole texts.

Edge cases: ``und`` with score 0 if a text is NULL or has no letter, and if nothing
could be learned; one language learned gives that one.  Rows with a NULL language are
not learned from.  Columns of the same name as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_LANG = 300
WINDOWS = 4
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
DIM = 8
EPOCHS = 6
#: Steps at least, for small samples.
LEAST_STEPS = 300
BATCH = 64
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Windows looked at in one step; bounds the memory of a worker to a few MB.
STEP = 256


def windows_of(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes of a text in rows of ``size``; the last row is filled up by zeros."""
    rows = max(1, -(-len(data) // size))
    out = np.zeros(rows * size, dtype=np.uint8)
    out[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(rows, size)


@dataclass
class Network:
    langs: list[str]
    embedding: np.ndarray  # (256, DIM)
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    biases: list[np.ndarray]
    out: np.ndarray  # (filters in all, languages)
    out_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """Per width and place: what each byte value adds to each filter."""
        return [np.einsum("bd,wdf->wbf", self.embedding, f).astype(np.float32) for f in self.filters]

    def probabilities(self, windows: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        tables = tables or self.tables()
        out = []
        for at in range(0, len(windows), STEP):
            part, pooled = windows[at : at + STEP].astype(np.intp), []
            for table, bias in zip(tables, self.biases, strict=True):
                reach = part.shape[1] - len(table) + 1
                total = table[0].take(part[:, :reach], axis=0)
                for k in range(1, len(table)):
                    total += table[k].take(part[:, k : k + reach], axis=0)
                while total.shape[1] > 1:  # the maximum by halves: long inner loops
                    half = (total.shape[1] + 1) // 2
                    total = np.maximum(total[:, :half], total[:, -half:])
                pooled.append(np.maximum(total[:, 0] + bias, 0))
            logits = np.concatenate(pooled, axis=1) @ self.out + self.out_bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            out.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit by Adam on the cross entropy of shuffled batches."""
    rng = np.random.default_rng(seed)
    n_all = FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.5, (256, DIM))]
    params += [rng.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS]
    params += [rng.normal(0, (1 / n_all) ** 0.5, (n_all, len(langs))), np.zeros(len(langs))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    k = len(WIDTHS)

    def gradient(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        emb, fil, bias, out, out_bias = params[0], params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], params[-1]
        pooled, places = [], []
        for w, f, b in zip(WIDTHS, fil, bias, strict=True):
            table = np.einsum("bd,wdf->wbf", emb, f)
            reach = x.shape[1] - w + 1
            total = sum(table[j][x[:, j : j + reach]] for j in range(w))
            at = total.argmax(axis=1)  # (batch, filters)
            pooled.append(np.take_along_axis(total, at[:, None], 1)[:, 0] + b)
            places.append(at)
        hidden = np.concatenate(pooled, axis=1)
        active = np.maximum(hidden, 0)
        logits = active @ out + out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        d_hidden = (p @ out.T) * (hidden > 0)
        d_emb, d_fil, d_bias = np.zeros_like(emb), [], []
        rows = np.arange(len(x))[:, None]
        for i, (w, f) in enumerate(zip(WIDTHS, fil, strict=True)):
            d = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            grads = np.zeros_like(f)
            for j in range(w):  # only the place of the maximum carries a gradient
                byte = x[rows, places[i] + j]
                grads[j] = np.einsum("nfd,nf->df", emb[byte], d)
                np.add.at(d_emb, byte.ravel(), (d[:, :, None] * f[j].T[None]).reshape(-1, DIM))
            d_fil.append(grads)
            d_bias.append(d.sum(0))
        return [d_emb, *d_fil, *d_bias, active.T @ p, p.sum(0)]

    per_epoch = -(-len(windows) // BATCH)
    for _ in range(max(epochs, -(-LEAST_STEPS // per_epoch))):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            step += 1
            for i, g in enumerate(gradient(windows[batch], labels[batch])):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                rate = 0.005 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                params[i] -= rate * first[i] / (second[i] ** 0.5 + 1e-8)
    return Network(langs, params[0], params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], params[-1])


def fit(docs: DataFrame, learn: Column, per_lang: int = PER_LANG) -> Network | None:
    """A network from the rows where ``learn`` holds and the language is known."""
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # The rank is cut in every task before the shuffle, so a hot language is no hot task.
    ids = (
        usable.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_lang)
        .select("doc_id")
        .distinct()
    )
    chosen = docs.sparkSession.createDataFrame(ids.collect(), "doc_id bigint")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                rows = windows_of(text.encode("utf-8", "replace"))
                at = np.unique(np.linspace(0, len(rows) - 1, WINDOWS).astype(int))
                found += [(lang, rows[i].tobytes()) for i in at]
            yield pd.DataFrame(found, columns=["lang", "bytes"])

    texts = usable.select(F.col("doc_id").cast("long"), "lang", "text").join(F.broadcast(chosen), "doc_id")
    # Rows that repeat an id are one document: its first text, by a hash.
    first = F.min_by(F.struct("lang", "text"), F.struct(F.xxhash64("text"), "text", "lang"))
    texts = texts.groupBy("doc_id").agg(first.alias("row")).select("row.*")
    found = texts.mapInPandas(cut, "lang string, bytes binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["lang", "bytes"]).reset_index(drop=True)
    langs = sorted(found["lang"].unique())
    windows = np.stack([np.frombuffer(b, dtype=np.uint8) for b in found["bytes"]])
    labels = found["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy()
    return train(windows, labels, langs)


def identify_batch(texts: list[str | None], network: Network | None, tables: list[np.ndarray] | None = None) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    held, size, owners = [], 0, []

    def settle() -> None:
        if held:
            p = network.probabilities(np.concatenate([w for w, _ in held]), tables)
            at = 0
            for (rows, n), i in zip(held, owners, strict=True):
                weight = np.full(len(rows), float(rows.shape[1]))
                weight[-1] = n - (len(rows) - 1) * rows.shape[1]
                mean = weight @ p[at : at + len(rows)] / weight.sum()
                langs[i], scores[i] = network.langs[int(mean.argmax())], float(min(mean.max(), 1.0))
                at += len(rows)

    for i, text in enumerate(texts):
        if network is None or not text or not LETTER.search(text):
            continue
        data = text.encode("utf-8", "replace")
        held.append((windows_of(data), len(data)))
        owners.append(i)
        size += len(data)
        if size > 2_000_000:
            settle()
            held, size, owners = [], 0, []
    settle()
    return langs, scores


def identify(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType(
        [
            *[docs.schema[c] for c in kept],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = network.tables() if network else None
        for batch in batches:
            langs, scores = identify_batch(batch[text_col].tolist(), network, tables)
            yield batch[kept].assign(lang_pred=langs, score=scores)

    return docs.mapInPandas(over, schema)
