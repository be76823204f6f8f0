"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, everything but letters becomes one space, and each run of 2, 3 and 4
bytes is hashed to a row of an embedding table. The mean of the rows goes through a linear
layer and a softmax. The table and the layer are trained together by stochastic gradient
descent in numpy, on the driver, from windows of words out of a bounded sample of labelled rows:
``sample_per_language`` rows of each of the ``most_languages`` most frequent labels, but no more than about
``sample_rows`` in all, picked by a hash of key and text, one long and one short window each (``long_window`` and 3 to
``short_window`` words, and ``word_bytes`` bytes a word on average, for some texts have no spaces). Rows that repeat
key and text give one pair of windows. Windows are cut in the executors, so the driver gets at most some
1,200 bytes a sampled row, whatever the texts are.

A fifth of the sampled rows is held back to calibrate. It sets the temperature of the softmax and
two limits that a prediction is rejected beyond, each so that half of ``error_rate`` of the
calibration windows is: the least probability of the likeliest language, and the most surprise.
Surprise is the mean negative log frequency, among the training windows, of the runs of bytes; its
distance from the mean shrinks with the root of their number, up to ``whole`` runs. So text of
no learned language is rejected although the softmax must give it to one.

Prediction reads whole texts. The layer is folded into the table beforehand, with the surprise as
one more column, so a run of bytes costs one look-up of a few numbers.

Defined results: a text that is null or has no letter is ``und`` with score 0 and rejected. With
no labelled rows at all, every text is. A null key is not held out, and its row is predicted like
any other but not learned from. Ties, repeated rows and extra columns don't matter: rows are
independent, and only key and text are read for a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import on_workers

UNKNOWN = "und"
_PLAIN_LETTER = re.compile("[A-Za-z]")
#: Bytes of lower-cased text that are kept: a-z and all of multi-byte characters.
_KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 16
    sample_per_language: int = 1500
    long_window: int = 40
    short_window: int = 8
    word_bytes: int = 24
    sample_rows: int = 100_000
    epochs: int = 6
    batch: int = 64
    rate: float = 20.0
    error_rate: float = 0.002
    whole: int = 512
    most_languages: int = 1000
    seed: int = 7


def has_letter(text: str) -> bool:
    return _PLAIN_LETTER.search(text) is not None or any(map(str.isalpha, text))


def features(raw: bytes, buckets: int) -> np.ndarray:
    """Buckets of all runs of 2, 3 and 4 bytes."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    out, key = [], b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        key = key[:-1] << np.uint32(8) | b[n - 1 :]
        mixed = (key ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        out.append((mixed ^ mixed >> np.uint32(15)) % np.uint32(buckets))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def normal_bytes(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().translate(_KEPT).split()) + b" "


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages + 1): embeddings times layer, and the surprise of each bucket
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # of the likeliest language's probability
    usual: float = 0.0  # surprise of the calibration windows
    most: float = float("inf")  # how far above that, times the root of the number of runs
    whole: int = 512

    def measure(self, raw: bytes) -> tuple[np.ndarray, float]:
        """Logits of the languages, and the standing of the surprise: (its mean - usual) * root of the runs."""
        total, n = np.zeros(len(self.languages) + 1), 0
        for at in range(0, len(raw), _CHUNK):
            f = features(raw[at : at + _CHUNK + 3], len(self.table))
            total += self.table[f].sum(axis=0, dtype=np.float64)
            n += len(f)
        mean = total / max(n, 1)
        return mean[:-1] + self.bias, float((mean[-1] - self.usual) * min(n, self.whole) ** 0.5)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        logits, strange = self.measure(normal_bytes(text))
        p = softmax(logits / self.temperature)
        i = int(np.argmax(p))
        return self.languages[i], float(p[i]), bool(p[i] < self.least or strange > self.most)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def cut_window(words: list[bytes], most: int, word_bytes: int, rnd: np.random.Generator) -> bytes:
    """``most`` words side by side; of longer ones than ``word_bytes`` on average a stretch of whole characters."""
    at = int(rnd.integers(0, max(1, len(words) - most + 1)))
    found = b" ".join(words[at : at + most])
    size = most * word_bytes
    if len(found) > size:
        at = int(rnd.integers(0, len(found) - size + 1))
        inside = lambda i: i < len(found) and found[i] & 0xC0 == 0x80
        while inside(at):
            at += 1
        end = at + size
        while inside(end):
            end -= 1
        found = found[at:end].strip()
    return b" " + found + b" "


def sample_windows(docs: DataFrame, key: str, text: str, label: str, s: Settings) -> list[tuple[int, str, bytes]]:
    """(part, language, normalised window) from the rows that may be learned from."""
    on_workers(docs.sparkSession)
    ours = docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("l"))
    ours = ours.where(F.col("k").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col("k")))
    counts = ours.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(s.most_languages)
    scale = 1 << 40
    of_each = F.least(F.lit(float(s.sample_per_language)), F.lit(float(s.sample_rows)) / F.count(F.lit(1)).over(Window.partitionBy()))
    shares = F.broadcast(counts.select(F.col("l").alias("of"), (of_each * scale / F.col("n")).alias("share")))  # a row a language
    place = F.pmod(F.xxhash64("k", "t", F.lit(s.seed)), F.lit(scale))
    chosen = ours.join(shares, F.col("l") == F.col("of")).where(place < F.col("share"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, lang, window = [], [], []
            for k, t, label_ in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not t or not has_letter(t):
                    continue
                words = normal_bytes(t).split()
                rnd = np.random.default_rng([s.seed, *k.encode()])
                for most in (s.long_window, int(rnd.integers(3, s.short_window + 1))):
                    part.append(int(rnd.integers(0, 1 << 30)) if most == s.long_window else part[-1])
                    lang.append(label_)
                    window.append(cut_window(words, most, s.word_bytes, rnd))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(lang, pa.string()), pa.array(window, pa.binary())], ["part", "lang", "window"])

    rows = chosen.select("k", "t", "l").mapInArrow(cut, "part bigint, lang string, window binary").distinct().collect()
    return sorted((r["part"], r["lang"], bytes(r["window"])) for r in rows)


def train(windows: list[tuple[int, str, bytes]], s: Settings = Settings()) -> Model:
    languages = sorted({lang for _, lang, _ in windows})
    if not languages:
        return Model([], np.zeros((s.buckets, 1), np.float32), np.zeros(0))
    label = np.array([languages.index(lang) for _, lang, _ in windows])
    fit = np.array([part % 5 != 0 for part, _, _ in windows]) if len(windows) >= 50 else np.ones(len(windows), bool)
    feats = [features(w, s.buckets) for _, _, w in windows]
    rng = np.random.default_rng(s.seed)
    emb = rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32)
    layer = rng.normal(0, 0.5, (s.dim, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    rows = np.flatnonzero(fit)
    steps, total = 0, s.epochs * -(-len(rows) // s.batch)
    for _ in range(s.epochs):
        order = rng.permutation(rows)
        for at in range(0, len(order), s.batch):
            ids = [i for i in order[at : at + s.batch] if len(feats[i])]
            if not ids:
                continue
            rate = s.rate * (1 - steps / total)
            steps += 1
            n = np.array([len(feats[i]) for i in ids])
            flat = np.concatenate([feats[i] for i in ids])
            mean = np.add.reduceat(emb[flat], np.cumsum(n) - n, axis=0) / n[:, None].astype(np.float32)
            p = softmax(mean @ layer + bias)
            p[np.arange(len(ids)), label[ids]] -= 1
            p = (p / len(ids)).astype(np.float32)
            back = (p @ layer.T) / n[:, None].astype(np.float32)
            grown = np.repeat(back, n, axis=0)
            order_f = np.argsort(flat, kind="stable")
            uniq, first = np.unique(flat[order_f], return_index=True)
            emb[uniq] -= rate * np.add.reduceat(grown[order_f], first, axis=0)
            layer -= 0.05 * rate * (mean.T @ p)
            bias -= 0.05 * rate * p.sum(axis=0)
    seen = np.zeros(s.buckets) + 0.5
    for i in rows:
        np.add.at(seen, feats[i], 1)
    table = np.column_stack([emb @ layer, -np.log(seen / seen.sum())]).astype(np.float32)
    model = Model(languages, table, bias.astype(np.float64), whole=s.whole)
    check = np.flatnonzero(~fit) if (~fit).any() else rows
    n = np.array([min(len(feats[i]), s.whole) for i in check])
    model.usual = float(np.average([table[feats[i], -1].mean() if len(feats[i]) else 0.0 for i in check], weights=n))
    measured = [model.measure(windows[i][2]) for i in check]
    logit, strange = np.stack([m[0] for m in measured]), np.array([m[1] for m in measured])
    truth = label[check]
    at = np.arange(len(check))
    temperatures = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(softmax(logit / t)[at, truth], 1e-12)).mean() for t in temperatures]
    model.temperature = float(temperatures[int(np.argmin(loss))])
    # The calibrated quantiles alone decide, whatever the number of languages.
    model.least = float(np.quantile(softmax(logit / model.temperature).max(axis=1), s.error_rate / 2))
    model.most = float(np.quantile(strange, 1 - s.error_rate / 2))
    return model


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", settings: Settings = Settings()) -> Model:
    return train(sample_windows(docs, key, text, label, settings), settings)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(key, held_out, lang_pred, score, rejected), and the columns of ``carry`` as they are."""
    on_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers, whatever the data
    carry = carry or []
    rows = docs.select(F.col(text).alias("__wk_text"), F.col(key).alias("__wk_key"), held_out(F.col(key)).alias("__wk_out"), *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch.column(0)]
            made = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], [key, "held_out", *carry_names, *names])

    names = ["lang_pred", "score", "rejected"]
    carry_names = [f"__wk_{i}" for i in range(len(carry))]
    kinds = [rows.schema[i + 3].dataType.simpleString() for i in range(len(carry))]
    schema = ", ".join(
        [f"`{key}` {rows.schema[1].dataType.simpleString()}", "held_out boolean", *(f"{n} {k}" for n, k in zip(carry_names, kinds, strict=True)), "lang_pred string, score double, rejected boolean"]
    )
    return rows.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The documents whose language is not rejected; columns as in ``docs``."""
    model = fit(docs, key, text, label, settings)
    out = identify(docs, model, key, text, docs.columns).where(~F.col("rejected"))
    return out.select(*[F.col(f"__wk_{i}").alias(c) for i, c in enumerate(docs.columns)])
