"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the bytes of a segment forwards and backwards and
label every byte position with a distribution over languages; a document pools the
log-probabilities of all its positions. Segments are words between white space, so
a text is read whole and equal words are evaluated once per batch of texts; longer
words go in stretches of 32 bytes.

The network is trained in numpy by backpropagation through time on the words of a
bounded sample of labelled documents: the ``SAMPLE_DOCS`` smallest key hashes, and
of their (language, word) counts the ``SAMPLE_WORDS`` largest. Only text and label of
documents outside the held-out fold are used.

Defined results: a null text or one without a letter is ``und`` with score 0, as is
every text if nothing was learned; repeated rows get equal results; null keys are
in the fold of the empty key; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.texts import need

SAMPLE_DOCS = 3000
SAMPLE_WORDS = 40_000
#: Bytes of a segment.
STRETCH = 32
HIDDEN = 20
STEPS = 700
BATCH = 256
#: Remembered words of a Python worker.
REMEMBERED = 200_000
BATCH_CHARS = 2_000_000
UNKNOWN = "und"

_letter = re.compile(r"[^\W\d_]")


def segments(text: bytes) -> list[bytes]:
    """Lower-cased words, long ones in stretches."""
    words = text.lower().split()
    if len(text) > STRETCH and max(map(len, words), default=0) > STRETCH:
        words = [w[i : i + STRETCH] for w in words for i in range(0, len(w), STRETCH)]
    return words


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class ByteTagger:
    """Bidirectional gated recurrent network with a label per byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p[f"{side}_in"] = rng.normal(0, 0.3, (256, 3 * hidden))
            self.p[f"{side}_zr"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
            self.p[f"{side}_c"] = rng.normal(0, hidden**-0.5, (hidden, hidden))
            self.p[f"{side}_out"] = rng.normal(0, hidden**-0.5, (hidden, len(languages)))
        self.p["bias"] = np.zeros(len(languages))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    @staticmethod
    def table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes (position, word) and which of them are there."""
        lengths = np.array([len(w) for w in words])
        there = np.arange(lengths.max())[:, None] < lengths
        data = np.zeros(there.T.shape, np.uint8)
        data[there.T] = np.frombuffer(b"".join(words), np.uint8)
        return np.ascontiguousarray(data.T), there

    def _run(self, side: str, data: np.ndarray, there: np.ndarray, keep: bool):
        """States after each position in reading order; a word's state stays where it has no byte."""
        h_n, (steps, n) = self.hidden, data.shape
        h = np.zeros((n, h_n), np.float32)
        states, trace = np.empty((steps, n, h_n), np.float32), []
        for t in range(steps) if side == "f" else reversed(range(steps)):
            x = self.p[f"{side}_in"][data[t]]
            zr = _sigmoid(x[:, : 2 * h_n] + h @ self.p[f"{side}_zr"])
            z, r = zr[:, :h_n] * there[t][:, None], zr[:, h_n:]
            c = np.tanh(x[:, 2 * h_n :] + (r * h) @ self.p[f"{side}_c"])
            if keep:
                trace.append((t, h, z, r, c))
            h = h + z * (c - h)
            states[t] = h
        return states, trace

    def log_probabilities(self, data: np.ndarray, there: np.ndarray, keep: bool = False):
        """Label distributions (position, word, language), and what training needs."""
        runs = {side: self._run(side, data, there, keep) for side in "fb"}
        logits = sum(runs[s][0] @ self.p[f"{s}_out"] for s in "fb") + self.p["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True)), runs

    def gradients(self, words: list[bytes], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions, and its gradients by backpropagation through time."""
        data, there = self.table(words)
        log_p, runs = self.log_probabilities(data, there, keep=True)
        total, h_n = there.sum(), self.hidden
        n = len(words)
        loss = -(log_p[:, np.arange(n), labels] * there).sum() / total
        d_logits = np.exp(log_p)
        d_logits[:, np.arange(n), labels] -= 1.0
        d_logits *= (there / total)[:, :, None]
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["bias"] = d_logits.sum(axis=(0, 1))
        for side in "fb":
            states, trace = runs[side]
            grads[f"{side}_out"] = np.einsum("tnh,tnl->hl", states, d_logits)
            from_out = d_logits @ self.p[f"{side}_out"].T
            dh = np.zeros((n, h_n), np.float32)
            w_zr, w_c = self.p[f"{side}_zr"], self.p[f"{side}_c"]
            for t, h, z, r, c in reversed(trace):
                dh = dh + from_out[t]
                mask = there[t][:, None]
                d_c = dh * z * (1 - c * c)
                d_z = dh * (c - h) * z * (1 - z) * mask
                d_rh = d_c @ w_c.T
                d_r = d_rh * h * r * (1 - r)
                d_zr = np.concatenate((d_z, d_r), axis=1)
                grads[f"{side}_zr"] += h.T @ d_zr
                grads[f"{side}_c"] += (r * h).T @ d_c
                np.add.at(grads[f"{side}_in"], data[t], np.concatenate((d_zr, d_c), axis=1))
                dh = dh * (1 - z) + d_rh * r + d_zr @ w_zr.T
        return float(loss), grads

    def train(self, words: list[bytes], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        chance = weights / weights.sum()
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            drawn = rng.choice(len(words), BATCH, p=chance)
            _, grads = self.gradients([words[i] for i in drawn], labels[drawn])
            rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                scale = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                self.p[k] -= rate * first[k] / (1 - 0.9**step) / scale

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Log-probabilities summed over the positions of each word (word, language)."""
        out = np.empty((len(words), len(self.languages)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 4096):
            part = order[at : at + 4096]
            data, there = self.table([words[i] for i in part])
            log_p, _ = self.log_probabilities(data, there)
            out[part] = (log_p * there[:, :, None]).sum(axis=0)
        return out


def held_out(key: str, modulus: int = 3, remainder: int = 1) -> Column:
    """Whether crc32 of the key as text leaves the held-out remainder."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % modulus == remainder


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, w) for w in segments(text or b""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()),
             pa.array(list(counts.values()), pa.int64())],
            names=["lang", "word", "n"],
        )


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
    sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, steps: int = STEPS,
) -> ByteTagger | None:
    """A tagger trained on labelled documents outside the held-out fold; None if there are none."""
    need(docs, key, text, label)
    rows = docs.filter(F.col(f"`{label}`").isNotNull() & ~held_out(key)).select(
        F.xxhash64(F.col(f"`{key}`").cast("string")).alias("h"), F.col(f"`{label}`").cast("string").alias("lang"),
        F.col(f"`{text}`").cast("binary").alias("t"),
    )
    cut = rows.select("h").orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if cut is None:
        return None
    counted = rows.filter(F.col("h") <= cut).select("lang", "t").mapInArrow(_word_counts, "lang string, word binary, n long")
    words = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang", "word").limit(sample_words).collect()
    if not words:
        return None
    languages = sorted({w["lang"] for w in words})
    tagger = ByteTagger(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    tagger.train(
        [bytes(w["word"]) for w in words], np.array([place[w["lang"]] for w in words]),
        np.array([w["n"] for w in words], float), steps,
    )
    return tagger




def _label_texts(tagger: ByteTagger, known: dict[bytes, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Mean log-probabilities over all byte positions of each text."""
    cut = [segments(t) for t in texts]
    new = [w for w in set().union(*cut) if w not in known]
    if new:
        known.update(zip(new, tagger.pooled(new)))
    out = np.zeros((len(texts), len(tagger.languages)))
    for i, words in enumerate(cut):
        if words:
            out[i] = np.array([known[w] for w in words], np.float32).sum(axis=0, dtype=np.float64) / sum(map(len, words))
    return out


def _predictor(tagger: ByteTagger):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            texts = batch.column(2).to_pylist()
            named: list[str] = []
            scores: list[float] = []
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and chars < BATCH_CHARS:
                    chars += len(texts[end] or b"")
                    end += 1
                part = [t or b"" for t in texts[at:end]]
                if len(known) > REMEMBERED:
                    known = {}
                mean = _label_texts(tagger, known, part)
                best = mean.argmax(axis=1)
                share = np.exp(mean - mean.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                for t, b, s in zip(part, best, share):
                    letters = bool(_letter.search(t.decode("utf-8", "replace")))
                    named.append(tagger.languages[b] if letters else UNKNOWN)
                    scores.append(float(s[b]) if letters else 0.0)
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(scores, pa.float64())],
                names=["key", "held_out", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, tagger: ByteTagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score) per row; only the text is looked at."""
    need(docs, key, text)
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), held_out(key).alias("held_out"), F.col(f"`{text}`").cast("binary").alias("t")
    )
    if tagger is None:
        found = rows.select("key", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        schema = rows.select("key", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
        found = rows.mapInArrow(_predictor(tagger), schema)
    return found.withColumnRenamed("key", key)
