"""Language identification with a linear-chain conditional random field over words.

Each word of a text (a run of letters) gets a language. A word's emission scores come from its byte 2-, 3- and 4-grams
with marked word ends (so prefixes and suffixes are among them) and from a lexicon of frequent words; transition scores
between neighbouring words' languages are learned with them. Forward-backward gives each word's posterior; a text's
language is the one with the most posterior words, its score their share.

Training: the model is fitted on the driver, by gradient ascent on the likelihood of sequences spliced from a bounded
sample of labelled rows (``SAMPLE_DOCS`` different texts for each language, chosen by text hash, ``TRAIN_WORDS`` words), so that it
also sees changes of language. The bound does not depend on the table. The fitted model is about 1.5 MB.

Prediction runs inside tasks on the bytes of whole texts. Long chains are cut into pieces of 32 words whose transfer
matrices are computed side by side and then chained, which is exact and costs a few NumPy passes for any text length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

SAMPLE_DOCS, TRAIN_WORDS, LEXICON, EPOCHS = 120, 40_000, 10_000, 20
GRAM_BITS, PIECE = 16, 32
#: Text worked on at once; the features of its words take some hundred times that.
SLICE_BYTES = 1 << 18
#: Words between two changes of text in a training sequence, at least and at most.
SPLICE = (4, 60)
UNKNOWN = "und"


@dataclass
class Grams:
    """The gram features of some words: word k has features[first[k]:first[k+1]]."""

    features: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(words: tokens.Words, which: np.ndarray) -> Grams:
        """Buckets of the 2-, 3- and 4-grams of the chosen words, each with a mark at both ends."""
        length = words.end[which] - words.start[which]
        padded = length + 2
        begin = np.cumsum(padded) - padded
        total = int(padded.sum())
        code = np.full(total, 256, np.uint64)
        inner = np.repeat(words.start[which] - begin - 1, padded) + np.arange(total)
        place = np.arange(total) - np.repeat(begin, padded)
        body = (place > 0) & (place <= np.repeat(length, padded))
        code[body] = words.data[inner[body]]
        code[begin] = 257
        left = np.repeat(padded, padded) - place
        parts, owner = [], []
        word = np.repeat(np.arange(len(which)), padded)
        gram = code.copy()
        for n in (2, 3, 4):
            gram = gram[:-1] * np.uint64(259) + code[n - 1 :] if len(gram) else gram
            ok = left[: len(gram)] >= n
            key = gram[ok] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            parts.append((tokens.mixed(key) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
            owner.append(word[: len(gram)][ok])
        owner, features = np.concatenate(owner), np.concatenate(parts)
        order = np.argsort(owner, kind="stable")
        return Grams(features[order], np.searchsorted(owner[order], np.arange(len(which) + 1)))


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray  # bucket, label
    lexicon: np.ndarray  # sorted word hashes
    words: np.ndarray  # lexicon entry, label; the last row is for words outside
    transitions: np.ndarray  # from, to

    def emissions(self, grams: Grams, hashes: np.ndarray) -> np.ndarray:
        """Log scores of words, a row for each."""
        counts = np.diff(grams.first)
        sums = np.zeros((len(hashes), len(self.labels)), np.float32)
        for k in range(len(self.labels)):  # sums over each word's grams
            total = np.zeros(len(grams.features) + 1)
            np.cumsum(self.grams[grams.features, k], out=total[1:])
            sums[:, k] = (total[grams.first[1:]] - total[grams.first[:-1]]) / np.sqrt(np.maximum(counts, 1))
        return sums + self.words[self.entries(hashes)]

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))


def posteriors(emissions: np.ndarray, transitions: np.ndarray, first: np.ndarray, also_forward: bool = False):
    """Each word's label probabilities, by forward-backward over each text's words first[i] to first[i+1].

    With ``also_forward``, the forward probabilities too.
    """
    n, labels = emissions.shape
    if not n:
        return (emissions.astype(np.float64),) * 2 if also_forward else emissions.astype(np.float64)
    counts = np.diff(first)
    pieces = -(-counts // PIECE)
    text = np.repeat(np.arange(len(counts)), pieces)
    head = np.cumsum(pieces) - pieces
    nth = np.arange(len(text)) - head[text]
    at = first[text][:, None] + nth[:, None] * PIECE + np.arange(PIECE)
    on = at < first[text + 1][:, None]
    at = np.where(on, at, 0)
    step = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64)[at]
    change = np.exp(transitions - transitions.max())
    # transfer matrices of the pieces; padding behind a text's end changes nothing
    transfer = np.broadcast_to(np.eye(labels), (len(text), labels, labels))
    for t in range(PIECE):
        after = (transfer.reshape(-1, labels) @ change).reshape(transfer.shape) * step[:, t, None, :]
        after /= after.max(axis=(1, 2), keepdims=True)
        transfer = np.where(on[:, t, None, None], after, transfer)
    incoming, outgoing = np.ones((len(text), labels)), np.ones((len(text), labels))
    order = np.argsort(-pieces, kind="stable")
    sizes = pieces[order]
    for j in range(1, int(sizes[0])):
        here = head[order[: np.searchsorted(-sizes, -j)]] + j
        v = np.einsum("dl,dlm->dm", incoming[here - 1], transfer[here - 1])
        incoming[here] = v / v.sum(axis=1, keepdims=True)
    for j in range(int(sizes[0]) - 1, 0, -1):
        here = head[order[: np.searchsorted(-sizes, -j)]] + j
        v = np.einsum("dlm,dm->dl", transfer[here], outgoing[here])
        outgoing[here - 1] = v / v.sum(axis=1, keepdims=True)
    forward = np.empty((PIECE, len(text), labels))
    v = incoming
    for t in range(PIECE):
        after = (v @ change) * step[:, t]
        after /= after.sum(axis=1, keepdims=True)
        v = np.where(on[:, t, None], after, v)
        forward[t] = v
    alpha = forward.transpose(1, 0, 2)[on] if also_forward else None
    v = outgoing
    for t in range(PIECE - 1, -1, -1):
        forward[t] *= v
        before = (step[:, t] * v) @ change.T
        before /= before.sum(axis=1, keepdims=True)
        v = np.where(on[:, t, None], before, v)
    out = forward.transpose(1, 0, 2)[on]
    out /= out.sum(axis=1, keepdims=True)
    return (out, alpha) if also_forward else out


def fit(texts: list[str], labels: list[str], seed: int = 11) -> Model | None:
    """A model from labelled texts; None if there are no words."""
    names = sorted(set(labels))
    data, offsets = tokens.buffers(pa.array(texts, pa.string()))
    words = tokens.split(data, offsets, tokens.NOT_LETTER, lower=True)
    counts = words.counts
    usable = np.flatnonzero(counts)
    if not len(usable):
        return None
    of = np.array([names.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    by_label = [usable[of[usable] == k] for k in range(len(names))]
    by_label = [x for x in by_label if len(x)]
    picked, truth, total = [], [], 0
    most = min(TRAIN_WORDS, 20 * int(counts.sum()))
    while total < most:  # spans of random texts, each language as often, one after another
        texts_of = by_label[rng.integers(len(by_label))]
        i = texts_of[rng.integers(len(texts_of))]
        n = min(int(rng.integers(*SPLICE)), int(counts[i]))
        a = words.first[i] + rng.integers(counts[i] - n + 1)
        picked.append(np.arange(a, a + n))
        truth.append(np.full(n, of[i]))
        total += n
    stream, truth = np.concatenate(picked), np.concatenate(truth)
    hashes = words.hashes()
    frequent, seen = np.unique(hashes, return_counts=True)
    known = np.sort(frequent[np.lexsort((frequent, -seen))][: min(LEXICON, int((seen > 2).sum()))])
    distinct, where, back = np.unique(hashes[stream], return_index=True, return_inverse=True)
    grams = Grams.of(words, stream[where])
    size = len(names)
    model = Model(names, np.zeros((1 << GRAM_BITS, size), np.float32), known, np.zeros((len(known) + 1, size), np.float32), np.zeros((size, size)))
    entry = model.entries(distinct)
    per_gram = np.repeat(np.arange(len(distinct)), np.diff(grams.first))
    scale = 1 / np.sqrt(np.maximum(np.diff(grams.first), 1))
    length = 256
    first = np.append(np.arange(0, len(stream), length), len(stream))
    inner = np.ones(len(stream), bool)
    inner[first[:-1]] = False
    inner = np.flatnonzero(inner)
    memory = [np.full(x.shape, 1e-4) for x in (model.grams, model.words, model.transitions)]
    for _ in range(EPOCHS):
        emissions = model.emissions(grams, distinct)[back]
        p, alpha = posteriors(emissions, model.transitions, first, also_forward=True)
        wrong = -p
        wrong[np.arange(len(stream)), truth] += 1
        by_word = np.stack([np.bincount(back, wrong[:, k], len(distinct)) for k in range(size)], axis=1)
        by_gram = (by_word * scale[:, None])[per_gram]
        steps = (
            np.stack([np.bincount(grams.features, by_gram[:, k], 1 << GRAM_BITS) for k in range(size)], axis=1),
            np.stack([np.bincount(entry, by_word[:, k], len(known) + 1) for k in range(size)], axis=1),
            _pairs(truth, inner, size) - _expected_pairs(emissions, model.transitions, p, alpha, inner),
        )
        for weights, g, m, rate in zip((model.grams, model.words, model.transitions), steps, memory, (0.3, 0.3, 0.5)):
            g = g / len(stream) * 100 - 1e-3 * weights
            m += g * g
            weights += (rate * g / np.sqrt(m)).astype(weights.dtype)
    return model


def _pairs(truth: np.ndarray, inner: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(truth[inner - 1] * size + truth[inner], minlength=size * size).reshape(size, size).astype(float)


def _expected_pairs(emissions: np.ndarray, transitions: np.ndarray, p: np.ndarray, alpha: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected label pairs of neighbouring words: forward, transition, emission and backward probabilities."""
    onward = np.exp(emissions[inner] - emissions[inner].max(axis=1, keepdims=True)) * p[inner] / np.maximum(alpha[inner], 1e-300)
    joint = alpha[inner - 1][:, :, None] * np.exp(transitions)[None] * onward[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return joint.sum(axis=0)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for batch in batches:
            column = tokens.column_of(batch, "_text")
            for i, j, words in tokens.sliced(column, tokens.NOT_LETTER, lower=True, most=SLICE_BYTES):
                n = j - i
                label, score = np.full(n, -1), np.zeros(n)
                counts = words.counts
                if m is not None and counts.any():
                    hashes = words.hashes()
                    distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
                    p = posteriors(m.emissions(Grams.of(words, where), distinct)[back], m.transitions, words.first)
                    sums = np.zeros((len(p) + 1, len(m.labels)))
                    np.cumsum(p, axis=0, out=sums[1:])
                    share = (sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(counts, 1)[:, None]
                    some = counts > 0
                    label[some] = share[some].argmax(axis=1)
                    score[some] = np.clip(share[some].max(axis=1), 0, 1)
                    for k in np.flatnonzero(some):
                        data = words.data[words.start[words.first[k]] : words.end[words.first[k + 1] - 1]]
                        if not ((data >= 97) & (data <= 122)).any() and not any(c.isalpha() for c in bytes(data).decode()):
                            label[k], score[k] = -1, 0
                part = batch.slice(i, n)
                names = [c for c in part.schema.names if c != "_text"]
                found = [m.labels[x] if x >= 0 else UNKNOWN for x in label]
                yield pa.RecordBatch.from_arrays([*(tokens.column_of(part, c) for c in names), pa.array(found, pa.string()), pa.array(score)], names=[*names, "_lang", "_score"])

    return run


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Model | None:
    """A model from the rows where ``learn`` holds and text and label are given; None if there are none.

    Each language gives its ``SAMPLE_DOCS`` different texts of the smallest hashes, or all of them if it has fewer,
    however often they are repeated.
    """
    rows = docs.where(F.coalesce(learn, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    key = F.shiftrightunsigned(F.xxhash64(F.lit(5), text), 1)
    keyed = rows.select(F.col(lang).alias("lang"), key.alias("h"), F.col(text).alias("t"))
    # different texts by the bits of their hash: the fewest bits that hold SAMPLE_DOCS of a language hold under twice as many, about
    bits = keyed.select("lang", "h").distinct().groupBy("lang", F.length(F.bin("h")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    least, held = {}, Counter()
    for r in sorted(bits.collect(), key=lambda r: r["bits"]):
        if held[r["lang"]] < SAMPLE_DOCS:
            least[r["lang"]] = r["bits"]
            held[r["lang"]] += r["n"]
    if not least:
        return None
    most = F.lit(-1)
    for name, n in least.items():
        most = F.when(F.col("lang") == name, F.lit((1 << n) - 1)).otherwise(most)
    sample = keyed.where(F.col("h") <= most).groupBy("lang", "h").agg(F.min("t").alias("t"))
    nth = Counter()
    chosen = []
    for name, h, t in sorted((r["lang"], r["h"], r["t"]) for r in sample.collect()):
        nth[name] += 1
        if nth[name] <= SAMPLE_DOCS:
            chosen.append((name, h, t))
    return fit([t for _, _, t in chosen], [x for x, _, _ in chosen])


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with _lang (a learned label, or 'und' if the text is null or has no letter) and _score (0 to 1).

    The text is the only input. Without a model, all texts are 'und'. Ties go to the first label by code point. Repeated
    rows get equal results. Other columns pass through; _lang, _score and _text are this function's own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, bounded by the model's fixed sizes
    docs = docs.drop("_lang", "_score", "_text")
    return docs.withColumn("_text", F.col(text)).mapInArrow(_predict(shared), f"{_ddl(docs)}_lang string, _score double")


def _ddl(docs: DataFrame) -> str:
    return "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in docs.schema.fields)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs, ~held_out() & F.col("doc_id").isNotNull())
    found = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))
