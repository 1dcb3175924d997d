"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word, in lower case between two marks, is the byte 2- to 5-grams of it; each hashes to
an embedding, a text is the average over all subwords of all its words, and a linear
layer with softmax gives the languages. Embeddings and layer are trained by stochastic
gradient descent in numpy on a bounded sample. A temperature fitted on held-back examples
calibrates the probabilities; a prediction more likely wrong than right is rejected.

After training, embeddings times layer are one table of subword scores, so a text costs
one addition per distinct word and batch, and the whole text is always read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import slices

BUCKETS = 1 << 15
GRAMS = (2, 3, 4, 5)
UNKNOWN = "und"
# The classifier is fitted on so many labelled texts at most, shared evenly by the
# languages; of a longer text a window of so many words stands in the sample.
SAMPLE_TEXTS = 4000
SAMPLE_WORDS = 60
REJECT_BELOW = 0.5


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, number of subwords per word)."""
    raw = [f"<{w}>".encode() for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    ahead = np.r_[flat, np.zeros(max(GRAMS), np.uint32)]
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # bytes to the word's end
    counts = np.maximum(sizes[:, None] - np.array(GRAMS) + 1, 0)
    owner = np.repeat(np.arange(len(raw)), sizes)
    found, owners = [], []
    for n in GRAMS:
        code = np.full(len(flat), n, np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) + ahead[k : k + len(flat)]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        fits = left >= n
        found.append(((code >> np.uint32(12)) & np.uint32(BUCKETS - 1))[fits])
        owners.append(owner[fits])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(found)[order].astype(np.int64), counts.sum(1)


@dataclass(frozen=True)
class LanguageModel:
    """``table``: score of each subword bucket for each language; ``bias``;
    ``temperature`` divides the summed scores before the softmax."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        coded = lists.flatten().dictionary_encode()
        buckets, counts = subwords(coded.dictionary.to_pylist())
        starts = np.cumsum(counts) - counts
        index = coded.indices.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        total = np.bincount(owner, counts[index], len(texts)) if len(index) else np.zeros(len(texts))
        logits = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            each = np.add.reduceat(self.table[:, k][buckets], starts) if len(starts) else np.zeros(0)
            logits[:, k] = np.bincount(owner, each[index], len(texts)) / np.maximum(total, 1) + self.bias[k]
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7, size: int = 16, epochs: int = 6, rate: float = 0.5) -> LanguageModel:
    """Model of at least one labelled text; a fifth of them is held back to calibrate."""
    languages = tuple(sorted(set(labels)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    parts = []
    for k in order:
        words = texts[k].lower().split() or [""]
        parts.append(subwords(words)[0])
    target = np.array([languages.index(labels[k]) for k in order])
    held = len(parts) // 5
    rows = np.arange(held, len(parts))
    table = rng.normal(0, 1 / size, (BUCKETS, size))
    layer, bias = np.zeros((size, len(languages))), np.zeros(len(languages))
    total = epochs * max(1, -(-len(rows) // 16))
    step = 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), 16):
            chosen = rows[at : at + 16]
            pace = rate * (1 - step / total)
            step += 1
            ids = np.concatenate([parts[k] for k in chosen])
            sizes = np.array([len(parts[k]) for k in chosen])
            mean = np.add.reduceat(table[ids], np.cumsum(sizes) - sizes) / sizes[:, None]
            wrong = softmax(mean @ layer + bias)
            wrong[np.arange(len(chosen)), target[chosen]] -= 1
            back = wrong @ layer.T
            layer -= pace * mean.T @ wrong
            bias -= pace * wrong.mean(0)
            # the gradient of an average is the same for all its subwords
            at_ids, inverse = np.unique(ids, return_inverse=True)
            share = np.repeat(np.arange(len(chosen)), sizes)
            weight = np.zeros((len(at_ids), len(chosen)))
            np.add.at(weight, (inverse, share), 1.0 / sizes[share])
            table[at_ids] -= pace * 10 * (weight @ back)
    scores = table @ layer
    temperature = 1.0
    if held:
        logits = np.array([scores[parts[k]].mean(0) for k in range(held)]) + bias
        tries = np.geomspace(0.02, 5, 80)
        loss = [-np.log(softmax(logits / t)[np.arange(held), target[:held]] + 1e-12).mean() for t in tries]
        temperature = float(tries[int(np.argmin(loss))])
    return LanguageModel(languages, scores, bias, temperature)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limit: int = SAMPLE_TEXTS) -> LanguageModel | None:
    """Model of rows whose text and language are given; None if there is none.

    The sample takes the rows of smallest hashed id (of the text where the id is missing),
    evenly by language, at most ``limit`` in all, a window of ``SAMPLE_WORDS`` words of each.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    quota = max(1, limit // len(sizes))
    # A frequent language sends about twice its quota of rows to the ranking, the smallest
    # draws, whatever its size: fewer than the quota is out of reach (20 deviations).
    cuts = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(2**63 - 1, int(2**63 * (2 * quota + 64) / n))))]
    drawn = known.withColumn("draw", F.abs(F.xxhash64(F.coalesce("id", "text")))).where(F.col("draw") <= F.create_map(*cuts)[F.col("lang")])
    words = F.split(F.trim(F.col("text")), r"\s+")
    # Windows of 1 to SAMPLE_WORDS words, so that short texts are learned too.
    span = (F.lit(2) ** (F.pmod("draw", F.lit(997)) / 996.0 * np.log2(SAMPLE_WORDS))).cast("int")
    first = F.pmod(F.col("draw"), F.greatest(F.size("words") - span + 1, F.lit(1))).cast("int") + 1
    window = F.array_join(F.slice("words", first, span), " ").alias("text")
    by = Window.partitionBy("lang").orderBy("draw", "tie", "text")
    sample = (
        drawn.select("lang", "draw", F.xxhash64("text").alias("tie"), words.alias("words"))
        .select("lang", "draw", "tie", window)
        .withColumn("place", F.row_number().over(by))
        .where(F.col("place") <= quota)
        .select("text", "lang", "draw")
        .toPandas()
        .sort_values(["draw", "lang", "text"])
    )
    return train(sample["text"].tolist(), sample["lang"].tolist())


def predicted(text: Column, model: LanguageModel | None) -> Column:
    """Struct of ``lang`` (a learned language, ``und`` for a text that is null or has no
    letter, or without a model), ``score`` (calibrated probability, 0 for ``und``) and
    ``rejected`` (score below one half)."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def predict(texts: pa.Array) -> pa.Array:
        parts = []
        for some in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 1000, 1 << 20):
            part = some.column(0)
            letters = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            lang, score = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
            if model is not None and letters.any():
                chance = model.probabilities(part)
                best = chance.argmax(1)
                lang = np.where(letters, np.array(model.languages, object)[best], UNKNOWN)
                score = np.where(letters, chance.max(1), 0.0)
            fields = [pa.array(lang, pa.string()), pa.array(score), pa.array(score < REJECT_BELOW)]
            parts.append(pa.StructArray.from_arrays(fields, fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    def run(texts: pa.Array) -> pa.Array:
        return predict(texts)

    return F.arrow_udf(run, "lang string, score double, rejected boolean")(text)
