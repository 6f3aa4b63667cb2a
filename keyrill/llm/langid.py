"""Language identification with string kernels.

The kernel of two texts is a blended spectrum: the number of character n-grams, of one to
``GRAMS`` characters, present in both, normalized by the geometric mean of the texts' own
numbers. N-grams are lower-cased, white space counts as one space, and they are hashed into
``SPACE`` places per text. A bounded sample of labelled texts trains: some of
each language are Nyström landmarks, whose kernel matrix gives the feature map; kernel ridge
regression, one language against the rest, is solved in that space. Features and weights
multiply to one matrix from places to languages, so texts are scored by products of that
matrix with batches of presence rows.

Training uses at most ``SAMPLE`` texts in all, those with the smallest hash of each language, equal texts once, of the
``MOST_LANGUAGES`` most frequent languages (of equally frequent ones those first by name; the others stay unlearned); the sample reaches the driver as presence bits of
fixed size. Prediction goes over whole texts, in tasks, with a matrix of fixed size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text
if no labelled text has a letter. Labels that are null do not train. Repeated rows each get
their row; null doc_ids are neither held out nor used to train. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRAMS = 4
SPACE = 1 << 15
SAMPLE = 2_048
LANDMARKS = 256
MOST_LANGUAGES = 512
RIDGE = 1e-2
BATCH = 64
UNKNOWN = "und"

_SPACES = re.compile(r"\s+")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, set(text)))


def presence(text: str) -> np.ndarray:
    """Places of the n-grams present in a text, as flags."""
    shown = np.zeros(SPACE, bool)
    chars = np.frombuffer(f" {_SPACES.sub(' ', text.lower()).strip()} ".encode("utf-32-le"), np.uint32)
    one = (chars + np.uint32(1)) * np.uint32(0x9E3779B1)
    h = one
    for n in range(1, GRAMS + 1):
        if n > 1:
            h = h[:-1] * np.uint32(0x85EBCA6B) + one[n - 1 :]
        mixed = h ^ (h >> np.uint32(15))
        shown[(mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(17)] = True
    return shown


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        keep = [i for i, t in enumerate(texts) if has_letter(t)]
        packed = [np.packbits(presence(texts[i])).tobytes() for i in keep]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(packed, pa.binary())], names=["lang", "bits"]
        )


def sample(labelled: DataFrame, most: int = SAMPLE) -> list[tuple[str, bytes]]:
    """Languages and packed presence flags of at most ``most`` labelled texts (lang, text), in a fixed order."""
    hashed = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.xxhash64("text").alias("h"))
    # Of more labels than can be taught, the most frequent ones.
    taught = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not taught:
        return []
    each = max(2, most // len(taught))
    if len(taught) == MOST_LANGUAGES:
        hashed = hashed.filter(F.col("lang").isin([r["lang"] for r in taught]))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = hashed.distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= each).select("lang", "h")
    # At most ``most`` rows of a label and a number, so they may be broadcast.
    texts = (
        labelled.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
        .groupBy("lang", "h").agg(F.first("text").alias("text"))
    )
    rows = texts.select("lang", "text", "h").orderBy("h", "lang").select("lang", "text").mapInArrow(_bits, "lang string, bits binary").collect()
    return [(r["lang"], bytes(r["bits"])) for r in rows]


def _unit(packed: list[bytes]) -> np.ndarray:
    """Presence rows of length one."""
    flags = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1).astype(np.float32)
    return flags / np.sqrt(flags.sum(1, keepdims=True))


def train(rows: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix (places, languages) that scores normalized presence rows."""
    languages = sorted({lang for lang, _ in rows})
    if not rows:
        return languages, np.zeros((SPACE, 0), np.float32)
    of = np.array([languages.index(lang) for lang, _ in rows])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == k)[:each] for k in range(len(languages))])
    packed = [bits for _, bits in rows]
    marks = _unit([packed[i] for i in chosen])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # the Nyström map of kernel rows
    kernels = [_unit(packed[i : i + BATCH]) @ marks.T for i in range(0, len(packed), BATCH)]  # a batch of wide rows at a time
    features = np.concatenate(kernels).astype(np.float64) @ root
    # Each language weighs the same, whatever its number of rows.
    weight = 1 / np.bincount(of, minlength=len(languages))[of]
    target = (of[:, None] == np.arange(len(languages))).astype(np.float64)
    gram = (features * weight[:, None]).T @ features
    solved = np.linalg.solve(
        gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), (features * weight[:, None]).T @ target
    )
    return languages, (marks.T @ (root @ solved)).astype(np.float32)


def _predict(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, matrix = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if languages else []
            for begin in range(0, len(known), BATCH):
                rows = known[begin : begin + BATCH]
                flags = np.array([presence(texts[i]) for i in rows], np.float32)
                product = flags @ matrix / np.sqrt(flags.sum(1, keepdims=True))
                best = product.argmax(1)
                for i, k, s in zip(rows, best, product.max(1), strict=True):
                    found[i], scores[i] = languages[k], min(1.0, max(0.0, float(s)))
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string()), pa.array(scores)], names=[*names, "lang_pred", "score"]
            )

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``, from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep)
    return docs.select(*keep, "text").mapInArrow(_predict(shared, keep), f"{kinds}, lang_pred string, score double")


def language_digest(docs: DataFrame) -> DataFrame:
    """A row per document: whether it was held out, and its predicted language."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = train(sample(docs.filter(fold != 1).select("lang", "text")))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text")
    return predict(slim, model, ["doc_id", "held_out"])
