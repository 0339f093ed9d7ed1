"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled rows: one on windows of ordinary
texts, one on the passages that mark toxic ones (runs of byte n-grams that many toxic and hardly any ordinary
texts have; copies count once, as an n-gram only counts where its surroundings are new). The compressor for
the toxic side holds its dictionary in front of the ordinary one, so a window without such passages
compresses to the same length in both, and every byte of difference tells. A text's score is a logistic
function, calibrated on sampled rows that trained no dictionary, of its windows' largest differences.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import query
from .common import map_rows, ship, table, text_hash

SAMPLE = {1: 1200, 0: 3000}  # labelled rows of each class that are sampled at most
THRESHOLD = 0.7
WINDOW, STEP = 128, 112  # bytes
GRAM = 4
ORDINARY_BYTES, TOXIC_BYTES = 8192, 2048  # dictionary sizes
_OTHER = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def folded(text: str | None) -> bytes:
    """Lower-cased bytes, each run of ASCII other than letters and digits one space."""
    return _OTHER.sub(b" ", b" " + (text or "").encode("utf-8", "surrogatepass").lower() + b" ")


def windows(data: bytes) -> list[bytes]:
    """Overlapping windows over all of the data; at least one."""
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STEP), STEP)]


@dataclass(frozen=True)
class Model:
    ordinary: bytes  # dictionaries
    toxic: bytes
    weights: tuple[float, ...]  # intercept first
    mean: tuple[float, ...]
    scale: tuple[float, ...]


@lru_cache(maxsize=4)
def _compressor(content: bytes):
    import zstandard as z

    params = z.ZstdCompressionParameters(
        window_log=14, hash_log=14, chain_log=14, search_log=5, min_match=4, target_length=16, strategy=z.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    held = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return z.ZstdCompressor(dict_data=held, compression_params=params)


def features(text: str | None, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Of the windows' gains (bytes saved by the toxic dictionary): three largest, sum of the clear ones, count."""
    a, b = _compressor(ordinary).compress, _compressor(toxic + ordinary).compress
    gain = np.fromiter((len(a(w)) - len(b(w)) for w in windows(folded(text))), float)
    top = np.sort(np.concatenate((gain, np.zeros(3))))[:-4:-1]
    return np.concatenate((top, [gain[gain >= 3].sum() / len(gain) ** 0.5, np.log(len(gain))]))


def score(text: str | None, model: Model) -> float:
    if not model.toxic:  # no toxic row to learn from
        return 0.0
    x = (features(text, model.ordinary, model.toxic) - model.mean) / model.scale
    return float(1 / (1 + np.exp(-np.clip(model.weights[0] + x @ np.array(model.weights[1:]), -30, 30))))


def _marks(texts: list[tuple[bytes, int]]) -> set[bytes]:
    """n-grams of at least 2 % of the toxic texts, there 20 times as common as in ordinary ones."""
    found, total = (Counter(), Counter()), [0, 0]
    seen = bytearray(1 << 26)  # a mark for each surroundings met, by hash
    for data, label in texts:
        new = set()
        for i in range(len(data) - GRAM + 1):
            around = zlib.crc32(data[max(0, i - 8) : i + GRAM + 8], label) >> 6
            if not seen[around]:
                seen[around] = 1
                new.add(data[i : i + GRAM])
        found[label].update(new)
        total[label] += 1
    least = max(5, total[1] / 50)
    return {g for g, n in found[1].items() if n >= least and n / total[1] >= 20 * (found[0][g] + 1) / max(1, total[0])}


def _passages(data: bytes, marks: set[bytes]) -> bytes:
    """The runs of bytes that marks cover."""
    runs, end = [], -1
    for i in range(len(data) - GRAM + 1):
        if data[i : i + GRAM] in marks:
            runs.append(data[max(i, end) : i + GRAM])
            end = i + GRAM
    return b"".join(runs)


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(size, samples).as_bytes()
    except z.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        return b"".join(samples)[:size]


def fit(rows: list[tuple[str | None, int]]) -> Model:
    """A model of (text, label) rows; the same rows in the same order give the same model."""
    parts = [(folded(t), y) for t, y in rows]
    learn = [p for k, p in enumerate(parts) if k % 5 < 3]
    marks = _marks(learn)
    toxic = [p for d, y in learn if y and (p := _passages(d, marks))]
    if not toxic:
        return Model(b"", b"", (), (), ())
    plain = list(dict.fromkeys(w for d, y in learn if not y for w in windows(d)))
    plain.sort(key=zlib.crc32)
    ordinary, toxic = _dictionary(ORDINARY_BYTES, plain) if plain else b"", _dictionary(TOXIC_BYTES, toxic)
    held = [r for k, r in enumerate(rows) if k % 5 >= 3] or rows
    x = np.array([features(t, ordinary, toxic) for t, _ in held])
    y = np.array([label for _, label in held], float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack((np.ones(len(x)), (x - mean) / scale))
    w = np.zeros(a.shape[1])
    ridge = 0.1 * np.eye(len(w))
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (p - y) + ridge @ w)
    return Model(ordinary, toxic, tuple(w), tuple(mean), tuple(scale))


def fold_of(id_col: str):
    """crc32 of the id as text modulo 3: rows where it is 1 are held out. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Model:
    """Fit on at most SAMPLE labelled rows of a class, chosen by hash of their ids, none of them held out.

    Null ids and labels are passed over, and an id with both labels counts as toxic. The sampled ids, a
    bounded number, are broadcast to one scan of the texts; one whole text an id comes back, the least of an id that repeats.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & (fold_of(id_col) != 1))
    known = known.groupBy(F.col(id_col).alias("_l_id")).agg(F.max(label).cast("int").alias("y"))
    by = F.xxhash64("_l_id")
    picked = known.where("y = 1").orderBy(by).limit(SAMPLE[1]).unionAll(known.where("y = 0").orderBy(by).limit(SAMPLE[0]))
    texts = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    found = texts.join(F.broadcast(picked), F.col("i") == F.col("_l_id")).groupBy("_l_id").agg(F.min("t").alias("t"), F.max("y").alias("y"))
    rows = sorted((r["h"], r["t"] or "", r["y"]) for r in found.select(by.alias("h"), "t", "y").collect())
    return fit([(t, y) for _, t, y in rows])


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, held_out, score, predicted) for each row: one scan, no shuffle.

    The score sees nothing but the text. Null and empty texts get a score like any other text without
    marks; repeated rows get the same one. With no toxic row to learn from all scores are 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), text_hash(text_col), (fold_of(id_col) == 1))
    out = map_rows(rows, lambda it: ((i, h, out, score(t, model)) for i, t, h, out in it),
                   f"id {kind}, text_hash bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score THRESHOLD or more, in one scan: columns and repeats stay as they were."""
    from pyspark.sql.types import DoubleType

    ship(docs.sparkSession)
    model = train(train_docs, labels, id_col, text_col)

    @F.pandas_udf(DoubleType())
    def scored(texts):
        return texts.map(lambda t: score(t, model))

    scored = scored.asNondeterministic()  # evaluated once, not pushed into the scan's filters
    named = docs.withColumn("_tp_score", scored(F.col(f"`{text_col}`")))
    return named.where(F.col("_tp_score") < THRESHOLD).select(*(F.col(f"`{c}`") for c in docs.columns))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Scores over every whole text of documents, learnt from labels outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity(docs, train(docs, labels)).drop("text_hash")
