"""A toxicity classifier that is penalised for reacting to who a text mentions.

Logistic regression over hashed features of a text's distinct words: the word and its
first four and five characters. For a labelled text with identity terms a counterfactual
is made by putting another term of the same group in each one's place; besides the
usual loss, training penalises the squared difference of both scores (before the sigmoid).
Terms of a group so end up with like weights, and a neutral mention of a group that the
labelled toxic texts happen to attack does not count against a text.

Fitting takes a bounded sample of labelled rows, at most ``MOST_LABELS`` of each label,
those whose ids hash lowest; all documents are scored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import crc_mod, written

MOST_LABELS = 8_192
MOST_FEATURES = 1 << 16
MIN_Z = 3.0
RIDGE = 1.0
PENALTY = 5.0
STEPS = 300

# Identity terms, in groups whose members can stand for each other.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "locals"),
    ("deaf", "hearing"),
    ("blind", "sighted"),
    ("old", "young"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)


def distinct_words(text: str) -> set[str]:
    """Lower-cased words without the punctuation around them."""
    found = {w.strip(string.punctuation) for w in set(text.lower().split())}
    found.discard("")
    return found


def feature_ids(word: str) -> list[int]:
    """Hashes of the word and, for longer ones, of its beginnings."""
    names = [f"w:{word}"]
    if len(word) > 5:
        names += [f"p:{word[:4]}", f"p:{word[:5]}"]
    return [xxhash.xxh3_64_intdigest(n) - (1 << 63) for n in names]


def swaps(groups: Sequence[Sequence[str]]) -> dict[str, str]:
    return {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}


def _examples(groups: Sequence[Sequence[str]]):
    """Features of a labelled text (with repeats), and of its counterfactual if it has one."""
    other = swaps(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for toxic, text in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist(), strict=True):
                    found = distinct_words(text or "")
                    mine = [f for w in found for f in feature_ids(w)]
                    swapped = None
                    if hit := found & other.keys():
                        gone = [f for w in hit for f in feature_ids(w)]
                        come = [f for w in {other[w] for w in hit} for f in feature_ids(w)]
                        swapped = [np.array(v, np.int64).tobytes() for v in (gone, come)]
                    rows.append((toxic, np.array(mine, np.int64).tobytes(), *(swapped or (None, None))))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["toxic", "features", "gone", "come"],
                )

    return run


def chosen_features(
    ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, always: np.ndarray, most: int, min_z: float
) -> np.ndarray:
    """Sorted ids of features whose log odds differ by label, and of identity terms."""
    unique, of = np.unique(ids, return_inverse=True)
    pair = np.unique(of.astype(np.int64) * len(labels) + rows)  # once per text
    feature, row = pair // len(labels), pair % len(labels)
    a = np.bincount(feature[labels[row] == 1], minlength=len(unique)).astype(float)
    b = np.bincount(feature[labels[row] == 0], minlength=len(unique)).astype(float)
    pos, neg = (labels == 1).sum(), (labels == 0).sum()
    odds = np.log((a + 0.5) / (pos - a + 0.5)) - np.log((b + 0.5) / (neg - b + 0.5))
    z = np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    z[a + b < 3] = 0
    best = np.argsort(-z, kind="stable")[: max(0, most - len(always))]
    return np.unique(np.concatenate([unique[best[z[best] >= min_z]], always]))


def fitted(
    labels: np.ndarray,
    rows: np.ndarray,
    columns: np.ndarray,
    width: int,
    differences: tuple[np.ndarray, np.ndarray, np.ndarray],
    *,
    ridge: float = RIDGE,
    penalty: float = PENALTY,
    steps: int = STEPS,
) -> np.ndarray:
    """Weights and, last, the bias, by gradient steps with momentum per coordinate.

    ``differences`` has the rows, columns and signs by which counterfactuals differ.
    """
    n = len(labels)
    d_row, d_col, d_sign = differences
    pairs = int(d_row.max()) + 1 if len(d_row) else 0
    weights = np.zeros(width + 1)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    share = labels.mean()
    weights[-1] = math.log(share / (1 - share))
    balance = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    for step in range(1, steps + 1):
        score = np.bincount(rows, weights[columns], minlength=n) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - labels) * balance / n
        slope = np.append(np.bincount(columns, error[rows], minlength=width), error.sum())
        slope[:-1] += ridge * weights[:-1] / n
        if pairs:
            gap = np.bincount(d_row, d_sign * weights[d_col], minlength=pairs)
            slope[:-1] += penalty * np.bincount(d_col, d_sign * gap[d_row], minlength=width) / pairs
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


def _fit(groups: Sequence[Sequence[str]], options: dict):
    most, min_z = options.pop("most_features"), options.pop("min_z")
    always = np.array(sorted({xxhash.xxh3_64_intdigest(f"w:{t}") - (1 << 63) for g in groups for t in g}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, features, gone, come = [], [], [], []
        for batch in batches:
            labels += batch.column("toxic").to_pylist()
            for name, into in (("features", features), ("gone", gone), ("come", come)):
                into += batch.column(name).to_pylist()
        order = sorted(range(len(labels)), key=lambda i: (features[i], labels[i]))  # any order of rows gives one model
        y = np.array([labels[i] for i in order], np.int64)
        if not len(y) or y.min() == y.max():
            bias = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([bias]), pa.array([True])], ["id", "weight", "bias"])
            return
        each = [np.frombuffer(features[i], np.int64) for i in order]
        ids, rows = np.concatenate(each), np.repeat(np.arange(len(each)), [len(e) for e in each])
        kept = chosen_features(ids, rows, y, always, most, min_z)

        def known(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(kept, values), len(kept) - 1)
            return at, kept[at] == values

        at, here = known(ids)
        d_row, d_col, d_sign, number = [], [], [], 0
        for i in order:
            if gone[i] is None:
                continue
            for data, sign in ((gone[i], 1.0), (come[i], -1.0)):
                place, there = known(np.frombuffer(data, np.int64))
                d_row += [number] * int(there.sum())
                d_col += place[there].tolist()
                d_sign += [sign] * int(there.sum())
            number += 1
        differences = (np.array(d_row, np.int64), np.array(d_col, np.int64), np.array(d_sign))
        weights = fitted(y, rows[here], at[here], len(kept), differences, **options)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(kept, 0)),
                pa.array(weights),
                pa.array([*[False] * len(kept), True]),
            ],
            ["id", "weight", "bias"],
        )

    return run


def fit(
    labelled: DataFrame,
    *,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
    most_labels: int = MOST_LABELS,
    most_features: int = MOST_FEATURES,
    min_z: float = MIN_Z,
    ridge: float = RIDGE,
    penalty: float = PENALTY,
    steps: int = STEPS,
) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias, from rows of ``text`` and ``toxic`` (0 or 1).

    ``labelled`` must already be a bounded sample. With labels of one kind only, or none,
    there are no weights and the bias says that kind, or 0.
    """
    options = {
        "most_features": most_features, "min_z": min_z, "ridge": ridge, "penalty": penalty, "steps": steps,
    }
    examples = labelled.select(F.col("toxic").cast("int"), F.col("text").cast("string")).mapInArrow(
        _examples(groups), "toxic int, features binary, gone binary, come binary"
    )
    model = examples.repartition(1).mapInArrow(_fit(groups, options), "id long, weight double, bias boolean")
    rows = written(model, "toxicity-model").collect()  # at most most_features and one
    bias = next(r["weight"] for r in rows if r["bias"]) if rows else 0.0
    return {r["id"]: r["weight"] for r in rows if not r["bias"]}, bias


def sampled(labels: DataFrame, *, most_labels: int = MOST_LABELS) -> DataFrame:
    """At most ``most_labels`` ids of each label (``doc_id``, ``toxic``), by their hash.

    A null label or id is skipped; of several labels of an id the highest counts.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
        for label in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def _scorer(weights: dict[int, float], bias: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value: dict[str, float] = {}

        def learn(raw: str) -> float:
            word = raw.strip(string.punctuation)
            return sum(weights.get(f, 0.0) for f in feature_ids(word)) if word else 0.0

        for batch in batches:
            scores = []
            if len(value) > 400_000:
                value.clear()
            for text in batch.column("text").to_pylist():
                raw = set((text or "").lower().split())
                for word in raw.difference(value):
                    value[word] = learn(word)
                total = sum(map(value.__getitem__, raw))
                if total:  # words that differ in punctuation only count once
                    hits = {w.strip(string.punctuation) for w in raw if value[w]}
                    hits.discard("")
                    total = sum(value[w] if w in value else learn(w) for w in sorted(hits))
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, total + bias)))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score(documents: DataFrame, weights: dict[int, float], bias: float) -> DataFrame:
    """``doc_id`` and ``score`` of every row; a null or empty text has the bias alone."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_scorer(weights, bias), "doc_id long, score double")


def judge(documents: DataFrame, labels: DataFrame, *, folds: int = 5, **options: object) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    Rows whose crc32 of the id is divisible by ``folds`` are held out: their labels are
    not learnt from. Repeated rows are scored alike; a null id counts as held out. No
    documents give no rows, no labels a score of one half for all.
    """
    held = crc_mod("doc_id", folds) == 0
    ids = written(sampled(labels.where(~held).select("doc_id", "toxic"), most_labels=int(options.get("most_labels", MOST_LABELS))), "labels")
    # The sample is bounded, so it can go to every task.
    texts = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    weights, bias = fit(texts.dropDuplicates(["doc_id"]), **options)
    return score(documents, weights, bias).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
