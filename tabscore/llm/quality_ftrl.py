"""Quality score of texts: logistic regression on hashed word n-grams, learned with follow-the-regularised-leader steps.

A text is its white-space separated words.  Each word gives two symbols: its form (lower case, without what isn't a
letter or digit at its ends) and its shape (letter case, the signs behind it, whether it repeats the word before).
Features are the unigrams and bigrams of forms and the unigrams, bigrams and trigrams of shapes, hashed into
``BUCKETS`` weights; a feature's value is its share of the text's features.  A score is the sparse dot product of
those values with the weights, through the logistic function.

The model is fitted on the driver from a bounded sample: ``SAMPLE_DOCS`` labelled rows of each label at most (those with
the smallest hashes), of each at most its first ``SAMPLE_CHARS`` characters; rows weigh what their label's share of all
labelled rows demands.  Rows whose ``crc32(doc_id) % 4`` is 2 are never learned from.  Scoring is one narrow pass over
all rows and whole texts.

Defined results: a null or empty text has no feature and gets the learned bias; without both labels in the sample the
score is the share of label 1 (0.5 without any); null labels, labels of absent documents and labels under a null id teach
nothing; a document with repeated or contradicting labels teaches each distinct one; repeated rows give repeated
rows; rows with a null id are scored and count as not held out; columns besides those named are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.chunks import give_back, text_slices
from tabscore.llm.common import read

#: Bounds of the fit: labelled rows of each label, and characters of a row that are learned from.
SAMPLE_DOCS, SAMPLE_CHARS = 3_000, 10_000
BUCKETS = 1 << 18
#: From this score on a text counts as good.
CUT = 0.7
#: Scale of feature values (their sum in a text).
MASS = 16.0

WORD = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)


def symbols(token: str) -> tuple[int, int]:
    """Hashes of a token's form and of its shape."""
    before, form, behind = WORD.match(token).groups()
    case = "x" if form.islower() else "X" if form.isupper() and len(form) > 1 else "Xx" if form.istitle() else "0" if form.isdigit() else "" if not form else "?"
    shape = f"{before[:4]}{case}{behind[:4]}"
    return zlib.crc32(form.lower().encode("utf-8", "replace")), zlib.crc32(shape.encode("utf-8", "replace"), 1)


@dataclass
class Words:
    """A worker's memory of symbols; it starts anew when it has grown large, which never changes a result."""

    most: int = 200_000
    known: dict = field(default_factory=dict)

    def symbols(self, tokens: list[str]):
        import numpy as np
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        for t in set(tokens).difference(known):
            form, shape = symbols(t)
            known[t] = form << 32 | shape
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def mixed(x):
    """Bucket of 64-bit numbers."""
    import numpy as np
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - 18)).astype(np.int64) % BUCKETS


def buckets(texts: list[str], words: Words):
    """``(owner, bucket)`` of every feature of every text, as numpy arrays."""
    import numpy as np
    split = [t.split() for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    packed = words.symbols([t for s in split for t in s])
    form, shape = packed >> np.uint64(32), packed & np.uint64(0xFFFFFFFF)
    same = np.zeros(len(owner), bool)
    same[1:] = owner[1:] == owner[:-1]  # a word before it in the same text
    twice = same.copy()
    twice[2:] &= same[1:-1]
    twice[:2] = False
    again = same.copy()
    again[1:] &= form[1:] == form[:-1]
    shape = shape * np.uint64(2) + again.astype(np.uint64)
    prime = np.uint64(0x100000001B3)
    out, who = [], []

    def add(kind: int, values, at):
        out.append(mixed(values + np.uint64(kind << 58)))
        who.append(owner[at])

    here = slice(None)
    add(1, form, here)
    add(2, shape, here)
    if len(owner) > 1:
        add(3, form[:-1][same[1:]] * prime + form[1:][same[1:]], np.flatnonzero(same))
        pairs = np.zeros(len(owner), np.uint64)
        pairs[1:] = shape[:-1] * prime + shape[1:]
        add(4, pairs[same], np.flatnonzero(same))
        threes = np.flatnonzero(twice)
        add(5, shape[threes - 2] * prime * prime + pairs[threes], threes)
    return np.concatenate(who), np.concatenate(out)


@dataclass
class Model:
    """Learned weights of the buckets and the bias."""

    weights: object
    bias: float

    def scores(self, texts: list[str], words: Words | None = None):
        """Score of each text."""
        import numpy as np
        owner, at = buckets(texts, words or Words())
        n = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, self.weights[at], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + MASS * total / np.maximum(n, 1), -35, 35)))


def fit(rows: list[tuple[list[int], list[float], int, float]], rounds: int = 4, rate: float = 0.5, smooth: float = 1.0,
        l1: float = 2e-3, l2: float = 1e-3) -> Model:
    """Follow-the-regularised-leader (proximal, a rate per weight) over ``(buckets, values, label, weight)`` rows in the given
    order, ``rounds`` times."""
    import numpy as np
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # the last is the bias

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((smooth + np.sqrt(n[at])) / rate + l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    made = [(np.append(np.asarray(at, np.int64), BUCKETS), np.append(np.asarray(x, float), 1.0), y, weight) for at, x, y, weight in rows]
    for _ in range(rounds):
        for at, x, y, weight in made:
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * weight * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / rate
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(BUCKETS + 1))
    return Model(every[:-1].astype(np.float32), float(every[-1]))


def remainder(key):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def sample(docs: DataFrame, labels: DataFrame, target: str, key: str, text: str, most: int, chars: int) -> tuple[list, dict]:
    """Features of the sampled rows ``(buckets, values, label)`` in hash order, and the number of labelled rows of each label.

    At most ``most`` ids of each label leave the labels (a top-k of hashes, without a full sort), so their table
    can be broadcast; features are made where the documents are.
    """
    import pyarrow as pa
    known = (labels.select(F.col(key).cast("string").alias("_id"), F.col(target).cast("int").alias("_y"))
             .where("_id is not null and _y in (0, 1)").where(remainder("_id") != 2).distinct())
    # labels of documents that are there; ids alone are joined
    known = known.join(docs.select(F.col(key).cast("string").alias("_id")).distinct(), "_id", "left_semi")
    totals = {r._y: r.n for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    order = [F.xxhash64("_id", F.lit(11)), F.col("_id")]
    wanted = None
    for y in sorted(totals):
        some = known.where(F.col("_y") == y).orderBy(*order).limit(most)
        wanted = some if wanted is None else wanted.unionByName(some)
    if wanted is None:
        return [], totals

    def run(batches):
        import numpy as np
        own = Words()
        for batch in batches:
            for a, b, texts in text_slices(batch, "_text"):
                owner, at = buckets(texts, own)
                found, counts = np.unique(owner * BUCKETS + at, return_counts=True)
                who = found // BUCKETS
                cuts = np.searchsorted(who, np.arange(len(texts) + 1))
                rows = [(found[i:j] % BUCKETS, counts[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_h").slice(a, b - a), batch.column("_y").slice(a, b - a),
                     pa.array([x.astype("<i4").tobytes() for x, _ in rows], pa.binary()), pa.array([c.astype("<i4").tobytes() for _, c in rows], pa.binary())],
                    names=["_h", "_y", "at", "n"])

    short = F.substring(F.col(text).cast("string"), 1, chars)
    # a document id may be repeated; one of its rows teaches, so the number of rows stays bounded
    rows = (docs.select(F.col(key).cast("string").alias("_id"), short.alias("_text")).join(F.broadcast(wanted), "_id")
            .groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
            .select(F.xxhash64("_id", F.lit(11)).alias("_h"), "_y", F.coalesce("_text", F.lit("")).alias("_text"))
            .mapInArrow(run, "_h long, _y int, at binary, n binary").orderBy("_h", "_y").collect())
    return rows, totals


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", key: str = "doc_id", text: str = "text",
          most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on the bounded sample of labelled rows."""
    import numpy as np
    rows, totals = sample(docs, labels, target, key, text, most, chars)
    seen = {y: sum(r._y == y for r in rows) for y in totals}
    whole = sum(totals.values())
    if len([y for y in seen if seen[y]]) < 2:
        share = min(max(totals.get(1, 0) / whole, 1e-6), 1 - 1e-6) if whole else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    weight = {y: totals[y] / whole * len(rows) / seen[y] for y in totals}
    made = []
    for r in rows:
        n = np.frombuffer(r.n, "<i4").astype(float)
        made.append((np.frombuffer(r.at, "<i4"), MASS * n / max(n.sum(), 1.0), r._y, weight[r._y]))
    return fit(made)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """key, held_out, score, predicted of every row."""
    import pyarrow as pa

    def run(batches):
        own = Words()
        try:
            yield from scored(own, batches)
        finally:
            own.known = {}
            give_back()

    def scored(own, batches):
        for batch in batches:
            for a, b, texts in text_slices(batch, "_text"):
                found = model.scores(texts, own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(found, pa.float64()), pa.array(found >= cut, pa.bool_())],
                    names=["_key", "held_out", "score", "good"])

    kind = df.select(key).schema[0].dataType.simpleString()
    src = df.select(F.col(key).alias("_key"), F.coalesce(remainder(key) == 2, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("_text"))
    out = src.mapInArrow(run, f"_key {kind}, held_out boolean, score double, good boolean")
    return out.select(F.col("_key").alias(key), "held_out", "score", F.col("good").cast("int").alias("predicted"))


def op11_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, score, predicted."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, learn(docs, read(spark, sf_dir, "labels")))


QUERIES = {"op11_quality_ftrl": op11_quality_ftrl}
