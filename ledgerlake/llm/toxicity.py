"""Toxicity scores by a factorization machine over hashed terms (operator 8).

Terms of a text are its words and the first letters of its words, hashed to
31 bits.  A linear model adds the weights of single terms; the machine
also learns a factor vector per term, so that two terms seen together (an
insult and the mention of a group) can weigh more than their sum.

Fitting uses a bounded, documented sample: of each label at most
``max_rows_per_label`` rows, chosen by a hash of their id, without those held
out (crc32 of the id as text, modulo 4, is 2); the bias is then moved to the
labels' shares among all rows that aren't held out.  Documents are counted per
term and label over all labelled rows that aren't held out, by a distributed
aggregate; the ``max_terms`` terms whose rates differ most between the labels
(likelihood ratio) stay, and only these enter the machine, which keeps long
texts of unknown words from drifting.  The model has a fixed size, so it can
be shipped to every task; every text is then scored whole.

Labels, language, source and id are never inputs of a score.  Null and empty
texts have no terms and score the model's bias.  Rows with a null id or label
are not trained on; repeated labels of an id count as toxic if any is.
Without any labelled row every score is 0; an empty table gives no rows.  Very
long texts are scored whole.  Only id and text of the documents are read, so
other columns can have any name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_rows, broadcast_row_limit
from .common import materialize, pick

STRIP = ".,;:!?\"'()[]{}<>|/\\-_*#&%$~`«»“”‘’…"


@dataclass(frozen=True)
class Settings:
    max_rows_per_label: int = 4_000  # bound of the fitting sample
    max_terms: int = 4_096           # terms that enter the machine
    min_rows: int = 4                # labelled rows a term must be in
    min_gain: float = 20.0           # likelihood ratio (G) of term and label from which a term is kept, and the
    gain_a_row: float = 0.0125       # same for each row of the rarer label: G grows with the rows, so that without
                                     # this limit ever weaker terms would enter
    stem: int = 4                  # letters of a word's start that are a term of their own
    factors: int = 8
    epochs: int = 30
    batch: int = 256
    rate: float = 0.1
    l2: float = 1e-4
    threshold: float = 0.3
    seed: int = 7


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


class Terms:
    """Distinct hashed terms of a text, with a bounded memo of words."""

    def __init__(self, settings: Settings, memo_size: int = 200_000):
        self.s, self.memo, self.memo_size = settings, {}, memo_size

    def _of_word(self, raw: str) -> tuple[int, ...]:
        word = raw.lower().strip(STRIP)
        if not word:
            return ()
        stem = word[:self.s.stem]
        own = zlib.crc32(b"w:" + word.encode("utf-8", "replace")) >> 1
        return own, zlib.crc32(b"s:" + stem.encode("utf-8", "replace")) >> 1

    def __call__(self, text: str | None) -> np.ndarray:
        memo, found = self.memo, set()
        for raw in set((text or "").split()):
            terms = memo.get(raw)
            if terms is None:
                terms = self._of_word(raw)
                if len(memo) < self.memo_size and len(raw) <= 64:
                    memo[raw] = terms
            found.update(terms)
        return np.fromiter(found, np.int32, len(found))


def _term_batches(settings: Settings):
    def run(batches):
        import pyarrow as pa

        terms = Terms(settings)
        for batch in batches:
            texts = batch.column("text")
            found = [terms(texts[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms"])
    return run


class FactorizationMachine:
    """Second-order machine over binary features, logistic loss, AdaGrad."""

    def __init__(self, n: int, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.s, self.bias = settings, 0.0
        self.w = np.zeros(n)
        self.v = rng.normal(0.0, 0.01, (n, settings.factors))

    def margins(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the logistic function; row r has ids[starts[r]:starts[r+1]]."""
        rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        n = len(starts) - 1
        linear = np.bincount(rows, self.w[ids], n)
        pairs = np.zeros(n)
        for f in range(self.v.shape[1]):
            x = self.v[ids, f]
            pairs += np.bincount(rows, x, n) ** 2 - np.bincount(rows, x * x, n)
        return self.bias + linear + 0.5 * pairs

    @staticmethod
    def _thinned(ids: np.ndarray, rng) -> np.ndarray:
        """A random part of a training row's terms, one at least: each term must also count alone."""
        if len(ids) < 2:
            return ids
        keep = rng.random(len(ids)) < rng.choice((1.0, 0.4, 0.0))
        return ids[keep] if keep.any() else ids[rng.integers(len(ids))][None]

    def fit(self, features: list[np.ndarray], y: np.ndarray) -> "FactorizationMachine":
        s, rng, n = self.s, np.random.default_rng(self.s.seed + 1), len(y)
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        self.bias = float(np.log(share / (1 - share)))
        gb, gw, gv = 1e-8, np.full(self.w.shape, 1e-8), np.full(self.v.shape, 1e-8)
        for _ in range(s.epochs):
            order = rng.permutation(n)
            for at in range(0, n, s.batch):
                part = order[at:at + s.batch]
                lists = [self._thinned(features[i], rng) for i in part]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
                ids = np.concatenate(lists) if starts[-1] else np.zeros(0, np.int64)
                rows = np.repeat(np.arange(len(part)), np.diff(starts))
                error = 1 / (1 + np.exp(-np.clip(self.margins(ids, starts), -30, 30))) - y[part]
                g = error.sum() / len(part)
                gb += g * g
                self.bias -= s.rate * g / np.sqrt(gb)
                if not len(ids):
                    continue
                used, where = np.unique(ids, return_inverse=True)
                e = error[rows] / len(part)
                g = np.bincount(where, e, len(used)) + s.l2 * self.w[used]
                gw[used] += g * g
                self.w[used] -= s.rate * g / np.sqrt(gw[used])
                for f in range(self.v.shape[1]):
                    x = self.v[ids, f]
                    total = np.bincount(rows, x, len(part))
                    g = np.bincount(where, e * (total[rows] - x), len(used)) + s.l2 * self.v[used, f]
                    gv[used, f] += g * g
                    self.v[used, f] -= s.rate * g / np.sqrt(gv[used, f])
        return self


@dataclass
class Model:
    """Kept buckets (sorted) and their machine; bounded by ``max_terms``."""

    settings: Settings
    buckets: np.ndarray
    machine: FactorizationMachine | None

    def select(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.buckets) or not len(terms):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.buckets, terms)
        at[at == len(self.buckets)] = 0
        return np.sort(at[self.buckets[at] == terms])

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        if self.machine is None:
            return np.zeros(len(features))
        starts = np.concatenate([[0], np.cumsum([len(x) for x in features])]).astype(np.int64)
        ids = np.concatenate(features) if starts[-1] else np.zeros(0, np.int64)
        return 1 / (1 + np.exp(-np.clip(self.machine.margins(ids, starts), -700, 700)))


def _sample(known: DataFrame, s: Settings) -> DataFrame:
    """Of each label at most ``max_rows_per_label`` ids, the first in order of a hash."""
    def of(label: int) -> DataFrame:
        return (known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(s.max_rows_per_label))
    return of(1).unionByName(of(0))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", label_id_col: str = "doc_id") -> Model:
    """Counts terms over all labelled rows, fits the machine on the bounded sample.

    Only the kept terms and the sampled rows' lists of them reach the driver.
    """
    s = settings
    known = pick(labels, doc_id=label_id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = materialize(known, "toxicity-labels")
    spark = docs.sparkSession
    texts = pick(docs, doc_id=id_col, text=text_col)

    def terms_of(rows: DataFrame) -> DataFrame:
        rows = rows.select("doc_id", "toxic", "text")
        return rows.mapInArrow(_term_batches(s), f"doc_id {dict(rows.dtypes)['doc_id']}, toxic int, terms array<int>")

    few = F.broadcast(known) if bounded_rows(known, broadcast_row_limit(known)) else known
    labelled = texts.join(few, "doc_id")
    rows = texts.join(F.broadcast(_sample(known, s)), "doc_id")  # 2 * max_rows_per_label
    rows = materialize(rows.select("doc_id", "toxic", "text"), "toxicity-sample")
    shares = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    totals = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 and not n0:
        return Model(s, np.zeros(0, np.int64), None)
    by_term = terms_of(labelled).select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.min_rows)
    share = shares.get(1, 0) / sum(shares.values())
    least = max(s.min_gain, s.gain_a_row * min(shares.get(1, 0), shares.get(0, 0)))

    def part(count: Column, expected: float) -> Column:
        return F.when(count > 0, 2.0 * count * F.log(count / (F.col("n") * expected))).otherwise(0.0)

    gain = F.lit(0.0) if share in (0.0, 1.0) else part(F.col("a"), share) + part(F.col("n") - F.col("a"), 1 - share)
    ranked = by_term.withColumn("gain", gain).where(F.col("gain") >= least)
    kept = [r[0] for r in ranked.orderBy(F.desc("gain"), "term").limit(s.max_terms).select("term").collect()]
    buckets = np.array(sorted(kept), np.int64)

    chosen = F.broadcast(spark.createDataFrame([(int(b),) for b in kept], "term int"))
    per_row = terms_of(rows).select("doc_id", "toxic", F.explode("terms").alias("term")).join(chosen, "term").groupBy(
        "doc_id", "toxic").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    model = Model(s, buckets, FactorizationMachine(len(buckets), s))
    train = sorted(per_row.collect(), key=lambda r: (str(r["doc_id"]), r["toxic"]))
    features = [np.searchsorted(buckets, np.array(r["terms"], np.int64)) for r in train]
    y = [float(r["toxic"]) for r in train]
    for label, n in ((1.0, n1), (0.0, n0)):  # rows without any kept term
        rest = n - sum(v == label for v in y)
        features += [np.zeros(0, np.int64)] * rest
        y += [label] * rest
    model.machine.fit(features, np.array(y))
    if n1 and n0:
        model.machine.bias += float(np.log(shares[1] / shares[0]) - np.log(n1 / n0))
    return model


def _score_batches(model: Model):
    def run(batches):
        import pyarrow as pa

        terms, s = Terms(model.settings), model.settings
        for batch in batches:
            texts = batch.column("text")
            features = [model.select(terms(texts[i].as_py())) for i in range(batch.num_rows)]
            score = model.scores(features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= s.threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    src = pick(docs, doc_id=id_col, text=text_col)
    src = src.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return src.mapInArrow(_score_batches(model), f"doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, "
                                                 "score double, predicted int")
