"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of the rows that the hashes of the word, of its
first four and of its first six bytes name (ASCII lower case, marks behind it
removed).  Filters of widths 1, 2 and 3 slide over the words of a text, their
largest responses are pooled and a linear layer gives a log-odds.  All labelled
texts train it, by Adagrad with half of the words left out at random and both
classes weighing the same.  They are dealt to shards of about ``SHARD_ROWS`` texts;
in each pass every shard goes on from the same model, and the mean of what the
shards learnt, of each embedding row by how often a shard moved it, is the next
one.  Then the log-odds of all of them, counted by language, label and steps of
1 / ``STEPS``, set a threshold for each language, which the text's function words
tell; a score is the log-odds above that threshold as a probability, so 0.5 is
the threshold in every language.  Only the model, whose size is fixed, and
the counts, at most two a language and step, meet in the driver; the model goes to
all tasks and every whole text is scored.

Defined results: a null or empty text has the pooled value 0 and its score;
repeated rows score alike; a null id is not held out and not learnt from; of
rows that share an id the smallest text is learnt, under each label of the id;
without labelled texts of both classes every score is 0; an empty table gives
an empty result.  Only the id and the text column are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from huddle.llm.shared import side, small_batches, written
from huddle.llm.text import _LOWER, U64, Words, mix, slices, texts_of

#: Texts of a shard.
SHARD_ROWS = 5_000
#: Texts that all passes together see at least, within 3 to 12 passes.
SEEN = 60_000
#: Rounds over each slice of texts in a pass.
ROUNDS = 2
#: Counted log-odds: steps a unit, and the largest.
STEPS, LARGEST = 256, 32
BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
# Function words that tell a text's language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for with was are this",
    "fr": "le les et des une dans pour est qui sur avec du",
    "de": "der die und das den von mit ist nicht ein im sich",
    "es": "el los y del las en por para con una su como",
}
LANGUAGES = ["", *FUNCTION_WORDS]
_MARK = np.ones(256, bool)
_MARK[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False


class Texts:
    """Embedding rows and language of the texts of a slice."""

    def __init__(self, column: pa.Array):
        w = Words(column, hashes=False)
        data = _LOWER[w.data]
        start, end = w.start, w.end.copy()
        for _ in range(4):  # marks behind a word
            drop = (end - start > 1) & _MARK[data[np.maximum(end - 1, 0)]] if len(end) else np.zeros(0, bool)
            end[drop] -= 1
        whole = self._hash(data, start, end)
        self.rows = [(x & U64(BUCKETS - 1)).astype(np.int64) for x in (whole, mix(self._hash(data, start, np.minimum(end, start + 4)), 8), mix(self._hash(data, start, np.minimum(end, start + 6)), 9))]
        self.first, self.n, self.doc = w.first, w.n_docs, w.doc
        words = [(Words(pa.array([x], pa.large_string())).hash[0], i) for i, name in enumerate(FUNCTION_WORDS, 1) for x in FUNCTION_WORDS[name].split()]
        known = np.array(sorted(words), dtype=[("h", U64), ("l", np.int64)])
        at = np.minimum(np.searchsorted(known["h"], whole), len(known) - 1)
        hit = known["h"][at] == whole
        seen = np.bincount(self.doc[hit] * len(LANGUAGES) + known["l"][at][hit], minlength=self.n * len(LANGUAGES)).reshape(self.n, -1)
        self.language = np.where(seen.max(axis=1) > 0, seen.argmax(axis=1), 0)

    @staticmethod
    def _hash(data, start, end, piece=1 << 17):
        parts = [Words._hash(data, start[i : i + piece], end[i : i + piece]) for i in range(0, len(start), piece)]
        return np.concatenate(parts) if parts else np.zeros(0, U64)


class Network:
    """All parameters are rows of one table, so that shards can be averaged row by row: the embedding, then the
    kernels, offsets, output weights and the bias.  ``speed`` holds Adagrad's sums of squares alike."""

    def __init__(self, table: np.ndarray | None = None, speed: np.ndarray | None = None, threshold: np.ndarray | None = None, seed: int = 5):
        dense = sum(WIDTHS) * DIM + 2 * len(WIDTHS) + 1
        if table is None:
            table = (np.random.default_rng(seed).standard_normal((BUCKETS + dense, DIM)) * 0.25).astype(np.float32)
            table[BUCKETS + sum(WIDTHS) * DIM : -len(WIDTHS) - 1] = 0
            table[-1] = 0
        self.table = table
        self.speed = np.full(table.shape, 1e-6, np.float32) if speed is None else speed
        self.threshold = np.zeros(len(LANGUAGES)) if threshold is None else threshold
        self.embedding = table[:BUCKETS]
        self.kernel, self.offset, self.out, self.bias = self._parts(table[BUCKETS:])

    @staticmethod
    def _parts(table: np.ndarray):
        """Kernels, offsets, output weights and bias as views of the rows behind the embedding."""
        kernel, offset, at = {}, {}, 0
        for w in WIDTHS:
            kernel[w] = table[at : at + w * DIM].reshape(w, DIM, FILTERS)
            at += w * DIM
        for w in WIDTHS:
            offset[w] = table[at]
            at += 1
        return kernel, offset, table[at : at + len(WIDTHS)].reshape(-1), table[-1, :1]

    def embed(self, rows, part=slice(None)):
        return sum(self.embedding[r[part]] for r in rows)

    def respond(self, e: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rectified responses of all filters at each word; a window over the end of a text gives 0."""
        n, columns = len(e), []
        for w in WIDTHS:
            a = np.zeros((n, FILTERS), np.float32)
            if n >= w:
                m = n - w + 1
                a[:m] = self.offset[w]
                for j in range(w):
                    a[:m] += e[j : j + m] @ self.kernel[w][j]
                a[:m][doc[:m] != doc[w - 1 :]] = 0
            columns.append(np.maximum(a, 0))
        return np.concatenate(columns, axis=1)

    def pooled(self, t: Texts) -> np.ndarray:
        out = np.zeros((t.n, len(self.out)), np.float32)
        full = np.flatnonzero(np.diff(t.first))
        if len(full):
            out[full] = np.maximum.reduceat(self.respond(self.embed(t.rows), t.doc), t.first[full], axis=0)
        return out

    def odds(self, t: Texts) -> np.ndarray:
        return (self.pooled(t) @ self.out + self.bias[0]).astype(float)

    def learn(self, t: Texts, label: np.ndarray, weight: np.ndarray, moved: np.ndarray, rng, rate: float = 0.08, batch: int = 16, drop: float = 0.5):
        """One round over the texts of a slice; ``moved`` counts the steps of each embedding row."""

        def step(rows, grad):
            self.speed[rows] += grad**2
            self.table[rows] -= rate * grad / np.sqrt(self.speed[rows])

        for lo in range(0, t.n, batch):
            hi = min(t.n, lo + batch)
            span = slice(t.first[lo], t.first[hi])
            rows, at = [r[span] for r in t.rows], t.first[lo : hi + 1] - t.first[lo]
            e = self.embed(rows)
            a = self.respond(e, t.doc[span])
            a[rng.random(len(a)) < drop] = 0  # or only a text's strongest word would ever learn
            top, best = np.zeros((hi - lo, len(self.out)), np.int64), np.zeros((hi - lo, len(self.out)), np.float32)
            for i in np.flatnonzero(np.diff(at)):
                own = a[at[i] : at[i + 1]]
                top[i] = own.argmax(axis=0)
                best[i] = own[top[i], np.arange(len(self.out))]
            top += at[:-1, None]
            error = weight[lo:hi] * (1 / (1 + np.exp(-(best @ self.out + self.bias[0]))) - label[lo:hi]) / (hi - lo)
            back = error[:, None] * self.out * (best > 0)
            grad = np.zeros((len(self.table) - BUCKETS, DIM), np.float32)
            g_kernel, g_offset, g_out, g_bias = self._parts(grad)
            g_out += error @ best
            g_bias += error.sum()
            touched, change = [], []
            for k, w in enumerate(WIDTHS):
                of, f = np.nonzero(back[:, k * FILTERS : (k + 1) * FILTERS])
                g, p = back[of, k * FILTERS + f].astype(np.float32), top[of, k * FILTERS + f]
                np.add.at(g_offset[w], f, g)
                for j in range(w):
                    np.add.at(g_kernel[w][j].T, f, g[:, None] * e[p + j])
                    for r in rows:
                        touched.append(r[p + j])
                        change.append(g[:, None] * self.kernel[w][j].T[f])
            hit, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g = np.zeros((len(hit), DIM), np.float32)
            np.add.at(g, inverse, np.concatenate(change))
            step(slice(BUCKETS, None), grad)
            step(hit, g)
            moved[hit] += 1

    def calibrate(self, odds: np.ndarray, label: np.ndarray, language: np.ndarray, weight: np.ndarray):
        """For each language the cut with the least weighted error, halfway between the two log-odds
        beside it; a language with few texts of a class takes the cut of all."""

        def cut(rows):
            order = np.argsort(odds[rows])
            o, y, w = odds[rows][order], label[rows][order], weight[rows][order]
            wrong = np.concatenate([[0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0]])
            best = np.flatnonzero(wrong == wrong.min())
            k = best[len(best) // 2]
            return (max(o[k - 1], -8.0) if k else o[0] - 1) / 2 + (min(o[k], 8.0) if k < len(o) else o[-1] + 1) / 2

        every = np.arange(len(odds))
        for i in range(len(LANGUAGES)):
            own = np.flatnonzero(language == i)
            enough = len(own) and min((weight * label)[own].sum(), (weight * (1 - label))[own].sum()) >= 10
            self.threshold[i] = cut(own if enough else every)

    def score(self, t: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.odds(t) - self.threshold[t.language])))


def averaged(net: Network, learnt: DataFrame, weight: tuple[float, float], seed: int) -> Network:
    """One pass: every shard goes on from ``net``, Spark averages the rows that they moved."""
    table, speed = net.table, net.speed

    def run(batches):
        own, rng = Network(table.copy(), speed.copy()), np.random.default_rng(seed)
        moved, texts = np.zeros(len(table)), 0
        for batch in batches:
            for part in slices(batch, "text"):
                t = Texts(texts_of(part.column("text")))
                label = part.column("label").to_numpy(zero_copy_only=False)
                for _ in range(ROUNDS):
                    own.learn(t, label, np.where(label == 1, weight[1], weight[0]), moved, rng)
                texts += t.n
        moved[BUCKETS:] = texts
        rows = np.flatnonzero(moved)
        values = np.concatenate([own.table[rows], own.speed[rows]], axis=1).astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(moved[rows]), *map(pa.array, values.T.copy())], names=["row", "moved", *names])

    names = [f"x{i}" for i in range(2 * DIM)]
    shards = learnt.select("text", "label").mapInArrow(run, "row long, moved double, " + ", ".join(f"{c} double" for c in names))
    mean = shards.groupBy("row").agg(*[(F.sum(F.col(c) * F.col("moved")) / F.sum("moved")).alias(c) for c in names]).toArrow()
    table, speed, rows = table.copy(), speed.copy(), mean.column("row").to_numpy()
    values = np.column_stack([mean.column(c).to_numpy() for c in names])
    table[rows], speed[rows] = values[:, :DIM], values[:, DIM:]
    return Network(table, speed)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict | None:
    """The trained network's table and thresholds.  labels: id and label of the rows to learn from, all of which are learnt."""
    labels = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    labels = written(labels.distinct(), "toxicity-labels")
    shards = max(1, labels.count() // SHARD_ROWS)
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # one text per id, however often it is repeated; a shard's texts come in the order of a hash
    learnt = texts.join(side(labels), "id").repartition(shards, "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    learnt = written(learnt.sortWithinPartitions(F.xxhash64("id"), "id", "label"), "toxicity-learnt").coalesce(shards)
    totals = dict(learnt.groupBy("label").count().collect())
    if len(totals) < 2:
        return None
    rows = sum(totals.values())
    weight = tuple(rows / (2 * totals[x]) for x in (0, 1))
    net = Network()
    for i in range(min(12, max(3, SEEN // rows))):
        net = averaged(net, learnt, weight, i)

    def run(batches):
        own = Network(table)
        for batch in batches:
            for part in slices(batch, "text"):
                t = Texts(texts_of(part.column("text")))
                at = np.clip(np.floor(own.odds(t) * STEPS), -LARGEST * STEPS, LARGEST * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(t.language.astype(np.int64)), part.column("label"), pa.array(at)], names=["language", "label", "at"])

    table = net.table
    # at most two counts a language and step
    counted = learnt.select("text", "label").mapInArrow(run, "language long, label int, at long").groupBy("language", "label", "at").count().toArrow()
    language, label, at, count = (counted.column(c).to_numpy() for c in ("language", "label", "at", "count"))
    net.calibrate((at + 0.5) / STEPS, label.astype(float), language, count.astype(float))
    return {"table": table, "threshold": net.threshold}


def score_toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, language (told from the text) of every row."""

    def run(batches):
        net = Network(**model) if model else None
        for batch in batches:
            for part in slices(batch, "text"):
                t = Texts(texts_of(part.column("text")))
                score = net.score(t) if net else np.zeros(t.n)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score), pa.array([LANGUAGES[i] for i in t.language])], names=["id", "score", "language"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, score double, language string")
