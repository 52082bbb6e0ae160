"""Toxicity categories by a classifier chain of linear models.

The categories are predicted in a fixed order. Each has a logistic model over
the words of the text, and from the second on over the probabilities of the
categories before it. In training those probabilities are out-of-fold: a row's
earlier probabilities come from models that did not see the row, so a later
model learns to trust them as much as they deserve.

The models are fitted on a bounded sample of labelled rows (``max_rows`` rows,
``max_features`` words in all, in the order of a hash of the id, so the sample
is spread over the corpus); every row of the table is scored in full.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch, store
from .decontam import words as tokens

MAX_ROWS, MAX_FEATURES, FOLDS = 5000, 5_000_000, 3
#: A word or prefix counts as a feature from so many sampled documents on.
MIN_DOCS = 3
#: ... whose association with the category is no accident: twice the log
#: likelihood ratio against independence (chi-square of one degree).
MIN_G = 16.0
_PREFIX = 5
_REMEMBERED = 1_000_000


class _Features(dict):
    """Word -> hashes of the word and of its first letters, in one integer."""

    def __missing__(self, w: bytes) -> int:
        import xxhash
        got = xxhash.xxh32_intdigest(w) << 32 | xxhash.xxh32_intdigest(w[:_PREFIX], 1)
        if len(self) > _REMEMBERED:
            self.clear()
        self[w] = got
        return got


_FEATURES = _Features()


_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_CAPITALS = bytes(range(65, 91))
STATISTICS = 3


def features(text: str | None):
    """Sorted distinct 32-bit features of a whole text, and its share of
    repeated words, of symbols and of capitals."""
    import numpy as np
    all_words = tokens(text)
    words = set(all_words)
    v = np.fromiter(map(_FEATURES.__getitem__, words), np.uint64, len(words))
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw) or 1
    shares = (1 - len(words) / (len(all_words) or 1), 1 - len(raw.translate(None, _SYMBOLS)) / n if raw else 0.0,
              1 - len(raw.translate(None, _CAPITALS)) / n if raw else 0.0)
    return np.unique(np.concatenate([v >> np.uint64(32), v & np.uint64(0xFFFFFFFF)])).astype(np.uint32), shares


def _g_test(p, q, pos: float, n: float):
    """G statistic of each feature's 2 x 2 table (feature, category)."""
    import numpy as np
    total = np.zeros(len(p))
    for a, row, col in ((p, p + q, pos), (q, p + q, n - pos), (pos - p, n - p - q, pos), (n - pos - q, n - p - q, n - pos)):
        expected = row * col / n
        total += np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    return 2 * total


class Linear:
    """Logistic model over presence features, scaled by their log odds in the
    training rows, and a few dense inputs (text statistics, earlier probabilities)."""

    def __init__(self, index, start, dense, y, known, n_features: int, rounds: int = 150, l2: float = 1e-3):
        import numpy as np
        rows = np.flatnonzero(known)
        y = y.astype(np.float64)
        self.w = np.zeros(n_features)
        self.dense = np.zeros(dense.shape[1])
        pos, n = float(y[rows].sum()), len(rows)
        self.bias = float(np.log((pos + 0.5) / (n - pos + 0.5)))
        if not n or pos in (0.0, float(n)):
            return
        owner = np.repeat(np.arange(len(y)), np.diff(start))
        use = known[owner]
        index, owner = index[use], owner[use]
        p = np.bincount(index, weights=y[owner], minlength=n_features)
        q = np.bincount(index, weights=1 - y[owner], minlength=n_features)
        ratio = np.log((p + 0.5) / (pos + 1)) - np.log((q + 0.5) / (n - pos + 1))
        ratio[_g_test(p, q, pos, n) < MIN_G] = 0.0
        told = ratio[index] != 0
        index, owner = index[told], owner[told]
        step_w, step_d, step_b = np.full(n_features, 1e-8), np.full(dense.shape[1], 1e-8), 1e-8
        x = ratio[index]
        for _ in range(rounds):  # full-batch AdaGrad
            z = self.bias + np.bincount(owner, weights=x * self.w[index], minlength=len(y)) + dense @ self.dense
            err = np.where(known, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0.0) / n
            g = np.bincount(index, weights=err[owner] * x, minlength=n_features) + l2 * self.w / n
            gd, gb = dense.T @ err + l2 * self.dense / n, float(err.sum())
            step_w += g * g
            step_d += gd * gd
            step_b += gb * gb
            self.w -= 0.3 * g / np.sqrt(step_w)
            self.dense -= 0.3 * gd / np.sqrt(step_d)
            self.bias -= 0.3 * gb / np.sqrt(step_b)
        self.w *= ratio

    def predict(self, index, start, dense):
        import numpy as np
        owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
        z = self.bias + np.bincount(owner, weights=self.w[index], minlength=len(start) - 1) + dense @ self.dense
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories: Sequence[str],
            max_rows: int, max_features: int):
    """Features and labels of the sampled rows, on the driver (bounded)."""
    order = F.xxhash64(id_col)
    flags = labels.groupBy(id_col).agg(*[F.max(F.col(c).cast("int")).alias(f"__c{i}") for i, c in enumerate(categories)])
    flags = flags.where(F.col(id_col).isNotNull()).withColumn("__o", order).orderBy("__o", id_col).limit(max_rows)
    flags = store(flags, "toxicity-sample")  # max_rows ids, small enough to be broadcast by size
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text")).join(flags, id_col)
    names = [f"__c{i}" for i in range(len(categories))]
    schema = T.StructType([T.StructField("__o", T.LongType())] + [T.StructField(n, T.IntegerType()) for n in names]
                          + [T.StructField("n", T.LongType()), T.StructField("f", T.ArrayType(T.LongType())),
                             T.StructField("s", T.ArrayType(T.DoubleType()))])
    fields = [("__o", pa.int64())] + [(n, pa.int32()) for n in names] + [("n", pa.int64()), ("f", pa.list_(pa.int64())),
                                                                     ("s", pa.list_(pa.float64()))]

    def run(batches):
        for b in batches:
            for part in lists(b, "__text"):
                got = [features(t) for t in part["__text"]]
                yield out_batch(fields, [part["__o"], *(part[n] for n in names), [len(x) for x, _ in got],
                                         [x for x, _ in got], [s for _, s in got]])

    got = rows.select("__o", *names, "__text").mapInArrow(run, schema)
    # one row per id, however often it is repeated, so what is collected has max_rows rows at most
    got = store(got.groupBy("__o", *names).agg(F.min(F.struct("n", "f", "s")).alias("x")).select("__o", *names, "x.*"),
                "toxicity-features")
    sizes = sorted(map(tuple, got.groupBy("__o").agg(F.sum("n")).collect()))
    total, chosen = 0, []
    for o, n in sizes:
        if total + n <= max_features:  # a row that does not fit is left out, later ones are not
            total += n
            chosen.append(o)
    return got.where(F.col("__o").isin(chosen)).orderBy("__o", "n", *names).toArrow()


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
        folds: int = FOLDS) -> dict:
    """Train the chain ``categories`` (0/1 columns of ``labels``, in order).

    A NULL label leaves its row out of that category's model; of repeated
    labels of an id the greatest counts, of its documents the one with the
    fewest words; ids without a document are ignored. A
    category without both values gets a constant model, with a warning. The
    sample is bounded by ``max_rows`` and ``max_features``; a row that would
    exceed the latter is left out and the next ones are tried."""
    import numpy as np
    rows = _sample(docs, labels, id_col, text_col, categories, max_rows, max_features)
    sizes = np.array(rows["n"], np.int64)
    flat = np.array(rows["f"].combine_chunks().flatten(), np.int64).astype(np.uint32)
    words, index, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count >= MIN_DOCS
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)[often[index]]
    index = (np.cumsum(often) - 1)[index[often[index]]]
    words = words[often]
    start = np.searchsorted(owner, np.arange(n + 1))
    fold = np.arange(n) % folds
    earlier = np.array(rows["s"].combine_chunks().flatten(), np.float64).reshape(n, STATISTICS)
    models = []
    for c in range(len(categories)):
        label = rows[f"__c{c}"]
        y = np.array(label.fill_null(0), np.float64)
        known = ~np.array(label.is_null(), bool)
        if n and len(np.unique(y[known])) < 2:
            warnings.warn(f"the sample of {n} rows lacks a label of {categories[c]}: its model is constant", stacklevel=2)
        out = np.zeros(n)
        for f in range(folds):
            part = Linear(index, start, earlier, y, known & (fold != f), len(words))
            out[fold == f] = part.predict(index, start, earlier)[fold == f]
        models.append(Linear(index, start, earlier, y, known, len(words)))
        earlier = np.concatenate([earlier, out[:, None]], 1)
    return {"categories": list(categories), "words": words, "models": models}


def score_texts(chain: dict, texts: Sequence[str | None]):
    """Probabilities, texts x categories."""
    import numpy as np
    words = chain["words"]
    found, shares = [], []
    for t in texts:
        f, s = features(t)
        shares.append(s)
        at = np.searchsorted(words, f)
        at[at == len(words)] = 0
        found.append(at[words[at] == f] if len(words) else np.zeros(0, np.int64))
    index = np.concatenate([np.zeros(0, np.int64), *found])
    start = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    out = np.array(shares, np.float64).reshape(len(texts), STATISTICS)
    for m in chain["models"]:
        out = np.concatenate([out, m.predict(index, start, out)[:, None]], 1)
    return out[:, STATISTICS:]


def predict(df: DataFrame, chain: dict, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``p_<category>`` per row, whole texts.

    A NULL text counts as empty and gets the models' base rates; repeated rows
    are scored each; an empty table gives no rows."""
    shared = df.sparkSession.sparkContext.broadcast(chain)  # at most max_features words
    names = [f"p_{c}" for c in chain["categories"]]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches):
        import numpy as np
        for b in batches:
            parts = [score_texts(shared.value, p["__text"]) for p in lists(b.select(["__text"]), "__text")]
            got = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))] + [pa.array(got[:, i]) for i in range(len(names))],
                names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text")).mapInArrow(run, schema)
