"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts every n-gram of every labelled text inside the tasks (a count
matrix of ``BUCKETS`` x languages per task, summed by Spark), so only that
bounded matrix meets on the driver. The log-probability matrix is broadcast.
A batch of texts is scored as a sparse matrix product: the n-gram positions of
all texts are the column indices, the texts the row ranges, and numpy sums the
gathered log-probabilities per range. Log-probabilities are integers (fixed
point), so sums do not depend on order, batches or partitions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch, store

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: Bound of the matrix that is broadcast: BUCKETS x MAX_LANGUAGES numbers.
MAX_LANGUAGES = 256
UNDETERMINED = "und"
_SCALE = 1 << 20
_PIECE = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _segments(texts):
    """(row, lower-cased text piece, number of n-gram starts in it); pieces of
    a long text overlap by the longest n-gram less one."""
    for row, t in enumerate(texts):
        t = t.lower()
        for at in range(0, len(t), _PIECE):
            yield row, t[at:at + _PIECE + max(ORDERS) - 1], min(_PIECE, len(t) - at)


def _grams(pieces):
    """For every n-gram order: the hash buckets of all positions of the joined
    pieces, and the [start, end) range of each piece."""
    import numpy as np
    codes = np.frombuffer("".join(p for _, p, _ in pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(p) for _, p, _ in pieces], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    held = np.array([n for _, _, n in pieces], np.int64)
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, min(max(ORDERS), len(codes)) + 1):
        h = (h[:len(codes) - n + 1] + codes[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            ends = starts + np.minimum(held, np.maximum(sizes - n + 1, 0))
            yield (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), starts, ends


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict:
    """Train on every row with a text and a language.

    Returns ``langs`` (sorted), ``prior`` and ``logp`` (languages x BUCKETS,
    fixed point). Rows with a NULL text or language are not learned from; an
    empty table gives a model without languages. More than ``MAX_LANGUAGES``
    distinct languages raise ValueError."""
    import numpy as np
    schema = "lang string, bucket int, n long"
    fields = [("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())]

    def count(batches):
        import numpy as np
        held: dict[str, np.ndarray] = {}
        for b in batches:
            for part in lists(b, "__text"):
                by: dict[str, list[str]] = {}
                for lang, text in zip(part["__lang"], part["__text"]):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    total = held.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    total[BUCKETS] += len(texts)
                    pieces = list(_segments(texts))
                    for h, starts, ends in _grams(pieces) if pieces else ():
                        inside = np.zeros(len(h) + 1, np.int64)
                        np.add.at(inside, np.minimum(starts, len(h)), 1)
                        np.add.at(inside, np.minimum(ends, len(h)), -1)
                        total[:BUCKETS] += np.bincount(h[np.cumsum(inside[:-1]) > 0], minlength=BUCKETS)
        for lang, total in held.items():
            at = np.flatnonzero(total)
            yield out_batch(fields, ([lang] * len(at), at, total[at]))

    rows = (df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("__lang"), F.col(text_col).alias("__text"))
            .mapInArrow(count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    rows = store(rows, "langid-counts")  # the texts are counted once
    langs_seen = rows.where(F.col("bucket") == BUCKETS).select("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(langs_seen) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    got = rows.toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + 1), np.int64)
    counts[[langs.index(x) for x in got["lang"]], got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    grams, docs = counts[:, :BUCKETS], counts[:, BUCKETS]
    logp = np.log(grams + 1.0) - np.log(grams.sum(1, keepdims=True) + float(BUCKETS))
    prior = np.log(docs / max(docs.sum(), 1))
    return {"langs": langs, "prior": np.rint(prior * _SCALE).astype(np.int64),
            "logp": np.rint(logp * _SCALE).astype(np.int64)}


def score_texts(model: dict, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Predicted language and its posterior probability per text."""
    import numpy as np
    langs, out = model["langs"], [UNDETERMINED] * len(texts)
    score = [0.0] * len(texts)
    rows = [i for i, t in enumerate(texts) if has_letter(t)] if langs else []
    if not rows:
        return out, score
    pieces = list(_segments([texts[i] for i in rows]))
    owner = np.array([r for r, _, _ in pieces], np.int64)
    total = np.repeat(model["prior"][:, None], len(rows), 1)
    for h, starts, ends in _grams(pieces):
        full = np.flatnonzero(ends > starts)
        if not len(full):
            continue
        h = np.append(h, 0)
        at = np.stack([starts[full], ends[full]], 1).ravel()
        for k in range(len(langs)):
            sums = np.add.reduceat(model["logp"][k][h], at)[::2]
            np.add.at(total[k], owner[full], sums)
    best = total.argmax(0)  # the first of equals: langs are sorted
    gap = (total - total.max(0)) / _SCALE
    prob = 1.0 / np.exp(gap).sum(0)
    for i, b, p in zip(rows, best, prob):
        out[i], score[i] = langs[b], float(p)
    return out, score


def predict(df: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None,
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """The columns ``keep`` of every row (all when None) with ``lang_out`` and
    ``score_out`` (posterior probability, 0 to 1), which replace input columns
    of these names.

    The whole text is read. A NULL text or one without a letter is ``und`` with
    score 0, and so is every text when the model knows no language. Repeated
    rows are predicted each; an empty table gives no rows."""
    keep = [c for c in df.columns if keep is None or c in keep]
    keep = [c for c in keep if c not in (lang_out, score_out)]
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most BUCKETS x MAX_LANGUAGES numbers
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def run(batches):
        for b in batches:
            langs: list[str] = []
            scores: list[float] = []
            for part in lists(b.select(["__text"]), "__text"):
                got = score_texts(shared.value, part["__text"])
                langs += got[0]
                scores += got[1]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id's text modulo ``folds`` is ``fold`` (a NULL id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


__all__ = ["fit", "predict", "score_texts", "has_letter", "held_out"]
