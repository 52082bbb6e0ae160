"""Hard negatives of anchors among labelled vectors.

1. Rows are packed into blocks, anchors into smaller ones. Each block of rows
   meets each block of anchors once by an equi-join on the rows' part, to which
   the anchors' blocks are sent; scores are integer inner products, exact in
   double precision below 2**53 and computed with Python's integers beyond.
2. A first pass keeps each anchor's best rows of its own label, per pair of
   blocks and then over all (a group limit before and after the shuffle): its
   positives. Their scores open the windows in which negatives count.
3. A second pass keeps, per pair of blocks, the best rows of other labels in
   each window: a row of the result is always among them, and what is shuffled
   is a few rows for each pair of an anchor and a block, not all pairs.
4. Secondary sort: the scores are shuffled by anchor and sorted inside
   partitions by (anchor, descending score, positives first, id). A streaming
   iterator opens a window at every positive and emits negatives to the open
   windows, of which there are never more than ``positives``; no anchor's rows
   are materialised.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import out_batch, store

#: Vector components of a block of rows and of a block of anchors.
ROW_BLOCK, ANCHOR_BLOCK = 1 << 18, 1 << 16
#: A part of the rows is one block until there are this many parts, then up to 16 blocks.
PARTS = 256
_BLOCK = ("ids array<long>, labels array<long>, width int, wide boolean, data binary, "
          "tops array<array<long>>")


def _rows(df: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    i, v, g = (F.col(f"`{c}`") for c in (id_col, vector, label))
    # 0 * x is 0 for a finite x and NULL or NaN otherwise
    clean = F.forall(v, lambda x: F.coalesce(x.cast("double") * 0 == 0, F.lit(False)))
    rows = df.where(i.isNotNull() & g.isNotNull() & v.isNotNull()).where(clean).select(
        i.cast("bigint").alias("id"), g.cast("bigint").alias("label"),
        F.transform(v, lambda x: x.cast("double")).alias("vector"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector")


def _packed(rows: DataFrame, limit: int, scale: int) -> DataFrame:
    """Blocks of rows of one vector length, in the order of id."""
    fields = [("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("width", pa.int32()),
              ("wide", pa.bool_()), ("data", pa.binary()), ("tops", pa.list_(pa.list_(pa.int64())))]

    def run(batches):
        import numpy as np
        open_: dict[int, list] = {}
        held = 0

        def emit():
            for width, rows in sorted(open_.items()):
                rows.sort(key=lambda r: r[0])
                m = np.floor(np.array([r[2] for r in rows], np.float64).reshape(len(rows), width) * scale)
                wide = bool(m.size and np.abs(m).max() >= 1 << 31)
                data = m.tobytes() if wide else m.astype(np.int32).tobytes()
                yield out_batch(fields, ([[r[0] for r in rows]], [[r[1] for r in rows]], [width], [wide], [data],
                                         [[r[3] for r in rows]]))
            open_.clear()

        for b in batches:
            tops = b.column(3).to_pylist() if b.num_columns > 3 else [None] * b.num_rows
            for i, g, v, top in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), tops):
                v = v.values.to_numpy(zero_copy_only=False)
                open_.setdefault(len(v), []).append((i, g, v, top))
                held += len(v) + 16
                if held >= limit:
                    yield from emit()
                    held = 0
        yield from emit()

    return rows.mapInArrow(run, _BLOCK)


def _matrix(data: bytes, wide: bool, rows: int, width: int):
    import numpy as np
    return np.frombuffer(data, np.float64 if wide else np.int32).reshape(rows, width).astype(np.float64)


def products(a, b):
    """Integer inner products of the rows of ``a`` and ``b``; a shorter vector
    counts as ending in zeros. Beyond 64 bits it raises."""
    import numpy as np
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if not n:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * n < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = [[int(x) for x in r] for r in a.tolist()], [[int(x) for x in r] for r in b.tolist()]
    return np.array([[sum(x * y for x, y in zip(r, s)) for s in exact[1]] for r in exact[0]], np.int64)


def best(scores, mask, k: int) -> list:
    """Per row of ``scores`` the places of the k greatest where ``mask``, the
    first of equal ones first; as (row, place) arrays."""
    import numpy as np
    n = scores.shape[1]
    if n <= k:
        return np.nonzero(mask)
    if np.abs(scores).max(initial=0) < (1 << 62) // n:
        low = np.iinfo(np.int64).min
        key = np.where(mask, scores * n + (n - 1 - np.arange(n)), low)
        at = np.argpartition(key, n - k, axis=1)[:, n - k:]
        row, col = np.nonzero(np.take_along_axis(key, at, 1) > low)
        return row, at[row, col]
    rows, cols = [], []
    for i in range(len(scores)):
        c = np.flatnonzero(mask[i])
        c = c[np.argsort(-scores[i, c].astype(object), kind="stable")][:k]
        rows.append(np.full(len(c), i))
        cols.append(c)
    return np.concatenate(rows).astype(int), np.concatenate(cols).astype(int)


def _pairs(blocks: DataFrame, anchors: DataFrame, n_blocks: int, k: int, low: tuple[int, int] | None) -> DataFrame:
    """``anchor_id, score, id`` that may matter: without ``low`` the k best rows
    of the anchor's label, with it the k best others in each window."""
    parts = max(min(n_blocks, PARTS), -(-n_blocks // 16))
    rows = blocks.select(F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int").alias("part"),
                         "ids", "labels", "width", "wide", "data")
    to = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                        *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "width", "wide", "data", "tops")])
    fields = [("anchor_id", pa.int64()), ("score", pa.int64()), ("id", pa.int64())]

    def run(batches):
        import numpy as np
        for b in batches:
            for i in range(b.num_rows):
                ids, labels, width, wide, data, a_ids, a_labels, a_width, a_wide, a_data, tops = (
                    b.column(c)[i].as_py() for c in range(b.num_columns))
                ids, labels = np.array(ids, np.int64), np.array(labels, np.int64)
                a_ids, a_labels = np.array(a_ids, np.int64), np.array(a_labels, np.int64)
                s = products(_matrix(a_data, a_wide, len(a_ids), a_width), _matrix(data, wide, len(ids), width))
                same = a_labels[:, None] == labels[None, :]
                if low is None:
                    found = [best(s, same & (a_ids[:, None] != ids[None, :]), k)]
                else:
                    found = []
                    for w in range(max(map(len, tops))):
                        high = np.array([t[w] if w < len(t) else -1 for t in tops], np.int64)
                        floor = np.array([-(-low[0] * int(h) // low[1]) for h in high], np.int64)
                        inside = ~same & (s <= high[:, None]) & (s >= floor[:, None]) & (high[:, None] >= 0)
                        found.append(best(s, inside, k))
                row, col = (np.concatenate(x).astype(np.int64) for x in zip(*found))
                if len(row):
                    one = np.unique(row * len(ids) + col)
                    row, col = one // len(ids), one % len(ids)
                    yield out_batch(fields, (a_ids[row], s[row, col], ids[col]))

    return rows.join(to, "part").drop("part").mapInArrow(run, "anchor_id long, score long, id long")


def _emit(pairs: DataFrame, negatives: int, low: tuple[int, int]) -> DataFrame:
    """The streaming iterator over (anchor, descending score, positives first, id)."""
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def run(batches):
        now, windows = None, []
        for b in batches:
            out = []
            for a, s, other, i in zip(*(b.column(c).to_pylist() for c in range(4))):
                if a != now:
                    now, windows = a, []
                if not other:
                    if s >= 0:
                        windows.append([i, s, 0])
                    continue
                windows = [w for w in windows if w[2] < negatives and low[0] * w[1] <= low[1] * s]
                for w in windows:
                    w[2] += 1
                    out.append((a, w[0], w[2], i, w[1], s))
            if out:
                yield out_batch(list(zip(names, kinds)), list(zip(*out)))

    keys = ["anchor_id", F.desc("score"), "other", "id"]
    return pairs.repartition("anchor_id").sortWithinPartitions(*keys).select("anchor_id", "score", "other", "id").mapInArrow(
        run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.

    Vectors become integers, floor(scale * x). A row's score is its inner
    product with the anchor; higher scores come first, ties by smaller id.
    An anchor (``is_anchor``, a condition on a column ``id``) has its first
    ``positives`` other rows of its label as positives; for each, the first
    ``negatives`` rows of other labels with low[0] * positive_score <= low[1] *
    negative_score and negative_score <= positive_score are returned, ranked
    from 1. A positive of a negative score has none.

    Rows with a NULL id, label, vector or component, or a component that is
    not finite, take no part. Repeated rows count once; of different rows that
    share an id the least (label, vector) takes part. A vector that is shorter
    than the anchor's counts as ending in zeros, an empty one scores 0. Other
    columns are not read; an empty table, or one without anchors, gives no
    rows. Scores beyond 64 bits raise."""
    rows = store(_rows(df, id_col, vector, label), "negatives-rows")
    blocks = store(_packed(rows, ROW_BLOCK, scale), "negatives-blocks")
    n_blocks = max(blocks.count(), 1)
    anchors = rows.where(is_anchor)
    near = _pairs(blocks, _packed(anchors, ANCHOR_BLOCK, scale), n_blocks, positives, None)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    chosen = store(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives).drop("k"),
                   "negatives-positives")
    tops = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list("score"), False).alias("tops"))
    windows = anchors.join(tops.where("tops[0] >= 0"), "id").select("id", "label", "vector", "tops")
    far = _pairs(blocks, _packed(windows, ANCHOR_BLOCK, scale), n_blocks, negatives, low)
    return _emit(chosen.withColumn("other", F.lit(0)).unionByName(far.withColumn("other", F.lit(1))), negatives, low)
