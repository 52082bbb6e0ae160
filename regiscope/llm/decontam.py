"""Benchmark decontamination by greedy string tiling.

A benchmark item and a document are compared when they share a seed, a run of
``min_match`` tokens (a shorter item: all of it). A benchmark of at most
``BROADCAST_BYTES`` of text is broadcast, and a rolling (Karp-Rabin) hash of the
document's tokens is looked up among its seeds for all positions at once, inside
the task. The seeds of a larger one are joined by shuffle: each text gives the
hashes of its distinct seeds, documents only those that a bitmap of fixed size
says the benchmark may have; the pairs of texts that meet, each once however
many rows have them, fetch their texts and are tiled. The
shared runs of a pair are then tiled: the longest run of tokens not marked yet
is marked, again and again, until none of ``min_match`` tokens is left; a pair
with very many shared seeds is tiled from long to short windows by running
Karp-Rabin instead, which holds no pairs. The
share of the item's tokens under tiles is its coverage, so a passage with its
sentences in another order is caught as well.

Documents are read twice at most, whatever the benchmark's size, and nothing of
a benchmark beyond the bound reaches the driver but the bitmap.
"""

from __future__ import annotations

import heapq
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, lists, out_batch, store

#: Bytes of benchmark text up to which it is broadcast.
BROADCAST_BYTES = 8 << 20
#: Bits of the bitmap of a larger benchmark's seeds (16 MB). With more seeds
#: than that it lets more of the documents' seeds through to the join.
FILTER_BITS = 1 << 27
MIN_MATCH = 5
#: Shared seeds of one document and one item that are held at once; beyond them
#: the pair is tiled by ``tile_rolling``.
PAIRS = 200_000
COVERAGE = 0.5
_BASE = 0x9E3779B97F4A7C15
#: ASCII characters that are neither letters nor digits separate tokens.
_TO_SPACE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
#: Letters of scripts written without spaces (Thai, Lao, Tibetan, Myanmar,
#: Khmer, ideographs, kana, Bopomofo, Yi), with their marks.
_ALONE = re.compile(
    "[\u0e00-\u0e4e\u0e80-\u0ecf\u0edc-\u0edf\u0f00-\u0f1f\u0f34-\u0fff\u1000-\u103f\u1050-\u108f\u109a-\u109f\u1780-\u17df\u2e80-\u2fdf"
    "\u3005-\u3007\u3021-\u309f\u30a0-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\uf900-\ufaff\uff66-\uff9f"
    "\U00016fe0-\U0001b2ff\U00020000-\U0003fffd]").match
_JOINERS = "\u200c\u200d"


class _Spaced(dict):
    """Code point -> what str.translate puts for it: itself inside a word, a
    token of its own between spaces, or a space."""

    def __missing__(self, point: int):
        c = chr(point)
        inside = c.isalnum() or unicodedata.category(c)[0] == "M" or c in _JOINERS
        got = self[point] = (f" {c} " if _ALONE(c) else point) if inside else " "
        return got


_SPACED = _Spaced()


def words(text: str | None) -> list[bytes]:
    """Lower-cased tokens between ASCII characters that are not alphanumeric."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split() if text else []


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and their marks; each character of a
    script written without spaces is a token of its own, all others separate."""
    if not text or text.isascii():
        return words(text)
    return text.lower().translate(_SPACED).encode().split()


def rolling(ids, n: int):
    """Karp-Rabin hash of every run of ``n`` ids."""
    import numpy as np
    m = len(ids) - n + 1
    h = np.zeros(max(m, 0), np.uint64)
    for i in range(n if m > 0 else 0):
        h = h * np.uint64(_BASE) + ids[i:i + m]
    return h


class Seeds:
    """The seeds of some items. An item of fewer than
    ``min_match`` tokens is one seed of its own length."""

    def __init__(self, items: list[tuple], min_match: int):
        import numpy as np
        self.keys = [k for k, _ in items]
        words = [tokens(t) for _, t in items]
        self.number: dict[bytes, int] = {}
        for w in words:
            for x in w:
                self.number.setdefault(x, len(self.number) + 1)
        self.ids = [np.array([self.number[x] for x in w], np.uint64) for w in words]
        self.least = [min(min_match, len(x)) for x in self.ids]
        self.tables = []
        for n in sorted(set(self.least) - {0}):
            mine = [i for i, k in enumerate(self.least) if k == n]
            runs = [rolling(self.ids[i], n) for i in mine]
            hashes = np.concatenate(runs)
            item = np.repeat(np.array(mine), [len(r) for r in runs])
            place = np.concatenate([np.arange(len(r)) for r in runs])
            by = np.argsort(hashes, kind="stable")
            self.tables.append((n, hashes[by], item[by], place[by]))

    def shared(self, text: str | None):
        """Ids of the document's tokens (0: not in the benchmark), and per item
        that shares a seed (item, places in item, places in document), or
        (item, None, None) where the two have more than ``PAIRS`` shared seeds."""
        import numpy as np
        get = self.number.get
        ids = np.array([get(x, 0) for x in tokens(text)], np.uint64)
        known = np.cumsum(np.concatenate([[0], ids == 0]))
        out = []
        for n, hashes, items, places in self.tables:
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] == known[:-n])  # runs of benchmark words only
            if not len(at):
                continue
            h, which, times = np.unique(rolling(ids, n)[at], return_inverse=True, return_counts=True)
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            hit = hi > lo
            if not hit.any():
                continue
            # each seed at most once: how many pairs an item has with the document
            post = _ranges(lo[hit], (hi - lo)[hit])
            pairs = np.bincount(items[post], np.repeat(times[hit], (hi - lo)[hit]), minlength=len(self.ids))
            few = (pairs > 0) & (pairs <= PAIRS)
            out += [(int(k), None, None) for k in np.flatnonzero(pairs > PAIRS)]
            keep = few[items[post]]
            if not keep.any():
                continue
            seed = np.repeat(np.flatnonzero(hit), (hi - lo)[hit])[keep]
            post = post[keep]
            by = np.argsort(items[post], kind="stable")  # by item: the pairs of one item at a time
            seed, post = seed[by], post[by]
            order = np.argsort(which, kind="stable")
            start = np.concatenate([[0], np.cumsum(times)])
            ends = np.concatenate([np.flatnonzero(np.diff(items[post])) + 1, [len(post)]])
            a = 0
            for e in ends.tolist():
                d = at[order[_ranges(start[seed[a:e]], times[seed[a:e]])]]
                out.append((int(items[post[a]]), np.repeat(places[post[a:e]], times[seed[a:e]]), d))
                a = e
        return ids, out


def _ranges(lo, n):
    """The numbers lo[i] .. lo[i] + n[i] - 1 of all i, one after the other."""
    import numpy as np
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


class _Windows:
    """Karp-Rabin hashes of the windows of any length of an id sequence, from
    one pass over it."""

    def __init__(self, ids):
        import numpy as np
        n = len(ids)
        one = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):  # modulo 2**64
            self.up = np.cumprod(np.concatenate([one, np.full(n, _BASE, np.uint64)]))
            down = np.cumprod(np.concatenate([one, np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)]))
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * down[:-1])])

    def hashes(self, at, n: int):
        import numpy as np
        with np.errstate(over="ignore"):
            return (self.sums[at + n] - self.sums[at]) * self.up[at]


def _free_windows(marked, n: int):
    """Starts of the windows of n tokens without a marked one."""
    import numpy as np
    if len(marked) < n:
        return np.zeros(0, np.int64)
    known = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(known[n:] == known[:-n])


def tile_rolling(own, ids, n: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling by running Karp-Rabin, in memory in proportion to
    item and document however often they repeat themselves: the greatest length
    at which unmarked windows of both agree is found by bisection, the tiles of
    that length are marked from the front (first in the item, then in the
    document), and so on down to ``n``."""
    import numpy as np
    a, b = _Windows(own), _Windows(ids)
    in_item, in_doc = np.zeros(len(own), bool), np.zeros(len(ids), bool)
    in_doc[ids == 0] = True  # no benchmark word
    tiles: list[tuple[int, int, int]] = []

    def common(k: int):
        p, t = _free_windows(in_item, k), _free_windows(in_doc, k)
        if not len(p) or not len(t):
            return p[:0], t[:0], p[:0], t[:0]
        hp, ht = a.hashes(p, k), b.hashes(t, k)
        keep_p, keep_t = np.isin(hp, ht), np.isin(ht, hp)
        return p[keep_p], t[keep_t], hp[keep_p], ht[keep_t]

    top = min(len(own), len(ids))
    while top >= n:
        low, high = n - 1, top
        while low < high:
            mid = (low + high + 1) // 2
            if len(common(mid)[0]):
                low = mid
            else:
                high = mid - 1
        if low < n:
            break
        p, t, hp, ht = common(low)
        by = np.lexsort((t, ht))
        t, ht = t[by], ht[by]
        first = {h: [lo, hi] for h, lo, hi in zip(*(x.tolist() for x in (
            np.unique(ht), np.searchsorted(ht, np.unique(ht), "left"), np.searchsorted(ht, np.unique(ht), "right"))))}
        free_from = 0
        found = False
        for x, h in zip(p.tolist(), hp.tolist()):
            if x < free_from:  # tiles of one length are laid from the front
                continue
            at = first[h]
            while at[0] < at[1]:
                y = int(t[at[0]])
                if in_doc[y] or in_doc[y + low - 1]:  # marked since: tiles of this length cover an end
                    at[0] += 1
                    continue
                if not np.array_equal(own[x:x + low], ids[y:y + low]):  # equal hash, other tokens
                    at[0] += 1
                    continue
                in_item[x:x + low] = True
                in_doc[y:y + low] = True
                tiles.append((low, x, y))
                free_from, found = x + low, True
                at[0] += 1
                break
        top = low if found else low - 1
        if found and not len(common(low)[0]):
            top = low - 1
    return tiles


def runs(p, t, n: int) -> list[tuple[int, int, int]]:
    """Maximal common runs (length, place in item, place in document) from the
    places of shared seeds: consecutive seeds on one diagonal are one run."""
    import numpy as np
    by = np.lexsort((p, t - p))
    p, t = p[by], t[by]
    cut = np.concatenate([[True], (np.diff(t - p) != 0) | (np.diff(p) != 1)])
    first = np.flatnonzero(cut)
    last = np.concatenate([first[1:], [len(p)]]) - 1
    return list(zip((p[last] - p[first] + n).tolist(), p[first].tolist(), t[first].tolist()))


def tile(found: list[tuple[int, int, int]], n: int, item_len: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: mark the longest unmarked match (ties: first in
    the item, then in the document) until none of ``n`` tokens is left."""
    heap = [(-length, p, t) for length, p, t in found]
    heapq.heapify(heap)
    in_item = bytearray(item_len)
    in_doc: set[int] = set()
    tiles = []
    while heap:
        length, p, t = heapq.heappop(heap)
        length = -length
        free = [not in_item[p + i] and (t + i) not in in_doc for i in range(length)]
        if all(free):
            in_item[p:p + length] = b"\x01" * length
            in_doc.update(range(t, t + length))
            tiles.append((length, p, t))
            if sum(in_item) > item_len - n:
                break
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= n:
                    heapq.heappush(heap, (start - i, p + start, t + start))
                start = None
    return tiles


def compare(seeds: Seeds, text: str | None):
    """(item number, covered tokens, tiles) for each item that shares a seed."""
    import numpy as np
    ids, shared = seeds.shared(text)
    for k, p, t in shared:
        own, n = seeds.ids[k], seeds.least[k]
        if p is None:
            tiles = tile_rolling(own, ids, n)
        else:
            # equal hash, equal tokens: checked on the runs
            found = [r for r in runs(p, t, n) if np.array_equal(own[r[1]:r[1] + r[0]], ids[r[2]:r[2] + r[0]])]
            tiles = tile(found, n, len(own))
        if tiles:
            yield k, sum(x[0] for x in tiles), tiles


def seed_hashes(words: list[bytes], n: int):
    """Signed 64-bit hashes of the distinct runs of ``n`` tokens, equal in every
    task, the length told apart."""
    import numpy as np
    import xxhash
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        h = (rolling(ids, n) + np.uint64(n)) * np.uint64(_BASE)
    return np.unique(h ^ (h >> np.uint64(32))).view(np.int64)


def _bit(h):
    """The place of a hash in the bitmap, by its top bits."""
    return F.shiftrightunsigned(h, 64 - FILTER_BITS.bit_length() + 1)


def _candidates(docs: DataFrame, items: DataFrame, min_match: int) -> DataFrame:
    """``d, i``: the digests of the document and item texts that share the hash
    of a seed, from (d, t) and (i, t)."""
    spark = docs.sparkSession

    def of_items(batches):
        fields = [("i", pa.binary()), ("n", pa.int32()), ("h", pa.int64())]
        for b in batches:
            for part in lists(b, "t"):
                for key, text in zip(part["i"], part["t"]):
                    w = tokens(text)
                    n = min(min_match, len(w))
                    if n:
                        h = seed_hashes(w, n)
                        yield out_batch(fields, ([key] * len(h), [n] * len(h), h))

    seeds = store(items.mapInArrow(of_items, "i binary, n int, h long"), "decontam-seeds")
    lengths = sorted(r[0] for r in seeds.select("n").distinct().collect())  # at most min_match numbers
    at = _bit(F.col("h")) + 1
    pages = seeds.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = bytearray(FILTER_BITS // 8)
    for page, got in pages.toLocalIterator():  # FILTER_BITS in all
        bits[(page - 1) * len(got):page * len(got)] = got
    shared = spark.sparkContext.broadcast(bytes(bits))

    def of_docs(batches):
        import numpy as np
        known = np.frombuffer(shared.value, np.uint8)
        shift = np.uint64(64 - FILTER_BITS.bit_length() + 1)
        for b in batches:
            for part in lists(b, "t"):
                for key, text in zip(part["d"], part["t"]):
                    w = tokens(text)
                    for n in lengths:
                        if len(w) < n:
                            continue
                        h = seed_hashes(w, n)
                        place = (h.view(np.uint64) >> shift).astype(np.int64)
                        h = h[(known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
                        if len(h):
                            yield out_batch([("d", pa.binary()), ("h", pa.int64())], ([key] * len(h), h))

    return (docs.mapInArrow(of_docs, "d binary, h long").join(seeds.select("i", "h"), "h")
            .select("d", "i").distinct())


def _by_shuffle(docs: DataFrame, bench: DataFrame, min_match: int, coverage: float, found: T.StructType) -> DataFrame:
    """``id, k`` and the columns of ``found`` for every pair of ``docs`` (id, t)
    and ``bench`` (k, t) with a tile, by a shuffle join of their seeds."""
    key = F.unhex(F.sha2(F.col("t").cast("binary"), 256))
    docs, bench = (x.where(F.col("t").isNotNull()).withColumn(c, key) for x, c in ((docs, "d"), (bench, "i")))
    items = store(bench.groupBy("i").agg(F.first("t").alias("t")), "decontam-items")
    pairs = store(_candidates(docs.select("d", "t"), items, min_match), "decontam-pairs")
    texts = docs.join(pairs.select("d").distinct(), "d", "left_semi").groupBy("d").agg(F.first("t").alias("t"))
    both = (pairs.join(items.withColumnRenamed("t", "it"), "i").join(texts, "d")).select("d", "i", "t", "it")
    fields = [("d", pa.binary()), ("i", pa.binary()), *zip(found.names, _FOUND)]

    def tiled(doc, text, own):
        seeds = Seeds(own, min_match)
        rows = [(doc, *x) for x in _rows(seeds, text, coverage)]
        if rows:
            yield out_batch(fields, list(zip(*rows)))

    def run(batches):
        now, text, own, held = None, None, [], 0
        for b in batches:
            for part in lists(b, "t"):
                for d, i, t, it in zip(part["d"], part["i"], part["t"], part["it"]):
                    if d != now or held > CHUNK_BYTES:  # items of one document that come together are one look-up
                        if own:
                            yield from tiled(now, text, own)
                        now, text, own, held = d, t, [], 0
                    own.append((i, it))
                    held += len(it)
        if own:
            yield from tiled(now, text, own)

    got = both.mapInArrow(run, T.StructType([T.StructField("d", T.BinaryType()), T.StructField("i", T.BinaryType()), *found]))
    return got.join(docs.select("id", "d"), "d").join(bench.select("k", "i"), "i").drop("d", "i")


def _rows(seeds: Seeds, text: str | None, coverage: float):
    """(item key, then the columns of a result row) per item with a tile."""
    for k, n, tiles in compare(seeds, text):
        total = len(seeds.ids[k])
        yield (seeds.keys[k], total, n, n / total, [dict(zip(("length", "item_start", "doc_start"), x)) for x in tiles],
               n >= coverage * total)


def _by_broadcast(docs: DataFrame, bench: DataFrame, min_match: int, coverage: float, found: T.StructType) -> DataFrame:
    """The same where the whole benchmark goes to every task."""
    shared = docs.sparkSession.sparkContext.broadcast([(r["k"], r["t"]) for r in bench.orderBy("k", "t").collect()])
    schema = T.StructType([docs.schema["id"], bench.schema["k"], *found])

    def run(batches):
        seeds = Seeds(shared.value, min_match)
        for b in batches:
            for part in lists(b, "t"):
                rows = [(key, *x) for key, text in zip(part["id"], part["t"]) for x in _rows(seeds, text, coverage)]
                if rows:
                    kinds = [_arrow(schema["id"].dataType), _arrow(schema["k"].dataType), *_FOUND]
                    yield out_batch(list(zip(schema.names, kinds)), list(zip(*rows)))

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
                  coverage: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every pair of a document and an item with a tile: ``id_col, item_col,
    item_tokens, covered, coverage, tiles, contaminated``; ``tiles`` are
    (length, item_start, doc_start) in tokens, ``contaminated`` means that the
    tiles cover at least the share ``coverage`` of the item.

    Both sides are cut by ``tokens``. NULL and empty texts have no tile and so
    no row; an item of fewer than ``min_match`` tokens is found where all of it
    stands in one piece. Texts that repeat themselves without end are tiled in
    memory in proportion to their length. Repeated documents and repeated items give a row each.
    A benchmark of more than ``broadcast_bytes`` is joined by shuffle, with the same rows.
    Other columns are not read; an empty table on either side gives no rows."""
    bench = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_col).alias("k"), F.col(item_text).alias("t"))
    size = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    found = T.StructType([
        T.StructField("item_tokens", T.LongType()), T.StructField("covered", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("tiles", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("length", "item_start", "doc_start")]))),
        T.StructField("contaminated", T.BooleanType())])
    way = _by_broadcast if size <= broadcast_bytes else _by_shuffle
    rows = way(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), bench, min_match, coverage, found)
    return rows.select(F.col("id").alias(id_col), F.col("k").alias(item_col), *found.names)


_FOUND = [pa.int64(), pa.int64(), pa.float64(),
          pa.list_(pa.struct([("length", pa.int64()), ("item_start", pa.int64()), ("doc_start", pa.int64())])), pa.bool_()]


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


__all__ = ["contamination", "seed_hashes", "tokens", "words", "tile", "runs", "Seeds", "compare"]
