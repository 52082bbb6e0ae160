"""Exact Jaccard join of word-shingle sets with set-relation skipping.

1. Every task reads whole texts, emits size and digest of each shingle set, and
   counts its shingles in a fixed table of ``SKETCH`` counters. The summed
   table orders all shingles, rare ones first; any order gives right results,
   this one keeps index lists short.
2. Sets x and y that are linked share min(a, b) shingles of their prefixes, the
   first n - ceil(t n) + a shingles of x and m - ceil(t m) + b of y in that
   order; a is ``least_shared(n)``, about n / ``EXTRA``. The prefixes form the
   distributed index. A set leaves it when fewer of its shingles than a link
   takes stand in a list with another set whose size allows a link, and so on
   until few leave: in a large corpus every set shares a few shingles with
   unlinked ones, and their chains would join most sets in one group. Of what
   is left a list is read in the order of set size, and sets whose sizes allow
   a link are chained. A list longer than 1/1,000 of the documents by its
   counter is dealt over ``SALTS`` lists, whose heads are chained too.
   Components of the chains are the candidate groups.
3. Each set travels to its group; a bitmap of fixed size keeps texts that no
   group holds inside their task. Inside, sets are joined exactly
   (``join_sets``): index lists hold blocks of equal set size, sorted by the
   shingle's position, so a block, or the rest of one, is skipped when the
   position leaves too little for a link; and the answers of a set that is
   highly similar to one already answered are derived from those answers, by
   the shingles in which the two differ.
4. A group beyond ``GROUP_SETS`` sets or ``GROUP_SHINGLES`` shingles is split by
   classes of size (linked sets lie in the same class or adjacent ones) and
   then into chunks; every two chunks of such classes meet in one task. What
   leaves it are numbers of links and a spanning forest, never all pairs.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch, release, store
from .components import connected_components
from .minhash import shingle_set

#: Counters of the order of shingles, and the rows their table travels in.
SKETCH, SKETCH_ROWS = 1 << 22, 16
#: Lists that a list longer than 1/1,000 of the documents, and than
#: ``DEALT_FROM``, is dealt over.
SALTS, DEALT_FROM = 64, 1000
#: A prefix holds 1/``EXTRA`` of a set more than one shared shingle takes.
EXTRA = 20
#: The index is narrowed again while a round leaves less than this part of it.
FEW_LEAVE = (3, 4)
#: Sets and shingles that meet in one task.
GROUP_SETS, GROUP_SHINGLES = 400, 1_000_000
#: A set of this similarity to an answered one gets its answers from there.
CLOSE = (9, 10)
#: Bits of the bitmap of the texts that travel to a group (8 MB).
WANTED_BITS = 1 << 26
#: Sets a task remembers to have indexed already.
_SEEN = 200_000


def _digest(s) -> bytes:
    import hashlib
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _bucket(s):
    import numpy as np
    return (s >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("__h"),
                     F.col(f"`{text_col}`").alias("__text"))


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """``id, __h, n_shingles, set_id, s`` per row (``set_id`` and its first 64
    bits NULL for an empty set), and ``part, counts``: the counters of a task."""
    schema = T.StructType([T.StructField("id", texts.schema["__id"].dataType), T.StructField("__h", T.LongType()),
                           T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
                           T.StructField("s", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        import zlib

        import numpy as np
        counts = fields = None
        for b in batches:
            fields = [("id", b.schema.field(0).type), ("__h", pa.int64()), ("n_shingles", pa.int64()),
                      ("set_id", pa.binary()), ("s", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())]
            for rows in lists(b, "__text"):
                sets = [shingle_set(t, k) for t in rows["__text"]]
                if counts is None:
                    counts = np.zeros(SKETCH, np.uint32)
                found = _bucket(np.concatenate(sets))
                at, n = np.unique(found, return_counts=True)
                counts[at] += n.astype(np.uint32)
                none = [None] * len(sets)
                ids = [_digest(s) if len(s) else None for s in sets]
                yield out_batch(fields, (rows["__id"], rows["__h"], [len(s) for s in sets], ids,
                                         [d and _short(d) for d in ids], none, none))
        if counts is not None:
            for i, part in enumerate(np.split(counts, SKETCH_ROWS)):
                yield out_batch(fields, ([None], [None], [None], [None], [None], [i], [zlib.compress(part.tobytes(), 1)]))

    return texts.mapInArrow(run, schema)


def _order(sig: DataFrame):
    """The summed counters (of fixed size, so collected)."""
    import numpy as np

    def add(batches):
        import zlib

        sums: dict = {}
        for b in batches:
            for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = np.frombuffer(zlib.decompress(c), np.uint32)
                sums[i] = sums[i] + got if i in sums else got.astype(np.int64)
        if sums:
            yield out_batch([("part", pa.int32()), ("counts", pa.binary())],
                            (list(sums), [np.minimum(s, 0xFFFFFFFF).astype(np.uint32).tobytes() for s in sums.values()]))

    rows = sig.where("part IS NOT NULL").select("part", "counts").repartition("part").mapInArrow(add, "part int, counts binary")
    out = np.zeros(SKETCH, np.uint32)
    each = SKETCH // SKETCH_ROWS
    for r in rows.collect():
        out[r["part"] * each:(r["part"] + 1) * each] = np.frombuffer(r["counts"], np.uint32)
    return out


def prefix_length(n, num: int, den: int):
    """Shingles of a set of n of which a linked set must share one."""
    return n - -(-num * n // den) + 1


def least_shared(n):
    """Shingles that the prefixes of a set of n and of a linked one of no fewer
    share, with a prefix longer by ``least_shared(n) - 1``."""
    return 1 + n // EXTRA


def _index(texts: DataFrame, k: int, num: int, den: int, counts, hot: float) -> DataFrame:
    """``token, salt, s, n``: the prefix of every set; salt -1 for a list that
    is not dealt."""
    held = texts.sparkSession.sparkContext.broadcast(counts)
    fields = [("token", pa.int64()), ("salt", pa.int32()), ("s", pa.int64()), ("n", pa.int32())]

    def run(batches):
        import numpy as np
        seen: set[bytes] = set()
        order = held.value
        for b in batches:
            for rows in lists(b, "__text"):
                cols: list[list] = [[], [], [], []]
                for t in rows["__text"]:
                    s = shingle_set(t, k)
                    if not len(s) or (d := _digest(s)) in seen:
                        continue
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(d)
                    c = order[_bucket(s)]
                    first = np.argsort(c, kind="stable")[:prefix_length(len(s), num, den) + least_shared(len(s)) - 1]
                    me = _short(d)
                    cols[0].append(s[first].view(np.int64))
                    cols[1].append(np.where(c[first] > hot, me % SALTS, -1))
                    cols[2].append(np.full(len(first), me))
                    cols[3].append(np.full(len(first), len(s)))
                if cols[0]:
                    yield out_batch(fields, [np.concatenate(c) for c in cols])

    return texts.select("__text").mapInArrow(run, "token long, salt int, s long, n int")


def _in_company(index: DataFrame, num: int, den: int) -> DataFrame:
    """The distinct rows of ``index`` in whose list stands another set of a
    size that allows a link; of a dealt list all."""
    w = Window.partitionBy("token", "salt").orderBy("n", "s")
    n, s = F.col("n").cast("long"), F.col("s")
    around = index.withColumns({"p": F.lag("s").over(w), "m": F.lag("n").over(w),
                                "q": F.lead("s").over(w), "o": F.lead("n").over(w)})
    before = (F.col("p") != s) & (F.col("m").cast("long") * den >= n * num)
    after = (F.col("q") != s) & (n * den >= F.col("o").cast("long") * num)
    return around.where((F.col("salt") >= 0) | before | after).select(*index.columns).dropDuplicates()


def _narrowed(index: DataFrame, num: int, den: int) -> DataFrame:
    """The index without sets that share too little to be linked (see the
    module's text, 2)."""
    index = store(_in_company(index, num, den), "jaccard-index")
    left = index.count()
    # a linked set has ceil(t n) shingles or more
    least = F.expr(f"1 + ((n * {num}L + {den - 1}) div {den}) div {EXTRA}")
    while True:
        able = index.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("n").cast("long").alias("n")).where(
            F.col("c") >= least).select("s")
        index = store(_in_company(index.join(able, "s", "left_semi"), num, den), "jaccard-index")
        before, left = left, index.count()
        if FEW_LEAVE[1] * left >= FEW_LEAVE[0] * before:
            return index


def _chains(index: DataFrame, num: int, den: int) -> DataFrame:
    """``src, dst``: neighbours in the index lists, in the order of size."""
    w = Window.partitionBy("token", "salt").orderBy("n", "s")
    near = index.withColumn("p", F.lag("s").over(w)).withColumn("m", F.lag("n").over(w))
    head = F.col("p").isNull() & (F.col("salt") >= 0)
    fits = (F.col("p") != F.col("s")) & ((F.col("salt") >= 0) | (F.col("m") * den >= F.col("n") * num))
    near = store(near.where(head | fits).select("s", "p", F.when(head, F.col("token")).alias("token"), "salt"), "jaccard-chains")
    heads = near.where("p IS NULL").withColumn("p", F.lag("s").over(Window.partitionBy("token").orderBy("salt")))
    return near.unionByName(heads).where("p IS NOT NULL").select(F.col("s").alias("src"), F.col("p").alias("dst"))


def _ranges(lo, n):
    """The numbers lo[i] .. lo[i] + n[i] - 1 of all i, one after the other."""
    import numpy as np
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


class _Index:
    """The sets of one task and their prefix index for num / den."""

    def __init__(self, sets: list, num: int, den: int):
        import numpy as np
        self.num, self.den = num, den
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        owner = np.repeat(np.arange(len(sets)), self.size)
        _, number, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(df), np.int64)
        rank[np.argsort(df, kind="stable")] = np.arange(len(df))  # rare shingles first
        self.token = rank[number]
        by = np.lexsort((self.token, owner))
        self.token = self.token[by]  # owner[by] is owner: rows are grouped by it already
        place = np.arange(len(owner)) - self.start[owner]
        by = np.argsort(self.token, kind="stable")
        self.post_owner, self.post = owner[by], np.searchsorted(self.token[by], np.arange(len(df) + 1))
        size = self.size[owner]
        few = np.flatnonzero(place < prefix_length(size, num, den))
        few = few[np.lexsort((place[few], size[few], self.token[few]))]
        token, self.owner, size, self.place = self.token[few], owner[few], size[few], place[few]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] != size[:-1])])
        self.block = np.flatnonzero(new)  # blocks: one shingle, one set size
        self.block_size, block_token = size[self.block], token[self.block]
        self.blocks_of = np.searchsorted(block_token, np.arange(len(df) + 1))
        self.wide = int(self.size.max()) + 1
        self.key = (np.cumsum(new) - 1) * self.wide + self.place

    def tokens(self, x: int):
        return self.token[self.start[x]:self.start[x + 1]]

    def candidates(self, x: int):
        """Sets that the index does not exclude as partners of x."""
        import numpy as np
        n = int(self.size[x])
        mine = self.tokens(x)[:prefix_length(n, self.num, self.den)]
        many = self.blocks_of[mine + 1] - self.blocks_of[mine]
        block = _ranges(self.blocks_of[mine], many)
        at = np.repeat(np.arange(len(mine)), many)
        m = self.block_size[block]
        need = -(-self.num * (n + m) // (self.num + self.den))
        some = (m * self.den >= self.num * n) & (n * self.den >= self.num * m) & (n - at >= need)
        block, m, need = block[some], m[some], need[some]
        lo = self.block[block]
        # places behind size - need leave too little: the rest of the block is skipped
        n_in = np.searchsorted(self.key, block * self.wide + m - need, "right") - lo
        got = np.unique(self.owner[_ranges(lo, n_in)])
        return got[got != x]

    def shared(self, x: int, others):
        """Shingles that x shares with each of the others."""
        import numpy as np
        if not len(others):
            return np.zeros(0, np.int64)
        mask = np.zeros(len(self.post) - 1, np.int64)
        mask[self.tokens(x)] = 1
        n = self.size[others]
        return np.add.reduceat(mask[self.token[_ranges(self.start[others], n)]], np.concatenate([[0], np.cumsum(n)[:-1]]))

    def derived(self, x: int, like: int, others, shared):
        """The same from what ``like`` shares: only shingles in one of the two
        sets x and like are looked up."""
        import numpy as np
        more = np.setdiff1d(self.tokens(x), self.tokens(like), assume_unique=True)
        less = np.setdiff1d(self.tokens(like), self.tokens(x), assume_unique=True)
        out = np.zeros(len(self.size), np.int64)
        for tokens, sign in ((more, 1), (less, -1)):
            if len(tokens):
                at = _ranges(self.post[tokens], self.post[tokens + 1] - self.post[tokens])
                out += sign * np.bincount(self.post_owner[at], minlength=len(out))
        return shared + out[others]


def join_sets(sets: list, num: int, den: int, weight=None, side=None):
    """Per set the weight of the sets it is linked with, and spanning links
    (i, j): den * |x & y| >= num * |x | y|. With ``side`` only sets of
    different sides are linked. Sets are sorted, distinct and not empty."""
    import numpy as np
    total = np.zeros(len(sets), np.int64)
    if len(sets) < 2:
        return total, []
    weight = np.ones(len(sets), np.int64) if weight is None else np.asarray(weight, np.int64)
    side = None if side is None else np.asarray(side)
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        if (side is None or side[0] != side[1]) and den * both >= num * (len(sets[0]) + len(sets[1]) - both):
            return weight[::-1].copy(), [(0, 1)]
        return total, []
    # 1 - similarity is a metric: an answer of a set of similarity c to x is at least num/den + c - 1 similar to x
    wide = num * CLOSE[1] - den * (CLOSE[1] - CLOSE[0]), den * CLOSE[1]
    index = _Index(sets, *(wide if wide[0] > 0 else (1, den * CLOSE[1])))
    root = np.arange(len(sets))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    links: list[tuple[int, int]] = []
    like: dict[int, int] = {}
    answers: dict[int, tuple] = {}
    for x in np.argsort(index.size, kind="stable").tolist():
        r = like.get(x)
        if r is None:
            others = index.candidates(x)
            shared = index.shared(x, others)
        else:
            others, shared = answers[r]
            others, shared = np.append(others, r), np.append(shared, index.size[r])
            shared = index.derived(x, r, others, shared)
            shared, others = shared[others != x], others[others != x]
        union = index.size[x] + index.size[others] - shared
        if r is None:
            some = index.den * shared >= index.num * union
            others, shared, union = others[some], shared[some], union[some]
            if wide[0] > 0:
                answers[x] = others, shared
                for y in others[CLOSE[1] * shared >= CLOSE[0] * union].tolist():
                    like.setdefault(y, x)
        hit = others[den * shared >= num * union]
        if side is not None:
            hit = hit[side[hit] != side[x]]
        total[x] = weight[hit].sum()
        for y in hit.tolist():
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((x, y))
    return total, links


def _joined(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``set_id, other, n`` from rows (key, side, set_id, copies, shingles):
    spanning links (n NULL) and weights of links (other NULL)."""
    fields = [("set_id", pa.binary()), ("other", pa.binary()), ("n", pa.int64())]

    def run(batches):
        import numpy as np
        now, ids, side, copies, sets = None, [], [], [], []

        def result():
            if len(ids) < 2:
                return
            total, links = join_sets(sets, num, den, copies, None if max(side) == 0 else side)
            at = np.flatnonzero(total).tolist()
            got = [(ids[i], None, int(total[i])) for i in at] + [(ids[i], ids[j], None) for i, j in links]
            if got:
                yield out_batch(fields, list(zip(*got)))

        for b in batches:
            for g, f, i, c, s in zip(*(b.column(k).to_pylist() for k in range(4)), b.column(4)):
                if g != now:
                    yield from result()
                    now, ids, side, copies, sets = g, [], [], [], []
                ids.append(i)
                side.append(f)
                copies.append(c)
                sets.append(s.values.to_numpy(zero_copy_only=False).view(np.uint64))
        yield from result()

    rows = rows.select("key", "side", "set_id", "copies", "shingles")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "set_id binary, other binary, n long")


def _held_by(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose hash may be in ``wanted``, by a bitmap (of
    fixed size, so collected)."""
    at = F.shiftrightunsigned("__h", 64 - WANTED_BITS.bit_length() + 1) + 1
    pages = wanted.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = bytearray(WANTED_BITS // 8)
    for page, got in pages.collect():
        bits[(page - 1) * len(got):page * len(got)] = got
    shared = texts.sparkSession.sparkContext.broadcast(bytes(bits))
    shift = 64 - WANTED_BITS.bit_length() + 1

    def run(batches):
        import numpy as np
        known = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            place = (b.column(0).to_numpy().view(np.uint64) >> np.uint64(shift)).astype(np.int64)
            some = b.filter(pa.array((known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
            if some.num_rows:
                yield some
            release()

    texts = texts.select("__h", "__text")
    return texts.mapInArrow(run, texts.schema)


def _members(texts: DataFrame, k: int) -> DataFrame:
    fields = [("grp", pa.int64()), ("large", pa.bool_()), ("set_id", pa.binary()), ("copies", pa.int64()),
              ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))]

    def run(batches):
        import numpy as np
        for b in batches:
            for part in lists(b, "__text"):
                rows = []
                for g, big, i, c, t in zip(part["grp"], part["large"], part["set_id"], part["copies"], part["__text"]):
                    s = shingle_set(t, k)
                    if _digest(s) == i:  # not another text of equal hash
                        rows.append((g, big, i, c, len(s), s.view(np.int64)))
                if rows:
                    yield out_batch(fields, list(zip(*rows)))

    return texts.select("grp", "large", "set_id", "copies", "__text").mapInArrow(
        run, "grp long, large boolean, set_id binary, copies long, n long, shingles array<long>")


def _chunked(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Rows for ``_joined`` of groups of any size (see the module's text, 4)."""
    width = math.log(den / num) * 1.0001  # a little wider, so that rounding never parts linked sets by two classes
    sets = sets.withColumn("c", F.floor(F.log("n") / F.lit(width)).cast("int"))
    size = sets.groupBy("grp", "c").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / GROUP_SETS, F.sum("n") / GROUP_SHINGLES)).cast("int").alias("chunks"))
    around = size.select("grp", "c", "chunks").join(
        size.select("grp", (F.col("c") - 1).alias("c"), F.col("chunks").alias("up")), ["grp", "c"], "left").join(
        size.select("grp", (F.col("c") + 1).alias("c"), F.col("chunks").alias("down")), ["grp", "c"], "left")
    me = F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("chunks")).cast("int")

    def keys(c, i, d, j):
        return F.struct(F.col("grp").alias("grp"), c.alias("c"), i.alias("i"), d.alias("d"), j.alias("j"))

    def upto(n):
        return F.when(F.coalesce(F.col(n), F.lit(0)) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(
            F.array().cast("array<int>"))

    c, i = F.col("c"), F.col("i")
    same = F.transform(upto("chunks"), lambda j: F.struct(
        keys(c, F.least(i, j), c, F.greatest(i, j)).alias("key"), F.when(i > j, 1).when(i < j, 2).otherwise(0).alias("side")))
    up = F.transform(upto("up"), lambda j: F.struct(keys(c, i, c + 1, j).alias("key"), F.lit(1).alias("side")))
    down = F.transform(upto("down"), lambda j: F.struct(keys(c - 1, j, c, i).alias("key"), F.lit(2).alias("side")))
    return sets.join(around, ["grp", "c"]).withColumn("i", me).select(
        F.explode(F.concat(same, up, down)).alias("x"), "set_id", "copies", "shingles").select(
        F.to_json("x.key").alias("key"), "x.side", "set_id", "copies", "shingles")


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                 similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``id_col, n_shingles, component_id, n_links`` for every row of ``df``.

    Rows are linked when den * |x & y| >= num * |x | y| for their sets of
    distinct k-word shingles, ``similarity = (num, den)``. ``component_id`` is
    the least id reachable by links, ``n_links`` the number of other rows
    linked directly (copies and repeated rows count each). A NULL or wordless
    text has an empty set and is linked with nothing: its component is its own
    id. A NULL id is the greatest id. Repeated rows give repeated results.
    Other columns are not read; an empty table gives no rows."""
    num, den = similarity
    texts = _texts(df, id_col, text_col)
    sig = store(_sets(texts, k), "jaccard-sets")
    docs = sig.where("part IS NULL").drop("part", "counts")
    full = docs.where("set_id IS NOT NULL")
    counts = _order(sig)
    n_docs = full.count()
    index = _narrowed(_index(texts, k, num, den, counts, max(n_docs / 1000, DEALT_FROM)), num, den)
    edges = _chains(index, num, den)
    groups = connected_components(edges)
    sets = store(full.groupBy("set_id").agg(
        F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("s").alias("s"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "__h")).alias("least")), "jaccard-distinct")
    members = store(sets.join(groups, F.col("s") == F.col("node")).select(
        "set_id", "n", "copies", F.col("least.__h").alias("__h"), F.col("component").alias("grp")), "jaccard-groups")
    large = members.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where(
        (F.col("m") > GROUP_SETS) | (F.col("s") > GROUP_SHINGLES)).select("grp", F.lit(True).alias("large"))
    wanted = members.join(large, "grp", "left").select("__h", "grp", "set_id", "copies",
                                                       F.coalesce("large", F.lit(False)).alias("large"))
    texts = _held_by(texts, members.select("__h")).join(wanted, "__h").groupBy("__h", "grp", "set_id", "copies", "large").agg(
        F.first("__text").alias("__text"))
    held = store(_members(texts, k), "jaccard-members")
    found = _joined(held.where(~F.col("large")).withColumn("key", F.col("grp").cast("string")).withColumn(
        "side", F.lit(0)), num, den)
    if large.limit(1).count():
        found = found.unionByName(_joined(_chunked(held.where("large"), num, den), num, den))
    found = store(found, "jaccard-links")
    comp = connected_components(found.where("other IS NOT NULL"), "set_id", "other")
    n_links = found.where("other IS NULL").groupBy(F.col("set_id").alias("linked")).agg(F.sum("n").alias("n_links"))
    of_set = store(sets.join(comp, F.col("set_id") == F.col("node"), "left").join(
        n_links, F.col("set_id") == F.col("linked"), "left").select(
        "set_id", "least", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "set_id").alias("comp")), "jaccard-of-set")
    least = of_set.groupBy("comp").agg(F.min("least").alias("first"))
    of_set = store(of_set.join(least, "comp").select("set_id", "n_links", F.col("first.id").alias("first")), "jaccard-least")
    out = docs.select("id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    return out.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
