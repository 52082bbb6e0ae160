"""Near-duplicate groups by min-max hashing.

1. A task reads whole texts and emits, per document, the size and a 128-bit
   digest of its shingle set and its band keys. Each permutation gives two
   signature values, the minimum and the maximum of the permuted hashes, so the
   number of hash evaluations is half the signature's length.
2. Documents with equal sets collapse to one set. Sets that share a band key
   are joined to the least set of that key (linear in the rows, never all
   pairs); the components of these links are the candidate groups.
3. Links are confirmed on full shingle sets inside the candidate groups. Each
   set travels once to its group. A group beyond ``GROUP_SETS`` sets or
   ``GROUP_SHINGLES`` shingles is worked in chunks: sets with too many shingles
   of their own cannot have a link and leave (exact); the others meet their
   chunk and a few centres near the core of the group; then the sets outside
   the group's main component meet every chunk, block by block. Every pair is
   either compared, already connected, or excluded by a bound; nothing is
   capped.
4. Components of the confirmed links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch, store
from .components import connected_components

#: 20 bands of 5 values from 50 permutations: two sets of similarity 0.8 share
#: no band with probability 0.0004, of 0.85 with 0.00001.
BANDS, BAND_ROWS = 20, 5
#: Sets and shingles of a candidate group (or chunk) that meet in one task.
GROUP_SETS, GROUP_SHINGLES = 400, 1_000_000
CENTRES = 8
#: Shingles whose permutations are evaluated at once.
_BLOCK = 1 << 16
#: Words whose hash a worker remembers.
_REMEMBERED = 250_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_HASHES = _WordHash()


def shingle_set(text: str | None, k: int):
    """Sorted 64-bit hashes of the distinct k-word shingles of a text: words
    are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer than k
    words the whole sequence is one shingle, without words the set is empty."""
    import numpy as np
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > _REMEMBERED:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - k + 1, 1)
    out = np.full(n, min(len(h), k), np.uint64)
    for i in range(min(k, len(h))):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) > 1 else out


def _multipliers(n: int):
    import numpy as np
    rng = np.random.default_rng(20240611)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def min_max_signature(shingles, perms):
    """Minimum and maximum of the top 32 bits of each multiplied hash."""
    import numpy as np
    low = high = None
    for at in range(0, len(shingles), _BLOCK):
        v = (shingles[at:at + _BLOCK, None] * perms[None, :]) >> np.uint64(32)
        lo, hi = v.min(0), v.max(0)
        low = lo if low is None else np.minimum(low, lo)
        high = hi if high is None else np.maximum(high, hi)
    return np.concatenate([low, high])


def band_keys(signature, bands: int, rows: int):
    """One signed 64-bit key per band of ``rows`` signature values."""
    import numpy as np
    v = signature.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows):
        key = (key ^ v[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """``id, __h, n_shingles, set_id, keys`` per row; ``__h`` hashes id and
    text, ``set_id`` and ``keys`` are NULL for an empty set."""
    if bands * rows % 2:
        raise ValueError("bands x rows must be even: each permutation gives two values")
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("__h", T.LongType()),
                           T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches):
        import hashlib
        perms = _multipliers(bands * rows // 2)
        for b in batches:
            fields = [("id", b.schema.field(0).type), ("__h", pa.int64()), ("n_shingles", pa.int64()),
                      ("set_id", pa.binary()), ("keys", pa.list_(pa.int64()))]
            for part in lists(b, "__text"):
                n, ids, keys = [], [], []
                for t in part["__text"]:
                    s = shingle_set(t, k)
                    n.append(len(s))
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    keys.append(band_keys(min_max_signature(s, perms), bands, rows) if len(s) else None)
                yield out_batch(fields, (part["__id"], part["__h"], n, ids, keys))

    return _hashed(df, id_col, text_col).mapInArrow(run, schema)


def _hashed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("__id"), F.xxhash64(id_col, text_col).alias("__h"),
                     F.col(text_col).alias("__text"))


def group_links(ids: list[bytes], sets: list, num: int, den: int) -> list[tuple[bytes, bytes]]:
    """Spanning links of the sets of one group: x and y are linked when
    den * |x & y| >= num * |x | y|. Common shingles are counted through an
    inverted index, so only sets that share something are compared."""
    import numpy as np
    order = sorted(dict(zip(ids, range(len(ids)))).values(), key=lambda i: ids[i])
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    if len(ids) < 2:
        return []
    if len(ids) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(ids[0], ids[1])] if den * both >= num * (len(sets[0]) + len(sets[1]) - both) else []
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    by = np.argsort(values, kind="stable")
    owner, values = owner[by], values[by]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(first) - 1
    post = np.concatenate([np.flatnonzero(first), [len(values)]])
    shingle_of = np.empty(len(values), np.int64)
    shingle_of[by] = number
    start = np.concatenate([[0], np.cumsum(sizes)])
    root = np.arange(len(sets))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    links = []
    for x in range(len(sets)):
        mine = shingle_of[start[x]:start[x + 1]]
        lo, n = post[mine], post[mine + 1] - post[mine]
        many = n > 1
        lo, n = lo[many], n[many]
        if not len(n):
            continue
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        hits = np.flatnonzero(den * both >= num * (sizes[x] + sizes - both))
        for y in hits[hits > x].tolist():
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((ids[x], ids[y]))
    return links


def _links_by_group(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``src, dst`` links within each ``grp`` of ``rows`` (grp, set_id,
    shingles), each group together in one task and bounded by the caller."""
    fields = [("src", pa.binary()), ("dst", pa.binary())]

    def run(batches):
        import numpy as np
        now, ids, sets = None, [], []

        def links() -> Iterator[pa.RecordBatch]:
            found = group_links(ids, sets, num, den)
            if found:
                yield out_batch(fields, list(zip(*found)))

        for b in batches:
            for g, i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if g != now:
                    yield from links()
                    now, ids, sets = g, [], []
                ids.append(i)
                sets.append(s.values.to_numpy(zero_copy_only=False).view(np.uint64))
        yield from links()

    rows = rows.select("grp", "set_id", "shingles")
    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "src binary, dst binary")


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """``grp, large, set_id, n_shingles, shingles`` from rows with a text."""
    schema = "grp binary, large boolean, set_id binary, n_shingles long, shingles array<long>"
    fields = [("grp", pa.binary()), ("large", pa.bool_()), ("set_id", pa.binary()), ("n_shingles", pa.int64()),
              ("shingles", pa.list_(pa.int64()))]

    def run(batches):
        import hashlib

        import numpy as np
        for b in batches:
            for part in lists(b, "__text"):
                rows = []
                for g, big, i, t in zip(part["grp"], part["large"], part["set_id"], part["__text"]):
                    s = shingle_set(t, k)
                    if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == i:  # not another text of equal hash
                        rows.append((g, big, i, len(s), s.view(np.int64)))
                if rows:
                    yield out_batch(fields, list(zip(*rows)))

    return texts.select("grp", "large", "set_id", "__text").mapInArrow(run, schema)


def _chunked_links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links within groups of any size (see the module's text, step 3)."""
    own = (sets.select("grp", "set_id", F.explode("shingles").alias("s"))
           .groupBy("grp", "s").agg(F.count(F.lit(1)).alias("c"), F.min("set_id").alias("set_id"))
           .where("c = 1").groupBy("grp", "set_id").agg(F.count(F.lit(1)).alias("own")))
    info = sets.select("grp", "set_id", "n_shingles").join(own, ["grp", "set_id"], "left").select(
        "grp", "set_id", "n_shingles", F.coalesce("own", F.lit(0)).alias("own"))
    # |x & y| <= n - own and |x | y| >= n for every y of the group
    info = store(info.where((F.col("n_shingles") - F.col("own")) * den >= F.col("n_shingles") * num), "near-core")
    size = info.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s")).select(
        "grp", F.ceil(F.greatest(F.col("m") / GROUP_SETS, F.col("s") / GROUP_SHINGLES)).cast("int").alias("chunks"))
    slot = F.pmod(F.xxhash64("set_id"), F.lit(CENTRES))
    centres = info.groupBy("grp", slot.alias("slot")).agg(
        F.min(F.struct((F.col("own") / F.col("n_shingles")).alias("f"), "set_id")).alias("c")).select(
        "grp", F.col("c.set_id").alias("set_id"))
    core = info.select("grp", "set_id").join(size, "grp").select(
        "grp", "set_id", "chunks", F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("chunks")).alias("chunk"))
    core = store(sets.select("grp", "set_id", "shingles").join(core, ["grp", "set_id"]), "near-chunks")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks").cast("bigint") - 1))
    part = F.concat(F.col("grp"), F.col("chunk").cast("string").cast("binary"))
    star = core.select(part.alias("grp"), "set_id", "shingles").unionByName(
        core.join(centres, ["grp", "set_id"]).select("grp", "set_id", "shingles", every.alias("chunk")).select(
            part.alias("grp"), "set_id", "shingles"))
    first = store(_links_by_group(star, num, den), "near-star")
    comp = connected_components(first)
    held = store(core.select("grp", "set_id", "chunks").join(comp, F.col("set_id") == F.col("node"), "left").select(
        "grp", "set_id", "chunks", F.coalesce("component", "set_id").alias("comp")), "near-held")
    main = held.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("grp").agg(
        F.max(F.struct("m", "comp")).alias("x")).select("grp", F.col("x.comp").alias("comp"))
    rest = held.join(main, ["grp", "comp"], "left_anti").where("chunks > 1")
    blocks = rest.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).cast("bigint").alias("blocks"))
    part2 = F.concat(F.col("grp"), F.concat_ws("/", F.lit(""), "chunk", "block").cast("binary"))
    block = F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("blocks"))
    cross = core.join(blocks, "grp").select(
        "grp", "set_id", "shingles", "chunk",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")).select(
        part2.alias("grp"), "set_id", "shingles")
    outside = core.join(rest.select("grp", "set_id"), ["grp", "set_id"]).join(blocks, "grp").select(
        "grp", "set_id", "shingles", block.alias("block"), every.alias("chunk")).select(
        part2.alias("grp"), "set_id", "shingles")
    return first.unionByName(_links_by_group(cross.unionByName(outside), num, den))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    similarity: tuple[int, int] = (80, 100), bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """``id_col, n_shingles, component_id, kept, row_hash`` for every row of ``df``.

    Rows are linked when den * |x & y| >= num * |x | y| for their sets of
    distinct k-word shingles, ``similarity = (num, den)``; ``component_id`` is
    the least id reachable and ``kept`` marks it. A NULL or wordless text has
    an empty set and is linked with nothing (its component is its own id, and
    it is kept). A NULL id is the greatest id. Rows that share an id and differ
    in text are separate rows, of which a group keeps one; repeated rows (same
    id and text) are one document and share its fate. ``row_hash`` is
    ``xxhash64(id, text)``. Other columns are not read; an empty table gives no
    rows."""
    num, den = similarity
    sig = store(signatures(df, id_col, text_col, k, bands, rows), "near-signatures")
    full = sig.where(F.col("set_id").isNotNull())
    sets = store(full.groupBy("set_id").agg(
        F.min("n_shingles").alias("n_shingles"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "__h")).alias("least"),
        F.first("keys").alias("keys")), "near-sets")
    by_key = sets.select(F.explode("keys").alias("key"), "set_id")
    heads = store(by_key.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("set_id").alias("head"))
                  .where("m > 1").select("key", "head"), "near-heads")
    pairs = by_key.join(heads, "key").where("set_id <> head").select(
        F.col("set_id").alias("src"), F.col("head").alias("dst"))
    groups = store(connected_components(pairs), "near-groups")
    groups = sets.select("set_id", "n_shingles", "least.__h").join(groups, F.col("set_id") == F.col("node")).select(
        "set_id", "n_shingles", "__h", F.col("component").alias("grp"))
    groups = store(groups, "near-members")
    large = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s")).where(
        (F.col("m") > GROUP_SETS) | (F.col("s") > GROUP_SHINGLES)).select("grp", F.lit(True).alias("large"))
    texts = _hashed(df, id_col, text_col).select("__h", "__text").join(
        groups.join(large, "grp", "left").select("__h", "grp", "set_id", F.coalesce("large", F.lit(False)).alias("large")), "__h")
    # one row per set: a repeated row (same id and text) meets its copies here, without another shuffle
    texts = texts.groupBy("__h", "grp", "set_id", "large").agg(F.first("__text").alias("__text"))
    members = store(_sets(texts, k), "near-shingles")
    links = _links_by_group(members.where(~F.col("large")), num, den)
    if large.limit(1).count():
        links = links.unionByName(_chunked_links(members.where("large").drop("large"), num, den))
    comp = connected_components(links, spanning=True)
    of_set = store(sets.select("set_id", "least").join(comp, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("comp")), "near-of-set")
    least = of_set.groupBy("comp").agg(F.min("least").alias("first"))
    of_set = store(of_set.join(least, "comp").select("set_id", "first"), "near-least")
    out = sig.select("id", "__h", "n_shingles", "set_id").join(of_set, "set_id", "left")
    empty = F.col("set_id").isNull()
    return out.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(empty, F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (empty | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("__h") == F.col("first.__h")))).alias("kept"),
        F.col("__h").alias("row_hash"))
