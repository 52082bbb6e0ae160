"""Cheapest repair of the turn structure of conversations.

A repaired conversation's role initials are ``(s?(ua)+)?``. Every row is kept
(cost 0), gets the role user or assistant (1) or is deleted (2; blank and
repeated rows must be); a row of user or assistant with an empty text may be
inserted anywhere (5); a truncated row that stays adds 5.

1. Equal rows are counted, so a row repeated without bound is one entry. The
   first entry of every (role, text) of a conversation is found by an aggregate
   and joined back on the whole key; no key of either is repeated.
2. The entries are range-partitioned and sorted by conversation and order, so a
   conversation of any length spreads over tasks, and cut into segments of at
   most ``SEGMENT`` entries.
3. Each segment is a lattice of (entries done, state) with integer costs. The
   auction algorithm (Bertsekas, 1991) finds its shortest path: a path from the
   origin is extended along an arc whose cost equals the difference of the
   prices of its ends, or else the last node's price is raised to its best arc
   and the path is contracted by it. The prices start at the sums of the
   entries' least costs, which no arc violates. With converged prices the
   arcs of all shortest paths are tight; the path that is least in ASCII is
   traced along them.
4. A conversation inside one segment is done then. The segments of the others,
   solved from every state to every state, are joined in their order without
   their texts. What is carried is four costs and their order in ASCII: two
   audits of as many entries never are one the prefix of the other, so the
   first difference decides.
5. Summaries stream over the segments of a conversation in order: the SHA-256
   of one long conversation is sequential by definition and holds one segment
   of texts; its audit is one value of the result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import out_batch, store

#: Entries of a segment.
SEGMENT = 64
#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a. Role initial -> state -> next state.
STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # the role that a state asks for: user -> 2, assistant -> 3
ROLE = {2: "user", 3: "assistant"}
FINAL = (0, 3)
#: What a state still needs at the end.
CLOSE = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
FAULTS = ("blank", "duplicate", "truncated")


def fault(text: str, first: bool) -> str | None:
    """The first fault of a row; ``first``: role and text not seen before."""
    held = text.rstrip(SPACE)
    if not held:
        return "blank"
    if not first:
        return "duplicate"
    return None if held[-1] in ".!?" else "truncated"


def steps(role: str, found: str | None, copies: int) -> list[tuple[str, bool, int]]:
    """(initial, truncated, 0) of the row that may stay, and ('', False, n) of
    n rows that must go."""
    if found in ("blank", "duplicate"):
        return [("", False, copies)]
    out = [(role[:1], found == "truncated", 0)]
    return out + [("", False, copies - 1)] if copies > 1 else out


def row_arcs(step: tuple[str, bool, int], state: int) -> list[tuple[str, int, int]]:
    """(edits, cost, next state) of an entry in a state, least edits first."""
    initial, truncated, gone = step
    if gone:
        return [("D" * gone, DELETE * gone, state)]
    more = TRUNCATED if truncated else 0
    out = [("D", DELETE, state)]
    kept = STEP.get(initial, {}).get(state)
    if kept is not None:
        out.append(("K", KEEP + more, kept))
    if NEXT[state] != kept:
        out.append(("R", REROLE + more, NEXT[state]))
    return out


def lattice(rows: list, ends: tuple, closing: bool) -> tuple[list, list, int]:
    """Arcs out of every node 4 * entries done + state, first prices, target.

    ``ends`` are the states the last entry may leave; ``closing``: rows may be
    inserted behind the last entry. Nodes that do not reach the target have no
    arcs in or out."""
    n = len(rows)
    target = 4 * n + 4
    out: list[list] = [[] for _ in range(target + 1)]
    price = [0] * (target + 1)
    reach = [False] * (target + 1)
    reach[target] = True
    floor = 0
    for at in range(n, -1, -1):
        ahead = []
        for s in range(4):
            if at < n:
                ahead.append([(e, c, 4 * at + 4 + t) for e, c, t in row_arcs(rows[at], s)])
            else:
                ahead.append([("", 0, target)] if s in ends else [])
        if at < n:
            floor += min(c for arcs in ahead for _, c, _ in arcs)
        for s in range(4):
            reach[4 * at + s] = any(reach[j] for _, _, j in ahead[s])
            price[4 * at + s] = floor
        if at < n or closing:
            for _ in range(3):
                for s in range(4):
                    reach[4 * at + s] |= reach[4 * at + NEXT[s]]
        for s in range(4):
            arcs = [a for a in ahead[s] if reach[a[2]]]
            if (at < n or closing) and reach[4 * at + NEXT[s]]:
                arcs.append(("I", INSERT, 4 * at + NEXT[s]))
            out[4 * at + s] = sorted(arcs)
    return out, price, target


def auction(out: list, price: list, origin: int, target: int) -> int | None:
    """Length of the shortest path from ``origin``, None without one. ``price``
    satisfies price[i] <= cost + price[j] for every arc, before and after; at
    the end every arc of a shortest path is tight."""
    if not out[origin]:
        return None
    path = [origin]
    while (i := path[-1]) != target:
        best, to = min((c + price[j], j) for _, c, j in out[i])
        if price[i] < best:
            price[i] = best  # contract: the node is dearer than it seemed
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)  # extend along a tight arc
    return price[origin] - price[target]


def trace(out: list, price: list, origin: int, target: int) -> str:
    """The ASCII-least edits along tight arcs from ``origin`` to ``target``."""
    path, at, tried = [], [origin], [0]
    dead: set[int] = set()
    while at[-1] != target:
        i = at[-1]
        for k in range(tried[-1], len(out[i])):
            e, c, j = out[i][k]
            if price[i] == c + price[j] and j not in dead:
                tried[-1] = k + 1
                at.append(j)
                tried.append(0)
                path.append(e)
                break
        else:
            dead.add(i)
            at.pop()
            tried.pop()
            path.pop()
    return "".join(path)


def solve(rows: list) -> tuple[int, str]:
    """Least cost and ASCII-least audit of a whole conversation."""
    out, price, target = lattice(rows, FINAL, True)
    cost = auction(out, price, 0, target)
    return cost, trace(out, price, 0, target)


def solve_between(rows: list) -> tuple[list, list]:
    """Cost and audit from state e to state x at 4 * e + x; None without a path."""
    costs, audits = [None] * 16, [None] * 16
    for x in range(4):
        out, price, target = lattice(rows, (x,), False)
        for e in range(4):
            costs[4 * e + x] = auction(out, price, e, target)
            if costs[4 * e + x] is not None:
                audits[4 * e + x] = trace(out, price, e, target)
    return costs, audits


def join_segments(segments) -> list[tuple[int, int]]:
    """(state before, state after) of every segment, from the (costs, audits)
    of a conversation's segments in order."""
    held = {0: (0, 0)}  # state -> (cost, place among the audits so far)
    back = []
    for costs, audits in segments:
        got = {}
        for x in range(4):
            ways = [(held[e][0] + costs[4 * e + x], held[e][1], e) for e in held if costs[4 * e + x] is not None]
            if ways:
                got[x] = min(ways)
        order = sorted(got, key=lambda x: (got[x][1], audits[4 * got[x][2] + x]))
        back.append(bytes(got[x][2] if x in got else 0 for x in range(4)))
        held = {x: (got[x][0], order.index(x)) for x in got}
    x = min(held, key=lambda x: (held[x][0] + CLOSE[x][0], held[x][1]))
    path = []
    for from_ in reversed(back):
        path.append((from_[x], x))
        x = from_[x]
    return path[::-1]


ROW = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                    T.StructField("text", T.StringType()), T.StructField("copies", T.LongType()),
                    T.StructField("fault", T.StringType())])


def _schema(conv: T.DataType, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), T.StructField("segment", T.LongType()), *more,
                         T.StructField("rows", T.ArrayType(ROW))])


def _entries(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    def col(c):
        return F.col(f"`{c}`")

    rows = df.select(
        col(conv).alias("conv_id"), col(turn).cast("bigint").alias("turn"), F.coalesce(col(role), F.lit(" ")).alias("role"),
        F.coalesce(col(text), F.lit(" ")).alias("text"),
        (col(copies).cast("bigint") if copies else F.lit(1).cast("bigint")).alias("copies"))
    rows = rows.withColumn("sha", F.sha2("text", 256)).groupBy("conv_id", "turn", "role", "sha").agg(
        F.first("text").alias("text"), F.sum("copies").alias("copies"))
    rows = store(rows, "repair-entries")
    least = rows.groupBy("conv_id", "role", "sha").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("t"), "turn")).alias("m")).select(
        F.col("conv_id").alias("__c"), F.col("m.turn").alias("__t"), F.col("role").alias("__r"), F.col("sha").alias("__s"),
        F.lit(True).alias("first"))
    on = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("conv_id", "__c"), ("turn", "__t"), ("role", "__r"), ("sha", "__s"))]
    return rows.join(least, on, "left").select(
        "conv_id", "turn", "role", "sha", "text", "copies", F.coalesce("first", F.lit(False)).alias("first"))


def _segments(entries: DataFrame) -> DataFrame:
    """One row per segment; ``audit`` where it is a whole conversation, else
    the costs and audits between states."""
    kind = entries.schema["conv_id"].dataType
    schema = _schema(kind, T.StructField("audit", T.StringType()), T.StructField("costs", T.ArrayType(T.LongType())),
                     T.StructField("audits", T.ArrayType(T.StringType())))
    key = ["conv_id", "turn", "role", "sha"]

    def run(batches):
        from pyspark import TaskContext
        fields = None
        base = TaskContext.get().partitionId() << 33
        number, now, held, whole, done = 0, None, [], False, []

        def close(last: bool):
            nonlocal number
            if not held:
                return
            rows = [s for r in held for s in steps(r[1], r[4], r[3])]
            audit = costs = audits = None
            if whole and last:
                audit = solve(rows)[1]
            else:
                costs, audits = solve_between(rows)
            done.append((now[0], base | number, audit, costs, audits,
                         [dict(zip(("turn", "role", "text", "copies", "fault"), r)) for r in held]))
            number += 1

        def emit():
            cols = list(zip(*done))
            done.clear()
            return out_batch(fields, cols)

        started = False
        for b in batches:
            if fields is None:
                fields = [(f.name, t) for f, t in zip(schema.fields, _arrow(schema, b.schema.field(0).type))]
            c, t, r, x, n, f = (b.column(k).to_pylist() for k in range(6))
            for k in range(len(c)):
                if now is None or c[k] != now[0]:
                    if now is not None:
                        close(True)
                    # a conversation that the task starts with may have begun in another one
                    now, held, whole, started = (c[k],), [], started, True
                elif len(held) == SEGMENT:
                    close(False)
                    held, whole = [], False
                held.append((t[k], r[k], x[k], n[k], fault(x[k], f[k])))
                if len(done) >= 256:
                    yield emit()
        close(False)  # the last one may go on in the next task
        if done:
            yield emit()

    rows = entries.repartitionByRange(*key).sortWithinPartitions(*key)
    return rows.select("conv_id", "turn", "role", "text", "copies", "first").mapInArrow(run, schema)


def _arrow(schema: T.StructType, conv: pa.DataType) -> list[pa.DataType]:
    row = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()),
                     ("fault", pa.string())])
    kinds = {"conv_id": conv, "segment": pa.int64(), "audit": pa.string(), "costs": pa.list_(pa.int64()),
             "audits": pa.list_(pa.string()), "state": pa.int32(), "rows": pa.list_(row)}
    return [kinds[f.name] for f in schema.fields]


def _choices(parts: DataFrame) -> DataFrame:
    """``segment, way`` (4 * state before + state after) of segments that are
    no whole conversation; a task reads the segments of a conversation in order."""
    def run(batches):
        now, ids, held = None, [], []

        def emit():
            ways = join_segments(held)
            yield out_batch([("segment", pa.int64()), ("way", pa.int32())], (ids, [4 * e + x for e, x in ways]))

        for b in batches:
            for c, s, costs, audits in zip(*(b.column(k).to_pylist() for k in range(4))):
                if now is None or c != now[0]:
                    if held:
                        yield from emit()
                    now, ids, held = (c,), [], []
                ids.append(s)
                held.append((costs, audits))
        if held:
            yield from emit()

    rows = parts.select("conv_id", "segment", "costs", "audits")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(
        run, "segment long, way int")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None) -> DataFrame:
    """Segments of the repaired conversations: ``conv_id, segment, whole,
    state, audit, rows``.

    The rows of a conversation are taken by turn (NULL first), then role, then
    the SHA-256 of the text. ``audit`` holds the edits of the segment's rows
    (Keep, Rerole, Delete, Insert; the rows that the end of a conversation
    lacks are left to ``close``), ``state`` the state before it. A NULL role or
    text is one space, NULL is a conversation of its own, repeated rows are
    rows (``copies``: a column with their number). A text is read whole.
    Other columns are not read; an empty table gives no rows."""
    parts = store(_segments(_entries(df, conv, turn, role, text, copies)), "repair-segments")
    ways = _choices(parts.where("audit IS NULL"))
    cut = parts.where("audit IS NULL").join(ways, "segment").select(
        "conv_id", "segment", F.lit(False).alias("whole"), F.floor(F.col("way") / 4).cast("int").alias("state"),
        F.col("audits")[F.col("way")].alias("audit"), "rows")
    return parts.where("audit IS NOT NULL").select(
        "conv_id", "segment", F.lit(True).alias("whole"), F.lit(0).alias("state"), "audit", "rows").unionByName(cut)


def edited(state: int, audit: str, rows: list[dict]):
    """(edit, state behind it, role, text, row) of every edit of a segment."""
    k = used = 0
    for e in audit:
        if e == "I":
            state = NEXT[state]
            yield e, state, ROLE[state], "", None
            continue
        row = rows[k]
        used += 1
        if used == row["copies"]:
            k, used = k + 1, 0
        if e != "D":
            state = STEP[row["role"][:1]][state] if e == "K" else NEXT[state]
        yield e, state, ROLE[state] if e == "R" else row["role"], row["text"], row


def messages(repaired: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, segment, at, edit,
    role, text``, in the order of segment and at. The closing rows of a
    conversation of several segments come from ``summary``'s audit only if it
    ends in I; they have no text."""
    kind = repaired.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("segment", T.LongType()),
                           T.StructField("at", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        for b in batches:
            fields = [("conv_id", b.schema.field(0).type), ("segment", pa.int64()), ("at", pa.int64()),
                      ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
            for i in range(b.num_rows):
                c, s, state, audit, rows = (b.column(k)[i].as_py() for k in range(5))
                out = [(c, s, at, e, role, text) for at, (e, _, role, text, _) in enumerate(edited(state, audit, rows)) if e != "D"]
                if out:
                    yield out_batch(fields, list(zip(*out)))

    return repaired.select("conv_id", "segment", "state", "audit", "rows").mapInArrow(run, schema)


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Summary:
    """Figures of one conversation, fed with its segments in order."""

    def __init__(self):
        import hashlib
        self.sha, self.empty, self.audit, self.state = hashlib.sha256(), True, [], 0
        self.found = dict.fromkeys(FAULTS, 0)
        self.low = self.high = self.initial = None
        self.turns = self.illegal = self.cost = 0

    def _write(self, role: str, text: str) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def add(self, state: int, audit: str, rows: list[dict]) -> None:
        for r in rows:
            n, turn, mine = r["copies"], r["turn"], r["role"][:1]
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            first = 1 if r["fault"] in (None, "truncated") else n
            if r["fault"]:
                self.found[r["fault"]] += first
            self.found["duplicate"] += n - first
            self.illegal += (self.initial is not None and f"{self.initial}{mine}" not in ("su", "ua", "au")) + n - 1
            self.initial = mine
        self.state = state
        for e, self.state, role, text, row in edited(state, audit, rows):
            self.cost += COSTS[e]
            if e != "D":
                self._write(role, text)
                if row and row["fault"] == "truncated":
                    self.cost += TRUNCATED
        self.audit.append(audit)

    def close(self) -> tuple:
        cost, edits = CLOSE[self.state]
        for _ in edits:
            self.state = NEXT[self.state]
            self._write(ROLE[self.state], "")
        self.audit.append(edits)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.found["blank"], self.found["duplicate"], self.found["truncated"], self.illegal,
                self.cost + cost, "".join(self.audit), self.sha.hexdigest())


def summary(repaired: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of every conversation with rows."""
    kind = repaired.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *[T.StructField(c, T.LongType()) for c in SUMMARY],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        now, one, done = None, None, []
        for b in batches:
            fields = [("conv_id", b.schema.field(0).type), *[(c, pa.int64()) for c in SUMMARY],
                      ("audit", pa.string()), ("repaired_sha256", pa.string())]
            ids, whole = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, c in enumerate(ids):
                if now is None or whole[i] or c != now[0]:
                    if now is not None:
                        done.append((*now, *one.close()))
                    now, one = (c,), _Summary()
                one.add(*(b.column(k)[i].as_py() for k in (2, 3, 4)))
            if done:
                yield out_batch(fields, list(zip(*done)))
                done = []
        if now is not None:
            yield out_batch(fields, list(zip((*now, *one.close()))))

    rows = repaired.select("conv_id", "whole", "state", "audit", "rows", "segment")
    cut = rows.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.where("whole").mapInArrow(run, schema).unionByName(cut.mapInArrow(run, schema))
