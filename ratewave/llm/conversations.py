"""Repair of conversation structure: the cheapest edits that make roles alternate.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  Edits: Keep a row
(free), Rerole it to user or assistant (2), Delete it (3; the only one for blank and repeated
rows), Insert an empty user or assistant row anywhere (2); each truncated row that is not
deleted adds 1.  Of the cheapest edit sequences the one whose initials are ASCII-least wins.

The cheapest cost from a row on depends only on the role expected next, so it is a vector of
four numbers.  A backward pass keeps these vectors at checkpoints only, about the square root
of the number of rows apart; the forward walk makes each block's vectors again from the next
checkpoint and takes, at every row, the ASCII-least edit that is tight (its cost and the rest's
add up).  Memory is two square roots of the rows, not one vector for each.

In Spark, equal rows at one turn are counted first (all but the first of them are repeats),
rows are sorted by range, and cut into chunks of ``CHUNK`` rows.  A conversation inside a chunk
is repaired there.  One that crosses a border is a chain of pieces: every piece's costs are a
(min, +) matrix, one stream over the matrices from the last to the first gives each piece the
cost vector at its end (its checkpoint), every piece is walked from each state it may start in,
and one stream over the pieces picks the walk that fits.  So no task holds a whole conversation,
however long; only its result, one string of edits and a digest, comes together in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, fields
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratewave.llm.common import materialize

#: Rows of a chunk: a power of two, as a chunk's number is a shifted row number.
CHUNK_BITS = 12
#: Blank characters: space, tab, LF, VT, FF, CR.
BLANK = " \t\n\x0b\x0c\r"

# States: nothing yet (may end), after a system row, after a user row, after an assistant row (may end).
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of an initial; what is absent isn't allowed.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The initial that Rerole and Insert give in each state, and the state they lead to.
DUE = tuple(("a", ASSISTANT) if s == USER else ("u", USER) for s in range(4))
NAMES = {"u": "user", "a": "assistant"}
RECOST, DROPCOST, ADDCOST, CUTCOST = 2, 3, 2, 1
FAR = 1 << 60  # no way

Vector = tuple[int, int, int, int]
#: (initial, must go, truncated), or None for a row that isn't there.
Kind = tuple[str, bool, bool] | None
END: Vector = (0, 4, 2, 0)  # empty rows that complete the last pair


def _closed(v: list[int]) -> list[int]:
    """The cheapest costs if rows may be inserted first; more than two of them never pay."""
    for _ in range(2):
        v = [min(c, ADDCOST + v[DUE[s][1]]) for s, c in enumerate(v)]
    return v


class Costs:
    """Cost vectors before a row from those after it, and tight edits; both remembered.

    Vectors are kept without their least number, so few different ones occur."""

    def __init__(self) -> None:
        self.before: dict[tuple[Vector, Kind], tuple[Vector, int]] = {}
        self.edits: dict[tuple[Vector, Kind, int], tuple[str, str, int]] = {}

    @staticmethod
    def base(v: Iterable[int]) -> tuple[Vector, int]:
        v = list(v)
        low = min(v)
        return tuple(min(x - low, FAR) if x < FAR else FAR for x in v), low

    def back(self, after: Vector, kind: Kind) -> tuple[Vector, int]:
        """(vector before a row of ``kind``, what was taken off it)."""
        got = self.before.get((after, kind))
        if got is None:
            got = self.before[after, kind] = self.base(_closed(self.choices(after, kind)))
        return got

    @staticmethod
    def choices(after: Vector, kind: Kind) -> list[int]:
        if kind is None:
            return list(after)
        initial, gone, cut = kind
        out = []
        for s in range(4):
            ways = [DROPCOST + after[s]]
            if not gone:
                if initial in NEXT[s]:
                    ways.append(CUTCOST * cut + after[NEXT[s][initial]])
                ways.append(RECOST + CUTCOST * cut + after[DUE[s][1]])
            out.append(min(ways))
        return out

    def walk(self, after: Vector, kind: Kind, state: int) -> tuple[str, str, int]:
        """The ASCII-least tight edits up to and with this row: (their initials, the initials
        of the roles that inserted rows and a reroled row get, the state after it)."""
        got = self.edits.get((after, kind, state))
        if got is not None:
            return got
        if kind is None:
            return "", "", state
        before = _closed(self.choices(after, kind))
        initial, gone, cut = kind
        done = roles = ""
        s = state
        while True:
            due, then = DUE[s]
            if DROPCOST + after[s] == before[s]:
                done += "D"
                break
            if ADDCOST + before[then] == before[s]:
                done, roles, s = done + "I", roles + due, then
                continue
            if not gone and initial in NEXT[s] and CUTCOST * cut + after[NEXT[s][initial]] == before[s]:
                done, s = done + "K", NEXT[s][initial]
            else:
                done, roles, s = done + "R", roles + due, then
            break
        self.edits[after, kind, state] = done, roles, s
        return done, roles, s


@dataclass
class Entry:
    """Equal rows of one conversation at one turn, ``n`` of them; 0: rows that aren't there."""

    turn: int | None
    role: str
    text: str
    n: int
    first: bool
    blank: bool
    cut: bool

    @property
    def kind(self) -> Kind:
        """Of the first of the rows; all others go, as repeats."""
        return (self.role[:1], self.blank or not self.first, self.cut) if self.n else None


def matrix(entries: list[Entry], costs: Costs) -> list[int]:
    """16 numbers: the cost from each state before the rows to each state after them."""
    out = [FAR] * 16
    kinds = [e.kind for e in entries]
    extra = sum(DROPCOST * (e.n - 1) for e in entries if e.n)
    for t in range(4):
        v: Vector = tuple(0 if s == t else FAR for s in range(4))
        total = extra
        for kind in reversed(kinds):
            v, low = costs.back(v, kind)
            total += low
        out[t::4] = [c + total if c < FAR else FAR for c in v]
    return out


def through(m: list[int], after: list[int]) -> list[int]:
    """The cost vector before a piece from the one after it."""
    v = [min(m[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    return [min(c, FAR) for c in v]


def repair(entries: list[Entry], end: Iterable[int], state: int, costs: Costs) -> tuple[str, list[tuple[str, str]], int, int]:
    """(edits, repaired (role, text) rows, state after, cost) of rows that begin in ``state``
    and have the cost vector ``end`` after them, which the cost includes."""
    n = len(entries)
    step = isqrt(n) + 1
    v, total = Costs.base(end)
    total += sum(DROPCOST * (e.n - 1) for e in entries if e.n)
    marks = {n: v}
    for i in range(n - 1, -1, -1):
        v, low = costs.back(v, entries[i].kind)
        total += low
        if i % step == 0:
            marks[i] = v
    cost = total + v[state]
    edits: list[str] = []
    rows: list[tuple[str, str]] = []
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        block = [marks[hi]]  # the vectors after rows hi - 1, hi - 2, ..., lo
        for i in range(hi - 1, lo, -1):
            block.append(costs.back(block[-1], entries[i].kind)[0])
        for i in range(lo, hi):
            e = entries[i]
            done, roles, state = costs.walk(block[hi - 1 - i], e.kind, state)
            edits.append(done + "D" * (e.n - 1))
            fresh = iter(roles)
            for x in done:
                if x == "I":
                    rows.append((NAMES[next(fresh)], ""))
                elif x == "K":
                    rows.append((e.role, e.text))
                elif x == "R":
                    rows.append((NAMES[next(fresh)], e.text))
    return "".join(edits), rows, state, cost


def ending(state: int) -> tuple[str, list[tuple[str, str]]]:
    """The rows inserted after the last one."""
    rows = []
    while END[state]:
        due, state = DUE[state]
        rows.append((NAMES[due], ""))
    return "I" * len(rows), rows


def said(rows: list[tuple[str, str]]) -> str:
    return "\n".join(f"{r}:{t}" for r, t in rows)


@dataclass
class Facts:
    """What is counted about rows in order; two stretches of rows add up."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    low: int | None = None  # turns
    high: int | None = None
    turns: int = 0  # different ones
    head: str | None = None  # the first and the last row's initial
    tail: str | None = None

    @staticmethod
    def of(entries: list[Entry]) -> Facts:
        out = Facts()
        for e in entries:
            if e.n:
                out += Facts(
                    blank=e.n if e.blank else 0,
                    duplicate=0 if e.blank else e.n - e.first,
                    truncated=int(e.first and e.cut and not e.blank),
                    illegal=e.n - 1,
                    low=e.turn,
                    high=e.turn,
                    turns=int(e.turn is not None),
                    head=e.role[:1],
                    tail=e.role[:1],
                )
        return out

    def __add__(self, o: Facts) -> Facts:
        if o.head is None or self.head is None:
            return self if o.head is None else o
        seen = [x for x in (self.low, o.low) if x is not None], [x for x in (self.high, o.high) if x is not None]
        return Facts(
            self.blank + o.blank,
            self.duplicate + o.duplicate,
            self.truncated + o.truncated,
            self.illegal + o.illegal + (self.tail + o.head not in ("su", "ua", "au")),
            min(seen[0], default=None),
            max(seen[1], default=None),
            self.turns + o.turns - (self.high is not None and self.high == o.low),  # rows come by turn
            self.head,
            o.tail,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


DONE = "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string"
PIECE = ", low long, high long, turns long, head string, tail string, c string, chunk long, start int, stop int, closes boolean"


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: the rows with known faults put in, by crc32 of
    ``conv_id:turn`` modulo 20: 0 none is left (copies 0), 1 empty text, 2 without ``.!?``,
    3 there twice, 4 a user's.  NULLs are one space, in that key as in role and text."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat_ws(":", spaced(conv_col), spaced(turn_col)).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(spaced(text_col), "[.!?]", "")).otherwise(spaced(text_col))
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(how == 4, "user").otherwise(spaced(role_col)).alias("role"),
        text.alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """The rows of ``damage``'s form, equal ones counted, marked, sorted and numbered by chunk."""
    c = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    at = F.coalesce(F.col("turn").cast("string"), F.lit("-"))
    named = rows.select("*", c.alias("c"), at.alias("at"), F.sha2("text", 256).alias("same"))
    one = ["c", "at", "role", "same"]
    entries = named.groupBy(*one).agg(
        F.sum("copies").alias("n"), F.any_value("conv_id").alias("conv_id"), F.any_value("turn").alias("turn"), F.any_value("text").alias("text")
    )
    # a (role, text) of a conversation is new where its turn is the least; one row each, so no key is hot
    order = F.struct(F.col("turn").isNotNull(), "turn", "at")
    firsts = entries.where("n > 0").groupBy("c", "role", "same").agg(F.min(order).alias("m"))
    firsts = firsts.select("c", F.col("m.at").alias("at"), "role", "same", F.lit(True).alias("first"))
    last = F.rtrim(F.col("text"), F.lit(BLANK))
    marked = entries.join(firsts, one, "left").select(
        "c", "conv_id", "turn", "role", "same", "text", "n",
        F.coalesce("first", F.lit(False)).alias("first"),
        (last == "").alias("blank"),
        (~F.substring(last, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    keys = ["c", "turn", "role", "same"]
    placed = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("same")
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "conversation_rows")
    return placed.withColumn("chunk", F.shiftright("place", CHUNK_BITS))


def _chunks(batches: Iterable[pa.RecordBatch], text: bool) -> Iterator[tuple[int, list[dict]]]:
    """(chunk, its conversations' stretches, in order) from batches sorted by place."""
    now: int | None = None
    parts: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if r["chunk"] != now:
                if now is not None:
                    yield now, parts
                now, parts = r["chunk"], []
            if not parts or parts[-1]["c"] != r["c"]:
                parts.append({"c": r["c"], "conv_id": r["conv_id"], "entries": [], "borders": r.get("borders")})
            own = r["text"] if text else ""
            parts[-1]["entries"].append(Entry(r["turn"], r["role"], own, r["n"], r["first"], r["blank"], r["cut"]))
    if now is not None:
        yield now, parts


def _batch(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _border_matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrices of each chunk's first and last stretch: only those can be pieces."""
    schema = pa.schema([("c", pa.string()), ("chunk", pa.int64()), ("m", pa.list_(pa.int64()))])
    costs = Costs()
    for chunk, parts in _chunks(batches, text=False):
        ends = parts[:1] + parts[1:][-1:]
        yield from _batch([{"c": p["c"], "chunk": chunk, "m": matrix(p["entries"], costs)} for p in ends], schema)


def _end_vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From matrices by (c, chunk from the last): the cost vector after each piece, and whether
    it is the first and the last of its conversation."""
    schema = pa.schema([("chunk", pa.int64()), ("c", pa.string()), ("v", pa.list_(pa.int64())), ("opens", pa.bool_()), ("closes", pa.bool_())])
    held: dict | None = None  # the piece before, whose "opens" the next one decides
    v: list[int] = []
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            same = held is not None and held["c"] == r["c"]
            if held is not None:
                out.append(held | {"opens": not same})
            if not same:
                v = list(END)
            held = {"chunk": r["chunk"], "c": r["c"], "v": v, "closes": not same}
            v = through(r["m"], v)
        yield from _batch(out, schema)
    if held is not None:
        yield from _batch([held | {"opens": True}], schema)


def _finished(conv_id, facts: Facts, cost: int, audit: str, repaired: str) -> dict:
    return {
        "conv_id": conv_id, "gaps": facts.gaps, "blank": facts.blank, "duplicate": facts.duplicate,
        "truncated": facts.truncated, "illegal": facts.illegal, "cost": cost, "audit": audit, "repaired": repaired,
    }


def repair_conversations(rows: DataFrame, digest: bool = False) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired of every
    conversation; ``repaired`` is the repaired rows as ``role:text`` joined by newlines, or with
    ``digest`` its SHA-256 in hex, for which no task holds the text of a long conversation.

    ``rows``: conv_id, turn, role, text (not NULL) and copies, as ``damage`` gives them.  Rows
    stand by turn, those without one first; at one turn by role and text digest, equal rows
    together.  Rows without a conv_id are one conversation.  A row's first fault counts: blank (no other
    character than blanks), duplicate (role and text seen earlier), truncated (the last such
    character isn't one of ``.!?``).  A role's initial is its first character; an empty role
    has none and can't be kept.  A conversation without rows (copies 0) has zeros, an empty audit and an
    empty text.  Turns more than 2^63 apart overflow.  An empty table gives no rows.
    """
    placed = in_order(rows)
    kind = rows.schema["conv_id"].dataType
    by_chunk = lambda df: df.repartition("chunk").sortWithinPartitions("place").drop("place")
    codes = by_chunk(placed.drop("text"))
    pieces = codes.mapInArrow(_border_matrices, "c string, chunk long, m array<long>")
    ends = pieces.repartition("c").sortWithinPartitions("c", F.desc("chunk")).mapInArrow(
        _end_vectors, "chunk long, c string, v array<long>, opens boolean, closes boolean"
    )
    borders = ends.groupBy("chunk").agg(F.collect_list(F.struct("c", "v", "opens", "closes")).alias("borders"))  # at most two
    borders = materialize(borders, "conversation_borders")
    counts = [(f, pa.int64()) for f in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    done = pa.schema([("conv_id", to_arrow_type(kind)), *counts, ("audit", pa.string()), ("repaired", pa.string())])
    part = pa.schema([
        *done,
        *[pa.field(f, pa.int64()) for f in ("low", "high", "turns")], ("head", pa.string()), ("tail", pa.string()),
        ("c", pa.string()), ("chunk", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("closes", pa.bool_()),
    ])
    shown = lambda text: hashlib.sha256(text.encode()).hexdigest() if digest else text

    def whole_or_walks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for chunk, parts in _chunks(batches, text=True):
            out = []
            for p in parts:
                at = next((b for b in p["borders"] or () if b["c"] == p["c"]), None)
                facts = Facts.of(p["entries"])
                if at is None or (at["opens"] and at["closes"]):
                    audit, kept, state, cost = repair(p["entries"], END, START, costs)
                    more, added = ending(state)
                    out.append(_finished(p["conv_id"], facts, cost, audit + more, shown(said(kept + added))))
                    continue
                for start in range(4) if not at["opens"] else (START,):
                    audit, kept, state, cost = repair(p["entries"], at["v"], start, costs)
                    own = _finished(p["conv_id"], facts, cost, audit, "".join(f"{r}:{t}\n" for r, t in kept))
                    out.append(own | asdict(facts) | {"c": p["c"], "chunk": chunk, "start": start, "stop": state, "closes": at["closes"]})
            yield from _batch(out, part)

    def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From walks by (c, chunk): those that fit together, joined."""
        now = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["c"] != now:
                    now, state, place, facts, cost, audit = r["c"], START, None, Facts(), r["cost"], []
                    text, sha, size = [], hashlib.sha256(), 0
                if r["chunk"] == place or r["start"] != state:
                    continue  # another start of a piece
                place, state = r["chunk"], r["stop"]
                facts += Facts(*[r[f.name] for f in fields(Facts)])
                audit.append(r["audit"])
                own = r["repaired"]
                if r["closes"]:
                    more, added = ending(state)
                    audit.append(more)
                    own += "".join(f"{x}:{t}\n" for x, t in added)
                if digest:  # the newline at the end of all waits for more
                    sha.update((b"\n" if size and own else b"") + own[:-1].encode())
                    size += len(own)
                else:
                    text.append(own)
                if r["closes"]:
                    shown_text = sha.hexdigest() if digest else "".join(text)[:-1]
                    yield from _batch([_finished(r["conv_id"], facts, cost, "".join(audit), shown_text)], done)

    name = kind.simpleString()
    found = by_chunk(placed.join(borders, "chunk", "left")).mapInArrow(whole_or_walks, DONE.format(kind=name) + PIECE)
    found = materialize(found, "conversation_walks")
    whole = found.where("c is null").select(*done.names)
    long = found.where("c is not null").repartition("c").sortWithinPartitions("c", "chunk", "start")
    return whole.unionByName(long.mapInArrow(chained, DONE.format(kind=name)))
