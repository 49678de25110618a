"""Cheapest repair of conversations by weighted interval parsing.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. The grammar is in
Chomsky normal form: its nonterminals are the pairs (p, q) of places in that pattern, "what
leads from p to q", with the rules (p, q) -> (p, r) (r, q). A row derives (p, q) by being kept,
given another role or deleted; inserted rows may come before it (the insertion closure). A
span's cell holds the least (cost, audit) of each nonterminal. Spans are combined bottom-up by
their length, doubling; since every (p, q) derives by any split of a span if by one, one split
of each span gives the minimum over all. Two audits of equal cost in one cell never are
prefixes of each other (what is longer inserts more), so the least of joined audits is joined
from the least ones.

Rows are dealt by ranges of (conversation, turn), so a large conversation is parsed by many
tasks and its cells are combined in order. The repaired rows are streamed in order by
conversation, which a digest over a conversation demands; none is held as a whole but for its
audit, one character a row.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.llm.session import materialised
from peerscope.llm.words import texts_of

#: Costs of the edits, and of a row that stays though it is truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Places in the pattern: at the start, after s, after u, after a; where it may end.
PLACES, ENDS = 4, (0, 3)
#: (place, initial) -> place.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
#: What a row is to the grammar: sound, truncated, or one that must go.
SOUND, CUT, GONE = 0, 1, 2

Cell = list  # PLACES x PLACES of (cost, audit) or None, by rows


def joined(left: Cell, right: Cell) -> Cell:
    """(p, q) -> (p, r) (r, q): the least of each pair over r."""
    out = [None] * (PLACES * PLACES)
    for p in range(PLACES):
        for r in range(PLACES):
            a = left[p * PLACES + r]
            if a is not None:
                for q in range(PLACES):
                    b = right[r * PLACES + q]
                    if b is not None:
                        both, at = (a[0] + b[0], a[1] + b[1]), p * PLACES + q
                        if out[at] is None or both < out[at]:
                            out[at] = both
    return out


def _closure() -> Cell:
    """What insertions alone lead to."""
    one = [(0, "") if p == q else None for p in range(PLACES) for q in range(PLACES)]
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            one[p * PLACES + q] = (INSERT, "I")
    while (more := joined(one, one)) != one:
        one = more
    return one


CLOSURE = _closure()


@lru_cache(maxsize=64)
def row_cell(initial: str, kind: int) -> Cell:
    """A row's cell, insertions before it included."""
    out = [None] * (PLACES * PLACES)
    more = TRUNCATED if kind == CUT else 0
    arcs = [(p, p, (DELETE, "D")) for p in range(PLACES)]
    if kind != GONE:
        arcs += [(p, q, (more, "K")) for (p, i), q in STEPS.items() if i == initial]
        arcs += [(p, q, (REROLE + more, "R")) for (p, i), q in STEPS.items() if i in ROLES]
    for p, q, edit in arcs:
        at = p * PLACES + q
        out[at] = edit if out[at] is None else min(out[at], edit)
    return joined(CLOSURE, out)


def deleted_cell(rows: int) -> Cell:
    """So many rows that must go, one after the other: an insertion between them would come
    cheaper, in the order of audits, after them."""
    return [(DELETE * rows, "D" * rows) if p == q else None
            for p in range(PLACES) for q in range(PLACES)]


class Spans:
    """Cells of spans whose lengths are falling powers of two: the last two of a length are
    joined to one of the next length."""

    def __init__(self):
        self.held: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        length = 1
        while self.held and self.held[-1][0] == length:
            cell = joined(self.held.pop()[1], cell)
            length *= 2
        self.held.append((length, cell))

    def whole(self) -> Cell:
        cell = self.held[-1][1]
        for _, left in reversed(self.held[:-1]):
            cell = joined(left, cell)
        return cell


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    done = joined(cell, CLOSURE)
    return min(done[q] for q in ENDS if done[q] is not None)


def audit_of(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the rows (initial, kind)."""
    spans = Spans()
    for initial, kind in rows:
        spans.add(row_cell(initial, kind))
    return cheapest(spans.whole()) if rows else (0, "")


def damaged(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``df`` (id, turn, role, text) with faults by crc32(``id:turn``) modulo 20: 0 drops the
    row, 1 empties its text, 2 takes out its full stops, 3 repeats it, 4 makes its role user.
    Nulls in role, text and the hashed string are one blank; null ids and turns stay null."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank(id_col), F.lit(":"), blank("turn"))) % 20
    rows = df.select(id_col, "turn", blank("role").alias("role"), blank("text").alias("text"),
                     fault.alias("__fault")).filter("__fault != 0")
    text = (F.when(F.col("__fault") == 1, "").when(
        F.col("__fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("__fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("__fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))))
    return rows.select(id_col, "turn", role.alias("role"), text.alias("text"), copies).drop("col")


_FRAGMENT = ("conv_id long, part int, illegal long, first string, last string, "
             "costs array<long>, audits array<string>")
_FRAGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string()))])
_LEGAL = frozenset(("su", "ua", "au"))


def _fragments(batches):
    """Sorted rows of a partition -> a cell for each conversation's rows in it."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    out, now, spans, illegal, first, last = [], None, None, 0, "", ""

    def done():
        cell = spans.whole()
        out.append({"conv_id": now[0], "part": part, "illegal": illegal, "first": first,
                    "last": last, "costs": [c and c[0] for c in cell],
                    "audits": [c and c[1] for c in cell]})

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "initial", "kind", "copies"))
        for conv, initial, kind, copies in zip(*columns):
            if now != (conv,):
                if now:
                    done()
                now, spans, illegal, first = (conv,), Spans(), 0, initial
            else:
                illegal += last + initial not in _LEGAL
            spans.add(row_cell(initial if initial in "sua" else "", kind))
            if copies > 1:
                spans.add(deleted_cell(copies - 1))
                illegal += copies - 1
            last = initial
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, _FRAGMENTS)
            out.clear()
    if now:
        done()
    yield pa.RecordBatch.from_pylist(out, _FRAGMENTS)


_FOUND = T.StructType().add("illegal", "long").add("cost", "long").add("audit", "string")


@F.arrow_udf(_FOUND)
def _combined(fragments: pa.Array) -> pa.Array:
    """A conversation's fragments, in order -> illegal pairs, cost and audit."""
    found = []
    for each in fragments:
        spans, illegal, last = Spans(), 0, None
        for f in each.as_py():
            spans.add([None if c is None else (c, a) for c, a in zip(f["costs"], f["audits"])])
            illegal += f["illegal"] + (last is not None and last + f["first"] not in _LEGAL)
            last = f["last"]
        cost, audit = cheapest(spans.whole())
        found.append({"illegal": illegal, "cost": cost, "audit": audit})
    return pa.array(found, pa.struct([("illegal", pa.int64()), ("cost", pa.int64()),
                                      ("audit", pa.string())]))


def sequenced(df: DataFrame) -> DataFrame:
    """Equal rows of (conv_id, turn, role, text) as one with their number, and ``mark``, a
    digest of the text that orders rows of one turn and role. Written once."""
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.col("turn").cast("long").alias("turn"),
                     *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    return materialised(rows.groupBy("conv_id", "turn", "role", "text").agg(
        F.count("*").alias("copies")).withColumn("mark", F.unhex(F.sha2("text", 256))))


def judged(rows: DataFrame) -> DataFrame:
    """What the parse needs of ``rows``, without texts: conv_id, turn, role, mark, copies,
    initial, kind of the first copy, and how many copies are blank, duplicate, truncated."""
    word = "[^\\x20\\x09-\\x0D]"
    light = rows.select(
        "conv_id", "turn", "role", "mark", "copies", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(word)).alias("empty"),
        (~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).alias("cut"))
    seen = light.groupBy("conv_id", "role", "mark").agg(
        F.count("*").alias("turns"), F.min("turn").alias("from"),
        F.max(F.col("turn").isNull()).alias("none")).filter("turns > 1")
    seen = seen.select(F.col("conv_id").alias("c"), F.col("role").alias("r"),
                       F.col("mark").alias("m"), "from", "none")
    light = light.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (
        F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")), "left")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("none") | (
        F.col("turn") != F.col("from"))), F.lit(False))
    empty = F.col("empty")
    return materialised(light.select(
        "conv_id", "turn", "role", "mark", "copies", "initial",
        F.when(empty | again, GONE).when(F.col("cut"), CUT).otherwise(SOUND).alias("kind"),
        F.when(empty, F.col("copies")).otherwise(0).alias("blank"),
        F.when(~empty, F.col("copies") - 1 + again.cast("long")).otherwise(0).alias("duplicate"),
        (~empty & ~again & F.col("cut")).cast("long").alias("truncated")))


def repairs(df: DataFrame, rows: DataFrame) -> DataFrame:
    """For every conv_id of ``df``, also those without ``rows`` (as ``sequenced`` gives them):
    gaps, blank, duplicate, truncated, illegal, cost, audit."""
    light = judged(rows)
    counts = light.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"),
                   F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "mark"]
    cells = (light.repartitionByRange(n, *order).sortWithinPartitions(*order)
             .select("conv_id", "initial", "kind", "copies")
             .mapInArrow(_fragments, _FRAGMENT))
    found = cells.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "part", "illegal", "first", "last", "costs", "audits"))).alias("fragments")).select(
        "conv_id", _combined("fragments").alias("found"))
    out = df.select(F.col("conv_id").cast("long").alias("id")).distinct()
    for more in (counts, found):
        out = out.join(more, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    longs = {c: F.col(c) for c in ("gaps", "blank", "duplicate", "truncated")}
    longs |= {c: F.col(f"found.{c}") for c in ("illegal", "cost")}
    return materialised(out.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in longs.items()),
        F.coalesce("found.audit", F.lit("")).alias("audit")))


def edited(audit: str, rows):
    """(edit, role, text) of the rows that an audit leaves, from (role, text, copies) in order;
    deleted rows are left out."""
    place, at = 0, 0

    def inserted():
        nonlocal place, at
        while at < len(audit) and audit[at] == "I":
            role = "a" if place == 2 else "u"
            place, at = STEPS[place, role], at + 1
            yield "I", ROLES[role], ""

    for role, text, copies in rows:
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit != "D":
            if edit == "R":
                role = ROLES["a" if place == 2 else "u"]
            place = STEPS[place, role[:1]]
            yield edit, role, text
        at += copies - 1
    yield from inserted()


_STREAM = ["conv_id", "row", "turn", "role", "mark", "text", "copies", "audit"]
_REPAIRED = "conv_id long, position long, edit string, role string, text string"
_REPAIRED_ROWS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()),
                            ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_DIGEST = "id long, sha256 string"
_DIGESTS = pa.schema([("id", pa.int64()), ("sha256", pa.string())])


def _by_conversation(batches):
    """(conv_id, audit, iterator over its rows) for the sorted stream, one after the other;
    rows that the taker leaves are passed over."""
    def each():
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv_id", "audit", "role", "copies")]
            yield from zip(*columns, texts_of(batch["text"]))

    stream = each()
    head = next(stream, None)
    while head is not None:
        following = None

        def rows():
            nonlocal following
            for row in stream:
                if row[1] is not None:  # the next conversation's first row
                    following = row
                    return
                yield row[2], row[4], row[3]

        mine = rows()
        yield head[0], head[1], mine
        for _ in mine:
            pass
        head = following


def _repaired(batches):
    out, size = [], 0
    for conv, audit, rows in _by_conversation(batches):
        for i, (edit, role, text) in enumerate(edited(audit, rows)):
            out.append({"conv_id": conv, "position": i, "edit": edit, "role": role, "text": text})
            size += len(text) + 64
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, _REPAIRED_ROWS)
                out, size = [], 0
    yield pa.RecordBatch.from_pylist(out, _REPAIRED_ROWS)


def _digested(batches):
    out = []
    for conv, audit, rows in _by_conversation(batches):
        sha = hashlib.sha256()
        for i, (_, role, text) in enumerate(edited(audit, rows)):
            sha.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        out.append({"id": conv, "sha256": sha.hexdigest()})
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, _DIGESTS)
            out = []
    yield pa.RecordBatch.from_pylist(out, _DIGESTS)


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A conversation's audit and then its rows in order, each conversation in one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = found.select("conv_id", F.lit(0).alias("row"), none("long").alias("turn"),
                         none("string").alias("role"), none("binary").alias("mark"),
                         none("string").alias("text"), none("long").alias("copies"), "audit")
    body = rows.select("conv_id", F.lit(1).alias("row"), "turn", "role", "mark", "text", "copies",
                       none("string").alias("audit"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return heads.union(body).repartition(n, "conv_id").sortWithinPartitions(
        "conv_id", "row", "turn", "role", "mark")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, edit (K, R or I), role, text."""
    return _streamed(rows, found).mapInArrow(_repaired, _REPAIRED)


def with_digest(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with repaired_sha256, over the repaired rows' ``role:text``, joined by newlines
    (of nothing where no row is left)."""
    sums = _streamed(rows, found).mapInArrow(_digested, _DIGEST)
    return found.join(sums, F.col("conv_id").eqNullSafe(F.col("id"))).select(
        *found.columns, F.col("sha256").alias("repaired_sha256"))


def repair(df: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, found) of the conversations in ``df`` (conv_id, turn, role, text): its rows in the
    form that ``repaired_rows`` and ``with_digest`` take, and a row for each conv_id with

    * gaps: turns missing between the least and the greatest one, nulls apart;
    * blank, duplicate, truncated: rows by their first fault (no word; role and text seen
      before; a last character of words other than ``.!?``);
    * illegal: neighbours whose roles' initials are not su, ua or au;
    * cost, audit: the cheapest edits (K keep, R rerole to user or assistant at 1, D delete at
      2, I insert an empty user or assistant at 5; a truncated row that stays costs 5 more;
      blank and duplicate rows must go), of equal cost the least in ASCII.

    Rows are taken by turn, null first; rows of one turn by role and a digest of the text. Null
    roles and texts are one blank. Rows without a conv_id are one conversation, of null id. A
    role of another initial than s, u and a can only be rerolled or deleted. Conversations of
    ``conversations`` (default ``df``) that have no rows get zeros and an empty audit; an empty
    table gives no rows. Other columns are ignored.
    """
    rows = sequenced(df)
    return rows, repairs(df if conversations is None else conversations, rows)
