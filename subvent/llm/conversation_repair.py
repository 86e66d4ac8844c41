"""Repair of the turn structure of conversations at the least cost.

A conversation is rows in order of turn. Each row is kept, given another role, or deleted, and empty turns may be inserted, so
that the roles' initials read s?(ua)+ or nothing. An edit script is written as its audit, a letter per edit.

1. Costs. From the last row back, the least cost of repairing the rest from each state of a small automaton (nothing yet, after
   s, after u, after a). A node is a place between rows and a state; an arc is an edit, and optimal if the costs on both sides
   agree.
2. Ranks. Nodes are ranked by the first letter of their audits, then by the first 2, 4, 8, ... letters: the rank of twice as many
   is that of a node's rank and the rank of the node that its pointer leads to, and pointers double. Of a node's optimal arcs the
   one of least letter is taken, and of equal letters the one to the node of least rank, until no choice changes.
3. Path. The letter at any place of an audit is reached from the first node through the doubled pointers that the bits of the place
   name, so the audits of all conversations of a task are read at once.
4. Texts. Rows meet their conversation's audit in the order of the edits and pass by once, a batch at a time.

The first pass moves a few bytes per row and no text. A task holds about a kB per row of the conversations it works on, and no text
beyond a batch: the hash of a conversation's text needs its rows in one order in one task, but never all of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subvent.llm.common import column

#: Costs of the edits, and of keeping a truncated row.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of conversations that a task plans at once.
ROWS_AT_ONCE = 1 << 16
#: States: nothing yet, after s, after u, after a. The state that u, a and s lead to; -1 where they may not stand.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_STEP = {"s": (AFTER_S, -1, -1, -1), "u": (AFTER_U, AFTER_U, -1, AFTER_U), "a": (-1, -1, AFTER_A, -1)}
#: The state that a row or an insert of a free role leads to.
_FREE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_LETTERS = b"DIKR"  # in ASCII order
_NEVER = np.int64(1) << 40

PLAN = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
REPORT = [f.split()[0] for f in PLAN.split(", ")]
REPAIRED = f"place bigint, role string, text string, edit string, {PLAN}, repaired_sha256 string"


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; NULL as one space in the last two) with faults that their ids name.

    The remainder by 20 of crc32("conv_id:turn") drops a row (0), empties its text (1), takes out its ``.!?`` (2), repeats it (3) or makes
    its role user (4). A dropped row stays, marked ``gone``, so that its conversation is known.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    damaged = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    )
    return damaged.drop("_copy")


def _doubled(letters: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ranks of the nodes by their audits, the pointers that lead 1, 2, 4, ... letters on, and the audits' lengths.

    ``letters`` is 0 at a node where an audit ends, which ``follow`` leads back to.
    """
    ranks = letters.astype(np.int64)
    lengths = (letters > 0).astype(np.int64)
    jumps = [follow]
    while True:
        far = jumps[-1]
        longer = lengths[far] > 0
        if not longer.any():
            return ranks, jumps, lengths
        _, ranks = np.unique(ranks * (ranks.max() + 1) + ranks[far], return_inverse=True)
        lengths = lengths + lengths[far]
        jumps.append(far[far])


def least_paths(letters: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For nodes with some arcs each (``letters`` 0: no arc; ``targets``): the least audit's first letter, pointers and lengths.

    Between nodes of which no optimal arc leads back, taking the least letter and then the least rank again and again ends at the least
    audit of every node.
    """
    nodes = np.arange(len(letters))
    order = np.where(letters > 0, letters, 255).astype(np.int64)
    pick = order.argmin(axis=1)
    while True:
        first = letters[nodes, pick]
        follow = np.where(first > 0, targets[nodes, pick], nodes).astype(np.int32)
        ranks, jumps, lengths = _doubled(first, follow)
        better = (order * (len(nodes) + 1) + np.where(letters > 0, ranks[targets], 0)).argmin(axis=1)
        if (better == pick).all():
            return first, jumps, lengths
        pick = better


def audits(initials: np.ndarray, faults: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The least cost and the least audit of each conversation.

    ``initials`` are the roles' first letters (ASCII, 0 for others), ``faults`` 0, 1 (blank), 2 (duplicate) or 3 (truncated), row
    after row; ``counts`` are the rows of each conversation.
    """
    conversations, total = len(counts), int(counts.sum())
    first_row = np.cumsum(counts) - counts
    first_node = first_row + np.arange(conversations)  # a conversation has a place more than rows
    places = total + conversations
    cost = np.full((places, 4), _NEVER)
    letters, targets = np.zeros((places, 4, 4), np.uint8), np.zeros((places, 4, 4), np.int32)
    moves = np.full((256, 4), -1)
    for name, to in _STEP.items():
        moves[ord(name)] = to
    free = np.asarray(_FREE)
    by_length = np.argsort(-counts, kind="stable")
    lengths = counts[by_length]
    alive = conversations
    for back in range(int(counts.max(initial=0)) + 1):
        alive = int(np.searchsorted(-lengths, -back, side="right"))
        some = by_length[:alive]
        at = first_node[some] + counts[some] - back
        options = np.full((alive, 4, 4), _NEVER)  # conversation, state, letter
        goal = np.zeros((alive, 4, 4), np.int64)
        if back == 0:
            base = np.tile(np.asarray([0, _NEVER, _NEVER, 0]), (alive, 1))
        else:
            row = first_row[some] + counts[some] - back
            rest, fault = cost[at + 1], faults[row]
            stays = np.where((fault == 1) | (fault == 2), _NEVER, np.where(fault == 3, TRUNCATED, 0))[:, None]
            options[:, :, 0] = rest + DELETE
            goal[:, :, 0] = np.arange(4)
            kept = moves[initials[row]]
            options[:, :, 2] = np.where(kept < 0, _NEVER, np.take_along_axis(rest, np.maximum(kept, 0), 1)) + stays
            goal[:, :, 2] = np.maximum(kept, 0)
            options[:, :, 3] = rest[:, free] + stays + RENAME
            goal[:, :, 3] = free
            base = options.min(axis=2)
        u = np.minimum(base[:, AFTER_U], base[:, AFTER_A] + INSERT)
        a = np.minimum(base[:, AFTER_A], base[:, AFTER_U] + INSERT)
        here = np.stack([np.minimum(base[:, START], u + INSERT), np.minimum(base[:, AFTER_S], u + INSERT), u, a], axis=1)
        cost[at] = here
        options[:, :, 1] = here[:, free] + INSERT
        tight = (options == here[:, :, None]) & (here[:, :, None] < _NEVER)
        letters[at] = np.where(tight, np.frombuffer(_LETTERS, np.uint8), 0)
        goal[:, :, 1] = free
        place = np.where(np.arange(4) == 1, at[:, None], at[:, None] + 1)  # an insert stays at its place
        targets[at] = np.where(tight, 4 * place[:, None, :] + goal, 0)
    first, jumps, lengths = least_paths(letters.reshape(-1, 4), targets.reshape(-1, 4))
    starts = 4 * first_node
    sizes = lengths[starts]
    ends = np.cumsum(sizes)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    node = np.repeat(starts, sizes)
    for k, jump in enumerate(jumps):
        on = (step >> k) & 1 == 1
        node[on] = jump[node[on]]
    written = first[node].tobytes()
    return cost[first_node, START], [written[i:j] for i, j in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _bounds(conv: pa.Array) -> np.ndarray:
    """The first row of each conversation, among rows in their order."""
    known = conv.is_valid().to_numpy(zero_copy_only=False)
    value = conv.fill_null(0).to_numpy()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (known[1:] != known[:-1])
    return np.flatnonzero(new)


def plan_conversations(part: pa.Table) -> pa.RecordBatch:
    """What ``PLAN`` holds for each conversation of whole, ordered conversations without their texts."""
    conv = column(part, "conv_id")
    starts = _bounds(conv)
    owner = np.repeat(np.arange(len(starts)), np.diff([*starts, len(conv)]))
    present = ~column(part, "gone").to_numpy(zero_copy_only=False)
    ids = conv.take(pa.array(starts))
    owner, rows = owner[present], part.filter(pa.array(present))
    counts = np.bincount(owner, minlength=len(starts))
    head = np.ones(len(owner), bool)
    head[1:] = owner[1:] != owner[:-1]

    turn = column(rows, "turn")
    known = turn.is_valid().to_numpy(zero_copy_only=False)
    value = turn.fill_null(0).to_numpy()[known]
    of = owner[known]
    differs = np.ones(len(of), bool)
    differs[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    new_of = np.ones(len(of), bool)
    new_of[1:] = of[1:] != of[:-1]
    gaps = np.zeros(len(starts), np.int64)
    if len(of):
        first = np.flatnonzero(new_of)
        last = np.append(first[1:], len(of)) - 1
        gaps[of[first]] = value[last] - value[first] + 1 - np.add.reduceat(differs.astype(np.int64), first)

    role = column(rows, "role").dictionary_encode()
    letter = np.asarray([ord(r[0]) if r[:1] in ("s", "u", "a") else 0 for r in role.dictionary.to_pylist()] or [0], np.uint8)
    role = np.asarray(role.indices)
    digest = np.frombuffer(b"".join(column(rows, "digest").to_pylist()), "<u8").reshape(-1, 2)
    blank = column(rows, "blank").to_numpy(zero_copy_only=False)
    order = np.lexsort((np.arange(len(owner)), digest[:, 1], digest[:, 0], role, owner))
    again = np.zeros(len(owner), bool)
    if len(owner) > 1:
        a, b = order[1:], order[:-1]
        again[a] = (owner[a] == owner[b]) & (role[a] == role[b]) & (digest[a] == digest[b]).all(axis=1)
    stopped = column(rows, "stopped").to_numpy(zero_copy_only=False)
    faults = np.where(blank, 1, np.where(again, 2, np.where(stopped, 0, 3)))
    initials = letter[role] if len(role) else np.zeros(0, np.uint8)
    wrong = np.zeros(len(owner), bool)
    if len(owner) > 1:
        pairs = 256 * initials[:-1].astype(np.int64) + initials[1:]
        wrong[1:] = ~head[1:] & ~np.isin(pairs, [256 * x + y for x, y in (b"su", b"ua", b"au")])
    cost, audit = audits(initials, faults, counts)
    per = lambda mask: pa.array(np.bincount(owner[mask], minlength=len(starts)).astype(np.int64))
    columns = [ids, pa.array(gaps), per(faults == 1), per(faults == 2), per(faults == 3), per(wrong), pa.array(cost)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([a.decode() for a in audit], pa.string())], REPORT)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations of ordered batches, about ROWS_AT_ONCE rows at a time."""
    held: list[pa.Table] = []
    rows, open_at = 0, 0  # rows held, and the first of them that is of the last conversation
    last: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        starts = _bounds(ids)
        if last == [ids[0].as_py()]:
            starts = starts[1:]  # goes on
        if len(starts):
            open_at = rows + int(starts[-1])
        last = [ids[-1].as_py()]
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= ROWS_AT_ONCE and open_at:
            whole = pa.concat_tables(held)
            yield plan_conversations(whole.slice(0, open_at))
            held, rows, open_at = [whole.slice(open_at)], rows - open_at, 0
    if rows:
        yield plan_conversations(pa.concat_tables(held))


class _Writer:
    """Applies an audit to the rows of its conversation as they pass by."""

    def __init__(self, report: dict, keep: bool):
        self.report, self.keep = report, keep
        self.audit, self.at, self.state, self.place = report["audit"], 0, START, 0
        self.hash = hashlib.sha256()

    def _put(self, role: str, text: str, edit: str, to: int, out: list) -> None:
        self.hash.update((("\n" if self.place else "") + f"{role}:{text}").encode())
        self.place += 1
        self.state = to
        if self.keep:
            out.append((self.report["conv_id"], self.place, role, text, edit))

    def _free(self) -> tuple[str, int]:
        to = _FREE[self.state]
        return ("user" if to == AFTER_U else "assistant"), to

    def inserts(self, out: list) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            role, to = self._free()
            self._put(role, "", "I", to, out)
            self.at += 1

    def row(self, role: str, text: str, out: list) -> None:
        self.inserts(out)
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text, edit, _STEP[role[0]][self.state], out)
        elif edit == "R":
            role, to = self._free()
            self._put(role, text, edit, to, out)


def _write(keep: bool):
    names = [f.split()[0] for f in REPAIRED.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in REPAIRED.split(", ")])

    def table(rows: list, ended: list) -> pa.RecordBatch:
        out = {c: [] for c in names}
        for conv, place, role, text, edit in rows:
            for c, v in zip(("conv_id", "place", "role", "text", "edit"), (conv, place, role, text, edit), strict=True):
                out[c].append(v)
        for c in set(names) - {"conv_id", "place", "role", "text", "edit"}:
            out[c] += [None] * len(rows)
        for writer in ended:
            done = writer.report | {"place": 0, "repaired_sha256": writer.hash.hexdigest()}
            for c in names:
                out[c].append(done.get(c))
        return pa.RecordBatch.from_pydict(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            rows: list = []
            ended: list = []
            for report, role, text in zip(*[batch.column(c).to_pylist() for c in ("report", "role", "text")], strict=True):
                if report is not None:
                    if writer:
                        writer.inserts(rows)
                        ended.append(writer)
                    writer = _Writer(report, keep)
                else:
                    writer.row(role, text, rows)
            yield table(rows, ended)
        if writer:
            rows = []
            writer.inserts(rows)
            yield table(rows, [writer])

    return run


def repair(rows: DataFrame, gone: str | Column = "gone", texts: bool = True) -> DataFrame:
    """The repaired rows and a report per conversation of ``rows`` (conv_id, turn, role, text).

    A row with ``place`` 0 is a conversation's report: ``gaps`` in its turns, rows whose first fault is ``blank``, ``duplicate`` or
    ``truncated``, ``illegal`` pairs of neighbours, the least ``cost``, the least ``audit`` and the hash of the repaired rows. The others,
    left out unless ``texts``, are the repaired rows: ``place`` from 1, ``role``, ``text`` and ``edit``. Conversations of which every row
    is ``gone`` have a report of zeros. Rows are in order of turn, NULL first, then role, then the MD5 of the text; a NULL role or text is
    one space; a role that starts with none of s, u and a cannot be kept. Rows without a conv_id are one conversation. An
    empty table gives no rows; other columns are not read.
    """
    white = r"\x20\x09-\x0D"
    gone = F.col(gone) if isinstance(gone, str) else gone
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    keyed = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
        F.coalesce(gone, F.lit(False)).alias("gone"), F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )
    flags = keyed.select(
        "conv_id", "turn", "role", "digest", "gone",
        (~F.col("text").rlike(f"[^{white}]")).alias("blank"), F.col("text").rlike(rf"[.!?][{white}]*\z").alias("stopped"),
    )
    ordered = flags.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    plan = ordered.mapInArrow(_plan, PLAN).select(
        "conv_id", F.lit(0).alias("after"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.struct(*REPORT).alias("report"),
    )
    kinds = plan.schema["report"].dataType
    passing = keyed.filter("NOT gone").select(
        "conv_id", F.lit(1).alias("after"), "turn", "role", "digest", "text", F.lit(None).cast(kinds).alias("report")
    )
    met = plan.unionByName(passing).repartition("conv_id").sortWithinPartitions("conv_id", "after", "turn", "role", "digest")
    return met.select("report", "role", "text").mapInArrow(_write(texts), REPAIRED)


def reports(repaired: DataFrame) -> DataFrame:
    return repaired.filter("place = 0").select(*REPORT, "repaired_sha256")


def repaired_rows(repaired: DataFrame) -> DataFrame:
    return repaired.filter("place > 0").select("conv_id", "place", "role", "text", "edit")
