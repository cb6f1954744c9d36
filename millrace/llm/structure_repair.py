"""Cheapest repair of conversation structure: cost programs over blocks of rows, and the least audit by prefix doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.turns import joined_sha256, numbered
from millrace.session import settle

#: Rows of a conversation that are one task's smallest unit; longer conversations are put together from such blocks.
BLOCK = 1024
#: Rows that are worked on at once.
BATCH_ROWS = 50_000

# The structure (s?(ua)+)? as an automaton: nothing yet, after s, after u, after a.
INITIALS = "sua"
STATES = 4
START = 0
ENDS = (0, 3)
#: State after an initial, -1 where none fits. Columns: s, u, a, any other.
STEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: The one role (1 user, 2 assistant) that an insertion or a new role may have in each state, and where it leads.
FILL = np.array([1, 1, 2, 1])
AFTER_FILL = np.array([2, 2, 3, 2])

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FAR = 1 << 40

SPACE = r"[\x20\x09-\x0D]"
FAULTS = {"blank": 1, "duplicate": 2, "truncated": 3}
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with nulls as one space (conv_id and turn: only in the key), damaged by the key's CRC-32.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), plain("role").alias("role"), plain("text").alias("text"), key.alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("harm") == 3, 2).otherwise(1)
    kept = rows.where("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return kept.drop("copy")


def faulty(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, fault, initial, role, text) in order of turn (nulls first), then role and text.

    fault is the first that counts: 1 blank, 2 duplicate (role and text seen earlier in the conversation), 3 truncated,
    else 0; initial is 0 to 3 for s, u, a, any other.
    """
    placed = numbered(rows.select("conv_id", "turn", "role", "text"), ["turn", "role", "text"])
    same = [F.xxhash64("role", "text").alias("one"), F.xxhash64(F.lit(1), "text", "role").alias("two")]
    seen = placed.groupBy("conv_id", *same).agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    seen = seen.select(F.col("conv_id").alias("own"), F.col("one").alias("own_one"), F.col("two").alias("own_two"), "first")
    known = placed.withColumns({"one": same[0], "two": same[1]})
    joined = known.join(seen, F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("one") == F.col("own_one")) & (F.col("two") == F.col("own_two")), "left")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), FAULTS["blank"])
        .when(F.col("at") > F.col("first"), FAULTS["duplicate"])
        .when(~F.col("text").rlike(rf"[.!?]{SPACE}*\z"), FAULTS["truncated"])
        .otherwise(0)
    )
    place = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.col("role") != "") & (place > 0), place - 1).otherwise(len(INITIALS))
    return settle(joined.select("conv_id", "at", "turn", fault.cast("int").alias("fault"), initial.cast("int").alias("initial"), "role", "text"), "faulty")


def counts(rows: DataFrame) -> DataFrame:
    """Per conversation of ``faulty`` rows: gaps, blank, duplicate, truncated and illegal."""
    per_turn = rows.groupBy("conv_id", "turn").agg(*[F.count(F.when(F.col("fault") == n, 1)).alias(name) for name, n in FAULTS.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    basic = per_turn.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(name).alias(name) for name in FAULTS])
    # Neighbours inside blocks, then those across the border of two blocks.
    fits = lambda a, b: ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    marked = rows.select("conv_id", "at", "initial", F.floor((F.col("at") - 1) / BLOCK).alias("block"))
    marked = marked.withColumn("before", F.lag("initial").over(Window.partitionBy("conv_id", "block").orderBy("at")))
    bad = F.count(F.when(F.col("before").isNotNull() & ~fits(F.col("before"), F.col("initial")), 1))
    blocks = marked.groupBy("conv_id", "block").agg(bad.alias("bad"), F.min_by("initial", "at").alias("first"), F.max_by("initial", "at").alias("last"))
    blocks = blocks.withColumn("before", F.lag("last").over(Window.partitionBy("conv_id").orderBy("block")))
    across = (F.col("before").isNotNull() & ~fits(F.col("before"), F.col("first"))).cast("bigint")
    illegal = blocks.groupBy("conv_id").agg(F.sum(F.col("bad") + F.coalesce(across, F.lit(0))).alias("illegal"))
    renamed = illegal.select(F.col("conv_id").alias("own"), "illegal")
    return basic.join(renamed, F.col("conv_id").eqNullSafe(F.col("own"))).drop("own")


def _with_insertions(cost: np.ndarray) -> np.ndarray:
    """Least costs to the end, by state (axis 1), where roles may first be inserted. Any cheapest way inserts fewer
    roles at one place than there are states."""
    for _ in range(STATES):
        cost = np.minimum(cost, INSERT + cost[:, AFTER_FILL])
    return cost


def _row_costs(after: np.ndarray, fault: np.ndarray, initial: np.ndarray) -> dict[str, np.ndarray]:
    """Cost to the end by edit and state, from the costs after the row. after: (rows, states, ...)."""
    extra = TRUNCATED * (fault == 3)
    must = (fault == 1) | (fault == 2)
    shape = (len(after),) + (1,) * (after.ndim - 2)
    keep, rerole = np.empty_like(after), np.empty_like(after)
    for q in range(STATES):
        to = STEP[q][initial]
        keep[:, q] = np.where(((to < 0) | must).reshape(shape), FAR, after[np.arange(len(after)), to] + extra.reshape(shape))
        rerole[:, q] = np.where(must.reshape(shape), FAR, after[:, AFTER_FILL[q]] + (REROLE + extra).reshape(shape))
    return {"D": after + DELETE, "K": keep, "R": rerole}


def suffix_costs(begin: np.ndarray, length: np.ndarray, fault: np.ndarray, initial: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """The cost program of many blocks at once, backwards: for every place of every block the least costs to its end.

    ``last`` has the costs at the blocks' ends, (blocks, states, ...). Item k of the result is for the place k rows
    before the end, with the blocks of at least k rows in descending order of length.
    """
    order = np.argsort(-length, kind="stable")
    out = [last[order]]
    for k in range(1, int(length.max(initial=0)) + 1):
        some = order[: int((length >= k).sum())]
        row = begin[some] + length[some] - k
        edits = _row_costs(out[-1][: len(some)], fault[row], initial[row])
        out.append(_with_insertions(np.minimum(np.minimum(edits["D"], edits["K"]), edits["R"])))
    return out


def transfer(begin: np.ndarray, length: np.ndarray, fault: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """(blocks, state at the begin, state at the end): least costs through each block."""
    same = np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)
    costs = suffix_costs(begin, length, fault, initial, np.repeat(same[None], len(begin), 0))
    out = np.empty((len(begin), STATES, STATES), np.int64)
    order = np.argsort(-length, kind="stable")
    for k, c in enumerate(costs):
        ends = np.flatnonzero(length[order] == k)
        out[order[ends]] = c[ends]
    return np.minimum(out, FAR)


def final_costs() -> np.ndarray:
    cost = np.full((1, STATES), FAR, np.int64)
    cost[0, list(ENDS)] = 0
    return _with_insertions(cost)[0]


def optimal_arcs(begin: np.ndarray, length: np.ndarray, fault: np.ndarray, initial: np.ndarray, last: np.ndarray, is_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """After the cost program: (least cost of each node, and source, letter, target of each edit on a cheapest way).

    Nodes are numbered block by block, place by place, state by state. A block that is its conversation's last
    (``is_end``) may end with insertions; elsewhere they belong to the next block.
    """
    base = np.cumsum((length + 1) * STATES) - (length + 1) * STATES
    least = np.empty(int(((length + 1) * STATES).sum()), np.int64)
    order = np.argsort(-length, kind="stable")
    costs = suffix_costs(begin, length, fault, initial, last)
    arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(letter: str, source: np.ndarray, by: np.ndarray, target: np.ndarray) -> None:
        fit = (by == least[source]) & (by < FAR)
        arcs.append((source[fit], np.full(int(fit.sum()), ord(letter)), target[fit]))

    for k, cost in enumerate(costs):
        some = order[: len(cost)]
        at = base[some] + (length[some] - k) * STATES
        for q in range(STATES):
            least[at + q] = cost[:, q]
        row = begin[some] + length[some] - k
        edits = _row_costs(costs[k - 1][: len(some)], fault[row], initial[row]) if k else {}
        for q in range(STATES):
            inserted = INSERT + cost[:, AFTER_FILL[q]]
            if k:
                add("D", at + q, edits["D"][:, q], at + STATES + q)
                add("I", at + q, inserted, at + AFTER_FILL[q])
                add("K", at + q, edits["K"][:, q], at + STATES + STEP[q][initial[row]])
                add("R", at + q, edits["R"][:, q], at + STATES + AFTER_FILL[q])
            elif q not in ENDS:
                ends = is_end[some]
                add("I", (at + q)[ends], inserted[ends], (at + AFTER_FILL[q])[ends])
    source, letter, target = (np.concatenate(x) for x in zip(*arcs))
    return least, source, letter, target


def _least_arcs(source: np.ndarray, rank: np.ndarray, nodes: int) -> np.ndarray:
    """The arc of least rank of each node."""
    order = np.lexsort((rank, source))
    first = np.append(True, source[order][1:] != source[order][:-1]) if len(order) else np.zeros(0, bool)
    out = np.empty(nodes, np.int64)
    out[source[order[first]]] = order[first]
    return out


def least_paths(begin: np.ndarray, length: np.ndarray, fault: np.ndarray, initial: np.ndarray, last: np.ndarray, is_end: np.ndarray) -> dict[str, np.ndarray]:
    """The cheapest edits of each block from each state, of equal ones those with the least audit.

    Arcs are ranked by the first letter, then by 2, 4, 8 ... letters: a rank for twice as many letters is that of the
    pair (rank of the arc, rank of the arc that its way reaches after so many letters). Pointers to the reached arcs
    double with the ranks, and at each node the arc of least rank goes on. A letter leads from a state of this automaton to one
    state only, so arcs of one node never share a letter and a pointer is one arc; ways that end are the least. Paths
    are read off by pointers alone: step t of all paths at once follows the powers of two that make up t.
    """
    base = np.cumsum((length + 1) * STATES) - (length + 1) * STATES
    least, source, letter, target = optimal_arcs(begin, length, fault, initial, last, is_end)
    nodes = len(least)
    over = np.ones(nodes, bool)
    over[source] = False
    stops = np.flatnonzero(over)  # a way ends here: an arc to itself, with a letter below all others
    source, letter, target = np.append(source, stops), np.append(letter, np.zeros(len(stops), np.int64)), np.append(target, stops)
    rank = np.unique(letter, return_inverse=True)[1]
    steps = (letter > 0).astype(np.int64)
    pointers = [_least_arcs(source, rank, nodes)[target]]
    starts = (base[:, None] + np.arange(STATES)).ravel()
    while (letter[pointers[-1]] > 0).any():
        jump = pointers[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        steps = steps + steps[jump]
        pointers.append(jump[jump])
    own = _least_arcs(source, rank, nodes)[starts]
    size = steps[own] + steps[pointers[-1][own]]
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    arc = np.repeat(own, size)
    for k, jump in enumerate(pointers):
        moved = (step >> k) & 1 == 1
        arc[moved] = jump[arc[moved]]
    end = own
    for jump in pointers:
        end = jump[end]
    owner = np.repeat(np.arange(len(starts)) // STATES, size)
    inside = source[arc] - base[owner]
    return {
        "size": size,
        "letter": letter[arc],
        "row": inside // STATES,
        "role": FILL[inside % STATES],
        "exit": (target[end] - np.repeat(base, STATES)) % STATES,
        "cost": least[starts],
    }


def _by_block(work: Callable[[pa.Table, np.ndarray, np.ndarray], pa.RecordBatch]) -> Callable:
    """Runs ``work(rows, begins, lengths)`` on whole blocks, about BATCH_ROWS rows at a time. Rows come sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def starts(table: pa.Table) -> np.ndarray:
            ids = table["conv_id"].fill_null(0).to_numpy()
            known = table["conv_id"].is_valid().to_numpy()
            block = table["block"].to_numpy()
            edge = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]) | (block[1:] != block[:-1])
            return np.concatenate(([0], np.flatnonzero(edge) + 1))

        def done(table: pa.Table, begin: np.ndarray) -> pa.RecordBatch:
            return work(table, begin, np.diff(np.append(begin, table.num_rows)))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BATCH_ROWS:
                table = pa.Table.from_batches(held)
                begin = starts(table)
                cut = int(begin[-1])  # the last block may go on
                if cut:
                    yield done(table.slice(0, cut).combine_chunks(), begin[:-1])
                held = table.slice(cut).combine_chunks().to_batches()
                size = table.num_rows - cut
        if size:
            table = pa.Table.from_batches(held).combine_chunks()
            yield done(table, starts(table))

    return run


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["fault"].to_numpy().astype(np.int64), table["initial"].to_numpy().astype(np.int64)


def _matrices(table: pa.Table, begin: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    found = transfer(begin, length, *_columns(table)).reshape(len(begin), -1)
    heads = table.take(pa.array(begin))
    return pa.RecordBatch.from_arrays([heads["conv_id"].combine_chunks(), heads["block"].combine_chunks(), pa.array(list(found), pa.list_(pa.int64()))], names=["conv_id", "block", "matrix"])


PATHS = "conv_id bigint, block bigint, entry int, exit int, cost bigint, audit string, ats array<bigint>, roles array<int>"


def _paths(table: pa.Table, begin: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    fault, initial = _columns(table)
    heads = table.take(pa.array(begin))
    last = np.array(heads["last"].to_pylist(), np.int64)
    found = least_paths(begin, length, fault, initial, last, heads["is_end"].to_numpy())
    ends = np.cumsum(found["size"])
    at = table["at"].to_numpy()
    shown = found["letter"] != ord("D")
    inserted = found["letter"] == ord("I")
    block = np.repeat(np.repeat(np.arange(len(begin)), STATES), found["size"])
    own = at[np.minimum(begin[block] + found["row"], len(at) - 1)] if len(block) else np.zeros(0, np.int64)
    ats = np.where(inserted, 0, own)
    roles = np.where(found["letter"] == ord("K"), 0, found["role"])
    letters = found["letter"].astype(np.uint8).tobytes().decode("ascii")
    first_only = (heads["block"].to_numpy() == 0).tolist()
    ids, blocks = heads["conv_id"].to_pylist(), heads["block"].to_pylist()
    out: dict[str, list] = {name: [] for name in ("conv_id", "block", "entry", "exit", "cost", "audit", "ats", "roles")}
    for b in range(len(begin)):
        for q in range(1 if first_only[b] else STATES):
            i = b * STATES + q
            part = slice(int(ends[i] - found["size"][i]), int(ends[i]))
            seen = shown[part]
            for name, value in zip(out, (ids[b], blocks[b], q, int(found["exit"][i]), int(found["cost"][i]), letters[part], ats[part][seen], roles[part][seen])):
                out[name].append(value)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def _border_costs(table: pa.Table) -> pa.Table:
    """Costs at the end of each block of one conversation: its matrices combined from the last block back."""
    table = table.sort_by("block")
    cost = final_costs()
    out = []
    for matrix in reversed(table["matrix"].to_pylist()):
        out.append(cost.tolist())
        cost = np.minimum((np.array(matrix, np.int64).reshape(STATES, STATES) + cost[None]).min(1), FAR)
    return pa.table({"conv_id": table["conv_id"], "block": table["block"], "last": pa.array(out[::-1], pa.list_(pa.int64())), "is_end": pa.array([False] * (len(out) - 1) + [True])})


def _entries(table: pa.Table) -> pa.Table:
    """The state in which the chosen path of one conversation comes into each of its blocks."""
    exits: dict[tuple[int, int], int] = {(b, q): x for b, q, x in zip(*[table[c].to_pylist() for c in ("block", "entry", "exit")])}
    blocks = sorted({b for b, _ in exits})
    states, state = [], START
    for b in blocks:
        states.append(state)
        state = exits[b, state]
    return pa.table({"conv_id": pa.array([table["conv_id"][0].as_py()] * len(blocks), pa.int64()), "block": pa.array(blocks, pa.int64()), "entry": pa.array(states, pa.int32())})


def cheapest_edits(rows: DataFrame) -> DataFrame:
    """(conv_id, block, cost, audit, ats, roles) of ``faulty`` rows: the chosen edits of each block of a conversation.

    cost is that from the block on; audit has a letter an edit (K keep, R new role, D delete, I insert); ats and roles
    name the repaired rows: the place of a row that stays, 0 for an inserted one; 1 user, 2 assistant, 0 its own role.
    Conversations of up to BLOCK rows are one block. Longer ones are cut into blocks, each giving a matrix of costs
    between its border states; the matrices are combined from the last one back, one row of 16 numbers a block, and the
    states at the borders then follow from the blocks' own paths.
    """
    placed = rows.select("conv_id", F.floor((F.col("at") - 1) / BLOCK).alias("block"), "at", "fault", "initial")
    ends = F.array(*[F.lit(int(c)).cast("bigint") for c in final_costs()])
    longer = rows.groupBy("conv_id").agg(F.max("at").alias("n")).where(F.col("n") > BLOCK).select(F.col("conv_id").alias("own"))
    longer = settle(longer, "longer")
    in_order = lambda df: df.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    same = F.col("conv_id").eqNullSafe(F.col("own"))
    known = longer.limit(1).count() > 0
    if known:
        matrices = in_order(placed.join(longer, same, "left_semi")).mapInArrow(_by_block(_matrices), "conv_id bigint, block bigint, matrix array<bigint>")
        borders = settle(matrices.groupBy("conv_id").applyInArrow(_border_costs, "conv_id bigint, block bigint, last array<bigint>, is_end boolean"), "borders")
        borders = borders.select(F.col("conv_id").alias("own"), F.col("block").alias("own_block"), "last", "is_end")
        placed = placed.join(borders, same & (F.col("block") == F.col("own_block")), "left").drop("own", "own_block")
        placed = placed.withColumns({"last": F.coalesce("last", ends), "is_end": F.coalesce("is_end", F.lit(True))})
    else:
        placed = placed.withColumns({"last": ends, "is_end": F.lit(True)})
    paths = settle(in_order(placed).mapInArrow(_by_block(_paths), PATHS), "paths")
    if known:
        entries = paths.join(longer, same, "left_semi").select("conv_id", "block", "entry", "exit").groupBy("conv_id").applyInArrow(_entries, "conv_id bigint, block bigint, entry int")
        entries = settle(entries, "entries").select(F.col("conv_id").alias("own"), F.col("block").alias("own_block"), F.col("entry").alias("own_entry"))
        joined = paths.join(entries, same & (F.col("block") == F.col("own_block")), "left")
        paths = joined.where(F.col("entry") == F.coalesce("own_entry", F.lit(START))).drop("own", "own_block", "own_entry")
    return paths.drop("entry", "exit")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, block, k, role, text) of the repaired conversations, in order of block and k; inserted texts are empty."""
    wanted = edits.select("conv_id", "block", F.posexplode(F.arrays_zip("ats", "roles")).alias("k", "e"))
    wanted = wanted.select("conv_id", "block", "k", F.col("e.ats").alias("place"), F.col("e.roles").alias("new_role"))
    source = rows.select(F.col("conv_id").alias("own"), "at", "role", "text")
    joined = wanted.where("place > 0").join(source, F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("place") == F.col("at")))
    role: Column = F.when(F.col("new_role") == 1, "user").when(F.col("new_role") == 2, "assistant")
    kept = joined.select("conv_id", "block", "k", F.coalesce(role, "role").alias("role"), "text")
    return kept.unionByName(wanted.where("place = 0").select("conv_id", "block", "k", role.alias("role"), F.lit("").alias("text")))


def repair_report(conversations: DataFrame) -> DataFrame:
    """A row per conv_id of ``conversations``: faults after the damage, the cheapest repair and its digest.

    gaps, blank, duplicate, truncated, illegal and cost are numbers, audit the letters of the chosen edits,
    repaired_sha256 the digest of the repaired ``role:text`` lines. Null roles and texts are one space; rows without a
    conv_id are one conversation, whose conv_id is null; equal turns are ordered by role and text; repeated rows are
    duplicates of each other. A conversation that loses all rows has zeros, an empty audit and the empty string's digest.
    """
    every = conversations.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    rows = faulty(damaged(conversations))
    edits = settle(cheapest_edits(rows), "edits")
    chosen = edits.groupBy("conv_id").agg(F.min_by("cost", "block").alias("cost"), F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("parts"))
    chosen = chosen.select("conv_id", "cost", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    fixed = repaired(rows, edits)
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    order = F.array(F.col("block"), F.col("k").cast("bigint"))
    pieces = settle(fixed.select(key.alias("key"), order.alias("order"), F.concat("role", F.lit(":"), "text").alias("piece")), "pieces")
    digests = joined_sha256(pieces, "\n")
    numbers = counts(rows)
    out = every.join(numbers, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(chosen, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests, F.coalesce(F.col("id").cast("string"), F.lit("")) == F.col("key"), "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256"))
