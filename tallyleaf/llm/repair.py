"""Repair of conversation structure at least cost, by dynamic programming over runs of equal symbols.

A turn's symbol is the initial of its role and its fault. A symbol is a 4 x 4 min-plus matrix over the states of the
wanted pattern, so turns combine in any grouping: a run by binary powers of one matrix, a segment by its runs, a
conversation by its segments. That lets a conversation of any length be worked on by many tasks.
"""

import hashlib
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm.tables import new_table

#: Costs of the edits. An undeleted truncated turn adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns of one segment: 2 to this power.
SEGMENT_BITS = 12
NOT_BLANK = r"[^\x20\x09-\x0D]"
ENDS_OPEN = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# The pattern (s?(ua)+)? as states: nothing yet, after s, after u, after a. ADDED is the role that an inserted or changed
# turn must have in each state, and THEN the state behind it; a conversation may end in the states of ENDS.
NEVER = 1 << 60
STATES = range(4)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ADDED = ("user", "user", "assistant", "user")
THEN = (2, 2, 3, 2)
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
# Symbols: 0 for a turn that must go, else 1 + the place of the initial here (others last) + 4 if it is truncated.
INITIALS = "sua"


class Repair(NamedTuple):
    """``conversations``: counts, cost and audit per conversation; ``turns``: the repaired turns in order of (at, part)."""

    conversations: DataFrame
    turns: DataFrame


def times(a, b):
    """Min-plus product of two matrices."""
    columns = tuple(zip(*b))
    return tuple(before(columns, r) for r in a)


def before(matrix, vector):
    """The least costs from each state before a step, from those behind it."""
    p, q, r, s = vector
    return tuple(min(a + p, b + q, c + r, d + s) for a, b, c, d in matrix)


@cache
def inserts():
    """From state to state by inserted turns alone."""
    one = tuple(tuple(0 if s == t else INSERT if THEN[s] == t else NEVER for t in STATES) for s in STATES)
    return times(times(one, one), one)


def choices(symbol, state):
    """What may be done with a turn: (edit, cost, state behind), in the order of the edits' letters."""
    yield "D", DELETE, state
    if symbol:
        initial, extra = (INITIALS + "o")[(symbol - 1) % 4], TRUNCATED if symbol > 4 else 0
        if (state, initial) in KEPT:
            yield "K", extra, KEPT[state, initial]
        yield "R", REROLE + extra, THEN[state]


@cache
def power(symbol, exponent):
    """The matrix of 2**exponent turns of one symbol, with whatever is inserted before each."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    step = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, then in choices(symbol, state):
            step[state][then] = min(step[state][then], cost)
    return times(inserts(), step)


def powers(symbol, count):
    return [power(symbol, e) for e in range(count.bit_length()) if count >> e & 1]


def final():
    """The least costs behind the last turn: inserted turns up to an end."""
    return before(inserts(), tuple(0 if s in ENDS else NEVER for s in STATES))


def runs_of(symbols):
    """[(symbol, count)] of (symbol, copies) per turn: copies behind the first must go."""
    runs = []
    for symbol, copies in symbols:
        for one, count in ((symbol, 1), (0, copies - 1)):
            if count and runs and runs[-1][0] == one:
                runs[-1][1] += count
            elif count:
                runs.append([one, count])
    return runs


def segment_matrix(runs):
    found = tuple(tuple(0 if s == t else NEVER for t in STATES) for s in STATES)
    for symbol, count in runs:
        for matrix in powers(symbol, count):
            found = times(found, matrix)
    return found


def unroll(runs, state, after, last):
    """The cheapest edits of a segment that begins in a state, the least letters first: [(edit letters, count)], end state.

    ``after`` are the least costs behind the segment. Letters are those of inserted turns and then of the turn; a turn that must
    go takes its D at once, as what is inserted can as well come later, so a run of such turns is one entry. Behind
    the last segment turns are inserted up to an end.
    """
    behind = [after]
    for symbol, count in reversed(runs):
        vector = behind[-1]
        for matrix in powers(symbol, count):
            vector = before(matrix, vector)
        behind.append(vector)
    behind.reverse()
    edits = []
    for number, (symbol, count) in enumerate(runs):
        if not symbol:
            edits.append(("D", count))
            continue
        # The least costs from each turn of the run on; only one run is held at a time.
        costs = [behind[number + 1]]
        for _ in range(count):
            costs.append(before(power(symbol, 0), costs[-1]))
        for at in range(count, 0, -1):
            letters = ""
            while True:
                letter, state = _least(symbol, state, costs[at], costs[at - 1])
                letters += letter
                if letter != "I":
                    break
            edits.append((letters, 1))
    if last:
        tail = ""
        while state not in ENDS:
            tail, state = tail + "I", THEN[state]
        edits.append((tail, 0))
    return edits, state


def _least(symbol, state, now, then):
    """The least letter among the cheapest edits of a turn in a state, and the state behind it, given the costs from it and behind it."""
    cheapest = [(edit, to) for edit, cost, to in choices(symbol, state) if cost + then[to] == now[state]]
    if INSERT + now[THEN[state]] == now[state]:
        cheapest.append(("I", THEN[state]))
    return min(cheapest)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults by ``crc32(conv_id:turn) % 20``: 0 drops a turn, 1 empties it, 2 takes its ``.!?``, 3 repeats it, 4 makes it
    the user's. A null counts as one blank, also in that string."""
    rows = _plain(turns)
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    hit = rows.withColumn("hit", F.crc32(named) % 20).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    again = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"), again.alias("again")).drop("again")


def _plain(turns):
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")}
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), blank["role"], blank["text"])


def _placed(turns):
    """Distinct turns with their copies, faults and place: ``at`` rises with (conv_id, turn, role, text).

    Places come from a range partitioning, not from a window, so the turns of a huge conversation lie in many tasks.
    """
    rows = _plain(turns).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.select(
        "*",
        F.left("role", F.lit(1)).alias("initial"),
        (~F.regexp_like("text", F.lit(NOT_BLANK))).alias("blank"),
        F.regexp_like("text", F.lit(ENDS_OPEN)).alias("truncated"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("key"),
    )
    count = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(count, "conv_id", "turn", "role", F.left("text", F.lit(64)))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = new_table(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")
    first = placed.groupBy("conv_id", "key").agg(F.min("at").alias("at"), F.lit(True).alias("fresh"))
    return placed, placed.drop("text", "role", "key").join(first.select("at", "fresh"), "at", "left").na.fill(False, ["fresh"])


def _batches(columns, rows):
    names, kinds = zip(*columns)
    values = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], list(names))


LONG, LONGS, INT, STRING = pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.string()


def _over(make, columns):
    """A function for mapInArrow that makes output rows of each input row."""

    def mapped(batches):
        for batch in batches:
            # A row is a segment or the outline of a conversation; few are held as Python values at a time.
            for at in range(0, batch.num_rows, 64):
                rows = [made for row in batch.slice(at, 64).to_pylist() for made in make(row)]
                if rows:
                    yield _batches(columns, rows)

    return mapped


def _outline(row):
    """A segment's matrix, first and last initial, and illegal neighbours within."""
    items = row["items"]
    illegal = sum(i["copies"] - 1 for i in items)
    illegal += sum(a["initial"] + b["initial"] not in LEGAL for a, b in zip(items, items[1:]))
    matrix = segment_matrix(runs_of((i["symbol"], i["copies"]) for i in items))
    ends = items[0]["initial"], items[-1]["initial"]
    yield row["conv_id"], row["segment"], [c for r in matrix for c in r], *ends, illegal


def _costs(row):
    """For each segment of a conversation, the least costs behind it and the one that follows; with the first, the cost of the whole."""
    segments, vector, out = row["segments"], final(), []
    for s in reversed(segments):
        out.append((s["segment"], list(vector)))
        vector = before([s["matrix"][4 * k : 4 * k + 4] for k in STATES], vector)
    illegal = sum(s["illegal"] for s in segments)
    illegal += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(segments, segments[1:]))
    out.reverse()
    for number, (segment, after) in enumerate(out):
        following = out[number + 1][0] if number + 1 < len(out) else None
        yield row["conv_id"], segment, after, following, *((0, 0) if number else (vector[0], illegal))


def _ends(row):
    """The state behind a segment that another one follows, for each state that it may begin in."""
    runs = runs_of((i["symbol"], i["copies"]) for i in row["items"])
    yield row["conv_id"], row["segment"], row["next"], [unroll(runs, s, row["after"], False)[1] for s in STATES]


def _begins(row):
    """The state that each segment but the first begins in."""
    state = 0
    for s in row["segments"]:
        state = s["ends"][state]
        yield s["next"], state


def _edits(row):
    """The audit of a segment, and per turn its edit, with the roles of the turns inserted before it and behind it."""
    items, state = row["items"], row["state"]
    is_last = row["next"] is None
    edits, _ = unroll(runs_of((i["symbol"], i["copies"]) for i in items), state, row["after"], is_last)
    audit = "".join(letters * max(count, 1) for letters, count in edits)
    edits = iter(edits)
    turns, at_end, letters, left = [], [], "", 0
    for item in items:
        inserted, edit, role = [], "D", None
        for copy in range(2 if item["copies"] > 1 else 1):
            wanted = 1 if not copy else item["copies"] - 1
            if not left:
                letters, left = next(edits)
            if not copy:
                for _ in letters[:-1]:
                    inserted.append(ADDED[state])
                    state = THEN[state]
                edit = letters[-1]
                if edit == "R":
                    role, state = ADDED[state], THEN[state]
                elif edit == "K":
                    state = KEPT[state, item["initial"]]
            while wanted:
                took = min(wanted, left)
                wanted, left = wanted - took, left - took
                if wanted:
                    letters, left = next(edits)
        turns.append({"at": item["at"], "inserted": inserted, "edit": edit, "role": role, "behind": []})
    if is_last:
        for _ in next(edits)[0]:
            at_end.append(ADDED[state])
            state = THEN[state]
        turns[-1]["behind"] = at_end
    yield row["conv_id"], row["segment"], audit, turns


def repair(turns: DataFrame) -> Repair:
    """The cheapest repair of every conversation of ``turns(conv_id, turn, role, text)``.

    Turns are ordered by turn, then role, then text, nulls first; a null role or text is one blank, rows without conv_id are one
    conversation, and other columns are ignored. A turn is blank, or repeats role and text of an earlier one, or is truncated
    (its last visible character is not one of ``.!?``); the first that holds counts. Blank and repeated turns must go. Roles must
    then have initials like ``(s?(ua)+)?``. Of the cheapest repairs the one whose audit (D, I, K, R in order) is least is taken. No
    rows give no conversations.

    Segments of 4096 turns are worked on side by side. What is brought together per conversation is one matrix a segment.
    """
    placed, symbols = _placed(turns)
    must_go = F.col("blank") | ~F.col("fresh")
    place = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(must_go, 0).otherwise(1 + place + F.when(F.col("truncated"), 4).otherwise(0)).cast("int")
    counted = symbols.groupBy("conv_id").agg(
        F.max("turn").alias("most"),
        F.min("turn").alias("least"),
        F.countDistinct("turn").alias("turns"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(
            F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.when(F.col("fresh"), 1).otherwise(0))
        ).alias("duplicate"),
        F.count_if(~must_go & F.col("truncated")).alias("truncated"),
    )
    items = symbols.select(
        "conv_id",
        F.shiftright("at", SEGMENT_BITS).alias("block"),
        F.struct("at", "initial", symbol.alias("symbol"), "copies").alias("item"),
    )
    grouped = items.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("item")).alias("items"))
    segments = new_table(grouped.select("conv_id", F.col("items")[0]["at"].alias("segment"), "items"), "segments")

    def per_conversation(rows, *columns):
        parts = F.sort_array(F.collect_list(F.struct("segment", *columns))).alias("segments")
        return rows.groupBy("conv_id").agg(parts)

    outline = [("conv_id", LONG), ("segment", LONG), ("matrix", LONGS), ("first", STRING), ("last", STRING), ("illegal", LONG)]
    outlines = segments.mapInArrow(
        _over(_outline, outline), "conv_id long, segment long, matrix array<long>, first string, last string, illegal long"
    )
    costs = [("conv_id", LONG), ("segment", LONG), ("after", LONGS), ("next", LONG), ("cost", LONG), ("illegal", LONG)]
    behind = per_conversation(outlines, "matrix", "first", "last", "illegal").mapInArrow(
        _over(_costs, costs), "conv_id long, segment long, after array<long>, next long, cost long, illegal long"
    )
    behind = new_table(behind, "costs")
    told = segments.join(behind.drop("conv_id"), "segment")
    # Only conversations of several segments have states to hand on.
    ends = [("conv_id", LONG), ("segment", LONG), ("next", LONG), ("ends", pa.list_(INT))]
    reached = told.where("next is not null").mapInArrow(_over(_ends, ends), "conv_id long, segment long, next long, ends array<int>")
    begun = per_conversation(reached, "next", "ends").mapInArrow(
        _over(_begins, [("segment", LONG), ("state", INT)]), "segment long, state int"
    )
    started = told.join(begun, "segment", "left").na.fill(0, ["state"])
    edit_type = "array<struct<at:long,inserted:array<string>,edit:string,role:string,behind:array<string>>>"
    edit = pa.struct([("at", LONG), ("inserted", pa.list_(STRING)), ("edit", STRING), ("role", STRING), ("behind", pa.list_(STRING))])
    edits = started.mapInArrow(
        _over(_edits, [("conv_id", LONG), ("segment", LONG), ("audit", STRING), ("edits", pa.list_(edit))]),
        f"conv_id long, segment long, audit string, edits {edit_type}",
    )
    edits = new_table(edits, "edits")
    audits = edits.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "audit"))).alias("parts"))
    sums = behind.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    # Joined by union and grouping: a conversation without an id is one like others.
    names = {"gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string"}
    parts = [
        counted.select("conv_id", gaps, "blank", "duplicate", "truncated"),
        sums.select("conv_id", "illegal", "cost"),
        audits.select("conv_id", F.array_join("parts.audit", "").alias("audit")),
    ]
    full = [p.select("conv_id", *[(F.col(n) if n in p.columns else F.lit(None)).cast(t).alias(n) for n, t in names.items()]) for p in parts]
    conversations = full[0].unionByName(full[1]).unionByName(full[2]).groupBy("conv_id").agg(*[F.max(n).alias(n) for n in names])
    return Repair(conversations, _repaired(placed, edits))


def _repaired(placed, edits):
    acted = edits.select(F.explode("edits").alias("e")).select("e.at", "e.inserted", "e.edit", F.col("e.role").alias("new"), "e.behind")
    both = placed.select("conv_id", "at", "turn", "role", "text").join(acted, "at")

    def added(names):
        return F.transform(names, lambda n: _turn(n, F.lit(""), F.lit("I"), F.lit(None).cast("long")))

    own = F.array(_turn(F.coalesce("new", "role"), F.col("text"), F.col("edit"), F.col("turn")))
    made = F.concat(added("inserted"), F.when(F.col("edit") == "D", F.slice(own, 1, 0)).otherwise(own), added("behind"))
    return both.select("conv_id", "at", F.posexplode(made).alias("part", "t")).select("conv_id", "at", "part", "t.*")


def _turn(role, text, edit, turn) -> Column:
    return F.struct(turn.alias("turn"), role.alias("role"), text.alias("text"), edit.alias("edit"))


def _hashes(batches):
    """(conv_id, sha256) of the lines of each conversation, which follow one another; only a digest is held."""
    now, digest, kinds = None, None, [("conv_id", LONG), ("repaired_sha256", STRING)]
    for batch in batches:
        done = []
        for conv_id, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is not None and conv_id == now:
                digest.update(b"\n")
            else:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv_id, hashlib.sha256()
            digest.update(line.encode())
        if done:
            yield _batches(kinds, done)
    if digest is not None:
        yield _batches(kinds, [(now, digest.hexdigest())])


def digests(original: DataFrame, repaired: Repair) -> DataFrame:
    """A row for every conv_id of ``original``: counts, cost, audit and the hash of the repaired ``role:text`` lines.

    A hash of one text is taken in order, so the lines of a conversation pass through one task, one after the other.
    """
    lines = repaired.turns.select("conv_id", "at", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "part").select("conv_id", "line")
    hashed = dealt.mapInArrow(_hashes, "conv_id long, repaired_sha256 string")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    zero = {**{n: F.lit(0).cast("long") for n in counts}, "audit": F.lit(""), "repaired_sha256": F.lit(None).cast("string")}
    every = original.select(F.col("conv_id").cast("long")).distinct().select("conv_id", *[c.alias(n) for n, c in zero.items()])
    found = repaired.conversations.select("conv_id", *[F.col(n) if n in (*counts, "audit") else zero[n].alias(n) for n in zero])
    texts = hashed.select("conv_id", *[F.col(n) if n == "repaired_sha256" else zero[n].alias(n) for n in zero])
    # Costs and counts are never negative, and an audit is never below the empty one.
    rows = every.unionByName(found).unionByName(texts).groupBy("conv_id").agg(*[F.max(n).alias(n) for n in zero])
    return rows.na.fill(EMPTY_SHA256, ["repaired_sha256"])
