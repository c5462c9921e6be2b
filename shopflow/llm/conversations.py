"""Repair of a conversation's structure by Hirschberg's divide and conquer.

A conversation is well formed when its roles read (system? (user assistant)+)? by their initials. Four states follow it: nothing yet, after a
system, a user or an assistant turn. Turns may be kept, given the role user or assistant, deleted, or have empty ones
inserted before them; the cheapest edits win, and of those the ones whose initials (K, R, D, I) are least as text, the audit.

A span of turns is solved in linear space: a vector of four costs runs forward to its middle and one backward from its
end, the state in which the best edits cross the middle is chosen, and either half is solved for itself. A crossing lies
directly behind a turn's own edit. Two different beginnings up to there end with an edit of the same turn, so neither
begins the other, and the order of the four best beginnings decides between crossings of equal cost; the forward vector
carries this order as ranks.

Long conversations are cut into leaves of bounded size. A leaf, and any row of leaves, is summed up by the costs and ranks
from each state to each state, which compose; so the same division goes on above the leaves, level by level, each node
being a bounded number of children, and every leaf learns the states between which it is to be solved.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from shopflow.llm.common import WHITE, bounded_batches
from shopflow.plans.hot_keys import null_safe_join
from shopflow.plans.ordering import with_rank_in_group
from shopflow.plans.storage import materialize

STATES = range(4)  # nothing yet, system, user, assistant
FAR = 1 << 60
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
INSERTED = (2, 2, 3, 2)  # the state behind an inserted turn, by the state before it
FINISH = (0, 2, 1, 0)  # turns still to be inserted at the end
BLANK_OR_COPY, CUT_SHORT = 1, 2
LEGAL = ("su", "ua", "au")

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # costs and ranks by state
Element = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]  # the same from each state to each state


def _edits_of(code: int) -> list[list[tuple[int, str] | None]]:
    """Cheapest, then least, edits of one turn from each state to each state; None where there are none."""
    initial, fault = "suax"[code // 3], code % 3
    found: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for entry in STATES:
        state, before = entry, ""
        for _ in STATES:
            spent = INSERT * len(before)
            ways = [(state, spent + DELETE, "D")]
            if fault != BLANK_OR_COPY:
                spent += TRUNCATED * (fault == CUT_SHORT)
                following = INSERTED[state]
                ways.append((following, spent + REROLE, "R"))
                if initial == "ua"[following - 2]:
                    ways.append((following, spent, "K"))
                if initial == "s" and state == 0:
                    ways.append((1, spent, "K"))
            for leaves, cost, letter in ways:
                way = (cost, before + letter)
                if found[entry][leaves] is None or way < found[entry][leaves]:
                    found[entry][leaves] = way
            state, before = INSERTED[state], before + "I"
    return found


def _as_element(found: list[list[tuple[int, str] | None]]) -> Element:
    costs, ranks = [], []
    for line in found:
        order = sorted(w[1] for w in line if w)
        costs.append(tuple(w[0] if w else FAR for w in line))
        ranks.append(tuple(order.index(w[1]) if w else 4 for w in line))
    return tuple(costs), tuple(ranks)


EDITS = [_edits_of(code) for code in range(12)]  # by role initial (s, u, a, other) and fault (none, blank or copy, truncated)
TURNS = [_as_element(e) for e in EDITS]
START: Vector = ((0, FAR, FAR, FAR), (0, 4, 4, 4))


def at_state(state: int) -> Vector:
    return tuple(0 if s == state else FAR for s in STATES), tuple(0 if s == state else 4 for s in STATES)


SEEN: dict = {}  # steps that were made before; few differ, as vectors are kept relative to their least cost


def _once(step, *given):
    key = (step.__name__, *given)
    found = SEEN.get(key)
    if found is None:
        if len(SEEN) >= 1 << 16:
            SEEN.clear()
        found = SEEN[key] = step(*given)
    return found


def forward(vector: Vector, element: Element) -> Vector:
    """Vector behind the element. Costs are as given; ranks order the best beginnings of the four states."""
    costs, ranks = vector
    step, order = element
    reached = []
    for out in STATES:
        ways = [(costs[s] + step[s][out], ranks[s], order[s][out]) for s in STATES if costs[s] < FAR and step[s][out] < FAR]
        reached.append(min(ways, default=(FAR, 4, 4)))
    line = sorted({(r[1], r[2]) for r in reached if r[0] < FAR})
    return tuple(r[0] for r in reached), tuple(line.index((r[1], r[2])) if r[0] < FAR else 4 for r in reached)


def backward(costs: tuple[int, ...], element: Element) -> tuple[int, ...]:
    """Costs from each state before the element, given those behind it."""
    step = element[0]
    return tuple(min(FAR, *(step[s][out] + costs[out] for out in STATES)) for s in STATES)


def _moved(vector: Vector, elements: list[Element]) -> tuple[int, Vector]:
    """Least cost, and the vector with costs above it, so that vectors repeat and are remembered."""
    base = 0
    for element in elements:
        costs, ranks = _once(forward, vector, element)
        least = min(costs)
        base += least
        vector = (tuple(c - least if c < FAR else FAR for c in costs), ranks)
    return base, vector


def _moved_back(costs: tuple[int, ...], elements: list[Element]) -> tuple[int, ...]:
    for element in reversed(elements):
        costs = _once(backward, costs, element)
        least = min(costs)
        costs = tuple(c - least if c < FAR else FAR for c in costs)
    return costs


def summed(elements: list[Element]) -> Element:
    """One element that stands for all of these in a row."""
    lines = []
    for state in STATES:
        base, (costs, ranks) = _moved(at_state(state), elements)
        lines.append((tuple(c + base if c < FAR else FAR for c in costs), ranks))
    return tuple(c for c, _ in lines), tuple(r for _, r in lines)


def best_end(vector: Vector) -> int:
    """State behind the last turn from which the cheapest, then least, edits end."""
    costs, ranks = vector
    return min((c + INSERT * FINISH[s], ranks[s], s) for s, c in enumerate(costs) if c < FAR)[2]


def crossings(elements: list[Element], entry: int, leave: int) -> list[int]:
    """State behind each element on the best way between two states."""
    states = [leave] * len(elements)
    spans = [(0, len(elements), entry, leave)]
    while spans:
        low, high, first, last = spans.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        _, (costs, ranks) = _moved(at_state(first), elements[low:middle])
        rest = _moved_back(at_state(last)[0], elements[middle:high])
        crossing = min((costs[s] + rest[s], ranks[s], s) for s in STATES if costs[s] < FAR and rest[s] < FAR)[2]
        states[middle - 1] = crossing
        spans += [(low, middle, first, crossing), (middle, high, crossing, last)]
    return states


def solve(codes: list[int], entry: int = 0, leave: int | None = None) -> tuple[int, list[tuple[str, int, int]]]:
    """Cost, and per turn its edits and the states before and behind it. Without a given end, the best one."""
    elements = [TURNS[c] for c in codes]
    end = best_end(_moved(at_state(entry), elements)[1]) if leave is None else leave
    cost, path, state = 0, [], entry
    for code, behind in zip(codes, crossings(elements, entry, end), strict=True):
        spent, letters = EDITS[code][state][behind]
        cost += spent
        path.append((letters, state, behind))
        state = behind
    return cost, path


ROLE_OF = {2: "user", 3: "assistant"}


def inserted_roles(state: int, letters: str) -> list[str]:
    """Roles of the turns that the I at the beginning of these letters insert, from this state on."""
    roles = []
    for _ in range(letters.count("I")):
        state = INSERTED[state]
        roles.append(ROLE_OF[state])
    return roles


# Between Spark rows and elements: 32 numbers, costs and then ranks.


def _flat(element: Element) -> list[int]:
    return [x for part in element for line in part for x in line]


def _element(flat: list[int]) -> Element:
    return tuple(tuple(tuple(flat[at + 4 * s : at + 4 * s + 4]) for s in STATES) for at in (0, 16))


def _codes(text: str) -> list[int]:
    return [ord(c) - 97 for c in text]


def _python(frame: DataFrame, columns: list[str], run, schema: str) -> DataFrame:
    """Rows through a function of single rows that yields dictionaries."""
    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [out for row in part.to_pylist() for out in run(row)]
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in kinds.names} for r in rows], kinds)

    return frame.select(*columns).mapInArrow(batches, schema)


def _faulty(ordered: DataFrame) -> DataFrame:
    """Narrow rows: conversation, position, initial and fault; of equal turns all but the first are copies."""
    bare = F.translate("_text", WHITE, "")
    marked = ordered.select(
        "_conv",
        "_pos",
        F.substring("_role", 1, 1).alias("_initial"),
        (bare == "").alias("_blank"),
        F.coalesce(~F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(True)).alias("_cut"),
        F.xxhash64("_role").alias("_role_hash"),
        F.unhex(F.sha2(F.concat_ws("\x00", "_role", "_text"), 256)).alias("_digest"),
    )
    firsts = marked.filter(~F.col("_blank")).groupBy("_conv", "_role_hash", "_digest").agg(F.min("_pos").alias("_pos"))
    firsts = firsts.select("_conv", "_pos", F.lit(True).alias("_first"))
    found = null_safe_join(marked, firsts.hint("merge"), ["_conv", "_pos"], "left")
    copy = ~F.col("_blank") & F.col("_first").isNull()
    return found.select("_conv", "_pos", "_initial", "_blank", copy.alias("_copy"), (~F.col("_blank") & ~copy & F.col("_cut")).alias("_cut"))


def _leaves(faulty: DataFrame, leaf_rows: int) -> DataFrame:
    """One row per conversation and leaf: its turns as letters, counts, and illegal neighbours."""
    initial = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in "sua"]), F.col("_initial")), F.lit(0)).cast("int")
    kind = F.when(initial == 0, 3).otherwise(initial - 1)
    fault = F.when(F.col("_blank") | F.col("_copy"), BLANK_OR_COPY).when(F.col("_cut"), CUT_SHORT).otherwise(0)
    turn = F.struct("_pos", F.char(97 + kind * 3 + fault).alias("code"))
    count = lambda c: F.count_if(F.col(c)).alias(c[1:])
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["code"]), "")
    leaf = F.floor((F.col("_pos") - 1) / leaf_rows).cast("long").alias("_leaf")
    return faulty.groupBy("_conv", leaf).agg(codes.alias("codes"), count("_blank"), count("_copy"), count("_cut"))


def _initials(codes: str) -> str:
    return "".join("suax"[c // 3] for c in _codes(codes))


def _between_nodes(leaves: DataFrame, fan: int) -> DataFrame:
    """For the leaves of conversations that have several: the states between which each is to be solved."""

    def leaf_sums(row):
        yield {"_conv": row["_conv"], "_node": row["_leaf"], "sums": _flat(summed([TURNS[c] for c in _codes(row["codes"])]))}

    def node_sums(row):
        yield {"_conv": row["_conv"], "_node": row["_node"], "sums": _flat(summed([_element(c["sums"]) for c in row["children"]]))}

    def root_states(row):
        costs, ranks = _element(row["sums"])
        yield {"_conv": row["_conv"], "_node": row["_node"], "entry": 0, "leave": best_end((costs[0], ranks[0]))}

    def child_states(row):
        entry = row["entry"]
        for child, behind in zip(row["children"], crossings([_element(c["sums"]) for c in row["children"]], entry, row["leave"]), strict=True):
            yield {"_conv": row["_conv"], "_node": child["_node"], "entry": entry, "leave": behind}
            entry = behind

    kind = leaves.schema["_conv"].dataType.simpleString()
    many = leaves.filter("_leaf > 0").select("_conv").distinct()
    mine = null_safe_join(leaves, many, ["_conv"], "left_semi")
    levels = [materialize(_python(mine, ["_conv", "_leaf", "codes"], leaf_sums, f"_conv {kind}, _node long, sums array<long>"), "level")]
    parents = []
    while (levels[-1].agg(F.max("_node")).first()[0] or 0) > 0:
        children = levels[-1].groupBy("_conv", F.floor(F.col("_node") / fan).cast("long").alias("_up")).agg(F.array_sort(F.collect_list(F.struct("_node", "sums"))).alias("children"))
        parents.append(materialize(children.withColumnRenamed("_up", "_node"), "children"))
        levels.append(materialize(_python(parents[-1], ["_conv", "_node", "children"], node_sums, f"_conv {kind}, _node long, sums array<long>"), "level"))
    states = f"_conv {kind}, _node long, entry int, leave int"
    placed = _python(levels[-1], ["_conv", "_node", "sums"], root_states, states)
    for children in reversed(parents):
        joined = null_safe_join(children, placed, ["_conv", "_node"], "inner")
        placed = materialize(_python(joined, ["_conv", "_node", "children", "entry", "leave"], child_states, states), "states")
    return placed.withColumnRenamed("_node", "_leaf")


def _solved(leaves: DataFrame, leaf_rows: int, fan: int) -> DataFrame:
    """Leaves with their cost, audit and per turn what is inserted before it and the role it gets."""

    def run(row):
        codes = _codes(row["codes"])
        cost, path = solve(codes, row["entry"] or 0, row["leave"])
        turns = []
        for letters, state, behind in path:
            kept = letters[-1]
            role = ROLE_OF[behind] if kept == "R" else None
            turns.append({"edit": kept, "inserted": inserted_roles(state, letters), "role": role, "after": []})
        audit, last = "".join(p[0] for p in path), path[-1][2]
        if row["_last"]:
            turns[-1]["after"] = inserted_roles(last, "I" * FINISH[last])
            audit += "I" * FINISH[last]
            cost += INSERT * FINISH[last]
        line = _initials(row["codes"])
        illegal = sum(a + b not in LEGAL for a, b in zip(line, line[1:], strict=False))
        yield {**row, "cost": cost, "audit": audit, "turns": turns, "illegal": illegal, "ends": line[0] + line[-1]}

    deepest = leaves.agg(F.max("_leaf")).first()[0] or 0
    kind = leaves.schema["_conv"].dataType.simpleString()
    if deepest:
        placed = null_safe_join(leaves, _between_nodes(leaves, fan), ["_conv", "_leaf"], "left")
        last = null_safe_join(placed, leaves.groupBy("_conv").agg(F.max("_leaf").alias("_end")), ["_conv"], "left")
        placed = last.withColumn("_last", F.col("_leaf") == F.col("_end"))
    else:
        none = F.lit(None).cast("int")
        placed = leaves.select("*", none.alias("entry"), none.alias("leave"), F.lit(True).alias("_last"))
    schema = (
        f"_conv {kind}, _leaf long, blank long, copy long, cut long, cost long, audit string, illegal long, ends string, "
        "turns array<struct<edit:string,inserted:array<string>,role:string,after:array<string>>>"
    )
    return materialize(_python(placed, ["_conv", "_leaf", "codes", "blank", "copy", "cut", "entry", "leave", "_last"], run, schema), "solved")


class Repair:
    """Result of a repair.

    turns: every turn of the repaired conversations with its place (_conv, _pos, _sub), role, text and edit (K, R or I).
    report: per conversation that has rows gaps, blank, duplicate, truncated, illegal, cost and audit.
    """

    def __init__(self, turns: DataFrame, report: DataFrame):
        self.turns, self.report = turns, report


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", leaf_rows: int = 4096, fan: int = 1024) -> Repair:
    """Cheapest edits that make every conversation well formed, and its faults.

    Rows are taken by turn (null first), then role and text. A null role or text is one space; null conversations are one
    conversation. Repeated rows are turns of their own, and copies of the first. A blank text or a turn seen before must go;
    a text that does not end in . ! or ? costs extra unless it goes. An empty table gives no rows; other columns are not
    read. A conversation may have any number of rows: leaf_rows and fan bound what a task holds of it. Its audit is one
    value, as a result cell is.
    """
    bounded_batches(turns.sparkSession, 256)
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("_text"),
    )
    order = [F.col("_turn").asc_nulls_first(), "_role", "_text"]
    ordered = materialize(with_rank_in_group(rows, ["_conv"], order, "_pos"), "turns")
    leaves = materialize(_leaves(_faulty(ordered), leaf_rows), "leaves")
    solved = _solved(leaves, leaf_rows, fan)

    one = solved.select("_conv", "_leaf", F.posexplode("turns").alias("_at", "_edit")).select(
        "_conv", (F.col("_leaf") * leaf_rows + F.col("_at") + 1).cast(ordered.schema["_pos"].dataType).alias("_pos"), "_edit.*"
    )
    empty = lambda r: F.struct(r.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    own = F.struct(F.coalesce("role", "_role").alias("role"), F.col("_text").alias("text"), F.col("edit").alias("edit"))
    lines = F.concat(F.transform("inserted", empty), F.when(F.col("edit") != "D", F.array(own)).otherwise(F.array().cast("array<struct<role:string,text:string,edit:string>>")), F.transform("after", empty))
    # Both sides grow with the turns, and edits are far larger in memory than their files let Spark guess.
    joined = null_safe_join(ordered.select("_conv", "_pos", "_role", "_text"), one.hint("merge"), ["_conv", "_pos"], "inner")
    repaired = joined.select("_conv", "_pos", F.posexplode(lines).alias("_sub", "_line")).select("_conv", "_pos", "_sub", "_line.*")

    pair = F.concat(F.right(F.lag("ends").over(Window.partitionBy("_conv").orderBy("_leaf")), F.lit(1)), F.left("ends", F.lit(1)))
    seams = solved.withColumn("_seam", F.coalesce((~pair.isin(*LEGAL)).cast("long"), F.lit(0)))
    faults = seams.groupBy("_conv").agg(
        F.sum("blank").alias("blank"),
        F.sum("copy").alias("duplicate"),
        F.sum("cut").alias("truncated"),
        F.sum(F.col("illegal") + F.col("_seam")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_leaf", "audit"))), lambda p: p["audit"]), "").alias("audit"),
    )
    whole = F.col("_turn").cast("long")
    spans = rows.groupBy("_conv").agg(F.coalesce(F.max(whole) - F.min(whole) + 1 - F.count_distinct(whole), F.lit(0)).alias("gaps"))
    return Repair(repaired, null_safe_join(faults, spans, ["_conv"], "left"))


def text_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired turns, `role:text` joined by line feeds: _conv, repaired_sha256.

    A digest is made in order, so a conversation is read by one task; it passes in batches and is never held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            kind, done = batch.column("_conv").type, []
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("_conv", "role", "text")), strict=True):
                if state is None or own != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([state.hexdigest()])], names)

    names = ["_conv", "repaired_sha256"]
    sorted_turns = turns.select("_conv", "_pos", "_sub", "role", "text").repartition("_conv").sortWithinPartitions("_conv", "_pos", "_sub")
    return sorted_turns.mapInArrow(run, f"_conv {turns.schema['_conv'].dataType.simpleString()}, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Turns damaged by crc32 of `conv_id:turn` modulo 20: 0 dropped, 1 emptied, 2 without . ! ?, 3 twice, 4 from the user.

    A null counts as one space in every text.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rest = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), rest.alias("_rest")).filter("_rest <> 0")
    text = F.when(F.col("_rest") == 1, F.lit("")).when(F.col("_rest") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_rest") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_rest") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def repair_report(conversations: DataFrame, leaf_rows: int = 4096, fan: int = 1024) -> DataFrame:
    """Every conversation of the table, damaged and repaired: faults, cost, audit and the digest of the repaired turns."""
    found = repair(damage(conversations), leaf_rows=leaf_rows, fan=fan)
    ids = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    whole = null_safe_join(null_safe_join(ids, found.report, ["_conv"], "left"), text_digests(found.turns), ["_conv"], "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(F.col("_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
