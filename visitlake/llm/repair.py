"""Repair of damaged conversations at least cost, by the auction algorithm for shortest paths.

The lattice has a layer per row and in it a node per state of the role pattern `(s?(ua)+)?`: nothing written yet, a
system, user or assistant turn written last. An arc keeps, re-roles or deletes the next row, which leads to
the next layer, or inserts an empty turn, which stays in the layer.

The auction holds a path and a price per node, never above what its cheapest arc and that arc's end cost together, and
equal along the path. If the last node's price can rise, it does and the path contracts by that node; else the path
extends along the cheapest arc. Origins are taken from the last layer back, so that a path ends as soon as it
meets a node whose price is final, the cost of the best way from there. Arcs whose cost is just the
difference of their ends' prices are tight; following the tight arc with the least letter from the start gives the
least of the cheapest edit strings, as a letter leads from a node to one node only.

What a layer's prices are, but for a common part, depends on its row's kind and the next layer's prices, but for their
common part; so equal cases are auctioned once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.turns import crc32_of, number_turns, turn_digest
from visitlake.sources.files import staged

# Fixed costs of edits, by their letters, and what a truncated row costs that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\f\r"
STOPS = ".!?"
# A row's kind is one letter: its fault times four plus its role.
ROLES, FAULTS = "sua ", ("", "truncated", "blank", "duplicate")
_KINDS = "ABCDEFGHIJKLMNOP"
_CHUNK = 4096  # rows whose kinds one row of a list holds

START, SYSTEM, USER, ASSISTANT = range(4)
# Which turns may follow which: state -> (letter of the role, state).
_NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NAMES = {USER: "user", ASSISTANT: "assistant"}

_Arc = tuple[str, int, int, bool]  # letter, cost, state it leads to, whether to the next layer


def _arcs(kind: str) -> list[list[_Arc]]:
    """Arcs out of each state for a row of a kind (none: there is no row left), in order of their letters."""
    fault, role = divmod(_KINDS.index(kind), 4) if kind else (0, 0)
    kept = TRUNCATED if FAULTS[fault] == "truncated" else 0
    arcs: list[list[_Arc]] = []
    for state in range(4):
        out: list[_Arc] = [("D", DELETE, state, True)] if kind else []
        writable = [s for s in _NEXT[state].values() if s in _NAMES]
        out += [("I", INSERT, s, False) for s in writable]
        if kind and FAULTS[fault] in ("", "truncated"):
            if ROLES[role] in _NEXT[state]:
                out.append(("K", KEEP + kept, _NEXT[state][ROLES[role]], True))
            out += [("R", REROLE + kept, s, True) for s in writable]
        arcs.append(out)
    return arcs


def auction(arcs: list[list[_Arc]], after: list[int] | None) -> list[int]:
    """Final prices of a layer's nodes, by path extension and contraction; `after` are those of the next layer.

    Without a next layer, nodes at which a conversation may end are final at no cost.
    """
    final = {START: 0, ASSISTANT: 0} if after is None else {}
    prices = [0] * 4 if after is None else [min(after)] * 4
    for origin in range(4):
        path = [origin]
        while path[-1] not in final:
            here = path[-1]
            value, step = min((cost + (after[to] if onward else prices[to]), (onward, to)) for _, cost, to, onward in arcs[here])
            if prices[here] < value:
                prices[here] = value
                if len(path) > 1:
                    path.pop()
            elif step[0]:
                break  # the next layer's prices are final
            else:
                path.append(step[1])
        final.update((state, prices[state]) for state in path)
    return prices


class Layers:
    """Layers of lattices, each auctioned once: common price, prices above it, and the arc to take from each state."""

    def __init__(self) -> None:
        self._known: dict[tuple, tuple[int, tuple[int, ...], list[_Arc | None]]] = {}

    def layer(self, kind: str, after: tuple[int, ...] | None) -> tuple[int, tuple[int, ...], list[_Arc | None]]:
        found = self._known.get((kind, after))
        if found is None:
            arcs = _arcs(kind)
            prices = auction(arcs, None if after is None else list(after))
            tight = [
                next((a for a in arcs[s] if a[1] + (after[a[2]] if a[3] else prices[a[2]]) == prices[s]), None) for s in range(4)
            ]
            if after is None:
                tight[START] = tight[ASSISTANT] = None
            least = min(prices)
            found = self._known[kind, after] = (least, tuple(p - least for p in prices), tight)
        return found

    def repair(self, kinds: str) -> tuple[int, list[tuple[str, int, str | None]]]:
        """Cost of the best repair and its edits in order: letter, row (-1: none), role written (None: the row's own)."""
        common, above, tight = self.layer("", None)
        ways = [tight]
        for kind in reversed(kinds):
            more, above, tight = self.layer(kind, above)
            common += more
            ways.append(tight)
        edits, state, row = [], START, 0
        while True:
            arc = ways[len(kinds) - row][state]
            if arc is None:
                return common + above[START], edits
            letter, _, state, onward = arc
            edits.append((letter, row if onward else -1, _NAMES[state] if letter in "IR" else None))
            row += onward


def damage(turns: DataFrame) -> DataFrame:
    """Rows after damage by CRC-32 of `conv_id:turn`; nulls read as one space, but stay nulls in conv_id and turn."""
    blank = F.lit(" ")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (crc32_of(place) % 20).alias("_case"))
    case = F.col("_case")
    damaged = rows.filter(case != 0).select(
        "conv_id", "turn", F.when(case == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return damaged.drop("_copy")


_KEYS = ["absent", "conv"]
_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _report(kinds: str, gaps: int | None, cost: int, edits: list) -> dict:
    faults, roles = [_KINDS.index(k) // 4 for k in kinds], [ROLES[_KINDS.index(k) % 4] for k in kinds]
    return {
        "gaps": gaps, **{name: faults.count(n) for n, name in enumerate(FAULTS) if name},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
        "cost": cost, "audit": "".join(letter for letter, _, _ in edits),
    }


def _repairer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (keys, pos, kinds, gaps, role, text) in order, a conversation's kinds first, to its report and its turns."""
    layers, edits, at = Layers(), [], 0
    names = ["place", "edit", "role", "text", *_REPORT, "audit"]
    texts = {"edit", "role", "text", "audit"}
    for batch in batches:
        keys: dict[str, list] = {k: [] for k in _KEYS}
        out: dict[str, list] = {n: [] for n in names}

        def put(key: tuple, **values) -> None:
            for name, value in zip(_KEYS, key):
                keys[name].append(value)
            for name in names:
                out[name].append(values.get(name))

        for *key, pos, kinds, gaps, role, text in zip(*(batch.column(n).to_pylist() for n in range(7))):
            if pos < 0:
                cost, edits = layers.repair(kinds)
                at = 0
                put(key, place=0, **_report(kinds, gaps, cost, edits))
            else:
                letter, _, written = edits[at]
                at += 1
                gone = letter == "D"
                put(key, place=at, edit=letter, role=None if gone else written or role, text=None if gone else text)
            while at < len(edits) and edits[at][0] == "I":  # turns inserted before the next row, or at the end
                at += 1
                put(key, place=at, edit="I", role=edits[at - 1][2], text="")
        yield pa.RecordBatch.from_pydict({
            **{k: pa.array(v, batch.schema.field(k).type) for k, v in keys.items()},
            **{n: pa.array(v, pa.string() if n in texts else pa.int64()) for n, v in out.items()},
        })


def repair_conversations(turns: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """Reports and repaired turns of all conversations of `turns` (conv_id, turn, role, text).

    `damaged` (the same columns, without nulls in role and text) are the rows to repair; by default `damage(turns)`. Per
    conversation of `turns` there is a report at place 0 (gaps, blank, duplicate, truncated, illegal, cost, audit), then a row
    per edit from place 1 on (edit, role, text; the last two null for deleted rows), in order, in one partition.

    Rows are put in order of turn (null first), ties by role and text; so repeated rows stand side by side and all but the first
    are duplicates. A null conv_id is a conversation too. A role is told by its first letter; an empty role
    fits nowhere. A conversation without rows after damage has a report of zeros and an empty audit. An empty table gives
    an empty one. Turns so far apart that their distance is no bigint make `gaps` null.

    Texts are sorted and pass one by one; what a task holds of a conversation is a letter a row and its edits, as
    the audit, a single value, does.
    """
    rows = (damage(turns) if damaged is None else damaged).select("conv_id", "turn", "role", "text")
    id_type = turns.schema["conv_id"].dataType.simpleString()
    keyed = lambda df: df.withColumns({"absent": F.col("conv_id").isNull(), "conv": F.coalesce("conv_id", F.lit(0).cast(id_type))})
    stripped = F.rtrim("text", F.lit(BLANKS))
    state = F.when(stripped == "", 2).when(F.right(stripped, F.lit(1)).isin(*STOPS), 0).otherwise(1)
    initial = F.left("role", F.lit(1))
    facts = keyed(rows).withColumns({
        "state": state, "digest": F.unhex(turn_digest(F.col("role"), F.col("text"))),
        "initial": F.when(initial.isin(*ROLES), initial).otherwise(" "),
    })
    placed, _ = staged(number_turns(facts, _KEYS, ["turn", "role", "text", "state", "digest", "initial"]), "damaged-turns")
    seen = placed.groupBy(*_KEYS, "digest").agg(F.min("pos").alias("pos")).withColumn("first", F.lit(True))
    marked = placed.select(*_KEYS, "pos", "digest", "state", "initial").join(seen, [*_KEYS, "digest", "pos"], "left")
    fault = F.when(F.col("state") == 2, 2).when(F.col("first").isNull(), 3).otherwise(F.col("state"))
    kind = F.substring(F.lit(_KINDS), fault * 4 + F.instr(F.lit(ROLES), F.col("initial")), F.lit(1))
    letters = marked.select(*_KEYS, "pos", kind.alias("kind"), F.floor(F.col("pos") / _CHUNK).alias("chunk"))
    in_order = lambda name: F.expr(f"concat_ws('', transform(array_sort(collect_list(struct({name}))), x -> x.kind))").alias("kind")
    kinds = letters.groupBy(*_KEYS, "chunk").agg(in_order("pos, kind")).groupBy(*_KEYS).agg(in_order("chunk, kind"))
    turns_there = placed.groupBy(*_KEYS, "turn").agg(F.lit(1).alias("one")).groupBy(*_KEYS).agg(
        F.expr("try_subtract(try_add(try_subtract(max(turn), min(turn)), 1), count(turn))").alias("gaps"), F.count("turn").alias("known")
    )
    gaps = F.when(F.coalesce("known", F.lit(0)) == 0, F.lit(0)).otherwise(F.col("gaps")).cast("bigint")
    heads = keyed(turns.select("conv_id").distinct()).select(*_KEYS).join(kinds, _KEYS, "left").join(turns_there, _KEYS, "left")
    none = F.lit(None).cast("string")
    heads = heads.select(
        *_KEYS, F.lit(-1).cast("bigint").alias("pos"), F.coalesce("kind", F.lit("")).alias("kinds"), gaps.alias("gaps"),
        none.alias("role"), none.alias("text"),
    )
    body = placed.select(*_KEYS, "pos", none.alias("kinds"), F.lit(None).cast("bigint").alias("gaps"), "role", "text")
    both = heads.unionByName(body).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "pos")
    numbers = ", ".join(f"{n} bigint" for n in _REPORT)
    repaired = both.mapInArrow(
        _repairer, f"absent boolean, conv {id_type}, place bigint, edit string, role string, text string, {numbers}, audit string"
    )
    return repaired.select(F.when(~F.col("absent"), F.col("conv")).alias("conv_id"), "place", "edit", "role", "text", *_REPORT, "audit")
