"""Faults of conversations and the cheapest repair of their roles.

Rows are sorted by conversation and turn over all tasks, so a conversation of any size is spread over as many as it needs. A
task reads its rows once, in pieces of bounded size. A conversation that begins and ends inside a task is repaired there.
The others leave open pieces: what each does to any state before it is told by the block tables (see role_blocks) from one
byte per row, these are chained, and each piece is then repaired by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.blobs import rows_by_key
from kerbline.llm.hashing import slices
from kerbline.llm.role_blocks import GONE, Path, accepted, reach, shape, solve, symbol, turned
from kerbline.llm.stage import store

PIECE_ROWS, PIECE_BYTES = 1 << 16, 1 << 23
OUT_ROWS = 512
WHITE = " \t\n\x0b\f\r"
LONGEST = 2**63 - 1
_MARKER, _ROW = 0, 1
_FINE, _TRUNCATED, _BLANK = range(3)
_LEGAL = {"su", "ua", "au"}
_COUNTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, first string, final string"
PIECES = "conv string, part int, piece int, open boolean, symbols binary, roles array<string>, texts array<string>, cost long, audit string, repaired string, n_repaired long, "


def damage(conversations: DataFrame) -> DataFrame:
    """Rows broken by the crc32 of `conv_id:turn` modulo 20, a null in either being one space there: 0 drops a row, 1
    empties its text, 2 takes .!? out of it, 3 repeats it, 4 makes it a user's. A null role or text becomes one space."""
    space = F.lit(" ")
    key = F.concat(*(F.coalesce(F.col(name).cast("string"), space) if name != ":" else F.lit(":") for name in ("conv_id", ":", "turn")))
    code = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), space) for name in ("role", "text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code")).where("code <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = F.when(last == "", _BLANK).when(last.isin(".", "!", "?"), _FINE).otherwise(_TRUNCATED)
    named = rows.select(
        rows[conv].cast("string").alias("conv"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
        # The input task: equal rows of many tasks can be dealt apart, and still have one order.
        F.spark_partition_id().alias("salt"),
    )
    return named.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), fault.cast("int").alias("fault"), F.lit(_ROW).alias("kind"))


def _markers(rows: DataFrame) -> DataFrame:
    """A row without text for each place where a role and text stand that the conversation has at an earlier place.

    Equal rows of one place are told by their being neighbours. Of the many rows that occur once, none is left after the
    grouping, which begins before the shuffle.
    """
    place = F.struct("turn", "salt")
    said = rows.where(F.col("fault") != _BLANK).select("conv", "turn", "role", "digest", "salt")
    ends = said.groupBy("conv", "role", "digest").agg(F.min(place).alias("earliest"), F.max(place).alias("latest"))
    again = ends.where(~F.col("earliest").eqNullSafe(F.col("latest"))).alias("e")
    places = said.distinct().alias("s")
    same = F.col("s.conv").eqNullSafe(F.col("e.conv")) & (F.col("s.role") == F.col("e.role")) & (F.col("s.digest") == F.col("e.digest"))
    later = places.join(again, same).where(~F.struct("s.turn", "s.salt").eqNullSafe(F.col("e.earliest")))
    return later.select("s.*", F.lit(_MARKER).alias("kind"))


class _Piece:
    """Rows of a conversation that stand together in a task."""

    def __init__(self, conv: str | None, cut: bool):
        self.conv, self.cut, self.size = conv, cut, 0
        self.symbols, self.roles, self.texts = bytearray(), [], []
        self.counts = [0, 0, 0]
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first: str | None = None
        self.final = ""

    def add(self, turn: int | None, role: str, text: str, fault: int, again: bool) -> None:
        gone = fault == _BLANK or again
        if gone or fault:
            self.counts[0 if fault == _BLANK else 1 if again else 2] += 1
        self.symbols.append(GONE if gone else symbol(role, fault == _TRUNCATED))
        self.roles.append(None if gone else role)
        self.texts.append(None if gone else text)
        self.size += 0 if gone else len(text)
        if self.first is None:
            self.first = role[:1]
        else:
            self.illegal += self.final + role[:1] not in _LEGAL
        self.final = role[:1]
        if turn is not None and (not self.turns or turn != self.last_turn):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, part: int, number: int, open_: bool) -> dict:
        out = dict.fromkeys(name.split()[0] for name in (PIECES + _COUNTS).split(", "))
        out |= {"conv": self.conv, "part": part, "piece": number, "open": open_, "n_rows": len(self.symbols), "illegal": self.illegal, "turns": self.turns}
        out |= dict(zip(("blank", "duplicate", "truncated"), self.counts, strict=True))
        out |= {"first_turn": self.first_turn, "last_turn": self.last_turn, "first": self.first, "final": self.final}
        if open_:
            return out | {"symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts}
        out["cost"], letters = solve(bytes(self.symbols))
        return out | _repaired(letters, self.roles, self.texts)


def _repaired(letters: list[str], roles: list[str | None], texts: list[str | None], state: int = 0) -> dict:
    """The audit of a piece and its repaired rows, `role:text` a line."""
    lines = []
    for at, step in enumerate(letters):
        for letter in step:
            if letter == "D":
                continue
            if letter == "K":
                state = 1 + "sua".index(roles[at][0])
                lines.append(f"{roles[at]}:{texts[at]}")
                continue
            state = turned(state)
            lines.append(f"{('user', 'assistant')[state - 2]}:{texts[at] if letter == 'R' else ''}")
    return {"audit": "".join(letters), "repaired": "\n".join(lines), "n_repaired": len(lines)}


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row["n_rows"]
        if size >= OUT_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def _pieces(prepared: DataFrame) -> DataFrame:
    """All conversations in pieces, those within a task repaired."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, number, piece, marked, before = TaskContext.get().partitionId(), 0, None, None, None
        first = True  # the task's first conversation may have begun in the task before
        for batch in batches:
            for some in slices(batch, "text"):
                columns = [some.column(name).to_pylist() for name in ("conv", "turn", "role", "digest", "salt", "kind", "text", "fault")]
                for conv, turn, role, digest, salt, kind, text, fault in zip(*columns, strict=True):
                    key = (conv, turn, role, digest, salt)
                    if kind == _MARKER:
                        marked = key
                        continue
                    new = piece is None or piece.conv != conv
                    if new or len(piece.symbols) >= PIECE_ROWS or piece.size >= PIECE_BYTES:
                        if piece is not None:
                            yield piece.row(part, number, first or piece.cut or not new)
                            number, first = number + 1, first and not new
                        piece = _Piece(conv, cut=not new)
                    piece.add(turn, role, text, fault, key == marked or key == before)
                    before = key
        if piece is not None:
            yield piece.row(part, number, True)

    schema = _arrow(PIECES + _COUNTS)
    order = ["conv", "turn", "role", "digest", "salt"]
    rows = prepared.unionByName(_markers(prepared), allowMissingColumns=True)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "kind")
    return store(ordered.mapInArrow(lambda batches: _batches(gather(batches), schema), PIECES + _COUNTS))


def _by_conversation(frame: DataFrame, chain: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    """Apply `chain` to the rows of each conversation's pieces, in order."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in rows_by_key(batches, ["conv"]):
            for row in chain(rows):
                yield pa.RecordBatch.from_pylist([{name: row[name] for name in schema.names}], schema)

    return frame.repartition("conv").sortWithinPartitions("conv", "part", "piece").mapInArrow(run, ddl)


def _enter(rows: Iterator[dict]) -> Iterator[dict]:
    """The vector before each piece, and with the last one the cost of all."""
    vector, cost, held = 0, 0, None
    for row in rows:
        if held is not None:
            yield held | {"last": False, "cost": None}
        held = row | {"vector": vector}
        after, grown = np.frombuffer(row["after"], np.int64), np.frombuffer(row["grown"], np.int64)
        vector, cost = int(after[vector]), cost + int(grown[vector])
    yield held | {"last": True, "cost": cost + accepted(vector)[1]}


def _meet(rows: Iterator[dict]) -> Iterator[dict]:
    """The states marked behind each piece, from the last to the first, then the state before each, from the first on. Of
    a piece some 80 bytes are held."""
    held = list(rows)
    shapes = [np.frombuffer(row.pop("shape"), np.uint8).reshape(16, 5) for row in held]
    masks = [accepted(int(held[-1]["end"]))[0]]
    for one in reversed(shapes):
        masks.append(int(one[masks[-1], 0]))
    masks.reverse()
    state = 0
    for row, one, mask in zip(held, shapes, masks[1:], strict=True):
        yield row | {"mask": mask, "state": state}
        state = int(one[mask, 1 + state])


def _plan(open_: DataFrame) -> DataFrame:
    """Per open piece what its repair has to know: the vector and state before it, the states marked behind it."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [reach(symbols) for symbols in batch.column("symbols").to_pylist()]
            for name, at in (("after", 0), ("grown", 1)):
                batch = batch.append_column(name, pa.array([one[at].tobytes() for one in found], pa.binary()))
            yield batch

    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, shapes = [], []
            for row in batch.to_pylist():
                path = Path(row["symbols"], row["vector"])
                made = np.zeros((16, 5), np.uint8)
                for mask, (before, states) in shape(path, [accepted(path.end)[0]] if row["last"] else list(range(1, 16))).items():
                    made[mask] = before, *states
                ends.append(path.end)
                shapes.append(made.tobytes())
            batch = batch.drop_columns(["symbols"])
            yield batch.append_column("end", pa.array(ends, pa.int64())).append_column("shape", pa.array(shapes, pa.binary()))

    named, known = "conv string, part int, piece int, symbols binary, ", "vector long, last boolean, cost long"
    rows = open_.select("conv", "part", "piece", "symbols").mapInArrow(reached, named + "after binary, grown binary")
    entered = _by_conversation(rows, _enter, named + known).repartition("part", "piece")
    keyed = named.replace("symbols binary, ", "")
    met = entered.mapInArrow(shaped, keyed + known + ", end long, shape binary")
    return store(_by_conversation(met, _meet, keyed + known + ", mask long, state long").drop("conv"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Pieces of repaired conversations: conv (as a string), part, piece (their order), open (the conversation may have
    other pieces), n_rows, blank, duplicate, truncated, illegal, turns, first_turn, last_turn, first and final (role
    initials), cost (with the last piece), audit, repaired (`role:text` lines) and n_repaired of the piece.

    A conversation's rows are taken by turn, nulls first, then by role and a hash of the text. Null conversations are one;
    a null role or text is one space; a role that does not begin with s, u or a can only be deleted or given another
    role. Roles and texts are compared whole, by 256 bits. An empty table gives no pieces. Only the four named columns are
    read.
    """
    pieces = _pieces(_prepared(conversations, conv, turn, role, text))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                letters = Path(row["symbols"], row.pop("vector")).letters(row.pop("mask"), state := row.pop("state"), row.pop("last"))[0]
                yield pa.RecordBatch.from_pylist([row | _repaired(letters, row["roles"], row["texts"], state)], schema)

    schema = _arrow(PIECES + _COUNTS)
    open_ = pieces.where("open")
    mended = open_.drop("cost").join(_plan(open_), ["part", "piece"]).mapInArrow(mend, PIECES + _COUNTS)
    return pieces.where(~F.col("open")).unionByName(mended).drop("symbols", "roles", "texts")


def _whole(rows: Iterator[dict]) -> Iterator[dict]:
    """One conversation's pieces as one row; the texts go through the hash and are not held."""
    out: dict = {}
    digest, lines, audit = sha256(), 0, []
    for row in rows:
        audit.append(row["audit"])
        if row["n_repaired"]:
            digest.update(("\n" if lines else "").encode() + row["repaired"].encode())
            lines += row["n_repaired"]
        if not out:
            out = dict(row)
            continue
        for name in ("blank", "duplicate", "truncated", "illegal", "n_rows"):
            out[name] += row[name]
        out["illegal"] += out["final"] + row["first"] not in _LEGAL
        out["final"] = row["final"]
        if row["turns"]:
            out["turns"] += row["turns"] - (out["last_turn"] is not None and out["last_turn"] == row["first_turn"])
            out["first_turn"] = row["first_turn"] if out["first_turn"] is None else out["first_turn"]
            out["last_turn"] = row["last_turn"]
        out["cost"] = row["cost"] if row["cost"] is not None else out["cost"]
    yield out | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    gaps counts the turns missing between the first and the last; 0 where all are null, 2**63 - 1 where it is more. The
    audit of a conversation is one value, so this row grows with it."""
    counts = "conv string, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    ddl = counts + "repaired_sha256 string"
    alone = pieces.where(~F.col("open")).withColumn("repaired_sha256", F.sha2("repaired", 256)).select(*_arrow(ddl).names)
    whole = alone.unionByName(_by_conversation(pieces.where("open"), _whole, ddl))
    wide = [F.col(name).cast("decimal(20,0)") for name in ("last_turn", "first_turn", "turns")]
    missing = F.least(wide[0] - wide[1] + 1 - wide[2], F.lit(LONGEST).cast("decimal(20,0)")).cast("long")
    gaps = F.when(F.col("turns") == 0, F.lit(0)).otherwise(missing).cast("long")
    return whole.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The report on rows, with every conv_id of conversations; one without rows has zeros and an empty audit."""
    ids = conversations.select("conv_id").distinct()
    found = report(repair(rows))
    joined = ids.join(found, ids["conv_id"].cast("string").eqNullSafe(found["conv"]), "left")
    numbers = [F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
