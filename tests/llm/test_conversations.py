"""Operator 11 against a plain search over all edits, row by row."""

import zlib
from functools import cache
from hashlib import sha256

import numpy as np
import pytest

from kerbline.llm import conversations, registry, role_blocks
from kerbline.llm.conversations import damage, report, repair

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\f\r"


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def _faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        stripped = text.strip(WHITE)
        found.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def _cheapest(rows, faults):
    """(cost, audit, repaired rows) by trying every edit of every row; written from the rules, not from the tables."""

    @cache
    def go(at, before, inserted):
        # before: the initials so far as the last one, "" or "s"
        options = []
        wanted = "assistant" if before == "u" else "user"
        if at == len(rows):
            if before in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text = rows[at][2:]
            cost, audit, kept = go(at + 1, before, 0)
            options.append((cost + 2, "D" + audit, kept))
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 if faults[at] else 0
                initial = role[:1]
                if initial == wanted[0] or (initial == "s" and before == ""):
                    cost, audit, kept = go(at + 1, initial, 0)
                    options.append((cost + extra, "K" + audit, ((role, text), *kept)))
                cost, audit, kept = go(at + 1, wanted[0], 0)
                options.append((cost + 1 + extra, "R" + audit, ((wanted, text), *kept)))
        if inserted < 4:
            cost, audit, kept = go(at, wanted[0], inserted + 1)
            options.append((cost + 5, "I" + audit, ((wanted, ""), *kept)))
        return min(options, default=(10**9, "", ()))

    return go(0, "", 0)


def _plain(original, rows):
    out = {}
    for conv in {row[0] for row in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).digest()))
        faults = _faults(mine)
        cost, audit, kept = _cheapest(tuple(mine), tuple(faults))
        turns = {r[1] for r in mine if r[1] is not None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        text = "\n".join(f"{role}:{text}" for role, text in kept)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, sha256(text.encode()).hexdigest())
    return out


def _found(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def test_query_equals_the_plain_search(spark):
    original = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    query = registry.queries()["op11_conversations"](spark, SF)
    assert query.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert _found(query) == _plain(original, _damaged(original))


def _invented(seed, convs=40):
    random = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", " ", None, "User", "agent"]
    texts = ["Yes.", "No!", "What?", "cut off", "", " \n", None, "Well. \t", "so ", "end.\u0085", "Yes.", "a. b"]
    rows = []
    for conv in range(convs):
        for turn in range(int(random.integers(0, 9))):
            role = roles[random.choice(len(roles), p=[0.3, 0.3, 0.12, 0.08, 0.04, 0.04, 0.04, 0.04, 0.04])]
            rows.append((conv if conv else None, int(turn * random.integers(1, 3)) if random.random() < 0.95 else None, role, texts[random.integers(len(texts))]))
    return rows


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, conv string").repartition(parts)


@pytest.mark.parametrize("seed", range(3))
def test_invented_conversations(spark, seed):
    rows = _invented(seed)
    frame = _frame(spark, rows)
    assert _found(conversations.report_all(frame, damage(frame))) == _plain(rows, _damaged(rows))


@pytest.mark.parametrize("seed", range(3))
def test_conversations_in_many_pieces(spark, seed, monkeypatch):
    """Pieces of at most two rows, dealt over tasks: every conversation is chained."""
    rows = _invented(seed + 10, 25)
    monkeypatch.setattr(conversations, "PIECE_ROWS", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = _frame(spark, rows)
        assert repair(damage(frame)).where("open").count() > 25
        assert _found(conversations.report_all(frame, damage(frame))) == _plain(rows, _damaged(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_conversation_with_most_rows(spark, monkeypatch):
    """Many equal rows at one place and a text that comes back at many turns, over several tasks."""
    random = np.random.default_rng(0)
    rows = [(1, 5, "user", "Again.")] * 300
    rows += [(1, turn, ["user", "assistant"][turn % 2], "Yes." if random.random() < 0.5 else f"Line {turn}.") for turn in range(300)]
    rows += [(2, turn, ["user", "assistant"][turn], "Hello.") for turn in range(2)]
    monkeypatch.setattr(conversations, "PIECE_ROWS", 64)
    frame = _frame(spark, rows, 6)
    got = {r.conv: r for r in report(repair(frame)).collect()}
    ordered = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1], r[2], sha256(r[3].encode()).digest()))
    faults = _faults(ordered)
    assert got["1"].duplicate == faults.count("duplicate") and got["1"].gaps == 0
    symbols = bytes(role_blocks.GONE if f else role_blocks.symbol(r[2], False) for r, f in zip(ordered, faults))
    cost, letters = role_blocks.solve(symbols)
    assert (got["1"].cost, got["1"].audit) == (cost, "".join(letters))
    assert got["2"].audit == "KK"


def test_odd_rows_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (3, None, None, "x" * 100_000), (3, None, "user", None), (4, 2**62, "user", "a."), (4, -(2**62) * 2, "assistant", "b.")]
    frame = _frame(spark, rows)
    got = _found(conversations.report_all(frame, frame))
    assert set(got) == {None, 3, 4} and got[4][0] == 2**63 - 1
    none = frame.where("false")
    assert conversations.report_all(none, damage(none)).count() == 0
    assert repair(none).count() == 0
    lost = conversations.report_all(frame, none)
    assert {tuple(r)[1:] for r in lost.collect()} == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}


# -- the tables -----------------------------------------------------------


def _strings(seed, count, most):
    random = np.random.default_rng(seed)
    weights = np.array([2, 1, 5, 1, 5, 1, 2, 1, 1]) / 19
    return [bytes(random.choice(9, int(random.integers(0, most)), p=weights).astype(np.uint8)) for _ in range(count)]


def _text_rows(symbols):
    roles = ["system", "system", "user", "user", "assistant", "assistant", "tool", "tool", "user"]
    return tuple((0, 0, roles[s], "") for s in symbols), tuple("blank" if s == 8 else "truncated" if s % 2 else "" for s in symbols)


def test_tables_find_the_cheapest_and_ascii_least(spark):
    for symbols in _strings(1, 800, 12):
        cost, letters = role_blocks.solve(symbols)
        assert (cost, "".join(letters)) == _cheapest(*_text_rows(symbols))[:2]


def test_pieces_of_a_string_agree_with_the_whole():
    random = np.random.default_rng(2)
    for symbols in _strings(3, 200, 40):
        cuts = [0, *sorted(random.integers(0, len(symbols) + 1, 3).tolist()), len(symbols)]
        parts = [symbols[a:b] for a, b in zip(cuts, cuts[1:])]
        vector, cost, paths = 0, 0, []
        for part in parts:
            after, grown = role_blocks.reach(part)
            paths.append(role_blocks.Path(part, vector))
            assert (paths[-1].end, paths[-1].cost) == (after[vector], grown[vector])
            vector, cost = int(after[vector]), cost + int(grown[vector])
        mask, more = role_blocks.accepted(vector)
        masks, shapes = [mask], []
        for path in reversed(paths):
            shapes.insert(0, role_blocks.shape(path, [masks[0]])[masks[0]])
            masks.insert(0, shapes[0][0])
        state, audit = 0, ""
        for at, path in enumerate(paths):
            letters, after = path.letters(masks[at + 1], state, last=at == len(paths) - 1)
            assert after == shapes[at][1][state]
            state, audit = after, audit + "".join(letters)
        whole = role_blocks.solve(symbols)
        assert (cost + more, audit) == (whole[0], "".join(whole[1]))


def test_few_vectors_occur():
    assert 4 < len(role_blocks.tables().vectors) < 256
    assert role_blocks.tables().block_after.shape[1] == role_blocks.SYMBOLS**role_blocks.BLOCK
