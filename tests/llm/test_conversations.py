"""Conversation repair against a plain search over whole strings of edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest

from ratewave.llm import conversations as C
from ratewave.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
BLANK = "[ \t\n\x0b\x0c\r]"


def cheapest(kinds):
    """(cost, edits, repaired initials of each edit) by (cost, string) order, states as prefixes of the pattern."""

    def after(state, x):  # state: the initials so far, shortened
        got = state + x
        if re.fullmatch("s?(ua)*u?", got):
            return "ua" if got.endswith("ua") else got
        return None

    @cache
    def best(i, state, inserted):
        ways = []
        if i == len(kinds) and state in ("", "ua"):
            ways.append((0, "", ()))
        if inserted < 2:
            for x in "ua":
                if (s := after(state, x)) is not None:
                    c, e, r = best(i, s, inserted + 1)
                    ways.append((c + 2, "I" + e, (x, *r)))
        if i < len(kinds):
            initial, gone, cut = kinds[i]
            c, e, r = best(i + 1, state, 0)
            ways.append((c + 3, "D" + e, ("", *r)))
            if not gone:
                if initial and (s := after(state, initial)) is not None:
                    c, e, r = best(i + 1, s, 0)
                    ways.append((c + cut, "K" + e, (initial, *r)))
                for x in "ua":
                    if (s := after(state, x)) is not None:
                        c, e, r = best(i + 1, s, 0)
                        ways.append((c + 2 + cut, "R" + e, (x, *r)))
        return min(ways, default=(10**9, "", ()))

    for i in reversed(range(len(kinds))):  # from the end, so that no call goes deep
        best(i, "ua", 0)
    return best(0, "", 0)


def brute(rows):
    """rows: (conv_id, turn, role, text) of the table, any order."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            role, text = (" " if role is None else role), (" " if text is None else text)
            how = zlib.crc32(key.encode()) % 20
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            own += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, kinds, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            bare = re.sub(f"{BLANK}+$", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit, roles = cheapest(tuple(kinds))
        kept, i = [], 0
        for x, r in zip(audit, roles, strict=True):
            if x == "I":
                kept.append({"u": "user", "a": "assistant"}[r] + ":")
            else:
                if x != "D":
                    kept.append((own[i][1] if x == "K" else {"u": "user", "a": "assistant"}[r]) + ":" + own[i][2])
                i += 1
        turns = {r[0] for r in own} - {None}
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **n,
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
            "cost": cost,
            "audit": audit,
            "repaired": "\n".join(kept),
        }
    return out


def check(found, rows, digest=False):
    want = brute(rows)
    got = {r.conv_id: r.asDict() for r in found.collect()}
    assert set(got) == set(want)
    for conv, w in want.items():
        if digest:
            w["repaired"] = hashlib.sha256(w["repaired"].encode()).hexdigest()
        assert {k: got[conv][k] for k in w} == w, conv


def made(seed, convs, longest):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "open", " ", "", None, "Why? ", "a\nb.\n", "x\x0b", "Same."]
    rows = []
    for conv in [None, *range(convs)]:
        for _ in range(rnd.randint(1, longest)):
            turn = rnd.choice([None, *range(-2, longest)])
            rows.append((conv, turn, rnd.choices(roles, [5, 5, 2, 1, 1, 1])[0], rnd.choices(texts, [9, 9, 3, 1, 1, 1, 3, 3, 1, 9])[0] if rnd.random() < 0.4 else f"T{rnd.random()}."))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("bits", "digest"), [(12, False), (0, False), (0, True), (2, True)])
def test_repair_of_odd_conversations(spark, monkeypatch, bits, digest):
    monkeypatch.setattr(C, "CHUNK_BITS", bits)  # chunks of one row, four rows
    rows = made(5, 60, 14) + [(77, 1, "user", "Same.")] * 9
    table = spark.createDataFrame(rows, SCHEMA)
    check(C.repair_conversations(C.damage(table), digest), rows, digest)


def test_checkpointed_blocks_give_the_edits_of_a_plain_search():
    rnd = random.Random(3)
    for n in [0, 1, 2, 3, 5, 17, 60]:
        for _ in range(30):
            kinds = [(rnd.choice("suaaut"), rnd.random() < 0.1, rnd.random() < 0.2) for _ in range(n)]
            own = [C.Entry(i, k[0], "t", 1, True, k[1], k[2]) for i, k in enumerate(kinds)]
            audit, kept, state, cost = C.repair(own, C.END, C.START, C.Costs())
            more, added = C.ending(state)
            assert (cost, audit + more) == cheapest(tuple(kinds))[:2]
            assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept + added))


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BITS", 5)
    rnd = random.Random(8)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Same.", f"{t}.", f"{t}"])) for t in range(700)]
    rows += [(2, 5, "user", "Hi.")] + [(3, None, "user", "Copy.")] * 400
    table = spark.createDataFrame(rows, SCHEMA)
    check(C.repair_conversations(C.damage(table), True), rows, True)


def test_clashing_columns_and_no_rows(spark):
    rows = made(9, 5, 6)
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA + ", c string, chunk string, first string")
    check(C.repair_conversations(C.damage(table)), rows)
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_conversations(C.damage(none)).collect() == []


def test_registered_query(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF001}/conversations.parquet'").fetchall()
    found = QUERIES["op12_conversation_repair"](spark, SF001).withColumnRenamed("repaired_sha256", "repaired")
    check(found, rows, digest=True)
