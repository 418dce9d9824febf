"""Edits against a search over all edit strings, blocks of long conversations, odd rows."""

import hashlib
import heapq
import random

import pytest
from pyspark.sql import functions as F

from strideframe.llm import turn_repair as tr
from strideframe.llm.digests import ordered_sha256

SCHEMA = "conv_id long, turn long, role string, text string, k string, pos int, code string, extra int"


def cheapest(codes):
    """``(cost, edits)``, cheapest first and then least, by uniform-cost search on strings."""
    queue, done = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(codes) and state in (0, 3):
            return cost, audit
        fault, initial = divmod(codes[at], 4) if at < len(codes) else (0, 3)
        after_new = 3 if state == 2 else 2
        heapq.heappush(queue, (cost + 3, audit + "I", at, after_new))
        if at == len(codes):
            continue
        heapq.heappush(queue, (cost + 4, audit + "D", at + 1, state))
        if fault in (1, 2):
            continue
        more = 3 if fault == 3 else 0
        heapq.heappush(queue, (cost + 3 + more, audit + "R", at + 1, after_new))
        kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((state, initial))
        if kept is not None:
            heapq.heappush(queue, (cost + more, audit + "K", at + 1, kept))


def text_of(fault, i):
    return {0: f"whole {i}.", 1: "", 2: "twice.", 3: f"cut {i}"}[fault]


def conversation(codes):
    """Turns whose faults are ``codes``, as far as a first "twice." is none."""
    role = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
    return [(role[c % 4], text_of(c // 4, i)) for i, c in enumerate(codes)]


def true_codes(turns):
    seen, out = set(), []
    for role, text in turns:
        fault = 1 if not text.strip() else 2 if (role, text) in seen else 3 if text[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append(4 * fault + "sua".find(role[0]) % 4 if role[0] in "sua" else 4 * fault + 3)
    return out


@pytest.fixture(scope="module")
def repaired(spark):
    rng = random.Random(5)
    talks = {i: conversation([rng.randrange(16) for _ in range(rng.randrange(1, 9))]) for i in range(250)}
    talks[1000] = conversation([rng.randrange(16) for _ in range(700)])
    talks[1001] = conversation([1, 2] * 60)
    rows = [(c, t, role, text, "k", 1, "c", 0) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    report, left = tr.repair(spark.createDataFrame(rows, SCHEMA).repartition(5))
    return talks, {r.conv_id: r for r in report.collect()}, left.collect(), left


def test_edits_are_the_cheapest_and_least(repaired):
    talks, report, _, _ = repaired
    assert set(report) == set(talks)
    for c, turns in talks.items():
        codes = true_codes(turns)
        assert (report[c].cost, report[c].audit) == cheapest(codes), (c, codes)
        for fault, name in enumerate(("blank", "duplicate", "truncated"), 1):
            assert report[c][name] == sum(x // 4 == fault for x in codes)
        firsts = [role[0] for role, _ in turns]
        assert report[c].illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))


def test_repaired_turns_follow_the_edits(repaired):
    talks, report, left, table = repaired
    by_conv = {}
    for r in sorted(left, key=lambda r: (r.k, r.block, r.step)):
        by_conv.setdefault(int(r.k[1:]), []).append(r)
    lines = {}
    for c, turns in talks.items():
        own = by_conv.get(c, [])
        initials = "".join(r.role[0] for r in own)
        rest = initials[1:] if initials.startswith("s") else initials
        assert len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2) and (rest or not initials)
        assert "".join(r.edit for r in own) == report[c].audit.replace("D", "")
        for r in own:
            assert r.text == ("" if r.edit == "I" else turns[r.pos][1])
            assert r.edit != "K" or r.role == turns[r.pos][0]
        if own:
            lines[c] = "\n".join(f"{r.role}:{r.text}" for r in own)
    hashed = ordered_sha256(table.select("k", "block", "step", F.concat("role", F.lit(":"), "text").alias("line")), ["k"], ["block", "step"], "line", "\n", piece_bytes=64)
    assert {int(r.k[1:]): r.sha256 for r in hashed.collect()} == {c: hashlib.sha256(t.encode()).hexdigest() for c, t in lines.items()}


def test_nulls_ties_and_gaps(spark):
    rows = [
        (1, 5, "user", "a."), (1, 9, "assistant", "b."), (1, None, "system", "s."),
        (None, 1, "user", "x."), (None, 2, None, "y."), (None, 2, "assistant", None),
        (2, None, "user", None), (3, 1, "", "z."), (3, 1, "", "z."),
    ]
    got = {r.conv_id: r for r in tr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))[0].collect()}
    assert (got[1].gaps, got[1].cost, got[1].audit, got[1].illegal) == (3, 0, "KKK", 0)
    assert (got[None].gaps, got[None].blank, got[None].illegal) == (0, 1, 2)
    assert (got[None].cost, got[None].audit) == (7, "KRD")
    assert (got[2].gaps, got[2].audit, got[2].cost) == (0, "D", 4)
    assert (got[3].duplicate, got[3].audit, got[3].cost) == (1, "DD", 8)


def test_report_keeps_every_id_and_takes_an_empty_table(spark):
    rows = [(i, 0, "user", "Hello there. How? Yes!") for i in range(120)] + [(None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in tr.repair_report(table).collect()}
    assert set(got) == {*range(120), None}
    import zlib

    empty = hashlib.sha256(b"").hexdigest()
    for i in range(120):
        f = zlib.crc32(f"{i}:0".encode()) % 20
        want = {0: (0, ""), 1: (4, "D"), 2: (6, "KI"), 3: (7, "KDI")}.get(f, (3, "KI"))
        if f == 3:
            want = min((7, "KDI"), (7, "KID"), (8, "DD"))
        assert (got[i].cost, got[i].audit) == (min(want, (4, "D")) if want[0] > 4 and f != 3 else want), f
        if not got[i].audit.strip("D"):
            assert got[i].repaired_sha256 == empty
    assert tr.repair_report(table.limit(0)).count() == 0


def test_long_blocks_are_not_remembered():
    codes = tuple([1, 2] * 20)
    assert tr.block_costs(codes) == tr.block_costs(codes)
    assert tr.walk(codes, (0, 6, 3, 0), True, 0) == ("K" * 40, 3)
