import hashlib
import itertools
import random
import re

import pytest

from pulse.llm import dialogue_repair as dr

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(facts):
    """Cost and audit by trying edits in order of cost; ``facts``: (initial, must_delete, truncated)."""
    best = None
    slots = len(facts) + 1
    for inserted in range(0, 4):
        for where in itertools.combinations_with_replacement(range(slots), inserted):
            for edits in itertools.product("KRD", repeat=len(facts)):
                cost, audit, options = 5 * inserted, "", [""]
                for i in range(slots):
                    for _ in range(where.count(i)):
                        audit, options = audit + "I", [o + x for o in options for x in "ua"]
                    if i == len(facts):
                        break
                    initial, must, cut = facts[i]
                    e = edits[i]
                    audit += e
                    if e != "D" and must:
                        options = []
                    cost += {"K": 0, "R": 1, "D": 2}[e] + (5 if cut and e != "D" else 0)
                    if e != "D":
                        options = [o + x for o in options for x in (initial if e == "K" and len(initial) == 1 else "?" if e == "K" else "ua")]
                if any(GRAMMAR.fullmatch(o) for o in options) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def parsed(facts, segment=None):
    p = dr.Parser()
    for f in facts:
        p.feed(*f)
    return p.result()


def test_least_cost_and_audit():
    rng = random.Random(3)
    for _ in range(250):
        facts = []
        for _ in range(rng.randint(0, 5)):
            must = rng.random() < 0.15
            facts.append((rng.choice(["s", "u", "a", "u", "a", "x", ""]), must, not must and rng.random() < 0.2))
        assert parsed(facts) == cheapest(facts), facts


def test_segments_change_nothing(monkeypatch):
    rng = random.Random(4)
    for _ in range(40):
        facts = [(rng.choice("suaxua"), rng.random() < 0.1, rng.random() < 0.1) for _ in range(rng.randint(50, 200))]
        whole = parsed(facts)
        for segment in (1, 2, 7):
            monkeypatch.setattr(dr, "SEGMENT", segment)
            assert parsed(facts) == whole
        monkeypatch.undo()


def test_long_dialogue_is_linear():
    cost, audit = parsed([("x", False, False)] * 100_001)
    assert cost == 100_002 and audit == "D" + "R" * 100_000
    cost, audit = parsed([("s", False, False)] + [("u", False, False), ("a", False, False)] * 50_000)
    assert cost == 0 and audit == "K" * 100_001


def brute(rows):
    """One dialogue's row from its damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, facts, tally = set(), [], [0, 0, 0]
    for _, role, text in rows:
        t = text.rstrip(dr._SPACE)
        fault = 0 if not t else 1 if (role, text) in seen else 2 if t[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            tally[fault] += 1
        facts.append((role[:1], fault in (0, 1), fault == 2))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = parsed(facts)
    out, at, due = [], 0, 0
    for e in audit:
        if e == "I":
            out.append(f"{('user', 'assistant')[due]}:")
            due = 1 - due
            continue
        _, role, text = rows[at]
        at += 1
        if e == "D":
            continue
        if e == "R":
            role = ("user", "assistant")[due]
        out.append(f"{role}:{text}")
        if role[:1] != "s" or e == "R":
            due = 1 - due
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *tally, illegal, cost, audit, sha), out


@pytest.fixture
def odd(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "so so", " \t\n", "", None, "Ok?  \n", "x" * 30_000 + ".", "é?", " ", "...", "Yes."]
    rows = [(c, rng.choice([None, 0, 1, 1, 2, 3, 5, 9, 400]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "s"]),
             rng.choice(texts), 1, "k") for c in [None, *range(40)] for _ in range(rng.randint(1, 9))]
    rows += [(100, 0, "user", "Hi.", 2, "k")] * 3
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int, audit string")


def test_odd_conversations(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "conversations.parquet"))
    rows = dr.with_faults(dr.damage(odd))
    edits = dr.find_edits(rows, odd)
    got = {r.conv_id: tuple(r)[1:] for r in dr.op11_dialogue_repair(spark, str(tmp_path)).collect()}
    by = {r.conv_id: [] for r in odd.select("conv_id").distinct().collect()}
    for r in dr.damage(odd).collect():
        by[r.conv_id].append((r.turn, r.role, r.text))
    assert got == {c: brute(x)[0] for c, x in by.items()}
    made = {}
    for r in sorted(dr.repaired_rows(rows, edits).collect(), key=lambda r: r.position):
        made.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert made == {c: brute(x)[1] for c, x in by.items() if brute(x)[1]}


def test_no_rows(spark, odd):
    none = odd.limit(0)
    rows = dr.with_faults(dr.damage(none))
    assert dr.repaired_digests(rows, dr.find_edits(rows, none)).count() == 0
    edits = dr.find_edits(rows, odd.select("conv_id"))
    r = dr.repaired_digests(rows, edits).first()
    assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage_repeats_rows_with_their_turn(spark, odd):
    import zlib
    want = []
    for r in odd.collect():
        h = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        if h:
            text = " " if r.text is None else r.text
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            want += [(r.conv_id, r.turn, "user" if h == 4 else " " if r.role is None else r.role, text)] * (2 if h == 3 else 1)
    assert sorted(map(str, map(tuple, dr.damage(odd).collect()))) == sorted(map(str, want))
