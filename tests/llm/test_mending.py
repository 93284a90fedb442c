import itertools
import random
import re
import zlib
from collections import defaultdict
from hashlib import md5, sha256

from helpers import clashing, frame

from strataloom.llm import mending

TURNS = "conv_id long, turn long, role string, text string"
GOAL = re.compile(r"(s?(ua)+)?")


def every_edit(rows):
    """(cost, audit, repaired rows) of the best of all edit sequences; rows: (role, text, fault)."""
    gaps = ["", "u", "a", "ua", "au"]
    name = {"u": "user", "a": "assistant"}
    choices = []
    for role, text, fault in rows:
        own = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            own.append((extra, "K", [(role, text)]))
            own += [(2 + extra, "R", [(r, text)]) for r in name.values()]
        choices.append(own)
    best = None
    for picked in itertools.product(*choices):
        for between in itertools.product(gaps, repeat=len(rows) + 1):
            out, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                out += [(name[c], "") for c in between[k]]
                audit += "I" * len(between[k])
                cost += 2 * len(between[k])
                if k < len(rows):
                    cost += picked[k][0]
                    audit += picked[k][1]
                    out += picked[k][2]
            if (best is None or (cost, audit) < best[:2]) and GOAL.fullmatch("".join(r[:1] for r, _ in out)):
                best = cost, audit, out
    return best


def plain_edits(rows):
    """The same with whole audits kept per state, for longer conversations."""
    after = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    best = {0: (0, "", ())}

    def spread(found):
        """Ways that end in any number of inserts."""
        for s, (cost, audit, said) in found.items():
            for _ in range(4):
                yield s, (cost, audit, said)
                cost, audit, said, s = cost + 2, audit + "I", (*said, (after[s][1], "")), after[s][0]

    for role, text, fault in rows:
        new = {}

        def offer(s, way):
            if s not in new or way[:2] < new[s][:2]:
                new[s] = way

        for s, (cost, audit, said) in spread(best):
            offer(s, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            extra = int(fault == "truncated")
            offer(after[s][0], (cost + 2 + extra, audit + "R", (*said, (after[s][1], text))))
            if role[:1] == "s" and s == 0:
                offer(1, (cost + extra, audit + "K", (*said, (role, text))))
            if role[:1] == after[s][1][0]:
                offer(after[s][0], (cost + extra, audit + "K", (*said, (role, text))))
        best = new
    return min(way for s, way in spread(best) if s in (0, 3))


def plain_rows(turns):
    """Rows per conversation in order, with their first fault, and the counts."""
    groups = defaultdict(list)
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        same = md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        groups[conv].append((turn is not None, turn or 0, same, turn, role, text))
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        seen, faulty = set(), []
        for *_, role, text in rows:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            fault = None
            if not said:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif said[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        known = {r[3] for r in rows if r[3] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        initials = [r[0][:1] for r in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = faulty, gaps, illegal
    return out


def plain_damage(turns):
    out = []
    for conv, turn, role, text in turns:
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot:
            text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def plain_repair(turns):
    found = plain_rows(plain_damage(turns))
    out = []
    for conv in {t[0] for t in turns}:
        rows, gaps, illegal = found.get(conv, ([], 0, 0))
        cost, audit, said = plain_edits(rows)
        faults = [f for *_, f in rows]
        digest = sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(map(repr, out))


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = rng.choice(["system", "tool", None, "sys", ""]) if rng.random() < 0.1 else role
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", "", " \n", None, "ends. \t", f"{turn} said.", "é\u0085"])
            number = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 5])
            rows.append((conv, number, role, text))
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 1, "user", "a.")]
    rows += [(900, k, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 300)}.") for k in range(700)]
    rows += [(901, 3, "user", "again.")] * 60
    return rows


def test_audits_against_every_edit():
    rng = random.Random(2)
    for n in (0, 1, 2, 3):
        for _ in range(25 if n == 3 else 40):
            rows = [
                (rng.choice(["system", "user", "assistant", "tool", "user", "assistant"]), f"{k}",
                 rng.choice([None, None, "blank", "duplicate", "truncated"])) for k in range(n)
            ]
            cost, audit, said = every_edit(rows)
            assert plain_edits(rows)[:2] == (cost, audit)
            kinds = "".join(mending.kind_of(r[:1], f in ("blank", "duplicate"), f == "truncated") for r, _, f in rows)
            if kinds:
                end = mending.borders(*([x] for x in mending.summary(kinds)))[-1]
                assert mending.edits(kinds, 0, end) + "I" * mending.tail(end) == audit
            assert list(mending.applied(iter(audit), ((r, t) for r, t, _ in rows))) == said


def test_blocks_meet_in_the_least_audit():
    """However a conversation is cut, borders and blocks give one audit."""
    rng = random.Random(7)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), "t", rng.choice([None, "blank", "truncated"])) for _ in range(40)]
        kinds = "".join(mending.kind_of(r[:1], f == "blank", f == "truncated") for r, _, f in rows)
        cuts = sorted(rng.sample(range(1, 40), 5))
        parts = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, 40])]
        states = mending.borders(*zip(*map(mending.summary, parts)))
        audit = "".join(mending.edits(p, s, e) for p, s, e in zip(parts, states, states[1:]))
        assert audit + "I" * mending.tail(states[-1]) == plain_edits(rows)[1]


def test_against_plain_version(spark):
    rows = conversations()
    df = frame(spark, rows, TURNS)
    for block in (4096, 3):
        out = mending.repair_damaged(df.repartition(5), mending.Settings(block=block))
        assert out.columns == [
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert sorted(repr(tuple(r)) for r in out.collect()) == plain_repair(rows)


def test_repaired_turns(spark):
    rows = conversations(5)
    want = []
    for conv, (faulty, *_) in plain_rows(rows).items():
        want += [(None if conv is None else str(conv), n, *x) for n, x in enumerate(plain_edits(faulty)[2])]
    got = [tuple(r) for r in mending.repaired_turns(frame(spark, rows, TURNS), mending.Settings(block=50)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    roles = defaultdict(str)
    for conv, _, role, _ in sorted(got, key=lambda r: (r[0] or "", r[1])):
        roles[conv] += role[:1]
    assert all(GOAL.fullmatch(r) for r in roles.values())


def test_all_dropped_empty_and_clashing(spark):
    assert mending.repair_damaged(frame(spark, [], TURNS)).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = mending.repair_damaged(frame(spark, [(dropped, 0, "user", "Hi.")], TURNS)).first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    wide = clashing(frame(spark, conversations(), TURNS))
    wide = wide.selectExpr("*", *[f"'x' AS {c}" for c in ("conv", "same", "lot", "part", "seq", "audit", "time", "what")])
    assert sorted(repr(tuple(r)) for r in mending.repair_damaged(wide).collect()) == plain_repair(conversations())
