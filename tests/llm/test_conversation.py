import hashlib
import itertools
import random
import re
import zlib

from feedlens.llm import conversation as cv

SOUND = re.compile(r"(s?(ua)+)?")


def _faults(rows):
    """The fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        words = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _best(rows):
    """(cost, audit, repaired rows) by dynamic programming over whole edit strings."""
    faults = _faults(rows)
    state_after = lambda p, c: {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(c, {}).get(p)
    names = {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}

    def offer(found, q, way):
        if q is not None and (q not in found or way[:2] < found[q][:2]):
            found[q] = way
            return True
        return False

    def with_inserts(found):
        found = dict(found)
        todo = list(found)
        while todo:
            p = todo.pop()
            cost, audit, done = found[p]
            for c in "ua":
                if offer(found, state_after(p, c), (cost + 5, audit + "I", (*done, (names[c], "")))):
                    todo.append(state_after(p, c))
        return found

    for (role, text), fault in zip(rows, faults):
        after = {}
        for p, (cost, audit, done) in with_inserts(best).items():
            offer(after, p, (cost + 2, audit + "D", done))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                offer(after, state_after(p, role[:1]), (cost + extra, audit + "K", (*done, (role, text))))
                for c in "ua":
                    offer(after, state_after(p, c), (cost + extra + 1, audit + "R", (*done, (names[c], text))))
        best = after
    final = with_inserts(best)
    return min(final[q] for q in (0, 3) if q in final)


def _all_edits(rows):
    """(cost, audit) of the best edits, by trying all of them with at most two inserted rows in a gap."""
    faults, found = _faults(rows), []
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product("KDua", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, faults)):
            continue
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            roles = "".join(g + ("" if e == "D" else r[0][:1] if e == "K" else e) for g, e, r in zip(ins, edits, rows)) + ins[-1]
            if SOUND.fullmatch(roles):
                cost = sum(5 * len(g) for g in ins) + sum({"K": 0, "D": 2}.get(e, 1) + 5 * (e != "D" and f == "truncated") for e, f in zip(edits, faults))
                found.append((cost, "".join("I" * len(g) + (e if e in "KD" else "R") for g, e in zip(ins, edits)) + "I" * len(ins[-1])))
    return min(found)


def _classes(rows):
    kinds = {"blank": lambda c: "-", "duplicate": lambda c: "-", "truncated": str.upper, "": str}
    return "".join(kinds[f](r[0][:1] if r[0][:1] in tuple("sua") else "x") for r, f in zip(rows, _faults(rows)))


def _random_rows(rng, n):
    texts = ["", " \t", "Fine.", "Cut off", "Really?", "Yes! \n", "no", "a.", "b.", "c.", "d."]
    return [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]), rng.choice(texts) + rng.choice(["", f" {rng.randint(0, 9)}."])) for _ in range(n)]


def test_division_equals_trying_all_edits():
    rng = random.Random(4)
    for _ in range(60):
        rows = _random_rows(rng, rng.randint(0, 3))
        cost, edits, tail = cv.repair(_classes(rows))
        assert (cost, "".join(edits) + "I" * tail) == _all_edits(rows) == _best(rows)[:2], rows


def test_division_and_blocks_equal_whole_strings_on_long_conversations():
    rng = random.Random(5)
    for n in [1, 2, 3, 7, 8, 30, 61, 200] * 6:
        rows = _random_rows(rng, n)
        classes = _classes(rows)
        cost, audit, _ = _best(rows)
        done = cv.repair(classes)
        assert (done[0], "".join(done[1]) + "I" * done[2]) == (cost, audit)
        size = rng.randint(1, 9)
        blocks = [classes[i:i + size] for i in range(0, n, size)]
        states, last = cv._cross(tuple(tuple(cv._measure(b)[0]) for b in blocks))
        parts = [cv.block_edits(b, p, q) for b, p, q in zip(blocks, states, states[1:])]
        assert sum(p[0] for p in parts) + 5 * last == cost and "".join("".join(p[1]) for p in parts) + "I" * last == audit


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def _brute(rows):
    left = {}
    for r in _damaged(rows):
        left.setdefault(r[0], []).append(r)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(left.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))  # the tests' ties differ in role or are equal
        pairs = [r[2:] for r in mine]
        turns = {r[1] for r in mine} - {None}
        faults, (cost, audit, done) = _faults(pairs), _best(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in cv.FAULTS), illegal, cost, audit, digest))
    return sorted(out, key=str)


def _query(spark, rows, tmp_path, name):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, at int, kind string")
    df.repartition(5).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    return sorted((tuple(r) for r in cv.op13_conversation(spark, f"{tmp_path}/{name}").collect()), key=str)


def test_query_equals_brute_force_with_nulls_ties_repeated_rows_and_long_texts(spark, tmp_path):
    rng = random.Random(6)
    rows = [(c, t, *r) for c in range(60) for t, r in enumerate(_random_rows(rng, rng.randint(1, 25)))]
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (None, None, None, None), (101, None, "user", "Only."), (102, 5, "", ""), (103, 0, None, "x")]
    rows += [(104, 3, "user", "Same.")] * 5 + [(104, 3, "assistant", "Same."), (105, 1, "user", "long " * 100000 + "."), (105, 2, "assistant", " " * 100000)]
    rows += [(106, t, "user", "ends with a line sign  ") for t in range(4)] + [(107, -2 ** 40, "system", "A."), (107, 2 ** 40, "user", "B.")]
    assert _query(spark, rows, tmp_path, "odd") == _brute(rows)


def test_one_conversation_that_holds_most_rows_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cv, "BLOCK", 16)
    rng = random.Random(7)
    rows = [(1, t, *r) for t, r in enumerate(_random_rows(rng, 700))] + [(c, t, "user", "One.") for c in range(2, 30) for t in range(3)]
    assert _query(spark, rows, tmp_path, "hot") == _brute(rows)


def test_repaired_rows_are_sound_and_no_rows_give_none(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, *r) for c in range(30) for t, r in enumerate(_random_rows(rng, 12))]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by_conv = {}
    for r in sorted(cv.fixed(given).collect(), key=lambda r: (r.at, r.nth)):
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text))
    for c in range(30):
        want = _best([r[2:] for r in rows if r[0] == c])[2]
        assert tuple(by_conv.get(c, [])) == want and SOUND.fullmatch("".join(r[0] for r, _ in want))
    assert cv.fixed(given.limit(0)).count() == 0
    given.limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    assert cv.op13_conversation(spark, str(tmp_path)).count() == 0


def test_given_tables(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in cv.op13_conversation(spark, d).collect()), key=str) == _brute(rows)
