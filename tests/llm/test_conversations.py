"""Conversation repair against every possible edit, and over range borders."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from citylake.llm import conversations
from citylake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def exhaustive(turns):
    """The best (cost, audit) of turns (initial, must go, truncated), at most two inserted at a place."""
    places = [()] + [(x,) for x in "ua"] + list(itertools.product("ua", repeat=2))
    best = None
    kept = [["D"] if gone else ["D", "K", "u", "a"] for _, gone, _ in turns]
    for edits in itertools.product(*kept):
        for put in itertools.product(places, repeat=len(turns) + 1):
            roles, audit, cost = list(put[0]), "I" * len(put[0]), 5 * sum(map(len, put))
            for (initial, _, cut), edit, more in zip(turns, edits, put[1:]):
                audit += edit if edit in "DK" else "R"
                cost += 2 if edit == "D" else (edit != "K") + 5 * cut
                roles += ([] if edit == "D" else [initial if edit == "K" else edit]) + list(more)
                audit += "I" * len(more)
            if re.fullmatch("(s?(ua)+)?", "".join(roles)) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_every_edit_of_three_turns():
    kinds = [(i, g, c) for i in "suax" for g, c in ((False, False), (True, False), (False, True))]
    for turns in random.Random(1).sample(list(itertools.product(kinds, repeat=3)), 25) + [(k,) for k in kinds] + [()]:
        assert conversations.least(conversations.best_audits(list(turns), conversations.EMPTY, True)) == exhaustive(turns)


def plain(turns):
    """The same programme with whole strings."""
    state = {"": (0, "")}
    put = {"": "u", "s": "u", "u": "a", "a": "u"}

    def grown(state):
        for _ in range(3):
            for s, (cost, audit) in list(state.items()):
                new = (cost + 5, audit + "I")
                state[put[s]] = min(state.get(put[s], new), new)
        return state

    for initial, gone, cut in turns:
        after = {}
        for s, (cost, audit) in grown(state).items():
            options = [(s, cost + 2, "D")]
            if not gone:
                to = put[s]
                options.append((to, cost + 5 * cut + (initial != to), "K" if initial == to else "R"))
                if s == "" and initial == "s":
                    options.append(("s", cost + 5 * cut, "K"))
            for to, c, letter in options:
                after[to] = min(after.get(to, (c, audit + letter)), (c, audit + letter))
        state = after
    state = grown(state)
    return min(v for k, v in state.items() if k in ("", "a"))


def brute(rows):
    """Expected rows of the query."""
    out, conv_ids = [], {r[0] for r in rows}
    for conv in conv_ids:
        turns = []
        mine = [(t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for t, role, text in sorted(mine, key=lambda m: (m[0] is not None, m[0] or 0, m[1], sha(m[2]))):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if t is None else t}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        seen, faults = set(), []
        for _, role, text in turns:
            blank = not text.strip(SPACE)
            faults.append("b" if blank else "d" if (role, text) in seen else "t" if text.rstrip(SPACE)[-1] not in ".!?" else "")
            seen.add((role, text))
        numbers = {t for t, _, _ in turns if t is not None}
        initials = [r[:1] for _, r, _ in turns]
        cost, audit = plain([(i, f in ("b", "d"), f == "t") for i, f in zip(initials, faults)])
        lines, left = [], iter(turns)
        for letter in audit:
            row = next(left) if letter != "I" else None
            role = "assistant" if lines and lines[-1][:1] == "u" else "user"
            if letter == "K":
                lines.append(f"{row[1]}:{row[2]}")
            elif letter != "D":
                lines.append(f"{role}:{row[2] if row else ''}")
        out.append((
            conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *map(faults.count, "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha("\n".join(lines)),
        ))
    return sorted(map(repr, out))


def query(spark, tmp_path, rows):
    path = str(tmp_path / f"t{random.random()}")
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/conversations.parquet")
    return sorted(repr(tuple(r)) for r in QUERIES["op12_conversation_repair"](spark, path).collect())


def random_rows(sizes, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "so what", "", " \t", "Why?\n", "a. b", "é…", "long " * 50 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "us"]
    rows = []
    for conv, n in enumerate(sizes):
        for t in range(n):
            role = draw.choice(roles) if draw.random() < 0.3 else ("user", "assistant")[t % 2]
            text = draw.choice(texts) if draw.random() < 0.3 else f"turn {draw.random()}."
            rows.append((conv, draw.choice([t, t, t, t // 2, None]), role, text))
    return rows


def test_query_against_whole_strings(spark, tmp_path):
    rows = random_rows([1, 2, 3, 4, 5, 6, 7, 8] * 12 + [40], 3)
    rows += [(None, 1, "user", "A?"), (None, 2, "assistant", None), (500, None, None, None), (501, 3, "user", "Hi."), (501, 3, "user", "Hi.")]
    # Conversations of which every turn is dropped.
    gone = [c for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows += [(c, 0, "user", "Hello.") for c in gone]
    assert gone and query(spark, tmp_path, rows) == brute(rows)


def test_conversations_over_many_ranges(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for sizes in ([3, 700, 2], [300], [2, 400, 500, 1]):
            rows = random_rows(sizes, sum(sizes))
            assert query(spark, tmp_path, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(1, 2, "user", "Same.")] * 30 + [(1, 3, "assistant", "x" * 300_000 + ".")]
    assert query(spark, tmp_path, rows) == brute(rows)
    assert query(spark, tmp_path, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x"), (1, 1, "assistant", "Yo.", "y")], SCHEMA + ", audit string")
    for name in ("copy", "kind", "same", "slice", "of"):
        df = df.withColumn(name, df["audit"])
    assert conversations.repair(conversations.judged(conversations.damaged(df))).count() == 1


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 5])
def test_audits_compare_as_strings(monkeypatch, modulus):
    """Also when nearly all hashes collide."""
    monkeypatch.setattr(conversations, "_MODULUS", modulus)
    draw, audits, texts = random.Random(7), conversations.Audits(), [""]
    for _ in range(300):
        parent, letter = draw.randrange(max(0, len(texts) - 40), len(texts)), draw.choice("DIK")
        audits.extend(parent, letter)
        texts.append(texts[parent] + letter)
    for _ in range(3000):
        a, b = draw.randrange(len(texts)), draw.randrange(len(texts))
        assert audits.less(a, b) == (texts[a] < texts[b]) and audits.text(a) == texts[a]
