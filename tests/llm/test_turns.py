"""Conversation repair beside a plain search over all edits, on tables, random rows and odd cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from llm_tables import SF_DIR
from pyspark.sql import functions as F

from tallyguard.llm import queries, turns

STEP = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired) of (role, text, must_go, truncated), whole paths compared at every step."""
    paths = {"0": (0, "", ())}

    def inserted(paths):
        for _ in range(3):
            for state, (cost, audit, out) in list(paths.items()):
                for role in ("user", "assistant"):
                    after = STEP.get((state, role[0]))
                    offer = (cost + 2, audit + "I", out + (f"{role}:",))
                    if after and offer[:2] < paths.get(after, (10**9, ""))[:2]:
                        paths[after] = offer
        return paths

    paths = inserted(paths)
    for role, text, must_go, cut in rows:
        found = {}
        for state, (cost, audit, out) in paths.items():
            offers = [(state, cost + 3, audit + "D", out)]
            if not must_go:
                new = [(role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")]
                offers += [
                    (STEP.get((state, r[:1])), cost + c + cut, audit + e, out + (f"{r}:{text}",)) for r, c, e in new
                ]
            for after, *offer in offers:
                if after and tuple(offer[:2]) < found.get(after, (10**9, ""))[:2]:
                    found[after] = tuple(offer)
        paths = inserted(found)
    return min((paths[s] for s in "03" if s in paths), key=lambda p: p[:2])


def by_hand(table):
    """The contract over (conv_id, turn, role, text), damage included."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = groups[conv]
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known, faults, seen = {r[0] for r in rows if r[0] is not None}, [], set()
        for _, role, text in rows:
            core = text.strip(SPACE)
            fault = "b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, fixed = cheapest([(r, t, f in ("b", "d") and f != "", f == "t") for (_, r, t), f in zip(rows, faults)])
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        counts = [faults.count(f) for f in "bdt"]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return out


def collected(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert collected(queries.QUERIES["op11_turns"](spark, SF_DIR)) == by_hand(rows)


def test_random_rows():
    """Roles and faults by chance; many ties."""
    rng = random.Random(5)
    for trial in range(3000):
        rows = []
        for i in range(rng.randrange(9)):
            gone = rng.random() < 0.2
            rows.append((rng.choice(["system", "user", "assistant", "x", ""]), str(i), gone, not gone and rng.random() < 0.4))
        audit, out = [], []

        def emit(edit, role, text):
            audit.append(edit)
            if role is not None:
                out.append(f"{role}:{text}")

        repair = turns.Repair(emit)
        for row in rows:
            repair.row(*row)
        assert (repair.end(), "".join(audit), tuple(out)) == cheapest(rows), (trial, rows)


def test_survivors_coalesce():
    """Of a long conversation only a few edits are unresolved at any time."""
    rng, settled = random.Random(6), [0]
    repair = turns.Repair(lambda *_: settled.__setitem__(0, settled[0] + 1))
    worst = 0
    for i in range(20000):
        repair.row(rng.choice(["user", "assistant", "system"]), "t.", rng.random() < 0.1, rng.random() < 0.3)
        worst = max(worst, i + 1 - settled[0])
    repair.end()
    assert worst < 200


ODD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi there?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
    (1, 5, "assistant", "Yes."), (1, None, None, None), (1, 7, "user", "\t \n"), (1, 8, "user", "cut"),
    (2, None, "user", "a?"), (2, None, "user", "a?"), (3, 4, "", ""), (None, 1, "user", "x."), (None, 2, "assistant", "y."),
    (5, -3, "user", "é" * 100000 + "."), (5, 10**12, "assistant", " "), (6, 1, "useless", "b."), (6, 2, "a", "b."),
    *[(7, t, r, "same.") for t in range(40) for r in ("user", "assistant")],
    *[(c, 0, "user", "only.") for c in range(100, 160)],
]


def test_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    table = spark.createDataFrame(ODD, schema).withColumn("key", F.lit(1)).withColumn("digest", F.lit("x")).repartition(3)
    harmed = turns.damaged(table)
    found = collected(turns.summaries(harmed, dropped=F.col("dropped")))
    assert found == by_hand(ODD)
    lost = [c for c in range(100, 160) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert lost and all(found[c] == (0, 0, 0, 0, 0, 0, "", empty) for c in lost)
    assert turns.summaries(turns.damaged(table.limit(0))).count() == 0


def test_repaired_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    table = spark.createDataFrame(ODD, schema)
    rows = turns.repaired(table).orderBy("conv_id", "position").collect()
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r["conv_id"]].append(r)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in turns.summaries(table).collect()}
    for conv, digest in digests.items():
        own = by_conv[conv]
        assert [r["position"] for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in own))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digest
