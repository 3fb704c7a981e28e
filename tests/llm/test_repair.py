import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from penprint.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def every_repair(initials, faults):
    """The cheapest audit by trying all edits, with at most two insertions in a gap."""
    gaps = [("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au")]
    options = []
    for i, f in zip(initials, faults):
        own = [(3, "D", "")]
        if f not in "bd":
            late = f == "t"
            own += [(late, "K", i), (2 + late, "R", "u"), (2 + late, "R", "a")]
        options.append([(c + 2 * len(g[0]), g[0] + a, g[1] + r) for g in gaps for c, a, r in own])
    options.append([(2 * len(g[0]), *g) for g in gaps])
    best = None
    for chosen in itertools.product(*options):
        roles = "".join(c[2] for c in chosen)
        if GRAMMAR.fullmatch(roles):
            key = (sum(c[0] for c in chosen), "".join(c[1] for c in chosen))
            best = min(best, key) if best else key
    return best


def whole(initials, faults):
    items = repair.segment_items(initials, faults, repair.START)
    cost, _, audit = min(items[q] for q in repair.ACCEPTED if q in items)
    return cost, audit


def test_lightest_equals_trying_all_edits():
    rng = random.Random(4)
    cases = [(a, b) for n in range(3) for a in itertools.product("sua?", repeat=n) for b in itertools.product("bt-", repeat=n)]
    cases += [(rng.choices("sua?", k=3), rng.choices("bdt-----", k=3)) for _ in range(12)]
    for initials, faults in cases:
        initials, faults = "".join(initials), "".join(faults)
        assert whole(initials, faults) == every_repair(initials, faults), (initials, faults)


def test_segments_give_the_same_as_the_whole():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 40)
        initials, faults = "".join(rng.choices("sua?", [1, 6, 6, 1], k=n)), "".join(rng.choices("bdt-", [1, 1, 2, 9], k=n))
        step = rng.randrange(1, 9)
        parts = [
            {(p, q): w for p in range(4) for q, w in repair.segment_items(initials[i : i + step], faults[i : i + step], p).items()}
            for i in range(0, n, step)
        ]
        items = repair.joined_items(parts)
        cost, rows, audit = min(items[0, q] for q in repair.ACCEPTED if (0, q) in items)
        assert (cost, audit) == whole(initials, faults) and rows == n


def test_a_weight_comes_off_once_and_in_order():
    popped = []

    def deduce(item, weight, chart):
        popped.append(weight)
        return [((i, item), (weight[0] + c, weight[1] + 1, weight[2] + "x")) for i, c in (("a", 0), ("b", 2))] if weight[1] < 3 else []

    repair.lightest([("s", (0, 0, ""))], deduce, ["never"])
    assert popped == sorted(popped) and len(popped) == 15


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 4, "user", "And"), (1, 5, "user", "And now?"),
    (2, None, "assistant", "No turn."), (2, 3, None, None), (2, 3, "tool", "x!"), (2, 7, "user", " \t\x0b"), (2, 8, "user", "Hi?"), (2, 8, "user", "Hi?"),
    (None, 0, "user", "Whose?"), (None, None, "assistant", "Nobody's. \n"), (3, None, None, None), (4, 1, "assistant", "a."), (4, 1, "", "b"),
    *[(5, k, ("user", "assistant")[k % 2], f"turn {k}" + "..!"[k % 3]) for k in range(60)],
    *[(k, t, ("user", "assistant")[t % 2], "Same first turn.") for k in range(6, 40) for t in range(3)],
]


def expected(rows, damage):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(repair.SQL if damage else repair.SQL.replace("% 20 AS how", "* 0 + 9 AS how")).fetchall(), key=repr)


@pytest.mark.parametrize("sizes", [(256, 64), (2, 2)])
def test_odd_rows_equal_the_sql(spark, tmp_path, sizes):
    rows = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], "conv_id bigint, turn bigint, role string, text string, cost string, _pos int").repartition(6)
    repairs, turns = repair.repaired(rows, *sizes)
    digests = {r["_conv"]: r["sha"] for r in repair.digested(turns).collect()}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    got = [(r["conv_id"], *[r[n] for n in names], digests.get(r["_conv"], hashlib.sha256(b"").hexdigest())) for r in repairs.collect()]
    assert sorted(got, key=repr) == expected(ROWS, False)
    for r in turns.where("_conv = '=5'").collect():
        assert len(r["roles"]) == len(r["texts"])


def test_damage_follows_the_checksum(spark):
    rows = [(k, t, "assistant", "a. b? c!") for k in range(30) for t in range(10)] + [(None, None, None, None)]
    got = sorted(map(tuple, repair.damaged(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()), key=repr)
    want = []
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if how == 4 else role or " ", {1: "", 2: "a b c"}.get(how, text) if text else " ")
        want += [row] * {0: 0, 3: 2}.get(how, 1)
    assert got == sorted(want, key=repr)


def test_query_equals_its_sql_on_odd_rows_and_empty_tables(spark, tmp_path, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    assert sorted(map(tuple, repair.op13_repair(spark, small).collect())) == sorted(con.execute(repair.SQL).fetchall())
    for k, rows in enumerate(([], ROWS)):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{folder}/conversations.parquet")
        assert sorted(map(tuple, repair.op13_repair(spark, folder).collect()), key=repr) == expected(rows, True)
