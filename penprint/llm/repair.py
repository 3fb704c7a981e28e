"""Conversation repair as a lightest derivation.

A repair is a derivation: an item says that the first rows of a conversation are repaired so that the roles so far end in
a state of the grammar ``(s?(ua)+)?``, and every edit deduces an item from another one. Items come off an agenda in the
order of their weight, as in Knuth's generalisation of shortest paths: all functions are monotone and superior, so the
first weight with which an item comes off is its lightest. Long conversations are cut into segments; a segment has items
from every state to every state, and two neighbouring items make one over both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Hashable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm.common import written
from penprint.operators.scale import lookup_join, running_totals

SPACE = " \t\n\x0b\x0c\r"
SEGMENT = 256  # rows of a segment
FAN = 64  # segments joined at once
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: State after a role's initial; what is not listed is not allowed.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1  # costs
LEGAL = ("su", "ua", "au")

Weight = tuple[int, int, str]


def lightest(axioms: Iterable[tuple[Hashable, Weight]], deduce: Callable, goals: Iterable[Hashable]) -> dict[Hashable, Weight]:
    """Lightest weights of the items that come off the agenda until all goals have, or none is left.

    ``deduce(item, weight, chart)`` gives the consequences of an item that has just been finalised together with others
    of the chart. A weight is (cost, rows covered, audit): every deduction adds to the cost or covers more rows, so no
    conclusion is lighter than a premise, and weights of one item, which cover the same rows, go by cost and audit.
    """
    agenda = [(weight, item) for item, weight in axioms]
    heapify(agenda)
    chart: dict[Hashable, Weight] = {}
    open_ = set(goals)
    while agenda and open_:
        weight, item = heappop(agenda)
        if item in chart:
            continue
        chart[item] = weight
        open_.discard(item)
        for conclusion, heavier in deduce(item, weight, chart):
            if conclusion not in chart:
                heappush(agenda, (heavier, conclusion))
    return chart


def segment_items(initials: str, faults: str, start: int, ends: Iterable[int] = range(4)) -> dict[int, Weight]:
    """Lightest repairs of a run of rows from one state, by the state they end in.

    A row has an initial (``?`` for one outside the grammar) and a fault: b blank, d duplicate, t truncated, or ``-``.
    """
    n = len(initials)

    def deduce(item: tuple[int, int], weight: Weight, chart: dict) -> Iterator[tuple[tuple[int, int], Weight]]:
        (i, state), (cost, _, audit) = item, weight
        for role in "ua":
            if (state, role) in NEXT:
                yield (i, NEXT[state, role]), (cost + INSERT, i, audit + "I")
        if i == n:
            return
        yield (i + 1, state), (cost + DELETE, i + 1, audit + "D")
        if faults[i] in "bd":
            return
        cost += CUT_OFF * (faults[i] == "t")
        if (state, initials[i]) in NEXT:
            yield (i + 1, NEXT[state, initials[i]]), (cost, i + 1, audit + "K")
        for role in "ua":
            if (state, role) in NEXT:
                yield (i + 1, NEXT[state, role]), (cost + REROLE, i + 1, audit + "R")

    chart = lightest([((0, start), (0, 0, ""))], deduce, [(n, q) for q in ends])
    return {q: chart[n, q] for q in ends if (n, q) in chart}


def joined_items(parts: list[dict[tuple[int, int], Weight]]) -> dict[tuple[int, int], Weight]:
    """Lightest items over all parts, from items (state before, state after) over each of them."""

    def deduce(item: tuple, weight: Weight, chart: dict) -> Iterator[tuple[tuple, Weight]]:
        kind, k, p, q = item
        if kind == "part":  # is the right premise
            pairs = [(("first", k, s, p), chart[("first", k, s, p)], item, weight) for s in range(4) if ("first", k, s, p) in chart]
        else:
            pairs = [(item, weight, ("part", k, q, r), chart[("part", k, q, r)]) for r in range(4) if ("part", k, q, r) in chart]
        for (_, _, s, _), a, (_, _, _, r), b in pairs:
            yield ("first", k + 1, s, r), (a[0] + b[0], a[1] + b[1], a[2] + b[2])

    axioms = [(("first", 0, p, p), (0, 0, "")) for p in range(4)]
    axioms += [(("part", k, p, q), w) for k, part in enumerate(parts) for (p, q), w in part.items()]
    n = len(parts)
    chart = lightest(axioms, deduce, [("first", n, p, q) for p in range(4) for q in range(4)])
    return {(p, q): chart["first", n, p, q] for p in range(4) for q in range(4) if ("first", n, p, q) in chart}


ITEMS = "array<struct<cost:bigint,audit:string,p:int,q:int,n:bigint>>"
SEGMENTS = f"_conv string, _seg bigint, first string, last string, illegal bigint, items {ITEMS}"
ITEM = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("p", pa.int32()), ("q", pa.int32()), ("n", pa.int64())]))


def segment_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("_conv", pa.string()), ("_seg", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("items", ITEM)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


def listed(items: dict[tuple[int, int], Weight]) -> list[dict]:
    return [{"cost": c, "audit": a, "p": p, "q": q, "n": n} for (p, q), (c, n, a) in items.items()]


def solved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of every segment; a conversation of one segment needs those from the start alone."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            text = r["initials"]
            starts, ends = ((START,), ACCEPTED) if r["_alone"] else (range(4), range(4))
            items = {(p, q): w for p in starts for q, w in segment_items(text, r["faults"], p, ends).items()}
            illegal = sum(text[i : i + 2] not in LEGAL for i in range(len(text) - 1))
            out.append((r["_conv"], r["_seg"], text[0], text[-1], illegal, listed(items)))
        yield segment_rows(out)


def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            parts = r["parts"]
            items = joined_items([{(x["p"], x["q"]): (x["cost"], x["n"], x["audit"]) for x in p["items"]} for p in parts])
            borders = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
            yield segment_rows([(r["_conv"], r["_seg"], parts[0]["first"], parts[-1]["last"], borders + sum(p["illegal"] for p in parts), listed(items))])


def edits_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per place of an audit: the roles put in before it, the edit of its row, and the row's new role.

    Roles alternate from the first user on, so the number of rows that stay tells whether a system row leads.
    """
    for batch in batches:
        for conv, audit in zip(batch.column("_conv").to_pylist(), batch.column("audit").to_pylist()):
            at, place, before = -((len(audit) - audit.count("D")) % 2), 0, []
            out: list[tuple] = []
            for edit in audit:
                role = "user" if at % 2 == 0 else "assistant"
                if edit == "I":
                    before.append(role)
                else:
                    out.append((place, before, edit, role if edit == "R" else None))
                    place, before = place + 1, []
                at += edit != "D"
                if len(out) == 1 << 16:
                    yield edit_rows(conv, out)
                    out = []
            yield edit_rows(conv, [*out, (place, before, "", None)] if before else out)


EDITS = "_conv string, _pos bigint, before array<string>, edit string, new_role string"


def edit_rows(conv: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
    columns = [pa.array([conv] * len(rows), pa.string()), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]]
    return pa.RecordBatch.from_arrays(columns, ["_conv", "_pos", "before", "edit", "new_role"])


def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the lines of each conversation, which arrive in order; nothing but the running digest is held."""
    conv, digest = None, None

    def done() -> Iterator[pa.RecordBatch]:
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["_conv", "sha"])

    for batch in batches:
        for here, lines in zip(batch.column("_conv").to_pylist(), batch.column("lines").to_pylist()):
            data = lines.encode()
            if here != conv:
                yield from done()
                conv, digest = here, hashlib.sha256(data)
            else:
                digest.update(b"\n" + data)
    yield from done()


def named(column: str) -> Column:
    """A conversation's name, which tells null from every id."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with their place ``_pos`` in the conversation and first fault.

    Rows go by turn, nulls first, then role and text. Places come from ordered ranges of all rows, so a conversation
    with most of the rows is sorted by many tasks.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.select("*", named("conv_id").alias("_conv"))
    numbered = running_totals(rows, ["_conv", F.col("turn").asc_nulls_first(), "role", "text"], {"_g": F.lit(1)})
    # texts are long, so only a digest takes part in the search for equal rows
    key = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    numbered = written(numbered.withColumn("_key", key), "ordered")
    first = numbered.groupBy("_conv").agg(F.min("_g").alias("_start"), F.count("*").alias("_rows"))
    placed = lookup_join(numbered, first, ["_conv"], salt_on=["_g"])
    placed = placed.withColumn("_pos", F.col("_g") - F.col("_start")).drop("_g", "_start")
    blank = F.rtrim("text", F.lit(SPACE)) == ""
    again = placed.where(~blank).groupBy("_conv", "_key").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    placed = lookup_join(placed, written(again, "repeats"), ["_conv", "_key"], "left", salt_on=["_pos"])
    ending = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = F.when(blank, "b").when(F.coalesce(F.col("_pos") > F.col("_first"), F.lit(False)), "d").when(~ending.isin(".", "!", "?"), "t").otherwise("-")
    return placed.withColumn("_fault", fault).drop("_first", "_key")


def derived(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """Lightest repair of every conversation of ordered rows: _conv, cost, audit, illegal (pairs of neighbours)."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("?")
    cut = rows.groupBy("_conv", F.expr(f"_pos div {segment}").alias("_seg")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", initial.alias("i"), "_fault"))).alias("r"), (F.max("_rows") <= segment).alias("_alone")
    )
    cut = cut.select("_conv", "_seg", "_alone", F.array_join("r.i", "").alias("initials"), F.array_join("r._fault", "").alias("faults"))
    parts = written(cut.mapInArrow(solved, SEGMENTS), "segments")
    most = parts.agg(F.max("_seg").alias("m")).first()["m"] or 0
    while most > 0:
        several = parts.groupBy("_conv", F.expr(f"_seg div {fan}").alias("_seg")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("_seg").alias("k"), "first", "last", "illegal", "items"))).alias("parts")
        )
        parts, most = written(several.mapInArrow(folded, SEGMENTS), "segments"), most // fan
    whole = F.filter("items", lambda x: (x["p"] == START) & x["q"].isin(*ACCEPTED))
    return parts.select("_conv", "illegal", F.array_min(whole).alias("w")).select("_conv", "illegal", "w.cost", "w.audit")


def repaired(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of rows (conv_id, turn, role, text).

    Returns one row per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and the repaired
    turns (conv_id, place, edits, roles, texts): each place is a row of the conversation with the turns put in before it
    and its own, if it stays. Null roles and texts count as one space, a null id is a conversation of its own, rows with
    a null turn come first, rows of equal turn go by role and text, so repeated rows are neighbours. Other columns are
    not looked at; an empty table gives none. ``segment`` and ``fan`` do not change a result.
    """
    placed = written(ordered(rows), "placed")
    found = written(derived(placed, segment, fan), "repairs")
    counts = placed.groupBy("_conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count(F.when(F.col("_fault") == code, 1)).alias(name) for code, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
    )
    edits = found.select("_conv", "audit").mapInArrow(edits_of, EDITS)
    turns = placed.select("_conv", "_pos", "role", "text").join(edits, ["_conv", "_pos"], "right")
    stays = F.col("edit").isin("K", "R")
    own = F.when(stays, F.array(F.coalesce("new_role", "role"))).otherwise(F.array().cast("array<string>"))
    empty = F.transform("before", lambda _: F.lit(""))
    turns = turns.select(
        "_conv", "_pos", F.concat(F.repeat(F.lit("I"), F.size("before")), "edit").alias("edits"),
        F.concat("before", own).alias("roles"), F.when(stays, F.concat(empty, F.array("text"))).otherwise(empty).alias("texts"),
    )
    return counts.join(found, "_conv"), turns


def digested(turns: DataFrame) -> DataFrame:
    """sha256 of the repaired ``role:text`` lines of every conversation that has any: _conv, sha."""
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    filled = turns.where(F.size("roles") > 0).select("_conv", "_pos", lines.alias("lines"))
    return filled.repartition("_conv").sortWithinPartitions("_conv", "_pos").mapInArrow(digests, "_conv string, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """Damage a twentieth of the rows in each of five ways, chosen by a checksum of conversation and turn."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(how == 4, "user").otherwise(word("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(how == 0, 0).when(how == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_n")).drop("_n")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    repairs, turns = repaired(damaged(given))
    every = given.select("conv_id").distinct().select("conv_id", named("conv_id").alias("_conv"))
    out = every.join(repairs.drop("conv_id"), "_conv", "left").join(digested(turns), "_conv", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)
  )
), o AS (
  SELECT conv_id, coalesce('=' || conv_id, 'null') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), h AS (
  SELECT o.*, xor(list_reduce([4294967295] || [ascii(x)::BIGINT FOR x IN string_split(name, '')], lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how
  FROM o, tab
), dam AS (
  SELECT conv, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM h
), p AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM dam),
r AS (
  SELECT conv, turn, role, text, pos, substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY pos) AS prev,
         CASE WHEN rtrim(text, E' \t\n\x0b\f\r') = '' THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN right(rtrim(text, E' \t\n\x0b\f\r'), 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault
  FROM p
), em(s, ini, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(s, t, cost, audit, lines) AS (
  SELECT s, s, 0, '', '' FROM (VALUES (0), (1), (2), (3)) v(s)
  UNION ALL SELECT s, t, 2, 'I', CASE ini WHEN 'u' THEN E'\nuser:' ELSE E'\nassistant:' END FROM em WHERE ini <> 's'
  UNION ALL SELECT s, 3, 4, 'II', E'\nuser:\nassistant:' FROM (VALUES (0), (1)) v(s)
), dp AS (
  SELECT conv, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS w FROM (SELECT DISTINCT conv FROM r)
  UNION ALL
  SELECT conv, i, s, min({'cost': cost, 'audit': audit, 'lines': lines}) FROM (
    SELECT dp.conv, r.pos AS i,
           CASE e.op WHEN 'D' THEN ins.t ELSE em.t END AS s,
           dp.w.cost + ins.cost + e.cost + CASE WHEN e.op <> 'D' AND r.fault = 't' THEN 1 ELSE 0 END AS cost,
           dp.w.audit || ins.audit || e.op AS audit,
           dp.w.lines || ins.lines || CASE e.op WHEN 'K' THEN E'\n' || r.role || ':' || r.text
             WHEN 'R' THEN CASE em.ini WHEN 'u' THEN E'\nuser:' ELSE E'\nassistant:' END || r.text ELSE '' END AS lines
    FROM dp JOIN r ON r.conv = dp.conv AND r.pos = dp.i + 1 JOIN ins ON ins.s = dp.s
    JOIN (VALUES ('K', 0), ('R', 2), ('D', 3)) e(op, cost) ON e.op = 'D' OR r.fault NOT IN ('b', 'd')
    LEFT JOIN em ON em.s = ins.t AND e.op <> 'D' AND (e.op = 'K' AND em.ini = r.ini OR e.op = 'R' AND em.ini <> 's')
    WHERE e.op = 'D' OR em.t IS NOT NULL
  ) GROUP BY conv, i, s
), f AS (
  SELECT dp.conv, min({'cost': dp.w.cost + ins.cost, 'audit': dp.w.audit || ins.audit, 'lines': dp.w.lines || ins.lines}) AS w
  FROM dp JOIN (SELECT conv, max(pos) AS n FROM r GROUP BY conv) z ON z.conv = dp.conv AND z.n = dp.i JOIN ins ON ins.s = dp.s
  WHERE ins.t IN (0, 3) GROUP BY dp.conv
), c AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(substr(w.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM o) a LEFT JOIN c ON c.conv = a.conv LEFT JOIN f ON f.conv = a.conv
"""
