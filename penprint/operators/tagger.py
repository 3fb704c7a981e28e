"""Tags in context: a first-order tag model, learned by counting, and the best path of every sentence.

Costs are whole numbers (millionths of a nat), so sums are exact and equal paths are told apart in the same way on any
machine. Tables of sentences have an array column of word forms.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.operators.scale import common_part, fits_broadcast, rare_rows, stored

UNIT = 1_000_000
NEVER = 1 << 40
MOST_TAGS = 512


@dataclass
class TagModel:
    """Tags in order, costs of one tag after another (the last row and column stand for the border of a sentence), costs
    of a form under each tag (form, costs; null where it never has the tag), and those of a form that was not seen."""

    tags: list[str]
    steps: np.ndarray
    forms: DataFrame
    unseen: list[int]


def cost(part: Column, whole: Column) -> Column:
    """Minus the logarithm of a share, in millionths."""
    return F.round(-F.log(part.cast("double") / whole) * UNIT).cast("bigint")


def learn(sentences: DataFrame, forms: str = "forms", tags: str = "tags") -> TagModel:
    """Count a model from sentences with an array of forms and one of tags.

    Words without a tag are left out of the counts of forms and break the chain. A tag follows another with
    (n + 1) / (total + tags + 1); a form has a tag as often as it was seen with it; a form that was never seen counts as
    one that was seen once, so its costs come from the forms of one occurrence. The tag set and its square come to the
    driver; more than ``MOST_TAGS`` tags are refused. Forms stay a table.
    """
    words = sentences.select(F.explode(F.arrays_zip(F.col(forms).alias("form"), F.col(tags).alias("tag"))).alias("w")).select("w.form", "w.tag")
    seen = words.where(F.col("tag").isNotNull() & F.col("form").isNotNull())
    counted = stored(seen.groupBy("form", "tag").agg(F.count("*").alias("n")), "forms")
    once = counted.groupBy("form").agg(F.sum("n").alias("n"), F.first("tag").alias("tag")).where("n = 1").groupBy("tag").agg(F.count("*").alias("once"))
    totals = counted.groupBy("tag").agg(F.sum("n").alias("total")).join(F.broadcast(once), "tag", "left").na.fill(0, ["once"])
    listed = totals.limit(MOST_TAGS + 1).collect()
    if len(listed) > MOST_TAGS:
        raise ValueError(f"more than {MOST_TAGS} tags; cut them first")
    names = sorted(r["tag"] for r in listed)
    place = {t: i for i, t in enumerate(names)}
    n = len(names)
    border = F.array(F.lit(None).cast("string"))
    pairs = F.zip_with(F.concat(border, tags), F.concat(tags, border), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    spread = sentences.where(F.size(tags) > 0).select(F.posexplode(pairs).alias("i", "p"), F.size(tags).alias("n"))
    known = spread.where((F.col("p.a").isNotNull() | (F.col("i") == 0)) & (F.col("p.b").isNotNull() | (F.col("i") == F.col("n"))))
    moves = np.zeros((n + 1, n + 1))
    for r in known.groupBy("p.a", "p.b").agg(F.count("*").alias("n")).collect():
        moves[n if r["a"] is None else place[r["a"]], n if r["b"] is None else place[r["b"]]] = r["n"]
    steps = np.rint(-np.log((moves + 1) / (moves.sum(1, keepdims=True) + n + 1)) * UNIT).astype(np.int64)
    own = counted.join(F.broadcast(totals), "tag").select("form", "tag", cost(F.col("n"), F.col("total")).alias("c"))
    by_tag = F.map_from_entries(F.collect_list(F.struct("tag", "c")))
    costs = F.array(*[F.try_element_at("m", F.lit(t)) for t in names]) if names else F.array().cast("array<bigint>")
    table = stored(own.groupBy("form").agg(by_tag.alias("m")).select("form", costs.alias("costs")), "costs")
    size = {r["tag"]: (r["once"], r["total"]) for r in listed}
    unseen = [int(np.rint(-np.log((size[t][0] + 1) / (size[t][1] + n)) * UNIT)) for t in names]
    return TagModel(names, steps, table, unseen)


def best_paths(costs: np.ndarray, bounds: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The cheapest tags of many sentences at once; at equal cost the lower tag wins, from the end backwards.

    ``costs`` has a row per word, ``bounds`` the begins of the sentences and the end. Sentences go side by side, the
    longest first, so one step serves all that have a word there.
    """
    n = steps.shape[0] - 1
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = bounds[:-1][order], lengths[order]
    out = np.zeros(len(costs), np.int64)
    if not len(costs):
        return out
    back = np.zeros((len(costs), n), np.int16)
    score = steps[n, :n] + costs[begins[lengths > 0]]
    ended = np.zeros((len(lengths), n), np.int64)
    inner = steps[:n, :n]
    for t in range(1, int(lengths[0])):
        here = int(np.searchsorted(-lengths, -t, "left"))  # sentences longer than t
        ended[here : len(score)] = score[here:]
        score = score[:here]
        ways = score[:, :, None] + inner
        from_ = ways.argmin(1)
        rows = begins[:here] + t
        back[rows] = from_
        score = np.take_along_axis(ways, from_[:, None, :], 1)[:, 0] + costs[rows]
    ended[: len(score)] = score
    filled = int(np.searchsorted(-lengths, 0, "left"))
    tag = (ended[:filled] + steps[:n, n]).argmin(1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        here = int(np.searchsorted(-lengths, -t, "left"))
        rows = begins[:here] + t
        out[rows] = tag[:here]
        tag[:here] = back[rows, tag[:here]]
    return out


def tag_sentences(sentences: DataFrame, model: TagModel, doc: str, order: str = "pos", forms: str = "forms", out: str = "tags") -> DataFrame:
    """The best tags of the words of every sentence: doc, order, forms, ``out``.

    ``doc`` and ``order`` together name a sentence. A null form counts as one that was not seen; an empty or null sentence
    has no tags. The words of a sentence stay neighbours while they are looked up in a table that a count allows to
    broadcast, so nothing is shuffled. Of a larger table the frequent forms are broadcast; the costs of the other words
    are looked up by a join of their own rows and come back to their sentence as one map.
    """
    names, steps = model.tags, model.steps
    if not names:
        return sentences.select(doc, order, forms, F.array().cast("array<string>").alias(out))
    rows = sentences.select(doc, order, F.posexplode_outer(forms).alias("_i", "form"))
    if fits_broadcast(model.forms):
        joined = rows.join(F.broadcast(model.forms), "form", "left")
    else:
        near = common_part(rows, model.forms, "form")
        rare = rare_rows(rows, near, "form").join(model.forms.select("form", F.col("costs").alias("c")), "form")
        found = rare.groupBy(F.col(doc).alias("_doc"), F.col(order).alias("_order")).agg(
            F.map_from_entries(F.collect_set(F.struct("form", "c"))).alias("_rare")
        )
        own = sentences.join(found, F.col(doc).eqNullSafe(F.col("_doc")) & F.col(order).eqNullSafe(F.col("_order")), "left")
        rows = own.select(doc, order, "_rare", F.posexplode_outer(forms).alias("_i", "form"))
        joined = rows.join(F.broadcast(near), "form", "left")
        joined = joined.withColumn("costs", F.coalesce("costs", F.try_element_at("_rare", F.col("form"))))
    joined = joined.select(doc, order, "_i", "form", "costs")
    unseen = np.array(model.unseen, np.int64)

    def tagged(words: pa.Table) -> pa.RecordBatch:
        """Whole sentences in order."""
        words = words.combine_chunks()
        firsts = np.flatnonzero(_changes(words, doc) | _changes(words, order))
        real = np.asarray(words.column("_i").is_valid())
        known = words.filter(pa.array(real))
        bounds = np.append(np.append(0, np.cumsum(real))[firsts], real.sum())
        column = known.column("costs").combine_chunks()
        seen = np.asarray(column.is_valid())
        costs = np.empty((len(known), len(names)), np.int64)
        costs[~seen] = unseen
        if seen.any():
            costs[seen] = np.asarray(column.drop_null().flatten().fill_null(NEVER)).reshape(-1, len(names))
        tags = pa.array(names).take(pa.array(best_paths(costs, bounds, steps)))
        ends, text = pa.array(bounds, pa.int32()), known.column("form").combine_chunks().cast(pa.string())
        lists = [pa.ListArray.from_arrays(ends, text), pa.ListArray.from_arrays(ends, tags)]
        heads = words.select([doc, order]).take(pa.array(firsts)).combine_chunks()
        return pa.RecordBatch.from_arrays([heads.column(0).chunk(0), heads.column(1).chunk(0), *lists], [doc, order, forms, out])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = int(np.flatnonzero(_changes(held, doc) | _changes(held, order))[-1])  # that sentence may go on
            if last:
                yield tagged(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield tagged(held)

    kinds = dict(joined.dtypes)
    return joined.mapInArrow(run, f"`{doc}` {kinds[doc]}, `{order}` {kinds[order]}, `{forms}` array<string>, `{out}` array<string>")


def _changes(table: pa.Table, column: str) -> np.ndarray:
    """Whether a row's value differs from that of the row before; true for the first."""
    codes = table.column(column).combine_chunks().dictionary_encode("encode").indices
    codes = np.asarray(codes)
    return np.append(True, codes[1:] != codes[:-1])


def word_rows(tagged: DataFrame, doc: str, forms: str = "forms", tags: str = "tags") -> DataFrame:
    """Rows (doc, token, tag) of tagged sentences, as ``pos.tag_counts`` takes them; one with nulls for an empty sentence."""
    pairs = F.explode_outer(F.arrays_zip(F.col(forms).alias("token"), F.col(tags).alias("tag"))).alias("w")
    return tagged.select(doc, pairs).select(doc, "w.token", "w.tag")
