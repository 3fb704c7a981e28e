"""Cutting books into fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import fixed, text as T
from penprint.operators.scale import balanced, unnest


def split_author_prefix(df: DataFrame, value: str = "value") -> DataFrame:
    """First twelve characters are the author key, the rest is the text."""
    return df.withColumns(
        {
            "target": F.substring(value, 1, fixed.PREFIX_LENGTH),
            "text": F.expr(f"substring({value}, {fixed.PREFIX_LENGTH + 1})"),
        }
    ).drop(value)


def fragment_ends(tokens: Column, size: int, unit: str = "chars") -> Column:
    """Token positions after which a full fragment ends.

    Every token counts with its following blank. A fragment always restarts
    empty, so one pass over the lengths with an integer state is enough.
    """
    weight = (lambda t: F.length(t) + 1) if unit == "chars" else (lambda t: F.lit(1))
    start = F.struct(
        F.lit(0).alias("filled"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")
    )

    def step(state: Column, token: Column) -> Column:
        filled, at = state["filled"] + weight(token), state["at"] + 1
        full = filled >= size
        return F.struct(
            F.when(full, F.lit(0)).otherwise(filled).alias("filled"),
            at.alias("at"),
            F.when(full, F.array_append(state["ends"], at)).otherwise(state["ends"]).alias("ends"),
        )

    return F.aggregate(tokens, start, step, lambda state: state["ends"])


def split_fragments(
    df: DataFrame, number: int = 1000, unit: str = "chars", text: str = "text"
) -> DataFrame:
    """One row per fragment of at least ``number`` units, with its position.

    A full fragment is cut after its last ``. , ! ?`` and the rest of it is
    dropped; the last, partial one stays whole. Works inside each row, so the
    result is the same under any partitioning.
    """
    others = [c for c in df.columns if c != text]
    rows = balanced(df).select(*others, T.treebank_tokens(text).alias("_tok"))
    rows = rows.withColumn("_ends", fragment_ends(F.col("_tok"), number, unit))
    last = F.coalesce(F.try_element_at("_ends", F.lit(-1)), F.lit(0))
    spans = F.transform(
        "_ends",
        lambda end, i: F.struct(
            F.when(i > 0, F.element_at("_ends", F.greatest(i, F.lit(1)))).otherwise(0).alias("begin"),
            end.alias("end"),
            F.lit(True).alias("full"),
        ),
    )
    tail = F.array(
        F.struct(last.alias("begin"), F.size("_tok").alias("end"), F.lit(False).alias("full"))
    )
    spans = F.when(last < F.size("_tok"), F.concat(spans, tail)).otherwise(spans)

    def piece(span: Column) -> Column:
        whole = F.array_join(F.slice("_tok", span["begin"] + 1, span["end"] - span["begin"]), " ")
        cut = F.regexp_extract(whole, r"(?s)^.*[.,!?]", 0)
        return T.strip(F.when(span["full"] & (cut != ""), cut).otherwise(whole))

    # Fragments are joined inside the row, so their rows do not carry the token array.
    return unnest(rows.withColumn("_spans", spans), others, F.transform("_spans", piece), text, "pos").select(
        *others, "pos", text
    )


def build_corpus(books: DataFrame, number: int = 1000, unit: str = "chars") -> DataFrame:
    """Raw books (book, value) to fragments (book, target, pos, text)."""
    fragments = split_fragments(split_author_prefix(books), number, unit)
    return fragments.select("book", "target", "pos", "text")
