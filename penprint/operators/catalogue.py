"""Pages, works, titles and the author catalogue."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import text as T
from penprint.operators.scale import balanced, dense_ids, lookup_join, running_totals, settled

# The most frequent named character references, looked up first.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "copy": "©", "middot": "·", "laquo": "«", "raquo": "»", "mdash": "—", "ndash": "–",
    "hellip": "…", "shy": "­", "sect": "§", "deg": "°", "times": "×",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bdquo": "„",
}


def unescape(c: Column | str) -> Column:
    """Resolve named (all of HTML 5) and numeric character references that end with a semicolon."""
    column = F.col(c) if isinstance(c, str) else c
    pieces = T.extract_all(column, r"&#?[A-Za-z0-9]+;|[^&]+|&")
    often = F.create_map(*[F.lit(x) for k, v in ENTITIES.items() for x in (f"&{k};", v)])
    named = F.create_map(*[F.lit(x) for k, v in html5.items() if k.endswith(";") for x in (f"&{k}", v)])

    def resolve(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^&#([0-9]+);$", 1)
        hexa = F.regexp_extract(piece, r"^&#[xX]([0-9A-Fa-f]+);$", 1)
        code = F.coalesce(decimal.try_cast("bigint"), F.conv(hexa, 16, 10).try_cast("bigint"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
        numeric = (decimal != "") | (hexa != "")
        reference = F.coalesce(
            F.try_element_at(often, piece),
            F.when(numeric, F.coalesce(char, F.lit("\ufffd"))),
            F.try_element_at(named, piece),
            piece,
        )
        return F.when(piece.startswith("&") & (piece != "&"), reference).otherwise(piece)

    return F.array_join(F.transform(pieces, resolve), "")


def extract_page_text(
    pages: DataFrame, tag: str = "span", cls: str | None = "p", html: str = "html", out: str = "text",
    nests: bool = True,
) -> DataFrame:
    """Text of all ``<tag class=cls>`` blocks of a page, joined.

    The page is cut into tags and text, and one pass keeps the nesting depth, so
    inner elements of the same name do not end a block early. ``nests=False`` is
    for elements that a new opening tag closes, such as ``p``.
    """
    bare = F.regexp_replace(
        html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", ""
    )
    tokens = T.extract_all(bare, r"<[A-Za-z/!?][^>]*>|<|[^<]+")
    any_open, any_close = rf"(?is)^<{tag}(\s[^>]*)?>$", rf"(?is)^</{tag}\s*>$"
    if cls is None:
        opens = any_open
    else:
        opens = rf"(?is)^<{tag}\s(?:[^>]*\s)?class\s*=\s*[\"']?(?:[^\"'>]*\s)?{cls}(?=[\s\"'>])[^>]*>$"
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, piece: Column) -> Column:
        depth, kept = state["depth"], state["kept"]
        markup = piece.rlike(r"(?s)^<[A-Za-z/!?].*>$")
        deeper = depth + 1 if nests else F.lit(1)
        after = (
            F.when(~markup, depth)
            .when((depth > 0) & piece.rlike(any_open), deeper)
            .when((depth == 0) & piece.rlike(opens), F.lit(1))
            .when((depth > 0) & piece.rlike(any_close), depth - 1)
            .otherwise(depth)
        )
        text = F.when((depth > 0) & ~markup, F.array_append(kept, piece)).otherwise(kept)
        return F.struct(after.alias("depth"), text.alias("kept"))

    kept = F.aggregate(tokens, start, step, lambda state: state["kept"])
    return balanced(pages).withColumn(out, unescape(F.array_join(kept, "")))


def page_key(url: Column | str) -> Column:
    """Work path of a page address: language and number, without host and query."""
    column = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(column, r"^[a-z]+://[^/]+/([a-z]+/[0-9]+)", 1)


def page_number(url: Column | str) -> Column:
    column = F.col(url) if isinstance(url, str) else url
    number = F.regexp_extract(column, r"[?&]page=([0-9]+)", 1)
    return F.coalesce(number.try_cast("int"), F.lit(1))


def ordered_pages(pages: DataFrame, work: str, page: str, tie: str, text: str = "text") -> DataFrame:
    """(work, place, text): the pages of every work in order, from place 0; for works too long to be one string.

    Places come from running totals over range-partitioned keys, not from one window per work.
    """
    placed = running_totals(pages.select(work, page, tie), [work, page, tie], {"_at": F.lit(1)})
    placed = settled(placed)
    starts = placed.groupBy(work).agg(F.min("_at").alias("_from"))
    places = lookup_join(placed, settled(starts), [work], salt_on=[page, tie]).select(
        tie, (F.col("_at") - F.col("_from")).cast("bigint").alias("place")
    )
    return pages.select(work, tie, text).join(places, tie).select(work, "place", text)


def assemble_works(
    pages: DataFrame, work: str, page: str, tie: str, text: str = "text", block: int = 256
) -> DataFrame:
    """Join the pages of a work in page order: (work, text, n_pages), one row per work.

    Blocks of ``block`` pages are joined first, spread over tasks, then the few block texts of a work in order;
    ``block`` steers the balance, never the result. A null text counts as empty. A work longer than the largest string
    is served by ``ordered_pages``.
    """
    rows = ordered_pages(pages, work, page, tie, text)
    step = F.floor(F.col("place") / F.lit(block)).alias("_block")

    def joined(order: str) -> Column:
        pair = F.struct(order, F.coalesce(text, F.lit("")).alias("v"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["v"]), "").alias(text)

    blocks = rows.groupBy(work, step).agg(joined("place"), F.count("*").alias("n"))
    return blocks.groupBy(work).agg(joined("_block"), F.sum("n").alias("n_pages"))


def plan_titles(tasks: DataFrame, found: DataFrame, title: str = "title") -> DataFrame:
    """Every wanted title once, with ``known`` telling whether it was found before.

    Titles to fetch are those that are not known.
    """
    wanted = tasks.select(title).distinct()
    have = found.select(title).distinct().withColumn("_have", F.lit(True))
    joined = wanted.join(have, title, "left")
    return joined.select(title, F.col("_have").isNotNull().alias("known"))


def missing_titles(tasks: DataFrame, found: DataFrame, title: str = "title") -> DataFrame:
    return tasks.select(title).distinct().join(found.select(title), title, "left_anti")


def author_names(catalogue: DataFrame) -> DataFrame:
    """author_id to author; the greatest name wins."""
    return catalogue.groupBy("author_id").agg(F.max("author").alias("author"))


def assign_author_ids(works: DataFrame, author: str, order: str) -> DataFrame:
    """Number authors 0, 1, 2, ... by first appearance, with the padded prefix."""
    first = works.groupBy(author).agg(F.min(order).alias("first_seen"))
    ids = dense_ids(first, ["first_seen"], "author_id")
    return ids.withColumn("prefix", T.author_prefix("author_id"))


def encode_labels(df: DataFrame, label: str, out: str = "label_id") -> DataFrame:
    """Number the label values in alphabetical order, starting at zero."""
    codes = dense_ids(df.select(label).distinct(), [label], out)
    return lookup_join(df, settled(codes), [label], salt_on=df.columns)


def map_labels(df: DataFrame, label: str, out: str = "name") -> DataFrame:
    return df.withColumn(out, T.label_name(label))
