"""Main text of HTML pages: markup tells menus from articles, a suffix array per host finds repeated boilerplate."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from penprint.llm import words
from penprint.llm.common import bounded, written
from penprint.operators.scale import lookup_join

RUN = 12  # words that a run repeated on different pages must have
FEW = 5  # pages of different content that a run inside articles must stand on before it may be furniture
SHARD = 256 << 10  # html bytes of a host that share one suffix array
CONTENT, FURNITURE, OPEN = 0, 1, 2  # blocks of the article, of the page around it, and those that markup leaves open

PIECE = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object", "canvas", "math"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NESTED = set("address article aside blockquote body center dd details dialog div dl dt fieldset figure footer form header html li main menu nav ol section table tbody td tfoot th thead tr ul".split())
AROUND = {"nav", "aside", "footer", "form", "menu", "dialog", "button"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
NAMES = set(
    "nav navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent notice alert newsletter subscribe popup modal overlay comment comments disqus "
    "reply replies social share sharing related recommended pagination pager login signup search form toolbar".split()
)
BODIES = {"content", "post", "entry", "story", "article", "main", "body", "text"}


def names_of(attributes: str) -> tuple[set[str], str, bool]:
    """Words of class and id, role, and whether the element is hidden."""
    names, role, hidden = set(), "", False
    for key, *values in ATTRIBUTE.findall(attributes):
        value, key = next((v for v in values if v), ""), key.lower()
        if key in ("class", "id"):
            names.update(re.split(r"[^a-z0-9]+", value.lower()))
        elif key == "role":
            role = value.lower()
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return names, role, hidden


def blocks_of(html: str) -> tuple[list[str], list[int]]:
    """Blocks of text in page order, white space turned into one space, and what markup says about each.

    A block ends where an element begins or ends that is not inline; a line break is white space. Blocks inside an
    article (or, where no page has one, the main element, or one that is named like content) are content, but for
    navigation, asides, footers, forms and elements named like furniture in it. Of the rest, such elements are
    furniture and other blocks are left open.
    """
    texts, kinds, ranks = [], [], []
    stack: list[tuple[str, bool, int]] = []  # tag, furniture, rank of the container
    held: list[str] = []
    furniture, rank = False, 0

    def flush() -> None:
        if held:
            text = "".join(held)
            held.clear()
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                texts.append(text)
                kinds.append(furniture)
                ranks.append(rank)

    at = 0
    while piece := PIECE.match(html, at):
        at = piece.end()
        tag = piece[2]
        if tag is None:
            if (found := piece[0])[0] != "<" or found == "<":
                held.append(found)
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in INLINE:
            continue
        flush()
        if tag in RAW and not piece[1]:
            if not piece[3].rstrip().endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = close.end() if close else len(html)
            continue
        if tag not in NESTED and tag not in AROUND or tag in VOID:
            continue
        if piece[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            furniture, rank = stack[-1][1:] if stack else (False, 0)
            continue
        names, role, hidden = names_of(piece[3]) if piece[3].strip() else (set(), "", False)
        around = hidden or tag in AROUND or role in ROLES or bool(names & NAMES) and not names & BODIES or tag == "header" and not rank
        if not furniture and not around:
            if tag == "article":
                rank = 3
            elif tag == "main" or role == "main":
                rank = max(rank, 2)
            elif names & BODIES and tag != "body":
                rank = max(rank, 1)
        furniture = furniture or around
        stack.append((tag, furniture, rank))
    flush()
    best = max((r for r, f in zip(ranks, kinds) if not f), default=0)
    return texts, [FURNITURE if f or best and r < best else CONTENT if best else OPEN for f, r in zip(kinds, ranks)]


def repeated(tokens: np.ndarray, page: np.ndarray, content: np.ndarray, length: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens lie in a run of ``length`` or more that stands on pages of different content; the runs' ranks.

    Ranks of suffixes double their depth from one token to ``length``: equal ranks are equal runs, and their order is
    that of the suffix array to this depth. ``page`` and ``content`` number the page of every token and its distinct
    stream. Runs do not leave their page.
    """
    n = len(tokens)
    covered = np.zeros(n, bool)
    _, rank = np.unique(tokens, return_inverse=True)
    if n < length:
        return covered, np.full(n, -1)
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        follow = np.full(n, -1)
        follow[:-step] = np.where(page[step:] == page[:-step], rank[step:], -1)
        broken = (follow < 0) | (rank < 0)
        _, rank = np.unique(np.where(broken, -1, rank * (n + 1) + follow), return_inverse=True)
        rank = np.where(broken, -1, rank)
        depth += step
    starts = np.flatnonzero(rank >= 0)
    if len(starts):
        pairs = np.unique(rank[starts].astype(np.int64) * (int(content.max()) + 1) + content[starts])
        shared = np.bincount(pairs // (int(content.max()) + 1), minlength=n + 1) > 1
        begin = starts[shared[rank[starts]]]
        covered = spread(begin, n, length)
    return covered, rank


def spread(begin: np.ndarray, n: int, length: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, np.minimum(begin + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def page_counts(rank: np.ndarray, page: np.ndarray, among: np.ndarray) -> np.ndarray:
    """On how many pages each run stands, counted over the places in ``among``."""
    width = int(page.max()) + 1 if len(page) else 1
    pairs = np.unique(rank[among].astype(np.int64) * width + page[among])
    return np.bincount(pairs // width, minlength=len(rank) + 1)


def inside(content: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the runs whose words all lie in articles."""
    sums = np.append(0, np.cumsum(content))
    starts = np.flatnonzero(rank >= 0)
    return starts[sums[starts + RUN] - sums[starts] == RUN] if len(starts) else starts


def remaining(texts: list[str], kinds: list[int], covered: list[np.ndarray], wide: list[np.ndarray] | None = None) -> list[str]:
    """The words outside of runs: of open blocks outside the ``covered`` ones, of content outside the ``wide`` ones.

    Content stays as it is where the wide runs hold more than half of its words, and a page that is all repeated stays.
    """
    words_in = [0 if kind != CONTENT else len(mask) for kind, mask in zip(kinds, covered)]
    gone = 0 if wide is None else sum(int(mask.sum()) for kind, mask in zip(kinds, wide) if kind == CONTENT)
    if wide is None or 2 * gone > sum(words_in):
        wide = [np.zeros(0, bool)] * len(texts)
    out = []
    for text, kind, mask, every in zip(texts, kinds, covered, wide):
        if kind != FURNITURE:
            mask = every if kind == CONTENT else mask
            out.append(text if not mask.any() else " ".join(w for w, c in zip(text.split(" "), mask) if not c))
    out = [t for t in out if t]
    return out or [t for t, k in zip(texts, kinds) if k != FURNITURE]


def packed(texts: list[str]) -> bytes:
    """Blocks, which hold no line breaks, as one compressed value."""
    return zstandard.compress("\n".join(texts).encode()) if texts else b""


def unpacked(data: bytes) -> list[str]:
    return zstandard.decompress(data).decode().split("\n") if data else []


def parsed(pages: DataFrame, html: str) -> DataFrame:
    """Replace the html column with the page's blocks, compressed for the way to its host, and their kinds."""
    rest = pages.drop("texts", "kinds")
    kept = [c for c in rest.columns if c != html]
    schema = ST.StructType([f for f in rest.schema.fields if f.name != html]).add("texts", ST.BinaryType()).add("kinds", ST.BinaryType())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, column=html):
            found = [blocks_of(h or "") for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([packed(t) for t, _ in found], pa.binary()), pa.array([bytes(k) for _, k in found], pa.binary())],
                [*kept, "texts", "kinds"],
            )

    return rest.mapInArrow(parse, schema)


def runs_of(texts: list[list[str]]) -> Iterator[tuple[np.ndarray, int]]:
    """Hashes of each page's runs of ``RUN`` words, in order, and a number for its stream."""
    for page in texts:
        hashes, _ = words.word_hashes(pa.array(page, pa.large_string()))
        stream = int.from_bytes(hashlib.md5(hashes).digest()[:8], "little", signed=True)
        yield words.chained(hashes, RUN).view(np.int64), stream


def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct runs of every page with its host and stream."""
    for batch in batches:
        for host, (grams, stream) in zip(batch.column("_host").to_pylist(), runs_of([unpacked(t) for t in batch.column("texts").to_pylist()])):
            grams = np.unique(grams)
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(grams), pa.string()), pa.array(grams), pa.array(np.full(len(grams), stream))], ["_host", "gram", "stream"])


def places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of every page with their places, the page's stream, and whether they lie in the article."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("_row", "_host", "_texts", "_kinds"))
        for row, host, texts, kinds in zip(*columns):
            ((grams, stream),) = runs_of([texts])
            n = len(grams)
            content = np.repeat(np.frombuffer(kinds, np.uint8) == CONTENT, np.array([len(t.split(" ")) for t in texts], np.int64))
            own = np.zeros(n, bool)
            own[inside(content, np.where(np.arange(len(content)) < n, 0, -1))] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row)), pa.array([host] * n, pa.string()), pa.array(np.arange(n, dtype=np.int32)), pa.array(grams), pa.array(np.full(n, stream)), pa.array(own)],
                ["_row", "_host", "at", "gram", "stream", "own"],
            )


def host_of(url: Column) -> Column:
    """Lower-cased host of an address; addresses without one share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def extracted(pages: DataFrame, url: str = "url", html: str = "html", identity: str = "page_id", shard: int = SHARD) -> DataFrame:
    """Rows of ``pages`` without the html, with text and n_chars (code points); other columns pass unchanged.

    The token streams of all pages of a host are concatenated and a suffix array finds the runs that stand on pages of
    different content; open blocks keep what lies outside of them. Of the runs inside articles those go that stand in the
    articles of more than half of the host's pages, ``FEW`` of different content at least, unless they are more than half
    of the article's words: passages that some articles share are text. A host with more html than ``shard`` has several
    arrays; where such a host has open blocks, or a run in more than half of the articles of one array, the runs of all its
    pages are then compared between the arrays, so that the split changes nothing. Null html gives an empty text; null and malformed addresses share one host; pages with equal streams count
    as one page.
    """
    drop = [c for c in ("text", "n_chars") if c in pages.columns]
    rows = pages.drop(*drop).withColumn("_host", host_of(F.col(url)))
    sizes = rows.groupBy("_host").agg(F.sum(F.coalesce(F.octet_length(html), F.lit(0))).alias("_bytes"))
    sizes = written(sizes.select("_host", (F.floor(F.col("_bytes") / shard) + 1).cast("int").alias("_shards")), "hosts")
    key = F.xxhash64(F.coalesce(F.col(identity).cast("string"), F.lit("")), F.octet_length(html))
    blocks = parsed(rows.withColumn("_spread", key), html)
    blocks = lookup_join(blocks, sizes, ["_host"], salt_on=["_spread"]).withColumn("_shard", F.pmod("_spread", "_shards").cast("int")).drop("_spread")
    together = blocks.repartition("_host", "_shard").sortWithinPartitions("_host", "_shard")
    kept = [c for c in pages.columns if c not in (html, *drop)]
    fields = [f for f in pages.schema.fields if f.name in kept]
    schema = ST.StructType(list(fields)).add("text", ST.StringType()).add("_host", ST.StringType()).add("_shard", ST.IntegerType())
    schema = schema.add("_texts", ST.ArrayType(ST.StringType())).add("_kinds", ST.BinaryType()).add("_covered", ST.BinaryType())
    schema = schema.add("_wide", ST.ArrayType(ST.LongType()))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts, kinds = [unpacked(t) for t in table.column("texts").to_pylist()], [list(k) for k in table.column("kinds").to_pylist()]
            hosts, shards, split = (table.column(c).to_pylist() for c in ("_host", "_shard", "_shards"))
            flat = pa.array([t for page in texts for t in page], pa.large_string())
            hashes, bounds = words.word_hashes(flat)
            blocks = np.append(0, np.cumsum([len(page) for page in texts]))
            ends = bounds[blocks]
            page = np.repeat(np.arange(len(texts)), np.diff(ends))
            group = {}
            number = np.array([group.setdefault((h, s), len(group)) for h, s in zip(hosts, shards)])
            streams: dict = {}
            content = np.array([streams.setdefault((number[k], hashlib.md5(hashes[ends[k] : ends[k + 1]]).digest()), len(streams)) for k in range(len(texts))])
            salted = words.mix(hashes + number[page].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(page) else hashes
            covered, rank = repeated(salted, page, content[page] if len(page) else page)
            article = np.repeat(np.array([kind == CONTENT for of_page in kinds for kind in of_page], bool), np.diff(bounds))
            own = inside(article, rank)
            often = own[2 * page_counts(rank, page, own)[rank[own]] > np.bincount(number)[number[page[own]]]] if len(own) else own
            whole = np.array([n == 1 for n in split])
            here = often[whole[page[often]]]  # hosts of one array are decided here, of others it names the runs
            streams_of = page_counts(rank, content[page], here) if len(here) else here
            wide = spread(here[streams_of[rank[here]] >= FEW], len(page), RUN) if len(here) else None
            named: list[list[int] | None] = [None] * len(texts)
            there = often[~whole[page[often]]]
            if len(there):
                grams = words.chained(hashes, RUN).view(np.int64)[there]
                _, first = np.unique(number, return_index=True)
                for g in np.unique(number[page[there]]):
                    named[first[g]] = np.unique(grams[number[page[there]] == g]).tolist()
            out, left = [], []
            for k in range(len(texts)):
                masks = [covered[bounds[b] : bounds[b + 1]] for b in range(blocks[k], blocks[k + 1])]
                every = None if wide is None else [wide[bounds[b] : bounds[b + 1]] for b in range(blocks[k], blocks[k + 1])]
                out.append("\n".join(remaining(texts[k], kinds[k], masks, every)))
                if split[k] > 1 and OPEN in kinds[k]:
                    left.append((texts[k], bytes(kinds[k]), covered[ends[k] : ends[k + 1]].tobytes()))
                else:
                    left.append((None, None, None))
            more = [pa.array(c, t) for c, t in zip(zip(*left), (pa.list_(pa.string()), pa.binary(), pa.binary()))]
            arrays = [table.column(c).combine_chunks() for c in kept]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(out, pa.string()), pa.array(hosts), pa.array(shards, pa.int32()), *more, pa.array(named, pa.list_(pa.int64()))],
                [*kept, "text", "_host", "_shard", "_texts", "_kinds", "_covered", "_wide"],
            )

        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            keys = list(zip(batch.column("_host").to_pylist(), batch.column("_shard").to_pylist()))
            begin = 0
            for k, this in enumerate(keys):
                if last is not None and this != last and size > 1 << 19:  # whole groups, about a megabyte of text at a time
                    if k > begin:
                        held.append(batch.slice(begin, k - begin))
                    yield solve(held)
                    held, begin, size = [], k, 0
                last = this
                size += batch.nbytes // len(keys)
            held.append(batch.slice(begin))
        if held and sum(h.num_rows for h in held):
            yield solve([h for h in held if h.num_rows])

    done = written(together.mapInArrow(clean, schema), "page-texts")
    late = done.where("_covered is not null").select(*kept, "_host", "_texts", "_kinds", "_covered")
    named = written(done.where("_wide is not null").select("_host", F.explode("_wide").alias("gram")).distinct(), "often")
    asked = {"open": bool(late.limit(1).count()), "wide": bool(named.limit(1).count())}
    final = done
    if asked["wide"]:  # all pages of such hosts once more
        again = written(named.select("_host").distinct(), "often-hosts")
        source = lookup_join(rows.withColumn("_spread", F.xxhash64(html)), again, ["_host"], salt_on=["_spread"]).drop("_spread")
        unpack = F.udf(lambda data: unpacked(data), ST.ArrayType(ST.StringType()))
        found = parsed(source, html).select(*kept, "_host", unpack("texts").alias("_texts"), F.col("kinds").alias("_kinds"), F.lit(None).cast("binary").alias("_covered"))
        mark = again.withColumn("_again", F.lit(True))
        final = lookup_join(done, mark, ["_host"], "left", salt_on=["text"]).where("_again is null").drop("_again")
        late = lookup_join(late, mark, ["_host"], "left", salt_on=["_kinds"]).where("_again is null").drop("_again").select(found.columns).unionByName(found)
    final = final.where("_covered is null").select(*kept, "text")
    if any(asked.values()):
        pages_of = written(late.withColumn("_row", F.monotonically_increasing_id()), "late-pages")
        places = pages_of.select("_row", "_host", "_texts", "_kinds").mapInArrow(places_of, "_row bigint, _host string, at int, gram bigint, stream bigint, own boolean")
        # runs on pages of different arrays of one host: those of all its pages, with articles too
        open_hosts = pages_of.where(F.instr(F.hex("_kinds"), f"{OPEN:02X}") > 0).select("_host").distinct()
        split = written(open_hosts, "late-hosts")
        sources = parsed(lookup_join(rows.select("_host", html).withColumn("_spread", F.xxhash64(html)), split, ["_host"], salt_on=["_spread"]).select("_host", html), html)
        grams = sources.mapInArrow(grams_of, "_host string, gram bigint, stream bigint")
        shared = grams.groupBy("_host", "gram").agg(F.min("stream").alias("a"), F.max("stream").alias("b")).where("a < b").select("_host", "gram")
        marks = places.join(shared, ["_host", "gram"]).groupBy("_row").agg(F.sort_array(F.collect_list("at")).alias("_marks"))  # places in one page
        joined = pages_of.join(marks, "_row", "left")
        if asked["wide"]:
            hit = written(places.where("own").join(named, ["_host", "gram"]), "often-places")
            sizes_of = pages_of.groupBy("_host").agg(F.count("*").alias("_pages"))
            on = hit.select("_host", "gram", "_row", "stream").distinct().groupBy("_host", "gram")
            counted = on.agg(F.count("*").alias("n"), F.count_distinct("stream").alias("streams")).join(sizes_of, "_host")
            wide = counted.where((2 * F.col("n") > F.col("_pages")) & (F.col("streams") >= FEW)).select("_host", "gram")
            joined = joined.join(hit.join(wide, ["_host", "gram"]).groupBy("_row").agg(F.sort_array(F.collect_list("at")).alias("_every")), "_row", "left")
        else:
            joined = joined.withColumn("_every", F.lit(None).cast("array<int>"))

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for texts, kinds, covered, marks, every in zip(*(batch.column(c).to_pylist() for c in ("_texts", "_kinds", "_covered", "_marks", "_every"))):
                    bounds = np.append(0, np.cumsum([len(t.split(" ")) for t in texts], dtype=np.int64))
                    n = int(bounds[-1])
                    mask = spread(np.array(marks or [], np.int64), n, RUN)
                    if covered is not None:
                        mask = mask | np.frombuffer(covered, bool)
                    wide = spread(np.array(every or [], np.int64), n, RUN)
                    cut = [[m[a:b] for a, b in zip(bounds[:-1], bounds[1:])] for m in (mask, wide)]
                    out.append("\n".join(remaining(texts, list(kinds), *cut)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.string())], [*kept, "text"])

        joined = joined.select(*kept, "_texts", "_kinds", "_covered", "_marks", "_every")
        final = final.unionByName(joined.mapInArrow(finish, ST.StructType(list(fields)).add("text", ST.StringType())))
    return final.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op1_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", "n_chars")
