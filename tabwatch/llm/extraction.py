"""Main text of HTML pages.

A page is read as blocks of text with the landmark they stand in. Blocks in navigation, headers, footers,
sidebars, forms, adverts, notices and comments go by their markup. The others form the page's token stream,
and a suffix array over the streams of many pages of one host finds long substrings that repeat on distinct
pages: those of the site's template. Blocks they cover go too; all other runs stay. Inside an <article> or
its like, a run counts as template only if nearly all of the pages have it, since articles may quote each other.

A host of many pages has several shards, with a suffix array each. Runs that any shard finds often enough are
nominated by their 64-bit hash and counted over the whole host, so the outcome does not depend on the shards.
"""

from __future__ import annotations

import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import record
from tabwatch.llm.hashing import Substrings
from tabwatch.llm.suffix import equal_prefix_groups
from tabwatch.session import new_workspace, stored

#: Tokens of a run that counts as long.
RUN = 5
#: Least share of a host's distinct pages, and least number of them, with a template run: elsewhere, and in the article.
SHARE, PAGES = 0.3, 3
ARTICLE_SHARE, ARTICLE_PAGES = 0.9, 8
#: Pages and characters of text that one suffix array covers at most.
SHARD_PAGES, SHARD_CHARS = 256, 4_000_000
#: Hosts of several shards are broadcast if there are at most so many; more of them are joined by sorting.
BROADCAST_HOSTS = 100_000
#: Row groups of the stored pages, so that many tasks share a large file.
BLOCK_BYTES = 4 << 20

# Fixed word lists of HTML element names and of the names that pages give to their parts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "head script style noscript template iframe object canvas svg select option button textarea dialog form nav footer aside menu".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion nav navbar navigation "
    "menu submenu footer sidebar aside cookie cookies consent gdpr notice notices banner comment comments commentlist reply replies "
    "disqus share sharing social related recommended breadcrumb breadcrumbs newsletter subscribe subscription signup login popup "
    "modal overlay toolbar pagination pager masthead copyright disclaimer skip".split()
)
_OUTER_NAMES = frozenset("header topbar".split())  # dropped outside the article only
_ARTICLE_NAMES = frozenset("article articlebody post entry story content".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Blocks(HTMLParser):
    """Blocks as (strength of the article container they are in, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # element, dropped, container strength
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.blocks.append((self.open[-1][2] if self.open else 0, text))

    def _judge(self, tag: str, attrs: list) -> tuple[bool, int]:
        values = {k: v or "" for k, v in attrs}
        names = {x.lower() for k in ("class", "id") for x in _NAME.findall(values.get(k, ""))}
        role = values.get("role", "").lower()
        inside = self.open[-1][2] if self.open else 0
        dropped = (
            tag in _SILENT or role in _DROPPED_ROLES or bool(names & _DROPPED_NAMES) or "hidden" in values
            or values.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(values.get("style", "").lower()))
            or (not inside and (tag == "header" or bool(names & _OUTER_NAMES)))
        )
        if tag in ("body", "html", "main", "article"):
            dropped = dropped and tag in ("main", "article")
        if tag == "article" or values.get("itemprop", "").lower() == "articlebody":
            inside = max(inside, 3)
        elif tag == "main" or role == "main":
            inside = max(inside, 2)
        elif names & _ARTICLE_NAMES and tag not in ("body", "html"):
            inside = max(inside, 1)
        return dropped, inside

    def _close(self, *tags: str, within: frozenset = _BLOCK) -> None:
        """Ends the innermost open element of these names if no other block stands in between."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                del self.open[k:]
                return
            if self.open[k][0] in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        if tag in _BLOCK or tag in _SILENT:
            self.end_block()
            if tag in _BLOCK:
                self._close("p")
            if tag == "li":
                self._close("li", within=frozenset(("ul", "ol", "menu")))
            elif tag in ("dt", "dd"):
                self._close("dt", "dd", within=frozenset(("dl",)))
            elif tag == "body":
                self.open = [x for x in self.open if x[0] == "html"]
        if tag not in _VOID:
            above = self.open[-1][1] if self.open else False
            dropped, inside = self._judge(tag, attrs)
            self.open.append((tag, above or dropped, inside))

    def handle_startendtag(self, tag, attrs):  # as browsers do, a slash ends no element that is not void
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _BLOCK or tag in _SILENT:
            self.end_block()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if not (self.open and self.open[-1][1]):
            self.text.append(data)


def page_blocks(html: str | None) -> tuple[bool, list[str]]:
    """Whether the page has an article container, and the blocks in it (without one, all blocks)."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    best = max((strength for strength, _ in parser.blocks), default=0)
    return best > 0, [text for strength, text in parser.blocks if strength == best]


def content_key(blocks: list[str]) -> int:
    """What a page is about: the 63-bit hash of its block with the most words (of several the greatest text).

    Copies of a page, and near copies that differ elsewhere, have equal keys; one of them stands for all when
    repeats are counted.
    """
    longest = max(blocks, key=lambda b: (b.count(" "), b), default="")
    return xxhash.xxh3_64_intdigest(longest.encode("utf-8", "surrogatepass")) >> 1


def run_hashes(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of RUN tokens of pages (lists of blocks), one for each start, and the page of each."""
    texts = [" ".join(blocks).encode("utf-8", "surrogatepass") for blocks in pages]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
    space = data == 0x20
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(~space & (border[:-1] | np.append(True, space)[:-1]))
    ends = np.flatnonzero(~space & (border[1:] | np.append(space, True)[1:])) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    whole = np.flatnonzero(owner[RUN - 1 :] == owner[: len(owner) - RUN + 1]) if len(owner) >= RUN else np.empty(0, np.int64)
    return Substrings(data).of(starts[whole], ends[whole + RUN - 1]).view(np.int64), owner[whole]


def repeated_runs(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct run of RUN tokens, by its hash, and the number of pages that have it.

    A suffix array over the pages' streams groups equal runs; each stream ends with a mark of its own, so that no
    run spans two pages.
    """
    known: dict[str, int] = {}
    codes, lengths = [], []
    for n, blocks in enumerate(pages):
        words = " ".join(blocks).split()
        codes.extend([known.setdefault(w, len(known)) for w in words])
        codes.append(-1 - n)
        lengths.append(len(words) + 1)
    codes, lengths = np.array(codes, np.int64), np.array(lengths, np.int64)
    hashes, owner = run_hashes(pages)
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    page = np.repeat(np.arange(len(pages)), lengths)
    array, group = equal_prefix_groups(codes, RUN)
    having = np.unique(group * len(pages) + page[array]) // len(pages)  # a group once for each page
    of_token = np.empty(len(codes), np.int64)
    of_token[array] = group
    before = np.searchsorted(owner, np.arange(len(pages)))
    at = (np.cumsum(lengths) - lengths)[owner] + np.arange(len(owner)) - before[owner]  # where each hashed run starts
    groups, one = np.unique(of_token[at], return_index=True)
    return hashes[one], np.bincount(having)[groups]


def _uncovered(blocks: list[str], hits: np.ndarray) -> list[str]:
    """Blocks of a page less than half covered by runs that start at the hits; if there is none, all of them."""
    sizes = np.array([b.count(" ") + 1 for b in blocks], np.int64)
    total = int(sizes.sum())
    edge = np.zeros(total + RUN + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + RUN, -1)
    covered = np.append(0, np.cumsum(np.cumsum(edge)[:total] > 0))
    kept = [b for b, n, end in zip(blocks, sizes, np.cumsum(sizes), strict=True) if covered[end] - covered[end - n] < 0.5 * n]
    return kept or blocks  # a page that is all template is its own content


def without_runs(pages: list[tuple[int, bool, list[str]]], outside: np.ndarray, inside: np.ndarray) -> list[list[str]]:
    """Blocks of each page (key, has a container, blocks) that template runs, given by their hashes, do not cover."""
    hashes, owner = run_hashes([blocks for _, _, blocks in pages])
    first = np.searchsorted(owner, np.arange(len(pages) + 1))
    hit = {False: np.isin(hashes, outside), True: np.isin(hashes, inside)}
    return [
        _uncovered(blocks, np.flatnonzero(hit[framed][first[n] : first[n + 1]])) if blocks else blocks
        for n, (_, framed, blocks) in enumerate(pages)
    ]


def keep_unique(pages: list[tuple[int, bool, list[str]]]) -> list[list[str]]:
    """Blocks of each page (key, has a container, blocks) of a whole host that no template run covers.

    Of pages with equal keys the first one counts.
    """
    contents = {key: blocks for key, _, blocks in reversed(pages)}
    runs, n = repeated_runs(list(contents.values()))
    outside = runs[n >= max(PAGES, SHARE * len(contents))]
    inside = runs[n >= max(ARTICLE_PAGES, ARTICLE_SHARE * len(contents))]
    return without_runs(pages, outside, inside)


_PARSED = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("shards", pa.int64()), ("key", pa.int64()),
     ("framed", pa.bool_()), ("blocks", pa.list_(pa.string())), ("first", pa.bool_())]
)
_PAGE_DDL = "page_id long, url string, host string, shards long, key long, framed boolean, "
#: Blocks travel compressed page by page, which halves what is shuffled.
_SENT = pa.schema([*list(_PARSED)[:-2], pa.field("packed", pa.binary())])
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
_TEXT_DDL = "page_id long, url string, text string, n_chars long"

def _parse(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            framed, blocks = zip(*map(page_blocks, part.column("html").to_pylist()), strict=True)
            packed = [zlib.compress("\n".join(b).encode("utf-8", "surrogatepass")) for b in blocks]
            yield record(
                _SENT, **{c: part.column(c) for c in ("page_id", "url", "host", "shards")}, key=list(map(content_key, blocks)),
                framed=framed, packed=packed,
            )


def _unpack(batches):
    """Rows come sorted by host, salt and key; the first one of a key stands for its content."""
    last = None
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            texts = [zlib.decompress(p).decode("utf-8", "surrogatepass") for p in part.column("packed").to_pylist()]
            blocks = pa.array([t.split("\n") if t else [] for t in texts], pa.list_(pa.string()))
            keys = list(zip(part.column("host").to_pylist(), part.column("key").to_pylist(), strict=True))
            first = pa.array([now != before for now, before in zip(keys, [last, *keys], strict=False)], pa.bool_())
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], blocks, first], schema=_PARSED)


def _shards(batches, *lists: str):
    """Bounded runs of neighbouring pages of one host: (host, the rows, the lists of runs that go with the host)."""
    held, last, known, chars = [], None, [], 0
    for batch in batches:
        plain = batch.drop_columns(list(lists)) if lists else batch
        for start in range(0, batch.num_rows, SHARD_PAGES):
            for k, row in enumerate(plain.slice(start, SHARD_PAGES).to_pylist(), start):
                size = sum(map(len, row["blocks"]))
                if held and (row["host"] != last or len(held) >= SHARD_PAGES or chars + size > SHARD_CHARS):
                    yield last, held, *known
                    held, chars = [], 0
                if not held:
                    known = [np.array(batch.column(c)[k].as_py() or [], np.int64) for c in lists]
                held.append(row)
                last, chars = row["host"], chars + size
    if held:
        yield last, held, *known


def _pages(rows: list[dict]) -> list[tuple[int, bool, list[str]]]:
    return [(r["key"], r["framed"], r["blocks"]) for r in rows]


def _texts(rows: list[dict], kept: list[list[str]]) -> pa.RecordBatch:
    texts = [" ".join(blocks) for blocks in kept]
    return record(_TEXT, page_id=[r["page_id"] for r in rows], url=[r["url"] for r in rows], text=texts, n_chars=[len(t) for t in texts])


def _counted(host: str, runs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([host] * len(runs), pa.string()), pa.array(runs), pa.array(n)], names=["host", "run", "n"])


def _whole_hosts(batches):
    for _, rows in _shards(batches):
        yield _texts(rows, keep_unique(_pages(rows)))


def _nominate(batches):
    """Runs with SHARE of a shard's contents. One with SHARE of all contents of the host is among those of some shard."""
    for host, rows in _shards(batches):
        runs, n = repeated_runs([r["blocks"] for r in rows])
        often = n >= SHARE * len(rows)
        yield _counted(host, runs[often], n[often])


def _count(batches):
    """The number of contents with each nominated run; every row carries the runs of its host."""
    for host, rows, runs in _shards(batches, "runs"):
        hashes, owner = run_hashes([r["blocks"] for r in rows])
        named = np.isin(hashes, runs)
        pairs = np.unique(np.stack([hashes[named], owner[named]]), axis=1)
        yield _counted(host, *np.unique(pairs[0], return_counts=True))


def _without_templates(batches):
    for _, rows, outside, inside in _shards(batches, "outside", "inside"):
        yield _texts(rows, without_runs(_pages(rows), outside, inside))


def _large_host_texts(dealt: DataFrame) -> DataFrame:
    """Texts of hosts of several shards: runs that a shard nominates are counted over all contents of the host."""
    spark = dealt.sparkSession
    path = new_workspace(spark, "pages")
    dealt.write.option("compression", "zstd").option("parquet.block.size", BLOCK_BYTES).parquet(path)
    pages = spark.read.schema(dealt.schema).parquet(path)
    contents = pages.where("first").select("host", "blocks")
    counted = "host string, run long, n long"
    runs = stored(contents.mapInArrow(_nominate, counted).groupBy("host").agg(F.collect_set("run").alias("runs")), "runs")
    spread = contents.join(runs, "host").mapInArrow(_count, counted).groupBy("host", "run").agg(F.sum("n").alias("n"))
    sizes = contents.groupBy("host").agg(F.count("*").alias("contents"))
    reached = spread.join(sizes, "host").groupBy("host").agg(
        F.collect_list(F.when(F.col("n") >= F.greatest(F.lit(PAGES), SHARE * F.col("contents")), F.col("run"))).alias("outside"),
        F.collect_list(F.when(F.col("n") >= F.greatest(F.lit(ARTICLE_PAGES), ARTICLE_SHARE * F.col("contents")), F.col("run"))).alias("inside"),
    )
    kept = pages.select("page_id", "url", "host", "key", "framed", "blocks").join(stored(reached, "templates"), "host", "left")
    return kept.mapInArrow(_without_templates, _TEXT_DDL)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty page has an empty text. Pages without a host in their url share one. Repeats are counted over
    all pages of a host, whatever their number, by distinct content: of pages with an equal `content_key` that with
    the least page_id counts; each gives a row. Other columns are ignored.
    """
    spark = pages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    named = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host")
    )
    most = F.greatest(F.count("*") / SHARD_PAGES, F.coalesce(F.sum(F.length("html")), F.lit(0)) / SHARD_CHARS)
    counts = named.groupBy("host").agg(F.ceil(most).alias("shards"))
    large = stored(counts.where("shards > 1"), "hosts")
    few = large.count() <= BROADCAST_HOSTS
    cut = named.join(F.broadcast(large) if few else large.hint("merge"), "host", "left")

    def dealt(rows: DataFrame) -> DataFrame:
        parsed = rows.select("page_id", "url", "html", "host", "shards").mapInArrow(_parse, _PAGE_DDL + "packed binary")
        salt = F.coalesce(F.pmod(F.xxhash64("key"), F.col("shards")), F.lit(0))
        in_order = parsed.repartition(n, "host", salt).sortWithinPartitions("host", salt, "key", "page_id", "url", "packed")
        return in_order.mapInArrow(_unpack, _PAGE_DDL + "blocks array<string>, first boolean")

    small = dealt(cut.where("shards IS NULL")).mapInArrow(_whole_hosts, _TEXT_DDL)
    return small.unionByName(_large_host_texts(dealt(cut.where("shards IS NOT NULL")))) if not large.isEmpty() else small
