"""Main text of web pages: runs of words that repeat on a host are boilerplate, what stands once is text.

Each page becomes a stream of words with a mark at the start of every block, and
the streams of a host are one long string. Of its suffix array only the order of
the first ``least_tokens`` tokens is needed, since a position lies in a repeated
substring of that length or more if and only if it lies in a window of that
length that repeats. So suffixes are keyed by host and a 128-bit print of their
first tokens, and Spark groups them: no task holds a host, however large.

A run counts as repeated if pages with different main texts have it; so copies
of an article are no boilerplate. Text that elements name as article or as
boilerplate keeps that part; runs decide about the text that nothing names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, groupby
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column
from ledgerlens.llm.markup import ARTICLE, NAMED, OPEN, Block, blocks
from ledgerlens.session import materialize

#: Tokens of the shortest repeated run: words, and one mark at the start of a block.
LEAST_TOKENS = 8
#: A print that more than this share of all open windows have is looked up from a broadcast table, of at most 1 / share rows.
HOT_SHARE = 1 / 2000


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def level(found: list[Block]) -> int:
    """The part that holds the page's main text: the best one that has text."""
    return max((b.part for b in found), default=OPEN)


def stretches(found: list[Block]) -> Iterator[list[int]]:
    """Places of the blocks outside of articles, together where no article comes between."""
    own: list[int] = []
    for i, b in enumerate(found):
        if b.part != ARTICLE:
            own.append(i)
        elif own:
            yield own
            own = []
    if own:
        yield own


def page_windows(url: str | None, page: str, least: int) -> tuple[int, list[bytes], list[bool]]:
    """Hash of the page's main text, prints of all windows outside of articles, and which of them have open words."""
    found = blocks(page)
    best = level(found)
    main = " ".join(w for b in found if b.part == best and best > NAMED for w in b.words)
    seed = xxhash.xxh3_64_intdigest(host_of(url))
    prints: list[bytes] = []
    open_words: list[bool] = []
    for own in stretches(found):
        tokens = [t for i in own for t in (f" {found[i].element}", *found[i].words)]
        upto = [0, *accumulate(o for i in own for o in (False, *[found[i].part == best > NAMED] * len(found[i].words)))]
        for k in range(len(tokens) - least + 1):
            prints.append(xxhash.xxh3_128_digest("\n".join(tokens[k:k + least]), seed))
            open_words.append(upto[k + least] > upto[k])
    return int.from_bytes(xxhash.xxh3_64_digest(main or url or ""), "little", signed=True), prints, open_words


def main_text(page: str, repeated: set[int], least: int) -> str:
    """The main text without what the windows at ``repeated`` places cover.

    A block goes whole if all its words are covered, or half of them by runs that
    have half of ``least`` words or more in it; else the words of such runs go. So
    a heading that starts like others on the host keeps its first word.
    """
    found = blocks(page)
    best = level(found)
    if best == NAMED:
        return ""
    kept = [b.words if b.part == best else [] for b in found]
    done = 0
    for own in stretches(found) if repeated else ():
        n = sum(1 + len(found[i].words) for i in own)
        covered, last = [], -1
        for k in range(n):
            if done + k in repeated and k + least <= n:
                last = k + least - 1
            covered.append(k <= last)
        done += max(0, n - least + 1)
        at = 0
        for i in own:
            words, hit = kept[i], covered[at + 1:at + 1 + len(found[i].words)]
            at += 1 + len(hit)
            if words and all(hit):
                kept[i] = []
            elif words:
                runs = [list(run) for _, run in groupby(range(len(hit)), hit.__getitem__)]
                stay = [words[w] for run in runs if not hit[run[0]] or 2 * len(run) < least for w in run]
                kept[i] = stay if 2 * len(stay) > len(words) else []
    return " ".join(w for words in kept for w in words)


def to_windows(least: int):
    """A function for mapInArrow: key, url and page become key, main text's hash, prints and marks of open words."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, prints, marks = [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                body, own, open_words = page_windows(url, page or "", least)
                bodies.append(body)
                prints.append(own)
                marks.append(open_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(bodies, pa.int64()), pa.array(prints, pa.list_(pa.binary())), pa.array(marks, pa.list_(pa.bool_()))],
                names=["a", "b", "body", "print", "open"])

    return windows


def to_text(least: int):
    """A function for mapInArrow: the page and its repeated places become its main text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(page or "", set(places or ()), least) for page, places in zip(batch.column("html").to_pylist(), batch.column("places").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["id", "url", "text", "n_chars"])

    return texts


def keyed(df: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """id, url, html and the key (a, b), 128 bits of address and page. Equal pages have equal keys and get equal verdicts."""
    url, html = column(url_column), column(html_column)
    return df.select(column(id_column).alias("id"), url.alias("url"), html.alias("html"),
                     F.xxhash64(F.lit(1), url, html).alias("a"), F.xxhash64(F.lit(2), html, url).alias("b"))


def repeated_places(pages: DataFrame, least: int) -> DataFrame:
    """(a, b, places): for each page the windows with open words that pages of the same host with another main text have too.

    Prints are grouped with partial sums, so a run on every page of a host costs
    one row a task. Frequent prints are looked up from a table of bounded size,
    the others by a join in which no key has more than a small share of the rows.
    """
    windows = materialize(
        pages.select("a", "b", "url", "html").mapInArrow(to_windows(least), "a bigint, b bigint, body bigint, print array<binary>, open array<boolean>"), "windows")
    each = windows.select("a", "b", "body", F.posexplode(F.arrays_zip("print", "open")).alias("place", "w")).select("a", "b", "body", "place", "w.*")
    asked = each.filter("open").select("a", "b", "place", "print")
    repeated = materialize(
        each.groupBy("print").agg(F.min("body").alias("low"), F.max("body").alias("high"), F.count_if("open").alias("n")).filter("low <> high and n > 0")
        .select("print", "n"), "repeated")
    least_hot = int(HOT_SHARE * (repeated.agg(F.sum("n")).first()[0] or 0))
    hot = F.broadcast(repeated.filter(F.col("n") > least_hot).select("print"))
    rare = repeated.filter(F.col("n") <= least_hot).select("print")
    hits = asked.join(hot, "print", "left_semi").unionByName(asked.join(hot, "print", "left_anti").join(rare, "print", "left_semi"))
    return materialize(hits.groupBy("a", "b").agg(F.collect_set("place").alias("places")), "places")


def extract(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """One row per row of ``df``: id, url, main text and its length in code points.

    The main text is the text of articles, without what is named as boilerplate in
    them; without an article that has text, that of a main part; without that, all
    text that is not named as boilerplate. From the last two, runs of
    ``least_tokens`` tokens or more go that pages of the host with another main
    text have too; pages without a host are one host. Null and empty pages have
    empty texts. Repeated rows get equal texts, null ids stay, an empty table
    gives no rows, further columns are not read. Pages of any length are read whole.
    """
    bounded_batches(df.sparkSession)
    pages = keyed(df, id_column, url_column, html_column)
    places = repeated_places(pages, least_tokens)
    joined = pages.join(places, ["a", "b"], "left").select("id", "url", "html", "places")
    schema = T.StructType([*joined.schema[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(to_text(least_tokens), schema).select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text", "n_chars")
