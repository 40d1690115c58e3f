"""Problem 3: the story of a page without the site's own furniture.

Method: two-pass block rules. Pass one decides each block (a line of the text, a block element of a page) by its stop-word
density, its length and its link density, and leaves open what these leave unclear: short sentences, lists, and long blocks
without stop words, as when they are garbled. In pass two the open ones inherit from their nearest decided neighbours.
Blocks of running text that recur in many different surroundings are notices and count as furniture, whatever their length.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.residue import MIN_COVERAGE, Index, build_index
from tidewire.runtime import broadcast_if_small, staged

#: A block of so many characters with stop words is running text, even where it does not end a sentence.
LONG = 140
#: A shorter one is, if it ends a sentence and has at least so many characters; below that it is an open short block.
MIDDLE = 96
MIN_STOPWORDS = 0.04
MAX_LINKS = 0.5
#: Running text found in so many different surroundings is a notice: short blocks, and all others.
SHORT_CONTEXTS, CONTEXTS = 3, 5

# Frequent function words of the corpus' languages.
STOPWORDS = frozenset(
    """
    the of and to in a is that for on was with as by at from it its an be has have had will would who were their they not this but which than more
    và của là các có cho trong được với không những một người tại ở đã sẽ để khi từ theo về này đó nhưng cũng hơn vì bị do ra rằng nếu nói còn
    der die das und in den von zu mit dem des ist im für auf ein eine nicht sich auch es an werden aus als hat bei wie wird nach über vor um am
    le la les de des du et en un une est que qui dans pour pas sur au par plus avec ce il sont ne se son sa aux ont mais ou d l n
    el la los las de del y en un una es que por con para su se no lo al más como pero sus le ha más sobre este entre
    и в не на что с по как из за его к от это он у для же был до бы но или так о со который которая который города городе
    """.split()  # fmt: skip
)
_BULLET = re.compile(r"^[-–—•*▪·]\s+\S")
_NUMBERED = re.compile(r"^\d{1,2}[.)]\s+\S")
_ENDS = re.compile(r"[.!?…][\"'”“»’)\]]*$")
_MENU = re.compile(r" [|›»·•/] ")
_SPACE = re.compile(r"\s+")

GOOD, BAD, OPEN, BULLET, BLANK = "G", "B", "S", "L", " "
#: Open short sentences, and open long blocks without stop words.
SHORT, BARE = "A", "O"
#: A bullet list continues running text that stands so many blocks before it at most, whatever was put between.
REACH = 8
_DIGITS = re.compile(r"\d+")


def block_key(text: str) -> int:
    """The hash by which a line of the text, its repeats and a block of the page are the same; runs of digits are alike."""
    return xxhash.xxh64_intdigest(_DIGITS.sub("0", " ".join(text.split()).lower())) - (1 << 63)


def stopword_density(text: str) -> float:
    """The share of stop words among the words between blanks; 0 without words."""
    words = text.lower().split()
    return sum(map(STOPWORDS.__contains__, words)) / len(words) if words else 0.0


def decided(block: str, residue: bool = False) -> str:
    """Pass one for one block: GOOD, BAD, or one of the open labels; BLANK for white space."""
    s = " ".join(unicodedata.normalize("NFKC", block).split())
    if not s:
        return BLANK
    if residue:
        return BAD
    if len(s) < LONG and (_BULLET.match(s) or _NUMBERED.match(s)):
        return BULLET if _BULLET.match(s) else OPEN
    menus = len(_MENU.findall(s))
    if menus and len(s) < 60 * (menus + 1):
        return BAD
    sentence = len(s) >= LONG or bool(_ENDS.search(s))
    if not sentence:  # headings, bylines, prompts
        return BAD
    dense = stopword_density(s) >= MIN_STOPWORDS
    if len(s) >= MIDDLE:
        return GOOD if dense else BARE if len(s) >= LONG else OPEN
    return SHORT if dense else BAD


def settled(labels: str) -> str:
    """Pass two: open blocks inherit from their nearest decided neighbours.

    Short sentences are story where the decided blocks next to them on both sides are (at an end of the text: on the one
    side there is). Long bare blocks are where either is, and in texts without any story. Lists and other open blocks go with
    the block that introduces them, or with the one after them where none is before; a bullet list continues the running
    text nearest before it, past furniture that was put between.
    """
    n = len(labels)
    before, after = [""] * n, [""] * n
    for near, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last = ""
        for i in order:
            near[i] = last
            if labels[i] in (GOOD, BAD):
                last = labels[i]
    out, since = [], REACH + 1
    for i, x in enumerate(labels):
        if x in (GOOD, BAD):
            since = 0 if x == GOOD else since + 1
        elif x == SHORT:
            x = GOOD if GOOD in (before[i], after[i]) and BAD not in (before[i], after[i]) else BAD
        elif x == BARE:
            x = GOOD if GOOD in (before[i], after[i]) or GOOD not in labels else BAD
        elif x == BULLET and since <= REACH:
            x = GOOD
        elif x in (OPEN, BULLET):
            x = before[i] or after[i] or BAD
        out.append(x)
    return "".join(out)


_BLOCK = re.compile(r"<(?:/?(?:p|div|li|ul|ol|tr|td|table|h[1-6]|nav|aside|article|section|footer|header|main|span|blockquote)|br)\b[^>]*>", re.I)
_UNSEEN = re.compile(r"<(script|style|noscript|svg|head)\b.*?</\1\s*>|<!--.*?-->", re.I | re.S)
_LINK = re.compile(r"<a\b[^>]*>(.*?)</a\s*>", re.I | re.S)
_TAG = re.compile(r"<[^>]*>")


def page_blocks(page: str | None) -> list[tuple[str, float]]:
    """(text, link density) of the block elements of a page, in order; nothing for null."""
    out = []
    for raw in _BLOCK.split(_UNSEEN.sub(" ", page or "")):
        text = _SPACE.sub(" ", html.unescape(_TAG.sub("", raw))).strip()
        if text:
            linked = sum(len(_TAG.sub("", x).strip()) for x in _LINK.findall(raw)) if "<a" in raw else 0
            out.append((text, min(1.0, linked / len(text))))
    return out


def linked_blocks(pages: DataFrame) -> DataFrame:
    """(raw_path, linked): the keys of the link-dense blocks of each page that has any; the smallest page text of a path counts."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, [block_key(t) for t, x in page_blocks(h) if x > MAX_LINKS]) for p, h in zip(batch["raw_path"], batch["html"], strict=True)]
            yield pd.DataFrame([r for r in rows if r[1]], columns=["raw_path", "linked"])

    rows = pages.filter(F.col("html").contains("<a") & (F.col("raw_path") != "")).select("raw_path", "html")
    return rows.mapInPandas(parse, "raw_path string, linked array<long>").groupBy("raw_path").agg(F.min("linked").alias("linked"))


def _notices(first: DataFrame) -> DataFrame:
    """(id, notices): the numbers of the lines of running text that stand in many different surroundings.

    What surrounds a line is named by the first long block of its text, so copies of one story are one surrounding.
    Surroundings are made different before they are counted, and only hashes move: a notice that a third of all documents
    print costs one row a task and surrounding.
    """
    line = F.posexplode(F.arrays_zip(F.filter(F.split("labels", ""), lambda x: x != "").alias("x"), F.col("keys").alias("k")))
    lines = first.select("id", "context", line.alias("line_no", "l")).filter(F.col("l.x").isin(GOOD, SHORT, BARE)).select("id", "context", "line_no", "l.x", "l.k")
    seen = lines.select("k", "x", "context").distinct().groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    often = staged(seen.filter(F.col("n") >= F.when(F.col("x") == SHORT, SHORT_CONTEXTS).otherwise(CONTEXTS)).select("k", "x"), "notices")
    return lines.join(broadcast_if_small(often, 24), ["k", "x"], "left_semi").groupBy("id").agg(F.collect_set("line_no").alias("notices"))


def labelled_lines(docs: DataFrame, pages: DataFrame | None = None, id_col: str = "id", text_col: str = "content", path_col: str = "raw_path") -> DataFrame:
    """(id, labels): one label for each line of each text that is not residue as a whole: G story, B furniture, blank.

    One pass over the texts leaves a string of labels and the lines' keys for each document; pages leave the keys of their
    link-dense blocks. Only these narrow rows are counted and joined, and documents without a page take no part in the
    join with pages, so the many empty paths never meet in one task. Null and empty texts give no row; rows that repeat
    an id give one.
    """
    held = docs.sparkSession.sparkContext.broadcast(build_index(docs, id_col, text_col))

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: Index = held.value
        for batch in batches:
            out = []
            for i, path, text in zip(batch["id"], batch["raw_path"], batch["text"], strict=True):
                lines = text.split("\n")
                shares = [index.coverage(x) for x in lines]
                hit, total = (sum(x[k] for x in shares) for k in (0, 1))
                if total and hit >= MIN_COVERAGE * total:
                    continue
                labels = "".join(decided(x, h > 0 and 2 * h >= t) for x, (h, t) in zip(lines, shares, strict=True))
                keys = [block_key(x) for x in lines]
                context = next((k for k, x in zip(keys, labels, strict=True) if x in (GOOD, BARE)), keys[0])
                out.append((i, path or None, labels, keys, context))
            yield pd.DataFrame(out, columns=["id", "raw_path", "labels", "keys", "context"])

    rows = docs.filter(F.col(id_col).isNotNull() & (F.col(text_col) != ""))
    path = F.col(path_col) if path_col in docs.columns else F.lit(None).cast("string")
    rows = rows.select(F.col(id_col).alias("id"), path.alias("raw_path"), F.col(text_col).alias("text"))
    first = staged(rows.mapInPandas(first_pass, "id string, raw_path string, labels string, keys array<long>, context long"), "block_labels")
    marked = first.drop("context").join(_notices(first), "id", "left")
    if pages is None:
        marked = marked.withColumn("linked", F.lit(None).cast("array<long>"))
    else:
        paged = marked.filter(F.col("raw_path").isNotNull()).join(linked_blocks(pages), "raw_path", "left")
        marked = marked.filter(F.col("raw_path").isNull()).withColumn("linked", F.lit(None).cast("array<long>")).unionByName(paged)

    def second_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for labels, keys, notices, linked in zip(batch["labels"], batch["keys"], batch["notices"], batch["linked"], strict=True):
                bad = set(notices) if notices is not None else set()
                if linked is not None:
                    dense = set(linked)
                    bad |= {n for n, (x, k) in enumerate(zip(labels, keys, strict=True)) if x != BLANK and k in dense}
                out.append(settled("".join(BAD if n in bad else x for n, x in enumerate(labels)) if bad else labels))
            yield pd.DataFrame({"id": batch["id"], "labels": out})

    return marked.select("id", "labels", "keys", "notices", "linked").mapInPandas(second_pass, "id string, labels string").dropDuplicates(["id"])


def furniture_lines(docs: DataFrame, pages: DataFrame | None = None, **columns: str) -> DataFrame:
    """(id, line_no) of the lines that are not part of the story; lines are numbered from 0, blank ones are none."""
    marks = labelled_lines(docs, pages, **columns).select("id", F.posexplode(F.split("labels", "")).alias("line_no", "x"))
    return marks.filter(F.col("x") == BAD).select("id", F.col("line_no").cast("int").alias("line_no"))


def main_bodies(docs: DataFrame, pages: DataFrame | None = None, id_col: str = "id", text_col: str = "content", **columns: str) -> DataFrame:
    """(id, body): the story lines of each row's text; residue as a whole and texts without a story give no row."""
    labels = labelled_lines(docs, pages, id_col=id_col, text_col=text_col, **columns).withColumnRenamed("id", "_id")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).join(labels, F.col("id") == F.col("_id"))
    kept = F.filter(F.split("_text", "\n"), lambda _, i: F.col("labels").substr(i + 1, F.lit(1)) == GOOD)
    return rows.select("id", F.array_join(kept, "\n").alias("body")).filter("body <> ''")


def page_bodies(pages: DataFrame) -> DataFrame:
    """(raw_path, body): the story blocks of each saved page; pages without a story give no row."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, page in zip(batch["raw_path"], batch["html"], strict=True):
                blocks = page_blocks(page)
                labels = settled("".join(BAD if x > MAX_LINKS else decided(t) for t, x in blocks))
                body = "\n".join(t for (t, _), x in zip(blocks, labels, strict=True) if x == GOOD)
                if body:
                    out.append((path, body))
            yield pd.DataFrame(out, columns=["raw_path", "body"])

    return pages.filter(F.col("html").isNotNull()).select("raw_path", "html").mapInPandas(parse, "raw_path string, body string")
