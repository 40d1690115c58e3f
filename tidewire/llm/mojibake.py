"""Problem 6: text that went through a wrong decoder.

Method: the garbled forms of every distinct word of the corpus under all encoding chains are joined by hash with all words
beyond ASCII of the documents; a hit names the original, verified by how the two are written and how often they stand in
the corpus. Words that have lost characters (or whose original the corpus does not hold) are recognised by what is left of
their byte sequences, and stay as they are.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, packed, staged

#: Single-byte decoders that UTF-8 text is wrongly put through, once or twice in a row.
CODECS = ("cp1252", "latin-1", "cp1250", "cp1251", "koi8-r", "cp437", "mac-roman", "cp850", "cp866", "cp1258")
#: Text stored in one single-byte code page and read as another: every pair of these.
STORED = ("cp1251", "koi8-r", "koi8-u", "cp866", "iso8859-5", "mac-cyrillic", "cp1250", "iso8859-2", "cp1253", "iso8859-7")
READ = ("cp1252", "latin-1", "cp1251", "koi8-r", "cp866", "mac-roman")
SINGLE = tuple((a, b) for a in STORED for b in READ if a != b)
#: A word read under SINGLE counts only with at least so many characters beyond ASCII.
SINGLE_LETTERS = 3
#: A garbled form that looks like a word itself, with fewer letters than this, counts only beside another garbled word.
SURE_LETTERS = 5
LOST = "�"

# White space that separates words; others, such as no-break spaces, can be what is left of a byte.
_WORD = re.compile(r"[^ \t\r\n]+")
_EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


@cache
def _byte_of(codec: str) -> dict[str, int]:
    """The byte each character stands for; bytes a codec leaves open are read as the control of that number."""
    table = {}
    for b in range(256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(c, b)
    return table


@cache
def _char_of(codec: str) -> str:
    """The 256 characters of a codec, by byte."""
    chars = [""] * 256
    for c, b in _byte_of(codec).items():
        chars[b] = c
    return "".join(chars)


@cache
def _encoding_of(codec: str):  # noqa: ANN202
    return codecs.charmap_build(_char_of(codec))


def _decoded(raw: bytes, codec: str) -> str:
    return codecs.charmap_decode(raw, "strict", _char_of(codec))[0]


def _encoded(text: str, codec: str) -> bytes | None:
    try:
        return codecs.charmap_encode(text, "strict", _encoding_of(codec))[0]
    except UnicodeEncodeError:
        return None


def _usual(i: int) -> bool:
    """Whether a code point is one that Latin, Vietnamese, Greek and Russian texts write."""
    return (
        0xA0 <= i <= 0x17F or i in (0x1A0, 0x1A1, 0x1AF, 0x1B0, 0x401, 0x451, 0x2026, 0x2022, 0x2116, 0x20AC, 0x2122, 0x202F, 0xFEFF, 0x3000)
        or 0x300 <= i <= 0x327 or 0x410 <= i <= 0x44F or 0x1EA0 <= i <= 0x1EF9 or 0x2000 <= i <= 0x203A or 0xFB00 <= i <= 0xFB06 or 0xFF01 <= i <= 0xFF5E or 0x391 <= i <= 0x3C9
    )


def _plausible(text: str, wide: bool = True) -> bool:
    """Whether the characters are ones that texts hold, with at least one beyond ASCII.

    Other scripts and signs count only where ``wide``, and need two characters, or one of three bytes and more: that bytes
    make those by accident is rare, but for words in Cyrillic, whose letters are lead and continuation bytes in cp866.
    """
    beyond, other, width = False, 0, 0
    for c in text:
        i = ord(c)
        if i < 0x80:
            if i < 32 and c not in "\t\n\r":
                return False
            continue
        beyond = True
        if not _usual(i):
            if not wide or unicodedata.category(c)[0] not in "LMNPS":
                return False
            other += 1
            width = max(width, 2 if i < 0x800 else 3)
    return beyond and (not other or other > 1 or width > 2)


def garbled_forms(word: str) -> set[str]:
    """What a word turns into under each chain: one wrong decoder, any two of them in a row, or a single-byte pair."""
    raw = word.encode("utf-8", "surrogatepass")
    once = {_decoded(raw, codec) for codec in CODECS}
    forms = once | {_decoded(x.encode("utf-8", "surrogatepass"), codec) for x in once for codec in CODECS}
    forms |= single_forms(word)
    forms.discard(word)
    return forms


def single_forms(word: str) -> set[str]:
    """What a word turns into under the single-byte pairs."""
    forms: set[str] = set()
    if sum(ord(c) > 127 for c in word) >= SINGLE_LETTERS:
        for stored, read in SINGLE:
            own = _encoded(word, stored)
            if own is not None:
                forms.add(_decoded(own, read))
    forms.discard(word)
    return forms


def undone(word: str, depth: int = 2) -> str | None:
    """The word with one or two wrong decodings taken back as a whole, if that gives plausible text."""
    wide = not any("\u0400" <= c <= "\u04ff" for c in word)
    for codec in CODECS:
        raw = _encoded(word, codec)
        if raw is None:
            continue
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if text != word:
            again = undone(text, depth - 1) if depth > 1 else None
            if again is not None or _plausible(text, wide):
                return again if again is not None else text
    return None


def _strange(word: str) -> bool:
    """Whether a word is not written as Cyrillic words are: other signs than letters and quotes, or capitals after small letters."""
    if not all(c.isascii() or "\u0400" <= c <= "\u045f" or c in "Ґґ«»„“”’–—…№" for c in word):
        return True
    parts = re.findall(r"[^\W\d_]+", word)
    return not parts or not all(x.islower() or x.isupper() or x[1:].islower() for x in parts)


#: Cyrillic letters from the commonest on, to tell which of two equally frequent words is the natural one.
_COMMON = {c: i for i, c in enumerate("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё")}


def _rareness(word: str) -> float:
    return sum(_COMMON.get(c, len(_COMMON)) for c in word.lower()) / len(word)


@cache
def _sequences(codec: str) -> re.Pattern[str]:
    """A lead byte with all its continuation bytes, as the codec shows them."""
    chars = _char_of(codec)
    tail = "[" + re.escape("".join(chars[0x80:0xC0])) + "]"
    group = lambda a, b: "[" + re.escape("".join(chars[a:b])) + "]"
    return re.compile(f"{group(0xC3, 0xE0)}{tail}|{group(0xE1, 0xF0)}{tail}{tail}")


def remains(word: str) -> bool:
    """Whether the word holds whole byte sequences of plausible characters amid lost ones."""
    wide = not any("\u0400" <= c <= "\u04ff" for c in word)
    for codec in ("cp1252", "latin-1", "cp1250", "cp1251", "koi8-r", "cp437", "mac-roman"):
        hits = 0
        for m in _sequences(codec).findall(word):
            raw = _encoded(m, codec)
            try:
                c = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            # one hit suffices where its characters do not stand together in any word: two symbols, or three bytes
            hits += _plausible(c, wide) * (2 if len(m) == 3 or sum(not x.isalpha() for x in m) == len(m) else 1)
        if hits >= 2:
            return True
    return False


@cache
def _kind(word: str) -> str:
    """lost (characters are gone), odd (a garbled form by its bytes), or clean (garbled only if the corpus has an original)."""
    if LOST in word:
        return "lost"
    if undone(word) is not None:
        return "odd"
    return "lost" if remains(word) else "clean"


def _words_of(text: str) -> Iterator[str]:
    """The words beyond ASCII of a text, without the ASCII marks around them."""
    return (w.strip(_EDGES) for w in _WORD.findall(text) if not w.isascii())


def words_by_kind(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(kind, word, n, id, field) of the words beyond ASCII: clean ones counted per batch, the others with their place.

    One pass over the text; a batch sends each clean word once, whatever source or document repeats it.
    """

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clean: Counter[str] = Counter()
            odd: list[tuple] = []
            for field in fields:
                for i, text in zip(batch["id"], batch[field], strict=True):
                    if not text or text.isascii():
                        continue
                    for word, n in Counter(_words_of(text)).items():
                        kind = _kind(word)
                        if kind == "clean":
                            clean[word] += n
                        else:
                            odd.append((kind, word, n, i, field))
            if _kind.cache_info().currsize > 200_000:
                _kind.cache_clear()
            yield pd.DataFrame(odd + [("clean", w, n, None, None) for w, n in clean.items()], columns=["kind", "word", "n", "id", "field"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *fields)
    return rows.mapInPandas(sort, "kind string, word string, n long, id string, field string")


def garbled_table(words: DataFrame) -> DataFrame:
    """(garbled, kind, original, weak): each corpus word that is a garbled form of another, with the most frequent such word.

    All distinct words are looked up. Single-byte pairs of Cyrillic codecs undo each other, so of two words that are forms
    of one another the original is the one written as words are; where both or neither are, the more frequent one in all
    its cases, then the one of commoner letters. ``weak`` hits are short and look like words. The forms are made where
    the clean words are and never shuffled while the vocabulary is small enough to broadcast.
    """

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for w, n, cases in zip(batch["word"], batch["n"], batch["cases"], strict=True):
                single = single_forms(w)
                out += [(g, w, n, cases, len(g) >= 3, False, False) for g in garbled_forms(w) - single]
                strange, rare = (_strange(w), _rareness(w)) if single else (False, 0.0)
                for g in single:
                    odd = _strange(g)
                    if odd or not strange:
                        out.append((g, w, n, cases, odd and not strange, rare < _rareness(g), not odd and len(g) < SURE_LETTERS))
            yield pd.DataFrame(out, columns=["garbled", "original", "n", "cases", "sure", "commoner", "weak"])

    counted = words.groupBy("kind", "word").agg(F.sum("n").alias("n")).withColumn("cases", F.sum("n").over(Window.partitionBy("kind", F.lower("word"))))
    vocabulary = staged(counted, "vocabulary")
    spread = vocabulary.filter("kind = 'clean'").select("word", "n", "cases").repartition(words.sparkSession.sparkContext.defaultParallelism * 2, "word")
    made = spread.mapInPandas(forms, "garbled string, original string, n long, cases long, sure boolean, commoner boolean, weak boolean")
    known = vocabulary.select(F.col("word").alias("garbled"), "kind", F.col("cases").alias("own_cases"))
    hits = made.join(broadcast_if_small(known, 120), "garbled").filter("kind <> 'clean' OR sure OR cases > own_cases OR (cases = own_cases AND commoner)")
    best = Window.partitionBy("garbled").orderBy(F.desc("n"), "original")
    first = hits.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select("garbled", "kind", "original", (F.col("weak") & (F.col("kind") == "clean")).alias("weak"))
    # an original that is itself a garbled word leads to its own original
    found = staged(first, "hits")
    again = broadcast_if_small(found.filter("kind = 'clean' AND NOT weak"), 160).select(F.col("garbled").alias("original"), F.col("original").alias("root"))
    return found.join(again, "original", "left").select("garbled", "kind", F.coalesce("root", "original").alias("original"), "weak")


def _places(docs: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    """(id, field, word) of the different words beyond ASCII of each field."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, field, list(set(_words_of(text)))) for field in fields for i, text in zip(batch["id"], batch[field], strict=True) if text and not text.isascii()]
            yield pd.DataFrame(out, columns=["id", "field", "words"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *fields)
    return rows.mapInPandas(read, "id string, field string, words array<string>").select("id", "field", F.explode("words").alias("word"))


def garbled_words(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(id, field, word, kind, original) of each garbled word of each field; original is null where none was verified.

    Words that only the corpus shows to be garbled are placed by a second pass over the text.
    """
    words = staged(words_by_kind(docs, fields, id_col), "words")
    found = staged(garbled_table(words).withColumnRenamed("garbled", "word"), "garbled_words")
    shown = found.filter("kind <> 'clean'").select("word", "original")
    by_bytes = words.filter("kind <> 'clean'").select("id", "field", "word", "kind").distinct().join(broadcast_if_small(shown, 160), "word", "left").withColumn("weak", F.lit(False))
    hidden = broadcast_if_small(found.filter("kind = 'clean'"), 160)
    by_corpus = _places(docs, fields, id_col).join(hidden, "word").distinct()
    columns = ["id", "field", "word", "kind", "original", "weak"]
    placed = by_bytes.select(columns).unionByName(by_corpus.select(columns))
    beside = F.count(F.lit(1)).over(Window.partitionBy("id", "field"))
    return placed.withColumn("beside", beside).filter("NOT weak OR beside > 1").drop("weak", "beside")


def garbled_fields(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(id, field, words, restorable, tier) of the fields with garbled text.

    ``words`` counts the different garbled words, ``restorable`` those with a verified original. The tier is 'table' where
    the table of garbled forms names an original of at least one word, else 'bytes': then only what is left of the byte
    sequences tells. Null and empty fields are never garbled; rows that repeat an id count once.
    """
    placed = garbled_words(docs, fields, id_col)
    counts = placed.groupBy("id", "field").agg(F.count(F.lit(1)).alias("words"), F.count("original").alias("restorable"))
    return counts.withColumn("tier", F.when(F.col("restorable") > 0, "table").otherwise("bytes"))


def restored(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """``docs`` with each garbled word of ``fields`` replaced by its verified original, where it has one.

    The words to replace travel as one small map for each garbled field; other fields and columns pass through.
    """
    found = garbled_words(docs, fields, id_col).filter("original IS NOT NULL")
    maps = staged(found.groupBy("id", "field").agg(F.map_from_entries(F.collect_list(F.struct("word", "original"))).alias("m")), "originals")
    edge = "[" + re.escape(_EDGES) + "]*"
    rows = docs.select(packed(docs), F.col(id_col).alias("id"))
    for k, field in enumerate(fields):
        own = maps.filter(F.col("field") == field).select("id", F.col("m").alias(f"m{k}"))
        rows = rows.join(own, "id", "left")

    def mended(k: int, field: str) -> Column:
        old, of = F.col(f"row.`{field}`"), F.col(f"m{k}")
        pieces = F.regexp_extract_all(old, F.lit(r"([ \t\r\n]+|[^ \t\r\n]+)"), F.lit(1))
        return F.when(of.isNull(), old).otherwise(F.array_join(F.transform(pieces, _mend(of, edge)), "")).alias(field)

    at = {field: k for k, field in enumerate(fields)}
    return rows.select(*[mended(at[c], c) if c in at else F.col(f"row.`{c}`") for c in docs.columns])


def _mend(originals: Column, edge: str):  # noqa: ANN202
    def mend(piece: Column) -> Column:
        core = F.regexp_replace(F.regexp_replace(piece, "^" + edge, ""), edge + "$", "")
        return F.when((core != "") & F.map_contains_key(originals, core), F.replace(piece, core, originals[core])).otherwise(piece)

    return mend
