"""Problem 2: text that looks the same but differs in its characters.

Method: texts are exploded to positioned code points (flat arrays with the offsets of their texts), the decomposition and
look-alike mappings are joined in from broadcast tables, combining marks are ordered by class, and strings are rebuilt.
``visual_keys`` compares: equal keys mean equal looks. ``one_form`` rewrites: look-alikes take the script of their word,
and accents are recomposed.
"""

import hashlib
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, staged

#: Characters worked on at once; a longer text is one piece of its own.
SLICE_CHARS = 200_000

# Letters of other scripts that look like Latin ones, each with its Latin twin.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝӏҮүѴѵԌ", "ABESIJKMHOPCTYXaesijopcyxhdqwlYyVvG", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυϲϳϹ", "ABEZHIKMNOPTYXaivopucjC", strict=True))
ARMENIAN = dict(zip("օոսհցՍՏՕ", "onuhgUSO", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHGRWVSLCPKB", strict=True))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
LATIN = {"Ð": "Đ", "Ɖ": "Đ"}
LOOKALIKES = CYRILLIC | GREEK | ARMENIAN | CHEROKEE | LISU | LATIN

PLAIN, EXPANDED, SPACE, UNSEEN, MARK = range(5)


def _visible_twin(c: str) -> str:
    """``c`` decomposed as far as no visible difference goes: canonically, by width and type face, and joined letters into their parts."""
    if 0xAC00 <= ord(c) < 0xD7A4:  # composed Hangul is decomposed by rule
        return unicodedata.normalize("NFD", c)
    d = unicodedata.decomposition(c)
    if not d:
        return LOOKALIKES.get(c, c)
    tag, _, rest = d.partition(" ") if d[0] == "<" else ("", "", d)
    parts = "".join(chr(int(x, 16)) for x in rest.split())
    category = unicodedata.category(c)
    letters = category[0] == "L" and len(parts) > 1 and all(unicodedata.category(x)[0] == "L" for x in parts)
    numerals = category == "Nl" and parts.isascii() and parts.isalpha()
    fonts = tag == "<font>" and category[0] == "L"
    if tag in ("", "<wide>", "<narrow>", "<noBreak>") or fonts or (tag == "<compat>" and (letters or numerals)):
        return "".join(_visible_twin(x) for x in parts)
    return LOOKALIKES.get(c, c)


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, combining class, first twin, number of twins, twins) for all code points; built from the character database."""
    kind = np.zeros(0x110000, np.uint8)
    ccc = np.zeros(0x110000, np.uint8)
    start = np.zeros(0x110000, np.int32)
    count = np.ones(0x110000, np.uint8)
    twins: list[int] = []
    for i in range(0x110000):
        if 0xD800 <= i < 0xF900 or 0x32400 <= i < 0xE0000 or i >= 0xE0200:  # surrogates, private use, nothing assigned
            continue
        c = chr(i)
        category = unicodedata.category(c)
        if c.isspace() or category in ("Zs", "Zl", "Zp"):
            kind[i] = SPACE
        elif (category == "Cf" and not 0x600 <= i < 0x606) or i == 0x34F or 0xFE00 <= i < 0xFE10 or 0xE0100 <= i < 0xE01F0:
            kind[i] = UNSEEN
        else:
            ccc[i] = unicodedata.combining(c)
            twin = _visible_twin(c)
            if twin != c:
                kind[i], start[i], count[i] = EXPANDED, len(twins), len(twin)
                twins += map(ord, twin)
            elif ccc[i]:
                kind[i] = MARK
    return kind, ccc, start, count, np.array(twins, np.uint32)


def _exploded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def _ordered(codes: np.ndarray, off: np.ndarray, ccc: np.ndarray) -> None:
    """Combining marks in the order of their classes, in place, by swaps of neighbours within a text."""
    k = ccc[codes]
    inside = np.ones(len(codes) + 1, bool)
    inside[off] = False
    while True:
        at = np.flatnonzero((k[:-1] > k[1:]) & (k[1:] > 0) & inside[1:-1])
        if not len(at):
            return
        at = at[np.concatenate(([True], np.diff(at) > 1))]  # swaps that touch wait for the next round
        codes[at], codes[at + 1] = codes[at + 1].copy(), codes[at].copy()
        k[at], k[at + 1] = k[at + 1].copy(), k[at].copy()


def skeletons(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' visible code points in decomposed Latin-twin form, and the offsets of the texts in them."""
    kind, ccc, start, count, twins = tables()
    codes, off = _exploded(texts)
    what = kind[codes]
    keep = what != UNSEEN
    if not keep.all():
        codes, off = codes[keep], np.concatenate(([0], np.cumsum(keep)))[off]
        what = what[keep]
    wide = what == EXPANDED
    if wide.any():
        n = np.where(wide, count[codes], 1).astype(np.int64)
        ends = np.cumsum(n)
        out = np.repeat(codes, n)
        inside = np.arange(len(out)) - np.repeat(ends - n, n)
        mapped = np.repeat(wide, n)
        out[mapped] = twins[start[out[mapped]] + inside[mapped]]
        codes, off = out, np.concatenate(([0], ends))[off]
    else:
        codes = codes.copy()
    _ordered(codes, off, ccc)
    space = kind[codes] == SPACE
    codes[space] = 0x20
    # one space for a run, none at the ends of a text
    begins = np.zeros(len(codes) + 1, bool)
    begins[off] = True
    before = np.concatenate(([True], space[:-1])) | begins[:-1]
    keep = ~(space & before)
    codes, off, space = codes[keep], np.concatenate(([0], np.cumsum(keep)))[off], space[keep]
    last = off[1:][off[1:] > off[:-1]] - 1
    drop = np.zeros(len(codes), bool)
    drop[last[space[last]]] = True
    if drop.any():
        codes, off = codes[~drop], np.concatenate(([0], np.cumsum(~drop)))[off]
    return codes, off


def _sliced(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > SLICE_CHARS:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def visual_digests(texts: list[str]) -> list[bytes]:
    """A 128-bit digest of each text's looks; blank texts give b''."""
    out: list[bytes] = []
    for _, part in _sliced(texts):
        codes, off = skeletons(part)
        raw = codes.tobytes()
        out += [hashlib.blake2b(raw[4 * a : 4 * b], digest_size=16).digest() if b > a else b"" for a, b in zip(off[:-1], off[1:], strict=True)]
    return out


def visual_keys(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(id, field, look, exact): digests of the looks and of the exact characters of each field that is not blank.

    Null and blank values give no row; rows repeated as a whole give one.
    """

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for field in fields:
                own = batch[batch[field].notna()]
                texts = own[field].tolist()
                exact = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
                frame = pd.DataFrame({"id": own["id"].tolist(), "field": field, "look": visual_digests(texts), "exact": exact})
                yield frame[frame["look"] != b""]

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *fields)
    return rows.mapInPandas(digest, "id string, field string, look binary, exact binary").distinct()


def lookalike_pairs(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(field, id_a, id_b), smaller id first, of records whose field looks the same but is not the same string.

    Only looks that come in at least two exact forms are joined, so copies of one form cost nothing; AQE splits a look
    that is hot.
    """
    keys = staged(visual_keys(docs, fields, id_col), "visual_keys")
    forms = keys.groupBy("field", "look").agg(F.min("exact").alias("a"), F.max("exact").alias("b")).filter("a <> b").select("field", "look")
    many = keys.join(forms, ["field", "look"], "left_semi")
    a = many.select("field", "look", F.col("id").alias("id_a"), F.col("exact").alias("exact_a"))
    b = many.select("field", "look", F.col("id").alias("id_b"), F.col("exact").alias("exact_b"))
    return a.join(b, ["field", "look"]).filter("id_a < id_b AND exact_a <> exact_b").select("field", "id_a", "id_b").distinct()


def lookalike_classes(docs: DataFrame, fields: list[str], id_col: str = "id") -> DataFrame:
    """(field, look, id, links): each record whose field looks like another one's of different characters, with its class.

    ``look`` names the class; ``links`` counts the records of the class whose characters differ from this one's. This is
    what lookalike_pairs spells out, in one row a record: a look that a third of all records share in many forms costs
    counts only.
    """
    keys = staged(visual_keys(docs, fields, id_col), "visual_keys")
    forms = keys.groupBy("field", "look", "exact").agg(F.count(F.lit(1)).alias("own"))
    classes = forms.groupBy("field", "look").agg(F.sum("own").alias("all"), F.count(F.lit(1)).alias("forms")).filter("forms > 1")
    links = staged(forms.join(classes, ["field", "look"]).select("field", "look", "exact", (F.col("all") - F.col("own")).alias("links")), "looks")
    return keys.join(broadcast_if_small(links, 120), ["field", "look", "exact"]).select("field", F.hex("look").alias("look"), "id", "links")


@cache
def _scripts() -> tuple[np.ndarray, np.ndarray]:
    """(script of letters that have no twin: 1 Latin, 2 Cyrillic; the Cyrillic twin of a Latin letter, or itself)."""
    script = np.zeros(0x110000, np.uint8)
    back = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x250):
        if chr(i).isalpha():
            script[i] = 1
    for i in range(0x400, 0x530):
        if chr(i).isalpha():
            script[i] = 2
    for cyrillic, latin in CYRILLIC.items():
        script[ord(latin)] = 0
        back[ord(latin)] = ord(cyrillic)
    return script, back


def one_form(texts: list[str]) -> list[str]:
    """Each text in one consistent form: equal looks give equal strings.

    Look-alike letters take the script of the letters of their word that have no twin, and of the whole text where the
    word has none; white space becomes single spaces, unseen characters go, width and joined letters are resolved, and
    accents are ordered and recomposed.
    """
    out: list[str] = []
    script, back = _scripts()
    for _, part in _sliced(texts):
        codes, off = skeletons(part)
        if len(codes):
            own = script[codes]
            brk = codes == 0x20
            word = np.cumsum(brk | np.isin(np.arange(len(codes)), off))
            n = int(word[-1]) + 1
            latin, cyrillic = (np.bincount(word[own == s], minlength=n) for s in (1, 2))
            text = np.repeat(np.arange(len(part)), np.diff(off))
            tl, tc = (np.bincount(text[own == s], minlength=len(part)) for s in (1, 2))
            mine = np.where(cyrillic[word] + latin[word] > 0, cyrillic[word] > latin[word], (tc > tl)[text])
            codes = np.where(mine, back[codes], codes)
        raw = codes.astype("<u4").tobytes()
        out += [unicodedata.normalize("NFC", raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass")) for a, b in zip(off[:-1], off[1:], strict=True)]
    return out


def in_one_form(docs: DataFrame, fields: list[str]) -> DataFrame:
    """``docs`` with ``fields`` rewritten by one_form; nulls stay null and all other columns pass through."""

    def rewrite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            filled = batch.notna()
            out = pd.Series([None] * len(batch), dtype=object)
            out[filled.to_numpy()] = one_form(batch[filled].tolist())
            yield out

    udf = F.pandas_udf(rewrite, "string")
    return docs.withColumns({f: udf(F.col(f)) for f in fields})
