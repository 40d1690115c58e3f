"""Problem 10: long spans that stand, character for character, in more than one document.

Method: content-defined chunking with a gear rolling hash. A cut is a position whose gear hash is the least of some
window of WINDOW positions, so cuts depend on the nearby characters alone and move along with insertions. A chunk runs
from each cut to the last cut within reach. With the lengths below, every shared span of MIN_SPAN characters holds one
whole chunk that both documents cut alike, so equal digests miss no pair. Hits are then extended character by character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, staged

MIN_SPAN = 500
GEAR = 32
WINDOW = 100
#: Characters worked on at once; a longer document is one piece of its own.
SLICE_CHARS = 250_000
#: Chunks with more places than this are not paired place by place, but by the windows of a whole span around them.
HOT_PLACES = 300
RUN_FIELDS = "doc_id_a long, doc_id_b long, pos_a int, pos_b int, back int, fwd int"

_MUL = np.uint64(0x9E3779B97F4A7C15)
# The same characters at another place differ by a power of an odd number, which has an inverse.
_ODD = 0xD1342543DE82EF95
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_TABLE = None


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x + _MUL).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gear_values(codes: np.ndarray) -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        _TABLE = _mix(np.arange(0x110000, dtype=np.uint64))
    return _TABLE[codes]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:  # noqa: ANN001
    """pick over values[i : i + width] for every i where it fits, by doubling."""
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def cuts(values: np.ndarray, gear: int = GEAR, window: int = WINDOW) -> np.ndarray:
    """Positions whose gear hash is the least of a window that holds them; values are the gear values of a text."""
    if len(values) < gear + window:
        return np.empty(0, np.int64)
    h, have = values, 1
    while have < gear:  # h[i] sums values[i - k] << k over the last `gear` positions
        h = h[have:] + (h[:-have] << np.uint64(have))
        have *= 2
    low = _sliding(h, window, np.minimum)
    pad = np.concatenate((np.zeros(window - 1, np.uint64), low, np.zeros(window - 1, np.uint64)))
    top = _sliding(pad, window, np.maximum)
    return np.flatnonzero(h == top) + gear - 1


def chunks_of(texts: list[str], min_span: int = MIN_SPAN, gear: int = GEAR, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text number, start, digest, key of the chunk before) of every chunk of the texts."""
    reach = min_span - gear - 2 * window + 2
    lens = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lens)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    values = _gear_values(codes)
    at = cuts(values, gear, window)
    if not len(at):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    doc = np.searchsorted(ends, at, "right")
    last = np.searchsorted(at, np.minimum(at + reach, ends[doc] - 1), "right") - 1
    ok = last > np.arange(len(at))
    powers = np.cumprod(np.full(len(codes) + 1, _ODD, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers[:-1])))
    start, stop, doc = at[ok], at[last[ok]], doc[ok]
    inverse = np.cumprod(np.full(len(codes) + 1, _ODD_INVERSE, np.uint64))
    digest = _mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64) * _MUL)
    before = np.zeros(len(start), np.uint64)
    if len(start) > 1:
        alike = doc[1:] == doc[:-1]
        before[1:] = np.where(alike, _mix(digest[:-1] + (start[1:] - start[:-1]).astype(np.uint64)), np.uint64(0))
    if len(start) > 2:
        # in a stretch that repeats itself, equal chunks follow one another: its first and its last stand for all of them
        same = (doc[1:] == doc[:-1]) & (digest[1:] == digest[:-1])
        inner = np.zeros(len(start), bool)
        inner[1:-1] = same[:-1] & same[1:]
        start, doc, digest, before = start[~inner], doc[~inner], digest[~inner], before[~inner]
        before[1:][same[~inner[1:]]] = 0
    begin = np.concatenate(([0], ends))[doc]
    return doc, start - begin, digest.view(np.int64), before.view(np.int64)


def _slices(ids: list[int], texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    own_ids, own, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        if own and size + len(t) > SLICE_CHARS:
            yield own_ids, own
            own_ids, own, size = [], [], 0
        own_ids.append(i)
        own.append(t)
        size += len(t)
    if own:
        yield own_ids, own


def chunk_table(documents: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(digest, doc_id, pos, before): one narrow row for each chunk of each document long enough to share a span."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, texts in _slices(batch["doc_id"].tolist(), batch["text"].tolist()):
                doc, pos, digest, before = chunks_of(texts, min_span)
                yield pd.DataFrame({"digest": digest, "doc_id": np.array(ids, np.int64)[doc], "pos": pos.astype(np.int32), "before": before})

    long = documents.filter(F.col("doc_id").isNotNull() & (F.length("text") >= min_span)).select("doc_id", "text")
    return long.mapInPandas(cut, "digest long, doc_id long, pos int, before long")


def _extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How far the two neighbourhoods agree around their hits."""
    for b in batches:
        head, tail = [], []
        for x, i, y, j in zip(b["near_a"], b["off_a"], b["near_b"], b["off_b"], strict=True):
            fwd = _common(x[i:], y[j:])
            back = _common(x[:i][::-1], y[:j][::-1])
            head.append(back)
            tail.append(fwd)
        out = b[["doc_id_a", "doc_id_b", "pos_a", "pos_b"]].copy()
        out["back"], out["fwd"] = head, tail
        yield out


def _common(x: str, y: str) -> int:
    """Length of the common beginning, by halving."""
    lo, hi = 0, min(len(x), len(y))
    if x[:hi] == y[:hi]:
        return hi
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _stretched(text: str, lo: int, hi: int, span: int) -> tuple[int, int]:
    """The shared part lo..hi of a text, widened where the text repeats itself with a period of up to ``span`` characters.

    A window of the part that stands again one period on is shared there too. Where the part has windows of all phases the
    whole periodic stretch is shared, else what whole periods reach.
    """
    windows = hi - lo - span + 1
    at = text.find(text[hi - span : hi], hi - span + 1, hi + span)
    if at >= 0:
        period = at - (hi - span)
        more = _common(text[hi:], text[hi - period :])
        hi += more if windows >= period else more // period * period
    at = text.rfind(text[lo : lo + span], max(0, lo - span), lo + span - 1)
    if at >= 0:
        period = lo - at
        more = _common(text[:lo][::-1], text[: lo + period][::-1])
        lo -= more if windows >= period else more // period * period
    return lo, hi


def _covered(batches: Iterator[pd.DataFrame], span: int) -> Iterator[pd.DataFrame]:
    """(doc_id, lo, hi) of both sides of each hit, extended over the whole texts."""
    for b in batches:
        out = []
        for da, x, i, db, y, j in zip(b["doc_id_a"], b["near_a"], b["pos_a"], b["doc_id_b"], b["near_b"], b["pos_b"], strict=True):
            fwd, back = _common(x[i:], y[j:]), _common(x[:i][::-1], y[:j][::-1])
            out.append((da, *_stretched(x, i - back, i + fwd, span)))
            out.append((db, *_stretched(y, j - back, j + fwd, span)))
        yield pd.DataFrame(out, columns=["doc_id", "lo", "hi"])


def _paired(places: DataFrame, key: str) -> DataFrame:
    """(doc_id_a, pos_a, doc_id_b, pos_b) of places with the same key, but for those whose places before agree as well."""
    a = places.select(key, F.col("doc_id").alias("doc_id_a"), F.col("pos").alias("pos_a"), F.col("before").alias("before_a"))
    b = places.select(key, F.col("doc_id").alias("doc_id_b"), F.col("pos").alias("pos_b"), F.col("before").alias("before_b"))
    first = (F.col("before_a") != F.col("before_b")) | (F.col("before_a") == 0)
    return a.join(b, key).filter((F.col("doc_id_a") < F.col("doc_id_b")) & first).select("doc_id_a", "doc_id_b", "pos_a", "pos_b").distinct()


def near_places(documents: DataFrame, places: DataFrame, back: int, ahead: int) -> DataFrame:
    """(doc_id, pos, off, near): the text from ``back`` characters before each place to ``ahead`` after its start."""
    at = broadcast_if_small(staged(places, "places"), 64)
    rows = documents.select("doc_id", "text").join(at, "doc_id").select("doc_id", "pos", F.greatest(F.lit(0), F.col("pos") - back).alias("lo"), "text")
    return rows.select("doc_id", "pos", (F.col("pos") - F.col("lo")).alias("off"), F.expr(f"substring(text, lo + 1, pos - lo + {ahead})").alias("near")).distinct()


def span_windows(documents: DataFrame, places: DataFrame, min_span: int) -> DataFrame:
    """(digest, doc_id, pos, before) of the windows of ``min_span`` characters around places of hot chunks.

    In a shared span the first chunk starts within GEAR + WINDOW - 2 characters, so one of that many windows before the
    chunk is the beginning of the span. A chunk that very many documents hold thus costs a fixed number of rows for each
    of its places, and only windows that really recur are paired. Only windows that stand in two places are returned.
    """
    reach = GEAR + WINDOW - 2

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 200):
                part = batch.iloc[lo : lo + 200]
                texts, off = part["near"].tolist(), part["off"].to_numpy(np.int64)
                lens = np.array([len(t) for t in texts], np.int64)
                begin = np.cumsum(lens) - lens
                values = _gear_values(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
                powers = np.cumprod(np.full(len(values) + 1, _ODD, np.uint64))
                inverse = np.cumprod(np.full(len(values) + 1, _ODD_INVERSE, np.uint64))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers[:-1])))
                n = np.maximum(0, np.minimum(off, lens - min_span) + 1)
                row = np.repeat(np.arange(len(part)), n)
                rel = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = begin[row] + rel
                digest = _mix((sums[start + min_span] - sums[start]) * inverse[start]).view(np.int64)
                before = np.where(rel > 0, np.concatenate((np.zeros(1, np.int64), digest[:-1])), 0)
                doc, pos = part["doc_id"].to_numpy(np.int64), part["pos"].to_numpy(np.int64)
                yield pd.DataFrame({"digest": digest, "doc_id": doc[row], "pos": (pos[row] - off[row] + rel).astype(np.int32), "before": before})

    windows = staged(near_places(documents, places, reach, min_span).mapInPandas(cut, "digest long, doc_id long, pos int, before long").distinct(), "windows")
    twice = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").select("digest")
    return staged(windows.join(twice, "digest", "left_semi"), "repeated_windows")


def shared_runs(documents: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id_a, doc_id_b, pos_a, pos_b, back, fwd): verified hits of at least ``min_span`` characters.

    Chunks of one digest meet in a join, those of hot digests by windows (see span_windows), and only the first chunk of a
    run both documents share makes a candidate, so a long shared span gives one candidate instead of one for each of its
    chunks. Verification reads only the neighbourhood of ``min_span`` characters on both sides of a hit.
    """
    chunks = staged(chunk_table(documents, min_span), "chunks")
    counts = chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
    twice = staged(chunks.join(counts, "digest"), "repeated_chunks")
    hits = _paired(twice.filter(F.col("places") <= HOT_PLACES), "digest")
    hot = twice.filter(F.col("places") > HOT_PLACES).select("doc_id", "pos").distinct()
    if not hot.isEmpty():
        hits = hits.unionByName(_paired(span_windows(documents, hot, min_span), "digest")).distinct()
    hits = staged(hits, "hits")
    places = hits.select(F.col("doc_id_a").alias("doc_id"), F.col("pos_a").alias("pos")).union(hits.select("doc_id_b", "pos_b")).distinct()
    near = staged(near_places(documents, places, min_span, min_span), "near")
    na = near.select(F.col("doc_id").alias("doc_id_a"), F.col("pos").alias("pos_a"), F.col("off").alias("off_a"), F.col("near").alias("near_a"))
    nb = near.select(F.col("doc_id").alias("doc_id_b"), F.col("pos").alias("pos_b"), F.col("off").alias("off_b"), F.col("near").alias("near_b"))
    both = hits.join(na, ["doc_id_a", "pos_a"]).join(nb, ["doc_id_b", "pos_b"])
    return both.select("doc_id_a", "doc_id_b", "pos_a", "pos_b", "near_a", "off_a", "near_b", "off_b").mapInPandas(_extended, RUN_FIELDS).filter(F.col("back") + F.col("fwd") >= min_span)


def shared_pairs(documents: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id_a, doc_id_b), smaller id first, of documents that share a span of ``min_span`` characters.

    Null texts, texts shorter than the span and an empty table give none; a document never pairs with itself.
    """
    return shared_runs(documents, min_span).select("doc_id_a", "doc_id_b").distinct()


def shared_parts(documents: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share) for each document that shares a span: how much of it stands elsewhere too.

    ``shared_chars`` counts the characters that lie in some verified run. Verified runs, which are few, are extended over
    the whole texts, and over the stretch around them where a text repeats itself; the runs of a document are merged by a
    window over its own runs, sorted by their start.
    """
    found = staged(shared_runs(documents, min_span).select("doc_id_a", "doc_id_b", "pos_a", "pos_b"), "runs")
    ids = staged(found.select(F.col("doc_id_a").alias("doc_id")).union(found.select("doc_id_b")).distinct(), "sharers")
    texts = documents.join(broadcast_if_small(ids, 48), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    ta = texts.select(F.col("doc_id").alias("doc_id_a"), F.col("text").alias("near_a"))
    tb = texts.select(F.col("doc_id").alias("doc_id_b"), F.col("text").alias("near_b"))
    both = found.join(ta, "doc_id_a").join(tb, "doc_id_b").select("doc_id_a", "near_a", "pos_a", "doc_id_b", "near_b", "pos_b")
    spans = staged(both.mapInPandas(lambda batches: _covered(batches, min_span), "doc_id long, lo int, hi int").distinct(), "spans")
    w = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("hi") - F.greatest(F.col("lo"), F.coalesce(F.max("hi").over(w), F.lit(0))))
    covered = spans.select("doc_id", fresh.alias("n")).groupBy("doc_id").agg(F.sum("n").alias("shared_chars"))
    sizes = documents.filter(F.col("doc_id").isNotNull()).select("doc_id", F.length("text").alias("n_chars"))
    joined = covered.join(sizes, "doc_id")
    return joined.select("doc_id", "n_chars", "shared_chars", F.round(F.col("shared_chars") / F.col("n_chars"), 6).alias("share"))
