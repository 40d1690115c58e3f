"""The residue fit counts all documents, however many there are."""

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewire.llm import main_body, residue

DOCUMENTS = 33_000


def _hash(text):
    h = xxhash.xxh64_intdigest(text, seed=42)
    return h - ((h >> 63) << 64)


@pytest.fixture(scope="module")
def corpus(spark):
    """Many short stories and four pages a machine filled in, whose ids have large hashes: a share of the smallest ones misses them."""
    ids = sorted((f"d{i}" for i in range(DOCUMENTS)), key=_hash)
    pages = [(i, f"parcel tracker widget stopped loading because customer profile {name} expired yesterday") for i, name in zip(ids[-4:], ("zorvla", "quimbet", "naxori", "velpund"), strict=True)]
    stories = spark.range(DOCUMENTS).select(F.concat(F.lit("d"), "id").alias("id"), F.lit("quiet harvest in the northern valley").alias("content")).filter(~F.col("id").isin(ids[-4:]))
    return stories.unionByName(spark.createDataFrame(pages, "id string, content string")), set(ids[-4:])


def test_fit_on_all_documents(corpus):
    df, made = corpus
    assert {r.id for r in residue.residue_ids(df).collect()} == made


def test_hashes_agree(spark):
    got = spark.createDataFrame([("Élan",), ("слово",), ("a",)], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    assert all(r.h == _hash(r.w) for r in got)


def test_labels_by_the_whole_fit(corpus):
    """Pages that are residue as a whole have no lines that could be labelled; stories keep theirs."""
    df, made = corpus
    few = {r.id for r in main_body.labelled_lines(df).filter(F.col("id").isin(made | {"d0", "d1"})).collect()}
    assert few == {"d0", "d1"} - made


def test_counts_in_one_pass(spark):
    """Words, slots and documents are counted together; texts are not read again for the slots."""
    texts = ["Read /a now", "Seen on e.g. page", "An end. “So” it 7 was", "plain words", "a/ b. c", "7 . x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "h long, text string")
    found = {r.word: r.n for r in residue._word_counts(rows).collect()}
    assert {k: found.get(k) for k in ("URL", "NUM", "QUOT", residue._DOCUMENT)} == {"URL": 2, "NUM": 2, "QUOT": 1, residue._DOCUMENT: 6}
    assert (found["a"], found["plain"], found["x"]) == (2, 1, 1)


def test_cut_as_tokens_say():
    """Windows cut without tokens() are masked as with it, also where letters are lowered by what stands around them."""
    pieces = ["Plain Words 12 stand here", "covid19 ２０ x²", "ΟΔΟΣ.Α ΟΔΟΣ", "İstanbul Istanbul", "404", "Not Found 404", "at /a/b it says PH", "an end.Of a.b %x% 50 %", "URLs PHP NUMB QUOTE P U N Q"]
    words = sorted({w for p in pieces for w in residue.tokens(p)} - {"here", "NUM"})
    cutter = residue._Cutter(residue.np.sort(residue.np.array([_hash(w) for w in words], dtype="int64")))
    for piece in pieces:
        masked = ["ONCE" if w == "here" else w for w in residue.tokens(piece)]
        found = cutter._found(piece)
        assert found[0] == " ".join(masked) if found else set(masked) <= {"NUM", "URL", "QUOT"}


def test_verdict_without_a_short_cut():
    """Windows that are left out by their words' sum have too little containment; digits alone are still no window."""
    index = residue.Index(residue.EXEMPLARS, 100, {"the": 90, "not": 50, "found": 3, "page": 10})
    pieces = ["Page not found", "the page not seen", "404", "404 500", "- | -", "Not found harvest", "A quiet harvest in the northern valley", "İ page", "not ΣΑΣ found", "Page 7 harvest valley"]
    for piece in pieces:
        own = residue.tokens(piece.lower())
        said = not residue._SLOTS.issuperset(own)
        assert index.verdict(piece) == (index.containment(own) >= residue.MIN_CONTAINMENT if said else None)
    assert index.beyond(pieces[6].split()) and not index.beyond(pieces[0].split()) and not index.beyond(["404"])
