"""Problem 7: what a template, a server or a browser left in place of a text.

Method: labelled residue exemplars are held in an inverted index. Each passage window of a document retrieves the
exemplars that share its words; its containment is the TF-IDF weight of the words it shares with the best one, over the
weight of all its words. Documents of which windows with high containment cover at least half are excluded.

The exemplars come from two places: a short list of public standard texts below, and a fit on all documents of the
corpus at hand (see fitted_exemplars), which labels passages that make up whole documents and differ from document to
document only in what a machine filled in.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.ranking import one_row_each
from tidewire.runtime import broadcast_if_small, packed, staged

MIN_CONTAINMENT = 0.5
MIN_COVERAGE = 0.5
#: Lines of more characters than this are cut into sentences.
WINDOW_CHARS = 200
#: A passage is a template only if it was seen with so many different fillings.
FIT_FILLINGS = 3
#: At least so much of the documents that hold an exemplar must be templates or known residue as a whole.
FIT_PURITY = 0.8
FIT_WHOLE = 0.9

# Standard texts of servers, browsers, frameworks and page templates. PH stands for an unfilled
# placeholder, URL for an address or path, NUM for digits.
EXEMPLARS = """
PH
By PH
Title PH
Published PH by PH
Updated PH
Hello PH, welcome to PH
Dear PH, thank you
Title goes here
Your text goes here
Insert text here. Add your content here. This is a placeholder. Sample text. Dummy text. Replace this text.
Headline TK. Body copy TK TK. TK
This is a test post, please ignore
asdf asdf qwerty xxxx
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
NUM Not Found
Page not found
The requested URL URL was not found on this server
The page you are looking for does not exist or has been removed. It may have moved or the link may be broken.
Sorry, we can't find that page
Oops! Something went wrong. Please try again later.
Go back to the home page or use the search box
NUM Internal Server Error
NUM Bad Gateway
NUM Service Unavailable
NUM Service Temporarily Unavailable
NUM Gateway Timeout
NUM Forbidden
You don't have permission to access URL on this server
The server is temporarily unable to service your request due to maintenance downtime or capacity problems
The server for URL is down for maintenance
Error NUM
Error establishing a database connection
SQLSTATE[NUM] server has gone away
Warning: include(URL): failed to open stream: No such file or directory in URL on line NUM
Fatal error: Uncaught exception in URL on line NUM
Unhandled exception: null reference
Traceback (most recent call last)
nginx
Access denied
Request id
Reference number
Ray ID
Your IP address has been blocked
You need to enable JavaScript to run this app
Please enable JavaScript and cookies to continue
This site requires JavaScript. Please turn on JavaScript in your browser and reload the page.
Checking your browser before accessing URL. This process is automatic. Your browser will redirect to your requested content shortly.
Verify you are human. Please complete the captcha to continue.
Không tìm thấy trang
Trang URL không tồn tại hoặc đã bị gỡ bỏ. Quay về trang chủ. Vui lòng bật JavaScript.
Lỗi máy chủ. Vui lòng thử lại sau.
Vui lòng bật JavaScript để xem trang này
Bạn không có quyền truy cập trang này
Seite nicht gefunden
Die Seite URL wurde nicht gefunden. Zurück zur Startseite. Bitte aktivieren Sie JavaScript.
Interner Serverfehler. Bitte versuchen Sie es später erneut.
Bitte aktivieren Sie JavaScript, um fortzufahren
Zugriff verweigert
Page introuvable
La page URL est introuvable. Revenez à l'accueil. Activez JavaScript.
Erreur du serveur. Veuillez réessayer plus tard.
Veuillez activer JavaScript pour continuer
Accès refusé
Página no encontrada
La página URL no existe o no está disponible. Vuelva a la portada. Active JavaScript.
Error del servidor. Inténtelo de nuevo más tarde.
Active JavaScript para continuar
Acceso denegado
Страница не найдена
Страница URL не найдена. Вернитесь на главную страницу. Включите JavaScript.
Ошибка сервера. Попробуйте позже.
Включите JavaScript, чтобы продолжить
Доступ запрещён
""".strip().split("\n")

_PLACEHOLDER = r"\{\{.{0,80}?\}\}|\{%.{0,80}?%\}|<%=?.{0,80}?%>|%%[\w .:-]{1,60}%%|[$#]\{.{0,80}?\}|\[\[[\w .:-]{1,60}\]\]|@Model(?:\.\w+)+|__\w[\w.]*?__|&lt;[\w.]+&gt;|<[\w.]+>|\[INSERT [\w .]{1,60}\]"
_URL = r"https?://\S+|/[\w.%~-]+(?:/[\w.%~-]*)*|[a-z0-9-]+(?:\.[a-z0-9-]+)+"
_TOKEN = re.compile(rf"(?P<PH>PH\b|{_PLACEHOLDER})|(?P<URL>URL\b|{_URL})|(?P<NUM>NUM\b|\d+)|(?P<QUOT>QUOT\b)|(?P<word>[^\W\d_]+)")
_QUOTE = re.compile(r"“[^”{<%$#\[]{1,200}”|„[^“{<%$#\[]{1,200}“|«[^»{<%$#\[]{1,200}»|\"[^\"{<%$#\[]{1,200}\"")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_WORDS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_PLAIN = re.compile(r"[^\W\d_]+|\d+")
# begins with one class of characters, so that it is searched for without a look at the other branches
_SIGNS = re.compile(r"[{<$#\[@_&/“„«\"%.PUNQ](?:(?<=[{<$#\[@_&/“„«\"])|(?<=%)[\w%]|(?<=[a-z0-9-]\.)[a-z0-9-]|(?<=P)H|(?<=U)RL|(?<=N)UM|(?<=Q)UOT)")
_SLOTS = frozenset(("URL", "NUM", "QUOT"))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def tokens(text: str) -> list[str]:
    """Words in lower case, with placeholders, addresses, digits and quoted passages as PH, URL, NUM and QUOT.

    A text that is one quotation is read as if it were none, so that what it says counts.
    """
    if not _SIGNS.search(text):  # none of the classes but digits can stand here
        return ["NUM" if w[0].isdecimal() else w.lower() for w in _PLAIN.findall(text)]
    out = [m.lastgroup if m.lastgroup != "word" else m.group().lower() for m in _TOKEN.finditer(_QUOTE.sub(" QUOT ", text))]
    if "QUOT" in out and _SLOTS.issuperset(out):
        out = [m.lastgroup if m.lastgroup != "word" else m.group().lower() for m in _TOKEN.finditer(text)]
    return out


def windows(text: str) -> Iterator[str]:
    """Passage windows of a text: its lines, long ones cut into sentences; blank lines give none."""
    for line in text.split("\n"):
        line = line.strip()
        if len(line) <= WINDOW_CHARS:
            if line:
                yield line
        else:
            yield from _SENTENCE.split(line)


class _Margins(dict):
    """What the words between two blanks add to a window's known weight beyond the bound; below 0 in sum, a window cannot reach it."""

    #: Pieces of text that are kept at once.
    MEMO = 300_000

    def __init__(self, weight: dict[str, float], other: float) -> None:
        self.weight, self.other = weight, other

    def __missing__(self, piece: str) -> float:
        total = held = 0.0
        for w in _PLAIN.findall(piece.lower()):
            x = self.weight.get("NUM" if w[0].isdecimal() else w)
            held += x or 0.0
            total += self.other if x is None else x
        if len(self) >= self.MEMO:
            self.clear()
        # two letters are lowered by what stands around them: left open
        self[piece] = out = math.inf if "Σ" in piece or "İ" in piece else held - MIN_CONTAINMENT * total
        return out


class Index:
    """Inverted index from words to exemplars, with the words' weights."""

    #: Windows whose verdict is kept, since a site prints the same lines often.
    MEMO = 50_000

    def __init__(self, exemplars: list[str], documents: int, found: dict[str, int]) -> None:
        self.postings: dict[str, set[int]] = {}
        for i, text in enumerate(exemplars):
            for w in tokens(text):
                self.postings.setdefault(w, set()).add(i)
        self.weight = {w: math.log((documents + 1) / (found.get(w, 0) + 1)) + 0.05 for w in self.postings}
        # placeholders are residue wherever they stand; addresses, digits and quotations say little by themselves
        self.weight["PH"] = max(self.weight.values())
        self.other = sum(self.weight.values()) / len(self.weight)
        self._margins = _Margins(self.weight, self.other)
        self._memo: dict[str, bool | None] = {}

    def containment(self, own: list[str]) -> float:
        """The weight that the window shares with its best exemplar, over its whole weight; 0 for no words."""
        known = list(filter(self.weight.__contains__, own))
        held = sum(map(self.weight.__getitem__, known))
        total = held + self.other * (len(own) - len(known))
        if held < MIN_CONTAINMENT * total or not total:  # no single exemplar can share more than all of them do
            return held / total if total else 0.0
        shared: Counter[int] = Counter()
        for w in known:
            x = self.weight[w]
            for e in self.postings.get(w, ()):
                shared[e] += x
        return max(shared.values(), default=0.0) / total

    def beyond(self, pieces: list[str]) -> bool:
        """Whether a window without signs, cut at its blanks, has too few known words for any exemplar; sums that are close are left open."""
        return sum(map(self._margins.__getitem__, pieces)) < -1e-6

    def verdict(self, window: str) -> bool | None:
        """Whether a window is residue; None where it has neither words nor placeholders of its own."""
        if window in self._memo:
            return self._memo[window]
        if _SIGNS.search(window):
            own = tokens(window)
        elif "NUM" in self.weight and self.beyond(window.split()):
            own = None
        else:  # their order does not matter here
            low = window.lower()
            own = _WORDS.findall(low) + ["NUM"] * len(_DIGITS.findall(low))
        out = False if own is None else None if _SLOTS.issuperset(own) else self.containment(own) >= MIN_CONTAINMENT
        if len(self._memo) >= self.MEMO:
            self._memo.clear()
        self._memo[window] = out
        return out

    def coverage(self, text: str | None) -> tuple[int, int]:
        """(characters of the windows that are residue, characters of all windows that say something)."""
        if not text:
            return 0, 0
        hit = total = 0
        for piece in windows(unicodedata.normalize("NFKC", text)):
            verdict = self.verdict(piece)
            if verdict is not None:
                total += len(piece)
                hit += len(piece) * verdict
        return hit, total


#: What a slot looks like in a text that was not cut into tokens.
_SEEN = {"URL": r"[/.](?<=/|\w\.)\w", "NUM": r"\d", "QUOT": r"[“„«\"]"}
#: What counts the documents among the words; as the slots', its name is no word in lower case.
_DOCUMENT = "DOC"


def _words_of(exemplars: list[str]) -> list[str]:
    return sorted({w for e in exemplars for w in tokens(e)} - _SLOTS - {"PH"})


def _marks(text: Column) -> Column:
    """The names of the slots that a text has, and the one that counts the text itself."""
    slots = [F.when(text.rlike(seen), F.array(F.lit(name))).otherwise(F.array().cast("array<string>")) for name, seen in _SEEN.items()]
    return F.concat(*slots, F.array(F.lit(_DOCUMENT)))


def _counted(docs: DataFrame, text_col: str, exemplars: list[str]) -> Index:
    """The exemplars' index, its weights counted over all documents without leaving the JVM; one count a word comes back."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_intersect(F.split(F.lower(text), r"\P{L}+"), F.array(*[F.lit(w) for w in _words_of(exemplars)]))
    counts = docs.select(F.explode(F.concat(words, _marks(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = {r.word: r.n for r in counts.collect()}
    return Index(exemplars, found.pop(_DOCUMENT, 0), found)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, text) of the documents with text, one row for each id; h is the hash of the id."""
    rows = docs.filter(F.col(id_col).isNotNull() & (F.col(text_col) != "")).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return one_row_each(rows, "id").select(F.xxhash64("id").alias("h"), "text")


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): in how many documents each word stands, each slot, and how many documents there are; in one pass."""
    words = F.concat(F.array_distinct(F.split(F.lower("text"), r"\P{L}+")), _marks(F.col("text")))
    return staged(rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")


class _Masked(dict):
    """Words as they stand in a skeleton: those of two or more documents, whose hashes are given, as they are, others as ONCE."""

    #: Words that are kept at once.
    MEMO = 300_000

    def __init__(self, common: np.ndarray) -> None:
        self.common = common

    def __missing__(self, word: str) -> str:
        h = xxhash.xxh64_intdigest(word, seed=42)  # as F.xxhash64 has it
        h -= (h >> 63) << 64
        at = int(self.common.searchsorted(h))
        held = word in _SLOTS or word == "PH" or (at < len(self.common) and self.common[at] == h)
        if len(self) >= self.MEMO:
            self.clear()
        self[word] = out = word if held else "ONCE"
        return out


class _Parts(dict):
    """What the words between two blanks are in a skeleton; they have no signs, and may have no words."""

    MEMO = 300_000

    def __init__(self, masked: _Masked) -> None:
        self.masked = masked

    def __missing__(self, piece: str) -> str:
        if len(self) >= self.MEMO:
            self.clear()
        self[piece] = out = " ".join([self.masked[w] for w in tokens(piece)])
        return out


class _Cutter:
    """Cuts texts into the windows the fit counts; what was found for a window is kept, as a site prints the same lines often."""

    MEMO = 50_000

    def __init__(self, common: np.ndarray) -> None:
        self.masked, self.known, self._memo = _Masked(common), Index(EXEMPLARS, 0, {}), {}
        self.parts = _Parts(self.masked)

    def cut(self, text: str) -> list[tuple[str, int, int, int, bool, bool, bool]]:
        """(skeleton, its hash, the hash of the window, characters, plain, filled, known) of each window that says something."""
        memo, out = self._memo, []
        for piece in windows(unicodedata.normalize("NFKC", text)):
            if piece in memo:
                found = memo[piece]
            else:
                found = self._found(piece)
                if len(memo) >= self.MEMO:
                    memo.clear()
                memo[piece] = found
            if found is not None:
                out.append(found)
        return out

    def _found(self, piece: str) -> tuple[str, int, int, int, bool, bool, bool] | None:
        pieces = piece.split()
        if _SIGNS.search(piece):
            own = tokens(piece)
            if _SLOTS.issuperset(own):
                return None
            masked = [self.masked[w] for w in own]
            skeleton, different = " ".join(masked), set(masked)
            filled = not different.isdisjoint(_FILLED)
            plain = not _UNSAID.issuperset(different)
            known = self.known.containment(own) >= MIN_CONTAINMENT
        else:  # words are lower case here, and only NUM and ONCE are not
            skeleton = " ".join(filter(None, map(self.parts.__getitem__, pieces)))
            filled = "ONCE" in skeleton
            plain = _SAID.search(skeleton) is not None
            if not (filled or plain):
                return None
            known = not self.known.beyond(pieces) and self.known.containment(tokens(piece)) >= MIN_CONTAINMENT
        if not plain:
            skeleton = ""
        return skeleton, _hash(skeleton), _hash("".join(pieces)), len(piece), plain, filled, known


_FILLED = frozenset(("URL", "QUOT", "PH", "ONCE"))
_UNSAID = _SLOTS | {"ONCE"}
_SAID = re.compile(r"[^A-Z ]")


def fitted_exemplars(docs: DataFrame, id_col: str = "id", text_col: str = "content") -> list[str]:
    """Exemplars labelled by the corpus itself: templates that make up whole documents.

    All documents are fitted on. A passage is a
    template when it comes with at least FIT_FILLINGS different addresses, titles, digits or words of no other document
    in otherwise equal words. A document is machine-made when at least FIT_WHOLE of its characters are templates or known
    residue. A passage that stands in machine-made documents in at least FIT_PURITY of its cases is an exemplar. Lines
    that a site prints around its stories are not, as most documents that hold them have a story; nor are copies of a
    story, which fill nothing in.
    """
    rows = _texts(docs, id_col, text_col)
    return _fitted(rows, _word_counts(rows))


def _fitted(rows: DataFrame, words: DataFrame) -> list[str]:
    """Texts and words stay where they are: eight bytes a common word are held by each task, and only hashes are counted and joined."""
    common = words.filter("n > 1").select(F.xxhash64("word").alias("w")).toArrow().column("w").to_numpy()
    held = rows.sparkSession.sparkContext.broadcast(np.sort(common))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = _Cutter(held.value)
        for batch in batches:
            out = [(h, *x[1:]) for h, text in zip(batch["h"], batch["text"], strict=True) for x in cutter.cut(text)]
            yield pd.DataFrame(dict(zip(("h", "s", "raw", "chars", "plain", "filled", "known"), zip(*out, strict=True), strict=True)) if out else {c: [] for c in ("h", "s", "raw", "chars", "plain", "filled", "known")})

    def skeletons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = _Cutter(held.value)
        for batch in batches:
            out = [(x[1], x[0]) for text in batch["text"] for x in cutter.cut(text)]
            yield pd.DataFrame(out, columns=["s", "skeleton"])

    cuts = staged(rows.mapInPandas(cut, "h long, s long, raw long, chars int, plain boolean, filled boolean, known boolean"), "residue_fit")
    forms = cuts.filter("plain").select("s", "raw").distinct().groupBy("s").agg(F.count(F.lit(1)).alias("forms")).filter(F.col("forms") >= FIT_FILLINGS).select("s")
    templates = broadcast_if_small(staged(forms.withColumn("template", F.lit(True)), "templates"), 24)
    marked = cuts.select("h", "s", "chars", "filled", "known").join(templates, "s", "left").withColumn("template", F.coalesce("template", F.lit(False)))
    whole = marked.groupBy("h").agg(
        (F.sum(F.when(F.col("template") | F.col("known"), F.col("chars")).otherwise(0)) >= FIT_WHOLE * F.sum("chars")).alias("made"),
        F.max(F.col("filled") & F.col("template") | F.col("known")).alias("shown"),
    )
    made = broadcast_if_small(staged(whole.filter("made AND shown").select("h", F.lit(1).alias("made")), "machine_made"), 24)
    judged = marked.filter("template").select("h", "s").distinct().join(made, "h", "left").groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.count("made").alias("made"), F.min("h").alias("h"))
    learned = staged(judged.filter((F.col("n") >= FIT_FILLINGS) & (F.col("made") >= FIT_PURITY * F.col("n"))).select("s", "h"), "learned")
    # one document for each exemplar tells its words
    named = rows.join(broadcast_if_small(learned.select("h").distinct(), 24), "h", "left_semi").mapInPandas(skeletons, "s long, skeleton string")
    found = named.join(broadcast_if_small(learned.select("s"), 24), "s", "left_semi").select("skeleton").distinct().collect()
    return sorted({" ".join(w for w in r.skeleton.split(" ") if w != "ONCE") for r in found})


def build_index(docs: DataFrame, id_col: str = "id", text_col: str = "content", exemplars: list[str] | None = None) -> Index:
    """The index of the given exemplars, or else of the standard and the fitted ones."""
    if exemplars:
        return _counted(docs, text_col, exemplars)
    rows = _texts(docs, id_col, text_col)
    words = _word_counts(rows)
    exemplars = EXEMPLARS + _fitted(rows, words)
    # the fit has counted the words already
    found = {r.word: r.n for r in words.filter(F.col("word").isin([*_words_of(exemplars), *_SEEN, _DOCUMENT])).collect()}
    return Index(exemplars, found.pop(_DOCUMENT, 0), found)


def residue_shares(docs: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(id, residue_chars, chars) for each row with text; repeated rows give one."""
    held = docs.sparkSession.sparkContext.broadcast(build_index(docs, id_col, text_col))

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, *held.value.coverage(t)) for i, t in zip(batch["id"], batch["text"], strict=True)]
            yield pd.DataFrame(out, columns=["id", "residue_chars", "chars"])

    rows = docs.filter(F.col(id_col).isNotNull() & (F.col(text_col) != "")).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(cover, "id string, residue_chars long, chars long").filter("chars > 0").distinct()


def residue_ids(docs: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(id) of the records that consist for at least half of residue; null, empty and blank texts are not among them."""
    shares = residue_shares(docs, id_col, text_col)
    return shares.filter(F.col("residue_chars") >= F.col("chars") * MIN_COVERAGE).select("id").distinct()


def without_residue(docs: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """``docs`` without those records; all columns pass through."""
    rows = docs.select(packed(docs), F.col(id_col).alias("id"))
    return rows.join(residue_ids(docs, id_col, text_col), "id", "left_anti").select("row.*")
