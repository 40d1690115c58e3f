"""Problem 9: documents of several sources mixed to target shares of the tokens.

Method: min-cost flow. Documents are aggregated by membership pattern, the set of sources they belong to; each pattern's
tokens are routed to the quotas of its sources, the first use of a document at no cost and each further use dearer
(convex repetition costs). Documents are then selected in a seeded order until the routed tokens are reached.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators.ranking import distributed_running_sum
from tidewire.runtime import broadcast_if_small, staged

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[int, object] = {}


def _encoder(ranks: bytes):  # noqa: ANN202
    """The tokenizer of a ranks file, once for each worker."""
    import tiktoken

    key = hash(ranks)
    if key not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encoders[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, text_col: str = "text") -> DataFrame:
    """``docs`` without its text and with ``tokens``, by a public tokenizer's ranks file; null and empty texts have 0."""
    held = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoder(held.value).encode_ordinary
        for batch in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in batch], dtype="int64")

    return docs.withColumn("tokens", F.pandas_udf(count, "long")(F.col(text_col))).drop(text_col)


class _Network:
    """A directed graph with capacities; flows grow by Dinic's blocking flows, all loops without recursion."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to = array("q")  # eight bytes an arc, as there may be many sets of sources
        self.room = array("q")

    def arc(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def _levels(self, start: int) -> list[int]:
        level = [-1] * len(self.out)
        level[start] = 0
        front = [start]
        for x in front:  # grows while it is read
            for e in self.out[x]:
                if self.room[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    front.append(self.to[e])
        return level

    def push(self, start: int, sink: int) -> int:
        """Send as much as fits on top of what flows already."""
        sent = 0
        while (level := self._levels(start))[sink] >= 0:
            at = [0] * len(self.out)
            path: list[int] = []
            x = start
            while True:
                if x == sink:
                    amount = min(self.room[e] for e in path)
                    sent += amount
                    for e in path:
                        self.room[e] -= amount
                        self.room[e ^ 1] += amount
                    path, x = [], start
                    continue
                while at[x] < len(self.out[x]):
                    e = self.out[x][at[x]]
                    if self.room[e] > 0 and level[self.to[e]] == level[x] + 1:
                        break
                    at[x] += 1
                if at[x] < len(self.out[x]):
                    path.append(self.out[x][at[x]])
                    x = self.to[path[-1]]
                elif path:  # a dead end: step back and try the next arc
                    x = self.to[path.pop() ^ 1]
                    at[x] += 1
                else:
                    break
        return sent


def routed(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: dict[str, int]) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens of each pattern that go to each of its sources: a flow of the most tokens at the least repetition cost.

    ``patterns`` has the tokens of each set of sources, ``quotas`` the tokens wanted, ``repeats`` how often a document may
    be used for a source. Costs stand only on the uses of a pattern, the first free and each further one dearer, and what
    can be routed forms a polymatroid; so the cheapest flow is found greedily: the first uses of all patterns are routed
    as far as they go, then the second ones on top of that, and so on. Ties go to what sorts first.
    """
    names = sorted(quotas)
    sets = sorted(p for p, t in patterns.items() if t > 0)
    start, sink = 0, 1 + len(sets) + len(names)
    net = _Network(sink + 1)
    at = {s: 1 + len(sets) + i for i, s in enumerate(names)}
    links: dict[int, tuple[tuple[str, ...], str]] = {}
    most = []
    for i, p in enumerate(sets):
        members = [s for s in p if s in at]
        most.append(max((repeats[s] for s in members), default=0))
        for s in members:
            links[net.arc(1 + i, at[s], patterns[p] * repeats[s])] = (p, s)
    for s in names:
        net.arc(at[s], sink, quotas[s])
    for use in range(max(most, default=0)):
        for i, p in enumerate(sets):
            if use < most[i]:
                net.arc(start, 1 + i, patterns[p])
        net.push(start, sink)
    return {link: net.room[e ^ 1] for e, link in links.items() if net.room[e ^ 1] > 0}


def reachable_total(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int]) -> int:
    """The largest total at which all sources that have documents reach their shares together; 0 without any.

    What each source could reach by itself bounds it; where sources overlap, the total is halved in to a thousandth.
    """
    most = {s: repeats[s] * sum(t for p, t in patterns.items() if s in p) for s in shares}
    live = {s: x for s, x in shares.items() if most[s] > 0 and x > 0}

    def fits(total: int) -> bool:
        quotas = {s: int(total * x) for s, x in live.items()}
        return sum(routed(patterns, quotas, repeats).values()) == sum(quotas.values())

    low, high = 0, int(min((most[s] / x for s, x in live.items()), default=0))
    if fits(high):
        return high
    while high - low > max(1, low // 1000):
        middle = (low + high) // 2
        low, high = (middle, high) if fits(middle) else (low, middle)
    return low


def mixed(
    docs: DataFrame, targets: DataFrame, seed: int = 7, total_tokens: int | None = None, tokenizer: str = TOKENIZER, source_col: str = "source", text_col: str = "text",
    most_patterns: int | None = None,
) -> DataFrame:
    """(doc_id, source, repeats, tokens): the documents to use, how often for which source, and their tokens each.

    ``targets`` has source, target_share and max_repeats; ``source_col`` is a string or an array of strings. Without
    ``total_tokens`` the mix is as large as the targets of all sources that have documents allow. A target that cannot be
    met gets all its documents max_repeats times. Documents of no target source, without text, or without id are left
    out; their texts are never tokenised. A source listed twice takes the smaller share and repeats.

    Only the tokens of each pattern come to the driver, and the flow is solved over all sets of sources, however many there
    are; ``most_patterns`` is taken for callers that name it and changes nothing. The running sums that select documents are taken over range
    partitions, so a source with a third of all rows never meets in one task.
    """
    wanted = {r.source: (r.share, r.repeats) for r in targets.filter("source IS NOT NULL").groupBy("source").agg(F.min("target_share").alias("share"), F.min("max_repeats").alias("repeats")).collect()}
    shares = {s: float(v[0] or 0) for s, v in wanted.items()}
    repeats = {s: max(0, int(v[1] or 0)) for s, v in wanted.items()}
    names = F.array(*[F.lit(s) for s in sorted(wanted)]).cast("array<string>")
    of = F.col(source_col) if dict(docs.dtypes)[source_col].startswith("array") else F.array(source_col)
    members = F.array_sort(F.array_intersect(names, of))
    mine = docs.filter(F.col("doc_id").isNotNull() & (F.col(text_col) != "")).select("doc_id", members.alias("pattern"), F.col(text_col).alias("text"))
    sized = token_counts(mine.filter(F.size("pattern") > 0), tokenizer, "text").filter("tokens > 0")
    sized = staged(sized.dropDuplicates(["doc_id"]), "sized")
    sums = sized.groupBy("pattern").agg(F.sum("tokens").alias("tokens"))
    patterns = {tuple(r.pattern): r.tokens for r in sums.toLocalIterator()}
    total = reachable_total(patterns, shares, repeats) if total_tokens is None else total_tokens
    flow = routed(patterns, {s: int(total * x) for s, x in shares.items()}, repeats)

    # each pattern's uses lie on a line of tokens, round after round in seeded order; a source owns a stretch of it
    stretches = []
    for p in sorted(patterns):
        done = 0
        for s in p:
            if (n := flow.get((p, s), 0)) > 0:
                stretches.append((list(p), s, done, done + n, patterns[p]))
                done += n
    spark = docs.sparkSession
    plan = spark.createDataFrame(stretches, "pattern array<string>, source string, lo long, hi long, of long")
    order = [F.xxhash64(F.lit(seed), "doc_id").asc(), F.col("doc_id").asc()]
    line = distributed_running_sum(sized.withColumn("_p", F.array_join("pattern", "\u0001")), ["_p"], order, F.col("tokens"), "upto")
    plan = plan.withColumn("_p", F.array_join("pattern", "\u0001")).drop("pattern")
    placed = line.join(broadcast_if_small(plan, 400), "_p")
    # uses of a document in a stretch: rounds r with lo <= r * of + middle < hi, the middle standing for the whole document
    middle = F.col("upto") - F.col("tokens") + F.floor(F.col("tokens") / 2)
    upper = F.ceil((F.col("hi") - middle) / F.col("of"))
    lower = F.ceil((F.col("lo") - middle) / F.col("of"))
    uses = F.greatest(upper, F.lit(0)) - F.greatest(lower, F.lit(0))
    out = placed.select("doc_id", "source", uses.cast("int").alias("repeats"), "tokens")
    return out.filter("repeats > 0")


def shares_reached(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, tokens, share) for every target; ``mix`` comes from ``mixed``."""
    sums = mix.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("repeats") * F.col("tokens")).alias("tokens"))
    sums = staged(sums, "mix_sums")  # one row for each target
    whole = sums.agg(F.sum("tokens").alias("whole"))
    joined = targets.join(broadcast_if_small(sums, 80), "source", "left").join(F.broadcast(whole))
    n = F.coalesce("tokens", F.lit(0))
    return joined.select("source", "target_share", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), n.alias("tokens"), F.round(n / F.col("whole"), 6).alias("share"))
