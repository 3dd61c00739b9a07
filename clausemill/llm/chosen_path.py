"""MinHash near-dedup by a chosen-path set similarity join (operator 8).

A document is its set of distinct five-word shingles. Equal sets are put together first. Every set gets minwise
tokens, and independent trees branch the sets: a node picks some of the token positions by its own randomness, one
on average for a pair at the threshold, and each set goes to the children named by its tokens there. Nodes of at
most ``NODE_ROWS`` sets are compared exhaustively by their tokens, larger ones branch again. Similar sets share a
small node in some tree with a probability that the number of trees brings near one.

Pairs whose tokens agree often enough are candidates, and every link is confirmed on full sets. Only links that
join components matter: links to a common member of each set's most populous node are confirmed first, and nodes that then hold
one component are dropped. Next a tree of candidates per small node is confirmed; then nodes that still hold several
components are compared on full sets and return the links that join them. Groups of near copies that no branching can divide are
joined by links to a common member; members that are not linked to it are compared with all others of the node, in
blocks. So nothing is capped and no group is expanded into all its pairs.

Words are split by white space, A-Z are lower-cased. A document with fewer than five words has its whole sequence
as one shingle; without words it has an empty set, linked with nothing. Rows without an id have no component and are
kept. Texts of one id belong together, as if they were linked: their rows share a component and what happens to it. Of
rows that repeat an id and its text, ``dedup`` leaves one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clausemill.llm.common import stored
from clausemill.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 85
TOKENS = 128
TREES = 10
NODE_ROWS = 300
MAX_DEPTH = 6
TASK_PAIRS = 20_000_000  # pairs of sets that a task compares by their tokens
BROADCAST_IDS = 4_000_000  # ids that are broadcast to find their texts; for more, all texts are shuffled
ERRORS = 5  # standard errors below the threshold down to which tokens make a candidate

_T = PERCENT / 100
AGREE = int((_T - ERRORS * (_T * (1 - _T) / TOKENS) ** 0.5) * TOKENS)  # tokens of TOKENS
_SLICE = 1 << 20
_GOLDEN, _MIX_A, _MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(2 * _SLICE, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Hashes of words and shingles, worked out for slices of texts at a time."""

    def __init__(self):
        self.power, self.inverse = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
        order = np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)
        self.places = _mixed(order * _GOLDEN) | np.uint64(1)

    def _words(self, text: bytes) -> np.ndarray:
        code = np.frombuffer(text, dtype=np.uint8)
        inside = np.concatenate([[False], _IS_WORD[code], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        n = len(code)
        if n > len(self.power):  # a word of over a million bytes
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, dtype=np.uint64)]), dtype=np.uint64)
            back = np.uint64(pow(_BASE, -1, 1 << 64))
            inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, back, dtype=np.uint64)]), dtype=np.uint64)
        else:
            power, inverse = self.power, self.inverse
        sums = np.concatenate([[np.uint64(0)], np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)])
        plain = (sums[ends] - sums[starts]) * inverse[starts]
        return _mixed(plain + (ends - starts).astype(np.uint64) * _GOLDEN)

    def words(self, text: str) -> np.ndarray:
        """A hash for every word."""
        raw = text.encode().translate(_LOWER)
        if len(raw) <= _SLICE:
            return self._words(raw)
        parts, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + _SLICE)
            while end < len(raw) and _IS_WORD[raw[end]]:
                end += 1
            parts.append(self._words(raw[at:end]))
            at = end
        return np.concatenate(parts)

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles of a text."""
        words = self.words(text or "")
        if len(words) == 0:
            return words
        n = min(len(words), SHINGLE_WORDS)
        many = len(words) - n + 1
        sums = np.full(many, n, dtype=np.uint64)
        for k in range(n):
            sums += words[k : k + many] * self.places[k]
        return np.unique(_mixed(sums))


class Tokens:
    """Minwise tokens of sets."""

    def __init__(self):
        x = np.arange(1, TOKENS + 1, dtype=np.uint64)
        self.shift = _mixed(x * _GOLDEN)
        self.factor = _mixed(x * _MIX_A) | np.uint64(1)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            part = (shingles[at : at + 2048, None] ^ self.shift) * self.factor
            np.minimum(least, part.min(axis=0), out=least)
        return _mixed(least).astype(np.uint32)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler, tokens = Shingler(), Tokens()
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in batch["text"]:
            shingles = shingler.shingles(text)
            sizes.append(len(shingles))
            digests.append(_digest(shingles) if len(shingles) else None)
            sketches.append(tokens.of(shingles).tobytes() if len(shingles) else None)
        short = [None if x is None else np.frombuffer(x, dtype=np.uint32).astype(np.uint8).tobytes() for x in sketches]
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "n_shingles": sizes, "digest": digests, "tokens": sketches, "short": short}
        )


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets of classes; an id may have other texts, whose digests differ from that of the class."""
    shingler = Shingler()
    for batch in batches:
        sets = [shingler.shingles(text) for text in batch["text"]]
        own = [_digest(x) == digest for x, digest in zip(sets, batch["digest"], strict=True)]
        yield pd.DataFrame({"id": batch["id"][own], "shingles": [x.view(np.int64) for x, is_own in zip(sets, own, strict=True) if is_own]})


def _matrix(tokens: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(tokens), dtype=np.uint32).reshape(-1, TOKENS)


def _chosen(node: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For nodes, the positions they branch on: one each, and a second one for so many that 1 / threshold is the mean."""
    first = (_mixed(node + _GOLDEN) % np.uint64(TOKENS)).astype(np.int64)
    draw = _mixed(_mixed(node) + _GOLDEN)
    second = (first + 1 + (draw >> np.uint64(32)).astype(np.int64) % (TOKENS - 1)) % TOKENS
    also = (draw & np.uint64(0xFFFF)) < np.uint64(int((1 / _T - 1) * 65536))
    return [(np.ones(len(node), dtype=bool), first), (also, second)]


def _child(node: np.ndarray, position: np.ndarray, token: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(node ^ (position.astype(np.uint64) * _GOLDEN)) + token.astype(np.uint64) * _MIX_B)


def _rooted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if batch.empty:
            continue
        tokens, ids = _matrix(batch["tokens"]), batch["id"].to_numpy()
        nodes, members = [], []
        for tree in range(TREES):
            root = np.full(len(ids), tree + 1, dtype=np.uint64)
            for holds, position in _chosen(_mixed(root)):
                nodes.append(_child(root, position, tokens[np.arange(len(ids)), position])[holds])
                members.append(ids[holds])
        yield pd.DataFrame({"node": np.concatenate(nodes).view(np.int64), "id": np.concatenate(members)})


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tokens in common, for all pairs of rows."""
    out = np.zeros((len(a), len(b)), dtype=np.int16)
    ones = np.uint64(0x0101010101010101)
    for at in range(0, len(a), 64):
        same = (a[at : at + 64, None, :] == b[None, :, :]).view(np.uint64)  # eight tokens to a number, a byte each
        out[at : at + 64] = (same.sum(axis=2) * ones) >> np.uint64(56)
    return out


def _starred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of members of large nodes with the node's common member, where tokens agree."""
    for batch in batches:
        if batch.empty:
            continue
        ids, others = batch["id"].to_numpy(), batch["common"].to_numpy()
        close = ((_matrix(batch["tokens"]) == _matrix(batch["common_tokens"])).sum(axis=1) >= AGREE) & (ids != others)
        yield _pairs(ids[close], others[close])


def _branched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Children of members of large nodes."""
    for batch in batches:
        if batch.empty:
            continue
        tokens, ids = _matrix(batch["tokens"]), batch["id"].to_numpy()
        node = batch["node"].to_numpy().view(np.uint64)
        children, members = [], []
        for holds, position in _chosen(node):
            children.append(_child(node, position, tokens[np.arange(len(ids)), position])[holds])
            members.append(ids[holds])
        yield pd.DataFrame({"node": np.concatenate(children).view(np.int64), "id": np.concatenate(members)})


_PAIR = "a long, b long"
_MEMBER = ("node", "id", "component", "asks", "shingles")


def _pairs(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(a, b).astype(np.int64), "b": np.maximum(a, b).astype(np.int64)})


def _by_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of whole nodes, of rows sorted by node. A small node has at most ``NODE_ROWS`` rows, so little is held back."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        nodes = batch["node"].to_numpy()
        cut = int(np.searchsorted(nodes, nodes[-1]))  # the last node may go on in the next batch
        if cut:
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held = [batch.iloc[cut:]]
        elif held and held[0]["node"].iloc[0] != nodes[0]:
            yield pd.concat(held, ignore_index=True)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def _bounds(nodes: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(nodes)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(nodes)], strict=True)


def _spanning(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For every node a forest of candidate pairs, grown from the smallest ids breadth first."""
    for rows in _by_node(batches):
        rows = rows.sort_values(["node", "id"])
        ids = rows["id"].to_numpy()
        tokens = np.frombuffer(b"".join(rows["short"]), dtype=np.uint8).reshape(-1, TOKENS)
        found = [_forest(ids[a:b], tokens[a:b]) for a, b in _bounds(rows["node"].to_numpy())]
        pairs = np.array([pair for forest in found for pair in forest], dtype=np.int64).reshape(-1, 2)
        yield _pairs(pairs[:, 0], pairs[:, 1])


def _forest(ids: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
    close = _agreeing(tokens, tokens) >= AGREE
    if int(close.sum()) == len(ids):  # each set agrees with itself alone
        return []
    left, pairs = np.ones(len(ids), dtype=bool), []
    for root in range(len(ids)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop(0)
            near = np.flatnonzero(close[at] & left)
            left[near] = False
            pairs += [(ids[at], other) for other in ids[near].tolist()]
            queue += near.tolist()
    return pairs


def _common(asking: list[np.ndarray], all_: list[np.ndarray]) -> np.ndarray:
    """Shingles in common, for all pairs of two lists of sets; the second list holds the first."""
    values, place, counts = np.unique(np.concatenate(all_), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    shared[counts < 2] = -1
    width = int(shared.max(initial=-1)) + 1
    column = shared[place]
    row = np.repeat(np.arange(len(all_)), [len(x) for x in all_])
    asked = [np.searchsorted(values, x) for x in asking]
    asked_row = np.repeat(np.arange(len(asking)), [len(x) for x in asking])
    asked_column = shared[np.concatenate(asked)]
    out = np.zeros((len(asking), len(all_)), dtype=np.float32)
    for at in range(0, width, 4096):
        left, right = (np.zeros((n, min(4096, width - at)), dtype=np.float32) for n in (len(asking), len(all_)))
        inside = (column >= at) & (column < at + 4096)
        right[row[inside], column[inside] - at] = 1
        inside = (asked_column >= at) & (asked_column < at + 4096)
        left[asked_row[inside], asked_column[inside] - at] = 1
        out += left @ right.T
    return out.astype(np.int64)


def _across(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a node, or of a block of one, that join its components: as many as it takes; ``asks`` marks one side."""
    asking = rows[rows["asks"]]
    found: list[tuple[int, int]] = []
    if not asking.empty and rows["component"].nunique() > 1:
        a_sets, b_sets = list(asking["shingles"]), list(rows["shingles"])
        a_size, b_size = (np.array([len(x) for x in sets]) for sets in (a_sets, b_sets))
        common = _common(a_sets, b_sets)
        linked = common * 100 >= (a_size[:, None] + b_size[None, :] - common) * PERCENT
        a_parts, b_parts = asking["component"].to_numpy(), rows["component"].to_numpy()
        linked &= a_parts[:, None] != b_parts[None, :]
        a_ids, b_ids = asking["id"].to_numpy(), rows["id"].to_numpy()
        head: dict[int, int] = {}

        def part(x: int) -> int:
            while x in head:
                x = head[x]
            return x

        for i, j in zip(*np.nonzero(linked), strict=True):
            x, y = part(a_parts[i]), part(b_parts[j])
            if x != y:
                head[max(x, y)] = min(x, y)
                found.append((a_ids[i], b_ids[j]))
    return _pairs(*(np.array([f[k] for f in found], dtype=np.int64) for k in (0, 1)))


def _across_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``_across`` for rows sorted by node."""
    for rows in _by_node(batches):
        for a, b in _bounds(rows["node"].to_numpy()):
            yield _across(rows.iloc[a:b])


def sketches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles``, a digest of the set, its minwise tokens and their last bytes, as a written table."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = "doc_id long, n_shingles long, digest binary, tokens binary, short binary"
    return stored(docs.sparkSession, rows.mapInPandas(_sketched, kind), "sketches")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common: Column = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * PERCENT).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row's ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable) and ``kept``."""
    spark = docs.sparkSession
    rows = sketches(docs, text, doc_id)
    known = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # Equal sets are a class; its number is the id by which it is joined, and its smallest document holds its text.
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(spark, classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    tokens = known.select("doc_id", "digest", "tokens", "short").join(classes, ["doc_id", "digest"])
    tokens = stored(spark, tokens.dropDuplicates(["id"]).select("id", "tokens", "short"), "tokens")
    short, tokens = tokens.select("id", "short"), tokens.select("id", "tokens")
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = stored(spark, repeated, "repeated-ids")
    ids_repeat = not repeated.isEmpty()

    def counted(members: DataFrame) -> DataFrame:
        """Members of nodes that hold two sets or more, with their number and a common member."""
        of_node = F.min(F.struct(F.xxhash64("id", "node").alias("h"), F.col("id").alias("id")))["id"]
        nodes = members.groupBy("node").agg(F.count("*").alias("n"), of_node.alias("common")).where("n > 1")
        return stored(spark, members.join(nodes, "node"), "nodes")

    def sets_of(ids: DataFrame) -> DataFrame:
        texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        wanted = stored(spark, classes.join(ids, "id", "left_semi"), "wanted")
        # A part of the texts is asked for; the others stay out of the join, which may have to shuffle.
        if wanted.count() <= BROADCAST_IDS:
            texts = texts.join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi")
        found = texts.join(wanted, "doc_id").mapInPandas(_sets, "id long, shingles array<long>")
        return found.dropDuplicates(["id"]) if ids_repeat else found  # without repeated ids each class is found once

    links = spark.createDataFrame([], _PAIR)
    labels = spark.createDataFrame([], "id long, component long")
    if ids_repeat:
        own = known.select("doc_id", "digest").join(repeated, "doc_id").join(classes.select("digest", "id"), "digest")
        own = stored(spark, own.select("doc_id", "id").distinct(), "classes-of-repeated-ids")
        first = own.groupBy("doc_id").agg(F.min("id").alias("a"))
        links = own.join(first, "doc_id").where("id > a").select("a", F.col("id").alias("b")).distinct()
        links = stored(spark, links, "links")
        labels = components(links)
    sets = spark.createDataFrame([], "id long, shingles array<long>")

    def with_sets(ids: DataFrame) -> DataFrame:
        """The sets known so far and those of more ids."""
        return sets.unionByName(stored(spark, sets_of(ids.join(sets.select("id"), "id", "left_anti")), "sets"))

    def labelled(members: DataFrame) -> DataFrame:
        return members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def mixed(members: DataFrame) -> DataFrame:
        """Members of nodes that hold several components; the others have no link left that would join any."""
        held = labelled(members).groupBy("node").agg(F.min("component").alias("c"), F.max("component").alias("d"))
        return members.join(held.where("c <> d").select("node"), "node", "left_semi")

    def confirm(candidates: DataFrame) -> None:
        """Confirm candidate pairs on full sets; the components grow by them."""
        nonlocal sets, links, labels
        candidates = stored(spark, candidates.distinct(), "pairs")
        if candidates.isEmpty():
            return
        sets = with_sets(stored(spark, _ends(candidates), "involved"))
        links = links.unionByName(stored(spark, _confirmed(candidates, sets), "links"))
        labels = components(links)

    def stars(members: DataFrame) -> DataFrame:
        commons = members.select("common").distinct().join(tokens.withColumnRenamed("id", "common"), "common")
        commons = stored(spark, commons.withColumnRenamed("tokens", "common_tokens"), "common-members")
        starred = members.select("id", "common").distinct().join(tokens, "id").join(commons, "common")
        return starred.mapInPandas(_starred, _PAIR)

    # Links to the common member of each set's most populous node come first: they join groups of near copies, whose
    # nodes then hold one component and need no branching. Links to other common members are confirmed with the forests.
    level, small, starred = counted(tokens.mapInPandas(_rooted, "node long, id long")), [], []
    fullest = level.where(f"n > {NODE_ROWS}").groupBy("id").agg(F.max(F.struct("n", "node", "common")).alias("f"))
    confirm(stars(fullest.select("id", "f.common")))
    for _ in range(MAX_DEPTH):
        small.append(level.where(f"n <= {NODE_ROWS}"))
        large = stored(spark, mixed(level.where(f"n > {NODE_ROWS}")), "large-nodes")
        if large.isEmpty():
            large = None
            break
        starred.append(stored(spark, stars(large), "stars"))
        step = stored(spark, large.select("node", "id").join(tokens, "id").mapInPandas(_branched, "node long, id long"), "branches")
        level = counted(step)
    else:
        # The last level is the end of branching; what is still large there is settled below, in blocks.
        small.append(level.where(f"n <= {NODE_ROWS}"))
        large = stored(spark, mixed(level.where(f"n > {NODE_ROWS}")), "large-nodes")
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.unionByName(more)
    nodes = stored(spark, mixed(nodes.select("node", "id", "n")), "small-nodes")

    # Round one: a forest of each small node. Nodes are dealt by the work they make, not by their few bytes.
    work = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # each of n members meets n others
    dealt = max(int(work // TASK_PAIRS) + 1, 4 * spark.sparkContext.defaultParallelism)

    def in_nodes(members: DataFrame) -> DataFrame:
        return members.repartition(dealt, "node").sortWithinPartitions("node")

    forest = in_nodes(nodes.select("node", "id").join(short, "id")).mapInPandas(_spanning, _PAIR)
    for more in starred:
        forest = forest.unionByName(more)
    confirm(forest)
    involved = sets.select("id")

    # Round two: what else joins components. A set without any candidate in round one has none in small nodes.
    rest = labelled(mixed(nodes.select("node", "id").join(involved, "id", "left_semi")))
    rest = rest.join(sets, "id").withColumn("asks", F.lit(True))
    second = in_nodes(rest.select(*_MEMBER)).mapInPandas(_across_nodes, _PAIR)
    if large is not None and not large.isEmpty():
        members = stored(spark, _undivided(labelled(large), labels), "undivided")
        if not members.isEmpty():
            sets = with_sets(members.select("id").distinct())
            blocks = members.join(sets, "id").select(*_MEMBER, "block", "ask_block")
            second = second.unionByName(blocks.groupBy("node", "block", "ask_block").applyInPandas(_across, _PAIR))
    second = stored(spark, second.distinct(), "links")
    if not second.isEmpty():
        labels = components(links.unionByName(second))
    of_class = classes.join(labels, "id", "left").select("digest", "doc_id", F.coalesce("component", "id").alias("component"))
    of_class = stored(spark, of_class, "components")
    smallest = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = stored(spark, of_class.select("digest", "component").join(smallest, "component").drop("component"), "components")
    narrow = rows.select("doc_id", "n_shingles", "digest")
    out = narrow.join(of_class, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _undivided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of large nodes in blocks; those outside the common member's component ask all blocks of the node."""
    of_common = labels.select(F.col("id").alias("common"), F.col("component").alias("common_component"))
    members = members.join(of_common, "common", "left")
    members = members.withColumn("apart", F.col("component") != F.coalesce("common_component", "common"))
    apart = members.where("apart").groupBy("node").agg(F.ceil(F.count("*") / NODE_ROWS).cast("int").alias("ask_blocks"))
    members = members.join(apart, "node").withColumn("blocks", F.ceil(F.col("n") / NODE_ROWS).cast("int"))

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    columns = ["node", "id", "component"]
    held = members.select(*columns, F.lit(False).alias("asks"), own("blocks").alias("block"), every("ask_blocks").alias("ask_block"))
    asked = members.where("apart").select(
        *columns, F.lit(True).alias("asks"), every("blocks").alias("block"), own("ask_blocks").alias("ask_block")
    )
    return held.unionByName(asked)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, in the columns they came with."""
    gone = link(docs, text, doc_id).where("NOT kept").select(F.col("doc_id").alias("gone"))
    gone = stored(docs.sparkSession, gone.distinct(), "near-copies")
    left = docs.join(gone, docs[doc_id].cast("long") == gone["gone"], "left_anti")
    # Only rows whose id repeats are ranked; the others are not shuffled.
    repeated = docs.groupBy(docs[doc_id].cast("long").alias("again")).agg(F.count("*").alias("times"))
    repeated = stored(docs.sparkSession, repeated.where("again IS NOT NULL AND times > 1").select("again"), "repeated-ids")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, left[doc_id].cast("long") == repeated["again"], "left_anti")
    rows = left.join(repeated, left[doc_id].cast("long") == repeated["again"], "left_semi").select(F.struct("*").alias("row"))
    same = Window.partitionBy(F.col("row")[doc_id], F.col("row")[text]).orderBy(F.xxhash64(F.to_json("row")))
    rows = rows.withColumn("at", F.row_number().over(same)).where("at = 1").select("row.*")
    return once.unionByName(rows)
