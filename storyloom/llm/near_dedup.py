"""MinHash near-duplicates by bottom-k sketches of one hash function.

1. Every whole text becomes a set of 64-bit shingle hashes and the K smallest of them, its sketch.  Texts with
   equal sets form a class; only the class representative goes on.
2. Inverted lists of retained values: value -> representatives.  The values of a sketch are ordered by (list
   length, value), an order common to all.  Two sets at the threshold share at least `need` values of their
   sketches, so they meet among the first size - need + 1 of that order, and only those are listed: a very frequent
   value is listed only where a document has nothing rarer.  No list is capped.
3. Lists are read as sorted streams.  Within a list the union sketch (K smallest of both) estimates the similarity
   of its members; the members that may be linked are joined, and a task gives out only a spanning forest of what it
   joined.  The connected parts of all forests are neighbourhoods: every link lies within one.
4. The full sets of a neighbourhood meet in one task, which confirms links exactly and again gives out a forest.
   Neighbourhoods beyond BLOCK members are dealt to blocks in two ways, which finds most links; then every member
   outside the neighbourhood's largest component visits all blocks, so no link is lost.

Pairs exist within a task only, as arrays; what is written or shuffled is linear in the lists and the members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT, discard, materialize, partitions, skewed_join, small_batches, text_bytes
from .components import connected_components

K = 48
#: Percent of a union sketch that must agree at a similarity of 80 percent (scaled for others); a pair at exactly
#: the threshold falls below with a chance of 3e-8.
FLOOR = 45
#: Lists up to this length are estimated pair by pair, all at once; longer ones by search through an index.
SHORT = 64
#: A list beyond this length is one neighbourhood as far as sizes fit, without estimates.
WIDE = 20_000
#: Members and shingles of a block of a neighbourhood.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Pairs estimated at once.
PAIRS = 16_384
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_WORDS_KEPT = 400_000
_EDGES = "a bigint, b bigint"


class ShingleHasher:
    """Whole text (UTF-8 bytes) -> sorted distinct 64-bit hashes of its word shingles; A-Z count as a-z."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > _WORDS_KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(h))
        out = h[: len(h) - width + 1].copy()
        for i in range(1, width):
            out = self._mix(out * _MULT + h[i : len(h) - width + 1 + i])
        return np.unique(self._mix(out + np.uint64(width)))

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def sketches(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """doc_id, n_shingles, digest (binary, null for the empty set), sketch (its k smallest hashes), tops (their upper halves, packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        for b in batches:
            sizes, digests, values, ends, tops = [], [], [], [0], []
            for t in b.column("text").to_pylist():
                s = hasher(t)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                values.append(s[:k].view(np.int64))
                tops.append((s[:k] >> np.uint64(32)).astype(np.uint32).tobytes())
                ends.append(ends[-1] + len(values[-1]))
            flat = np.concatenate(values) if values else np.empty(0, np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), sketch, pa.array(tops, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "sketch", "tops"],
            )

    small_batches(docs.sparkSession)
    return text_bytes(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, sketch array<bigint>, tops binary")


def floor_percent(percent: int) -> int:
    return FLOOR * percent // 80


def inverted_lists(reps: DataFrame, percent: int, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(value, rep, class) rows, each a value that a representative lists; (value, size) of lists of two or more.

    A set that is whole in its sketch, as all partners' are, needs the threshold's share of its own size in common;
    of others half of the sketch, as far as the estimate goes.  Sets too small to have any partner list nothing.
    """
    n, s = F.col("n"), F.size("sketch")
    own = F.expr(f"(n * {percent} + 99) div 100")
    need = F.when(F.expr(f"n * 100 div {percent} <= {k}"), own).otherwise(F.expr(f"(size(sketch) * {floor_percent(percent)} + 99) div 100"))
    flat = reps.filter(F.expr(f"n * 100 div {percent} > n") | (own < n)).select("rep", "class", s.alias("s"), need.alias("need"), F.explode("sketch").alias("value"))
    often = materialize(flat.groupBy("value").agg(F.count("*").alias("c")).filter("c > 1"), "often")
    shared = skewed_join(flat, often, "value", "c").groupBy("rep", "class", "need").agg(F.sort_array(F.collect_list(F.struct("c", "value"))).alias("v"))
    # values that no other sketch retains come first in the order and can give no pair
    room = F.expr("size(v) - need + 1").cast("int")
    listed = shared.filter(room > 0).select("rep", "class", F.explode(F.slice("v.value", F.lit(1), room)).alias("value"))
    listed = materialize(listed, "listed")
    sizes = materialize(listed.groupBy("value").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    discard(often)
    return listed, sizes


class Forest:
    """Union-find over ids; gives out one edge (id, root) for each id that was joined with another."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up[x]
        return top

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> pa.RecordBatch:
        ids = [i for i, y in self.up.items() if i != y]
        return pa.RecordBatch.from_arrays([pa.array([self.root(i) for i in ids], pa.int64()), pa.array(ids, pa.int64())], names=["a", "b"])


def spanning(sets: list[np.ndarray], linked: Callable[[np.ndarray, int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links (i, j) that connect what all linked pairs of sets connect.

    linked(common, size, sizes): which of several intersections with a set of that size are links.  Breadth-first
    from each set through an inverted index; sets already reached leave the index, so dense groups cost little.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(codes, kind="stable")
    listed, holders = codes[order], owner[order]
    own = np.split(codes, np.cumsum(sizes)[:-1])
    alive = np.ones(m, bool)
    indexed = left = m
    counts = np.bincount(listed, minlength=len(values))
    ends = np.cumsum(counts)
    for start in range(m):
        if not alive[start]:
            continue
        alive[start] = False
        left -= 1
        todo = [start]
        while todo and left:
            if 2 * left < indexed:
                keep = alive[holders]
                listed, holders, indexed = listed[keep], holders[keep], left
                counts = np.bincount(listed, minlength=len(values))
                ends = np.cumsum(counts)
            i = todo.pop()
            runs = counts[own[i]]
            at = np.repeat(ends[own[i]] - np.cumsum(runs), runs) + np.arange(runs.sum())
            common = np.bincount(holders[at], minlength=m)
            for j in np.flatnonzero(alive & (common > 0) & linked(common, int(sizes[i]), sizes)).tolist():
                alive[j] = False
                left -= 1
                todo.append(j)
                yield i, j


def exactly(percent: int) -> Callable[[np.ndarray, int, np.ndarray], np.ndarray]:
    return lambda common, size, sizes: 100 * common >= percent * (size + sizes - common)


class ListJoiner:
    """Joins the members of inverted lists that the union sketch estimates as near enough."""

    def __init__(self, percent: int, k: int = K):
        self.percent, self.floor, self.k, self.forest = percent, floor_percent(percent), k, Forest()

    def short(self, starts: np.ndarray, lengths: np.ndarray, reps: list[int], n: np.ndarray, tops: list[bytes]) -> None:
        """Several lists at once, laid end to end: all pairs whose sizes fit and that are not joined yet."""
        ends = np.repeat(starts + lengths, lengths)
        after = ends - np.arange(len(ends)) - 1
        i = np.repeat(np.arange(len(ends)), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        roots = np.array([self.forest.root(r) for r in reps], np.int64)
        fits = (roots[i] != roots[j]) & (self.percent * np.maximum(n[i], n[j]) <= 100 * np.minimum(n[i], n[j]))
        i, j = i[fits], j[fits]
        rows = np.full((len(tops), self.k), 0xFFFFFFFF, np.uint32)
        size = np.array([len(t) // 4 for t in tops])
        for r, t in enumerate(tops):
            rows[r, : len(t) // 4] = np.frombuffer(t, np.uint32)
        for at in range(0, len(i), PAIRS):
            a, b = i[at : at + PAIRS], j[at : at + PAIRS]
            near = self.estimate(rows[a], rows[b], size[a], size[b])
            for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                self.forest.join(reps[x], reps[y])

    def estimate(self, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        """Which pairs of sketches reach the floor among the k smallest of their union (all of it, where both are whole)."""
        both = np.sort(np.concatenate([x, y], axis=1), axis=1)
        same = (both[:, 1:] == both[:, :-1]) & (np.arange(2 * self.k - 1) < (nx + ny - 1)[:, None])
        before = np.cumsum(same, axis=1, dtype=np.int16) - same
        union = nx + ny - same.sum(axis=1)
        seen = np.where((nx < self.k) & (ny < self.k), union, np.minimum(union, self.k))
        hits = (same & (np.arange(2 * self.k - 1) - before < seen[:, None])).sum(axis=1)
        return 100 * hits >= self.floor * seen

    def long(self, reps: list[int], n: np.ndarray, tops: list[bytes]) -> None:
        """One list, by search through an index of its sketches; common values stand for the hits, which are no more."""
        sets = [np.frombuffer(t, np.uint32) for t in tops]
        near = lambda common, size, sizes: 100 * common >= self.floor * np.minimum(self.k, size + sizes - common)
        for i, j in spanning(sets, near):
            self.forest.join(reps[i], reps[j])

    def wide(self, reps: list[int], n: np.ndarray, pivots: dict[int, int]) -> None:
        """Part of a list beyond WIDE: members whose sizes may fit are joined, through one pivot of each size class."""
        for r, level in zip(reps, size_class(n).tolist(), strict=True):
            pivot = pivots.setdefault(level, r)
            self.forest.join(r, pivot)
            for other in (level - 1, level + 1):
                if other in pivots:
                    self.forest.join(pivot, pivots[other])


def size_class(n: np.ndarray) -> np.ndarray:
    """Sizes of linked sets differ by a quarter at most: their classes are equal or neighbours."""
    return np.floor(np.log(n) / np.log(1.25) + 1e-9).astype(np.int64)


def neighbours(lists: DataFrame, percent: int) -> DataFrame:
    """lists (value, rep, n, tops) -> edges (a, b) whose connected parts hold every pair that may be linked."""
    rows = lists.repartition(partitions(lists.sparkSession), "value").sortWithinPartitions("value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner, held, size, wide_value, pivots = ListJoiner(percent), [], 0, None, {}
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            last = b.column("value")[-1].as_py()
            one = held[0].column("value")[0].as_py() == last
            if size < (WIDE if one else 2048):
                continue
            t = pa.Table.from_batches(held)
            cut = size if one else int(np.searchsorted(t.column("value").to_numpy(), last))
            if one and wide_value != last:
                wide_value, pivots = last, {}
            wide_value = _work(joiner, t.slice(0, cut), wide_value, pivots)
            held, size = t.slice(cut).to_batches(), size - cut
            if len(joiner.forest.up) > 1_000_000:
                yield joiner.forest.edges()
                joiner.forest = Forest()
        if size:
            _work(joiner, pa.Table.from_batches(held), wide_value, pivots)
        yield joiner.forest.edges()

    return rows.mapInArrow(run, _EDGES)


def _work(joiner: ListJoiner, t: pa.Table, wide_value: int | None, pivots: dict[int, int]) -> int | None:
    """Joins within the lists of t, which are sorted and whole but for one of value wide_value."""
    values, reps, n, tops = t.column("value").to_numpy(), t.column("rep").to_pylist(), t.column("n").to_numpy(), t.column("tops").to_pylist()
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    lengths = np.diff(np.r_[starts, len(values)])
    if wide_value is not None and values[0] == wide_value:
        joiner.wide(reps[: lengths[0]], n[: lengths[0]], pivots)
        if len(starts) == 1:
            return wide_value
        starts, lengths = starts[1:], lengths[1:]
    few = lengths <= SHORT
    for at, size in zip(starts[~few].tolist(), lengths[~few].tolist(), strict=True):
        joiner.long(reps[at : at + size], n[at : at + size], tops[at : at + size])
    starts, lengths = starts[few], lengths[few]
    if len(starts):
        take = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        joiner.short(np.r_[0, np.cumsum(lengths)[:-1]], lengths, [reps[i] for i in take], n[take], [tops[i] for i in take])
    return None


def wide_neighbours(rows: DataFrame) -> DataFrame:
    """rows (value, rep, n) of the fewer than HOT hottest lists -> edges through one pivot of each list and size class."""
    level = F.floor(F.log(1.25, F.col("n").cast("double")) + 1e-9)
    rows = rows.withColumn("lv", F.explode(F.array(level, level + 1)))
    pivots = rows.groupBy("value", "lv").agg(F.min("rep").alias("a"))  # fewer than HOT values, about a hundred classes
    return rows.join(F.broadcast(pivots), ["value", "lv"]).select("a", F.col("rep").alias("b")).filter("a <> b")


def confirmed(blocks: DataFrame, percent: int) -> DataFrame:
    """blocks (y, deal, block, rep, set) -> links (a, b) that connect all that are linked within a block, exactly."""
    rows = blocks.repartition(partitions(blocks.sparkSession), "y", "deal", "block").sortWithinPartitions("y", "deal", "block")

    def links(reps: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        if len(sets) < 2:
            return []
        return [(min(reps[i], reps[j]), max(reps[i], reps[j])) for i, j in spanning(sets, exactly(percent)) if reps[i] != reps[j]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reps, sets = None, [], []
        for t in batches:
            found = []
            for *key, rep, packed in zip(*(t.column(c).to_pylist() for c in ("y", "deal", "block", "rep", "set")), strict=True):
                if key != at:
                    found += links(reps, sets)
                    at, reps, sets = key, [], []
                reps.append(rep)
                sets.append(np.frombuffer(packed, np.uint64))
            yield _edges(found)
        yield _edges(links(reps, sets))

    small_batches(blocks.sparkSession)
    return rows.select("y", "deal", "block", "rep", "set").mapInArrow(run, _EDGES)


def visited(rows: DataFrame, percent: int) -> DataFrame:
    """rows (y, block, kind, rep, component, set) -> links (a, b) of visitors (kind 1) with members (kind 0) of a block.

    One link for each visitor and component of its links; members of the visitor's own component are passed over.
    Members are held, visitors are streamed.
    """
    rows = rows.repartition(partitions(rows.sparkSession), "y", "block").sortWithinPartitions("y", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reps, parts, sets, index = None, [], [], [], None
        for t in batches:
            found = []
            for y, block, kind, rep, part, packed in zip(*(t.column(c).to_pylist() for c in ("y", "block", "kind", "rep", "component", "set")), strict=True):
                if (y, block) != at:
                    at, reps, parts, sets, index = (y, block), [], [], [], None
                s = np.frombuffer(packed, np.uint64)
                if kind == 0:
                    reps.append(rep)
                    parts.append(part)
                    sets.append(s)
                    continue
                if not sets:
                    continue
                if index is None:
                    values, sizes = np.concatenate(sets), np.array([len(x) for x in sets])
                    order = np.argsort(values, kind="stable")
                    index = values[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes, np.array(parts, np.int64)
                values, owner, sizes, labels = index
                lo = np.searchsorted(values, s, "left")
                runs = np.searchsorted(values, s, "right") - lo
                hold = np.repeat(lo - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
                common = np.bincount(owner[hold], minlength=len(sets))
                near = np.flatnonzero((common > 0) & (labels != part) & exactly(percent)(common, len(s), sizes))
                for k in near[np.unique(labels[near], return_index=True)[1]].tolist():
                    if reps[k] != rep:
                        found.append((min(rep, reps[k]), max(rep, reps[k])))
            yield _edges(found)

    small_batches(rows.sparkSession)
    return rows.select("y", "block", "kind", "rep", "component", "set").mapInArrow(run, _EDGES)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _as_edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("b").alias("u"), F.col("a").alias("v"))


def whole_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(rep, set) for the texts of these doc_ids: all shingle hashes, packed."""
    texts = text_bytes(docs).join(ids.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        for b in batches:
            sets = [hasher(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.binary())], names=["rep", "set"])

    small_batches(docs.sparkSession)
    return texts.mapInArrow(run, "rep bigint, set binary").filter("octet_length(set) > 0")


def _block(blocks: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64("rep", F.lit(salt)), blocks).cast("int")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id).

    docs: doc_id bigint, text string; other columns are ignored whatever their names.  width: words of a shingle;
    a text of fewer words is one shingle.  Null and blank texts have the empty set and are linked with nothing.
    Rows of one doc_id are one document, linked with all that any of its texts is.  A row without doc_id is kept
    and stands alone with component_id null.  No rows give no rows.
    """
    if percent < 80:
        raise ValueError("the size classes and the sketch bound hold from 80 percent up")
    sketch = materialize(sketches(docs, width), "sketches")
    some = sketch.filter("digest is not null and doc_id is not null")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("tops").alias("tops"), F.count("*").alias("held"))
    classes = materialize(classes, "classes")
    # a doc_id with several texts may stand for several classes
    reps = classes.withColumn("class", F.xxhash64("digest"))
    named = some.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = materialize(named.filter("low < high").select("doc_id"), "several")
    mine = some.select("doc_id", "digest").join(several.hint("merge"), "doc_id").join(classes.select("digest", "rep").hint("merge"), "digest")
    shared_id = materialize(mine.select(F.col("doc_id").alias("b"), F.col("rep").alias("a")).filter("a <> b").select("a", "b"), "shared")

    listed, sizes = inverted_lists(reps, percent)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    hottest = F.col("size") > F.greatest(F.lit(WIDE), F.lit(total) / HOT)
    placed = skewed_join(listed, sizes.filter(~hottest), "value", "size").select("value", "rep", "class")
    lists = placed.join(reps.select("rep", "class", "n", "tops").hint("merge"), ["rep", "class"]).select("value", "rep", "n", "tops")
    edges = neighbours(lists, percent)
    hot = sizes.filter(hottest)
    if not hot.isEmpty():
        rows = listed.join(F.broadcast(hot.select("value")), "value")
        edges = edges.unionByName(wide_neighbours(rows.join(reps.select("rep", "class", "n").hint("merge"), ["rep", "class"]).select("value", "rep", "n")))
    edges = materialize(edges.unionByName(shared_id), "near")
    around = connected_components(_as_edges(edges))

    # full sets meet by neighbourhood
    size_of = reps.groupBy("rep").agg(F.sum("n").alias("n"))
    members = materialize(around.join(size_of.hint("merge"), around["node"] == size_of["rep"]).select("rep", "n", F.col("component").alias("y")), "members")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int")
    groups = materialize(members.groupBy("y").agg(F.count("*").alias("c"), blocks.alias("blocks")), "groups")
    sets = materialize(whole_sets(docs, members, width), "sets")
    dealt = skewed_join(members, groups, "y", "c")
    dealt = materialize(dealt.select("rep", "y", "blocks"), "dealt")
    deals = dealt.select("rep", "y", "blocks", F.explode(F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("deal"))
    deals = deals.select("rep", "y", "deal", F.when(F.col("deal") == 0, _block(F.col("blocks"), 0)).otherwise(_block(F.col("blocks"), 1)).alias("block"))
    links = confirmed(deals.join(sets.hint("merge"), "rep"), percent).unionByName(shared_id)
    links = materialize(links, "links")
    parts = connected_components(_as_edges(links))

    if not dealt.filter("blocks > 1").isEmpty():
        # members outside the largest component of a neighbourhood visit all its blocks
        large = dealt.filter("blocks > 1").join(parts.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        large = materialize(large, "large")
        main = large.groupBy("y", "component").agg(F.count("*").alias("c"))
        main = main.groupBy("y").agg(F.sum("c").alias("c"), F.max_by("component", F.struct("c", "component")).alias("main"))
        split = materialize(main.join(large.filter("blocks > 1").select("y", "component").distinct().groupBy("y").agg(F.count("*").alias("parts")).filter("parts > 1").hint("merge"), "y").select("y", "main", "c"), "split")
        if not split.isEmpty():
            rows = skewed_join(large, split, "y", "c")
            home = rows.select("y", _block(F.col("blocks"), 0).alias("block"), F.lit(0).alias("kind"), "rep", "component")
            visit = rows.filter("component <> main").select("y", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(1).alias("kind"), "rep", "component")
            more = visited(home.unionByName(visit).join(sets.hint("merge"), "rep"), percent)
            links = materialize(links.unionByName(more), "links")
            parts = connected_components(_as_edges(links))

    # each representative's component, then each document's through its class
    parts = parts.withColumnRenamed("node", "rep").hint("merge")
    home = classes.select("digest", "rep", "held").join(parts, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"), "held")
    home = materialize(home, "homes")
    discard(listed, sizes, edges, members, groups, sets, dealt, classes, several)
    out = skewed_join(sketch.select("doc_id", "n_shingles", "digest"), home, "digest", "held", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
