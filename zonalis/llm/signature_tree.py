"""N-gram Jaccard join: exact links between documents whose shingle sets overlap.

1. *Routing.*  A set is cut by hash into parts, one more than the most tokens in which
   a linked pair of that size can differ, plus some slack.  A linked pair then agrees
   on a whole part that holds two tokens or more, one of them not very common; documents
   that share no part need not meet.  Sizes are dealt with in overlapping classes.  Small
   sets have their rarest tokens as keys instead.  A set with so many small parts that the
   promise fails gives keys of these as well.
2. *Groups.*  The few documents of a key are tried pair by pair by their bitmaps; those of
   a larger key are joined to the smallest of them.  Components of what remains are the
   candidate groups, cut into blocks of bounded size.  Documents with equal sets are one
   entry.
3. *Signature trees.*  In a block, sets are the leaves of a tree whose nodes hold the OR
   of their bitmaps, the least bit count and the size range.  A dual traversal drops node
   pairs whose greatest possible overlap is too small, and pairs that are already
   connected; what is left is compared exactly.  Groups of several blocks then compare
   block with block, unless all of both is connected by then.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.arrow import runs
from zonalis.llm.components import connected
from zonalis.llm.fetch import texts_of
from zonalis.llm.words import Words, chunks, mix
from zonalis.session import materialise

FAN = 16
CLASS_RATIO = 1.3
SMALL = 64  # sets of fewer tokens are routed by their rarest tokens
FEW = 8  # documents of a key that are tried pair by pair
BLOCK_SHINGLES = 1_500_000
SAMPLE_DOCS, COMMON = 4_000, 200_000


@dataclass(frozen=True)
class Threshold:
    """Link when den * intersection >= num * union."""

    num: int
    den: int

    def linked(self, inter: int, size_a: int, size_b: int) -> bool:
        return self.den * inter >= self.num * (size_a + size_b - inter)

    def differing(self, smaller: int) -> int:
        """Most tokens held by just one of a linked pair whose smaller set has so many."""
        return (self.den - self.num) * smaller // self.num


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text; a text of fewer than k words
    has its whole sequence as the one shingle, a text without words has none."""
    grams, whole = words.grams(k)
    for lo, hi in zip(words.first_word[:-1], words.first_word[1:], strict=True):
        n = hi - lo
        if n >= k:
            yield np.unique(grams[lo : hi - k + 1])
        elif n:
            h = np.uint64(n)
            for w in words.hash[lo:hi]:
                h = mix(np.array([h ^ w]))[0]
            yield np.array([h], dtype=np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _class_bounds(largest: int) -> list[int]:
    out = [SMALL]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_RATIO)))
    return out


_PARTS: dict[tuple[int, int], tuple[int, int]] = {}


def _parts(low: int, differing: int) -> tuple[int, int]:
    """Number of parts for sets of `low` tokens or more, and how many of them may be small
    without ending the promise of a large one in common: two deviations above the mean."""
    if (low, differing) in _PARTS:
        return _PARTS[low, differing]
    slack = 1
    while True:
        m = differing + 1 + slack
        share = low / m
        small = m * math.exp(-share) * (1 + share)
        if small + 2 * math.sqrt(small) <= slack or slack > differing:
            _PARTS[low, differing] = m, slack
            return m, slack
        slack += 1


def part_keys(tokens: np.ndarray, t: Threshold, common: np.ndarray) -> np.ndarray:
    """Keys of one set: a linked pair has one in common, see the module's head.

    `common` (sorted tokens) steers the choice of keys; whatever it holds, the promise is kept.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    rare = np.ones(n, bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        rare = common[at] != tokens
    out = []
    if n < SMALL:  # the rarest tokens, one more than a linked set can lack
        lack = n - -(-t.num * n // t.den)
        out.append(mix(tokens[np.lexsort((tokens, ~rare))][: lack + 1] ^ np.uint64(0x94D049BB133111EB)))
    if t.den * n < t.num * SMALL:
        return out[0]
    bounds = _class_bounds(n * t.den // t.num + 1)
    space = int(np.searchsorted(bounds, n, side="right")) - 1
    spaces = [space] if space >= 0 else []
    if t.den * n >= t.num * bounds[space + 1]:
        spaces.append(space + 1)
    spread = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    order = np.argsort(spread)
    spread = spread[order]
    sums, rares = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.int64)
    np.cumsum(mix(spread), out=sums[1:])
    np.cumsum(rare[order], out=rares[1:])
    high = spread >> np.uint64(32)
    for s in spaces:
        differing = t.differing(bounds[s + 1] - 1)
        m, slack = _parts(-(-bounds[s] * t.num // t.den), differing)
        part = ((high * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(m + 1))
        held = np.diff(edges)
        strong = (held >= 2) & (rares[edges[1:]] > rares[edges[:-1]])
        if m - int(strong.sum()) > slack:
            strong = held >= 1
            if m - int(strong.sum()) > slack:
                strong = np.ones(m, bool)
        keys = mix((sums[edges[1:]] - sums[edges[:-1]]) ^ mix(np.arange(m, dtype=np.uint64) + (np.uint64(s + 1) << np.uint64(32))))
        out.append(keys[strong])
    return np.concatenate(out)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bits of the tokens, in a power of two of them, more than there are tokens."""
    bits = max(128, 1 << len(tokens).bit_length())
    words = np.zeros(bits // 64, np.uint64)
    at = tokens % np.uint64(bits)
    np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return words


def may_link(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, t: Threshold) -> bool:
    """Whether two sets of these bitmaps and sizes can reach the threshold: a set has a
    token of its own for each bit the other lacks.  The longer bitmap is folded."""
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    both = int(np.bitwise_count(a & b).sum())
    most = min(size_a - (int(np.bitwise_count(a).sum()) - both), size_b - (int(np.bitwise_count(b).sum()) - both))
    return t.linked(most, size_a, size_b)


def _key_rows(k: int, fold_case: bool, t: Threshold, common):
    """(key, doc, 0), but of a key with more than FEW documents in a chunk only the smallest,
    as (key, doc, 2); its other documents are linked to that one at once, as (smallest, doc, 1)."""
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("other", pa.int64())])

    def rows(batches):
        often = common.value
        for batch in batches:
            for part, data, bounds in chunks(batch):
                ids = part.column(part.schema.get_field_index("doc_id")).to_numpy()
                each = [part_keys(s, t, often) for s in shingle_sets(Words(data, bounds, fold_case), k)]
                keys = np.concatenate(each)
                docs = np.repeat(ids, [len(x) for x in each])
                order = np.lexsort((docs, keys))
                keys, docs = keys[order].view(np.int64), docs[order]
                new = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])][: len(keys)]
                keys, docs = keys[new], docs[new]
                first = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
                run = np.cumsum(first) - 1
                crowd = np.bincount(run)[run] > FEW if len(run) else first
                least = docs[first][run] if len(run) else docs
                put, more = first | ~crowd, crowd & ~first
                near = np.unique(np.stack([least[more], docs[more]], 1), axis=0)
                n, e = int(put.sum()), len(near)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[keys[put], near[:, 0]]), pa.array(np.r_[docs[put], near[:, 1]]),
                    pa.array(np.r_[np.where(crowd[put], 2, 0), np.ones(e, np.int64)])], schema=schema)

    return rows, "key long, doc long, other long"


def _meetings(batches):
    """(a, b, sure) from rows sorted by (key, doc): all pairs of a key with FEW documents,
    to be tried by their bitmaps; the links to the smallest one of a larger key.  A document
    that stands for a crowd (other = 2) makes its key a larger one, however few its rows are."""
    def put(pairs: list[np.ndarray], sure: bool):
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(np.full(len(found), sure))], names=["a", "b", "sure"])

    key, held, size = None, np.zeros(0, np.int64), 0  # of a run that may go on: its first documents
    pairs_of = {n: np.array([(i, j) for j in range(n) for i in range(j)]).reshape(-1, 2) for n in range(2, FEW + 1)}
    for batch in batches:
        k, doc, other = (batch.column(i).to_numpy() for i in range(3))
        done = other == 1
        sure, maybe = [np.stack([k[done], doc[done]], 1)], []
        k, doc, crowd = k[~done], doc[~done], other[~done] == 2
        if len(k):
            cuts = np.r_[0, np.flatnonzero(k[1:] != k[:-1]) + 1, len(k)]
            long = np.diff(cuts)
            held_by = long + FEW * np.logical_or.reduceat(crowd, cuts[:-1])  # documents, at least
            for n in range(2, FEW + 1):  # whole runs of n documents
                at = cuts[:-1][held_by == n]
                at = at[(at > 0) & (at + n < len(k))]
                p = pairs_of[n]
                maybe.append(np.stack([doc[(at[:, None] + p[:, 0]).ravel()], doc[(at[:, None] + p[:, 1]).ravel()]], 1))
            for at, n, docs in zip(cuts[:-1], long, held_by, strict=True):
                edge = at == 0 or at + n == len(k)
                if not edge and docs <= FEW:
                    continue
                own = doc[at : at + n]
                if not edge:
                    sure.append(np.stack([np.full(n - 1, own[0]), own[1:]], 1))
                    continue
                if key is not None and k[at] != key:
                    if 1 < size <= FEW:
                        maybe.append(held[pairs_of[size]])
                    key = None
                if key is None:
                    key, held, size = k[at], own[:0], 0
                if size + docs > FEW:
                    rest = np.r_[held[1:] if size <= FEW else held[:0], own]
                    head = held[0] if len(held) else own[0]
                    sure.append(np.stack([np.full(len(rest), head), rest], 1))
                held, size = np.r_[held, own][:FEW], size + docs
        yield put(sure, True)
        yield put(maybe, False)
    if 1 < size <= FEW:
        yield put([held[pairs_of[size]]], False)


def _tried(t: Threshold):
    """The pairs whose bitmaps do not rule out a link."""
    def rows(batches):
        for batch in batches:
            a, b, na, nb, ba, bb = (batch.column(i).to_pylist() for i in range(6))
            keep = [i for i in range(len(a)) if may_link(np.frombuffer(ba[i], np.uint64), na[i], np.frombuffer(bb[i], np.uint64), nb[i], t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in keep], pa.int64()) for x in (a, b)], names=["a", "b"])
    return rows


class Tree:
    """A signature tree over sorted token arrays; node 0 of the last level is the root."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.size = np.array([len(s) for s in sets])
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = s % np.uint64(bits)
            np.bitwise_or.at(maps[i], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        pop = np.bitwise_count(maps).sum(1).astype(np.int64)
        # Each level: OR bitmap, least bit count, smallest and largest set.
        self.levels = [(maps, pop, self.size, self.size)]
        while len(self.levels[-1][0]) > 1:
            m, p, lo, hi = self.levels[-1]
            cut = np.arange(0, len(m), FAN)
            self.levels.append((np.bitwise_or.reduceat(m, cut), np.minimum.reduceat(p, cut),
                                np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut)))


def _may_link(a, i: np.ndarray, b, j: np.ndarray, t: Threshold) -> np.ndarray:
    """Whether some set below node i of level a can reach the threshold with one below
    node j of level b.  A set has a token of its own for each bit the other lacks."""
    common = np.bitwise_count(a[0][i] & b[0][j]).sum(1).astype(np.int64)
    most = np.minimum(a[3][i] - np.maximum(0, a[1][i] - common), b[3][j] - np.maximum(0, b[1][j] - common))
    least_a, least_b = np.maximum(a[2][i], most), np.maximum(b[2][j], most)
    return t.den * most >= t.num * (least_a + least_b - most)


class Groups:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.top(x), self.top(y)
        self.up[max(x, y)] = min(x, y)


def dual_links(one: Tree, two: Tree, t: Threshold, groups: Groups, shift: int) -> Iterator[tuple[int, int]]:
    """Links between sets of two trees that connect what groups does not connect yet.
    Positions of the second tree come after `shift`; one tree with itself has shift 0."""
    stack = [(len(one.levels) - 1, len(two.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        keep = _may_link(one.levels[la], i, two.levels[lb], j, t)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == lb == 0:
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if (shift or x < y) and groups.top(x) != groups.top(y + shift):
                    a, b = one.sets[x], two.sets[y]
                    inter = len(np.intersect1d(a, b, assume_unique=True))
                    if t.linked(inter, len(a), len(b)):
                        groups.join(x, y + shift)
                        yield x, y
            continue
        down_a, down_b = la >= lb, lb >= la
        ni, nj = [], []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            xs = range(x * FAN, min((x + 1) * FAN, len(one.levels[la - 1][0]))) if down_a else (x,)
            ys = range(y * FAN, min((y + 1) * FAN, len(two.levels[lb - 1][0]))) if down_b else (y,)
            for u in xs:
                ni += [u] * len(ys)
                nj += ys
        ni, nj = np.array(ni), np.array(nj)
        if not shift and la - down_a == lb - down_b:
            upper = ni <= nj
            ni, nj = ni[upper], nj[upper]
        for at in range(0, len(ni), 4096):
            stack.append((la - down_a, lb - down_b, ni[at : at + 4096], nj[at : at + 4096]))


def _load(table: pa.Table, k: int, fold_case: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    ids, sets = [], []
    for batch in table.select(["doc_id", "text"]).to_batches():
        for part, data, bounds in chunks(batch):
            ids.append(part.column(0).to_numpy())
            sets += list(shingle_sets(Words(data, bounds, fold_case), k))
    ids = np.concatenate(ids)
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0, ids[i]))
    return ids[order], [sets[i] for i in order]


def _bits(sets: list[np.ndarray]) -> int:
    return max(256, 1 << int(2 * max(len(s) for s in sets)).bit_length())


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([int(x[0]) for x in found], pa.int64()), pa.array([int(x[1]) for x in found], pa.int64())], names=["a", "b"])


def _within(k: int, fold_case: bool, t: Threshold):
    def rows(batches):
        for table in runs(batches, "block"):
            if len(table) > 1:
                ids, sets = _load(table, k, fold_case)
                tree = Tree(sets, _bits(sets))
                yield _pairs([(ids[x], ids[y]) for x, y in dual_links(tree, tree, t, Groups(len(sets)), 0)])
    return rows


def _across(k: int, fold_case: bool, t: Threshold):
    """Each run holds two blocks (side 0 and 1); `component` is what is connected so far."""
    def rows(batches):
        for table in runs(batches, "pair"):
            side = table.column("side").to_numpy()
            if not len(set(side.tolist())) == 2:
                continue
            halves = [table.filter(pa.array(side == s)) for s in (0, 1)]
            (ids_a, sets_a), (ids_b, sets_b) = (_load(h, k, fold_case) for h in halves)
            known = dict(zip(table.column("doc_id").to_pylist(), table.column("component").to_pylist(), strict=True))
            groups, first = Groups(len(sets_a) + len(sets_b)), {}
            for at, doc in enumerate([*ids_a.tolist(), *ids_b.tolist()]):
                groups.join(first.setdefault(known[doc], at), at)
            bits = _bits(sets_a + sets_b)
            found = dual_links(Tree(sets_a, bits), Tree(sets_b, bits), t, groups, len(sets_a))
            yield _pairs([(ids_a[x], ids_b[y]) for x, y in found])
    return rows


def common_shingles(docs: DataFrame, k: int, fold_case: bool, sample: int = SAMPLE_DOCS, least: int = 3) -> np.ndarray:
    """Shingles in `least` or more of at most `sample` documents, the first by digest.

    They steer the routing and never the result.  At most COMMON of them, the most frequent.
    """
    def rows(batches):
        for batch in batches:
            for _, data, bounds in chunks(batch):
                sets = list(shingle_sets(Words(data, bounds, fold_case), k))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["shingle"])

    some = docs.select(F.xxhash64("doc_id", "_text").alias("_o"), "text").orderBy("_o").limit(sample).select("text")
    found = some.mapInArrow(rows, "shingle long").groupBy("shingle").count().filter(F.col("count") >= least)
    return np.sort(np.array([r[0] for r in found.orderBy(F.desc("count"), "shingle").limit(COMMON).collect()], np.int64).view(np.uint64))


def _facts(k: int, fold_case: bool):
    """Set size, two 64-bit digests and the bitmap of the set of every row."""
    def rows(batches):
        for batch in batches:
            for part, data, bounds in chunks(batch):
                sets = list(shingle_sets(Words(data, bounds, fold_case), k))
                bits = pa.array([bitmap(s).tobytes() for s in sets], pa.binary())
                digests = [(len(s), int(s.sum(dtype=np.uint64).view(np.int64)), int(mix(s).sum(dtype=np.uint64).view(np.int64))) for s in sets]
                cols = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "_text")]
                yield pa.RecordBatch.from_arrays(
                    [*cols, *(pa.array([d[i] for d in digests], pa.int64()) for i in range(3)), bits],
                    names=["doc_id", "_text", "n_shingles", "_s1", "_s2", "bits"])
    return rows, "doc_id long, _text long, n_shingles long, _s1 long, _s2 long, bits binary"


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5, threshold: Threshold = Threshold(80, 100),
                       fold_case: bool = True, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    component_id is the smallest doc_id reachable by links, the row's own without any.
    Empty and null texts have no shingles and link with nothing.  Rows that share a
    doc_id are one node.  A null doc_id has a null component and links with nothing.
    Other columns of docs are not looked at.  block_shingles bounds what a task holds.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    fn, schema = _facts(k, fold_case)
    facts = materialise(rows.withColumn("_text", F.xxhash64("text")).mapInArrow(fn, schema), "facts")

    # Equal sets: links to the smallest document.
    same = facts.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    heads = same.groupBy("n_shingles", "_s1", "_s2").agg(F.min("doc_id").alias("head"))
    equal = materialise(same.join(heads, ["n_shingles", "_s1", "_s2"]).select("doc_id", "head", "n_shingles", "_text"), "equal")

    common = spark.sparkContext.broadcast(common_shingles(named.withColumn("_text", F.xxhash64("text")), k, fold_case))
    fn, schema = _key_rows(k, fold_case, threshold, common)
    keyed = named.mapInArrow(fn, schema).repartition("key").sortWithinPartitions("key", "doc")
    met = materialise(keyed.mapInArrow(_meetings, "a long, b long, sure boolean").groupBy("a", "b").agg(F.max("sure").alias("sure")), "met")
    first = equal.filter(F.col("doc_id") == F.col("head")).groupBy("doc_id").agg(F.min("_text").alias("_text"))
    bits = facts.join(first, ["doc_id", "_text"])
    bits = materialise(bits.select("doc_id", "n_shingles", "bits"), "bits")
    of = lambda end: bits.select(F.col("doc_id").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
    tried = met.filter(~F.col("sure")).join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    near = met.filter("sure").select("a", "b").unionAll(tried.mapInArrow(_tried(threshold), "a long, b long"))
    near = connected(near.unionAll(equal.select(F.col("doc_id").alias("a"), F.col("head").alias("b"))))

    # One row per distinct set of a group with more than one.
    reps = equal.filter(F.col("doc_id") == F.col("head")).join(near.withColumnRenamed("node", "doc_id"), "doc_id")
    sizes = reps.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_shingles")).filter(F.col("_n") > 1)
    reps = materialise(
        reps.join(sizes, "component").select(
            "doc_id", "_text", "component",
            F.ceil(F.col("_shingles") / block_shingles).cast("int").alias("blocks"),
            F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_shingles") / block_shingles)).cast("int").alias("part")), "sets")
    own = named.withColumn("_text", F.xxhash64("text"))
    texts = texts_of(own, reps, ["doc_id", "_text"], lambda df: df.drop("_text").withColumn("block", F.xxhash64("component", "part")))
    # Rows alike in doc_id and text are equal sets of one block.
    blocks = texts.select("block", "doc_id", "text").repartition("block").sortWithinPartitions("block")
    links = materialise(blocks.mapInArrow(_within(k, fold_case, threshold), "a long, b long"), "links")

    several = texts.filter(F.col("blocks") > 1)
    if not several.isEmpty():
        now = connected(links).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "linked")
        state = materialise(several.join(now, "doc_id", "left").select(
            "doc_id", "text", "block", "blocks", "part", "component", F.coalesce("linked", "doc_id").alias("linked")), "state")
        lone = state.groupBy("component", "part").agg(F.min("linked").alias("lo"), F.max("linked").alias("hi"))
        one, two = lone.alias("one"), lone.alias("two")
        pairs = materialise(
            one.join(two, (F.col("one.component") == F.col("two.component")) & (F.col("one.part") < F.col("two.part")))
            .filter(F.least("one.lo", "two.lo") != F.greatest("one.hi", "two.hi"))
            .select(F.col("one.component").alias("component"), F.col("one.part").alias("p0"), F.col("two.part").alias("p1")), "pairs")
        pairs = pairs.withColumn("pair", F.xxhash64("component", "p0", "p1"))
        sides = pairs.select("component", F.col("p0").alias("part"), "pair", F.lit(0).alias("side")).unionAll(
            pairs.select("component", F.col("p1").alias("part"), "pair", F.lit(1).alias("side")))
        met = state.join(sides, ["component", "part"]).select("pair", "side", "doc_id", "text", F.col("linked").alias("component"))
        met = met.repartition("pair").sortWithinPartitions("pair")
        links = links.unionAll(materialise(met.mapInArrow(_across(k, fold_case, threshold), "a long, b long"), "links"))

    every = links.unionAll(equal.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    groups = connected(every).select(F.col("node").alias("doc_id"), "component")
    return facts.join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
