"""Substring dedup by suffix automata over reference shards.

A window of `n` words belongs to one anchor: the least hash among its `n - k + 1` runs of
k words.  Equal windows have equal anchors, so the reference texts are sharded by anchor
and every document streams only the stretches around its own anchors through the
automata of their shards.

1. Copies of a whole text are settled by its digest: only the first of them goes on.
   Anchors met in one text only are dropped; what repeats is kept with each document.
2. The stretch around an anchor (all windows that belong to it) goes to the anchor's shard.
   An anchor met in more than `hot` documents is sharded further, by window.
3. In a shard, documents come by ascending doc_id.  Each streams its stretch through the
   suffix automaton of the stretches of smaller ids, taking matching statistics, and adds
   it only if it is not wholly known.  Runs of matches of n words or more are the spans.

A single broadcast of all automata would grow with the corpus; a shard's automaton is
built where the stretches for it arrive instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.words import Words, chunks, mix

WINDOW, ANCHOR = 13, 5
HOT = 2_000
WHOLE = 1 << 62  # as the end of a span: to the end of the text


class SuffixAutomaton:
    """Words of several texts; tells the longest suffix read so far that is in one."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.known: set[bytes] = set()

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: bytes, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def statistics(self, words: list[bytes]) -> Iterator[int]:
        """Length of the longest known stretch that ends with each word."""
        at = size = 0
        for w in words:
            while at and w not in self.next[at]:
                at = self.link[at]
                size = self.length[at]
            if w in self.next[at]:
                at = self.next[at][w]
                size += 1
            yield size


def _anchors(words: Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place where a window of n words starts: the place and its anchor's place.
    Of equal hashes the first is taken."""
    grams, _ = words.grams(k)
    _, whole = words.grams(n)
    start = np.flatnonzero(whole)
    if not len(start):
        return start, start
    best, at = grams[start].copy(), start.copy()
    for j in range(1, n - k + 1):
        less = grams[start + j] < best
        best[less] = grams[start + j][less]
        at[less] = start[less] + j
    return start, at


def _anchor_hash(words: Words, at: np.ndarray, k: int) -> np.ndarray:
    return words.grams(k)[0][at].view(np.int64)


def _anchor_rows(n: int, k: int):
    """(anchor, doc_id, text digest), each once per document."""
    names = ["anchor", "doc_id", "_text"]

    def rows(batches):
        for batch in batches:
            for part, data, bounds in chunks(batch):
                w = Words(data, bounds)
                at = np.unique(_anchors(w, n, k)[1])
                pair = np.unique(np.stack([w.text[at], _anchor_hash(w, at, k)], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
                ids, digests = (part.column(part.schema.get_field_index(c)).to_numpy() for c in names[1:])
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 1]), pa.array(ids[pair[:, 0]]), pa.array(digests[pair[:, 0]])], names=names)

    return rows, "anchor long, doc_id long, _text long"


def _repeated(hot: int):
    """From rows sorted by (anchor, text digest): the rows of anchors in two texts or more,
    and whether the anchor is hot.  Holds at most `hot` rows of an anchor; a hot one is
    told by its first rows already, as they wait until it is known."""

    def rows(batches):
        held: list[tuple[np.ndarray, ...]] = []
        state = {"key": None, "n": 0, "texts": set()}

        def flush(over: bool):
            if held and (over or len(state["texts"]) > 1):
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]
                out = pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.full(len(cols[0]), over))], names=["anchor", "doc_id", "_text", "hot"])
                held.clear()
                return [out]
            held.clear()
            return []

        for batch in batches:
            if not len(batch):
                continue
            cols = [batch.column(i).to_numpy() for i in range(3)]
            key = cols[0]
            cuts = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
            ends = cuts[1:]
            # Runs wholly inside the batch at once; the first and the last may go on.
            inner = np.zeros(len(key), bool)
            over = np.zeros(len(key), bool)
            if len(ends) > 2:
                lo, hi = cuts[1:-2], cuts[2:-1]
                several = cols[2][lo] != cols[2][hi - 1]
                inner[cuts[1] : cuts[-2]] = np.repeat(several, hi - lo)
                over[cuts[1] : cuts[-2]] = np.repeat(hi - lo > hot, hi - lo)
            for which in dict.fromkeys((0, len(ends) - 1)):
                lo, hi = cuts[which], cuts[which + 1]
                if state["key"] is None or key[lo] != state["key"]:
                    yield from flush(state["n"] > hot)
                    state.update(key=key[lo], n=0, texts=set())
                state["n"] += int(hi - lo)
                if len(state["texts"]) < 2:
                    state["texts"] |= {cols[2][lo], cols[2][hi - 1]}
                held.append(tuple(c[lo:hi].copy() for c in cols))
                if state["n"] > hot:
                    yield from flush(True)
                if which == 0 and inner.any():
                    if len(ends) > 1:
                        yield from flush(state["n"] > hot)
                    yield pa.RecordBatch.from_arrays([*(pa.array(c[inner]) for c in cols), pa.array(over[inner])], names=["anchor", "doc_id", "_text", "hot"])
        yield from flush(state["n"] > hot)

    return rows, "anchor long, doc_id long, _text long, hot boolean"


def _stretches(n: int, k: int):
    """(shard, doc_id, text digest, first word, words) for the repeated anchors of each row."""
    names = ["shard", "doc_id", "_text", "first", "words"]

    def rows(batches):
        for batch in batches:
            for part, data, bounds in chunks(batch):
                w = Words(data, bounds)
                start, at = _anchors(w, n, k)
                if not len(start):
                    continue
                anchor = _anchor_hash(w, at, k)
                ids, digests = (part.column(part.schema.get_field_index(c)).to_numpy() for c in names[1:3])
                wanted = [[x or [] for x in part.column(part.schema.get_field_index(c)).to_pylist()] for c in ("anchors", "hot_anchors")]
                out: list[list] = [[] for _ in names]
                crowd: list[list] = [[] for _ in names]  # of hot anchors
                text = w.text[start]
                borders = np.searchsorted(text, np.arange(len(part) + 1))
                windows = None
                for t in range(len(part)):
                    lo, hi = int(borders[t]), int(borders[t + 1])
                    if lo == hi:
                        continue
                    plain = np.isin(anchor[lo:hi], np.array(wanted[0][t], dtype=np.int64))
                    hot = np.isin(anchor[lo:hi], np.array(wanted[1][t], dtype=np.int64))
                    zero = int(w.first_word[t])

                    def put(shard, first, last, to=out, t=t, zero=zero):
                        a, b = w.start[first], w.end[last]
                        for col, x in zip(to, (shard, ids[t], digests[t], first - zero, b" ".join(data[a:b].tobytes().split())), strict=True):
                            col.append(x)

                    places = at[lo:hi]
                    cut = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
                    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), hi - lo], strict=True):
                        if plain[i]:
                            put(int(anchor[lo + i]), int(start[lo + i]), int(start[lo + j - 1]) + n - 1)
                    if hot.any():
                        if windows is None:
                            windows = mix(w.grams(n)[0] ^ np.uint64(n)).view(np.int64)
                        for i in np.flatnonzero(hot).tolist():
                            s = int(start[lo + i])
                            put(int(windows[s]), s, s + n - 1, crowd)
                _settle(crowd, out)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([
                        *(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], names=names)

    return rows, "shard long, doc_id long, _text long, first long, words binary"


def _settle(crowd: list[list], out: list[list]) -> None:
    """Of equal windows only those of the smallest doc_id go to the shard; the others are
    known by that one already, and go anywhere, without words."""
    least: dict[bytes, int] = {}
    for doc, text in zip(crowd[1], crowd[4], strict=True):
        least[text] = min(doc, least.get(text, doc))
    for shard, doc, digest, first, text in zip(*crowd, strict=True):
        known = doc != least[text]
        for col, x in zip(out, (digest ^ first if known else shard, doc, digest, first, None if known else text), strict=True):
            col.append(x)


def _matches(n: int):
    """From stretches sorted by (shard, doc_id): spans of words known from smaller ids."""

    def rows(batches):
        shard = doc = None
        auto = SuffixAutomaton()
        waiting: list[bytes] = []
        for batch in batches:
            out: list[list] = [[], [], [], []]
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for s, d, digest, first, text in zip(*cols, strict=True):
                if text is None:
                    for col, x in zip(out, (d, digest, first, first + n), strict=True):
                        col.append(x)
                    continue
                if s != shard:
                    shard, doc, auto, waiting = s, d, SuffixAutomaton(), []
                elif d != doc:
                    for known in waiting:
                        auto.add(known.split(b" "))
                        auto.known.add(known)
                    doc, waiting = d, []
                if text in auto.known:
                    ends = [(first, first + text.count(b" ") + 1)]
                    news = False
                else:
                    words, ends, news = text.split(b" "), [], True
                    if auto.known:
                        news = False
                        for i, m in enumerate(auto.statistics(words)):
                            if m >= n:
                                lo, hi = first + i - n + 1, first + i + 1
                                if ends and lo <= ends[-1][1]:
                                    ends[-1] = (ends[-1][0], hi)
                                else:
                                    ends.append((lo, hi))
                            elif i >= n - 1:
                                news = True
                if news and text not in waiting[-1:]:
                    waiting.append(text)
                for lo, hi in ends:
                    for col, x in zip(out, (d, digest, lo, hi), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "_text", "lo", "hi"])

    return rows, "doc_id long, _text long, lo long, hi long"


def _cut(window: int):
    def rows(batches):
        yield from _cut_rows(batches, window)
    return rows


def _cut_rows(batches, window: int):
    """Drop the words of each row's spans and join the rest by one space."""
    for batch in batches:
        names = batch.schema.names
        texts, spans = (batch.column(names.index(c)).to_pylist() for c in ("text", "_spans"))
        kept, total, removed, merged = [], [], [], []
        for text, own in zip(texts, spans, strict=True):
            words = (text or "").encode().split()
            total.append(len(words))
            joined: list[list[int]] = []
            for s in sorted((s["lo"], len(words) if s["hi"] == WHOLE else s["hi"]) for s in own or () if s["hi"] != WHOLE or len(words) >= window):
                if joined and s[0] <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], s[1])
                else:
                    joined.append(list(s))
            rest, at = [], 0
            for lo, hi in joined:
                rest += words[at:lo]
                at = hi
            rest += words[at:]
            removed.append(len(words) - len(rest))
            kept.append(b" ".join(rest).decode())
            merged.append([{"lo": lo, "hi": hi} for lo, hi in joined])
        span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(names.index("doc_id")), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(merged, pa.list_(span))], names=["doc_id", "kept", "n_words", "n_removed", "spans"])


def dedup_substrings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, spans) for every row of docs.

    A word goes if some window of `window` words covers it that also starts in a document
    with a smaller doc_id; spans are the maximal runs of such words (first, past the last).
    kept is the rest, joined by single spaces.  Null and empty texts have no words.  A null
    doc_id is neither smaller nor larger than another: its row stays whole and is no
    reference.  Rows that share a doc_id do not cover each other.  Other columns are not
    looked at.
    """
    # Without needless aliases: they would keep Spark from seeing that both joins below shuffle the same rows.
    plain = (doc_id, text) == ("doc_id", "text")
    rows = docs.select("doc_id", "text") if plain else docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if dict(rows.dtypes)["doc_id"] != "bigint":
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).withColumn("_text", F.xxhash64("text"))
    fn, schema = _anchor_rows(window, anchor)
    seen = named.mapInArrow(fn, schema).repartition("anchor").sortWithinPartitions("anchor", "_text")
    fn, schema = _repeated(hot)
    members = seen.mapInArrow(fn, schema)
    digests = named.select("doc_id", "_text", F.xxhash64(F.lit(1), "text").alias("_other"))
    heads = digests.groupBy("_text", "_other").agg(F.min("doc_id").alias("_head"))
    copies = digests.join(heads, ["_text", "_other"]).filter(F.col("doc_id") > F.col("_head")).select("doc_id", "_text")
    lists = members.groupBy("doc_id", "_text").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("anchors"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot_anchors"))
    lists = lists.join(copies, ["doc_id", "_text"], "left_anti")
    fn, schema = _stretches(window, anchor)
    met = named.join(lists, ["doc_id", "_text"], "left").select("doc_id", "_text", "text", "anchors", "hot_anchors").mapInArrow(fn, schema)
    met = met.repartition("shard").sortWithinPartitions("shard", "doc_id")
    fn, schema = _matches(window)
    spans = met.mapInArrow(fn, schema).groupBy("doc_id", "_text").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(WHOLE).alias("hi")))
    spans = spans.unionAll(copies.distinct().withColumn("_spans", all_of))
    # The same exchange of texts as above, so both are left joins; rows without a key or text have no spans.
    cut = named.join(spans, ["doc_id", "_text"], "left").select("doc_id", "text", "_spans")
    bare = rows.filter(F.col("doc_id").isNull() | F.col("text").isNull())
    cut = cut.unionAll(bare.select("doc_id", "text", F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("_spans")))
    return cut.mapInArrow(_cut(window), "doc_id long, kept string, n_words long, n_removed long, spans array<struct<lo:long,hi:long>>")
