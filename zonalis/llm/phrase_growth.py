"""Phrases mined by best-first growth with branch and bound.

1. Words and pairs of words are counted in one scan; what occurs less than `least` times
   is dropped before anything is written, as no longer phrase can occur more often than it.
2. A pair is a node of the search.  Cut after its first word, a phrase that begins with the
   pair scores at most scale * f(pair) / f(first word), because both the phrase and what
   follows the cut occur as often as the phrase at least.  That bound holds for the pair, too.
3. Nodes are opened from the best bound on, a bounded batch of every language at a time:
   a scan counts the phrases of three words that begin or end with a pair of the batch.
   This settles the pairs of the batch (a longer phrase may hold them) and yields all
   phrases that begin with them.
4. A language is settled when the best bound that is left is below its `top`-th
   surviving score; equal bounds are opened.  Then nothing unopened can be in the result.

Counting is exact: within a chunk words are numbered by an Arrow dictionary, and across
chunks the phrases themselves are the keys of the aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.llm.arrow import batches_of
from zonalis.llm.words import chunks
from zonalis.session import materialise

BATCH = 65_536  # nodes opened by a scan, over all languages
SCALE = 1_000_000
SHORT_BYTES, LONG_BYTES = 1 << 19, 1 << 20  # of text counted at once, which bounds a worker's memory
BATCH_BYTES = 4 << 20  # of rows sent to a worker at once
NO_LANG = "und"
_INK, _BLANK, _CUT = 0, 1, 2
_CLASS = np.full(256, _INK, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _CUT
_COUNTS = "lang string, words int, phrase string, f long"


@dataclass
class Words:
    """The words of a chunk: number in the dictionary, number of the language, and whether
    the next word follows in the same piece."""

    number: np.ndarray
    names: pa.Array
    lang: np.ndarray
    langs: pa.Array
    joined: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs begin, and a number for each that tells pairs and languages apart."""
        at = np.flatnonzero(self.joined)
        n = len(self.names)
        return at, (self.lang[at] * n + self.number[at]) * n + self.number[at + 1]

    def phrase(self, at: np.ndarray, words: int) -> pa.Array:
        parts = [self.names.take(pa.array(self.number[at + i])) for i in range(words)]
        return pc.binary_join_element_wise(*parts, " ") if words > 1 else parts[0]

    def counted(self, at: np.ndarray, words: int, f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[at])), pa.array(np.full(len(at), words, np.int32)), self.phrase(at, words), pa.array(f.astype(np.int64))],
            names=["lang", "words", "phrase", "f"])


def words_of(data: np.ndarray, bounds: np.ndarray, langs: pa.Array) -> Words:
    """The words of the texts that `bounds` cuts out of `data`, in lower case (A-Z)."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    kind = _CLASS[data]
    ink = kind == _INK
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= ink[cuts]
    last[cuts - 1] |= ink[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    breaks = np.cumsum(kind == _CUT, dtype=np.int32)
    text = np.searchsorted(bounds, start, side="right") - 1
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    spelt = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[ink].tobytes())).dictionary_encode()
    number = spelt.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    named = langs.fill_null(NO_LANG).dictionary_encode()
    lang = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text] if len(start) else np.zeros(0, np.int64)
    joined = np.zeros(len(start), bool)
    joined[:-1] = (breaks[start[1:]] == breaks[start[:-1]]) & (text[1:] == text[:-1])
    return Words(number, spelt.dictionary, lang, named.dictionary, joined)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Words]:
    for batch in batches:
        for rows, data, bounds in chunks(batch, size=size):
            yield words_of(data, bounds, rows.column(rows.schema.get_field_index("lang")))


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, pairs, and (with an empty phrase) all occurrences of words, by language."""
    for w in _chunks(batches, SHORT_BYTES):
        n = len(w.names)
        all_words = np.bincount(w.lang, minlength=len(w.langs))
        yield pa.RecordBatch.from_arrays(
            [w.langs, pa.array(np.zeros(len(w.langs), np.int32)), pa.array([""] * len(w.langs), pa.string()), pa.array(all_words.astype(np.int64))],
            names=["lang", "words", "phrase", "f"])
        _, at, f = np.unique(w.lang * n + w.number, return_index=True, return_counts=True)
        yield w.counted(at, 1, f)
        at, key = w.pairs()
        _, one, f = np.unique(key, return_index=True, return_counts=True)
        yield w.counted(at[one], 2, f)


def _long_counts(batches: Iterator[pa.RecordBatch], opened: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Phrases of three words that begin or end with an opened pair."""
    for w in _chunks(batches, LONG_BYTES):
        at, key = w.pairs()
        _, one, of = np.unique(key, return_index=True, return_inverse=True)
        names, langs = w.phrase(at[one], 2), w.lang[at[one]]
        hit = np.zeros(len(one), bool)
        for i, lang in enumerate(w.langs.to_pylist()):
            if lang in opened:
                hit |= (langs == i) & pc.is_in(names, value_set=opened[lang]).to_numpy(zero_copy_only=False)
        pair = np.full(len(w.number) + 1, -1, np.int64)
        pair[at] = of
        begin = at[(pair[at + 1] >= 0)]
        begin = begin[hit[pair[begin]] | hit[pair[begin + 1]]]
        _, one, f = np.unique(pair[begin] * len(w.names) + w.number[begin + 2], return_index=True, return_counts=True)
        yield w.counted(begin[one], 3, f)


def _sums(rows: DataFrame, least: int) -> DataFrame:
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).filter((F.col("words") == 0) | (F.col("f") >= least))


def _share(a: str, parts: list[str], scale: int) -> Column:
    """floor(scale * a^2 / product of parts), beyond 64 bits."""
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    return F.expr(f"cast({scale} as decimal(38, 0)) * {wide(a)} * {wide(a)} div ({' * '.join(map(wide, parts))})")


def _nodes(short: DataFrame, scale: int) -> DataFrame:
    """Pairs (lang, phrase, a, l, r) with their score and the bound on all that begins with them."""
    part = lambda end: short.filter("words = 1").select("lang", F.col("phrase").alias(f"w{end}"), F.col("f").alias("l" if end == 1 else "r"))
    pairs = short.filter("words = 2").select("lang", "phrase", F.col("f").alias("a"), *[F.substring_index("phrase", " ", i).alias(f"w{n}") for n, i in ((1, 1), (2, -1))])
    both = pairs.join(part(1), ["lang", "w1"]).join(part(2), ["lang", "w2"])
    return both.select("lang", "phrase", "a", "l", "r", _share("a", ["l", "r"], scale).alias("score"),
                       F.expr(f"cast({scale} as decimal(38, 0)) * a div l").alias("bound"))


def _batched(nodes: DataFrame, per_lang: int) -> DataFrame:
    """nodes with `batch`, about per_lang nodes of a language from the best bound on; nodes of one
    bound that do not fit are dealt by a digest of the phrase."""
    levels = nodes.groupBy("lang", "bound").count()
    before = Window.partitionBy("lang").orderBy(F.desc("bound"))
    levels = levels.withColumn("before", F.sum("count").over(before) - F.col("count"))
    at = F.col("before") + F.pmod(F.xxhash64("phrase"), F.col("count"))
    return nodes.join(levels, ["lang", "bound"]).withColumn("batch", F.floor(at / per_lang).cast("int")).drop("before", "count")


def _scored_long(long: DataFrame, short: DataFrame, scale: int) -> DataFrame:
    """Phrases of three words with the cut that scores least."""
    word = lambda c: F.get(F.split("phrase", " "), c)
    cuts = {"l1": word(0), "r1": F.concat_ws(" ", word(1), word(2)), "l2": F.concat_ws(" ", word(0), word(1)), "r2": word(2)}
    out = long.select("lang", "phrase", F.col("f").alias("a"), *[c.alias(f"_{n}") for n, c in cuts.items()])
    for n in cuts:
        out = out.join(short.filter("words > 0").select("lang", F.col("phrase").alias(f"_{n}"), F.col("f").alias(n)), ["lang", f"_{n}"])
    out = out.withColumns({f"s{k}": _share("a", [f"l{k}", f"r{k}"], scale) for k in (1, 2)})
    first = F.col("s1") <= F.col("s2")
    pick = lambda n: F.when(first, F.col(f"{n}1")).otherwise(F.col(f"{n}2")).alias(n)
    return out.select("lang", "phrase", "a", pick("l"), pick("r"), pick("s").alias("score"), F.col("_l2").alias("head"), F.col("_r1").alias("tail"))


def mine_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 10, inside: int = 50, top: int = 2_000,
                 batch: int = BATCH, scale: int = SCALE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of two or three words of every
    language, by score, then a, from the largest, then phrase.

    Texts are put in lower case (A-Z) and cut at . , ; : ! ? and line ends; the rest is words
    between blanks and tabs.  a counts the phrase (at least `least`), n all words of the language.  Cut
    into two parts that occur l and r times, a phrase scores floor(scale * a^2 / (l * r)); the
    cut that scores least counts, of equal ones the first.  A phrase of two words goes if one of
    three holds it and occurs at least `inside` % as often.  A null language is 'und', a null text
    is empty; repeated rows count each.  A language without phrases, or an empty table, has no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    with batches_of(spark, BATCH_BYTES):
        short = materialise(_sums(texts.mapInArrow(_short_counts, _COUNTS), least), "short")
    totals = {r["lang"]: r["f"] for r in short.filter("words = 0").select("lang", "f").toLocalIterator()}
    nodes = materialise(_batched(_nodes(short, scale), max(1_024, batch // max(1, len(totals)))), "nodes")
    best = {}  # by language, the best bound of every batch
    for r in nodes.groupBy("lang", "batch").agg(F.max("bound").alias("bound")).toLocalIterator():
        best.setdefault(r["lang"], {})[r["batch"]] = int(r["bound"])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen, found = None, None
    opened, step = dict.fromkeys(best, 0), 0  # batches of a language that are opened
    live = set(best)
    while live:
        now = F.col("lang").isin(sorted(live)) & (F.col("batch") == step)
        rows = nodes.filter(now).select("lang", "phrase").toArrow()
        members = {x: pc.filter(rows["phrase"], pc.equal(rows["lang"], x)).combine_chunks() for x in live}
        with batches_of(spark, BATCH_BYTES):
            counted = materialise(_sums(texts.mapInArrow(lambda b, m=members: _long_counts(b, m), _COUNTS), least), "long")
        new = materialise(_scored_long(counted, short, scale), "scored")
        found = new if found is None else materialise(found.unionAll(new).distinct(), "scored")
        for x in live:
            opened[x] += 1
        holds = found.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        limits = spark.createDataFrame(sorted(opened.items()), "lang string, opened int")
        settled = nodes.join(limits, "lang").filter(F.col("batch") < F.col("opened")).join(holds, ["lang", "phrase"], "left")
        alone = settled.filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
        columns = ["lang", "phrase", "a", "l", "r", "score"]
        chosen = materialise(alone.select(*columns).unionAll(found.select(*columns)).withColumn("rank", rank).filter(F.col("rank") <= top), "chosen")
        last = {r["lang"]: r["score"] for r in chosen.filter(F.col("rank") == top).select("lang", "score").toLocalIterator()}
        step += 1
        live = {x for x in live if max((bound for b, bound in best[x].items() if b >= step), default=-1) >= last.get(x, 0)}
    if chosen is None:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    n = short.filter("words = 0").select("lang", F.col("f").alias("n"))
    return chosen.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
