"""Phrase mining against brute force, and the cases the docstring defines."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from zonalis.llm import phrase_growth
from zonalis.llm.arrow import batches_of

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, words int, score long, n string"


def brute(docs, least, inside, top):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    rows = {}
    many = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    for (lang, w), a in many.items():
        if len(w) == 2 and any(100 * b >= inside * a for (x, v), b in many.items() if x == lang and len(v) == 3 and w in (v[:2], v[1:])):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, n, p.decode(), -a, ls, r, total[lang], -s) for lang, found in rows.items() for n, (s, a, p, ls, r) in enumerate(sorted(found)[:top], 1))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["ÉTÉ", "été", "日本", "a b", "x\x1fy", "'s", "-"]
    fixed = ["New York City", "new york", "per se", "ad hoc committee", "of the"]
    out = []
    for i in range(300):
        words = [rng.choice(fixed) if rng.random() < 0.3 else vocabulary[min(int(rng.expovariate(0.12)), len(vocabulary) - 1)] for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\v"]) for w in words)
        out.append((i, text, rng.choice(["en", "en", "de", None, "und", ""]), "p", 1, 1, 1, "n"))
    odd = [(900, None, "en"), (901, "", "en"), (902, "., ;", "fr"), (None, "new york city " * 12, "en"), (903, "lonely", "it"), (903, "lonely", "it")]
    out += [(i, t, lang, "p", 1, 1, 1, "n") for i, t, lang in odd]
    return out + [(904, " ".join(["again", "and"] * 30_000), "long", "p", 1, 1, 1, "n")]


@pytest.mark.parametrize(("top", "per_batch", "batch", "least"), [(2_000, 65_536, 1_024, 10), (12, 8, 8, 3), (1, 5, 5, 2), (40, 30, 30, 2)])
def test_phrases(spark, docs, monkeypatch, top, per_batch, batch, least):
    dealt = phrase_growth._batched
    monkeypatch.setattr(phrase_growth, "_batched", lambda nodes, _: dealt(nodes, per_batch))
    got = phrase_growth.mine_phrases(spark.createDataFrame(docs, SCHEMA), top=top, least=least)
    want = brute(docs, least, 50, top)
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 4
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_opening_stops_early(spark, docs, monkeypatch):
    """What cannot reach the best scores is never counted."""
    sizes, dealt = [], phrase_growth._batched
    monkeypatch.setattr(phrase_growth, "_batched", lambda nodes, _: dealt(nodes, 10))
    inner = phrase_growth._scored_long
    monkeypatch.setattr(phrase_growth, "_scored_long", lambda *a: sizes.append(1) or inner(*a))
    phrase_growth.mine_phrases(spark.createDataFrame(docs, SCHEMA), top=3, least=3).count()
    pairs = dealt(phrase_growth._nodes(phrase_growth._sums(spark.createDataFrame(docs, SCHEMA).select("lang", "text").mapInArrow(
        phrase_growth._short_counts, phrase_growth._COUNTS), 3), phrase_growth.SCALE), 10).agg({"batch": "max"}).first()[0]
    assert len(sizes) < pairs / 2


def test_scores_beyond_64_bits(spark):
    a, parts = 10**12, [10**12 + 7, 3 * 10**12]
    one = spark.createDataFrame([(a, *parts)], "a long, l long, r long").select(phrase_growth._share("a", ["l", "r"], 1_000_000).alias("s"))
    assert one.first()["s"] == 1_000_000 * a * a // (parts[0] * parts[1])


def test_words_of_pieces():
    import pyarrow as pa
    raw = b"A b,c\td" + b"e f"
    w = phrase_growth.words_of(np.frombuffer(raw, np.uint8), np.array([0, 7, 10]), pa.array(["x", None]))
    assert w.names.take(pa.array(w.number)).to_pylist() == ["a", "b", "c", "d", "e", "f"]
    assert w.joined.tolist() == [True, False, True, False, True, False] and w.langs.to_pylist() == ["x", "und"]


def test_no_documents(spark):
    assert phrase_growth.mine_phrases(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_take_little_text_at_once():
    """A worker's memory is a multiple of the text it counts at once."""
    text = " ".join(f"w{i % 700}" for i in range(20_000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 24, "text": [text] * 24})
    counts = list(phrase_growth._short_counts(iter([batch])))
    words = [c.column("f")[0].as_py() for c in counts if c.column("words")[0].as_py() == 0]
    assert sum(words) == 24 * 20_000 and max(words) * len(text) / 20_000 <= 1 << 19


def test_workers_get_little_text_at_once(spark, monkeypatch):
    """Both scans send batches of bounded bytes, whatever the rows' number; the setting is put back."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, write = spark.conf.get(name), phrase_growth.materialise

    def noted(df, label):
        seen[label] = spark.conf.get(name)
        return write(df, label)

    monkeypatch.setattr(phrase_growth, "materialise", noted)
    docs = spark.createDataFrame([("one two three four " * 5_000, "en")] * 40, "text string, lang string").coalesce(1)
    assert [r["phrase"] for r in phrase_growth.mine_phrases(docs).collect()]
    assert seen["short"] == seen["long"] == str(phrase_growth.BATCH_BYTES) and phrase_growth.BATCH_BYTES < 1 << 23 and spark.conf.get(name) == before

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    with batches_of(spark, 1 << 18):
        got = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 40 * 95_000 and max(got) < (1 << 18) + 200_000
