"""Ranked search, fingerprints and collocations against brute force, with nulls, empties, ties, repeats and long texts."""

import collections
import hashlib
import math
import random
import re
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stereobate.llm import collocations, fingerprints, ranked

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score long, range string, words string, item string, rank int, sketch string"
WORDS = [f"{a}{b}" for a in "b c d f g h k l m n p r s t v".split() for b in "a e i o u an en in on un".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def corpus(n=120):
    rng = random.Random(11)
    texts = [prose(rng, rng.randint(1, 250)) for _ in range(n)]
    texts += [texts[0]] * 4 + [None, "", " \n ", "one two", "One  TWO. one two; ONE two", "Größe über ÄÖ größe", "x" * 3000]
    texts.append(prose(rng, 30_000))
    rows = [(i, t, ["en", "de", None, "und"][i % 4], "s", 1, 2, "r", "w", "i", 3, "k") for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, "no id one two", "en", "s", 1, 2, "r", "w", "i", 3, "k"), (None, texts[5], "en", "s", 1, 2, "r", "w", "i", 3, "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def best_by_hand(rows, items, k):
    split = [(i, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))) for i, t in rows]
    split = [(i, w) for i, w in split if w]
    whole, total = len(split), sum(len(w) for _, w in split)
    df = collections.Counter(w for _, ws in split for w in set(ws))
    out = []
    for item, text in items:
        scored = []
        for doc, ws in split:
            tf, m, score = collections.Counter(ws), 75 + 25 * len(ws) * whole // total, 0
            for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)):
                if tf[w]:
                    score += math.floor(1000 * math.log((2 * whole + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "ba be bi bo ba"), (2, "One two"), (3, None), (4, ""), (5, "GRÖSSE größe"), (6, "unheardof"), (1, "ba be bi bo ba"), (None, "lin lon ba"), (7, " ".join(WORDS[:90]))]


def found_by(docs, items, spark, k=20):
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x")).withColumn("terms", F.lit(1))
    return sorted([tuple(r) for r in ranked.ranked(docs, items, k).collect()], key=str)


def test_ranked_search_equals_brute_force(spark, docs, empty):
    rows = [r[:2] for r in corpus()]
    assert found_by(docs, ITEMS, spark) == best_by_hand(rows, ITEMS, 20)
    assert found_by(docs, ITEMS, spark, 3) == best_by_hand(rows, ITEMS, 3)
    assert found_by(empty, ITEMS, spark) == []
    assert found_by(docs, [], spark) == []


def test_ranked_search_in_small_segments_blocks_and_without_filter(spark, docs, monkeypatch):
    """Results depend neither on segments and visits, nor on blocks of items, nor on the index's filter."""
    want = best_by_hand([r[:2] for r in corpus()], ITEMS, 5)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 20)
    assert found_by(docs, ITEMS, spark, 5) == want
    monkeypatch.setattr(ranked, "FILTER_TERMS", 3)
    assert found_by(docs, ITEMS, spark, 5) == want


def test_segment_skips_strata_and_keeps_the_best():
    rng = np.random.default_rng(5)
    vocabulary = np.arange(10, 30)
    docs = 4000
    lengths = rng.integers(1, 6, docs)
    terms = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in lengths])
    tf, m, ids = rng.integers(1, 9, len(terms)), rng.integers(75, 140, docs), rng.permutation(docs)
    segment = ranked.Segment(vocabulary, m, ids, np.zeros(docs, bool), lengths, terms, tf)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    for _ in range(20):
        chosen, weights = rng.choice(20, 4, replace=False), rng.integers(1, 9000, 4)
        weight = dict(zip(vocabulary[chosen], weights))
        at, scores = 0, []
        for d, n in enumerate(lengths):
            scores.append(sum(weight.get(terms[j], 0) * (10**9 * tf[j] // (1000 * tf[j] + 12 * m[d])) for j in range(at, at + n)))
            at += n
        want = sorted((-s, i) for s, i in zip(scores, ids) if s > 0)[:20]
        got = segment.search(chosen, weights, none, 20)
        assert [(-s, i) for s, i in zip(got[0], got[1])] == want


def sketch_by_hand(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    grams = [" ".join(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))] if ws else []
    hashes = {hashlib.md5(g.encode()).hexdigest()[:11] for g in grams}
    low = sorted(h for h in hashes if h < "4")
    return low or sorted(hashes)[:1]


def likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def test_fingerprints_equal_brute_force(docs):
    got = {}
    for r in fingerprints.fingerprints(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect():
        got[r.doc_id] = r
    texts = {i: t or "" for i, t, *_ in corpus() if i is not None}
    order = sorted(texts, reverse=True)
    assert sorted(got, reverse=True) == order
    for i, after in zip(order, order[1:] + order[:1]):
        text, other, r = texts[i], texts[after], got[i]
        edited = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
        own, edit, nxt = map(sketch_by_hand, (text, edited, other))
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(edit))
        assert (r.near_edited, r.near_next) == (likeness(own, edit), likeness(own, nxt))
    long = [r for r in got.values() if r.n_chars > 600 and r.n_chars < 3000]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_next for r in long if r.near_next < 1]) < 0.1


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_each_document_meets_the_next_at_any_number_of_ranges(spark, docs, empty, ranges):
    """Repeated rows, null ids and an id that fills several ranges: one chain through all rows."""
    rng = random.Random(2)
    many = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(7, prose(rng, 5)) for _ in range(80)], "doc_id long, text string"))
    pairs = fingerprints.edits(many, ranges).select("doc_id", "text", "next_text").collect()
    rows = [(r.doc_id, r.text or "") for r in many.collect()]
    assert sorted((str(p.doc_id), p.text) for p in pairs) == sorted((str(i), t) for i, t in rows)
    assert collections.Counter(p.next_text for p in pairs) == collections.Counter(t for _, t in rows)
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[-1 if i is None else i].add(t)
    order = sorted(texts, reverse=True)
    for p in pairs:
        i = -1 if p.doc_id is None else p.doc_id
        assert p.next_text in texts[i] | texts[order[(order.index(i) + 1) % len(order)]]
    assert fingerprints.edits(empty, ranges).count() == 0


def test_sketches_merge_to_the_sketch_of_the_union_and_estimate_containment(spark):
    rng = random.Random(4)
    small = [prose(rng, 400) for _ in range(3)]
    whole = "\n".join(small + [prose(rng, 3000)])
    df = spark.createDataFrame([(1, t) for t in small] + [(2, whole)], "g int, text string").withColumn("sketch", fingerprints.sketch(F.col("text")))
    by = {r.g: r.sketch for r in fingerprints.merged(df, ["g"]).collect()}
    assert by[2] == sketch_by_hand(whole)
    assert by[1] == sorted({h for t in small for h in sketch_by_hand(t)})
    share = spark.createDataFrame([(by[1], by[2])], "a array<string>, b array<string>").select(fingerprints.containment(F.col("a"), F.col("b")), fingerprints.containment(F.col("b"), F.col("a"))).first()
    assert share[0] > 0.95 and 0.2 < share[1] < 0.4
    back = spark.createDataFrame([("".join(by[1]),), ("",)], "f string").select(fingerprints.parsed(F.col("f"))).collect()
    assert [r[0] for r in back] == [by[1], []]


def phrases_by_hand(rows, least, top):
    count, size = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            size[lang] += len(ws)
            for n in range(1, 5):
                count[lang].update(ws[i : i + n] for i in range(len(ws) - n + 1))
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(100 * b >= 80 * a for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), " ".join(p), l, r))
        out += [(lang, n + 1, x[3], -x[1], x[4], x[5], size[lang], -x[0]) for n, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(25)] + ["Über", "É", "Alpha"]
    rows = []
    for i in range(300):
        ws = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = " ".join(w + rng.choice(["", "", "", "", ".", "!\t", "\r\n", " \t"]) for w in ws) + rng.choice(["", " big Red apple tree", " big red apple; tree big red"])
        rows.append((i, text, [None, "en", "und", "fr"][i % 4]))
    return rows + [(None, None, None), (5, "", "en"), (6, " ".join(["again"] * 500), "en"), (7, "w1 w2 w3 w4 " * 4000, "fr"), rows[4], rows[4]]


@pytest.mark.parametrize("least,top", [(30, 2000), (5, 40), (2, 2000)])
def test_collocations_equal_brute_force(spark, least, top):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).withColumn("words", F.lit(1)).withColumn("n", F.lit("x")).withColumn("word", F.lit("x"))
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.collocations(df, least, top).collect())
    assert got == phrases_by_hand([r[1:] for r in rows], least, top)
    assert got


def test_stripes_are_the_same_in_small_flushes_and_slices(monkeypatch):
    """Merged entries depend neither on how often tasks hand over nor on slices; totals are the prefixes' counts."""
    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], ["lang", "text"])
    counted = pa.Table.from_batches(list(collocations._words_counted(iter([batch]))))
    _, codes, hashes = collocations._lang_hashes(counted["lang"].combine_chunks())
    every = np.unique(collocations._keys(hashes[codes], [np.asarray(counted["hash"].combine_chunks()).view(np.uint64)]))
    single = collections.Counter()
    for r in counted.to_pylist():
        single[r["lang"], r["hash"]] += r["f"]
    seen = []
    for flush, hot in ((1 << 20, every[:0]), (50, every)):
        monkeypatch.setattr(collocations, "FLUSH", flush)
        shared = types.SimpleNamespace(value=(np.full(1 << 13, 255, np.uint8), hot))
        out = pa.Table.from_batches(list(collocations._stripes(shared, 2)(iter([batch]))))
        out = out.append_column("w", pa.array([x[0] for x in out["words"].to_pylist()])).sort_by([("lang", "ascending"), ("w", "ascending"), ("slice", "ascending")])
        merged = pa.Table.from_batches(list(collocations._merged(iter(out.to_batches(max_chunksize=7)), 2, 1))).to_pylist()
        entries = [((r["lang"], r["words"][0], n), f) for r in merged for n, f in zip(r["nexts"], r["counts"])]
        assert len(dict(entries)) == len(entries)
        total = collections.Counter()
        for r in merged:
            total[r["lang"], r["words"][0]] += r["total"]
        assert total == single
        seen.append((dict(entries), len(merged)))
    assert seen[0][0] == seen[1][0] and seen[1][1] > seen[0][1]


def test_collocations_of_nothing(empty):
    assert collocations.collocations(empty).collect() == []
