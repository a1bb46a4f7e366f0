"""The training-data operators against brute force on small tables, with nulls, empties, ties and repeats."""

import binascii
import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stereobate.llm import ann, decontam, licences, lm, mixing, neardup, quality, repeats, shards, tokencount
from stereobate.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, component string"
WORDS = [f"{a}{b}" for a in "b c d f g h k l m n p r s t v".split() for b in "a e i o u an en in on un".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus():
    """Documents with null and empty texts, copies, near copies, a null id, a null source and a repeated row."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(60)]
    texts += [texts[0]] * 5 + [None, "", "   \n", "one two", "One  TWO", "x" * 5000]
    base = [prose(rng, 200).split() for _ in range(4)]
    for words in base:
        for _ in range(6):
            other = list(words)
            other[rng.randrange(200)] = "changed"
            texts.append(" ".join(other))
    passage = prose(rng, 70)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(3)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), 1, "c") for i, t in enumerate(texts)]
    return [*rows, (None, "no id here at all", "en", "s1", 5, 1, "c"), rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_another_schedule_moves_positions_and_keeps_what_is_taken(docs):
    """Positions come from inverting the cumulative demand of each source's schedule."""
    one, two = (mixing.plan(docs, schedules=x).toPandas().sort_values(["doc_id", "size"]).reset_index(drop=True) for x in (mixing.SCHEDULES, ((0.5, 1.5), (1.5, 0.5), (1.0, 1.0))))
    assert one.taken.equals(two.taken)
    held = one.position.notna() & (one.position > 0)
    assert held.any() and (one.position[held] != two.position[held]).all()


def words(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]


def test_shards_are_even_and_whole(docs, empty):
    out = shards.shard_by_bytes(docs, 4).toPandas()
    rows = corpus()
    assert sorted((out["size"]).tolist()) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    assert collections.Counter(out.text_crc32) == collections.Counter(binascii.crc32((r[1] or "").encode()) for r in rows)
    by = out.sort_values(["shard", "slot"])
    assert (by.groupby("shard").cumcount() == by.slot).all()
    totals = out.groupby("shard")["size"].sum()
    assert len(totals) == 4 and totals.max() - totals.min() <= 2 * out["size"].max()
    assert shards.shard_by_bytes(empty, 4).count() == 0


def test_one_huge_group_is_split_over_the_shards(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    out = shards.shard_by_bytes(d, 8).toPandas()
    n = out.groupby("shard").size()
    assert len(n) == 8 and n.max() - n.min() <= 2


def test_large_ids_beside_a_null_and_many_equal_rows(spark):
    big = [(2**60 + 2 * i + 1, f"text {i % 5}") for i in range(50)] + [(None, "text 0"), (7, None), (-(2**63), "")]
    out = shards.shard_by_bytes(spark.createDataFrame(big, "doc_id long, text string").coalesce(1), 4)
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(i or 0 for i, _ in big)
    same = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("all alike").alias("text"))
    n = shards.shard_by_bytes(same, 8).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert len(n) == 8 and max(r.n for r in n) - min(r.n for r in n) <= 2 and all(r.top == r.n - 1 for r in n)


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2 * sizes[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def test_mix_meets_its_targets(docs, empty):
    got = mixing.plan(docs, keep=True).select("doc_id", "size", "source_size", "target", "taken", "position", "row.source").toPandas()
    sizes = collections.Counter()
    for r in corpus():
        sizes[r[3]] += len(words(r[1]))
    target = brute_targets(dict(sizes))
    for source, g in got.groupby(got.source.fillna("none")):
        s = None if source == "none" else source
        assert g.target.iloc[0] == pytest.approx(target[s]) and g.source_size.iloc[0] == sizes[s]
        assert abs(g.taken.sum() - target[s]) <= 1
    assert (got.taken <= 2 * got["size"]).all() and got.position.dropna().between(0, 1).all()
    again = mixing.plan(docs.repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, again[key].fillna(-1).values.tolist())) == sorted(map(tuple, got[key].fillna(-1).values.tolist()))
    assert mixing.plan(empty).count() == 0


def test_mixed_rows_hold_the_words_taken(docs):
    taken = sum(r.taken for r in mixing.plan(docs).collect())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r.text)) for r in out.collect()) == taken


@pytest.mark.parametrize("first, last", [(1.0, 1.0), (1.5, 0.5), (0.0, 2.0), (2.0, 0.0)])
def test_inverse_demand_inverts_the_integral(spark, first, last):
    t = spark.range(11).select((F.col("id") / 10).alias("t"))
    asked = (F.col("t") * first + (last - first) * F.col("t") ** 2 / 2) / ((first + last) / 2)
    got = t.select("t", mixing.inverse_demand(asked, F.lit(first), F.lit(last)).alias("u")).collect()
    assert all(abs(r.t - r.u) < 1e-6 for r in got)


ITEMS = ["Anna Berg bought 12 apples for 30 euros and gave 5 of the apples to her brother before noon on the same day", "short item of five words", "the river runs past seven old mills and under the long stone bridge into the quiet green valley below"]


def test_leaks_verbatim_and_with_other_numbers(spark):
    rng = random.Random(1)
    bench = spark.createDataFrame(list(enumerate(ITEMS)) + [(9, None), (10, "")], "item_id long, text string")
    pad = lambda t: f"{prose(rng, 40)}. {t} {prose(rng, 40)}"
    texts = [
        pad(ITEMS[2]), pad(ITEMS[0].replace("12", "19").replace("30", "44")), pad(ITEMS[1]), prose(rng, 300), None, "",
        pad(ITEMS[2].upper()), pad(" ".join(ITEMS[2].split()[:9])),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, ITEMS[2], 0)], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(d, bench).collect()}
    assert set(got) == {(0, 2), (1, 0), (2, 1), (6, 2)}
    assert got[1, 0].changed == 2 and got[0, 2].changed == 0
    assert {r.doc_id for r in decontam.clean(d, bench).collect()} == {3, 4, 5, 7, None}
    assert decontam.leaks(d.limit(0), bench).count() == 0 and decontam.leaks(d, bench.limit(0)).count() == 0


def test_changed_words_cost_only_themselves(spark):
    rng = random.Random(12)
    items = [prose(rng, n) for n in (21, 16, 40, 9)] + ["Compute 12 + 7 - 3 * 4 / 2 + 9 - 5 and round"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows, want = [], {}
    for i, item in enumerate(items):
        w = item.split()
        for changed in (0, 1, 2):
            other = list(w)
            for at in sorted(rng.sample(range(len(w) // 2), changed)):
                other[at] = "zzz"
            doc = len(rows)
            rows.append((doc, f"{prose(rng, 30)} {' '.join(other)} {prose(rng, 9000 if i == 2 else 30)}"))
            ours, theirs = (re.findall(r"\w+", x.lower()) for x in (item, " ".join(other)))
            equal = "".join("01"[a == b] for a, b in zip(ours, theirs))
            covered = sum(len(m) for m in re.findall("1{4,}", equal))
            if "1" * 8 in equal and covered >= min(13, math.ceil(0.8 * len(ours))):
                want[doc, i] = covered
    got = {(r.doc_id, r.item_id): r.covered for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == want and len(want) > 8


def test_copied_beginning_with_other_fillers_behind_is_a_leak(spark):
    item = "lay 4 bricks beside the tall wall and then paint every one of them blue before the 4 masons come back with more sand"
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    text = " ".join(item.split()[:18]) + " 9 dogs ran off"
    assert decontam.leaks(spark.createDataFrame([(0, text)], "doc_id long, text string"), bench).first().covered == 18


def test_inconsistent_slots_are_no_leak(spark):
    item = "take 7 stones and 7 sticks then lay the 7 stones round the 7 sticks in one neat ring on sand"
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    d = spark.createDataFrame([(0, item.replace("7", "9")), (1, "take 1 stones and 2 sticks then lay the 3 stones round the 4 sticks in one neat ring on sand")], "doc_id long, text string")
    assert [r.doc_id for r in decontam.leaks(d, bench).collect()] == [0]


def test_template_windows_with_a_placeholder_inside(spark):
    kinds = [None, None, None, None, "n", None, None, None, None, None, "n", "n", None, None]
    df = spark.createDataFrame([([(None if k is None else 7, i) for i, k in enumerate(kinds)],)], "x array<struct<kind:int,w:bigint>>")
    found = {r.n: [x.pos for x in r.rows] for r in df.select(decontam._template_windows(F.col("x"), [3, 8, 20]).alias("t")).first().t}
    assert found == {n: [p for p in range(len(kinds) - n + 1) if any(kinds[p : p + n])] for n in (3, 8, 20)}
    bench = spark.createDataFrame([(1, "every morning around 17 students gather near the fountain")], "item_id long, text string")
    d = spark.createDataFrame([(0, "It is said that every morning around 42 students gather near the fountain and sing.")], "doc_id long, text string")
    assert [r.doc_id for r in decontam.leaks(d, bench).collect()] == [0]


def vectors(n=900, dim=16):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(2000, None, 0), (2050, [0.0] * dim, 0), (2100, [float("nan")] * dim, 0), (2150, [None] * dim, 0), (2201, [1.0, 2.0], 0), (None, x[0].tolist(), 0)]
    return rows + bad, x


def test_neighbours_are_near_and_exact(spark):
    rows, x = vectors()
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = collections.defaultdict(list)
    for r in ann.nearest(e, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = x.astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = 0
    assert set(got) == {i for i in range(900) if i % 50 == 0}
    for q, near in got.items():
        cosine = unit @ unit[q]
        cosine[q] = -2
        best = sorted(range(900), key=lambda i: (-round(cosine[i], 12), i))[:5]
        hit += len(set(best) & {v for v, _ in near})
        assert len(near) == 5 and all(abs(s - cosine[v]) < 1e-12 for v, s in near)
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
    assert hit / (5 * len(got)) >= 0.9
    assert [v for v, _ in got[100]] == [101, 102, 103, 104, 105]


def test_ties_go_to_the_smaller_id_and_lengths_keep_apart(spark):
    rng = np.random.default_rng(4)
    way = rng.normal(size=8)
    rows = [(1001 + i, (way * (1.0 + 0.37 * i)).tolist()) for i in range(40)] + [(50, (way + 0.3 * rng.normal(size=8)).tolist())]
    rows += [(i, rng.normal(size=8).tolist()) for i in range(1, 40)] + [(100 * i, rng.normal(size=3).tolist()) for i in range(1, 4)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = collections.defaultdict(list)
    for r in ann.nearest(e, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[50] == [1001, 1002, 1003, 1004, 1005]
    assert {q: set(v) for q, v in got.items() if q != 50} == {100: {200, 300}, 200: {100, 300}, 300: {100, 200}}


def test_few_vectors_give_all_candidates(spark):
    e = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in ann.nearest(e, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(1, 3), (2, 1)]
    assert ann.nearest(e.limit(0), F.lit(True)).count() == 0


def test_language_model_counts(docs, empty):
    import public_tokenizers as P

    ranks = lm.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    got = lm.lm_scores(docs, ranks, P.PATTERN).collect()
    rows = corpus()
    held = lambda i: binascii.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    count = collections.Counter()
    for r in rows:
        if not held(r[0]):
            count.update(words(r[1]))
            count[None] += 1
    n, v = sum(count.values()), len(count)
    want = collections.Counter()
    for r in rows:
        tokens = [*words(r[1]), None]
        want[r[0], held(r[0]), len(tokens), sum(count[t] > 0 for t in tokens), n, round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), 6)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.lm_scores(empty, ranks, P.PATTERN).count() == 0


def test_language_model_learns_from_texts_beyond_its_first_sample(spark, monkeypatch):
    import public_tokenizers as P

    ranks = lm.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    monkeypatch.setattr(lm, "SAMPLE", 1)
    held = lambda i: binascii.crc32(str(i).encode()) % 7 == 2
    rng, pairs = random.Random(5), [("red", "house"), ("green", "tree"), ("blue", "river"), ("old", "stone")]
    ordered = [" ".join(w for _ in range(40) for w in rng.choice(pairs)) for _ in range(40)]
    mixed = [" ".join(rng.sample(t.split(), 80)) for t in ordered]  # the same words, so the same counts
    ids = [i for i in range(1000) if not held(i)][: len(ordered)]
    asked = next(i for i in range(1000, 2000) if held(i))
    # One text has the least draw of all, so that the first sample is the same.
    drawn = spark.createDataFrame([(i, "stone") for i in range(2000, 8000) if not held(i)], "doc_id long, text string")
    first = drawn.orderBy(F.xxhash64("doc_id", "text")).first()
    scores = []
    for texts in (ordered, mixed):
        rows = [*zip(ids, texts), (first.doc_id, first.text), (asked, " ".join(w for p in pairs * 5 for w in p))]
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert docs.where(f"doc_id <> {asked}").orderBy(F.xxhash64("doc_id", "text")).first().doc_id == first.doc_id
        scores.append({r.doc_id: r for r in lm.lm_scores(docs, ranks, P.PATTERN).collect()}[asked])
    assert scores[0].base_score == pytest.approx(scores[1].base_score)
    assert scores[0].score > scores[1].score + 0.01


def test_attention_is_causal_and_sums_to_one():
    net = lm.Network(50)
    classes = (np.arange(50) % lm.CLASSES).astype(np.int32)
    share = np.log(1 / np.bincount(classes, minlength=lm.CLASSES).clip(1)[classes]).astype(np.float32)
    rng = np.random.default_rng(0)
    seq = rng.integers(0, 49, 70).astype(np.int32)

    def logs(s):
        inputs, place, targets, opening = lm._blocks([s], 49)
        return net.log_probability(inputs, place, targets, opening, classes, share)[targets >= 0]

    changed = seq.copy()
    changed[40] = (seq[40] + 1) % 49
    assert np.allclose(logs(seq)[:40], logs(changed)[:40], atol=1e-5)
    total = sum(np.exp(logs(np.append(seq[:5], i).astype(np.int32))[5]) for i in range(50) if i != 49)
    total += np.exp(logs(seq[:5])[5])
    assert total == pytest.approx(1.0, abs=1e-3)


def test_gradients_match_differences():
    net = lm.Network(30, seed=1)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(1)
    inputs, place, targets, opening = lm._blocks([rng.integers(0, 29, 40).astype(np.int32)], 29)
    classes = (np.arange(30) % lm.CLASSES).astype(np.int32)
    ids = inputs[place[:, None] + np.arange(lm.WINDOW)]
    wanted = targets[place[:, None] + lm.HALF + np.arange(lm.HALF)]

    def loss():
        logits, kept = net.forward(net.p["e"][ids], opening, keep=True)
        return net.gradients(logits, kept, opening, classes[np.maximum(wanted, 0)], wanted >= 0)

    _, grads, _ = loss()
    for k in ("q", "k", "v", "o", "a", "b", "c"):
        at = (1, 2)
        before = net.p[k][at]
        net.p[k][at] = before + 1e-5
        up = loss()[0]
        net.p[k][at] = before - 1e-5
        down = loss()[0]
        net.p[k][at] = before
        assert grads[k][at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-6)


def test_token_counts_equal_the_library(spark, docs):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    parts = ["the", "ing", " ", "  ", "\n", "é", "ß", "Sch", "12", ".", "中", "日本", "\t", "▁", "<s>", "😀", "\x00", "http://", "ё", "ﬁ", "____", "                 ", "\xa0", "</s>", "<0x0A>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += [None, "", " " * 100, "a" * 3000, "ab" * 2000, "thetion" * 900]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in tokencount.token_counts(d, path).collect():
        text = texts[r.doc_id] or ""
        assert r.n_tokens == len(lib.encode(text)) and r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 4096)
    assert tokencount.token_counts(d.limit(0), path).count() == 0


def test_quality_learns_and_survives_missing_labels(spark, empty):
    rng = random.Random(5)
    rows = [(i, prose(rng, 40) if i % 3 else " ".join(w + "%%%" for w in prose(rng, 40).split())) for i in range(300)] + [(900, None), (901, ""), (None, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    got = quality.quality(d, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert held and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) / len(held) > 0.95
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert {r.score for r in quality.quality(d, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(empty, labels).count() == 0


def test_quality_reads_labels_that_come_last_and_clashing_columns(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 30) + (" bad%%" * 5 if i % 2 else ""), 0.5, "x") for i in range(200)] + [(10, "another text of a known id", 0.1, "y")]
    d = spark.createDataFrame(rows, "doc_id long, text string, score double, label string")
    far = spark.range(100_000, 140_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels = far.union(spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int"))
    got = quality.quality(d, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 201 and sum(r.predicted == 1 - r.doc_id % 2 for r in held) >= 0.9 * len(held)
    assert quality.score(d, (np.zeros(1 << quality.BITS, np.float32), 0.0), "q").columns == [*d.columns, "q"]


def test_python_batches_are_bounded_by_bytes(spark):
    d = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1 << 20).alias("text")).coalesce(1)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    from stereobate.llm._io import small_batches

    assert max(r.n for r in small_batches(d).mapInArrow(sizes, "n long").collect()) <= 10


def assert_repeats_equal_brute_force(rows, out):
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append((r.start_word, r.end_word))
        assert r.other_id != r.doc_id and r.end_word - r.start_word == r.n_words >= 50
    texts = {r[0]: words(r[1]) for r in rows if r[0] is not None}
    seen = collections.defaultdict(set)
    for i, w in texts.items():
        for p in range(len(w) - 49):
            seen[tuple(w[p : p + 50])].add(i)
    for i, w in texts.items():
        want, have = set(), set()
        for p in range(len(w) - 49):
            if len(seen[tuple(w[p : p + 50])]) > 1:
                want |= set(range(p, p + 50))
        for a, b in got[i]:
            have |= set(range(a, b))
        assert want == have


def test_repeats_cover_what_brute_force_finds(docs, empty):
    assert_repeats_equal_brute_force(corpus(), repeats.repeated_passages(docs))
    assert repeats.repeated_passages(empty).count() == 0


@pytest.mark.parametrize("crowded", [0, 3, repeats.CROWDED])
def test_repeats_of_periodic_runs_and_of_a_common_middle(spark, crowded):
    rng = random.Random(9)
    line = prose(rng, 10)
    rows = [(i, f"{prose(rng, 30)} {'la di ' * 150} {prose(rng, 40)}") for i in range(2)]
    rows += [(10 + i, f"{prose(rng, 15)} {(line + ' ') * 40} {prose(rng, 25)}") for i in range(2)]
    rows += [(20 + i, "x " * (60 + i)) for i in range(2)]
    # Forty words that all hold, between leads and tails that few share: no pair of neighbours shows all of them.
    middle, ends = prose(rng, 40), [prose(rng, 12) for _ in range(8)]
    rows += [(100 + i, f"{prose(rng, 20)} {ends[i % 4]} {middle} {ends[4 + i // 4 % 4]} {prose(rng, 20)}") for i in range(32)]
    rows += [(200 + i, f"{prose(rng, 20)} {' '.join(ends[0].split()[12 - i :])} {middle} {' '.join(ends[5].split()[: 12 - i])} {prose(rng, 20)}") for i in range(13)]
    d = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, pos int, key int").repartition(5)
    assert_repeats_equal_brute_force(rows, repeats.repeated_passages(d, crowded))


def brute_components(rows, percent, k=5):
    sets = {}
    for r in rows:
        if r[0] is not None:
            w = words(r[1])
            sets[r[0]] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("percent", [85, 98])
def test_near_duplicates_equal_brute_force(docs, empty, percent):
    want = brute_components(corpus(), percent)
    got = neardup.near_duplicates(docs, percent).collect()
    assert len(got) == len(corpus())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(empty).count() == 0


def test_crowded_buckets_find_the_links_of_a_large_group(spark):
    rng = random.Random(8)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(120)] = rng.choice(WORDS) + "x"
        rows.append((i, " ".join(w)))
    want = brute_components(rows, 85)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] != c for i, (_, c) in want.items()) == 0


def test_crowded_buckets_compare_nodes_that_are_far_from_the_hub(spark):
    rng, rows, pairs = random.Random(5), [], []
    for g in range(2):
        base = [f"{w}{g}" for w in prose(rng, 600).split()]
        cut = lambda at, n: " ".join(base[:at] + base[at + n :])  # noqa: B023, E731
        rows += [(1000 * g + 100 + i, cut(rng.randrange(576), 24)) for i in range(300)]
        # The shorter text of a pair lacks so much of the base that it is near its longer one only.
        for i in range(8):
            x, y = 1000 * g + 2 * i, 1000 * g + 2 * i + 1
            rows += [(x, cut(10 + 60 * i, 118)), (y, cut(45 + 60 * i, 50))]
            pairs.append((x, y))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]) for x, y in pairs)
    assert [x for x, y in pairs if got[x] != got[y]] == []


def test_licences_equal_brute_force(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "the GNU General\nPublic License, version 3, and the MIT License; mit-license", None, "", "apache", "Apache licens", "é apache license ü", "cc by cc by", "by cc", "x " * 3000 + "Apache License", licences.NOTICES[6][0].upper(), "x y " + " ".join(licences.NOTICES[11][0].split()[:9]), "by by cc by by", "MIT and license, not MIT: a license"]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1)], "doc_id long, text string, score int")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licences.scan(d).collect():
        w = pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or ""))
        places, labels = [], set()
        for phrase, label in licences.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        if r.doc_id == 10:
            assert r.labels == "apache,apache-2.0" and r.score == 1
        if r.doc_id == 11:
            assert r.labels == "mit" and 0.1 < r.score <= 1
    assert licences.scan(d.limit(0)).count() == 0


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"

    docs = spark.read.parquet(f"{sf}/documents.parquet").union(spark.createDataFrame([(77_000, None, "en", "src0", 0), (77_001, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    stages = dict(corpus_pipeline.STAGES)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = stages["quality"](spark, docs, sf)
    left = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and all(i in left for i, q in labels.items() if q == 1) and not any(i in left for i, q in labels.items() if q == 0)
    single = stages["near_dedup"](spark, good, sf)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in brute_components(rows, corpus_pipeline.SIMILAR).items() if i == c)
    clean = stages["decontamination"](spark, single, sf)
    bench = {tuple(words(r.text)[p : p + 13]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for p in range(len(words(r.text)) - 12)}
    for r in single.collect():
        w = words(r.text)
        if any(tuple(w[p : p + 13]) in bench for p in range(len(w) - 12)):
            assert r.doc_id not in {x.doc_id for x in clean.collect()}
    mix = stages["mixing"](spark, clean, sf)
    assert mix.columns == docs.columns and {r.doc_id for r in mix.collect()} <= {r.doc_id for r in clean.collect()}
    placed = stages["sharding"](spark, mix, sf)
    assert placed.count() == mix.count() and placed.select("shard").distinct().count() == corpus_pipeline.SHARDS


def test_pipeline_stages_keep_further_columns_and_take_empty_tables(spark, sf):
    import corpus_pipeline

    rng = random.Random(11)
    rows = [(i, prose(rng, 30) if i % 5 else None if i % 2 else "", "en", f"s{i % 2}" if i % 3 else None, i, 0.5, "x") for i in range(20)] + [(None, prose(rng, 9), "en", "s0", 3, 0.1, "y")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, size string")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, sf)
        if name == "sharding":
            assert out.count() == len(rows)
        else:
            assert out.columns == d.columns and {r.doc_id for r in out.collect()} <= {r[0] for r in rows}
        assert stage(spark, d.limit(0), sf).count() == 0
