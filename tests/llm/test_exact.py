"""Operators whose results are fixed, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from facetable.llm import (
    bpe,
    decontaminate,
    minhash,
    pii,
    quality_rules,
    sharding,
    suffix_dedup,
)
from facetable.llm.components import components
from facetable.llm.oracle import ORACLE
from facetable.llm.queries import QUERIES
from tests.compare import duckdb_bag, open_duckdb, spark_bag
from tests.llm import brute


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql_oracle(spark, data, name):
    assert spark_bag(QUERIES[name](spark, data)) == duckdb_bag(open_duckdb(data), ORACLE[name])


# Quality rules


def test_quality_measurements(odd, odd_docs):
    got = quality_rules.measure(odd).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert by_text(got.collect()) == by_text((d, *brute.quality(t)) for d, t in odd_docs)


def test_quality_policies_and_ablation(odd):
    rows = quality_rules.ledger(odd).cache()
    for policy, rules in quality_rules.POLICIES.items():
        wrong = " OR ".join(f"({quality_rules.RULES[r]})" for r in rules)
        assert rows.where(quality_rules.fails(policy) != F.expr(wrong)).count() == 0
        assert quality_rules.apply_policy(rows, policy).count() == rows.where(f"NOT ({wrong})").count()
        for row in quality_rules.ablation(rows, policy).collect():
            others = [quality_rules.RULES[r] for r in rules if r != row.rule] or ["FALSE"]
            mine = quality_rules.RULES[row.rule]
            assert row.n_failed == rows.where(mine).count()
            assert row.n_alone == rows.where(f"({mine}) AND NOT ({' OR '.join(others)})").count()


# Repeated strings


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_repeats(odd, odd_docs, hot):
    got = suffix_dedup.remove_repeats(odd, hot=hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)
    )
    assert by_text(got.collect()) == by_text(brute.repeats(odd_docs))


def test_repeats_across_the_cuts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 200)
    rng = random.Random(4)
    common = "".join(rng.choice("abcdefghij ") for _ in range(700))
    docs = [(i, common[i * 37 : i * 37 + 400] + str(i) * 60 + common[:90]) for i in range(8)]
    expected = by_text(brute.repeats(docs))
    kept = {}
    for depth_slice in suffix_dedup._segments(_batches(docs), 50):
        for doc, at, part in depth_slice:
            kept.setdefault(doc, set()).update(range(at, at + len(part) - 49))
    assert all(kept[d] == set(range(len(t) - 49)) for d, t in docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert by_text(got.collect()) == expected


def _batches(docs):
    import pyarrow as pa

    yield pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]})


def test_repeats_on_the_table(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op6_suffix_dedup"](spark, data).collect()
    assert by_text((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == by_text(brute.repeats(docs))


# Near duplicates


def check_near(frame, docs):
    got = minhash.near_duplicates(frame).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.near(docs))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates(odd, odd_docs):
    check_near(odd, odd_docs)
    kept = {d for d, _, c in brute.near(odd_docs) if d == c}
    assert {r.doc_id for r in minhash.deduplicate(odd).collect()} == kept


def test_near_duplicates_in_small_chunks(odd, odd_docs, monkeypatch):
    monkeypatch.setattr(minhash, "LEFT", 3)
    monkeypatch.setattr(minhash, "RIGHT", 5)
    check_near(odd, odd_docs)


def test_every_pair_across_components_is_looked_at(spark):
    """A chain whose ends are far apart, and a group with a common smallest member."""
    rng = random.Random(9)
    base = [f"w{rng.random()}" for _ in range(100)]
    docs = []
    for k in range(60):
        base = list(base)
        base[(k * 17) % 100] = f"n{k}"
        docs.append((rng.randint(0, 10**9), " ".join(base)))
    check_near(spark.createDataFrame(docs, "doc_id bigint, text string"), docs)


def compared(monkeypatch):
    """Pairs that the tasks of each comparison hold."""
    plain, counts = minhash.confirm, []

    def counted(tasks, sets, threshold=minhash.THRESHOLD):
        sides = tasks.groupBy("task").pivot("side", [0, 1]).count().na.fill(0)
        counts.append(sides.agg(F.sum(F.col("0") * F.col("1"))).first()[0] or 0)
        return plain(tasks, sets, threshold)

    monkeypatch.setattr(minhash, "confirm", counted)
    return counts


def test_texts_that_share_a_frame_are_not_compared(spark, monkeypatch):
    """Texts at 0.6: many share a band, none are alike."""
    counts = compared(monkeypatch)
    rng = random.Random(12)
    frame = [f"frame{k}" for k in range(80)]
    docs = [(k, " ".join([*frame, *(f"own{k}x{j}" for j in range(26))])) for k in range(2000)]
    docs += [(5000 + k, docs[k][1] + " more") for k in range(0, 40)]
    rng.shuffle(docs)
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {d: d - 5000 if d >= 5000 else d for d, _ in docs}
    assert counts[-1] < 2000  # of two million pairs


def test_prefixes_of_sets_at_the_threshold_meet():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, minhash.COUNTERS)
    for _ in range(400):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        kept = a[rng.random(len(a)) < rng.choice([0.8, 0.9, 1.0])]
        b = np.union1d(kept, rng.integers(0, 1 << 62, int(rng.integers(0, 9))).astype(np.uint64))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 75 * len(np.union1d(a, b)):
            continue
        (large, _), (small, short) = (
            minhash.prefixes(s, counts) for s in sorted((a, b), key=len, reverse=True)
        )
        assert np.isin(small[:short], large).any()


def test_long_sets_are_dealt_to_more_tasks(spark, monkeypatch):
    """What a task holds is bounded by shingles, not by sets."""
    monkeypatch.setattr(minhash, "LEFT_SHINGLES", 400)
    rng, docs = random.Random(9), []
    base = [f"w{rng.random()}" for _ in range(100)]
    for k in range(60):
        base = list(base)
        base[(k * 17) % 100] = f"n{k}"
        docs.append((rng.randint(0, 10**9), " ".join(base)))
    check_near(spark.createDataFrame(docs, "doc_id bigint, text string"), docs)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(200, 260)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(40)]
    parent = {x: x for pair in links for x in pair}
    for _ in range(len(parent)):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    expected = {k: v for k, v in parent.items() if any(k in p and p[0] != p[1] for p in links)}
    assert {r.id: r.label for r in got} == expected


# Personal data


def odd_personal():
    rng = random.Random(3)
    bits = ["+", "1", "4", "9", "0", " ", "-", ".", "(", ")", "@", "a", "b.c", "_", "%", "255", "300"]
    bits += ["4111111111111111", "é", "🙂", "\n", "+1 (988) 555-2485"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [
        None, "", "a@b.com_x@c.org.d@e.f x", "9" * 30000, "a" * 100000 + "@", "1 " * 20000,
        "x@" + "a." * 8000, "+1" + "(" * 50000, "1.2.3.999.5.6.7.8", "1.2.3.4" * 500,
    ]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def model(spark, data):
    return pii.fit(spark.read.parquet(f"{data}/documents.parquet"))


def test_personal_base_spans(spark, model):
    docs = odd_personal()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)
    got = pii.find(frame, model).select("doc_id", pii.digest("base_spans"), pii.digest("spans")).collect()
    assert {r[0]: r[1] for r in got} == {d: brute.personal(t) for d, t in docs}
    for r in got:
        assert not set(r[1].split(",")) - set(r[2].split(",")) or not r[1]


def test_personal_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = {d: brute.personal(t) for d, t in docs}
    for r in QUERIES["op9_pii"](spark, data).collect():
        base = expected[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            base.count(f"{k}:") for k in ("email", "ip", "card", "phone")
        )


def test_redaction(spark, model):
    docs = [(1, "é mail bob@x.org, 4111111111111111 or +1 (988) 555-2485."), (2, None), (3, "plain"), (4, "")]
    got = pii.redact(spark.createDataFrame(docs, "doc_id bigint, text string"), model).collect()
    assert {r.doc_id: r.text for r in got} == {
        1: "é mail [EMAIL], [CARD] or [PHONE].", 2: None, 3: "plain", 4: "",
    }


def test_added_spans(spark, model):
    docs = [(1, "call (312) 555-1234 now"), (2, "on 2024-11-12 10:22 it"), (3, "plain words only")]
    got = pii.find(spark.createDataFrame(docs, "doc_id bigint, text string"), model)
    assert {r[0]: r[1] for r in got.select("doc_id", pii.digest("spans")).collect()} == {1: "phone:5:19", 2: "", 3: ""}


def test_added_spans_of_every_kind(spark, model):
    """Formats and words that training does not see."""
    for kind, (precision, recall, added, wanted) in pii.measure(spark, model).items():
        if kind == "ip":  # all that looks like one is a base span
            assert (added, wanted) == (0, 0)
        else:
            assert precision >= 0.95 and recall >= 0.9 and wanted >= 40, kind
    texts = {
        "call (020) 7946-0958 or": "phone:5:20", "at 020 7946 0958 x": "phone:3:16", "ssn 078-05-1120 x": "id:4:15",
        "host 2001:db8::1 up": "ipv6:5:16", "api_key = 'sk9vQ2mZx81LpTn4RbYw7CdE'": "secret:11:35",
        "at 12:30:45 on 2024-11-05 10:22:33": "", "commit 4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e": "",
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r[0]: r[1] for r in pii.find(frame, model).select("text", pii.digest("spans")).collect()}
    assert got == texts


def test_trees_add_spans_to_the_table(spark, model):
    """Secrets of the table have no base rule; all of them are found, and redacted."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pii.find(docs, model).select("text", F.explode(F.array_except("spans", "base_spans")).alias("s"))
    secrets = found.where("s.kind = 'secret'").select(F.expr("substring(text, s.start + 1, s.end - s.start)")).collect()
    assert len(secrets) > 0 and all(len(r[0]) == 40 for r in secrets)
    clean = pii.redact(docs, model)
    assert clean.where("lower(text) RLIKE 'token = \"[0-9a-f]{40}'").count() == 0


def test_thresholds_rest_on_spans_that_can_be_added(spark, monkeypatch):
    """A bounded number of spans reaches the driver, and those beside base spans are no evidence."""
    calls = []
    plain = pii.calibrated
    monkeypatch.setattr(pii, "SPANS", 30)
    monkeypatch.setattr(pii, "calibrated", lambda *a: calls.append(a) or plain(*a))
    # One very long text, and many with base spans.
    docs = [(0, " ".join(f"{k % 900 + 100}-{k % 700 + 200}-{k + 1000}" for k in range(3000)))]
    docs += [(k, f"mail me{k}@host.org or +1 (312) 555-{k + 1000}") for k in range(1, 200)]
    pii.fit(spark.createDataFrame(docs, "doc_id bigint, text string"))
    kinds, y, score, use = calls[0]
    assert all((kinds == k).sum() <= 2 * pii.SPANS for k in range(len(pii.ALL_KINDS)))
    assert use.any() and not use[kinds == pii.KINDS.index("email")].all()


def test_base_spans_do_not_loosen_a_threshold():
    import numpy as np

    kinds, score = np.zeros(110), np.array([0.9] * 100 + [0.7] * 10)
    y, free = np.array([1.0] * 100 + [0.0] * 10), np.array([False] * 100 + [True] * 10)
    assert pii.calibrated(kinds, y, score, free) == [2.0] * len(pii.ALL_KINDS)
    assert pii.calibrated(kinds, y, score, free | True)[0] > 0.7


def test_trees_and_thresholds_rest_on_every_row(spark, monkeypatch):
    """Only the last rows by the hash that a sample once went by hold addresses."""
    calls = []
    plain = pii.calibrated
    monkeypatch.setattr(pii, "calibrated", lambda *a: calls.append(a) or plain(*a))
    ids = [r.id for r in spark.range(2600).orderBy(F.xxhash64("id"), "id").collect()]
    docs = [(k, "at 5 x" if n < 2000 else f"host 10.0.0.{n % 256} up") for n, k in enumerate(ids)]
    docs += [(None, "host 10.0.0.1 up")] * 2 + [(9000, None), (9001, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    pii.fit(frame)
    kinds, y, _, _ = calls[0]
    assert ((kinds == pii.KINDS.index("ip")) & (y == 1)).any()
    counted = pii.evidence(frame).where("NOT made").groupBy("kind", "hit", "y").agg(F.sum("n")).collect()
    assert list(map(tuple, counted)) == [(pii.KINDS.index("ip"), True, True, 602)]


def test_a_large_table_weighs_as_much_as_a_bounded_one(spark):
    rows = [(True, 3, False, 400), (False, 3, False, 50_000), (False, 0, True, 9_000_000), (False, 6, False, 7)]
    frame = spark.createDataFrame(rows, "made boolean, kind int, hit boolean, n bigint")
    weight = pii.weights(frame, 4 * pii.TEXTS)
    assert weight[1, 3, 0] == pytest.approx(pii.SPANS / (400 + 12_500))
    assert weight[0, 3, 0] == pytest.approx(weight[1, 3, 0] / 4)
    assert weight[0, 0, 1] * 9_000_000 == pytest.approx(pii.SPANS)
    assert weight[0, 6, 0] == 0.25 and (pii.weights(frame.where("n = 7"), 9) == 1).all()


# Benchmark passages


def test_leaks(spark, data):
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(9001, "just three words"), (9002, ""), (9003, None)]
    rng = random.Random(1)
    docs = [(k, d.text) for k, d in enumerate(spark.read.parquet(f"{data}/documents.parquet").limit(60).collect())]
    for k in range(300):
        passage = rng.choice(items[:-3])[1].split()[rng.choice([0, 0, 0, 1, 2, 3]) :]
        for _ in range(rng.choice([0, 0, 1, 2])):
            passage[rng.randrange(len(passage))] = "zzz"
        around = rng.choice(docs[:60])[1].split()[:100]
        at = rng.randrange(len(around) + 1)
        docs.append((1000 + k, " ".join(around[:at] + passage + around[at:])))
    docs += [(5000, None), (5001, ""), (5002, "We say: JUST three words!"), (5003, items[0][1] * 2)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = {d: brute.leaks(t, items) for d, t in docs}
    got = decontaminate.find_leaks(frame, bench).collect()
    assert {r.doc_id: {x.item_id for x in r.leaks} for r in got} == expected
    clean = decontaminate.decontaminate(frame, bench).collect()
    assert {r.doc_id for r in clean} == {d for d, found in expected.items() if not found}


def test_short_items_match_only_whole_texts(spark, tmp_path):
    items = [(1, "Yes"), (2, "New York!"), (3, "one two three four five six"), (4, "- "), (5, None)]
    texts = ["yes, it is", "Yes.", "we like New York a lot", "new york", "x one two three four five six x", "", None]
    docs = [(k, t, "en", "a", len(t or "")) for k, t in enumerate(texts)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op1_decontaminate"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.item_ids for r in got} == {0: [], 1: [1], 2: [], 3: [2], 4: [3], 5: [], 6: []}
    left = corpus_pipeline.benchmark_stage(spark, frame, str(tmp_path)).collect()
    assert {r.doc_id for r in left} == {0, 2, 5, 6}
    short = decontaminate.short_items(bench).select("item_id", "n_words").collect()
    assert sorted(map(tuple, short)) == [(1, 1), (2, 2)]


def edited(rng, words):
    """A passage with words replaced, dropped or put in, or cut at an end."""
    words = list(words)
    for _ in range(rng.choice([1, 1, 2, 3])):
        at, kind = rng.randrange(len(words)), rng.randrange(4)
        if kind == 0:
            words[at] = "zzz"
        elif kind == 1:
            del words[at]
        elif kind == 2:
            words.insert(at, "yyy")
        else:
            cut = rng.randrange(1, 2 + len(words) // 8)
            words = words[cut:] if at % 2 else words[:-cut]
    return words


def leak_pairs(spark, bench, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = decontaminate.find_leaks(frame, bench, **options).collect()
    return {(r.doc_id, x.item_id) for r in rows for x in r.leaks}


def test_recall_of_edited_passages_rests_on_the_blocks(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(12, 90))] for _ in range(40)]
    items = [(k, " ".join(p)) for k, p in enumerate(passages)]
    docs = []
    for k in range(600):
        around = [rng.choice(vocabulary) for _ in range(60)]
        docs.append((k, " ".join(around[:30] + edited(rng, rng.choice(passages)) + around[30:])))
    want = {(d, i) for d, t in docs for i in brute.leaks(t, items)}
    assert 150 < len(want) < 500  # the others are below the threshold
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = leak_pairs(spark, bench, docs)
    assert got <= want and len(got) >= 0.99 * len(want)
    # With fewer bits there are fewer blocks, and passages are missed.
    fewer = leak_pairs(spark, bench, docs, bits=64)
    assert fewer < got and len(fewer) < 0.97 * len(want)


def test_windows_of_fingerprints_equal_one_by_one():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 62, 80).astype(np.uint64)[rng.integers(0, 80, 300)]
    starts = np.array([0, 3, 17, 260])
    found = decontaminate.fingerprints(decontaminate.bit_sums(words), starts, 40)
    for row, start in zip(found, starts, strict=True):
        alone = decontaminate.fingerprints(decontaminate.bit_sums(words[start : start + 40]), np.zeros(1, np.int64), 40)
        assert row.tolist() == alone[0].tolist()


def test_fingerprints_within_the_radius_share_a_block():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, decontaminate.BITS).astype(np.uint8)
    radius = decontaminate.BITS // decontaminate.WIDTH - 1
    mine = decontaminate.block_keys(np.packbits(bits)[None], 5, 40)[0]
    for _ in range(200):
        other = bits.copy()
        other[rng.choice(decontaminate.BITS, radius, replace=False)] ^= 1
        assert np.isin(decontaminate.block_keys(np.packbits(other)[None], 5, 40)[0], mine).any()
    assert not np.isin(decontaminate.block_keys(np.packbits(bits)[None], 5, 41)[0], mine).any()


def test_plan_does_not_grow_with_the_items(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    copies = bench.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(99))))
    many = copies.select((F.col("item_id") + F.col("k") * 1000).alias("item_id"), F.concat("text", F.lit(" w"), "k").alias("text"))

    def nodes(items):
        plan = decontaminate.find_leaks(docs, items)._jdf.queryExecution().optimizedPlan().toString()
        return len(plan.splitlines())

    assert nodes(bench) == nodes(many)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST, 0])
def test_items_without_an_id_and_of_one_id(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST", most)  # beyond it the list is not broadcast
    passage = " ".join(f"w{k}" for k in range(30))
    other = " ".join(f"v{k}" for k in range(30))
    items = [(None, passage), (7, passage), (7, passage), (8, other), (8, f"{other} end"), (9, "- ")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(1, f"before {passage} behind"), (2, f"{other} end"), (3, f"x {other} x {other} end"), (4, "w1 w2")]
    rows = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    assert {r.doc_id: [(x.item_id, x.similarity, x.word) for x in r.leaks] for r in rows} == {
        1: [(None, 1.0, 1), (7, 1.0, 1)], 2: [(8, 1.0, 0)], 3: [(8, 1.0, 1)], 4: []
    }


# Sharding


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_have_exact_sizes(odd, shards):
    got = sharding.shuffle_into_shards(odd, shards, blocks=16, bins=4).collect()
    assert len(got) == odd.count()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_query(spark, data):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    first = sorted(QUERIES["op7_sharding"](spark, data).collect())
    assert {r.doc_id: (r.size, r.text_crc32) for r in first} == {
        d: (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in docs.items()
    }
    assert first == sorted(QUERIES["op7_sharding"](spark, data).collect())
    # The law of the query: shards differ by one row at most, slots have no gaps.
    assert {(r.law, r.grown_shard) for r in first} == {("rows", None)}
    slots = {k: sorted(r.slot for r in first if r.shard == k) for k in range(8)}
    assert sum(map(len, slots.values())) == len(docs)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(s == list(range(len(s))) for s in slots.values())


def test_equal_rows_are_dealt_to_all_blocks(spark):
    """A third of the rows are one row; it fills no block and every shard."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id")).repartition(5)
    keyed = rows.select(F.struct("id").alias("row"), F.xxhash64("id").alias("key"), F.xxhash64(F.lit(1), "id").alias("check"))
    per_block = [r["count"] for r in sharding.dealt_repeats(keyed, 6000, 64).groupBy("block").count().collect()]
    assert sum(per_block) == 6000 and len(per_block) == 64 and max(per_block) < 3 * 6000 / 64
    got = sharding.shuffle_into_shards(rows, 4).collect()
    assert sorted(r.id for r in got) == sorted(r.id for r in rows.collect())
    for k in range(4):
        mine = [r for r in got if r.shard == k]
        assert sorted(r.slot for r in mine) == list(range(1500))
        assert 400 < sum(r.id == -1 for r in mine) < 600


def test_columns_of_maps_pass_through(spark):
    rows = spark.range(50).select("id", F.create_map(F.lit("a"), "id").alias("m"), F.array(F.create_map("id", F.lit(1))).alias("n"))
    got = sharding.shuffle_into_shards(rows, 3).collect()
    assert sorted(r.id for r in got) == list(range(50)) and all(r.m == {"a": r.id} and r.n == [{r.id: 1}] for r in got)


def test_blocks_follow_the_rows():
    assert [sharding.parts_for(n) for n in (0, 10**6, 10**8, 10**9, 10**12)] == [64, 64, 100, 1000, 2048]


def test_the_shuffle_is_uniform(spark):
    """Every row is equally likely in every shard, near or far from its neighbours."""
    rows = spark.range(64)
    hits = [[0] * 4 for _ in range(64)]
    for seed in range(40):
        for r in sharding.shuffle_into_shards(rows, 4, seed, blocks=4, bins=2).collect():
            hits[r.id][r.shard] += 1
    chi = sum((h - 10) ** 2 / 10 for row in hits for h in row)
    assert 120 < chi < 270  # 192 degrees of freedom


def test_matrix_sums():
    import numpy as np

    blocks = np.array([0, 5, 1000, 3_000_000_000, 17])
    bins = sharding.bin_sizes(int(blocks.sum()), 3, 4)
    matrix = sharding.draw_matrix(blocks, bins, 1)
    assert (matrix.sum(0) == bins).all() and (matrix.sum(1) == blocks).all() and (matrix >= 0).all()


def test_small_draws_from_large_populations_keep_the_law():
    import numpy as np

    rng = np.random.default_rng(3)
    draws = [sharding._hypergeometric(rng, 1_000_000, 5_000_000_000, 1000) for _ in range(5000)]
    assert abs(np.mean(np.array(draws) == 0) - 0.8187) < 0.025  # a rounded normal gives 0.75


@pytest.mark.parametrize(("good", "bad", "n"), [(7, 5, 6), (3, 40, 20), (40, 3, 41), (500, 900, 300)])
def test_both_ways_to_draw_have_one_law(good, bad, n):
    from math import comb

    import numpy as np

    rng = np.random.default_rng(4)
    got = np.bincount([sharding._inverted(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1)
    law = np.array([comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(n + 1)])
    assert got.sum() == 20_000 and not got[law == 0].any()
    assert np.abs(np.cumsum(got) / 20_000 - np.cumsum(law)).max() < 0.015


def test_large_draws_have_the_mean_and_spread_of_the_law():
    import numpy as np

    rng = np.random.default_rng(5)
    good, bad, n = 3_000_000_000, 6_000_000_000, 900_000_000
    draws = np.array([sharding._hypergeometric(rng, good, bad, n) for _ in range(400)], dtype=float)
    spread = np.sqrt(n / 3 * 2 / 3 * 0.9)
    assert abs(draws.mean() - n / 3) < 5 * spread / 20 and 0.8 < draws.std() / spread < 1.2


# Tokens


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def encoded(codec, texts):
    ids, counts = codec.encode_batch(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


ODD_TEXTS = [
    "", "a" * 5000, "Hello <|endoftext|>WÖRLD ΑΣ ß İ don't it'S they'LL \u0085 \x1c x　y 你好 🙂🙂 é é ½ ②",
    "!" * 3000, "<|startoftext|><|endoftext|>", "xY9" * 800, "the cat's </w> w>", "naïve <|endoftext", "İΣ", "a\x1cb \x1f\x1e, c",
]


def test_tokens_equal_the_library():
    rng = random.Random(1)
    codec = bpe.codec(bpe.tokenizer_path())
    texts = ODD_TEXTS + ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 14))) for _ in range(20000)]
    texts += ["".join(t.replace("</w>", "") for t in rng.sample(list(codec.vocab), 3)) for _ in range(2000)]
    lib = library()
    expected = lib.encode_batch(texts, add_special_tokens=False)
    assert encoded(codec, texts) == [e.ids for e in expected]
    # The pairs that are told apart are those that the exact merging leaves apart.
    pairs = [(a, b) for e in expected[:3000] for a, b in zip(e.ids, e.ids[1:], strict=False)]
    assert pairs


def test_words_of_any_length_are_proposed_and_merged_alike():
    codec, lib = bpe.codec(bpe.tokenizer_path()), library()
    rng = random.Random(5)
    letters = [codec.vocab[c] for c in "etaoins"]
    for n in (1, 2, 30, 199):
        words = np.array([[rng.choice(letters) for _ in range(n)] for _ in range(20)])
        rows = codec.merge(words)
        assert [r[r >= 0].tolist() for r in rows] == [codec.merge_long(w.tolist()) for w in words]
    texts = ["".join(rng.choice(kinds) for _ in range(n)) for n in (63, 64, 65, 1500, 40000) for kinds in ("ab", "etaoinsh", "a")]
    assert encoded(codec, texts) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_long_words_are_speculated(monkeypatch):
    """Verification alone decides who is merged: a word of single letters that no merge joins
    is not, however long."""
    codec = bpe.Codec(bpe.tokenizer_path())
    text = "\u0e33" * 3000
    proposed, counts = codec.propose(
        np.append(np.frombuffer(text.encode(), np.uint8), bpe.LAST).astype(np.int64), np.array([0])
    )
    assert counts.tolist() == [len(proposed)]
    called = []
    exact = codec.merge_long
    monkeypatch.setattr(codec, "merge_long", lambda word: called.append(len(word)) or exact(word))
    want = library().encode(text, add_special_tokens=False).ids
    assert encoded(codec, [text]) == [want] and bool(called) == (proposed.tolist() != want)


def test_every_code_point():
    """Tables of this Python where it knows a letter, those of the library elsewhere."""
    codec, lib = bpe.codec(bpe.tokenizer_path()), library()
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 100_000):
        texts = [f"a{c}b" for c in every[at : at + 100_000]]
        expected = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert encoded(codec, texts) == expected


def test_store_is_emptied_and_results_stay(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 30)
    monkeypatch.setattr(bpe, "CHUNK", 100)
    codec = bpe.Codec(bpe.tokenizer_path())
    texts = [" ".join(f"w{i * k}x" for k in range(20)) for i in range(60)]
    expected = library().encode_batch(texts, add_special_tokens=False)
    assert encoded(codec, texts) == [e.ids for e in expected]


def test_token_query(spark, data):
    lib, docs = library(), spark.read.parquet(f"{data}/documents.parquet").collect()
    expected = {}
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        expected[d.doc_id] = (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op10_bpe"](spark, data).collect()} == expected
