"""Alignment of tokenizers, fill-in-middle and exact duplicates against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetable.llm import exact_dedup, fill_middle, token_align
from facetable.llm.bpe import byte_letters, tokenizer_path


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact duplicates ---------------------------------------------------------------


def same_texts(docs, best):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    out = []
    for d, t in docs:
        ids = [i for i in groups[t or ""] if i is not None]
        keep = best(ids) if ids else None
        out.append((d, keep, len(groups[t or ""]), d == keep, sha(t or "")))
    return Counter(out)


@pytest.mark.parametrize("keep, best", [("largest", max), ("smallest", min)])
def test_exact_duplicates(spark, odd_docs, keep, best):
    docs = odd_docs + [(None, None), (None, "only without id"), (None, "only without id"), (10, odd_docs[3][1])]
    docs += [(50000 + k, "one text of a third") for k in range(80)] + [(-1, "one text of a third"), (77, "A"), (78, "a")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    for fan, rounds in ((16, 3), (2, 3), (3, 1)):
        rows = exact_dedup.mark(frame, keep, fan=fan, rounds=rounds)
        got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows.collect())
        assert got == same_texts(docs, best)


def test_exact_deduplicate_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "doc_id bigint, text string, run int")
    assert sorted(exact_dedup.deduplicate(docs).collect()) == [(2, "a", 2), (3, "b", 3)]
    with pytest.raises(ValueError):
        exact_dedup.deduplicate(docs.withColumnRenamed("run", "kept"))


def test_no_entry_gathers_more_than_the_fan(spark):
    """One text in all rows: each round merges at most ``FAN`` entries of it."""
    runs = spark.range(4096).select(
        F.col("id").cast("int").alias("run"), F.lit(b"d").alias("digest"), F.lit(1).alias("bytes"),
        F.lit(1).alias("check"), F.col("id").alias("keep"), F.lit(1).alias("rows"),
    )
    for left in (256, 16, 1):
        most = runs.groupBy(F.floor(F.col("run") / 16)).count().agg(F.max("count")).first()[0]
        assert most == exact_dedup.FAN
        runs = exact_dedup.merge_round(runs, F.max("keep"))
        assert runs.count() == left
    assert runs.first().asDict() | {"digest": None} == {
        "run": 0, "digest": None, "bytes": 1, "check": 1, "keep": 4095, "rows": 4096
    }


def test_entries_that_differ_in_length_or_check_stay_apart(spark):
    rows = [(0, b"d", 1, 1, 1, 1), (1, b"d", 2, 1, 2, 1), (2, b"d", 1, 2, 3, 1), (3, b"d", 1, 1, 4, 1)]
    runs = spark.createDataFrame(rows, "run int, digest binary, bytes int, check bigint, keep bigint, rows bigint")
    assert sorted(r.keep for r in exact_dedup.merge_round(runs, F.max("keep")).collect()) == [2, 3, 4]


def test_exact_dedup_is_native_and_leaves_texts_unshuffled(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    plan = exact_dedup.mark(docs).select("doc_id", "keep_id", "kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "text#" not in line


# --- fill-in-middle -----------------------------------------------------------------


def moved(doc_id, text):
    text = text or ""
    unit = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(unit)
    digest = sha(f"1:{'null' if doc_id is None else doc_id}")
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(unit[:p]), "".join(unit[p:m]), "".join(unit[m:])
    if h[3] % 100 < 20:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_fill_middle(spark, odd_docs):
    rng = random.Random(3)
    docs = odd_docs + [(20 + k, "x" * k + t) for k, t in enumerate(("<P>", "<S>", "<M>a", "<", "P>", "<P", "𝒜b\n\0c", "é"))]
    docs += [(1000 + k, "".join(rng.choice("<PSM>a é🙂\n") for _ in range(rng.randint(0, 40)))) for k in range(400)]
    docs += [(None, "no id but text"), (None, None), (9999, "long " * 100000), (9999, "long " * 100000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    rows = fill_middle.invert(fill_middle.transform(frame)).collect()
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows)
    assert got == Counter((d, *moved(d, t), t or "") for d, t in docs)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 200])
def test_rotations(n, monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 8)
    text = bytes(i % 251 for i in range(n))
    for a in range(0, n + 1, 1 + n // 9):
        for b in range(a, n + 1, 1 + n // 9):
            buf = bytearray(text)
            fill_middle.rotate(buf, a, b, n)
            assert bytes(buf) == text[:a] + text[b:] + text[a:b]
            for form in ("psm", "spm"):
                whole = bytes(c % 59 for c in text)  # no sentinel: '<' is 60
                assert fill_middle.restore(bytes(fill_middle.arrange(whole, a, b, form)), form) == whole


# --- alignment ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain_tokens():
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    path = tokenizer_path(token_align.TOKENIZER_A)
    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(token_align.TOKENIZER_B))
    value = {c: k for k, c in enumerate(byte_letters())}
    names = {i: t for t, i in json.load(open(path))["model"]["vocab"].items()}

    def of(text):
        if not text:
            return [], []
        x = [(i, bytes(value[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            hexed = re.fullmatch("<0x(..)>", piece)
            y.append((i, bytes.fromhex(hexed[1]) if hexed else piece.replace("▁", " ").encode()))
        whole = b" " + text.encode()
        return (x, y) if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else ([], [])

    return of


def aligned(docs, of):
    """All columns but doc_id, in the order of ``docs``."""
    found, counts = [], Counter()
    for _, text in docs:
        x, y = of(text)
        ends = []
        for side in (x, y):
            at, out = 0, []
            for _, t in side:
                at += len(t)
                out.append(at)
            ends.append(out)
        groups, k, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(e, k) + 1, ends[1].index(e, j) + 1
            groups.append(([i for i, _ in x[k:p]], [i for i, _ in y[j:q]]))
            k, j = p, q
        links = Counter((a, b) for g, h in groups for a in g for b in h)
        counts.update(links.keys())
        found.append((len(x), len(y), groups, links))
    top = Counter()
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    for n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield (
            n_a, n_b, len(groups), sum(links.values()),
            sum(n for k, n in links.items() if counts[k] == top[k[0]]),
            sum(n * counts[k] for k, n in links.items()), sha(text) if text else "",
        )


@pytest.fixture(scope="module")
def token_docs(odd_docs):
    docs = [d for d in odd_docs if len(d[1] or "") < 5000]
    more = [
        "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", " leading", "trailing ", "  two  blanks\t\n\n", "ﬁ ligature",
        "日本語のテキスト", "🙂🙃" * 20, "\0 zero", "é e", "a" * 300, "12345 6789", "don't we'll", " x", "ｆｕｌｌ",
        " " * 3000 + "x" + "\n" * 1200, "new letters \u1c89 \ua7cb \U00032400 here", "𞤀 \u0600 ǅ Ⅷ ² ½ \u00a0\u0085\u2028x",
    ]
    return docs + [(700 + k, t) for k, t in enumerate(more)] + [(None, "no id"), (12, "one two"), (12, "one two")]


@pytest.mark.parametrize("slice_bytes", [300, token_align.SLICE])
def test_alignment(spark, token_docs, plain_tokens, slice_bytes):
    frame = spark.createDataFrame(token_docs, "doc_id bigint, text string").coalesce(2)
    rows = token_align.align(frame, slice_bytes=slice_bytes).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = Counter((r.doc_id, *[r[c] for c in names]) for r in rows)
    assert got == Counter((d, *rest) for (d, _), rest in zip(token_docs, aligned(token_docs, plain_tokens), strict=True))
    assert sum(r.n_a == 0 for r in rows) > 3  # NULL, empty, normalised by B


def test_both_libraries_of_a_agree_on_every_letter_that_is_known():
    both = token_align.pair(tokenizer_path(token_align.TOKENIZER_A), tokenizer_path(token_align.TOKENIZER_B))
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b 1{c} {c}{c}" for c in every if both.is_plain(c)]
    assert len(texts) > 250_000
    want = [e.ids for e in both.exact.encode_batch_fast(texts, add_special_tokens=False)]
    assert [both.fast.encode_ordinary(t) for t in texts] == want
    assert both.is_plain(" " * 999) and not both.is_plain("a" + " " * 1000) and not both.is_plain("\u1c89")


def test_records_are_cut_into_parts(monkeypatch):
    both = token_align.pair(tokenizer_path(token_align.TOKENIZER_A), tokenizer_path(token_align.TOKENIZER_B))
    texts = ["🙂 é ü " * 40, "plain words here", "", "日本 " * 9]
    groups = token_align.Groups(both, *both.encode(texts))
    want = [x.tolist() for x in groups.records()]
    monkeypatch.setattr(token_align, "LINKS", 3)
    assert [x.tolist() for x in groups.records()] == want
    assert sum(want[2]) == groups.n_links.sum()


@pytest.mark.parametrize("block, counted", [(1, 1), (3, 10), (1024, 1 << 18)])
def test_runs_merge_to_exact_counts(monkeypatch, block, counted):
    monkeypatch.setattr(token_align, "BLOCK", block)
    monkeypatch.setattr(token_align, "COUNTED", counted)
    rng, total, runs = random.Random(5), Counter(), []
    for _ in range(9):
        run = {rng.randrange(1 << 31) if rng.random() < 0.3 else rng.randrange(40): rng.randint(1, 9) for _ in range(50)}
        total.update(run)
        runs.append(sorted(run.items()))
    heads = [token_align.pack_head(*np.array(run).T) for run in runs]
    counts, found = [[] for _ in runs], {}
    for run, each, code, n in token_align.merge_heads(heads):
        for r, c in zip(run, each, strict=True):
            counts[r].append(int(c))
        assert not found or code[0] > max(found)  # A-major order
        found.update(zip(code.tolist(), n.tolist(), strict=True))
    assert found == total
    assert counts == [[total[c] for c, _ in run] for run in runs]


def test_alignment_of_one_pair_in_all_documents(spark, plain_tokens):
    """A hot pair travels once per slice: its count is that of all documents."""
    docs = [(k, "the same") for k in range(300)] + [(300, "the other")]
    rows = token_align.align(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)).collect()
    want = {d: w for (d, _), w in zip(docs, aligned(docs, plain_tokens), strict=True)}
    assert all(tuple(r)[1:] == want[r.doc_id] for r in rows) and len(rows) == 301
