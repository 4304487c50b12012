import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

import corpus_pipeline
from aerolith.llm import bpe, mixing, quality
from test_jaccard import brute as brute_links

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ORDER = ["quality_rules", "near_duplicates", "repeated_passages", "mixture", "tokens"]


def brute_pipeline(rows):
    """rows: (doc_id, text, source), ids unique."""
    kept = []
    for i, t, s in rows:
        m = dict(zip(quality.MEASURES, quality.measure_text((t or "").encode()), strict=True))
        if not any(eval(c.replace(" OR ", " or "), {}, m) for _, c in quality.RULES):
            kept.append((i, t, s))
    heads = {r[3] for r in brute_links([(i, t) for i, t, _ in kept])}
    kept = [r for r in kept if r[0] in heads]
    cut = []
    data = [t.encode() for _, t, _ in kept]
    counts, strings = defaultdict(int), defaultdict(int)
    for t in data:
        for k in range(len(t) - 399):
            counts[t[k : k + 400]] += 1
        words = WORD.findall(t)
        for k in range(len(words) - 50):
            strings[tuple(words[k : k + 51])] += 1
    for (i, _, s), t in zip(kept, data, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - 399):
            if counts[t[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        spans = [m.span() for m in WORD.finditer(t)]
        for k in range(len(spans) - 50):
            if strings[tuple(t[a:b] for a, b in spans[k : k + 51])] > 1:
                a, b = spans[k][0], spans[k + 50][1]
                gone[a:b] = b"\1" * (b - a)
        cut.append((i, bytes(b for b, g in zip(t, gone, strict=True) if not g).decode(errors="ignore"), s))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in cut}
    by_source = defaultdict(list)
    for i, t, s in cut:
        by_source[s].append((hashlib.md5((str(i) + hashlib.md5(t.encode()).hexdigest()).encode()).hexdigest(), i, t))
    names = sorted(by_source)
    size = {s: sum(sizes[i] for _, i, _ in by_source[s]) for s in names}
    total = sum(size.values())
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:
        level = (total - sum(3 * size[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        over = [s for s in names if s not in full and level * weight[s] >= 3 * size[s]]
        if not over:
            break
        full.update(over)
    for s in names:
        target[s] = 3.0 * size[s] if s in full else level * weight[s]
    out = []
    buckets = -(-len(cut) // mixing.BUCKET_ROWS)
    for s in names:
        words = min(int(target[s] + 0.5), 3 * size[s])
        at = 0
        stream = sorted(by_source[s], key=lambda x: (int(x[0][:15], 16) % buckets, x[0]))
        for epoch in range(3):
            for _, i, t in stream:
                n = min(sizes[i], words - at)
                if n > 0:
                    out.append((i, t if n == sizes[i] else re.match(r"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){%d}" % n, t)[0]))
                at += sizes[i]
    ranks = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = []
    for i, t in out:
        ids = enc.encode_ordinary(t)
        final.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(final)


def documents(rng):
    vocab = ["".join(rng.choice("abcdefgü") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [text(90) for _ in range(3)] + [text(55) for _ in range(3)]
    out = []
    for _ in range(120):
        base = text(rng.randint(40, 200))
        if rng.random() < 0.3:
            base[20:20] = rng.choice(passages)
        out.append(" ".join(base))
        if rng.random() < 0.2:
            base[rng.randrange(len(base))] = "edit"
            out.append("\n".join(base))
        if rng.random() < 0.1:
            out.append(out[-1])
    out += ["junk ### " * 80, "AB CD " * 90, "", "word " * 5000]
    return [Row(doc_id=k, text=t, lang="xx", source=rng.choice(["a", "b", "c", "é", "zz"]), n_chars=len(t)) for k, t in enumerate(out)]


def test_stages_and_columns():
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER


def test_against_brute_force(spark, tmp_path):
    rows = documents(random.Random(11))
    spark.createDataFrame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == brute_pipeline([(r.doc_id, r.text, r.source) for r in rows])
    assert len({g[0] for g in got}) > 50


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3, [(1, "one two", "en", None, 7)]])
def test_empty_null_and_rejected(spark, tmp_path, rows):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_each_stage_handles_nulls(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    docs = spark.createDataFrame([(None, "a b c d e f g " * 20, None, None, None, 1), (2, None, "en", "s", 3, 2), (2, None, "en", "s", 3, 2)], kind)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "tokens" or out.columns == list(corpus_pipeline.COLUMNS)
        assert out.count() == {"quality_rules": 0, "near_duplicates": 3, "repeated_passages": 3, "mixture": 1, "tokens": 3}[name]


def test_passages_of_51_words_below_400_bytes_go(spark, tmp_path):
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefgü") for _ in range(rng.randint(2, 6)))
    rows, passages = [], {}
    for k in range(30):
        n = [50, 51, 52, 55, 60][k % 5]
        passages[k] = [word()[:4] for _ in range(n)]
        for gap in (" ", "\n " if k % 2 else " "):
            head, tail = [f"h{len(rows)}"] + [word() for _ in range(30)], [word() for _ in range(30)] + [f"t{len(rows)}"]
            text = " ".join(head) + " " + gap.join(passages[k]) + "  " + " ".join(tail)
            rows.append((len(rows), text, "xx", "s", len(text), k, " ".join(head), " ".join(tail)))
    assert all(n == 50 or len(" ".join(p).encode()) < 400 for n, p in ((len(p), p) for p in passages.values()))
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, str(tmp_path)).collect()}
    for i, text, _, _, _, k, head, tail in rows:
        if len(passages[k]) < 51:
            assert got[i] == text
        else:
            assert got[i] == f"{head}   {tail}"


def test_a_very_long_text_goes_through_whole(spark, tmp_path):
    text = " ".join(f"w{k * 7919 % 1_000_003}x" for k in range(150_000)) + "."
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    (r,) = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_tokens > 150_000
