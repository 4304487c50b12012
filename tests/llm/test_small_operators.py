import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from aerolith.llm import langid, mixing, quality, urlfilter


def brute_measures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(marked), sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text))


def test_measures_against_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "ü", " ", "\n", "\t", "#", "日", "A", "\x85", " ", "\x1c", "\v"]) for _ in range(rng.randint(0, 120)))
        assert quality.measure_text(text.encode()) == brute_measures(text)


def test_ledger_policies_and_ablation(spark):
    good = " ".join(f"word{k} goes" for k in range(60))
    rows = [(1, good, 9), (2, None, 9), (3, "", 9), (4, "x y z " * 40, 9), (5, good.upper(), 9), (5, good + " ###" * 60, 9), (None, good, 9)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, n_words=n) for i, t, n in rows], "doc_id long, text string, n_words int")
    led = quality.ledger(df, column="led").withColumn("fail_bits", F.col("led.fail_bits")).withColumn("kept", quality.passes(F.col("led.fail_bits")))
    got = [(r.doc_id, r.kept, r.n_words) for r in led.collect()]
    assert sorted(got, key=str) == sorted([(1, True, 9), (2, False, 9), (3, False, 9), (4, False, 9), (5, False, 9), (5, False, 9), (None, True, 9)], key=str)
    found = {r.rule: (r.n_failed, r.n_only, r.n_docs) for r in quality.ablation(led.select("fail_bits")).collect()}
    assert found["too_few_words"][0] == 2 and found["capitals"] == (1, 1, 7) and found["symbols"][1] >= 0
    assert quality.ablation(led.select("fail_bits").where("false")).where("n_docs = 0").count() == len(quality.RULES)
    assert quality.ledger(df.where("false")).count() == 0


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        level = (total - 3 * sum(sizes[s] for s in full)) / max(1, sum(w[s] for s in names if s not in full))
        over = [s for s in names if s not in full and level * w[s] > 3 * sizes[s]]
        if not over:
            return {s: 3.0 * sizes[s] if s in full else level * w[s] for s in names}
        full.update(over)


def test_mixture_reaches_its_targets(spark):
    rng = random.Random(4)
    rows = [Row(doc_id=k, text=" ".join(["w"] * rng.choice([0, 1, 3, 40, 200])), source=rng.choice(["a", "a", "a", "b", "ä", "Z", None, "tiny"] if k else ["tiny"]), size="clash", slot=1) for k in range(600)]
    rows = [r if r.source != "tiny" or r.doc_id % 9 == 0 else Row(**(r.asDict() | {"source": "b"})) for r in rows] + rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, slot int")
    got = mixing.taken(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(r.text.split())
    expected = targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 1, s
    again = {(r.id, r.size, r.source): r.taken for r in mixing.taken(df.repartition(7)).collect()}
    assert sorted(again.values()) == sorted({(r.id, r.size, r.source): r.taken for r in got}.values())


def test_small_sources_beside_a_large_one_reach_their_targets(spark):
    rows = [(k, "w " * 4000, "hot") for k in range(40)] + [(100 + k, "x " * (1 + k % 3), f"site{k:03}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, expected = Counter(), {}
    for r in mixing.taken(df, slot_bits=6).collect():
        taken[r.source] += r.taken
        expected[r.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in expected.items()) and len(expected) == 201
    pieces, placed = mixing.mix(df, slot_bits=6)
    assert {r.slot for r in pieces.select("slot").distinct().collect()} == set(range(64))


def test_repeated_rows_and_clashing_names_in_the_mixture(spark):
    rows = [(None, "a b c", "s", 1, 2)] * 30 + [(2, None, "s", 3, 4), (3, "d e", "t", 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __tie int, __N int")
    got = mixing.repeats(df).collect()
    assert Counter((r.doc_id, r["__tie"], r["__N"]) for r in got)[None, 1, 2] == 29 and set(df.columns) < set(got[0].asDict())
    assert sum(r.turn.taken for r in got if r.source == "s") + sum(r.turn.taken for r in got if r.source == "t") in (91, 92, 93)


def test_mixture_of_nothing(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.taken(spark.createDataFrame([], kind)).count() == 0
    assert [(r.size, r.taken, r.target) for r in mixing.taken(spark.createDataFrame([(1, None, "a"), (None, "", None)], kind)).collect()] == [(0, 0, 0.0)] * 2
    (r,) = mixing.taken(spark.createDataFrame([(1, "one", "a")], kind)).collect()
    assert (r.taken, r.target) == (1, 1.0)


def brute_rule(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def test_url_rules_against_brute_force(spark):
    rng = random.Random(6)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "ö.de", "com.", ""]
    rules = sorted({(h, "/" + rng.choice(["", "e", "en/", "en/x"])): rng.choice(["allow", "block"]) for h in hosts for _ in range(3)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [None, "", "x", "://", "http://", "HTTP://A.COM", "http://a.com/en/x?y#z", "http://u@a.com:80/en/", "http://b.A.com\n/en/", "http://a.com?/en/"]
    urls += [f"http://{rng.choice(['', 'q.', 'b.', 'xa'])}{rng.choice(hosts)}/{rng.choice(['', 'e', 'en/', 'en/x', 'fr'])}" for _ in range(300)]
    urls += [f"http://{'a.' * 100_000}a.com/en/{'x' * 3_000_000}", f"http://{'y' * 2_000_000}.net/", "http://b.a.com/en/"] * 2
    df = spark.createDataFrame([Row(url=u, host="clash", rule=1) for u in urls], "url string, host string, rule int")
    got = sorted(((r.v.host, r.v.path, r.v.rule, r.v.verdict) for r in urlfilter.judge(df, rules, column="v").collect()), key=str)
    assert got == sorted((brute_rule(u, rules) for u in urls), key=str)
    assert {r.v.verdict for r in urlfilter.judge(df, [], column="v", default="block").collect()} == {"block"}
    assert urlfilter.judge(df.where("false"), rules).count() == 0


def test_colliding_digests_are_told_apart(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(urlfilter, "_key", lambda host, path: 7)
    (tmp_path / "r").write_bytes(urlfilter.pack([("a.com", "/", "block"), ("b.com", "/", "allow"), ("b.com", "/", "block")]))
    rules = urlfilter.Rules(str(tmp_path / "r"))
    assert rules.judge([b"a.com", b"b.com", b"c.com"], [b"/x", b"/", b"/"]) == [("a.com/", True), ("b.com/", True), (None, None)]


def test_languages(spark):
    words = {"aa": ["kato", "miru", "sane", "toru"], "bb": ["the", "wind", "stone", "grass"], "cc": ["über", "größe", "straße", "schön"]}
    rng = random.Random(8)
    rows = [Row(doc_id=k, text=" ".join(rng.choice(words[lang]) for _ in range(30)), lang=lang, lang_pred="clash") for k in range(300) for lang in words]
    kind = "doc_id long, text string, lang string, lang_pred string"
    docs = spark.createDataFrame(rows, kind)
    model = langid.fit(docs)
    tests = [("kato sane", "aa"), ("stones windy", "bb"), ("größer straßen", "cc"), (None, "und"), ("", "und"), ("123 !? ²", "und"), ("the" * 4000, "bb")]
    df = spark.createDataFrame([Row(doc_id=k, text=t, lang=None, lang_pred="clash") for k, (t, _) in enumerate(tests)], kind)
    got = {r.doc_id: r.language for r in langid.identify(df, model).collect()}
    assert [got[k].lang_pred for k in range(len(tests))] == [x for _, x in tests]
    assert all(0 <= x.score <= 1 for x in got.values()) and got[3].score == 0
    nothing = langid.fit(docs.where("false"))
    assert {r.language.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def brute_language(training, text):
    """(language, score) by the rules in words: training has (text, language), all of it learned."""
    runs = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    strings = lambda w, n: [w] if n == 0 else list(w) if n == 1 else [f"^{w}$"[k : k + n] for k in range(len(w) + 3 - n)]
    languages = sorted({lang for _, lang in training})
    counts = {(n, lang): Counter(s for t, l in training if l == lang for w in runs(t) for s in strings(w, n)) for n in range(6) for lang in languages}
    kinds = {n: set().union(*(counts[n, lang] for lang in languages)) for n in range(6)}
    log = lambda n, s, lang: math.log(counts[n, lang][s] + 0.5) - math.log(sum(counts[n, lang].values()) + 0.5 * (len(kinds[n]) + 1))

    def of_word(w, lang):
        for n in (0, 5, 4, 3, 2, 1):
            if found := [log(n, s, lang) for s in strings(w, n) if s in kinds[n]]:
                return sum(found) / len(found)
        return 0.0

    words = runs(text or "")
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    sums = {lang: sum(of_word(w, lang) for w in words) for lang in languages}
    best = max(languages, key=lambda lang: (round(sums[lang], 4), -languages.index(lang)))
    return best, 1 / sum(math.exp((sums[lang] - sums[best]) / len(words)) for lang in languages)


def test_languages_against_brute_force(spark):
    rng = random.Random(9)
    letters = {"aa": "kamiuo", "bb": "thewinds", "cc": "üßäkami", "dd": "привет"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 8)))
    vocab = {lang: [word(lang) for _ in range(30)] for lang in letters}
    training = [(" ".join(rng.choice(vocab[lang]) for _ in range(rng.randint(0, 20))), lang) for lang in letters for _ in range(25)]
    docs = spark.createDataFrame([Row(doc_id=None, text=t, lang=lang) for t, lang in training] + [Row(doc_id=1, text=None, lang="aa"), Row(doc_id=2, text="zzz", lang=None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    texts = [" ".join(rng.choice([*vocab[rng.choice(list(letters))], word("aa"), word("dd"), "QQQ", "12", "x_y", "日本"]) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    texts += [None, "", "²½ 12", "qqq", vocab["bb"][0] * 3, "KAMI", "z" * 50_000]  # "qqq": a tie of what nothing is known of
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.language for r in langid.identify(df, model).collect()}
    for k, text in enumerate(texts):
        lang, score = brute_language(training, text)
        assert got[k].lang_pred == lang and got[k].score == pytest.approx(score, abs=1e-4), text


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    right = langid.identify(docs.where(held), langid.fit(docs.where(~held))).agg(F.avg((F.col("language.lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98


def test_many_languages_and_huge_texts_stay_bounded(spark, monkeypatch):
    """Two hundred languages, texts of 20 MB among them: those teach nothing, and are predicted whole."""
    rng = random.Random(10)
    vocab = {f"l{k:03}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{''.join(rng.choice('aeioubdgklm') for _ in range(5))}" for _ in range(6)] for k in range(200)}
    rows = [(k, " ".join(rng.choice(w) for _ in range(20)), lang) for k in range(4) for lang, w in vocab.items()]
    huge = " ".join(vocab["l007"] * 4) + " "
    rows.append((9, huge * (20_000_000 // len(huge)), "l008"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = langid.fit(docs)
    held = sum(x.itemsize * len(x) for e in model.tables for x in (e.language, e.above, e.start))
    assert len(model.languages) == 200 and held < 2_000_000 and all(len(e.language) < 40_000 for e in model.tables)
    assert model.most * 200 * 8 <= langid.MOST_REMEMBERED_BYTES and model.stretch * 200 * 8 <= langid.STRETCH_BYTES
    got = {(r.doc_id, r.lang): r.language.lang_pred for r in langid.identify(docs, model).collect()}
    assert got.pop((9, "l008")) == "l007" and all(pred == lang for (_, lang), pred in got.items())
    # a sample with too many entries is halved until it has not
    monkeypatch.setattr(langid, "MOST_ENTRIES", 9000)
    small = langid.fit(docs)
    assert sum(len(e.language) for e in small.tables) <= 9000 and 0 < len(small.tables[0].place) < len(model.tables[0].place)


def test_stretches_of_words_add_up(monkeypatch):
    entries = [(0, "ab", 0, 3), (0, "cd", 1, 2), (1, "a", 0, 4), (1, "c", 1, 1)]
    text = " ".join(["ab", "cd", "ab", "ac"] * 5000)
    whole = langid.Model(["x", "y"], entries).predict(text)
    monkeypatch.setattr(langid, "STRETCH_BYTES", 1)
    monkeypatch.setattr(langid, "MOST_REMEMBERED_BYTES", 1)
    monkeypatch.setattr(langid, "PIECE_CHARS", 100)
    parts = langid.Model(["x", "y"], entries)
    assert [w for some in langid.stretches(f"{text} {'z' * 500}9{text}", 7) for w in some] == langid.words_of(f"{text} {'z' * 500}9{text}")
    assert list(langid.stretches("", 7)) == [] and parts.stretch == 1024 and parts.predict(text)[0] == whole[0] == "x" and parts.predict(text)[1] == pytest.approx(whole[1])
