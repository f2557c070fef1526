"""Problems 6 to 8 against plain versions and held-out accuracy, with nulls, empty tables, repeats and clashing columns."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from readloom.llm import languages as L
from readloom.llm.forum_text import running_text, sentences, words
from readloom.llm.leaks import leaked_passages, positional_index, term_lists
from readloom.llm.mixing import Mix, default_tokenizer, mix_report, mix_schedule, token_counts
from tests.helpers import rng, rows


# 6
def test_words():
    assert words("> The <b>QUICK</b> brown&nbsp;f&amp;amp;x,\n>> jum-\n> ped [quote=a_1]o­ver[/quote] ｆｕｌｌ ﬁn ​é") == ["the", "quick", "brown", "f", "x", "jumped", "over", "full", "fin", "é"]
    assert words("旧机器 x_y") == ["旧", "机", "器", "x", "y"]
    assert words(None) == words("") == words("<p>  </p>[b][/b]") == []
    assert words("été") == ["été"]


def test_long_markup_and_deep_entities():
    """No length of a tag and no depth of an entity stays in the words; very long ones take no more than their length."""
    assert words(f'one <a href="{"x" * 5_000}">two</a> three [url=http://{"y" * 5_000}]four[/url] [quote={"z " * 400}]five') == ["one", "two", "three", "four", "five"]
    for depth in (1, 4, 9, 40_000):
        assert words("one &" + "amp;" * depth + "lt;b&" + "amp;" * depth + "gt;two") == ["one", "two"]
    assert words("a&#38;#38;#x26;nbsp;b &amp;#38;amp;amp;eacute;t") == ["a", "b", "ét"]
    began = time.perf_counter()
    words("[a=" * 100_000 + "<b" * 100_000 + "&amp;" * 100_000)
    assert time.perf_counter() - began < 20


def _holds(doc, item, least, one_in):
    """Whether some span of the item and some span of the document are close enough: every pair of starts, edit distance."""
    for i in range(len(item)):
        for j in range(len(doc) + 1):
            prev = list(range(len(doc) - j + 1))
            for n in range(1, len(item) - i + 1):
                now = [n]
                for m in range(1, len(doc) - j + 1):
                    now.append(min(prev[m] + 1, now[m - 1] + 1, prev[m - 1] + (item[i + n - 1] != doc[j + m - 1])))
                prev = now
                if n >= least and min(now) <= n // one_in:
                    return True
    return False


def test_leaks_against_every_alignment(spark):
    r = rng(3)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [[r.choice(vocabulary) for _ in range(r.randint(10, 20))] for _ in range(4)]
    docs = []
    for _ in range(150):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 6))]
        item = r.choice(items)
        a = r.randrange(len(item))
        part = item[a : a + r.randint(8, 20)]
        for _ in range(r.randint(0, 2)):
            at, kind = r.randrange(len(part)) if part else 0, r.randrange(3)
            part = part[:at] + ([r.choice(vocabulary)] if kind == 0 else [] if kind == 1 else [r.choice(vocabulary)] + part[at : at + 1]) + part[at + 1 :]
        docs.append(text + part + [r.choice(vocabulary) for _ in range(r.randint(0, 5))])
    d = spark.createDataFrame([(i, " ".join(x), 5) for i, x in enumerate(docs)] + [(900, None, 1), (901, "", 1), (None, " ".join(items[0]), 1)], "doc_id bigint, text string, item_id int")
    t = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(8, None), (9, " ".join(items[0])), (10, "too short")], "item_id bigint, text string")
    items_by = {**dict(enumerate(items)), 9: items[0]}
    want = {(i, j) for i, x in enumerate(docs) for j, y in items_by.items() if _holds(x, y, 12, 8)}
    got = {(x["doc_id"], x["item_id"]) for x in leaked_passages(d, t).collect()}
    assert got == want and len(want) > 10 and len(want) < 150 * 5
    assert leaked_passages(d.limit(0), t).count() == 0 and leaked_passages(d, t.limit(0)).count() == 0


def test_passages_through_markup_and_in_long_texts(spark):
    item = "During year 1263 the old council moved 8436 crates of yellow glass from Birtem to Kalfor"
    shouted = "> " + item.upper().replace(" ", " <i>", 1).replace("COUNCIL ", "COUN-\n> CIL&nbsp;")
    long = "filler words " * 50_000 + item + " and more " * 50_000
    d = spark.createDataFrame([(1, shouted), (2, long), (3, " ".join(item.split()[:11])), (4, " ".join(item.split()[2:10])), (5, item + " " + item)], "doc_id bigint, text string")
    t = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {x["doc_id"]: (x["n_words"], x["n_changes"]) for x in leaked_passages(d, t).collect()}
    assert {k: v for k, v in got.items() if k != 3} == {1: (16, 0), 2: (16, 0), 5: (16, 0)}
    index = positional_index(term_lists(d.where("doc_id = 5"), "doc_id"))
    assert index.where("term = '8436'").first()["places"] == [7, 23] and index.count() == len(set(words(item)))


# 7
DOCS = [(i, s, t) for i, (s, t) in enumerate([("A ", "one two three four five six"), ("a", "one two three four five six"), ("B", "seven"), ("b", None), (None, "lost text"), ("c", "unknown source")] + [("A", f"text number {n} of the source") for n in range(200)] + [("B", f"short {n}") for n in range(30)])]


@pytest.fixture(scope="module")
def mix_tables(spark):
    d = spark.createDataFrame([(*x, 1) for x in DOCS], "doc_id bigint, source string, text string, n_tokens int")
    t = spark.createDataFrame([("a", 0.5, 3), (" B", 0.4, 2), ("none", 0.1, 5), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    return d, t


def test_mix_report(spark, mix_tables):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    import public_tokenizers as P

    with open(default_tokenizer(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    size = Counter()
    for _, s, t in DOCS:
        size[(s or "?").strip().lower()] += len(enc.encode_ordinary(t or ""))
    d, t = mix_tables
    got = {x["source"]: x for x in mix_report(d, t, block_tokens=16).collect()}
    total = size["a"] + size["b"]
    assert {s: (x["tokens"], x["falls_short"]) for s, x in got.items()} == {"a": (size["a"], 3 * size["a"] < 0.5 * total), "b": (size["b"], 2 * size["b"] < 0.4 * total), "none": (0, True)}
    assert got["b"]["repeats"] <= 2 and abs(sum(x["actual_share"] for x in got.values()) - 1) < 1e-9
    assert abs(got["a"]["used_tokens"] - 0.5 * total) < 0.05 * total
    assert token_counts(d).where("doc_id = 3").first()["n_tokens"] == 0


def test_schedule_is_even_and_capped(spark, mix_tables):
    d, t = mix_tables
    mix = Mix(d, t, block_tokens=16)
    slots = mix.slots().orderBy("slot").collect()
    weights = {"a": 0.5, "b": 0.4, "none": 0.1}
    for n in range(10, len(slots), 10):
        seen = Counter(x["source"] for x in slots[:n])
        assert all(abs(seen[s] - w * n) <= 3 for s, w in weights.items())
    for s in weights:
        assert [x["rank"] for x in slots if x["source"] == s] == list(range(sum(x["source"] == s for x in slots)))
    times = {x["doc_id"]: x["times"] for x in mix.schedule().collect()}
    assert max(v for k, v in times.items() if (DOCS[k][1] or "").strip().lower() == "b") <= 2
    blocks = mix.blocks()
    fill = {(x[0], x[1]): x[2] for x in blocks.groupBy("source", "block").sum("n_tokens").collect()}
    assert all(v <= 16 + 12 for v in fill.values()) and blocks.count() == sum(1 for x in DOCS if x[2] and (x[1] or "").strip().lower() in ("a", "b"))
    assert [x for x in rows(mix_schedule(d.limit(0), t))] == []
    assert {x["source"]: x["falls_short"] for x in mix_report(d.limit(0), t).collect()} == {"a": False, "b": False, "none": False}
    assert mix_report(d, t.limit(0)).count() == 0


def test_shortfall_of_the_schedule_is_the_inequality(spark):
    """Sources whose caps lie around what their weights ask for; vocabularies are sent, and bounded."""
    from readloom.llm import mixing

    r = rng(9)
    d = spark.createDataFrame([(i, f"s{r.randrange(24):02d}", "one two three " * r.randint(1, 9)) for i in range(1_500)], "doc_id bigint, source string, text string")
    size = dict(rows(token_counts(d).groupBy("source").sum("n_tokens")))
    total = sum(size.values())
    near = [size[f"s{i:02d}"] / total * (1 + (i - 12) / 400) for i in range(24)]
    targets = [(f"s{i:02d}", round(w / sum(near), 9), 1) for i, w in enumerate(near)]
    want = {s for s, w, m in targets if m * size[s] < w * total}
    assert 3 < len(want) < 24
    got = mix_report(d, spark.createDataFrame(targets, "source string, weight double, max_repeats int"), block_tokens=32)
    assert {x["source"] for x in got.where("falls_short").collect()} == want
    assert "Window" in got.where("falls_short").select("source")._jdf.queryExecution().optimizedPlan().toString()
    keep = mixing.VOCABULARY_MB
    try:
        mixing.VOCABULARY_MB = 0
        with pytest.raises(ValueError, match="vocabulary"):
            token_counts(d)
    finally:
        mixing.VOCABULARY_MB = keep


def test_running_sums_over_chunks(spark):
    from readloom.llm import mixing

    keep = mixing.CHUNK_ROWS
    try:
        mixing.CHUNK_ROWS = 7
        d = spark.createDataFrame([(i, "a" if i % 3 else "b", "some words here " * (i % 4)) for i in range(90)], "doc_id bigint, source string, text string")
        t = spark.createDataFrame([("a", 0.6, 2), ("b", 0.4, 2)], "source string, weight double, max_repeats int")
        mix = Mix(d, t, block_tokens=10)
        slots = mix.slots()
        for s in ("a", "b"):
            assert [x["rank"] for x in slots.where(F.col("source") == s).orderBy("slot").collect()] == list(range(slots.where(F.col("source") == s).count()))
        total = {x[0]: x[1] for x in mix.blocks().groupBy("source").sum("n_tokens").collect()}
        last = {x[0]: x[1] for x in mix.blocks().groupBy("source").max("block").collect()}
        assert all(last[s] == (total[s] - 1) // 10 or last[s] <= total[s] // 10 for s in total)
    finally:
        mixing.CHUNK_ROWS = keep


# 8
def test_automaton_knows_every_substring():
    r = rng(4)
    text = "".join(r.choice("abc") for _ in range(80))
    go = L.automaton(text)
    known = {text[i:j] for i in range(80) for j in range(i + 1, 81)}

    def has(s):
        state = 0
        for c in s:
            if (state := go[state].get(c)) is None:
                return False
        return True

    assert all(map(has, known))
    assert all(has(s) == (s in known) for s in ("".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(500)))


def test_phrases_are_the_greedy_parse():
    r = rng(5)
    texts = {"x": "".join(r.choice("ab ") for _ in range(40)), "y": "".join(r.choice("bcd") for _ in range(60))}
    parser = L.Parser(texts)

    def phrases(s, t):
        n = i = 0
        while i < len(s):
            j = i + 1
            while j < len(s) and s[i : j + 1] in t:
                j += 1
            i, n = j, n + 1
        return n

    pieces = ["".join(r.choice("abcdz ") for _ in range(r.randint(0, 30))) for _ in range(60)]
    costs = parser.costs(pieces)
    for p, c in zip(pieces, costs):
        # a letter that no phrase can begin with is parsed as one of its own
        assert [round(x / k) for x, k in zip(c, parser.cost)] == [phrases(p, texts[lang]) for lang in parser.langs]


def test_labels(spark):
    labels = {"EN": ["en"], "en_GB": ["en"], "pt-BR": ["pt"], "ger": ["de"], "Français": ["fr"], "de; en/zh": ["de", "en", "zh"], " Svenska ": ["sv"], "und": [], "??": [], "": [], "n/a": [], "xx": [], "русский, POL": ["ru", "pl"], "zh-Hans-CN": ["zh"], "english": ["en"], None: []}
    df = spark.createDataFrame([(k,) for k in labels], "lang string")
    assert {r[0]: r[1] for r in df.select("lang", L.label_languages(F.col("lang"))).collect()} == labels


def test_running_text():
    text = "bob:\n> quoted &amp; more\n<b>Hello</b> http://x.invalid/y you\r\n[url=http://z.invalid]link[/url] *** removed by moderator ***\n\n*** gone ***\n~Sig\n[size=1]Name[/size]\n-- \nName 94"
    got = running_text(text)
    assert "quoted" in got and "Hello" in got and not any(x in got for x in ("invalid", "Name", "Sig", "gone", "bob"))
    assert sentences("One two. Three\nfour!\n\nFive。六") == ["One two.", "Three four!", "Five。", "六"]
    assert running_text(None) == "" and sentences("") == [] and "".join(sentences("x" * 700)) == "x" * 700


SAMPLES = f"{os.environ.get('TEST_SF_DIR', '/root/testdata/sf0.001')}/lang_samples.parquet"


@pytest.mark.skipif(not os.path.exists(SAMPLES), reason="needs the labelled sample")
def test_held_out_accuracy(spark):
    data = spark.read.parquet(SAMPLES).orderBy("sample_id").collect()
    train = [tuple(x) for i, x in enumerate(data) if i % 4]
    held = [x for i, x in enumerate(data) if i % 4 == 0]
    samples = spark.createDataFrame(train, "sample_id bigint, lang string, text string")
    own = spark.createDataFrame([(i, x["text"], "") for i, x in enumerate(held)] + [(999, None, "en"), (998, "", None), (997, "[deleted]", None), (None, "words without a number", None)], "doc_id bigint, text string, lang string")
    got = {x["doc_id"]: x["lang"] for x in L.language_segments(own, samples).collect()}
    assert sum(got[i] == x["lang"] for i, x in enumerate(held)) >= 0.97 * len(held) and not {998, 999} & set(got)
    by = {x["lang"]: x["text"] for x in held}
    mixed = spark.createDataFrame([(1, f"{by['en']}\n\n{by['pl']} {by['zh']}", "en", "clash"), (2, "короткое. " + by["de"], "de", "clash")], "doc_id bigint, text string, lang string, letters string")
    assert [(x["doc_id"], x["segment"], x["lang"]) for x in L.language_segments(mixed, samples).where("doc_id = 1").orderBy("segment").collect()] == [(1, 0, "en"), (1, 1, "pl"), (1, 2, "zh")]
    found = {(x["doc_id"], x["lang"]): x["labelled"] for x in L.document_languages(mixed, samples, han=5).collect()}
    assert found == {(1, "en"): True, (1, "pl"): False, (1, "zh"): False, (2, "de"): True}
    assert all(0 <= x["confidence"] <= 1 for x in L.language_segments(mixed, samples).collect())
    assert L.document_languages(own.limit(0), samples).count() == 0 and L.language_segments(own, samples.limit(0)).count() == 0


def test_what_is_learnt_is_bounded(spark):
    samples = spark.createDataFrame([(i, " EN", f"the cat {i} sat on the mat") for i in range(30)] + [(99, "de", "der hund lief und die katze schlief"), (98, None, "x"), (97, "fr", " ")], "sample_id bigint, lang string, text string")
    docs = spark.createDataFrame([(i, f"the other cat number {i} ran on and on and over the mat. der hund und die katze schlief lange {i}.", ["en", "de", "en, de", None][i % 4]) for i in range(40)], "doc_id bigint, text string, lang string")
    plain = L.learn(samples, rows=3, letters=40)
    assert plain == {"en": "the cat 0 sat on the mat the cat 0 sat on the mat"[:40], "de": "der hund lief und die katze schlief"}
    more = L.learn(samples, docs, rows=3, letters=40, more=10, rounds=2)
    assert all(more[k].startswith(plain[k]) and len(more[k]) <= 40 + 2 * (10 + 80) for k in plain) and more["en"] != plain["en"]
    assert "hund" not in more["en"] and "mat" not in more["de"]


def test_very_long_text(spark):
    samples = spark.createDataFrame([(1, "en", "the cat sat on the mat and the dog ran"), (2, "de", "der hund lief und die katze schlief")], "sample_id bigint, lang string, text string")
    d = spark.createDataFrame([(1, "the dog sat on the mat and ran " * 20_000, "de")], "doc_id bigint, text string, lang string")
    got = L.document_languages(d, samples).collect()
    assert [(x["doc_id"], x["lang"], x["labelled"]) for x in got] == [(1, "en", False)]
