"""Classifier, packing, pages, chat, mixing, vectors and the pipeline."""

import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloister.llm import chat, covertree, mixing, packing, pages, quality
from cloister.llm.common import word_count

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_classifier_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert len(held) > 40 and np.mean([p == q for p, q in held]) > 0.95


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs, flipped)


def test_compiled_rules_score_like_the_model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.with_statistics(docs, F.col("text")).select("stats", model.column(F.col("stats")).alias("score")).collect()
    assert np.allclose([r["score"] for r in rows], model.score(np.array([r["stats"] for r in rows])))
    assert model.rules and model.describe()


def plain_statistics(text):
    """The statistics, each by its definition."""
    t = text or ""
    words, lines = WORD.findall(t), [x for x in t.split("\n") if x]
    letter, digit, usual = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), ".,;:!?'\"()-"
    plain = lambda c: bool(letter.match(c) or digit.match(c)) or c in usual
    share = lambda a, b: a / b if b else 0.0
    among = lambda kind: share(sum(map(kind, t)), len(t))
    return {
        "chars": len(t), "words": len(words), "lines": len(lines), "word_chars": share(sum(map(len, words)), len(words)), "line_chars": share(len(t), len(lines)),
        "distinct_words": share(len(set(words)), len(words)), "distinct_lines": share(len(set(lines)), len(lines)),
        "symbols": among(lambda c: not plain(c) and c not in " \t\n\x0b\f\r"), "digits": among(lambda c: bool(digit.match(c))), "capitals": among(lambda c: bool(regex.match(r"\p{Lu}", c))),
        "stops": among(lambda c: c in ".!?"), "commas": among(lambda c: c in ",;:"), "longest_word": max(map(len, words), default=0),
        "short_words": share(sum(len(w) <= 3 for w in words), len(words)), "marked_words": share(sum(not plain(w[-1]) for w in words), len(words)),
        "lone_marks": share(sum(len(w) == 1 for w in words), len(words)), "long_lines": share(sum(len(x) > 400 for x in lines), len(lines)),
    }


def test_statistics_by_their_definitions(spark, odd):
    made = ["A* b# \u00c9t\u00e9 \u4e16\u754c 12\u0663 $5,00; x:y (z)!\n\n" + "long " * 90 + "\n-\t@\x0b~ ok?", "\u2603 \U0001f600\U0001f600 \u00a0 \x1c a\u0301", "\n\n\n", "one line. one line.\none line. one line."]
    few = spark.createDataFrame([(t,) for t in made], "text string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").unionByName(odd.select("text")).unionByName(few)
    rows = quality.with_statistics(docs, F.col("text")).collect()
    for r in rows:
        want = plain_statistics(r["text"])
        got = dict(zip(quality.STATISTICS, r["stats"]))
        assert list(want) == list(got) and all(abs(got[k] - want[k]) <= 1e-12 * max(1, abs(want[k])) for k in want), (r["text"][:80], {k: (got[k], want[k]) for k in want if got[k] != want[k]})
    assert len(rows) > 200


def test_classifier_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 1), (8, None), (None, 1), (99, 0)], "doc_id long, quality int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(none, labels).count() == 0
    assert {r["score"] for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.good_documents(odd, labels.limit(0)).columns == odd.columns


ENCODER = packing.Encoder(None)


PARTS = [" ", "  ", "\n", "\t", "'s", "a", "Foo", "\u00e9", "12", ".", "\u00a0", "\u3000", "\x1c", "\u4e16", "\U0001f600", "\x85"]


@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join) | st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_tokenizers(text):
    assert ENCODER.fast is not None
    ids = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode([text]) == [np.array(ids, "<u4").tobytes()]


def test_special_tokens_and_other_files(tmp_path):
    text = "a <|endoftext|> b"
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    import public_tokenizers

    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None and np.frombuffer(other.encode(["Some text"])[0], "<u4").tolist() == other.tokenizer.encode("Some text", add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
@settings(max_examples=150, deadline=None)
def test_plans_use_every_piece_once(counts):
    used = Counter()
    for n, lengths in packing.plan_packing(counts, 64):
        assert n > 0 and sum(lengths) <= 64
        for x in lengths:
            used[x] += n
    assert used == Counter(counts)


def test_complements_are_found():
    for counts, bins in (({40: 3, 24: 3}, 3), ({30: 2, 20: 2, 14: 2}, 2), ({40: 1, 10: 1, 8: 1, 6: 1}, 1), ({32: 5}, 3), ({64: 4}, 4)):
        assert sum(n for n, _ in packing.plan_packing(counts, 64)) == bins


def check_packing(rows, got, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in rows:
        ids = [*ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            assert k == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids) and len(by_doc[i]) == -(-len(ids) // capacity)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_the_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.pack(df).collect()
    n = check_packing([(r["doc_id"], r["text"]) for r in df.collect()], got)
    assert n <= 1.03 * sum(r["length"] for r in got) / 1024 + 2


def test_packing_odd_rows(odd, none):
    got = packing.pack(odd).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter([1, 2, 3, 4, 5, 6, 7, 7, 8, None, None, 9, 9])
    assert {r["length"] for r in got if r["doc_id"] in (1, 2)} == {1}
    check_packing([], got)
    assert packing.pack(none).count() == 0


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site name that is rather long for a name</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>All the other pages of this site</a></ul></nav>
<div id="cookie-notice"><p>We use cookies and tell you so at some length, as the law would have it.</p></div>
%s
<aside><p>Something beside the article, also long enough to look like text of some kind.</p></aside>
<div class="comments"><article class="comment"><p>First! I have read all of it and I have a great deal to say about it, at length.</p></article></div>
<form><label>Write to us at any time, we are glad to hear from you</label><textarea>text</textarea></form><footer>&copy; somebody</footer></body></html>"""


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<article><h1>Title &amp; more</h1><p>A first   paragraph\nof text<br>that goes <b>on</b>.<p>Short.</p><div class=ad>Buy this, it is very good and very cheap</div><ul><li>one<li>two</ul></article>", "Title & more\n\nA first paragraph of text that goes on.\n\nShort.\n\none\n\ntwo"),
        ("<main><section><h2>Head</h2><p>Text of the only section, with some words.</p></section></main>", "Head\n\nText of the only section, with some words."),
        ("<div id=content><p>A long paragraph of real text that stands in no article, but has many words and few tags, as text does.</p><p>And a second one, which is also long enough to be seen as what it is.</p></div>", "A long paragraph of real text that stands in no article, but has many words and few tags, as text does.\n\nAnd a second one, which is also long enough to be seen as what it is."),
    ],
)
def test_pages(inner, want):
    assert pages.main_text(PAGE % inner) == want


LONG = "A sentence of the article that has many words and hardly any tags, as sentences of articles do. " * 2


def test_names_take_nothing_from_an_article():
    inner = f'<h2 id="sharing-data">Sharing data</h2><section id="search-algorithms"><p>{LONG}</p></section><p class="notice">A notice of the text.</p><div class="related-work"><p>Work that is related.</p></div><p>By <span class="form">form</span> alone.</p>'
    got = pages.main_text(PAGE % f"<article>{inner}<div class='ad-slot'>Buy this now</div><p class=ad>Buy that, too</p><div id='post-comments'><p>First!</p></div></article>")
    assert got.split("\n\n") == ["Sharing data", LONG.strip(), "A notice of the text.", "Work that is related.", "By form alone."]


def test_ratios_choose_the_region(monkeypatch):
    teasers = "".join(f"<article><h3><a href=x{k}>More of it</a></h3><a href=y>Go</a> <a href=z>on</a></article>" for k in range(4))
    scores = "".join(f"<li><b>Player {k}</b><br><i>{k} goals</i><br><span>{k} games</span></li>" for k in range(40))
    cases = {
        PAGE % f"<div class=stories>{teasers}</div><div id=body><h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div><div><p>Short.</p></div></div>": f"Head\n\n{LONG.strip()}\n\n{LONG.strip()}\n\nShort.",
        f"<html><body><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><div><a href=d>Four</a><a href=e>Five</a></div></div><div>Copyright of somebody</div></body></html>": f"Head\n\n{LONG.strip()}\n\n{LONG.strip()}",
        f"<body><div><a href=a>One</a> <a href=b>Two</a></div><h1>Head</h1><p>{LONG}</p><p>Short.</p><div>Copyright</div></body>": f"Head\n\n{LONG.strip()}\n\nShort.",
        f"<body><div><ul>{scores}</ul></div><div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>": "\n\n".join(["Head", *[LONG.strip()] * 3]),
        f"<h1>Head</h1><p>{LONG}</p><p>Short.": f"Head\n\n{LONG.strip()}\n\nShort.",
    }
    for html, want in cases.items():
        assert pages.main_text(html) == want
    monkeypatch.setattr(pages, "smoothed", lambda ratios: [1.0] * len(ratios))
    assert sum(pages.main_text(html) != want for html, want in cases.items()) >= 2


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<nav>only a menu</nav>", "x"), (3, "u", "plain &lt;text&gt; only", "x"), (3, "u", "<p>" * 3000 + "deep", "x")], "page_id long, url string, html string, text string")
    got = [tuple(r) for r in pages.extract(df).collect()]
    assert got == [(1, "u", "", 0), (2, None, "", 0), (None, "u", "", 0), (3, "u", "plain <text> only", 17), (3, "u", "deep", 4)]
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    import html

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body.replace("<br>", " ")))
        assert pages.main_text(r["html"]) == "\n\n".join(b for b in blocks if b)


SCHEMAS = {"add": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "number", "minimum": 0}, "c": {"enum": ["x", "y"]}}, "required": ["a"], "additionalProperties": False}}


def linked(spark, events, depends=()):
    e = spark.createDataFrame(events, "conv_id long, position long, kind string, call_id string, name string, body string, extra string")
    d = spark.createDataFrame(list(depends), "conv_id long, call_id string, needs string")
    return chat.link_calls(e, SCHEMAS, d).collect()


def test_links_and_schemas(spark):
    got = linked(
        spark,
        [
            (1, 0, "message", None, "user", "hi", ""), (1, 1, "call", "c1", "add", '{"b": 1.5, "a": 2}', ""), (1, 2, "result", "c1", None, "3", ""), (1, 3, "call", "c2", "add", '{"a": "x", "d": 1, "b": -1}', ""),
            (1, 4, "result", "c9", None, "?", ""), (1, 5, "call", "c3", "sub", None, ""), (1, 6, "call", "c4", "add", "{", ""), (2, 0, "result", "c2", None, "other conversation", ""),
            (None, 0, "call", "c1", "add", '{"a": 1}', ""), (None, 1, "result", "c1", None, None, ""), (3, 0, "call", "d", "add", '{"a": 1}', ""), (3, 0, "call", "d", "add", '{"a": 1}', ""), (3, 1, "result", "d", None, "r", ""), (4, None, "call", None, "add", '{"a": NaN}', ""),
        ],
    )
    by = {(r["conv_id"], r["position"], r["kind"]): r for r in got}
    assert len(got) == 14
    assert by[1, 1, "call"]["status"] == by[1, 2, "result"]["status"] == "linked" and by[1, 1, "call"]["first_result"] == 2
    assert by[1, 1, "call"]["json"] == '{"arguments":{"a":2,"b":1.5},"id":"c1","name":"add","type":"tool_call"}' and by[1, 1, "call"]["errors"] == ""
    assert by[1, 3, "call"]["errors"] == "$.a: not integer; $.b: under minimum; $.d: unknown" and by[1, 3, "call"]["status"] == "unanswered"
    assert by[1, 4, "result"]["status"] == by[2, 0, "result"]["status"] == "orphan"
    assert by[1, 5, "call"]["errors"] == "unknown tool" and by[1, 6, "call"]["errors"] == "$: not JSON" and by[4, None, "call"]["errors"] == "$: not JSON"
    assert by[None, 0, "call"]["status"] == by[None, 1, "result"]["status"] == "linked"
    assert {r["status"] for r in got if r["conv_id"] == 3} == {"duplicate"} and by[3, 1, "result"]["n_calls"] == 2
    assert sorted(r["seq"] for r in got if r["conv_id"] == 1) == list(range(7))


def test_topological_order(spark):
    events = [(1, p, "call", c, "add", '{"a": 1}', "") for p, c in enumerate("abcde")] + [(2, p, "call", c, "add", "{}", "") for p, c in enumerate("xy")]
    got = linked(spark, events, [(1, "a", "d"), (1, "b", "a"), (1, "e", "c"), (1, "c", "zz"), (2, "x", "y"), (2, "y", "x")])
    order = [r["call_id"] for r in sorted(got, key=lambda r: r["seq"]) if r["conv_id"] == 1]
    assert order.index("d") < order.index("a") < order.index("b") and order.index("c") < order.index("e")
    assert [r["cycle"] for r in got if r["conv_id"] == 2] == [True, True] and not any(r["cycle"] for r in got if r["conv_id"] == 1)


def test_long_chains_beside_a_cycle(spark):
    n = 100
    events = [(1, p, "call", f"c{p}", "add", '{"a": 1}', "") for p in range(n)] + [(c, p, "call", i, "add", "{}", "") for c in (2, None) for p, i in enumerate("xyzw")]
    depends = [(1, f"c{p}", f"c{p - 1}") for p in range(1, n - 1)] + [(1, "c0", f"c{n - 1}")]
    depends += [(c, a, b) for c in (2, None) for a, b in (("x", "y"), ("y", "x"), ("z", "y"))]
    got = linked(spark, events, depends)
    order = [r["call_id"] for r in sorted(got, key=lambda r: r["seq"]) if r["conv_id"] == 1]
    assert order == [f"c{n - 1}", *[f"c{p}" for p in range(n - 1)]] and not any(r["cycle"] for r in got if r["conv_id"] == 1)
    for c in (2, None):
        assert [(r["call_id"], r["cycle"]) for r in sorted(got, key=lambda r: r["seq"]) if r["conv_id"] == c] == [("x", True), ("y", True), ("z", True), ("w", False)]


def test_long_conversations_are_numbered(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)] + [(8, 0, "system", "s"), (8, 1, "user", ""), (8, 3, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("status", F.lit("clash"))
    got = chat.format_conversations(df).collect()
    assert [r["seq"] for r in sorted(got, key=lambda r: (r["conv_id"], r["position"])) if r["conv_id"] == 7] == list(range(300))
    assert {r["status"] for r in got if r["conv_id"] == 7} == {"linked"} and {json.loads(r["json"])["type"] for r in got} == {"tool_call", "tool_result", "message"}
    by = {r["position"]: r for r in got if r["conv_id"] == 8}
    assert by[1]["errors"] == "$.prompt: length" and by[3]["errors"] == "$.prompt: missing" and by[0]["status"] == "message"
    assert chat.format_conversations(df.limit(0)).count() == 0


def fair(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        left, weight = total - sum(out.values()), sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / weight > cap * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * w[s] / weight for s in free}
        out |= {s: cap * sizes[s] for s in over}


def test_mix_meets_its_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes, source = Counter(), {}
    for r in df.collect():
        source[r["doc_id"]] = r["source"]
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want, taken = fair(sizes), Counter()
    got = mixing.mix(df).collect()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and abs(r["target"] - want[source[r["doc_id"]]]) < 1e-6
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= max(0.03 * want[s], 640) for s in want)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(5)).collect()))
    assert sum(r["taken"] for r in got) == pytest.approx(sum(want.values()), rel=0.01)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df).collect()))


def test_permutations_of_blocks(spark):
    for n in (1, 2, 3, 7, 64, 100, 1000, 4097):
        rows = spark.range(2 * n).select((F.col("id") % 2).cast("int").alias("si"), F.lit(n).cast("long").alias("n_blocks"), F.col("id").alias("slot"))
        rows = rows.union(rows.withColumn("si", 1 - F.col("si")))
        got = defaultdict(list)
        for r in mixing.permuted(rows, 5).collect():
            got[r["si"], r["turn"]].append(r["block"])
        assert len(got) == 4 and all(sorted(x) == list(range(n)) for x in got.values())
        assert n < 1000 or len({tuple(x) for x in got.values()}) == 4
    n = 200_000_000_000
    rows = spark.range(0, 2 * n, n // 1000 + 1).union(spark.range(n - 3000, n)).select(F.lit(3).alias("si"), F.lit(n).alias("n_blocks"), F.col("id").alias("slot"))
    got = mixing.permuted(rows, 5).collect()
    assert len({(r["turn"], r["block"]) for r in got}) == len(got) and all(0 <= r["block"] < n for r in got)
    near = [r["block"] for r in got[-3000:]]
    steps = np.diff(np.array(near))
    assert len(set(steps.tolist())) > 2900 and abs(np.mean(near) / n - 0.5) < 0.05 and np.mean(np.abs(steps) < n // 100) < 0.1


def test_counts_of_shards(spark):
    plan = spark.createDataFrame([(0, 50_000, 0.5017), (1, 50_000, 0.3001), (2, 50_000, 0.1979), (3, 50_000, 0.0003)], "si int, n_blocks long, share double")
    shards, per = 2500, 10
    got = mixing._uses(plan, shards * per, shards, 7).collect()
    by = defaultdict(list)
    for r in got:
        by[r["si"]].append(r["slot"])
    assert sum(map(len, by.values())) == shards * per and all(sorted(x) == list(range(len(x))) for x in by.values())
    for si, share in ((0, 0.5017), (1, 0.3001), (2, 0.1979), (3, 0.0003)):
        part = per * share % 1
        assert abs(len(by[si]) - shards * per * share) < 4 * (shards * 2 * part) ** 0.5 + 1


def test_mix_is_native(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mixed_documents_hold_the_words_taken(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect()}
    out, text = mixing.mixed_documents(df), {r["doc_id"]: r["text"] for r in df.collect()}
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        w = WORD.findall(r["text"])
        words[r["doc_id"]] += len(w)
        assert r["n_chars"] == len(r["text"]) and (len(w) < len(WORD.findall(text[r["doc_id"]])) or r["text"] == text[r["doc_id"]])
    assert words == Counter({i: n for i, n in taken.items() if n})


def test_mix_of_odd_rows(odd, none, docs_of):
    got = mixing.mix(odd).collect()
    assert len(got) == 13 and all(r["taken"] <= 2 * r["size"] for r in got) and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mixed_documents(odd).columns == odd.columns and mixing.mixed_documents(odd).count() > 0
    assert mixing.mix(none).count() == mixing.mixed_documents(none).count() == 0
    assert [tuple(r)[1:] for r in mixing.mix(docs_of([(1, ""), (2, None)])).collect()] == [(0, 0, 0.0, 0)] * 2


def test_word_counts(spark):
    texts = ["", " ", "a", " a", "a ", "\x0ba\x1cb c d\n", "\t\n x  y "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [len(WORD.findall(t)) for t in texts]


def brute_vectors(x, cosine):
    n = np.linalg.norm(x, axis=1)
    links = (x @ x.T) / np.outer(n, n) >= cosine
    np.fill_diagonal(links, False)
    low = np.arange(len(x))
    while True:
        new = low.copy()
        i, j = np.nonzero(links)
        np.minimum.at(new, i, low[j])
        if (new == low).all():
            return links.sum(axis=1), low
        low = new


def clustered(seed, n, d):
    r = np.random.default_rng(seed)
    x, centers = r.normal(size=(n, d)), r.normal(size=(5, d))
    m = n // 2
    x[:m] = centers[r.integers(5, size=m)] + r.normal(size=(m, d)) * r.choice([0.02, 0.2, 0.35], size=(m, 1))
    return x[r.permutation(n)].astype(np.float32)


@pytest.mark.parametrize(("n", "d", "cosine", "block"), [(400, 6, 0.9, 60), (300, 32, 0.9, 4096), (200, 3, 0.99, 32)])
def test_vectors_against_all_pairs(spark, n, d, cosine, block):
    x = clustered(n, n, d)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    links, low = brute_vectors(x.astype(float), cosine)
    got = sorted(covertree.near_vectors(df, cosine=cosine, block_rows=block, pivots=4).collect())
    assert links.sum() and [tuple(r) for r in got] == [(i, links[i], low[i], low[i] == i) for i in range(n)]


def test_cover_trees_nest_and_cover():
    x = clustered(1, 500, 5).astype(float)
    t, unit = covertree.build(x), x / np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(len(t["points"]) - 1):
        begin, end = t["child"][k]
        assert set(t["points"][k]) <= set(t["points"][k + 1]) and end[-1] == len(t["points"][k + 1])
        for node, p in enumerate(t["points"][k]):
            below = t["rows"][t["under"][k][0][node] : t["under"][k][1][node]]
            assert p in below and np.linalg.norm(unit[below] - unit[p], axis=1).max() <= t["radius"][k][node] + 1e-6


def test_blocks_follow_the_geometry(spark):
    # Groups that are larger than blocks: only their blocks' pairs are left.
    r = np.random.default_rng(5)
    x = np.eye(32)[r.integers(6, size=2000)] + r.normal(size=(2000, 32)) * 0.01
    reps = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "row long, copies long, embedding array<double>")
    blocks, partners = covertree._blocks_and_partners(reps, 0.9, 100, 8, 500)
    held = Counter(b["block"] for b in blocks.select("block").collect())
    met = {(p["a"], p["b"]) for p in partners.collect()}
    assert sum(held.values()) == 2000 and max(held.values()) < 200 and len(held) > 20 and all((b, b) in met for b in held)
    assert len(met) < len(held) * (len(held) + 1) / 4  # most pairs of blocks are pruned
    block_of = {b["row"]: b["block"] for b in blocks.select("row", "block").collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = {tuple(sorted((block_of[i], block_of[j]))) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.9))}
    assert linked <= {tuple(sorted(p)) for p in met}


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [0.0, 1.0]), (11, [-0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash"))
    got = Counter(tuple(r) for r in covertree.near_vectors(df).collect())
    assert got == Counter([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)], (10, 1, 10, True), (11, 1, 10, False)])
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_size(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [1e-310, 1.01e-310]), (5, [1e200, -1e200]), (6, [1.0, 1.0]), (7, [1e-300, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in covertree.near_vectors(df).collect()}
    assert got == {**{i: (4, 1) for i in (1, 2, 3, 4, 6)}, 5: (0, 5), 7: (0, 7)}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    from cloister.llm.common import staged

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [docs]
    for _, stage in cp.STAGES:
        texts.append(staged(stage(spark, texts[-1], SF), "test"))
    assert all(t.columns == docs.columns for t in texts[:-1])
    ids = [Counter(r["doc_id"] for r in t.collect()) for t in texts[:-1]]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:])) and max(ids[4].values()) == 2
    good = {r["doc_id"] for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert set(ids[1]) == good
    check_packing([], texts[5].collect())
    assert sum(r["length"] for r in texts[5].collect()) == sum(len(ENCODER.encode([r["text"]])[0]) // 4 + 1 for r in texts[4].collect())
    assert Counter(map(tuple, cp.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in texts[5].collect())


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from cloister.llm.common import shared_dir

    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master))

    assert shared_dir(session("spark://a:7077", "hdfs://b/c/")) == "hdfs://b/c"
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(session("spark://a:7077", None))
