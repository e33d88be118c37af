"""Near-duplicates, lines, chunks and fingerprints against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloister.llm import chunks, fingerprints, lines, minhash
from cloister.llm.components import components, local_components

SMALL = "/root/testdata/sf0.001/documents.parquet"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups(sets, links):
    low = dict.fromkeys(sets)
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, groups(sets, links)


def family(seed, n=90, words=60):
    """Texts around a few bases at all similarities, some equal up to case and white space."""
    r = random.Random(seed)
    out = []
    for b in range(3):
        base = [f"w{b}{r.randrange(400)}" for _ in range(words)]
        for k in range(n // 3):
            w = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 3, 4, 6))):
                w[r.randrange(len(w))] = f"n{r.randrange(10_000)}"
            out.append((b * 1000 + k, (" " if k % 2 else "  \n").join(w).upper() if k % 3 == 0 else " ".join(w)))
    return out


@pytest.mark.parametrize("rows", [family(1), family(2), [(i, f"x{i % 3}") for i in range(9)]])
def test_near_duplicates_are_those_of_all_pairs(docs_of, rows):
    sets, want = brute(rows)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (i == want[i]) for i, r in got.items())


def test_near_duplicates_of_the_table(spark):
    df = spark.read.parquet(SMALL)
    sets, want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()} == want
    kept = minhash.without_near_duplicates(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in want if want[i] == i) and kept.columns == df.columns


def test_near_duplicates_of_odd_rows(odd, none):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd).collect())
    assert sum(got.values()) == 13
    assert got[(1, 0, 1, True)] == got[(2, 0, 2, True)] == got[(3, 0, 3, True)] == got[(None, 0, None, True)] == 1
    assert got[(7, 4, 7, True)] == 2 and got[(8, 4, 7, False)] == 1 and got[(None, 4, 7, False)] == 1 and got[(9, 4, 7, False)] == 1
    kept = minhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, None, 4, 5, 7, 9])
    assert minhash.near_duplicates(none).count() == minhash.without_near_duplicates(none).count() == 0


def test_estimates_follow_similarity():
    r = np.random.default_rng(3)
    sets, true = [], []
    for share in (0.0, 0.3, 0.6, 0.75, 0.9, 1.0):
        both = r.integers(0, 2**63, int(4000 * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, r.integers(0, 2**63, 4000 - len(both), dtype=np.uint64)])) for _ in "ab")
        sets += [a, b]
        true.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    _, lanes = minhash.signatures(sets)
    est = minhash.lane_estimates(lanes.view(np.uint64)[::2], lanes.view(np.uint64)[1::2]).diagonal()
    assert np.abs(est - np.array(true)).max() < 0.16 and est[-1] == 1
    assert (minhash.shared_counts(sets[:3], sets[1:5], 64) == [[len(np.intersect1d(x, y)) for y in sets[1:5]] for x in sets[:3]]).all()


@given(st.text(alphabet=" \t\nAbcé世", max_size=40))
@settings(max_examples=200, deadline=None)
def test_shingle_sets_match_the_definition(text):
    assert len(minhash.shingle_set(text)) == len(shingles(text))
    assert (minhash.shingle_set(text) == minhash.shingle_set(" " + text.translate(LOWER))).all()


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60))
@settings(max_examples=100, deadline=None)
def test_local_components(links):
    a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    ids, low = local_components(a, b)
    assert dict(zip(ids.tolist(), low.tolist())) == groups({x for p in links for x in p}, links)


def test_components_over_several_splits(spark):
    r = random.Random(5)
    links = [(i, i + 1) for i in range(300) if i % 50] + [(r.randrange(400, 600), r.randrange(400, 600)) for _ in range(120)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = {x["id"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = groups({x for p in links for x in p}, links)
    assert {i: want[i] for i in got} == got and set(want) - set(got) <= {a for a, b in links if a == b}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@given(st.text(alphabet="ab", max_size=9), st.text(alphabet="abc", max_size=9), st.integers(0, 4))
@settings(max_examples=400, deadline=None)
def test_banded_distance(a, b, edits):
    d = distance(a, b)
    assert lines.within(a, b, edits) == (d if d <= edits else None)


@given(st.text(alphabet="abcd", min_size=6, max_size=20), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 20), st.sampled_from("abcd")), max_size=3))
@settings(max_examples=400, deadline=None)
def test_segments_and_probes_always_meet(a, changes):
    b = list(a)
    for kind, at, c in changes:
        if kind == 0:
            b.insert(min(at, len(b)), c)
        elif at < len(b):
            b[at : at + 1] = [] if kind == 1 else [c]
    short, long = sorted((a, "".join(b)), key=len)
    for edits in (1, 2, 3):
        if distance(a, "".join(b)) <= edits and len(short) > edits:
            parts = lines.segments(len(short), edits)
            assert any(short[s : s + n] == long[at : at + n] for i, at, n in lines.probes(len(long), len(short), edits) for s, n in [parts[i]])


def texts_with_near_lines(seed):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdefgh ") for _ in range(r.randrange(30, 60))) for _ in range(25)]
    rows = []
    for i in range(40):
        some = []
        for _ in range(r.randrange(1, 6)):
            line = list(r.choice(pool))
            for _ in range(r.choice((0, 0, 1, 2, 3))):
                at = r.randrange(len(line))
                line[at : at + 1] = r.choice(([], ["z"], ["é", line[at]]))
            some.append("".join(line))
        rows.append((i, "\n".join([*some, "short", ""])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_all_pairs(docs_of, seed):
    rows = texts_with_near_lines(seed)
    first, where = {}, []
    for i, t in rows:
        for k, line in enumerate(t.split("\n")):
            if len(line) >= 32:
                first.setdefault(line, (i, k))
                where.append((i, k, line))
    links, earliest = defaultdict(set), {}
    for a in first:
        for b in first:
            if a != b and distance(a, b) <= 2:
                links[a].add(b)
                earliest[a] = min(earliest.get(a, first[b]), first[b])
    got = {r["doc_id"]: r for r in lines.deduplicated_lines(docs_of(rows)).collect()}
    assert links
    for i, t in rows:
        mine = [(k, x) for d, k, x in where if d == i]
        exact = {k for k, x in mine if (i, k) > first[x]}
        near = {k for k, x in mine if x in earliest and earliest[x] < (i, k)} - exact
        assert (got[i]["n_exact"], got[i]["n_near"], got[i]["n_links"]) == (len(exact), len(near), sum(len(links[x]) for _, x in mine))
        assert got[i]["text"] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in exact | near) and got[i]["n_lines"] == t.count("\n") + 1


@given(st.lists(st.text(alphabet="ab ", min_size=1, max_size=24), min_size=16, max_size=24), st.integers(0, 4))
@settings(max_examples=12, deadline=None)
def test_distances_of_many_pairs(texts, edits):
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    want = [distance(texts[i], texts[j]) for i, j in zip(a.tolist(), b.tolist())]
    assert lines.distances(texts, a, b, edits).tolist() == [d if d <= edits else -1 for d in want]


def near_texts(n, seed):
    """Distinct lines around one line, each two edits away from it at most, and some that only share its start."""
    r = random.Random(seed)
    base, out = "a line that stands in very many documents, hardly ever twice the same", set()
    while len(out) < n:
        line = list(base)
        for _ in range(r.choice((0, 1, 1, 2, 2))):
            at = r.randrange(len(line))
            line[at : at + 1] = r.choice(([], [r.choice("xyz")], [line[at], r.choice("xyzé")]))
        out.add("".join(line) if r.random() < 0.9 else base[:30] + "".join(r.choice("abcdefgh") for _ in range(40)))
    return sorted(out, key=lambda x: r.random())


def links_of(texts):
    a, b = np.triu_indices(len(texts), 1)
    near = lines.distances(texts, a, b, 2) > 0
    a, b = np.concatenate([a[near], b[near]]), np.concatenate([b[near], a[near]])
    low = np.full(len(texts), len(texts))
    np.minimum.at(low, a, b)
    return np.bincount(a, minlength=len(texts)), low


def test_one_group_of_2000_near_lines(docs_of):
    texts = near_texts(2000, 3)
    many, low = links_of(texts)
    some = random.Random(1).sample(range(2000), 40)
    assert all(sum(0 < distance(texts[i], texts[j]) <= 2 for j in range(0, 2000, 50)) == sum(lines.within(texts[i], texts[j], 2) not in (None, 0) for j in range(0, 2000, 50)) for i in some[:4])
    docs = docs_of(list(enumerate(texts)))
    want = {i: (many[i], low[i] < i) for i in range(2000)}
    for block in (lines.BLOCK, 300):
        got = {r["h1"]: (r["links"], r["doc_id"]) for r in lines.near_lines(docs, block=block).collect()}
        own = {lines._signed([lines._digest(t)[0]])[0].as_py(): i for i, t in enumerate(texts)}
        assert {own[h]: x for h, x in got.items()} == {i: (many[i], low[i]) for i in range(2000) if many[i]}
    got = {r["doc_id"]: r for r in lines.deduplicated_lines(docs).collect()}
    assert {i: (r["n_links"], r["n_near"] == 1) for i, r in got.items()} == want


def test_frequent_keys_meet_wherever_they_are_dealt(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lines, "_GATHER", 600)
    monkeypatch.setattr(lines, "_OFTEN", 20)
    monkeypatch.setattr(lines, "_COMPARED", 30)
    monkeypatch.setattr(lines, "_HELD", 900)
    texts = near_texts(250, 8) + ["".join(random.Random(i).choice("abcdefgh ") for _ in range(40)) for i in range(60)]
    many, _ = links_of(texts)
    deal = lambda some: list(lines._keys(32, 2, 4)(iter([pa.RecordBatch.from_pydict({"text": some})])))
    rows = sorted((b, h) for part in (texts[:100], texts[100:], texts[:7]) for x in deal(part) for b, h in zip(*(c.to_pylist() for c in x.columns)))
    assert any(b >= 4 for b, _ in rows)
    met = list(lines._meet(2, 4)(iter([pa.RecordBatch.from_pydict({"bucket": [b for b, _ in rows], "held": [h for _, h in rows]})])))
    members = {x for m in met for x in zip(*(c.to_pylist() for c in m.columns))}
    at = {lines._digest(t)[0] >> 1: i for i, t in enumerate(texts)}
    table = sorted((k, 0, 0, 0, at[line], 0, at[line], 0, texts[at[line]]) for k, line in members)
    names = ["key", "one", "other", "block", "h1", "h2", "doc_id", "place", "text"]
    found = lines._verifier(2, 32, 32, 4)(iter([pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*table)))))]))
    got = Counter()
    for x in found:
        for i, n in zip(x.column("h1").to_pylist(), x.column("links").to_pylist()):
            got[i] += n
    assert got == Counter({i: n for i, n in enumerate(many.tolist()) if n})


def test_lines_of_odd_rows(odd, none, docs_of):
    got = lines.deduplicated_lines(odd).collect()
    assert len(got) == 13 and {r["text"] for r in got if r["doc_id"] == 1} == {None}
    assert all(r["n_exact"] + r["n_near"] == 0 for r in got if r["doc_id"] != 6)
    same = "this line is long enough to be compared with others"
    df = docs_of([(1, same + "\nown"), (2, same), (3, same + "\n" + same), (4, same.replace("long", "lung") + "\nx")])
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.without_repeated_lines(df).collect()}
    assert out == {1: (same + "\nown", len(same) + 4), 4: ("x", 1)}
    assert lines.without_repeated_lines(odd).columns == odd.columns
    assert lines.deduplicated_lines(none).count() == lines.without_repeated_lines(none).count() == 0


def test_short_lines_against_all_pairs(spark, docs_of, tmp_path):
    import corpus_pipeline
    from cloister.llm import queries

    r = random.Random(5)
    pool = ["".join(r.choice("abcdefgh ") for _ in range(r.choice((1, 3, 8, 15, 16, 17, 24, 30, 31, 32, 33)))) for _ in range(40)]
    rows = []
    for i in range(60):
        some = []
        for _ in range(r.randrange(1, 6)):
            line = list(r.choice(pool))
            for _ in range(r.choice((0, 0, 1, 2))):
                at = r.randrange(len(line) + 1)
                line[at : at + 1] = r.choice(([], ["z"], ["y", "é"]))
            some.append("".join(line))
        rows.append((i, "\n".join([*some, "end", "   ", ""])))
    places = [(i, k, x) for i, t in rows for k, x in enumerate(t.split("\n")) if x.strip(" ")]
    near = lambda a, b: min(len(a), len(b)) >= 16 and distance(a, b) <= (2 if max(len(a), len(b)) >= 32 else 1)
    drop = {(i, k) for n, (i, k, x) in enumerate(places) if any(x == y or near(x, y) for _, _, y in places[:n])}
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in drop) for i, t in rows}
    docs = docs_of(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["doc_id"]: x["text"] for x in queries.op5_lines(spark, str(tmp_path)).collect()}
    assert got == want and any(len(x) < 16 for i, k, x in places if (i, k) in drop)
    stage = {x["doc_id"]: x["text"] for x in corpus_pipeline.line_stage(spark, docs, str(tmp_path)).collect()}
    assert stage == {i: t for i, t in want.items() if t.strip("\n")}


@given(st.text(max_size=600), st.text(max_size=40))
@settings(max_examples=150, deadline=None)
def test_chunks_cover_and_resist_insertions(text, more):
    data = text.encode()
    ends = chunks.chunk_ends(data)
    assert (ends or [0])[-1] == len(data) and all(0 < b - a <= chunks.LONGEST for a, b in zip([0, *ends], ends))
    for a, b in zip([0, *ends], ends):
        data[a:b].decode()  # never inside a character


def test_insertions_move_chunks_but_keep_them():
    r = random.Random(9)
    text = " ".join(f"w{r.randrange(5000)}" for _ in range(2000)).encode()
    cut = lambda t: [t[a:b] for a, b in zip([0, *chunks.chunk_ends(t)], chunks.chunk_ends(t))]
    before, after = set(cut(text)), set(cut(b"something new at the start, " + text[:5000] + b" and here " + text[5000:]))
    assert len(before - after) <= 6


def test_passages(docs_of):
    r = random.Random(4)
    prose = lambda n: " ".join(f"{r.choice('bcdfghlm')}{r.choice('aeiou')}{r.randrange(10_000)}" for _ in range(n))
    passage = prose(60)
    rows = [(i, prose(80) + (" " + passage + " " if i % 4 == 0 else " ") + prose(50)) for i in range(40)]
    out = chunks.repeated_passages(docs_of(rows)).collect()
    assert {x["doc_id"] for x in out} == {i for i in range(40) if i % 4 == 0}
    assert {x["first_doc_id"] for x in out} == {0} and [x["doc_id"] for x in out if not x["repeat"]] == [0]
    text = dict(rows)
    assert all(text[x["doc_id"]].encode()[x["start"] : x["start"] + x["length"]].decode() in passage for x in out)


def test_chunks_against_a_plain_count(spark):
    df = spark.read.parquet(SMALL)
    seen = defaultdict(list)
    for row in df.collect():
        data = (row["text"] or "").encode()
        ends = chunks.chunk_ends(data)
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            seen[data[a:b]].append((row["doc_id"], k, a, b - a))
    want = sorted(x for v in seen.values() if len(v) > 1 for x in v)
    assert sorted((r["doc_id"], r["nth"], r["start"], r["length"]) for r in chunks.repeated_chunks(df).collect()) == want


def test_passages_of_51_words_are_found_whole(docs_of):
    r = random.Random(12)
    prose = lambda n, least=1: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randrange(least, 8))) for _ in range(n))
    rows, want = [], set()
    for k in range(150):
        n = 50 if k % 5 == 0 else 51
        passage = " ".join(r.choice("abcdefghijklm") for _ in range(n)) if k % 3 == 0 else prose(n)
        for i in (2 * k, 2 * k + 1):
            before = prose(r.randrange(1, 90), 5) + f"{i % 2} "
            rows.append((i, before + passage + f" {i % 2}" + prose(r.randrange(1, 90), 5)))
            if n == 51:
                want.add((i, len(before.encode()), len(passage.encode()), 2 * k, i % 2 == 1))
    got = chunks.repeated_passages(docs_of(rows)).collect()
    assert {(x["doc_id"], x["start"], x["length"], x["first_doc_id"], x["repeat"]) for x in got} == want


def test_passages_shared_with_others_than_the_first(docs_of):
    r = random.Random(13)
    prose = lambda n: " ".join(f"w{r.randrange(100_000)}" for _ in range(n))
    phrase, long = prose(20), prose(40)
    rows = [(1, prose(60) + " " + phrase + " " + prose(60)), *[(i, prose(60) + " " + phrase + " " + long + " " + prose(60)) for i in (2, 3)]]
    got = {(x["doc_id"], x["first_doc_id"], dict(rows)[x["doc_id"]][x["start"] : x["start"] + x["length"]]) for x in chunks.repeated_passages(docs_of(rows)).collect()}
    assert got == {(i, 2, phrase + " " + long) for i in (2, 3)}


def plain_passages(rows, words):
    """Every row of repeated_passages, by the definition."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0], k))
    spans = {k: [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (rows[k][1] or "").encode())] for k in order}
    stands = defaultdict(list)
    for k in order:
        data = (rows[k][1] or "").encode()
        for n in range(len(spans[k]) - words + 1):
            a, b = spans[k][n][0], spans[k][n + words - 1][1]
            stands[data[a:b]].append((k, n, a, b))
    shared = defaultdict(dict)
    for places in stands.values():
        for place in places if len(places) > 1 else ():
            shared[place[0]][place[1]] = (place[2], place[3], rows[places[0][0]][0], place != places[0])
    out = []
    for k, found in shared.items():
        for n in sorted(found):
            a, b, first, later = found[n]
            if n - 1 in found:
                a0, _, count, first0, later0 = out[-1][1]
                out[-1] = (k, (a0, b, count + 1, min(first, first0), later or later0))
            else:
                out.append((k, (a, b, 1, first, later)))
    return Counter((rows[k][0], a, b - a, n, first, later) for k, (a, b, n, first, later) in out)


@pytest.mark.parametrize("words", [7, 51])
def test_passages_against_every_stretch(docs_of, words):
    r = random.Random(words)
    prose = lambda n: " ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 7))) for _ in range(n))
    shared = [prose(r.choice((words - 1, words, words + 20, 3 * words))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = " ".join(x for _ in range(r.randrange(1, 4)) for x in (prose(r.randrange(5, 60)), r.choice(shared)))
        rows.append((i // 2 if i % 9 == 0 else i, text))
    rows += [(500 + k, rows[k % 7][1]) for k in range(20)] + [rows[3], rows[3], (900, shared[2] + " " + shared[2])]
    docs = docs_of(rows)
    got = Counter((x["doc_id"], x["start"], x["length"], x["n_chunks"], x["first_doc_id"], x["repeat"]) for x in chunks.repeated_passages(docs, words=words).collect())
    # Rows equal in id have no order of their own: whole rows with other texts can only differ in what is earlier.
    assert got == plain_passages(rows, words) or {x[:5] for x in got} == {x[:5] for x in plain_passages(rows, words)}
    assert {x for x in got if x[0] > 200} == {x for x in plain_passages(rows, words) if x[0] > 200}
    clean = [(x["doc_id"], x["text"]) for x in chunks.without_repeated_passages(docs, words=words).collect()]
    left = {i: t for i, t in clean}
    assert left[1] == dict(rows)[1] or not any(x[0] == 1 and not x[5] for x in got)
    assert not {i for i in left if 500 <= i < 520} and all(" ".join(t.split()) for _, t in clean)
    whole = " ".join(t for _, t in sorted(clean, key=lambda x: x[0]))
    assert all(x in whole for x in shared if len(x.split()) >= words and any(x in t for _, t in rows))


def test_frequent_stretches_meet_wherever_they_are_dealt(monkeypatch):
    import pyarrow as pa

    for name, value in (("_OFTEN", 4), ("_MANY", 6), ("_TOGETHER", 400), ("_HELD", 300)):
        monkeypatch.setattr(chunks, name, value)
    r = random.Random(2)
    prose = lambda n: " ".join(f"w{r.randrange(100_000)}" for _ in range(n))
    often = prose(60)
    texts = [prose(20) + " " + (often if i % 3 else prose(55)) for i in range(60)]
    codec = pa.Codec("zstd", 1)
    part = lambda some: pa.RecordBatch.from_pydict({"doc_id": some, "k1": some, "size": [len(texts[i]) for i in some], "packed": [codec.compress(texts[i].encode(), asbytes=True) for i in some], "digests": [chunks.anchors(texts[i].encode())[0].view(np.int64).tolist() for i in some], "copies": [1] * len(some)}, schema=pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("size", pa.int64()), ("packed", pa.binary()), ("digests", pa.list_(pa.int64())), ("copies", pa.int64())]))
    rows = sorted((b, h) for some in (range(0, 25), range(25, 60)) for x in chunks._stretched(51, 3)(iter([part(list(some))])) for b, h in zip(*(c.to_pylist() for c in x.columns)))
    assert any(b >= 3 for b, _ in rows)
    out = [x for batch in chunks._alike(3)(iter([pa.RecordBatch.from_pydict({"bucket": [b for b, _ in rows], "held": [h for _, h in rows]})])) for x in batch.to_pylist()]
    firsts = [(x["h1"], x["h2"]) for x in out if x["kind"] == chunks._FIRST]
    assert len(firsts) == len(set(firsts)) and {(x["h1"], x["h2"]) for x in out if x["kind"] == chunks._OTHER} <= set(firsts)
    assert Counter((x["doc_id"], x["later"]) for x in out) == Counter({(i, i != 1): 10 for i in range(60) if i % 3})
    alone = pa.RecordBatch.from_pydict({"doc_id": [1], "k1": [1], "size": [len(texts[0])], "packed": [codec.compress(texts[0].encode(), asbytes=True)], "digests": pa.array([None], pa.list_(pa.int64())), "copies": [2]})
    whole = [np.frombuffer(h, chunks._STRETCH) for x in chunks._stretched(51, 3)(iter([alone])) for h in x.column("held").to_pylist()]
    assert [(x["kind"], x["nth"], x["start"], x["end"]) for h in whole for x in h] == [(chunks._WHOLE, 25, 0, len(texts[0]))]


def test_passages_of_odd_rows(odd, none):
    assert chunks.without_repeated_passages(odd).columns == odd.columns and chunks.without_repeated_passages(none).count() == 0
    assert Counter(r["doc_id"] for r in chunks.without_repeated_passages(odd).collect()) == Counter({i: 1 for i in (1, 2, 3, 4, 5, 6, 8)} | {7: 2, 9: 2, None: 2})
    got = {r["doc_id"] for r in chunks.repeated_passages(odd).collect()}
    assert {5, 6} <= got and not got & {1, 2, 3, 4}
    assert chunks.repeated_passages(none).count() == 0


def test_fingerprints_against_sets(spark):
    df = spark.read.parquet(SMALL)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(df, rows_per_bucket=30).collect()}
    parts = lambda t: set(fingerprints.digests(t).tolist())
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    import hashlib

    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        new = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and r["n_chars"] == len(t)
        assert abs(r["near_edited"] - like(parts(t), parts(new))) < 1e-12 and abs(r["near_next"] - like(parts(t), parts(after))) < 1e-12
    assert len({r["fingerprint"] for r in got.values()}) == len({t for _, t in rows})


def test_sketches_peel_and_retry():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 1, 5, 300, 4000)]
    assert fingerprints.likeness(sets, sets).tolist() == [1.0] * 5
    assert fingerprints.likeness(sets, [sets[0]] * 5).tolist() == [1.0, 0, 0, 0, 0]
    small = fingerprints.Sketches(np.array([1]), 0)
    small.add(np.zeros(300, np.int64), sets[3], np.ones(300, np.int64))
    assert not small.peel()[1][0]


def test_fingerprints_of_odd_rows(odd, none):
    got = fingerprints.fingerprint(odd, rows_per_bucket=3).collect()
    assert len(got) == 13 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 0}) == 1
    assert fingerprints.fingerprint(none).count() == 0
    one = fingerprints.fingerprint(odd.filter("doc_id = 4")).collect()
    assert [(r["near_next"], r["edited_fingerprint"] == r["fingerprint"]) for r in one] == [(1.0, False)]
