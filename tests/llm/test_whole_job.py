"""Each stage's whole job against plain brute force, on small tables made for it."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from kvlens.llm import html_text, neighbours, shingles


def shingle_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited_copies():
    """Texts with copies that have evenly spread words replaced, similarity 0.7 to 0.97, and texts with one common line."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    line = [word() for _ in range(40)]
    out = []
    for n in (60, 150, 400, 900):
        for share in (0.97, 0.92, 0.87, 0.83, 0.81, 0.76, 0.7):
            base = [word() for _ in range(n)] + (line if rng.random() < 0.5 else [])
            changed = list(base)
            for k in range(max(1, round(len(base) * (1 - share) / (1 + share) / 5))):
                changed[min(len(base) - 1, 3 + k * (len(base) // max(1, round(len(base) * (1 - share) / (1 + share) / 5))))] = word()
            out += [base, changed]
    return [(i, " ".join(t)) for i, t in enumerate(out)]


def brute_components(sets):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            x, y = sets[a], sets[b]
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k in keys}


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_pipeline_edited_copies(spark, data):
    texts = edited_copies()
    want = brute_components({i: shingle_set(t) for i, t in texts})
    pairs = [(i, i + 1) for i in range(0, len(texts), 2)]
    shares = [len(shingle_set(texts[a][1]) & shingle_set(texts[b][1])) / len(shingle_set(texts[a][1]) | shingle_set(texts[b][1])) for a, b in pairs]
    assert sum(0.8 <= s < 0.95 for s in shares) >= 10 and sum(s < 0.8 for s in shares) >= 4
    got = {r.doc_id for r in pipeline.drop_near_copies(spark, table(spark, texts), data).select("doc_id").collect()}
    assert got == set(want.values())


def test_pipeline_near_copies_of_given_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = brute_components({r.doc_id: shingle_set(r.text) for r in docs.collect()})
    assert {r.doc_id for r in pipeline.drop_near_copies(spark, docs, data).collect()} == set(want.values())


def test_op1_settles_or_raises(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2500, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    _, units, dim = neighbours.nodes_of(df, "vec_id", "embedding", 6)
    with pytest.raises(RuntimeError, match="not settled"):
        neighbours.graph(units, dim, degree=8, rounds=1)
    lists = {r.node for r in neighbours.graph(units, dim, degree=8).collect()}
    assert len(lists) == len(x)


def test_op1_beam_grows():
    assert neighbours.width(500) == neighbours.BEAM < neighbours.width(100_000) < neighbours.width(1_000_000)


def test_op10_repeats_over_a_whole_host(spark):
    """A passage on two pages of a host of many shards goes from both; words of one page stay."""
    rng = random.Random(9)
    some = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    own = [some(12) for _ in range(60)]
    passage = [some(9) for _ in range(30)]
    rows = [(i, f"https://one.example/{i}", f"<div>{passage[i % 30]}</div><p>{own[i]}</p>") for i in range(60)]
    rows.append((60, "https://two.example/1", f"<div>{passage[0]}</div>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df, shard=4).collect()}
    assert got == {**dict(enumerate(own)), 60: passage[0]}


@pytest.mark.parametrize("shard", [4, 256])
def test_op10_boilerplate_inside_articles(spark, shard):
    """A notice in every article of a host goes; a passage that two articles quote stays, and so do articles that are whole copies."""
    rng = random.Random(10)
    some = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    own, notice, quote, copy = [some(12) for _ in range(20)], some(10), some(10), some(20)
    rows = [(i, f"https://one.example/{i}", f"<article><p>{own[i]}</p>{f'<p>{quote}</p>' if i < 2 else ''}<p>{notice}</p></article>") for i in range(20)]
    rows += [(20 + i, f"https://two.example/{i}", f"<article><p>{copy}</p></article>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df, shard=shard).collect()}
    assert got == {**{i: own[i] + ("\n" + quote if i < 2 else "") for i in range(20)}, **{20 + i: copy for i in range(5)}}


def test_op10_keeps_what_is_not_marked():
    """Class words within other names drop nothing; nor does a teaser article drop the text beside it."""
    texts = lambda page: html_text.main_texts([1], [page])[0]
    assert texts("<article class='post category-legal comments-open'><p>one</p><section class='discussion'>two</section></article>") == "one\ntwo"
    assert texts("<div class='top-story-search-engines'>one</div><div id='social-history'>two</div>") == "one\ntwo"
    assert texts("<div class='text'>the main text</div><article>a teaser</article>") == "the main text\na teaser"
    assert texts("<div class='site-footer'>a</div><div class='ad'>b</div><div id='commentList'>c</div><div class='share-buttons'>d</div><div role='search'>e</div><nav>f</nav><p>g</p>") == "g"
    assert texts("<article><p>one</p><div class='sidebar-left ad-slot-2'>a</div><aside>b</aside></article>") == "one"


def test_pipeline_repeated_and_null_ids(spark, data):
    """Rows count, not ids: unrelated texts of one doc_id stay, near copies of null doc_ids go."""
    rng = random.Random(4)
    some = lambda: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(60))
    a, b, c, d = some(), some(), some(), some()
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b + " more"), (None, c), (None, c + " more"), (None, a), (None, d), (4, d)]
    got = sorted((r.doc_id or 0, r.text) for r in pipeline.drop_near_copies(spark, table(spark, rows), data).collect())
    assert [i for i, _ in got] == [0, 1, 2, 4]
    assert got[1:] == [(1, a), (2, b), (4, d)] and got[0][1] in (c, c + " more")


def versions():
    """Texts whose shingles are a base's but for many edits: a few are near copies, most only of the base's next versions."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    base = [word() for _ in range(400)]
    out = []
    for i in range(120):
        text = list(base)
        for at in rng.sample(range(400), 1 + i % 40):
            text[at] = word()
        out.append((i, " ".join(text)))
    return out


def test_pipeline_versions_of_one_text(spark, data, monkeypatch):
    """Versions at every distance from a text are told apart without comparing all pairs of those that aren't linked."""
    texts, compared = versions(), []
    verified = shingles.verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(shingles, "verified", counted)
    want = brute_components({i: shingle_set(t) for i, t in texts})
    got = {r.doc_id for r in pipeline.drop_near_copies(spark, table(spark, texts), data).select("doc_id").collect()}
    assert got == set(want.values())
    assert sum(compared) < len(texts)


def test_pipeline_prefixes_count_over_all_sets(spark):
    """Places follow counts over all sets: a set's own shingles come first, and one that is in a single set is no entry."""
    texts = versions()
    own = {t: shingle_set(t) for _, t in texts}
    times = Counter(s for x in own.values() for s in x)
    sets = shingles.with_set(table(spark, texts), keep=["text"])
    name = {r.sig: r.text for r in sets.select("sig", "text").collect()}
    rows = shingles.prefixes(sets).collect()
    assert rows and all(r.alone == sum(times[s] == 1 for s in own[name[r.sig]]) <= r.at < r.n - shingles.needed(r.n) + 1 for r in rows)
    first = {x: sorted((times[s] for s in own[x]))[: len(own[x]) - shingles.needed(len(own[x])) + 1] for x in own}
    assert Counter(name[r.sig] for r in rows) == Counter({x: m for x, f in first.items() if (m := sum(c > 1 for c in f))})
    at = {}
    for r in rows:
        at.setdefault(name[r.sig], []).append((r.at, r.token))
    assert all(len(set(p)) == len(p) == len({k for _, k in p}) for p in at.values())


def test_op1_search_holds_one_row_a_query(spark, monkeypatch):
    """A hop writes one row for each query, whatever the beam; a beam as large as the graph finds each node once."""
    x = np.random.default_rng(6).standard_normal((600, 16))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    vectors, units, dim = neighbours.nodes_of(df, "vec_id", "embedding", 6)
    lists = neighbours.graph(units, dim, degree=8)
    queries = vectors.limit(7).select(vectors["node"].alias("q")).localCheckpoint()
    kept, written = [], neighbours.written

    def counted(frame, name):
        out = written(frame, name)
        kept.append((name, out.count()))
        return out

    monkeypatch.setattr(neighbours, "written", counted)
    found = neighbours.search(queries, units, lists, beam=600).collect()
    assert {name for name, _ in kept} == {"ann-beam"} and {n for _, n in kept} == {7}
    assert len(found) == len({(r.q, r.node) for r in found}) == 7 * 600


def random_vectors(spark, n, dim, seed):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"), x / np.linalg.norm(x, axis=1, keepdims=True)


def test_op1_search_has_no_row_for_what_it_looks_at(spark, monkeypatch):
    """A search writes once, not at each hop, and one row for each query; what is scored exactly grows with the result asked for, not with the beam."""
    df, unit = random_vectors(spark, 1500, 32, 8)
    vectors, units, dim = neighbours.nodes_of(df, "vec_id", "embedding", 6)
    lists = neighbours.graph(units, dim, degree=8)
    queries = vectors.limit(9).select(vectors["node"].alias("q")).localCheckpoint()
    kept, written = [], neighbours.written

    def counted(frame, name):
        out = written(frame, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "written", counted)
    whole = {(r.q, r.node) for r in neighbours.search(queries, units, lists, beam=1500).collect()}
    likely = {(r.q, r.node) for r in neighbours.search(queries, units, lists, beam=1500, keep=6).collect()}
    assert kept == [9, 9] and likely < whole and len(likely) < 9 * 60
    id_of = {r.node: r.ids[0] for r in vectors.collect()}
    for q in {q for q, _ in whole}:
        score = unit @ unit[id_of[q]]
        assert set(np.argsort(-score)[:6].tolist()) <= {id_of[n] for p, n in likely if p == q}


@pytest.mark.parametrize("clusters", [0, 60])
def test_op1_blocks_find_what_lies_in_others(spark, clusters):
    """Blocks of 500 nodes, graphs of small leaves: the nearest of other blocks are found, also where clusters keep graphs apart."""
    df, unit = random_vectors(spark, 3000, 24, 9)
    if clusters:
        rng = np.random.default_rng(10)
        x = rng.standard_normal((clusters, 24))[np.arange(3000) % clusters] + 0.01 * rng.standard_normal((3000, 24))
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    _, units, dim = neighbours.nodes_of(df, "vec_id", "embedding", 6)
    assert len(neighbours.graph(units, dim, held=500 * 24, leaf=64).blocks) == 6
    found = {}
    for r in neighbours.nearest(df, lambda c: c % 50 == 0, beam=100, held=500 * 24, leaf=64).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 50):
        score = unit @ unit[q]
        score[q] = -9
        hits += len(found[q] & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.95 * 5 * 60


def test_op1_odd_rows(spark):
    """No rows, one id, unusable rows, copies, ties and vectors of unequal length."""
    def nearest(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in neighbours.nearest(df, lambda c: c % 50 == 0).collect())

    assert nearest([]) == nearest([(0, [1.0, 2.0])]) == nearest([(0, [0.0, 0.0]), (50, None), (None, [1.0, 0.0]), (100, [1.0, float("nan")])]) == []
    got = nearest([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0]), (2, [0.0, 1.0]), (1, [0.0, -1.0]), (50, [0.0, 0.0]), (4, [2.0, 0.0])])
    assert got == [(0, 1, 3, 1.0), (0, 2, 4, 1.0), (0, 3, 1, 0.0), (0, 4, 2, 0.0)]
