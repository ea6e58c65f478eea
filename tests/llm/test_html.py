"""Main texts of pages against a plain whole-host count of runs, and hand-made pages with their texts."""

import random
from collections import Counter, defaultdict

import pytest

from kvlens.llm import html_text


def plain(rows):
    """The rule by dictionaries of runs: what stands on two pages goes outside articles, what stands in half of the rows inside them."""
    found = [(html_text.blocks(html or ""), url.split("/")[2] if url else "", i) for i, url, html in rows]
    on, of, many = defaultdict(set), Counter(), Counter(h for _, h, _ in found)
    words = [[w for t, *_ in b for w in t.split(" ")] for b, *_ in found]
    for w, (_, h, i) in zip(words, found, strict=True):
        for run in {tuple(w[k : k + 8]) for k in range(len(w) - 7)}:
            on[h, run].add(i)
            of[h, run] += 1
    out = []
    for w, (b, h, _) in zip(words, found, strict=True):
        boiler, common = [False] * len(w), [False] * len(w)
        for k in range(len(w) - 7):
            run = h, tuple(w[k : k + 8])
            if len(on[run]) > 1:
                boiler[k : k + 8] = [True] * 8
                if of[run] >= max(3, -(-many[h] // 2)):
                    common[k : k + 8] = [True] * 8
        at, parts = 0, []
        for t, kind, inside in b:
            n = len(t.split(" "))
            parts.append((t, kind, inside, boiler[at : at + n], common[at : at + n]))
            at += n
        copies = all(all(c) for _, kind, inside, _, c in parts if inside and kind != html_text.DROP)
        kept = []
        for t, kind, inside, x, c in parts:
            if kind == html_text.DROP or inside and all(c) and not copies:
                continue
            t = t if inside else " ".join(v for v, gone in zip(t.split(" "), x, strict=True) if not gone)
            kept += [t] if t else []
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("shard", [1, 3, 4096])
def test_any_shards_give_the_whole_hosts_result(spark, shard):
    """Few words, so that runs repeat by chance; shared passages, repeated and null page_ids, null urls and pages."""
    rng = random.Random(11)
    word = lambda: rng.choice("abc")
    some = lambda n: " ".join(word() for _ in range(n))
    notes = [some(20) for _ in range(4)]
    rows = []
    for i in range(90):
        host = rng.choice(["one", "one", "one", "two", "three"])
        body = f"<div>{some(rng.randrange(30))}</div><p>{rng.choice(notes)}</p>" + (f"<article><h1>{some(5)}</h1><p>{some(rng.randrange(25))}</p><p>{notes[0]}</p></article>" if rng.random() < 0.5 else "")
        rows.append((i if i % 11 else 7, f"https://{host}.example/{i}", body))
    rows += [(200, None, f"<p>{notes[1]}</p>"), (201, None, f"<p>{notes[1]} x</p>"), (202, "https://two.example/n", None), (203, "https://two.example/e", ""), (204, "https://solo.example/", "<p>two words</p>"), (205, "https://solo2.example/", "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, key int").repartition(5)
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(df, shard=shard).collect())
    assert got == Counter((i, u, t, len(t)) for (i, u, _), t in zip(rows, plain(rows), strict=True))


def test_null_page_ids_and_no_rows(spark):
    schema = "page_id long, url string, html string"
    text = "one two three four five six seven eight nine"
    rows = [(None, "https://a.example/1", f"<p>{text}</p>")] * 2 + [(None, "https://b.example/1", f"<p>{text}</p>"), (None, "https://b.example/2", f"<p>{text} ten</p>")]
    assert sorted(r.text for r in html_text.extract(spark.createDataFrame(rows, schema)).collect()) == ["", text, text, "ten"]
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
    assert html_text.main_texts([], []) == [] and html_text.main_texts([1, 2], [None, ""]) == ["", ""]


PAGES = [
    ("<html><head><title>t</title></head><body><nav><a>menu</a></nav><article><h1>A &amp; B</h1><p>one\n two<br>three</p><p>&nbsp;&#8220;four&#x201d;</p></article><footer>foot</footer></body></html>", "A & B\none two three\n“four”"),
    ("<div id='page'><div class='cookie-notice'>we use cookies</div><main><p>kept</p><div class='ad'>buy</div></main><aside>side</aside></div>", "kept"),
    ("<article><p>text</p><form><p>name</p></form><script>x='<p>no</p>'</script><style>p{}</style><section class='comments'><p>first!</p></section></article>", "text"),
    ("<!-- a comment <p>no</p> --><p>a<b>b</b>c<i> d</i></p><ul><li>e<li>f</ul><table><tr><td>g<td>h</table>", "abc d\ne\nf\ng h"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
    ("plain text, no markup", "plain text, no markup"),
    ("<p>", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_hand_made_pages(page, text):
    assert html_text.main_texts([1], [page]) == [text]


def test_suffix_array_decides(spark):
    """With no run long enough to repeat, unmarked boilerplate stays: what removes it is the array alone."""
    rng = random.Random(2)
    some = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12))
    line, own = some(), [some() for _ in range(3)]
    df = spark.createDataFrame([(i, "https://a.example/", f"<p>{line}</p><p>{x}</p>") for i, x in enumerate(own)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == dict(enumerate(own))
    assert {r.page_id: r.text for r in html_text.extract(df, long=30).collect()} == {i: f"{line}\n{x}" for i, x in enumerate(own)}
