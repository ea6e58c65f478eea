"""The ten queries and the pipeline against plain brute force on the small tables."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest

import public_tokenizers as P
from kvlens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, data):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def pages(spark, data):
    return {r.page_id: r.html or "" for r in spark.read.parquet(f"{data}/pages.parquet").collect()}


def rows(spark, data, name):
    return QUERIES[name](spark, data).collect()


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_op1_recall(spark, data):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect() if r.embedding is not None and None not in r.embedding}
    vectors = {i: v for i, v in vectors.items() if np.isfinite(v).all() and np.linalg.norm(v) > 0}
    ids = np.array(sorted(vectors))
    unit = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in ids.tolist()])
    got = {}
    for r in rows(spark, data, "op1_nn_descent"):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 50 == 0].tolist():
        score = unit @ unit[np.searchsorted(ids, q)]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:5]
        found = sorted(got[q])
        assert [x[0] for x in found] == list(range(1, len(order) + 1))
        for _, v, s in found:
            assert abs(s - score[np.searchsorted(ids, v)]) < 1e-9
        hits += len({int(ids[j]) for j in order} & {v for _, v, _ in found})
        total += len(order)
    assert hits >= 0.9 * total


def test_op2_held_out(spark, data, docs):
    got = {r.doc_id: r for r in rows(spark, data, "op2_toxicity")}
    assert got.keys() == docs.keys()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [i for i in got if got[i].held_out and label.get(i) is not None]
    assert np.mean([got[i].predicted == label[i] for i in held]) >= 0.9


def test_op3_ids(spark, data, docs):
    from tokenizers import Tokenizer

    t, at = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    got = sorted(rows(spark, data, "op3_token_files"), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == sorted(docs)
    for r in got:
        ids = [*t.encode(docs[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(little(ids)))
        at += len(ids)


def test_op4_ids(spark, data, docs):
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, data, "op4_byte_bpe")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        ids = t.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(little(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_op5_spans(spark, data, docs):
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = rows(spark, data, "op5_secret_scan")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        t = docs[r.doc_id]
        kinds = [
            [m.span() for m in assign.finditer(t) if len(m[1]) >= 8],
            [m.span() for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16],
            [m.span() for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32],
        ]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, kinds))
        spans = sorted((a, k, b) for k, found in enumerate(kinds) for a, b in found)
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_op6_records(spark, data, pages):
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = rows(spark, data, "op6_warc")
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        raw = pages[r.page_id].encode()
        head = first[pages[r.page_id]]
        revisit = len(raw) >= 100 and head != r.page_id
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", head) if revisit else ("response", None))


def test_op7_pieces(spark, data, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc, by_bin = {}, {}
    for r in rows(spark, data, "op7_packing"):
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == docs.keys()
    for i, found in by_doc.items():
        ids, at = [*t.encode(docs[i], add_special_tokens=False).ids, 0], 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(little(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    padded = used = 0
    for found in by_bin.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        used += at
        padded += at if at & (at - 1) == 0 else 1024
    assert used >= 0.98 * padded


def test_op8_round_trip(spark, data, docs):
    got = rows(spark, data, "op8_matroska")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        raw = docs[r.doc_id].encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def prints(text):
    import xxhash

    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op9_components(spark, data, docs):
    fp = {i: prints(t) for i, t in docs.items()}
    ids, root = sorted(fp), {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = rows(spark, data, "op9_simhash")
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fp[i]:016x}", find(i)) for i in fp}


def test_op10_pages(spark, data, pages):
    got = rows(spark, data, "op10_html_text")
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.n_chars == len(r.text)
        assert r.text == r.text.strip() and not re.search(r"<(?:script|nav|footer|form)\b", r.text)


def test_pipeline_stages(spark, data, docs):
    import corpus_pipeline as pipeline

    table = spark.read.parquet(f"{data}/documents.parquet")
    kept = pipeline.drop_near_copies(spark, table, data)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    least = {}
    for i in sorted(docs):
        least.setdefault(docs[i], i)
    assert set(ids) <= set(least.values())
    clean = {r.doc_id: r for r in pipeline.redact_secrets(spark, table, data).collect()}
    assert clean.keys() == docs.keys()
    assert all(not re.search("AKIA[A-Z0-9]{12}", r.text or "") for r in clean.values())
    assert pipeline.pack_sequences(spark, table, data).select("doc_id").distinct().count() == len(docs)


@pytest.mark.parametrize("name", ["op4_byte_bpe", "op5_secret_scan", "op7_packing", "op8_matroska", "op9_simhash", "op3_token_files"])
def test_edges(spark, tmp_path, name):
    """Null and empty texts, repeated rows, an extra column with a clashing name; then no rows at all."""
    rows_ = [(1, None, "x"), (2, "", "y"), (3, "some words here token=abcdefgh12345", "z"), (3, "some words here token=abcdefgh12345", "z"), (4, "é" * 50_000, None)]
    schema = "doc_id long, text string, fp string"
    spark.createDataFrame(rows_, schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in QUERIES[name](spark, str(tmp_path)).collect()} == {1, 2, 3, 4}
    none = tmp_path / "none"
    spark.createDataFrame([], schema).write.parquet(str(none / "documents.parquet"))
    assert QUERIES[name](spark, str(none)).collect() == []
