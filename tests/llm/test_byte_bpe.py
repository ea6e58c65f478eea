"""Byte BPE against the tiktoken library; long slices, offsets, and ranges of ids."""

import base64
import random
import time

import numpy as np
import pytest

import public_tokenizers as P
from kvlens.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_slices_are_merged_as_short_ones(library):
    rng = random.Random(3)
    vocabulary = byte_bpe.Vocabulary(PATH)
    texts = ["a" * 1000, "ab" * 700, "".join(rng.choices("abcdefgh", k=3000)), "".join(rng.choices("the and ofing", k=900)).replace(" ", ""), "é" * 600, "=" * 500]
    for t in texts:
        want = library.encode_ordinary(t)
        assert np.frombuffer(vocabulary.merge_long(t.encode()), "<u4").tolist() == want
        assert vocabulary.merge([t.encode()])[0] == vocabulary.merge_long(t.encode())
    assert vocabulary.merge_long(b"a") == vocabulary.merge([b"a"])[0]


def test_a_million_letters(library):
    text = "".join(random.Random(4).choices("abcdefghijklmnop", k=1_000_000))
    start = time.process_time()
    ids, _ = byte_bpe.Encoder(PATH).encode([text])
    assert time.process_time() - start < 60
    assert np.frombuffer(ids[0], "<u4").tolist() == library.encode_ordinary(text)


def test_offsets_decode_any_range(spark, library):
    rows = [(1, "Some words, 12 numbers\n\nand é中文 ", "x"), (2, "", "y"), (3, None, "z"), (3, "repeated", None), (3, "repeated", None), (4, "w" * 2000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offsets string")
    found = byte_bpe.encode(df, PATH, keep=["doc_id", "text"])
    got = byte_bpe.decode(found, PATH).collect()
    e = byte_bpe.Encoder(PATH)
    assert len(got) == len(rows)
    for r in got:
        raw = (r.text or "").encode()
        assert r.decoded == raw and r.offsets[0] == 0 and r.offsets[-1] == len(raw)
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        n = len(r.offsets) - 1
        for a in range(0, n, 3):
            b = min(n, a + 4)
            assert e.decode(r.ids, np.array(r.offsets), a, b) == raw[r.offsets[a] : r.offsets[b]]
    with pytest.raises(ValueError, match="offsets"):
        e.decode(got[0].ids, np.array(got[0].offsets) + np.arange(len(got[0].offsets)))


def test_boundaries_are_the_patterns_matches():
    regex = pytest.importorskip("regex")
    rng = random.Random(5)
    for _ in range(300):
        t = "".join(rng.choice(["a", "s", "'", "ll", "'re", " ", "  ", "\n", "\t", "1", "é", "٣", "中", "!", ".", " ", "’", "D"]) for _ in range(rng.randrange(1, 40)))
        points = np.append(np.frombuffer(t.encode("utf-32-le"), "<u4"), 0x110000).astype(np.uint32)
        assert byte_bpe.boundaries(points).tolist() == [m.start() for m in regex.finditer(P.PATTERN, t)]
