"""The chunk encoder, the control-byte codec and token files against the library and plain loops."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers as P
from kvlens.llm import token_files
from kvlens.llm.encoding import ChunkEncoder

ODD = [
    "", " ", "a", "  lead", "tail  ", "a\n\nb c,d. e ,f ...x don't DON'T we'll  x hi", "<|endoftext|> Hi <|ENDOFTEXT|> x", "İstanbul é É ÀÉ ß ẞ",
    "x" * 5000, "1,000.5 a.b,c", "\t\ta,\r\n b", "中文，测试。 a", "é ́a,b", "\x00 a\x00b, c", "ſ K Å,", "a  b　c", "﷐", "one ﷐, two", "some plain words, and more.", None,
]


@pytest.mark.parametrize(("name", "kind", "dtype"), [("word_bpe_49k.json", "word", "<u2"), ("byte_bpe_50k.json", "byte", "<u4")])
@pytest.mark.parametrize("cache", [0, 1000])
def test_encoder_is_the_library(name, kind, dtype, cache):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path(name))
    e = ChunkEncoder(P.path(name), kind, dtype, cache)
    for _ in range(2):  # with an empty cache, and with what is kept
        ids, count = e.encode_array(pa.array(ODD, pa.string()), 7)
        at = np.cumsum(count)
        for text, a, b in zip(ODD, at - count, at, strict=True):
            assert ids[a:b].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 7]
    assert len(e.known) == len(e.size) and len(e.flat) == e.size.sum()
    assert cache or len(e.known) == 1


def test_numbers_of_every_length():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        x = rng.integers(0, 1 << rng.integers(1, 33, n), dtype=np.uint64).astype("<u4") if n else np.empty(0, "<u4")
        control, data = token_files.pack_numbers(x)
        assert len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in x) == token_files.data_size(np.frombuffer(control, np.uint8), n)
        assert token_files.unpack_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data + b"rest", np.uint8), n).tolist() == x.tolist()


def test_many_files_and_one_hot_doc_id(spark, tmp_path):
    """Files end at their size, ``start`` runs on over them, and repeated doc_ids keep all their rows."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [(i if i % 3 else 0, f"text number {i} " * (i % 7), "x") for i in range(200)] + [(None, "no id", "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string").repartition(3)
    manifest, folder = token_files.write(df, P.path("word_bpe_49k.json"), "word", file_bytes=200)
    assert manifest.count() > 8
    got = sorted(token_files.read(manifest, folder, manifest.doc_id_field).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert [r.doc_id or 0 for r in got] == sorted(r[0] or 0 for r in rows) and [r.doc_id for r in got[:2]] == [None, None]
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t, _ in rows]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((d or -1, len(b) // 4, zlib.crc32(b)) for (d, _, _), b in zip(rows, ids, strict=True))
