import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import bytebpe, tokenfile, tokens
from tickloom.session import shared_dir


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def noisy(spark, tmp_path_factory):
    """Random texts over characters where splitters might differ."""
    rng = random.Random(7)
    pool = [*"ab zZ'  \n\t09.,!?-_’“”–…€œŒ", "'s", "'ll", "'t", "  ", " \n", " ", "\x85", "\x1c", "­", "²", "½", "ª", "é", "ß", "漢", "🙂", "<|endoftext|>",
            " ", "　", "á", "٠", "<|end", "\x00", "\x7f"]
    rows = [(i, "".join(rng.choice(pool[: 30 if i % 2 else len(pool)]) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    path = str(tmp_path_factory.mktemp("noisy") / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    return spark.read.parquet(path), dict(rows)


def test_ids_and_round_trip_equal_the_tokenizer(whole, noisy):
    docs, texts = noisy
    encoded = tokens.encode(docs)
    got = tokens.decode(encoded).collect()
    assert len(got) == len(texts)
    for r in got:
        want = whole.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want, repr(texts[r.doc_id])
        assert r.decoded == whole.decode(want, skip_special_tokens=False)


def test_decoding_of_any_ids(spark, whole):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(50257) for _ in range(rng.randint(0, 20))]) for i in range(200)] + [(500, None), (501, [])]
    got = {r.i: r.decoded for r in tokens.decode(spark.createDataFrame(rows, "i int, ids array<int>")).collect()}
    for i, ids in rows:
        assert got[i] == whole.decode(ids or [], skip_special_tokens=False)
    bad = spark.createDataFrame([([5, -1, None, 60000],)], "ids array<int>")
    assert tokens.decode(bad).first().decoded == whole.decode([5])


def test_odd_rows(odd, odd_rows, none, whole):
    got = sorted(((r.doc_id, r.ids) for r in tokens.encode(odd).collect()), key=str)
    assert got == sorted(((i, whole.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in odd_rows), key=str)
    assert tokens.digests(none).count() == 0


def test_token_files(spark, noisy, whole):
    import zlib

    docs, texts = noisy
    manifest = tokenfile.write(docs, shared_dir(spark, "t"), end_id=0)
    got = {r.doc_id: r for r in tokenfile.read_documents(manifest, docs.schema["doc_id"].dataType).collect()}
    at = 0
    for i in sorted(texts):
        ids = whole.encode(texts[i], add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_of_odd_rows(spark, odd, odd_rows, none):
    kind = odd.schema["doc_id"].dataType
    back = tokenfile.read_documents(tokenfile.write(odd, shared_dir(spark, "t"), end_id=None), kind).collect()
    assert sorted(str(r.doc_id) for r in back) == sorted(str(i) for i, *_ in odd_rows)
    order = [r.doc_id for r in sorted(back, key=lambda r: (r.start, r.n_tokens))]
    assert [x for x in order if x is not None] == sorted(i for i, *_ in odd_rows if i is not None)
    assert tokenfile.read_documents(tokenfile.write(none, shared_dir(spark, "t")), kind).count() == 0


def test_a_reader_opens_only_the_frames_it_needs(tmp_path, monkeypatch):
    import io

    import pyarrow as pa
    import zstandard

    monkeypatch.setattr(tokenfile, "FRAME_IDS", 100)
    rng = np.random.default_rng(1)
    counts = np.array([30, 0, 90, 5, 1000, 0, 60, 70, 3])
    ids = rng.integers(0, 50257, counts.sum()).astype(np.uint32)
    for width in (2, 4):
        sink = io.BytesIO()
        writer = tokenfile.Writer(sink, width, pa.int64())
        writer.add(pa.array(range(4), pa.int64()), ids[:125], counts[:4])
        writer.add(pa.array(range(4, 9), pa.int64()), ids[125:], counts[4:])
        assert writer.close()[:2] == (9, counts.sum())
        path = tmp_path / f"f{width}"
        path.write_bytes(sink.getvalue())
        from pyarrow import fs
        with fs.LocalFileSystem().open_input_file(str(path)) as f:
            reader = tokenfile.Reader(f)
            ends = np.cumsum(counts)
            assert [x.tolist() for _, x in reader.all()] == [ids[e - n:e].tolist() for e, n in zip(ends, counts)]
            opened = []
            frame = reader.frame
            reader.frame = lambda k: opened.append(k) or frame(k)
            for row in range(9):
                opened.clear()
                assert reader.ids(row).tolist() == ids[ends[row] - counts[row]:ends[row]].tolist()
                assert len(opened) <= max(1, counts[row] // 100 + 2)
        plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(sink.getvalue())
        assert np.frombuffer(plain, f"<u{width}").tolist() == ids.tolist()
        broken = bytearray(sink.getvalue())
        broken[20] ^= 1
        path.write_bytes(bytes(broken))
        with fs.LocalFileSystem().open_input_file(str(path)) as f, pytest.raises(Exception):
            list(tokenfile.Reader(f).all())


def test_words_of_the_fast_path(whole):
    t = bytebpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    words = [" hello", "Ünïcode", "  ", "\n\n", "<|endoftext|>", "'ll", "12345", "…", "naïvetés"]
    ids, lens = t.encode_words(words)
    want = [whole.encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]
