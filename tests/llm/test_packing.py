import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seclake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "a b  c\n\nd \t e", " lead and trail ", "x y   z\x85q \x1c r", "it's we'll 'tis 12 34", "a<|endoftext|>b <|endoftext|> c",
         "éè 中文 \U0001f600 ok", "a.\nB c,\n\nd e\n f \ng", "x's it's. don't!' 'll' a'", "m²! n½?! \n", "-- a-- b\n-- c\n", "a\t.\nb \xa0c\xa0 d", "\n", "a\n", " \n ", "É!!\r\nx\r\ny", "a<|endoftext|>", "<|endoftext|>", "<|endoftext|>a", "a<|endoftext|>.", "a <|endoftext|>\nb", "a\n<|endoftext|>\n", "<|endoftext|", "nul\0in a\0 text\n", "a\0", "word " * 5000, "z" * 30_000, "one two three " * 900, "tab\tspace \n line\r\n end"]


def test_ids_equal_the_tokenizers():
    plain = Tokenizer.from_file(PATH)
    for memo in range(2):
        encoder = packing.Encoder(PATH)
        got = encoder.many([t or "" for t in TEXTS]) if memo else [encoder.many([t or ""])[0] for t in TEXTS]
        for text, ids in zip(TEXTS, got):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_ids_of_random_texts():
    """20,000 texts over an alphabet of everything that parts or joins words, the special token among it."""
    import random
    draw, plain = random.Random(7), Tokenizer.from_file(PATH)
    alphabet = [" ", " ", " ", "\n", "a", "The", "word", "é", "²", "12", ".", ",", "!", "'s", "'", "-", "\t", "\x1c", "\xa0", "<|endoftext|>", "|>", "<", "中", "\U0001f600", "\r", "\0"]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(1, 12))) for _ in range(20_000)]
    encoder = packing.Encoder(PATH)
    for k in range(0, len(texts), 500):
        some = texts[k:k + 500]
        for text, ids, e in zip(some, encoder.many(some), plain.encode_batch(some, add_special_tokens=False)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == e.ids, repr(text)


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (20, [(0, 4), (4, 8), (12, 8)])])
def test_pieces(n, want):
    assert packing.pieces_of(n, 8) == want


@pytest.mark.parametrize("seed", range(20))
def test_plan_holds_every_piece(seed):
    draw = np.random.default_rng(seed)
    histogram = {int(x): int(n) for x, n in zip(draw.integers(1, 65, 40), draw.integers(1, 500, 40))}
    kinds = packing.plan(histogram, 64)
    held = Counter()
    for content, number in kinds:
        assert number > 0 and sum(x * m for x, m in content) <= 64
        for x, m in content:
            held[x] += m * number
    assert held == histogram
    least = -(-sum(x * n for x, n in histogram.items()) // 64)
    assert sum(n for _, n in kinds) <= least * 1.25 + 1


def check(rows, texts, room):
    """rows: (doc, piece, start, length, crc, sequence, offset); texts: by doc."""
    plain = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in texts:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, (s, n) in enumerate(packing.pieces_of(len(ids), room)):
            want[doc, k, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r[5]].append((r[6], r[3]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(filled)


def test_pack(spark):
    texts = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "other"), (None, "no id"), (None, None)] + [(100 + i, "same length text") for i in range(300)]
    docs = spark.createDataFrame([(i, t, i, 1.5) for i, t in texts], "doc_id long, text string, row long, length double")
    got = packing.pack(docs, PATH, room=256)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check([tuple(r) for r in got.collect()], texts, 256)
    whole = packing.pack(docs, PATH, room=256, with_ids=True).collect()
    for r in whole:
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length


def test_documents_table(spark):
    from conftest import SF_SMALL
    from seclake.llm import queries
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op9(spark, SF_SMALL).collect()]
    n = check(got, docs, 2048)
    assert n <= -(-sum(r[3] for r in got) // 2048) + 2  # no packing could use fewer than the sum allows


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_ids_of_random_texts():
    import random
    plain, encoder, draw = Tokenizer.from_file(PATH), packing.Encoder(PATH), random.Random(5)
    texts = ["".join(draw.choice([" ", " ", "\n", "\t", "a", "bc", "The", "é", "'", "s", "'ll", ".", ",", "!!", "1", "23", "²", "\xa0", "中", "_", "-"]) for _ in range(draw.randint(1, 25))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.many(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
