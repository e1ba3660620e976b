"""Byte-level BPE on texts without blanks, and names of shared stores."""

import random

import pytest

from benchbook.llm import byte_bpe, warc
from benchbook.llm import tokenizers_ as tok


def texts(n):
    rng = random.Random(5)
    common = "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生"
    yield "".join(rng.choice(common) for _ in range(n))
    yield "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    yield "".join(rng.choice(common + "、。，") for _ in range(n))
    yield "".join(chr(rng.randrange(0xAC00, 0xD7A3)) for _ in range(n))
    yield "".join(rng.choice("あいうえおかきくけこアイウエオカキクケコ人国") for _ in range(n))
    yield "".join(rng.choice("aeinrstxyz") for _ in range(n))
    yield "ab" * (n // 2)
    yield "".join(rng.choice(["in", "the", "'s", "'ll", "er", "国", " ", "1", "。"]) for _ in range(n // 2))


class Counting:
    """An encoding that tells how many characters it was given."""

    def __init__(self, encoding):
        self.encoding, self.n = encoding, 0
        self.decode_tokens_bytes = encoding.decode_tokens_bytes

    def encode_ordinary(self, text):
        self.n += len(text)
        return self.encoding.encode_ordinary(text)

    def _encode_single_piece(self, data):
        self.n += len(data.decode())
        return self.encoding._encode_single_piece(data)


@pytest.mark.parametrize(("n", "leaf"), [(20_000, 256), (3_000, 37), (600, 4)])
def test_texts_without_blanks(n, leaf):
    encoding = tok.ranked(tok.BYTE_BPE_RANKS)
    for k, text in enumerate(texts(n)):
        counted = Counting(encoding)
        assert byte_bpe.encode_tree(text, counted, leaf) == encoding.encode_ordinary(text), k
        if leaf == 256:
            assert counted.n <= 1.5 * len(text), (k, counted.n / len(text))


def test_names_of_stores():
    assert warc.shared_uri("s3a://b/k") == "s3://b/k" and warc.shared_uri("s3n://b/k") == "s3://b/k" and warc.shared_uri("gcs://b/k") == "gs://b/k"
    assert warc.shared_uri("hdfs://n:8020/k") == "hdfs://n:8020/k" and warc.shared_uri("abfss://c@a/k") == "abfss://c@a/k" and warc.shared_uri("wasbs://c@a/k") == "abfss://c@a/k"
    assert warc.shared_uri("file:/tmp/x") == "file:///tmp/x" == warc.shared_uri("file:///tmp/x") and warc.shared_uri("/tmp/x:y") == "/tmp/x:y"
