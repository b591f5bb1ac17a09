import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from helpers import docs
from stratalake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe.Codec(ranks)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_encodes_as_the_library(codec, library):
    rng = random.Random(1)
    letters = "aab b\n é日本 the 123!'s  \tß-_eration"
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.1:
            text += rng.choice("aé-") * rng.randint(1, 3000)
        ids = [t for m in regex.findall(PATTERN, text) for t in codec.matches[m]]
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_join_does_not_depend_on_the_cut(codec):
    rng = random.Random(2)
    for _ in range(100):
        data = bytes(rng.choice(b"abetrhnion") for _ in range(rng.randint(2, 200)))
        whole = codec.merge(data)
        at = rng.randint(1, len(data) - 1)
        assert codec.join(codec.merge(data[:at]), codec.merge(data[at:])) == whole == codec.encode(data)


def test_memory_of_a_codec_does_not_change_results(ranks, codec):
    small = bpe.Codec(ranks, remembered=3)
    for word in ("eration", " thandererin", "ouououououou", "x" * 100):
        assert small.matches[word] == codec.matches[word]


def test_rows_of_all_kinds(spark, ranks, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "long" * 20000), (3, "long" * 20000), (4, "\n\n   x")]
    table = docs(spark, rows, ids="clash", n_tokens="clash", other="kept")
    got = bpe.encode_texts(table, ranks, PATTERN, tuple(bpe.OUTPUTS)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["other"] == "kept"
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(row["decoded"]) == text.encode()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_texts(table.limit(0), ranks, PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_texts(table, ranks, PATTERN, ("nothing",))
