"""Secrets and personal data."""

import base64
import random
import re
import string

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from helpers import docs
from stratalake.llm import bpe, pii, secrets


def fixed_secrets(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 32]
    return sorted(out)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def fixed_pii(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_base_secrets():
    pieces = ["token", "=", "secret:", "abcdef0123456789", "AKIA", "ABCDEFGH1234", '"', " ", "api_key", "Password", "deadbeef" * 4,
              "x", "\n", "'", "-", "é", "ſecret=abcdefghij", "toKen=zzzzzzzzzz", "AKIAAKIA12345678", "token=secret:abcdefgh1"]
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert secrets.base_spans(text) == fixed_secrets(text)


def test_random_strings_but_not_names():
    assert secrets.known("d41d8cd98f00b204e9800998ecf8427e") and secrets.known("123e4567-e89b-12d3-a456-426614174000")
    assert secrets.known("release_candidate_2024_windows") and secrets.known("2024-01-15T10-30-00Z") and secrets.known("4803080219925719")
    assert not secrets.known("aB3xK9qLm2Zp7Rt5Vw8Yd")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokens(ranks):
    table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x.strip())}
    vocabulary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return lambda value: len(vocabulary.encode_ordinary(value))


def test_random_strings_are_found(tokens):
    rng = random.Random(8)
    kinds = {"letters": string.ascii_letters, "capitals": string.ascii_uppercase, "small": string.ascii_lowercase,
             "base62": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/"}
    for kind, alphabet in kinds.items():
        for size in (16, 18, 20, 32, 40):
            if kind == "base64" and size < 32:
                continue
            hits = 0
            for _ in range(400):
                key = "".join(rng.choices(alphabet, k=size))
                text = f"the key {key}, id={key} /h/a/{key}/words"
                found = secrets.random_spans(text, [], tokens)
                hits += len(found) == 3 and all(b - a >= 0.4 * size and text[a:b] in key for a, _, b, _ in found)
            print(kind, size, hits / 400)
            # one case alone: 16 characters in eight tokens are words as often
            assert hits >= (0.8 if kind in ("small", "capitals") else 0.9) * 400, (kind, size, hits)


def test_words_and_identifiers_are_not_random(tokens):
    words = """internationalization misunderstanding getElementsByTagName AbstractSingletonProxyFactoryBean counterrevolutionary
    electroencephalograph max_connections_per_host my-long-css-class-name HTTPServerRequestHandler Rechtsschutzversicherung
    THIS_IS_A_CONSTANT_NAME CONSTITUTIONALLY configuration_manager_v2 2024-01-15T10-30-00Z 0123456789012345678901
    /usr/local/lib/python/site-packages/pandas 123e4567-e89b-12d3-a456-426614174000 d41d8cd98f00b204"""
    assert secrets.random_spans(words, [], tokens) == []


def test_secret_rows_of_all_kinds(spark, ranks):
    odd = "key aB3xK9qLm2Zp7Rt5Vw8Yd and token: aB3xK9qLm2Zp7Rt5Vw8Yd"
    rows = [(1, None), (2, ""), (None, odd), (3, "é " * 50000 + "password=12345678"), (4, "plain words only"), (4, "plain words only")]
    table = docs(spark, rows, spans="clash", kind="clash")
    got = secrets.find(table, ranks, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in got}
    assert by[1] == by[2] == by[4] == []
    assert by[None] == [("random", 4, 25), ("assign", 30, len(odd))]
    assert by[3] == [("assign", 100000, 100017)]
    assert secrets.find(table.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def listed(spark, texts, kinds=("email", "ip", "card", "phone")):
    found = pii.find(docs(spark, list(enumerate(texts))))
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return [r["x"] for r in found.orderBy("doc_id").select(pii.listed(base).alias("x")).collect()]


def test_base_personal_data(spark):
    pieces = ["a@b.c", "@", ".", "x", "1.2.3.4", "256.1.1.1", "000255.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 123-4567",
              "+", " ", "-", "é", "%", "_d@e.fr", "12", "5500-0000-0000-0004", "\n", "+49.30.1234567", "0" * 14, "(", "a.b@c-d.e.f-g"]
    rng = random.Random(2)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert listed(spark, texts) == [",".join(fixed_pii(t)) for t in texts]


def test_very_long_runs(spark):
    texts = ["1" * 200_000, "a" * 200_000, "1 " * 100_000, "a@" + "b." * 50_000 + "c", "+1" + "(" * 100_000, "1.2.3.4 " * 3000]
    got = listed(spark, texts)
    assert got[0] == got[1] == got[2] == got[4] == ""
    assert got[3] == f"email:0:{len(texts[3])}" and got[5] == ",".join(fixed_pii(texts[5]))


def test_checksums_and_context(spark):
    texts = [
        "my iban DE89 3704 0044 0532 0130 00 ok", "DE89370400440532013001", "ssn 123-45-6789", "part 123-45-6789", "ssn 000-45-6789",
        "ssn 1123-45-6789", None, "",
    ]
    got = listed(spark, texts, kinds=("iban", "ssn"))
    assert got == ["iban:8:35", "", "ssn:4:15", "", "", "", "", ""]
    scores = pii.find(docs(spark, [(1, "call +1 555 123 4567"), (2, "x +1 555 123 4567")])).orderBy("doc_id").collect()
    assert [r["spans"][0]["score"] for r in scores] == [0.9, 0.6]


def test_pii_rows_of_all_kinds(spark):
    rows = [(None, "a@b.c"), (1, None), (1, "a@b.c"), (1, "a@b.c")]
    table = docs(spark, rows, spans="clash", _email="kept", start="clash")
    got = pii.find(table.withColumnRenamed("_email", "mail"))
    assert got.count() == 4 and got.where("size(spans) = 1").count() == 3
    assert pii.find(table.limit(0)).count() == 0


def test_running_sums(spark):
    rows = [([],), ([5],), (list(range(1000)),), ([0] * 64,), ([1] * 65,)]
    got = spark.createDataFrame(rows, "x array<int>").select("x", pii.running(F.col("x")).alias("y")).collect()
    for r in got:
        assert r["y"] == [sum(r["x"][:i]) for i in range(len(r["x"]))]
