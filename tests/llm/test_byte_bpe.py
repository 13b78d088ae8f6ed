import base64
import hashlib

import pytest
import public_tokenizers
import tiktoken

from cairn.llm import byte_bpe as x


@pytest.fixture(scope="module")
def exact():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", " ", "  ", "   ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a\n  b", " \n \n b", "a \t", "   x", "a   b", "x　 y ", "it's we'll I'D  'S",
    "<|endoftext|> and <|endoftext|>", "naïve café 日本語 😀 👩‍👩‍👧", "1234 5 ½ ²", "!!! ... --- \r\n\r\n tab\tend", "\x00\x01 \x7f", "words " * 30_000, "nospaces" * 5000,
]


def test_round_trip_matches_tiktoken(docs, exact, prose):
    rows = list(enumerate([*TEXTS, *(prose(i, 200) for i in range(5))])) + [(900, None), (900, None), (None, "id is null")]
    got = x.round_trip(docs(rows).select("doc_id", "text")).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i, t in rows:
        ids = exact.encode_ordinary(t or "")
        assert (by[i]["n_tokens"], by[i]["ids_sha256"], by[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(b"".join(v.to_bytes(4, "little") for v in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()), repr(t)[:60]


def test_offsets_and_decoding(docs, exact):
    rows = list(enumerate(TEXTS[:22]))
    found = {r["doc_id"]: r for r in x.encode(docs(rows)).collect()}
    texts = {r["doc_id"]: r["text"] for r in x.decode(x.encode(docs(rows))).collect()}
    for i, t in rows:
        at, character = 0, [k for k, c in enumerate(t) for _ in c.encode()]
        for token, byte, char in zip(found[i]["ids"], found[i]["byte_starts"], found[i]["char_starts"], strict=True):
            assert (byte, char) == (at, character[at])
            at += len(exact.decode_single_token_bytes(token))
        assert texts[i] == t


def test_empty_table(docs):
    assert x.round_trip(docs([])).collect() == [] and x.encode(docs([])).collect() == []


def test_forgetting_changes_nothing(monkeypatch, exact):
    monkeypatch.setattr(x, "REMEMBERED", 3)
    tool = x.Codec(x.VOCABULARY)
    for t in ("a b c d e", "f g h", "a b"):
        assert list(memoryview(tool.encode([t])[0]).cast("I")) == exact.encode_ordinary(t)
